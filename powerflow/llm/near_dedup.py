"""Near duplicates on word shingles: ProbMinHash, banding, exact verification, classes.

Documents whose shingle sets have a Jaccard similarity of at least the threshold are linked, and linked
documents form a class. Signatures are made for shingles weighted by their counts and, where a shingle repeats,
for the plain set as well, so that both kinds of resemblance meet in a band.

A band's bucket is never expanded into its pairs. Each member is first compared with the bucket's smallest
member. Where a bucket then still holds several classes, the members outside its largest one are compared with
all members in blocks of bounded size: by signature first, and those that can reach the threshold by
their shingles, likeliest first, until one link to each other class is found. More links between two
classes would change nothing. A link is therefore lost only if no band of the two documents agrees (three in a
million at the threshold) or their signatures are off by more than five standard errors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from powerflow.llm.bitmap import bitmap_of, may_be_in
from powerflow.llm.common import arrow_schema, documents_of, keep_marked
from powerflow.llm.prob_minhash import REGISTERS, bands_of, jaccard, signatures, weighted_sets
from powerflow.llm.words import mix, pieces, shingles, split_words
from powerflow.operators.grouping import fact_join, first_per_key
from powerflow.session import written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# A bucket's members are compared in blocks of so many rows, or fewer where shingle sets are long
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20


def sketches(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Each document's node (a hash of its shingle set), one byte of each register, and its bands."""
    schema = (
        "id {id}, text_key binary, text_hash long, node long, n_set int, sign binary, bands array<long>"
    ).format(id=documents.schema["id"].dataType.simpleString())
    arrow = arrow_schema(schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows = piece.num_rows
                words = split_words(piece.column("text"))
                values, begin = shingles(words, shingle_words)
                elements, counts, row = weighted_sets(values, words.row[begin])
                sizes = np.bincount(row, minlength=rows)
                plain = signatures(elements, np.ones(len(elements)), row, rows)
                bands = list(bands_of(plain).view(np.int64))
                repeats = np.unique(row[counts > 1])
                if len(repeats):
                    on = np.isin(row, repeats)
                    weighted = signatures(elements[on], counts[on], np.searchsorted(repeats, row[on]), len(repeats))
                    for i, more in zip(repeats, bands_of(weighted).view(np.int64), strict=True):
                        bands[i] = np.union1d(bands[i], more)
                total = np.zeros(rows, dtype=np.uint64)
                np.add.at(total, row, mix(elements + np.uint64(1)))
                node = mix(total + sizes.astype(np.uint64)).view(np.int64)
                empty = sizes == 0
                sign = (plain & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"), piece.column("text_key"), piece.column("text_hash"),
                        pa.array(node, pa.int64(), mask=empty), pa.array(sizes.astype(np.int32)),
                        pa.array([s.tobytes() for s in sign], pa.binary()),
                        pa.array([[] if none else b for none, b in zip(empty, bands, strict=True)], pa.list_(pa.int64())),
                    ],
                    schema=arrow,
                )

    rows = documents.select("id", "text_key", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(sketch, schema)


def _shingle_sets(documents: DataFrame, info: DataFrame, shingle_words: int) -> DataFrame:
    """Signature and sorted shingle hashes, packed, of each node that shares a bucket."""

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        out = []
        for piece in pieces(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
            words = split_words(piece.column("text"))
            values, begin = shingles(words, shingle_words)
            elements, _, row = weighted_sets(values, words.row[begin])
            cut = np.searchsorted(row, np.arange(piece.num_rows + 1))
            out += [elements[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.array(out, pa.binary())

    wanted = bitmap_of(info, "text_hash")
    rows = documents.withColumn("text_hash", F.xxhash64("text")).filter(may_be_in(F.col("text_hash"), wanted))
    owners = info.select("node", "text_hash", "text_key", "sign")
    sets = rows.select("text_hash", "text_key", packed("text").alias("shingles"))
    joined = fact_join(sets, owners, ["text_hash", "text_key"], "inner")
    return joined.select("node", "sign", "shingles").dropDuplicates(["node"])


@F.arrow_udf(T.IntegerType())
def _agreement(left: pa.Array, right: pa.Array) -> pa.Array:
    """Registers in which two signatures agree."""
    a, b = (np.array([v.as_py() for v in side], dtype=f"V{REGISTERS}").view(np.uint8).reshape(-1, REGISTERS) for side in (left, right))
    return pa.array((a == b).sum(axis=1).astype(np.int32))


@F.arrow_udf(T.DoubleType())
def _jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([
        jaccard(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64))
        for a, b in zip(left, right, strict=True)
    ], pa.float64())


def least_agreement(similarity: float) -> int:
    """Registers in which two sets of this similarity agree but for one case in two million."""
    error = (REGISTERS * similarity * (1 - similarity)) ** 0.5
    return max(1, int(REGISTERS * similarity - 5 * error))


def _with_node(pairs: DataFrame, key: str, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pairs with columns of one of their nodes."""
    side = table.select(F.col("node").alias(key), *[F.col(old).alias(new) for old, new in columns.items()])
    return fact_join(pairs, side, key, "inner")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose exact similarity reaches the threshold."""
    both = _with_node(_with_node(pairs, "a", sets, {"shingles": "left"}), "b", sets, {"shingles": "right"})
    sizes = F.octet_length("left"), F.octet_length("right")
    possible = both.filter(F.least(*sizes) >= similarity * F.greatest(*sizes))
    return possible.filter(_jaccard("left", "right") >= similarity).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """Smallest node of each component: (node, label), for nodes with links.

    Labels travel along links and along the labels found so far, so the number of rounds grows with the
    logarithm of the longest path.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        near = fact_join(edges.withColumnRenamed("a", "node"), labels, "node", "inner").groupBy(F.col("b").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        best = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = written(
            fact_join(best, far, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")
            ),
            "labels",
        )
        changed = not labels.filter("label < old").isEmpty()
        labels = labels.select("node", "label")
        if not changed:
            return labels


def _labelled(rows: DataFrame, key: str, labels: DataFrame, name: str) -> DataFrame:
    side = labels.select(F.col("node").alias(key), F.col("label").alias(name))
    joined = fact_join(rows, side, key, "left")
    return joined.withColumn(name, F.coalesce(name, key))


def _new_links(
    node: np.ndarray, label: np.ndarray, rest: np.ndarray, sign: np.ndarray, sets: list[np.ndarray],
    enough: int, similarity: float,
) -> list[tuple[int, int]]:
    """One link from each row of ``rest`` to each other class that it has a link to, within one block."""
    size = np.array([len(s) for s in sets])
    others = np.flatnonzero(~rest)
    links = []
    for i in np.flatnonzero(rest):
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        on = others[(label[others] != label[i]) & (low >= similarity * high)]
        same = (sign[on] == sign[i]).sum(axis=1)
        likely = same >= enough
        on = on[likely][np.argsort(-same[likely], kind="stable")]
        step = 8
        while len(on):
            now, on = on[:step], on[step:]
            elements = np.concatenate([sets[j] for j in now])
            at = np.minimum(np.searchsorted(sets[i], elements), size[i] - 1)
            begins = np.cumsum(size[now]) - size[now]
            common = np.add.reduceat((sets[i][at] == elements).astype(np.int64), begins)
            found = now[common >= similarity * (size[i] + size[now] - common)]
            _, one = np.unique(label[found], return_index=True)
            links += [(int(node[i]), int(node[j])) for j in found[one]]
            on = on[~np.isin(label[on], label[found])]
            step *= 8
    return links


def _rest_links(members: DataFrame, labels: DataFrame, sets: DataFrame, enough: int, similarity: float) -> DataFrame:
    """Links between classes that share a bucket: (a, b), at least one for every two classes linked there.

    One end is outside its bucket's largest class. Both sides are dealt into blocks, and every block of
    the one meets every block of the other in a group of its own.
    """
    rows = _labelled(members, "node", labels, "label")
    rows = fact_join(rows, sets.select("node", F.octet_length("shingles").alias("bytes")), "node", "inner")
    classes = rows.groupBy("band", "label").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK_BYTES / F.col("longest"))))
    buckets = (
        classes.groupBy("band")
        .agg(
            F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("classes"), F.sum("n").alias("size"),
            F.max("bytes").alias("longest"),
        )
        .filter("classes > 1 AND size > 2")  # of two members, the one pair has been compared
        .select(
            "band", F.col("top.label").alias("top"),
            F.ceil(F.col("size") / block).cast("int").alias("all_blocks"),
            F.ceil((F.col("size") - F.col("top.n")) / block).cast("int").alias("rest_blocks"),
        )
    )
    active = fact_join(rows.select("band", "node", "label"), buckets, "band", "inner")
    active = fact_join(active, sets, "node", "inner")
    spot = F.xxhash64("node")
    outside = F.col("label") != F.col("top")
    # a row outside the largest class stands on both sides; it is sent once for each block it meets
    places = F.transform(
        F.sequence(F.lit(0), F.col("rest_blocks") - 1),
        lambda line: F.struct(F.pmod(spot, "all_blocks").cast("int").alias("column"), line.alias("line"), F.lit(False).alias("rest")),
    )
    rest_places = F.transform(
        F.sequence(F.lit(0), F.col("all_blocks") - 1),
        lambda column: F.struct(column.alias("column"), F.pmod(spot, "rest_blocks").cast("int").alias("line"), F.lit(True).alias("rest")),
    )
    spread = active.select(
        "band", "node", "label", "sign", "shingles",
        F.explode(F.when(outside, F.concat(places, rest_places)).otherwise(places)).alias("place"),
    ).select("band", "place.line", "place.column", "node", "label", "place.rest", "sign", "shingles")
    schema = "a long, b long"
    arrow = arrow_schema(schema)

    def compare(table: pa.Table) -> pa.RecordBatch:
        links = _new_links(
            table.column("node").to_numpy(), table.column("label").to_numpy(),
            table.column("rest").to_numpy().astype(bool),
            np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(-1, REGISTERS),
            [np.frombuffer(v, np.uint64) for v in table.column("shingles").to_pylist()], enough, similarity,
        )
        ends = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], schema=arrow)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "line", "column")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                key = tuple(keys[:, a])
                if held and key != last:
                    yield compare(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = key
        if held:
            yield compare(pa.Table.from_batches(held))

    return (
        spread.repartition("band", "line", "column").sortWithinPartitions("band", "line", "column")
        .mapInArrow(blocks, schema).distinct()
    )


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """Class of each row: ``id``, ``text_key``, ``class_id``, ``class_size``, ``kept`` and ``copy``.

    The class's id is the smallest id in it, NULL last; that row stays, and of rows equal in id and text
    one. A text with fewer words than a shingle has one shingle of all of them. Texts without words, NULL
    ones among them, resemble nothing, not even each other.
    """
    docs = documents_of(documents)
    all_docs = written(sketches(docs, shingle_words), "sketches")
    banded = all_docs.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("other")).filter("leader < other")
    members = written(
        fact_join(banded, shared.select("band", "leader"), "band", "inner").distinct(), "members"
    )
    in_bucket = members.select("node").distinct()
    enough = least_agreement(similarity)
    found = fact_join(all_docs.select("node", "id", "text_key", "text_hash", "sign"), in_bucket, "node", "inner")
    info = written(
        first_per_key(found, "node", [F.col("text_key"), F.col("id")]).select("node", "text_hash", "text_key", "sign"),
        "nodes",
    )
    sets = written(_shingle_sets(docs, info, shingle_words), "shingle-sets")

    stars = written(
        members.filter("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "stars"
    )
    signed = _with_node(_with_node(stars, "a", sets, {"sign": "left"}), "b", sets, {"sign": "right"})
    likely = signed.filter(_agreement("left", "right") >= enough).select("a", "b")
    links = written(_verified(likely, sets, similarity), "links")
    labels = components(links)

    more = written(_rest_links(members.select("band", "node"), labels, sets, enough, similarity), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    rows = all_docs.groupBy("id", "text_key", "node").agg(F.count("*").alias("n_rows"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("text_key"))
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min(order).alias("first"), F.sum("n_rows").alias("n"))
    nodes = _labelled(nodes, "node", labels, "label")
    classes = nodes.groupBy("label").agg(F.min("first").alias("keep"), F.sum("n").alias("class_size"))
    of_node = fact_join(nodes.select("node", "label"), classes, "label", "inner").select("node", "keep", "class_size")
    joined = fact_join(rows, of_node, "node", "left")
    first = F.coalesce(
        F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("text_key") == F.col("keep.text_key")), F.lit(True)
    )
    alone = F.col("node").isNull()
    return joined.select(
        "id", "text_key",
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("class_id"),
        F.when(alone, F.col("n_rows")).otherwise(F.col("class_size")).alias("class_size"),
        F.when(alone, F.lit(True)).otherwise(first).alias("first"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"),
    ).select("id", "text_key", "class_id", "class_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "copy")


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each class, all columns kept."""
    return keep_marked(documents, written(near_duplicates(documents), "near"))
