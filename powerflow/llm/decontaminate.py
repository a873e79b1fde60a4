"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of consecutive words. A document holds a window only if it holds all
of the window's shingles, so with containment of one a single shingle is a necessary prefix: the one that
is rarest over all documents. Documents are searched for these shingles alone. A shingle's place in its
window and in the document fixes where the window would lie, which bounds position and length; what is
left is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.llm.bitmap import bitmap_of, passes
from powerflow.llm.common import arrow_schema, documents_of, without_documents
from powerflow.llm.words import mix, pieces, shingles, split_words
from powerflow.operators.grouping import fact_join
from powerflow.session import written

WINDOW = 13
SHINGLE = 3
FLUSH = 1 << 20


def _full_shingles(words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of exactly ``size`` words with the index of their first word."""
    if size == 1:
        return mix(words.hash + np.uint64(1)), np.arange(len(words.hash))
    values, begin = shingles(words, size)
    room = np.repeat(words.first[1:], words.counts)[begin] - begin
    return values[room >= size], begin[room >= size]


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows with the items that hold them and the shingles inside.

    An item with fewer words than a window, but not none, is one window. Items without words, NULL ones
    among them, have no window; a NULL id is not listed.
    """
    schema = "item string, window string, n int, grams array<struct<gram: long, size: int, pos: int>>"
    arrow = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = split_words(piece.column("text"))
                rows = []
                sizes = {size: _full_shingles(words, size) for size in range(1, SHINGLE + 1)}
                for row, item in enumerate(piece.column("id").to_pylist()):
                    first, last = int(words.first[row]), int(words.first[row + 1])
                    texts = words.texts(first, last)
                    n = min(window, last - first)
                    size = min(SHINGLE, n)
                    for at in range(last - first - n + 1 if n else 0):
                        values, begin = sizes[size]
                        lo = int(np.searchsorted(begin, first + at))
                        grams = [
                            {"gram": int(g), "size": size, "pos": pos}
                            for pos, g in enumerate(values[lo : lo + n - size + 1].view(np.int64))
                        ]
                        rows.append({"item": item, "window": " ".join(texts[at : at + n]), "n": n, "grams": grams})
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    items = documents_of(benchmark, "item_id").select(F.col("id").cast("string"), "text")
    return (
        items.mapInArrow(cut, schema)
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"), F.first("n").alias("n"), F.first("grams").alias("grams"))
    )


def _gram_counts(docs: DataFrame, wanted: Broadcast, sizes: list[int]) -> DataFrame:
    """How often each wanted shingle occurs in all documents, combined within each task first."""
    arrow = arrow_schema("gram long, count long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], schema=arrow)

        held, size_held = [np.zeros(0, dtype=np.uint64)], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = split_words(piece.column("text"))
                for size in sizes:
                    values, _ = _full_shingles(words, size)
                    values = values[passes(wanted.value, values)]
                    held.append(values)
                    size_held += len(values)
                if size_held > FLUSH:
                    yield flush()
                    held, size_held = [np.zeros(0, dtype=np.uint64)], 0
        yield flush()

    counted = docs.select("text").mapInArrow(count, "gram long, count long")
    return counted.groupBy("gram").agg(F.sum("count").alias("count"))


def _candidates(docs: DataFrame, wanted: Broadcast, sizes: list[int], window: int) -> DataFrame:
    """Documents with their word counts and each occurrence of a prefix shingle.

    An occurrence brings the words that a window around it can cover, so that it is compared without the
    text. The first element of every list stands for the document itself and matches nothing.
    """
    schema = (
        "id {id}, text_key binary, n_words int, "
        "found array<struct<gram: long, at: int, low: int, around: string>>"
    ).format(id=docs.schema["id"].dataType.simpleString())
    arrow = arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = split_words(piece.column("text"))
                keys = piece.column("text_key")
                self_gram = np.array([int.from_bytes(k.as_py()[:8], "big", signed=True) for k in keys], np.int64)
                found = [[{"gram": int(g), "at": -1, "low": 0, "around": None}] for g in self_gram]
                rows = words.row
                for size in sizes:
                    values, begin = _full_shingles(words, size)
                    on = np.flatnonzero(passes(wanted.value, values))
                    for value, at in zip(values[on].view(np.int64).tolist(), begin[on].tolist(), strict=True):
                        row = rows[at]
                        first, last = int(words.first[row]), int(words.first[row + 1])
                        low, high = max(first, at - window + 1), min(last, at + window)
                        found[row].append({
                            "gram": value, "at": at - first, "low": low - first,
                            "around": " ".join(words.texts(low, high)),
                        })
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"), keys, pa.array(words.counts.astype(np.int32)),
                        pa.array(found, arrow.field("found").type),
                    ],
                    schema=arrow,
                )

    return docs.select("id", "text_key", "text").mapInArrow(find, schema)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    One row per distinct document (``id``, ``text_key``) with ``n_rows`` (how often it occurs in
    the table), ``n_words``, ``n_hit``, ``items`` (sorted ids as strings of the items with a window in
    it) and ``spans`` (begin and end of the hit windows, in words). Texts without words, NULL ones
    among them, have zero counts. The joined lists of a document are as long as its own hits.
    """
    docs = documents_of(documents)
    windows = written(item_windows(benchmark, window), "windows")
    grams = windows.select("window", F.explode("grams").alias("g")).select("window", "g.*")
    sizes = sorted(row["size"] for row in grams.select("size").distinct().collect())  # SHINGLE at most
    counts = _gram_counts(docs, bitmap_of(grams, "gram"), sizes)
    prefix = (
        fact_join(grams, counts, "gram", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "gram", "pos", "size")).alias("rare"))
    )
    rare = written(
        windows.select("window", "items", "n").join(prefix, "window")
        .select("window", "items", "n", F.col("rare.gram").alias("gram"), F.col("rare.pos").alias("pos")),
        "rare",
    )
    found = _candidates(docs, bitmap_of(rare, "gram"), sizes, window)
    found = found.select("id", "text_key", "n_words", F.explode("found").alias("f")).select(
        "id", "text_key", "n_words", "f.*"
    )
    begin = F.col("at") - F.col("pos")
    held = F.slice(F.split("around", " "), begin - F.col("low") + 1, F.col("n"))
    hit = (
        (F.col("at") >= 0) & (begin >= 0) & (begin + F.col("n") <= F.col("n_words"))
        & (F.array_join(held, " ") == F.col("window"))
    )
    joined = found.join(rare, "gram", "left").select(
        "id", "text_key", "n_words", "at",
        F.when(F.when(begin >= 0, hit), F.struct(begin.alias("begin"), (begin + F.col("n")).alias("end"), "items")).alias("hit"),
    )
    span = F.transform(F.array_sort("hits"), lambda h: F.struct(h["begin"].alias("begin"), h["end"].alias("end")))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda done, s: F.struct(
            F.greatest(done["end"], s["end"]).alias("end"),
            (done["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(done["end"], s["begin"]))).alias("n"),
        ),
        lambda done: done["n"],
    )
    return (
        joined.filter("at < 0 OR hit IS NOT NULL")
        .groupBy("id", "text_key")
        .agg(
            F.count_if(F.col("at") < 0).alias("n_base"),
            F.first("n_words").cast("long").alias("n_words"),
            F.collect_set("hit").alias("hits"),
        )
        .withColumn("spans", span)
        .select(
            "id", "text_key", F.col("n_base").alias("n_rows"), "n_words",
            covered.alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("items"),
            F.array_distinct("spans").alias("spans"),
        )
    )


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of the documents, all columns kept, that are not contaminated."""
    bad = contamination(documents, benchmark).filter(is_contaminated()).select("id", "text_key")
    return without_documents(documents, written(bad, "contaminated"))
