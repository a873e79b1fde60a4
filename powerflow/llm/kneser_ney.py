"""Interpolated modified Kneser-Ney model of word pairs, counted by Spark.

Each task counts the pairs of its texts and deals them, packed, into shards by their first word and a part of the
second, so that the pairs of a very frequent word are spread over several shards. The number of shards follows the bytes of the text. A shard adds up its
pairs, writes them to the shared folder as a sorted array of hashes with counts, and hands on what each word's
totals need: the number of its followers by count and the number of its predecessors. These are added up in
shards by word and stored in the same way. Nothing of the corpus's size is in one task or on the driver.

Scoring tasks memory-map the arrays and look up the sorted distinct pairs and words of their texts.

Words are 64-bit hashes. In the pairs they are cut to PAIR_BITS bits, which keeps the shuffle small and mixes
up one word in a million; the base score uses the whole hashes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.llm.common import arrow_schema
from powerflow.llm.shared_files import mapped, new_folder, put
from powerflow.llm.words import NOT_BLANK, mix, pieces, split_words

PAIR_BITS = 40
SPREAD = 32  # at least; see spread_of
SHARD_BYTES = 16 << 20  # training text of one shard at most, so a task's group does not grow with the corpus
FLUSH_TOKENS = 3 << 19  # pairs that a task holds before it packs them
BASE_PRIOR = 0.1

_CUT = np.uint64(64 - PAIR_BITS)
_BYTES = PAIR_BITS // 8
_BEGIN = np.uint64(0x1D8AF066F4A9D1B3)
_END = np.uint64(0x6C62272E07BB0142)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MANY = 255  # counts from here on are kept apart

# kinds of packed rows
_WORDS, _PAIRS, _CONTEXTS, _FOLLOWERS = range(4)
_PACKED = "kind int, shard int, data binary"


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, each row's end token included, and each row's first index."""
    words = split_words(column, NOT_BLANK)
    hashes = np.insert(words.hash, words.first[1:], _END)
    return hashes, words.first + np.arange(len(words.first))


def contexts_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _BEGIN
    return before


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a pair of cut hashes."""
    return mix(mix(before + _STEP) * _STEP + word)


def spread_of(shards: int) -> int:
    """Parts of a first word's pairs: a word with an eighth of all pairs fills no more than a shard with each."""
    return max(SPREAD, shards // 8)


def shards_of(texts: DataFrame) -> int:
    """Shards for the bytes of ``text``, at least the shuffle partitions."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))


def pair_shards(before: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    spread = np.uint64(spread_of(shards))
    part = mix(before * spread + word % spread)
    return (part % np.uint64(shards)).astype(np.int64)


def word_shards(cut: np.ndarray, shards: int) -> np.ndarray:
    """Shards of cut word hashes: ranges, so that sorted words lie in one shard after the other."""
    return (((cut >> np.uint64(PAIR_BITS - 32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _narrow(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES]).tobytes()


def _wide(data: memoryview) -> np.ndarray:
    out = np.zeros((len(data) // _BYTES, 8), dtype=np.uint8)
    out[:, :_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    return out.view("<u8").ravel()


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts in a byte each; larger ones follow in order."""
    small = np.minimum(counts, _MANY).astype(np.uint8)
    return small.tobytes() + counts[counts >= _MANY].astype("<u8").tobytes()


def _unpack_counts(data: memoryview, n: int) -> tuple[np.ndarray, int]:
    counts = np.frombuffer(data[:n], np.uint8).astype(np.int64)
    many = np.flatnonzero(counts == _MANY)
    size = n + 8 * len(many)
    counts[many] = np.frombuffer(data[n:size], "<u8")
    return counts, size


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[begin], *(np.add.reduceat(v[order], begin) for v in values))


def _split(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    names, begin = np.unique(shard[order], return_index=True)
    for name, part in zip(names.tolist(), np.split(order, begin[1:]), strict=True):
        yield name, part


def _pack_words(words: np.ndarray, counts: np.ndarray, shards: int) -> list[dict]:
    return [
        {"kind": _WORDS, "shard": s, "data": struct.pack("<q", len(p)) + words[p].astype("<u8").tobytes() + _pack_counts(counts[p])}
        for s, p in _split(word_shards(words >> _CUT, shards))
    ]


def _pack_pairs(before: np.ndarray, word: np.ndarray, counts: np.ndarray, shards: int) -> list[dict]:
    """Pairs by shard; within one, a first word is stored once for all its followers."""
    rows = []
    for shard, part in _split(pair_shards(before, word, shards)):
        part = part[np.argsort(before[part], kind="stable")]
        heads, begin = np.unique(before[part], return_index=True)
        runs = np.diff(np.append(begin, len(part)))
        data = struct.pack("<qq", len(heads), len(part)) + _narrow(heads) + _pack_counts(runs)
        rows.append({"kind": _PAIRS, "shard": shard, "data": data + _narrow(word[part]) + _pack_counts(counts[part])})
    return rows


def _unpack_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    view = memoryview(data)
    (n,) = struct.unpack_from("<q", view)
    return np.frombuffer(view[8 : 8 + 8 * n], "<u8"), _unpack_counts(view[8 + 8 * n :], n)[0]


def _unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    view = memoryview(data)
    heads, n = struct.unpack_from("<qq", view)
    at = 16 + _BYTES * heads
    runs, size = _unpack_counts(view[at:], heads)
    before = np.repeat(_wide(view[16:at]), runs)
    at += size
    return before, _wide(view[at : at + _BYTES * n]), _unpack_counts(view[at + _BYTES * n :], n)[0]


def _pack_totals(kind: int, words: np.ndarray, columns: list[np.ndarray], shards: int) -> list[dict]:
    return [
        {"kind": kind, "shard": s, "data": struct.pack("<q", len(p)) + _narrow(words[p]) + b"".join(_pack_counts(c[p]) for c in columns)}
        for s, p in _split(word_shards(words, shards))
    ]


def _unpack_totals(data: bytes, columns: int) -> list[np.ndarray]:
    view = memoryview(data)
    (n,) = struct.unpack_from("<q", view)
    at = 8 + _BYTES * n
    out = [_wide(view[8:at])]
    for _ in range(columns):
        values, size = _unpack_counts(view[at:], n)
        out.append(values)
        at += size
    return out


@dataclass
class Totals:
    """Sums over the whole training text."""

    folder: str
    shards: int
    tokens: int = 0
    words: int = 0
    pairs: int = 0
    pair_discounts: list[float] = field(default_factory=list)
    word_discounts: list[float] = field(default_factory=list)
    word_rest: float = 1.0  # what the discounts on words leave for the uniform part


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more; plain ones where a count of counts is zero."""
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n3 else 1.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
    return [min(max(d, 0.05), k) for d, k in zip(found, (0.95, 1.95, 2.95), strict=True)]


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)] + [int(np.count_nonzero(counts >= 3))]


def _arrow_rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Packed rows of each (kind, shard), which come sorted."""
    key, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            now = batch.column("kind")[i].as_py(), batch.column("shard")[i].as_py()
            if now != key and held:
                yield (*key, held)
                held = []
            key = now
            held.append(batch.column("data")[i].as_py())
    if held:
        yield (*key, held)


def learn(texts: DataFrame) -> Totals:
    """Count the model of the rows' ``text`` into files of the shared folder."""
    spark = texts.sparkSession
    folder = new_folder(spark, "kneser-ney")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    texts = texts.select(text)
    shards = shards_of(texts)
    packed = arrow_schema(_PACKED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack() -> pa.RecordBatch:
            before, word = np.concatenate(befores), np.concatenate(words)
            own, n = np.unique(word, return_counts=True)
            rows = _pack_words(own, n, shards)
            before, word = before >> _CUT, word >> _CUT
            _, one, n = np.unique(pair_keys(before, word), return_index=True, return_counts=True)
            return _arrow_rows(rows + _pack_pairs(before[one], word[one], n, shards), packed)

        befores, words, size = [], [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens, first = tokens_of(piece.column("text"))
                befores.append(contexts_of(tokens, first))
                words.append(tokens)
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield pack()
                    befores, words, size = [], [], 0
        if size:
            yield pack()

    def add_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, shard, blobs in _grouped(batches):
            if kind == _WORDS:
                yield _arrow_rows([{"kind": kind, "shard": shard, "data": blob} for blob in blobs], packed)
                continue
            before, word, n = (np.concatenate(x) for x in zip(*map(_unpack_pairs, blobs), strict=True))
            keys = pair_keys(before, word)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, before, word = keys[begin], before[order][begin], word[order][begin]
            n = np.add.reduceat(n[order], begin)
            put(folder, f"pairs-{shard:05d}", [struct.pack("<q", len(keys)), keys.astype("<u8").tobytes(), _pack_counts(n)])
            once, twice, more = ((n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64))
            heads, total, *by_count = _sum_by(before, n, once, twice, more)
            rows = _pack_totals(_CONTEXTS, heads, [total, *by_count], shards)
            tails, predecessors = _sum_by(word, np.ones(len(word), dtype=np.int64))
            rows += _pack_totals(_FOLLOWERS, tails, [predecessors], shards)
            # counts of counts travel with the rows of the first shard
            rows.append({"kind": -1, "shard": 0, "data": struct.pack("<6q", len(n), *_count_of_counts(n))})
            yield _arrow_rows(rows, packed)

    sums = "tokens long, words long, pairs long, " + ", ".join(f"p{i} long" for i in range(5)) + ", " + ", ".join(f"w{i} long" for i in range(5))
    sums_arrow = arrow_schema(sums)

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            words, counts = (np.concatenate(x) for x in zip(*found[_WORDS], strict=True)) if found[_WORDS] else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            words, counts = _sum_by(words, counts)
            parts = [[c for c in zip(*found[k], strict=True)] or [[np.zeros(0, np.uint64)]] + [[np.zeros(0, np.int64)]] * n for k, n in ((_CONTEXTS, 4), (_FOLLOWERS, 1))]
            contexts = _sum_by(*(np.concatenate(c) for c in parts[0]))
            followers = _sum_by(*(np.concatenate(c) for c in parts[1]))
            put(folder, f"words-{shard:05d}", [
                struct.pack("<qqq", len(words), len(contexts[0]), len(followers[0])),
                *(np.ascontiguousarray(a, dtype="<u8").tobytes() for a in (words, counts, *contexts, *followers)),
            ])
            row = dict.fromkeys(sums_arrow.names, 0)
            row |= {"tokens": int(counts.sum()), "words": len(words)}
            row |= {f"w{i}": n for i, n in enumerate(_count_of_counts(followers[1]))}
            return _arrow_rows([row], sums_arrow)

        shard, found = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                kind, now, data = (batch.column(name)[i].as_py() for name in ("kind", "shard", "data"))
                if kind == -1:
                    values = struct.unpack("<6q", data)
                    row = dict.fromkeys(sums_arrow.names, 0) | {"pairs": values[0]}
                    yield _arrow_rows([row | {f"p{i}": n for i, n in enumerate(values[1:])}], sums_arrow)
                    continue
                if now != shard:
                    if shard is not None:
                        yield close()
                    shard, found = now, {_WORDS: [], _CONTEXTS: [], _FOLLOWERS: []}
                unpacked = _unpack_words(data) if kind == _WORDS else _unpack_totals(data, 4 if kind == _CONTEXTS else 1)
                found[kind].append(unpacked)
        if shard is not None:
            yield close()

    pairs = texts.mapInArrow(count, _PACKED).repartition(shards, "kind", "shard")
    stats = pairs.sortWithinPartitions("kind", "shard").mapInArrow(add_pairs, _PACKED)
    spread = F.when(F.col("kind") == -1, F.xxhash64("data") % shards).otherwise(F.col("shard"))
    words = stats.repartition(shards, spread).sortWithinPartitions("shard", "kind").mapInArrow(add_words, sums)
    row = words.agg(*[F.sum(name).alias(name) for name in sums_arrow.names]).first().asDict()
    value = {name: int(total or 0) for name, total in row.items()}
    by_word = discounts(*(value[f"w{i}"] for i in range(4)))
    left = by_word[0] * value["w0"] + by_word[1] * value["w1"] + by_word[2] * value["w4"]
    return Totals(
        folder, shards, value["tokens"], value["words"], value["pairs"],
        discounts(*(value[f"p{i}"] for i in range(4))), by_word, left / value["pairs"] if value["pairs"] else 1.0,
    )


class Model:
    """The stored arrays, mapped when first needed. A shard without a file has no entries."""

    def __init__(self, totals: Totals):
        self.totals = totals
        self.pairs: dict[int, tuple] = {}
        self.words: dict[int, tuple] = {}

    def _open(self, name: str) -> memoryview | None:
        try:
            return mapped(self.totals.folder, name)
        except FileNotFoundError:
            return None

    def pair_shard(self, shard: int) -> tuple | None:
        if shard not in self.pairs:
            view = self._open(f"pairs-{shard:05d}")
            if view is None:
                self.pairs[shard] = None
            else:
                (n,) = struct.unpack_from("<q", view)
                at = 8 + 8 * n
                small = np.frombuffer(view[at : at + n], np.uint8)
                many = np.flatnonzero(small == _MANY)
                large = np.frombuffer(view[at + n : at + n + 8 * len(many)], "<u8")
                self.pairs[shard] = np.frombuffer(view[8:at], "<u8"), small, many, large
        return self.pairs[shard]

    def word_shard(self, shard: int) -> list[np.ndarray] | None:
        if shard not in self.words:
            view = self._open(f"words-{shard:05d}")
            if view is None:
                self.words[shard] = None
            else:
                sizes = struct.unpack_from("<qqq", view)
                at, arrays = 24, []
                for n in (sizes[0],) * 2 + (sizes[1],) * 5 + (sizes[2],) * 2:
                    arrays.append(np.frombuffer(view[at : at + 8 * n], "<i8" if len(arrays) not in (0, 2, 7) else "<u8"))
                    at += 8 * n
                self.words[shard] = arrays
        return self.words[shard]

    def pair_counts(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Training counts of pairs of cut hashes; distinct pairs are looked up in the order of the arrays."""
        out = np.zeros(len(before), dtype=np.int64)
        keys = pair_keys(before, word)
        for shard, part in _split(pair_shards(before, word, self.totals.shards)):
            stored = self.pair_shard(shard)
            if stored is None:
                continue
            known, small, many, large = stored
            asked, back = np.unique(keys[part], return_inverse=True)
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            counts = np.where(known[at] == asked, small[at], 0).astype(np.int64)
            big = np.flatnonzero(counts == _MANY)
            counts[big] = large[np.searchsorted(many, at[big])]
            out[part] = counts[back]
        return out

    def word_values(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted distinct words: count, columns of followers (total, once, twice, more), predecessors."""
        count = np.zeros(len(words), dtype=np.int64)
        followers = np.zeros((4, len(words)), dtype=np.int64)
        predecessors = np.zeros(len(words), dtype=np.int64)
        cut = words >> _CUT
        for shard, part in _split(word_shards(cut, self.totals.shards)):
            arrays = self.word_shard(shard)
            if arrays is None:
                continue
            for known, asked, columns, target in (
                (arrays[0], words[part], arrays[1:2], [count]),
                (arrays[2], cut[part], arrays[3:7], list(followers)),
                (arrays[7], cut[part], arrays[8:9], [predecessors]),
            ):
                if len(known):
                    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                    hit = known[at] == asked
                    for column, values in zip(columns, target, strict=True):
                        values[part] = np.where(hit, column[at], 0)
        return count, followers, predecessors

    def score(self, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: training count, base log10 probability, log10 probability after its context."""
        total = self.totals
        words, back = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        count, followers, predecessors = self.word_values(words)
        own, context = back[: len(tokens)], back[len(tokens) :]
        base = np.log10((count + BASE_PRIOR) / (total.tokens + BASE_PRIOR * (total.words + 1)))[own]
        cut = np.array([0.0, *total.word_discounts])
        lower = np.maximum(predecessors - cut[np.minimum(predecessors, 3)], 0) / max(total.pairs, 1)
        lower = (lower + total.word_rest / (total.words + 1))[own]
        times = self.pair_counts(before >> _CUT, tokens >> _CUT)
        cut = np.array([0.0, *total.pair_discounts])
        seen = followers[0][context]
        left = (followers[1] * cut[1] + followers[2] * cut[2] + followers[3] * cut[3])[context]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = (np.maximum(times - cut[np.minimum(times, 3)], 0) + left * lower) / seen
        p = np.where(seen > 0, p, lower)
        return count[own], base, np.log10(p)


_MODELS: dict[str, Model] = {}


def model_of(totals: Totals) -> Model:
    if totals.folder not in _MODELS:
        _MODELS.clear()
        _MODELS[totals.folder] = Model(totals)
    return _MODELS[totals.folder]


def log_scores(text: Column, totals: Totals) -> Column:
    """Struct of ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 of the text's probability)."""
    schema = arrow_schema("n_tokens long, n_known long, base_score double, score double")

    @F.arrow_udf("n_tokens long, n_known long, base_score double, score double")
    def scores(column: pa.Array) -> pa.Array:
        model = model_of(totals)
        out = []
        for piece in pieces(pa.RecordBatch.from_arrays([column], ["text"]), "text", 1 << 20):
            tokens, first = tokens_of(piece.column("text"))
            count, base, score = model.score(tokens, contexts_of(tokens, first))
            begin = first[:-1]
            out.append([np.diff(first), np.add.reduceat((count > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(score, begin)])
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema.names)

    return scores(F.coalesce(text.cast("string"), F.lit("")))


def with_scores(documents: DataFrame, training: Column, text_col: str = "text") -> DataFrame:
    """The documents with ``lm``, a struct of scores and ``train_tokens``, learned from the rows of ``training``.

    NULL and empty texts are the end token alone. Without training rows the base score is that of unseen
    tokens and the model is uniform over one word.
    """
    totals = learn(documents.filter(training).select(F.col(f"`{text_col}`").alias("text")))
    scored = documents.withColumn("lm", log_scores(F.col(f"`{text_col}`"), totals))
    return scored.withColumn("lm", F.col("lm").withField("train_tokens", F.lit(totals.tokens).cast("long")))
