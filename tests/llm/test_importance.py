"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from powerflow.llm import importance, selection

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, orders):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]


def expected(rows, target, percent, min_words, seed, orders, buckets):
    def counted(texts):
        total = [0] * buckets
        for text in texts:
            for feature in runs(text, orders)[1]:
                total[zlib.crc32(feature.encode()) % buckets] += 1
        return total

    source, aim = counted(t for _, t in rows), counted(target)
    gain = [
        math.floor(1000 * math.log((t + 1) * (sum(source) + buckets) / ((s + 1) * (sum(aim) + buckets))))
        for s, t in zip(source, aim, strict=True)
    ]
    out = []
    for doc_id, text in rows:
        words, found = runs(text, orders)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(found), weight, score, None])
    able = sorted((row for row in out if row[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, out), key=str)


def drawn(df, target, **options):
    found = importance.draw(df, target, **options)
    return sorted(map(tuple, found.select("id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("orders", [(1, 1), (1, 2), (2, 3)])
def test_draw_matches_plain_python(spark, documents, prose, orders):
    rng = random.Random(3)
    texts = [prose(i, rng.randrange(0, 40)) for i in range(150)]
    texts += [None, "", "...", "ÄÖ é Straße 漢字", "ein-Wort", prose(1, 30), "W" * 5000 + " " + prose(2, 30)]
    ids = [*range(len(texts) - 3), None, 4, 4]
    target = [prose(i, 60) for i in (1, 2)] + [None]
    options = {"percent": 25, "min_words": 5, "seed": 9, "orders": orders, "buckets": 64}
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert drawn(documents(texts, ids), aim, **options) == expected(list(zip(ids, texts, strict=True)), target, **options)


def test_repeated_rows_are_drawn_exactly(spark, documents, prose):
    same = prose(5, 30)
    df = documents([same] * 10 + ["kurz"], [1] * 10 + [2])
    aim = spark.createDataFrame([(same,)], "text string")
    ranks = [row[5] for row in drawn(df, aim, percent=50, min_words=20, seed=1)]
    assert sorted(r for r in ranks if r) == [1, 2, 3, 4, 5] and ranks.count(None) == 6


def test_empty_tables(spark, documents, prose):
    none = spark.createDataFrame([], "text string")
    assert drawn(documents([]), none, percent=10, min_words=20, seed=1) == []
    rows = [(0, prose(1, 30)), (1, None)]
    options = {"percent": 100, "min_words": 20, "seed": 1, "orders": (1, 1), "buckets": 16}
    assert drawn(documents([t for _, t in rows]), none, **options) == expected(rows, [], **options)


def test_resample_returns_whole_rows(spark, documents, prose):
    df = documents([prose(i, 25) for i in range(20)])
    out = importance.resample(df, spark.createDataFrame([(prose(3, 50),)], "text string"), percent=20, min_words=20, seed=4)
    assert out.columns == [*df.columns, "draw_rank"]
    rows = out.collect()
    assert sorted(r["draw_rank"] for r in rows) == [1, 2, 3, 4] and {r["id"] for r in rows} == {"x"}


def test_buckets_are_bounded(spark, documents):
    with pytest.raises(ValueError, match="buckets"):
        importance.draw(documents(["a"]), spark.createDataFrame([], "text string"), 10, 1, 1, buckets=1 << 30)


def test_checksums_of_ranges():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 70), 1000]]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - np.array([len(w) for w in words])
    assert importance.crc_of_ranges(data, start, end).tolist() == list(map(zlib.crc32, words))
    column = pa.array(["a b", None, "", "b"])
    bucket, row, n_words = importance.features(column, (2, 2), 1 << 31)
    assert bucket.tolist() == [zlib.crc32(b"a b") % (1 << 31)] and row.tolist() == [0] and n_words.tolist() == [2, 0, 0, 1]


@pytest.mark.parametrize("block", [1, 7, 64])
def test_every_kth_key_is_found(spark, block):
    rng = random.Random(block)
    keys = [(rng.randrange(6), rng.randrange(4), i) for i in range(200)]
    df = spark.createDataFrame(keys, "a long, b long, c long").repartition(5)
    df = df.checkpoint() if spark.sparkContext.getCheckpointDir() else df
    for k in (1, 2, 50, 101, 199, 200):
        assert selection.kth_key(df, ["a", "b", "c"], k, block) == sorted(keys)[k - 1]
    for k in (0, 201):
        with pytest.raises(ValueError, match="no key number"):
            selection.kth_key(df, ["a", "b", "c"], k, block)


def test_ranks_are_whole_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), F.lit(0).cast("long").alias("b"), F.col("id").alias("c"))
    rows = selection.ranked(df, ["a", "b", "c"], "ranks").orderBy("a", "b", "c").collect()
    assert [r["rank"] for r in rows] == list(range(1, 5001))
