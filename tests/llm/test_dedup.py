"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from powerflow.llm import exact_dedup, near_dedup
from powerflow.llm.prob_minhash import REGISTERS, jaccard, signatures, weighted_sets
from tests.llm.test_words import words_by_definition


def shingle_set(text):
    words = words_by_definition(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes_by_definition(texts):
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return [find(i) for i in range(len(texts))]


def changed(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in text.split())


def test_exact_groups(documents, prose):
    long = prose(1, 4000)
    texts = ["a b", "ab ", "a\tb\n\n", None, "", " \r\n", long, long.replace(" ", "  "), "AB", long + "x"]
    found = exact_dedup.duplicates(documents(texts)).collect()
    bare = [re.sub("[ \t-\r]", "", t or "") for t in texts]
    for row in found:
        group = [i for i, b in enumerate(bare) if b == bare[row["id"]]]
        keep = min(group, key=lambda i: (-len(texts[i] or ""), i))
        assert (row["keep_id"], row["group_size"], row["kept"]) == (keep, len(group), keep == row["id"])
        assert row["text_sha256"] == hashlib.sha256(bare[row["id"]].encode()).hexdigest()
    assert len(found) == len(texts)


def test_exact_repeated_and_null_ids(documents):
    df = documents(["same", "same", "same", "same "], [7, 7, None, None])
    rows = exact_dedup.duplicates(df).collect()
    assert sorted(r["kept"] for r in rows) == [False, False, False, True]
    assert {(r["keep_id"], r["group_size"]) for r in rows} == {(None, 4)}  # the longest text has no id
    left = exact_dedup.keep_one(df)
    assert left.columns == df.columns and left.count() == 1
    left = exact_dedup.keep_one(documents(["same", "same"], [7, 7]))
    assert left.count() == 1


def test_empty_tables(documents):
    empty = documents(["x"]).filter("false")
    assert exact_dedup.duplicates(empty).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0
    assert exact_dedup.keep_one(empty).columns == empty.columns


SCRIPTS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "digits": "0123456789", "base64": "ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "thai": "กขคงจฉชซญดตถทธนบปผพภมยรลวสหอ", "hindi": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    "chinese": "".join(map(chr, range(0x4E00, 0x5800))), "korean": "".join(map(chr, range(0xAC00, 0xB600))),
}


def test_chunks_join_to_the_text(spark, prose):
    """Chunks are the text's bytes; what stands before a text changes few of them, whatever the script."""
    rng = random.Random(5)
    texts = {name: "".join(rng.choice(letters) for _ in range(20000)) for name, letters in SCRIPTS.items()}
    texts |= {"prose": re.sub(" ", "", prose(3, 4000)), "short": "x", "line": "ab\ncd" * 3000, "one": "é" * 9000, "empty": ""}
    rows = [(name, t, lead + t) for name, t in texts.items() for lead in ("q" * 40, "7", "ж")]
    chunks = [exact_dedup.chunks_of(F.col(c)).alias(c) for c in ("t", "u")]
    for name, t, u in spark.createDataFrame(rows, "name string, t string, u string").select("name", *chunks).collect():
        assert b"".join(c.encode("latin-1") for c in t).decode() == texts[name]
        assert all(len(c) <= exact_dedup.MAX_CHUNK for c in t) and all(len(c) >= exact_dedup.MIN_CHUNK for c in t[:-1])
        if name in SCRIPTS or name == "prose":
            assert len(t) > 15 and len(set(t) & set(u)) >= 0.6 * len(t), name


def test_colliding_chunk_hashes_are_told_apart(spark):
    rows = [(i, b"k%d" % i, 3, "s" if i == 0 else None, 0, 1, 5, sha) for i, sha in enumerate((b"one", b"two", b"one"))]
    chunks = spark.createDataFrame(rows, "id long, text_key binary, length int, text_sha256 string, place int, hash long, bytes int, sha binary")
    found = {r["id"]: r["recipe"] for r in exact_dedup.recipes(chunks).collect()}
    assert found[0] == found[2] != found[1]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes(documents, prose, seed):
    texts = [None, "", "...", "one two", "One, two!", "one two three"]
    for k in range(6):
        base = prose(seed * 100 + k, 60 + 40 * k)
        texts += [base] + [changed(base, share, k * 10 + j) for j, share in enumerate((0.01, 0.02, 0.03, 0.05, 0.1))]
    texts += [prose(9, 200), prose(9, 200).upper(), prose(9, 200) + " tail"]
    line = prose(11, 12)
    texts += [" ".join([line] * 30 + [prose(12, 40)]), " ".join([line] * 30 + [prose(13, 40)]), " ".join([line] * 9)]
    found = {r["id"]: r for r in near_dedup.near_duplicates(documents(texts)).collect()}
    assert [found[i]["class_id"] for i in range(len(texts))] == classes_by_definition(texts)
    assert {i for i in found if found[i]["kept"]} == {r["class_id"] for r in found.values()}


def test_a_large_group_of_near_copies(documents, prose, monkeypatch):
    """Copies of one text that differ from each other more than from it, compared in several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    base = prose(5, 120)
    texts = [changed(base, 0.03, j) for j in range(120)] + [prose(6, 120)]
    found = {r["id"]: r["class_id"] for r in near_dedup.near_duplicates(documents(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == classes_by_definition(texts)


def test_near_repeated_rows(documents, prose):
    text = prose(3, 50)
    df = documents([text, text, text + " end", None, None], [4, 4, None, 8, 8])
    rows = near_dedup.near_duplicates(df).collect()
    assert sorted((r["id"] or 0, r["class_id"], r["class_size"], r["kept"]) for r in rows) == [
        (0, 4, 3, False), (4, 4, 3, False), (4, 4, 3, True), (8, 8, 2, False), (8, 8, 2, True),
    ]
    assert near_dedup.keep_one(df).count() == 2


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)]
    labels = near_dedup.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in labels} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a, b = pool[:300], pool[50:350]
    wa, wb = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    wb[:250] = wa[50:]
    kept = signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), np.repeat([0, 1], 300), 2)
    both = np.intersect1d(a, b)
    of_a, of_b = dict(zip(a, wa, strict=True)), dict(zip(b, wb, strict=True))
    exact = sum(
        1 / sum(max(of_a.get(y, 0) / of_a[x], of_b.get(y, 0) / of_b[x]) for y in pool[:350]) for x in both
    )
    assert abs(np.mean(kept[0] == kept[1]) - exact) < 5 * (exact * (1 - exact) / REGISTERS) ** 0.5
    assert not signatures(a[:0], wa[:0], np.zeros(0, np.int64), 1).any()


def test_weighted_sets():
    elements, counts, row = weighted_sets(np.array([5, 3, 5, 5], np.uint64), np.array([1, 0, 1, 0]))
    assert (elements.tolist(), counts.tolist(), row.tolist()) == ([3, 5, 5], [1, 1, 2], [0, 0, 1])
    assert jaccard(elements[:2], elements[2:]) == 0.5
