"""Words and shingles of batches against the definition."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from powerflow.llm.words import NOT_BLANK, hash_ranges, pieces, shingles, split_words

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_by_definition(text):
    return WORD.findall((text or "").translate(UPPER))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB3é日 .\n-\x00Z", max_size=30)), max_size=6))
def test_words(texts):
    found = split_words(pa.array(texts, pa.string()))
    got = [found.texts(a, b) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    assert got == [words_by_definition(t) for t in texts]
    by_word = {}
    for words, a in zip(got, found.first, strict=False):
        for j, word in enumerate(words):
            assert by_word.setdefault(word, found.hash[a + j]) == found.hash[a + j]
    assert len(set(by_word.values())) == len(by_word)


def test_blank_separated_words():
    found = split_words(pa.array(["A-b\tc\x0bd", " \r", None]), NOT_BLANK)
    assert found.texts(0, 3) == ["a-b", "c", "d"] and list(found.counts) == [3, 0, 0]


def test_long_words_differ():
    long = b"x" * 3000
    data = np.frombuffer(long + long[:-1] + b"y" + long, np.uint8)
    ends = np.array([3000, 6000, 9000])
    a, b, c = hash_ranges(data, ends - 3000, ends)
    assert a == c != b


def test_shingles():
    found = split_words(pa.array(["a b c d", "", "c", "a b c", "b c d"]))
    values, begin = shingles(found, 3)
    assert list(begin) == [0, 1, 4, 5, 8]
    assert values[0] == values[3] and values[1] == values[4] and len(set(values.tolist())) == 3


def test_pieces_keep_rows_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 50, "", "cc", "d"])], ["text"])
    parts = [p.column(0).to_pylist() for p in pieces(batch, "text", 4)]
    assert sum(parts, []) == batch.column(0).to_pylist()
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 4 for p in parts)
    assert list(pieces(batch.slice(0, 0), "text")) == []
