"""Packing of tokenized documents into as few sequences of one length as possible.

Documents are encoded once, where they are; only a histogram of the lengths of their pieces, one number for each
length up to the capacity, goes to the driver, where :mod:`powerflow.llm.bin_plan` decides which lengths share a
sequence. The plan speaks of ranks: the n-th piece of a length has its sequence and offset. A piece's rank is its
number among the pieces of its length in its part of the table, plus what earlier parts hold, so no length is gathered
or sorted anywhere, however many pieces have it.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from powerflow.llm.bin_plan import plan
from powerflow.session import written

CHUNK_CHARS = 1 << 16
OUT_ROWS = 4096
OUT_TOKENS = 1 << 20

# No match of the vocabulary's pattern, and no special token, goes from a letter or digit on into a blank.
_BORDER = re.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")


class Encoder:
    """Token ids of whole texts, with an end id, as the library of the vocabulary gives them.

    A byte-level vocabulary whose ids follow its merges has the same encodings by ranks, which a quicker library
    takes; texts with one of its special strings, and other vocabularies, go to the library itself.
    """

    def __init__(self, path: str, end: int, chunk: int = CHUNK_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model, self.end, self.chunk = Tokenizer.from_file(path), end, chunk
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [token["content"] for token in described["added_tokens"]]
        ranks = byte_ranks(described)
        self.quick = ranks and tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def chunks(self, text: str) -> Iterator[str]:
        """Parts of at least ``chunk`` characters that are encoded each for itself."""
        begin = 0
        while len(text) - begin > self.chunk:
            border = _BORDER.search(text, begin + self.chunk)
            if border is None:
                break
            yield text[begin : border.start()]
            begin = border.start()
        yield text[begin:]

    def encode(self, text: str) -> np.ndarray:
        if self.quick and not any(special in text for special in self.special):
            ids = [self.quick.encode_to_numpy(part, disallowed_special=()) for part in self.chunks(text)]
        else:
            found = (self.model.encode_batch_fast([part], add_special_tokens=False)[0].ids for part in self.chunks(text))
            ids = [np.array(part, dtype="<u4") for part in found]
        return np.concatenate([*ids, np.array([self.end], dtype="<u4")])


def byte_ranks(described: dict) -> dict[bytes, int] | None:
    """Ranks of the tokens' bytes, or None if the vocabulary is not one that ranks describe.

    That is byte-level BPE without further steps, cut by the usual pattern, in which the n-th merge makes the n-th token
    after the 256 bytes.
    """
    model, cut = described["model"], described["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or not plain or described["normalizer"] or any(model.get(name) for name in odd):
        return None
    words = model["vocab"]
    merged = ("".join(pair if isinstance(pair, list) else pair.split(" ")) for pair in model["merges"])
    if any(words.get(word) != 256 + n for n, word in enumerate(merged)) or len(words) != 256 + len(model["merges"]):
        return None
    # bytes that are printable stand for themselves, the others for the characters from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
    return {bytes(letters[letter] for letter in word): rank for word, rank in words.items()}


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, end: int, chunk: int) -> Encoder:
    key = (path, end, chunk)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def pieces_of(
    documents: DataFrame, path: str, capacity: int, end: int = 0, id_col: str = "doc_id", text_col: str = "text",
    keep_ids: bool = False, chunk: int = CHUNK_CHARS,
) -> DataFrame:
    """Pieces of all documents: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and ``ids`` if wanted.

    A document's ids end with the id ``end``. Longer ones than the capacity are cut into pieces of the capacity, of
    which the first may be shorter. ``part`` and ``nth`` number the pieces of a length in each partition. NULL
    counts as empty; an empty text is the end id alone. A task holds one document's ids at a time.
    """
    id_type = documents.schema[id_col].dataType
    fields = [
        T.StructField("id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
    ] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path, end, chunk), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        ids_of, rows, tokens = [], [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.chunked_array(ids_of).combine_chunks() if ids_of else pa.array([], arrow.field("id").type)]
            columns += [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), list(arrow)[1:], strict=True)]
            return pa.RecordBatch.from_arrays([columns[0].cast(arrow.field("id").type), *columns[1:]], schema=arrow)

        for source in batches:
            for i in range(source.num_rows):
                ids = own.encode(source.column(1)[i].as_py() or "")
                begin, number = 0, 0
                until = len(ids) % capacity or capacity
                while begin < len(ids):
                    some = ids[begin:until]
                    row = (number, begin, len(some), zlib.crc32(some.tobytes()), part, seen[len(some)])
                    rows.append((*row, some.astype("<i4")) if keep_ids else row)
                    ids_of.append(source.column(0).slice(i, 1))
                    seen[len(some)] += 1
                    tokens += len(some)
                    begin, until, number = until, until + capacity, number + 1
                    if len(rows) >= OUT_ROWS or keep_ids and tokens >= OUT_TOKENS:
                        yield batch()
                        ids_of, rows, tokens = [], [], 0
        if rows:
            yield batch()

    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(cut, schema)


def pack(documents: DataFrame, path: str, capacity: int, **options) -> DataFrame:
    """The pieces of :func:`pieces_of` with the ``sequence_id`` and ``offset`` they are packed at.

    Sequences are numbered from 0 and filled without gaps from offset 0. Equal rows are documents of their own; an
    empty table gives no rows. Encoded pieces are written once, so a lost executor changes no rank.
    """
    pieces = written(pieces_of(documents, path, capacity, **options), "packing-pieces")
    counts = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).toArrow()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    histogram[totals["length"].to_numpy()] = totals["n"].to_numpy()
    decided = plan(histogram, capacity)

    # one row for each part and length, never for each piece
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = counts.select("part", "length", earlier.alias("earlier")).hint("merge")  # grows with the parts
    numbered = pieces.join(offsets, ["part", "length"])

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = decided.place(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(values) for values in found], ["sequence_id", "offset"])

    placed = numbered.withColumn("place", place("length", F.col("earlier") + F.col("nth")))
    return placed.select("id", *[c for c in pieces.columns if c not in ("id", "part", "nth")], "place.*")


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of whole sequences, from pieces that were packed with ``keep_ids``; at most the capacity each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids"))
    return whole.withColumn("n_tokens", F.size("ids"))
