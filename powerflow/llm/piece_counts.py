"""Token counts of a piece model, with huge texts encoded in overlapping chunks.

The model merges neighbours only into pieces of its vocabulary. Two characters that stand side by side
inside no piece are therefore never merged, whatever surrounds them: the place between them is a stable
boundary, and the encoding of a text is the concatenation of the encodings on either side. The set of
neighbours that do occur inside pieces is read from the model, so stability is a proof and not a guess.

A huge text is encoded in chunks that overlap; two chunks are spliced at a stable boundary in their
overlap at which both have a token's begin. An overlap without one is widened until it has one or reaches
the end of the text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 256
MAX_KNOWN = 1 << 19  # parts a worker remembers before it starts anew

SPACE = "▁"


class PieceCounter:
    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        if not 0 < overlap < chunk:
            raise ValueError("the overlap must be shorter than the chunk")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        plain = [
            self.model.id_to_piece(i)
            for i in range(self.model.vocab_size())
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        self.inner = {a + b for piece in plain for a, b in zip(piece, piece[1:], strict=False)}
        # a blank never follows another character inside a piece: each run of blanks begins a new part
        self.blank_begins = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inner)
        self.lone_blank = 3 if self.model.is_unknown(self.model.piece_to_id(SPACE)) else 1
        self.known: dict[str, int] = {}
        self.widened = 0

    def stable(self, left: str, right: str) -> bool:
        """Whether no piece holds ``left`` directly before ``right``."""
        pair = (left + right).replace(" ", SPACE)
        return pair not in self.inner

    def count(self, text: str) -> int:
        """Tokens of a whole text, as the library counts them."""
        if len(text) > self.chunk:
            return self.count_chunks(text)
        if self.blank_begins and SPACE not in text and "\x00" not in text:
            return self.count_parts(text)
        return len(self.model.encode(text, out_type="numpy"))

    def count_parts(self, text: str) -> int:
        """Count between stable boundaries before blanks; equal parts are encoded once."""
        if not text:
            return 0
        parts = text.split(" ") if "  " not in text and text[0] != " " and text[-1] != " " else None
        if parts is None:
            parts = [p[1:] if p[0] == " " else p for p in re.findall(r" *[^ ]+| +\Z", _with_blank(text))]
        known = self.known
        try:
            return sum(map(known.__getitem__, parts))
        except KeyError:
            pass
        new = list({part for part in parts if part not in known})
        if len(known) + len(new) > MAX_KNOWN:
            known.clear()
            new = list(set(parts))
        # the library puts a blank before each text, which is the one that was cut off here
        known.update(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True))
        known[""] = self.lone_blank  # a text's last blank; the library adds none to an empty text
        return sum(map(known.__getitem__, parts))

    def begins(self, text: str, begin: int, end: int) -> np.ndarray:
        """Positions in the text at which tokens of one chunk begin."""
        part = text[begin:end]
        offsets = self.model.encode(part, out_type="offset_mapping")["offsets"]
        return np.fromiter((begin + first for first, _ in offsets), dtype=np.int64)

    def splice(self, text: str, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> int | None:
        """First stable boundary in the overlap at which both chunks begin a token.

        A chunk's first character may be merged with the blank that the library puts before it, so it
        is no candidate.
        """
        common = np.intersect1d(left, right)
        for at in common[(common > begin) & (common < end)].tolist():
            if self.stable(text[at - 1], text[at]):
                return at
        return None

    def count_chunks(self, text: str) -> int:
        total, cut = 0, 0
        begin, end = 0, min(self.chunk, len(text))
        left = self.begins(text, begin, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                start = max(cut, end - overlap)
                stop = min(len(text), end + self.chunk)
                right = self.begins(text, start, stop)
                at = self.splice(text, left, right, start, end)
                if at is not None or start == cut:
                    break
                overlap *= 2
                self.widened += 1
            if at is None:  # nothing stable since the last cut: encode on from there as one chunk
                end, left = stop, self.begins(text, begin, stop)
                continue
            total += int(np.count_nonzero((left >= cut) & (left < at)))
            begin, cut, end, left = start, at, stop, right
        return total + int(np.count_nonzero(left >= cut))


def _with_blank(text: str) -> str:
    """The text with the blank that the library puts before it."""
    return " " + text


_COUNTERS: dict[tuple, PieceCounter] = {}


def counter(path: str, chunk: int, overlap: int) -> PieceCounter:
    key = (path, chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS[key] = PieceCounter(*key)
    return _COUNTERS[key]


def token_count(
    text: Column, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> Column:
    """Tokens of each text; NULL and empty texts have none."""

    @F.arrow_udf("long")
    def counts(column: pa.Array) -> pa.Array:
        own = counter(path, chunk, overlap)
        return pa.array([own.count(value.as_py() or "") for value in column], pa.int64())

    return counts(F.coalesce(text.cast("string"), F.lit("")))


def with_token_counts(
    df: DataFrame, path: str, limit: int, text_col: str = "text",
    chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit``, replacing columns of those names.

    Rows are counted where they are, without a shuffle. Memory follows the longest text of a batch.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    counted = df.withColumns({
        "n_bytes": F.octet_length(text).cast("long"),
        "n_tokens": token_count(text, path, chunk, overlap),
    })
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
