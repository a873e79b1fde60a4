"""Byte-level BPE by a lazily determinised transducer.

BPE has a local characterisation: a sequence of tokens is the encoding of its bytes exactly if every
pair of neighbours, encoded on its own, gives that pair back, and every token encodes to itself. An
encoding can then be read from left to right. For each position the last token of the prefix's encoding is
unique, so the transducer keeps, for every start of a token that may still be running, the node of the
vocabulary tree and the last token before it. These sets are its states. They are determinised as texts
reach them: a transition is computed once and then looked up in a flat table. A start stays open for at most
the longest token's length, which bounds the lookahead.

Each transition gives the last token of the prefix that ends there. All different pieces of a batch of texts
step through the table at once, one byte a step, and their tokens are read backwards from the last one. A long piece is
streamed instead: what all open starts have in common is emitted while it is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.llm.common import release_memory

# Bounds of what a task remembers; beyond them it starts anew, results stay the same. A ``memory`` of 2 doubles the
# last two, which spends some 60 MB a task to compute fewer transitions twice.
MAX_PAIRS = 1 << 16
ENTRY_BYTES = 200
MAX_STATES = 1 << 17
KNOWN_BYTES = 1 << 25  # of parts of texts and their ids, with what their entries take
SLICE_IDS = 1 << 16
LONG_PIECE = 96  # bytes from which a piece is streamed
BATCH_CHARS = 1 << 19  # of texts that are encoded together

# White space and controls on which engines differ; texts that hold one are not cut.
_ODD_WHITE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_WHITE_RUN = re.compile(r"[ \t-\r][ \t-\r]")
# parts that begin where a run of white space follows another character
_PARTS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+\Z")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE by definition: merge the leftmost pair of the lowest rank until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        options = [(ranks.get(parts[i] + parts[i + 1], None), i) for i in range(len(parts) - 1)]
        options = [option for option in options if option[0] is not None]
        if not options:
            break
        _, at = min(options)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class Moves:
    """Transitions in flat arrays: an open-addressed table from state and byte to the next state and the last token."""

    def __init__(self) -> None:
        self.size = 0
        self.key = np.full(1 << 12, -1, dtype=np.int64)
        self.to = np.zeros(1 << 12, dtype=np.int32)
        self.token = np.zeros(1 << 12, dtype=np.int32)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or of the gap where it belongs."""
        mask = len(self.key) - 1
        at = (keys * -0x61C8864680B583EB >> 33) & mask
        held = self.key[at]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            next_ = (at[open_] + 1) & mask
            at[open_] = next_
            held = self.key[next_]
            open_ = open_[(held != keys[open_]) & (held >= 0)]
        return at

    def add(self, keys: np.ndarray, to: np.ndarray, token: np.ndarray) -> None:
        """Different keys that are not there yet; at least half of the table stays free."""
        if (self.size + len(keys)) * 2 > len(self.key):
            old = self.key >= 0
            rows = [np.concatenate([mine[old], more]) for mine, more in ((self.key, keys), (self.to, to), (self.token, token))]
            room = 1 << int(4 * len(rows[0])).bit_length()
            self.size, self.key = 0, np.full(room, -1, dtype=np.int64)
            self.to, self.token = np.zeros(room, dtype=np.int32), np.zeros(room, dtype=np.int32)
            keys, to, token = rows
        left = np.arange(len(keys))
        while len(left):
            at = self.places(keys[left])
            _, first = np.unique(at, return_index=True)  # two keys may ask for the same gap
            done = left[first]
            self.key[at[first]], self.to[at[first]], self.token[at[first]] = keys[done], to[done], token[done]
            left = np.delete(left, first)
        self.size += len(keys)


class Transducer:
    """Bytes in, token ids out, pieces of the pattern each for itself."""

    BEGIN = bytes(8)

    def __init__(self, ranks: dict[bytes, int], max_states: int | None = None):
        self.ranks, self.max_states = ranks, max_states or MAX_STATES
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = np.zeros(max(self.tokens, default=-1) + 1, dtype=np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        # vocabulary tree: node and byte -> node; node -> the token that ends there
        self.next: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.next.get(key, 0)
                if not node:
                    node = self.next[key] = nodes
                    nodes += 1
            self.ends[node] = rank
        self.inner = bytearray(nodes)  # nodes that a token may go on from
        for key in self.next:
            self.inner[key >> 8] = 1
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.never = max(ranks.values(), default=0) + 2  # a rank after all others
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state packs its open starts: node << 32 | last token before the start + 1, 0 for none.
        self.states: dict[bytes, int] = {}
        self.open: list[bytes] = []
        self.moves = Moves()
        self.state(self.BEGIN)

    def state(self, open_: bytes) -> int:
        number = self.states.get(open_)
        if number is None:
            number = self.states[open_] = len(self.open)
            self.open.append(open_)
        return number

    def reachable(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        known = self.whole.get(token)
        if known is None:
            data = self.tokens[token]
            if len(data) > 1:
                parts = self.split(token)
                known = parts is not None and len(parts) == 2
            else:
                known = True
            self.whole[token] = known
        return known

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the token is merged from last; None for a single byte."""
        if token not in self.parts:
            data = self.tokens[token]
            # without its own rank the bytes stop one merge short of the token
            ranks = self.ranks
            found = None
            if len(data) > 1:
                del ranks[data]
                parts = merge_by_rank(data, ranks)
                ranks[data] = token
                found = (parts[0], parts[1]) if len(parts) == 2 else None
            self.parts[token] = found
        return self.parts[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together.

        Only merges across the border could join them. From the last merges of both tokens backwards, the pair that
        meets at the border is asked for at each point in time: it would be merged if its rank comes before that of the merge
        that takes one of the two away from the border. On equal ranks the left one of two places comes first.
        """
        if left < 0:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        ranks, tokens = self.ranks, self.tokens
        a, b = left, right
        # ranks at which the present pair stops being neighbours: a merge into left or right consumes it
        until = self.never
        while True:
            rank = ranks.get(tokens[a] + tokens[b])
            if rank is not None and rank < until:
                return False
            inner, outer = self.split(a), self.split(b)
            if inner is None and outer is None:
                return True
            # the later of the two merges is undone first
            if outer is None or inner is not None and a > b:
                until, a = a, inner[1]
            else:
                # a merge of the same rank further right comes after one at the border
                until, b = b + 1, outer[0]

    def move(self, open_: bytes, byte: int) -> tuple[bytes, int, list[int], int]:
        """Next open starts, the token that ends here (-1: none), which starts stay open and which one ends.

        A start at the new position is added if a token of the encoding ends there.
        """
        after, kept, left, ended = [], [], -1, -1
        for i, start in enumerate(memoryview(open_).cast("Q")):
            node = self.next.get(start >> 32 << 8 | byte)
            if node is None:
                continue
            before = start & 0xFFFFFFFF
            if self.inner[node]:
                after.append(node << 32 | before)
                kept.append(i)
            if left < 0:
                token = self.ends.get(node)
                if token is not None and self.reachable(token) and self.fits(before - 1, token):
                    left, ended = i, token
        if left >= 0:
            after.append(ended + 1)
        return array("Q", after).tobytes(), ended, kept, left

    def step(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and last tokens; transitions that are not known yet are computed once each."""
        keys = states << 8 | data
        at = self.moves.places(keys)
        missing = self.moves.key[at] < 0
        if missing.any():
            new = np.unique(keys[missing])
            found = [self.move(self.open[key >> 8], key & 255)[:2] for key in new.tolist()]
            to = np.array([self.state(open_) for open_, _ in found], dtype=np.int32)
            self.moves.add(new, to, np.array([token for _, token in found], dtype=np.int32))
            at = self.moves.places(keys)
        return self.moves.to[at].astype(np.int64), self.moves.token[at]

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of ids of each."""
        if len(self.open) >= self.max_states:
            self.reset()
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.int64)
        # the longest first, so that those still running are always the first ones
        order = np.argsort(-lengths, kind="stable")
        begins = (ends - lengths)[order]
        running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        states = np.zeros(len(pieces), dtype=np.int64)
        last = np.empty(len(data), dtype=np.int32)
        for place, n in enumerate(running.tolist()):
            at = begins[:n] + place
            states[:n], last[at] = self.step(states[:n], data[at])
        # tokens from the last one backwards
        numbers, left = np.flatnonzero(lengths), lengths.copy()
        counts = np.zeros(len(pieces), dtype=np.int64)
        steps = []
        while len(numbers):
            tokens = last[(ends - lengths)[numbers] + left[numbers] - 1]
            if (tokens < 0).any():
                raise ValueError("the vocabulary has no token for a byte")
            steps.append((numbers, tokens))
            counts[numbers] += 1
            left[numbers] -= self.lengths[tokens]
            numbers = numbers[left[numbers] > 0]
        ids = np.empty(int(counts.sum()), dtype="<u4")
        place = np.cumsum(counts)
        for numbers, tokens in steps:
            place[numbers] -= 1
            ids[place[numbers]] = tokens
        return ids, counts

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length. Tokens leave the buffer as soon as all open starts share them."""
        out: list[int] = []
        open_ = self.BEGIN
        # for each open start the tokens before it that are not yet in ``out``
        paths: list[tuple] = [()]
        final: tuple = ()
        ended = -1
        for byte in piece:
            open_, ended, kept, at = self.move(open_, byte)
            if not open_:
                raise ValueError("the vocabulary has no token for a byte")
            grown = [paths[i] for i in kept]
            if at >= 0:
                final = (*paths[at], ended)
                grown.append(final)
            paths = grown
            if len(paths) == 1:
                if paths[0]:
                    out.extend(paths[0])
                    paths, final = [()], () if final is paths[0] else final
            elif len(paths[0]) > 16:
                shared = 0
                while all(len(p) > shared and p[shared] == paths[0][shared] for p in paths):
                    shared += 1
                out.extend(paths[0][:shared])
                paths, final = [p[shared:] for p in paths], final[shared:]
        if piece and ended < 0:
            raise ValueError("the vocabulary has no token for a byte")
        return [*out, *final]


class Utf8Decoder:
    """Streaming UTF-8 state machine: bytes in, whole characters out.

    ``feed`` returns the text complete so far and keeps an unfinished sequence for the next call. A
    byte that no valid text has there becomes U+FFFD, as each maximal invalid part does in the
    standard's recommended practice. Valid stretches are taken at once; the machine steps through
    single bytes only from an invalid part on.
    """

    def __init__(self) -> None:
        self.need = 0  # continuation bytes still to come
        self.low, self.high = 0x80, 0xBF  # bounds of the next one
        self.held = bytearray()

    def feed(self, data: bytes) -> str:
        data = bytes(self.held) + data
        self.__init__()
        whole = len(data)
        for back in range(1, min(4, len(data) + 1)):  # an unfinished sequence at the end
            lead = data[-back]
            if lead >= 0xC0:
                if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    whole -= back
                break
            if lead < 0x80:
                break
        try:
            done = data[:whole].decode("utf-8")
        except UnicodeDecodeError as error:
            whole = error.start
            done = data[:whole].decode("utf-8")
        return done + self.step(data[whole:])

    def step(self, data: bytes) -> str:
        out: list[str] = []
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.held.append(byte)
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(self.held.decode("utf-8"))
                        self.held.clear()
                    continue
                out.append("\ufffd")
                self.__init__()
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.held.append(byte)
                self.need = 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("\ufffd")
        return "".join(out)

    def finish(self) -> str:
        rest = "\ufffd" if self.need else ""
        self.__init__()
        return rest


class Codec:
    """Encoder and decoder of one vocabulary.

    A match of the pattern holds white space only as one blank at its begin or as a run of it. A text can
    therefore be cut before each run of white space without changing a match. The different parts of a batch
    of texts are encoded together, and remembered up to a bound of bytes.
    """

    def __init__(self, path: str, pattern: str, memory: int = 1):
        self.fst = Transducer(load_ranks(path), MAX_STATES * memory)
        self.max_known = KNOWN_BYTES * memory
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0
        size = max(self.fst.tokens, default=-1) + 1
        self.bytes_of = [self.fst.tokens.get(i, b"") for i in range(size)]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Packed ids of each part; every different piece of them is encoded once."""
        found = [self.pattern.findall(part) for part in parts]
        numbers: dict[str, int] = {}
        which = [numbers.setdefault(piece, len(numbers)) for pieces in found for piece in pieces]
        pieces = [piece.encode("utf-8") for piece in numbers]
        short = [i for i, piece in enumerate(pieces) if len(piece) < LONG_PIECE]
        ids, counts = self.fst.encode_all([pieces[i] for i in short])
        packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        coded: list[bytes] = [b""] * len(pieces)
        for i, begin, end in zip(short, [0, *ends], ends, strict=False):
            coded[i] = packed[begin:end]
        for i, piece in enumerate(pieces):
            if len(piece) >= LONG_PIECE:
                coded[i] = np.array(self.fst.encode(piece), dtype="<u4").tobytes()
        at = iter(which)
        return [b"".join([coded[next(at)] for _ in pieces]) for pieces in found]

    def parts(self, text: str) -> list[str]:
        if _ODD_WHITE.search(text):
            return [text]
        if _WHITE_RUN.search(text):
            return _PARTS.findall(text)
        head, *rest = text.split(" ")
        return [head, *[" " + part for part in rest]]

    def encode_some(self, texts: list[str]) -> list[bytes]:
        parted = [self.parts(text) for text in texts]
        new = list({part for parts in parted for part in parts if part not in self.known})
        own = dict(zip(new, self.encode_parts(new), strict=True))
        found = self.known.get
        packed = [b"".join([own[part] if (ids := found(part)) is None else ids for part in parts]) for parts in parted]
        for part, ids in own.items():
            if len(part) <= 64:
                self.known[part] = ids
                self.known_bytes += ENTRY_BYTES + len(part) + len(ids)
        if self.known_bytes > self.max_known:
            self.known, self.known_bytes = {}, 0
        return packed

    def encode_many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Token ids of whole texts as little-endian unsigned 32-bit integers, a bounded number of characters at a time."""
        held, chars = [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= BATCH_CHARS:
                yield from self.encode_some(held)
                held, chars = [], 0
        yield from self.encode_some(held)

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text. Each match of the pattern is encoded on its own."""
        return np.frombuffer(self.encode_some([text])[0], dtype="<u4")

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text in parts; a character may be spread over several tokens and parts."""
        machine = Utf8Decoder()
        ids = np.asarray(ids)
        for begin in range(0, len(ids), SLICE_IDS):
            part = ids[begin : begin + SLICE_IDS].tolist()
            yield machine.feed(b"".join(map(self.bytes_of.__getitem__, part)))
        yield machine.finish()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary, built on first use."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _each(columns: Iterator[pa.Array], path: str, pattern: str, make, memory: int = 1) -> Iterator[pa.Array]:
    """Results of a task's columns. The codec goes with its task, as other work shares the worker's memory."""
    own = Codec(path, pattern, memory)
    try:
        for column in columns:
            yield make(own, own.encode_many(text.as_py() or "" for text in column))
    finally:
        del own
        release_memory()


def encode_ids(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text column as an array; NULL and empty texts give an empty array."""

    def arrays(_: Codec, coded: Iterator[bytes]) -> pa.Array:
        values = [np.frombuffer(packed, dtype="<i4") for packed in coded]
        ends = np.cumsum([0, *map(len, values)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, "<i4")])))

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _each(columns, path, pattern, arrays)

    return ids(F.coalesce(text.cast("string"), F.lit("")))


def decode_ids(ids: Column, path: str, pattern: str) -> Column:
    """Text of an array of token ids; NULL gives NULL, invalid UTF-8 gives U+FFFD."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([None if v is None else "".join(own.decode(v)) for v in column.to_pylist()], pa.string())

    return text(ids)


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", memory: int = 1) -> DataFrame:
    """Rows with the digests of their token ids and of the bytes decoded from them.

    Adds ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` in one struct column ``bpe``, replacing one of that name. Rows are never moved:
    the work is local to a row, and a text of any length is encoded in time linear in its length. NULL counts
    as empty.
    """

    def digested(own: Codec, coded: Iterator[bytes]) -> pa.Array:
        counts, encoded, decoded = [], [], []
        for packed in coded:
            counts.append(len(packed) // 4)
            encoded.append(hashlib.sha256(packed).hexdigest())
            back = hashlib.sha256()
            for part in own.decode(np.frombuffer(packed, dtype="<u4")):
                back.update(part.encode("utf-8"))
            decoded.append(back.hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _each(columns, path, pattern, digested, memory)

    return df.withColumn("bpe", digests(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
