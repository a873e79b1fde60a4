"""Repair of the structure of conversations by one streaming pass in turn order.

Rows are dealt by conversation and sorted within their partition. Every row comes twice: first all rows of a
conversation from the last to the first, without their text, then all from the first to the last, with it. On
the way back a dynamic program over the states of the wanted order of roles keeps the cost of what follows;
each row leaves two bytes that say, for each state, the best edit. On the way forth these bytes decide row by
row. State is carried across Arrow batches, so a batch may begin or end anywhere; the two bytes a row are kept
in memory for a conversation of usual length and go to the shared folder, block by block, for a giant one.

The wanted order of role initials is ``(s?(ua)+)?``. Keeping a row costs 0, giving it the role that comes next
2, deleting it 3, an inserted empty turn 2, and a truncated row that stays 1 more. Blank rows and repeated rows
are always deleted. Of equally cheap repairs the one with the smallest string of edit initials is taken; edits
being ``D``, ``I``, ``K`` and ``R``, that string settles the repaired rows.

A conversation is one stream of one task, since its turns are decided in order and its digest is serial; sorting
spills, and a task holds a batch, two bytes a row up to a bound, and nothing that grows with a conversation's text.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from powerflow.llm.shared_files import new_folder, open_store

BLOCK_ROWS = 1 << 20  # edits of a conversation that are held before a block is written
OUT_ROWS = 4096
OUT_CHARS = 1 << 22

BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("none", "blank", "duplicate", "truncated")
GONE = len(FAULTS)  # marks a conversation's row that is no longer there

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_INITIALS = {"s": 0, "u": 1, "a": 2}
_KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})  # state -> initial -> state
_NEXT = (2, 2, 3, 2)  # state after the turn that comes next
_ROLE = ("user", "user", "assistant", "user")  # role of that turn
_TAIL = (0, 2, 1, 0)  # turns to insert at the end
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_NEVER = 1 << 30

OUT_SCHEMA = (
    "conv string, seq long, turn long, edit string, role string, text string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long"
)


def faults(role: Column, text: Column, nth: Column) -> Column:
    """Place in ``FAULTS`` of a row's first fault; ``nth`` counts rows with its role and text."""
    end = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    return (
        F.when(end == "", 1).when(nth > 1, 2).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    )


class _Edits:
    """Best edits over the states, as a machine that is built as rows reach it.

    Only differences of costs matter, so a state of the machine is the tuple of costs over the least one.
    """

    def __init__(self) -> None:
        self.known: dict[tuple, tuple] = {}

    def back(self, costs: tuple, initial: int, fault: int) -> tuple[int, tuple, int]:
        """What the least cost grows by, the costs before the row, and four bits an edit for each state."""
        key = (costs, initial, fault)
        if key not in self.known:
            self.known[key] = self._back(*key)
        return self.known[key]

    def _back(self, after: tuple, initial: int, fault: int) -> tuple[int, tuple, int]:
        must, more = fault in (1, 2), int(fault == 3)
        options = []  # without inserts, in the order of their initials
        for state in range(4):
            kept = _KEEP[state].get(initial)
            keep = _NEVER if must or kept is None else more + after[kept]
            rerole = _NEVER if must else 2 + more + after[_NEXT[state]]
            options.append((3 + after[state], keep, rerole))
        plain = [min(option) for option in options]
        best = [min(plain[s], 2 + plain[_NEXT[s]], 4 + plain[_NEXT[_NEXT[s]]]) for s in range(4)]
        packed = 0
        for state in range(4):
            at, inserts = state, 0
            while True:
                delete, keep, _ = options[at]
                if delete == best[at]:
                    edit = 0
                elif 2 + best[_NEXT[at]] == best[at]:
                    at, inserts = _NEXT[at], inserts + 1
                    continue
                else:
                    edit = 1 if keep == best[at] else 2
                break
            packed |= (inserts * 3 + edit) << 4 * state
        least = min(best)
        return least, tuple(cost - least for cost in best), packed


class _Backpointers:
    """Two bytes a row, written last to first and read first to last."""

    def __init__(self, folder: str, block: int) -> None:
        self.folder, self.block = folder, block
        self.held = array("H")
        self.blocks: list[str] = []

    def push(self, packed: int) -> None:
        self.held.append(packed)
        if len(self.held) >= self.block:
            store, path = open_store(self.folder)
            name = f"{path}/edits-{uuid.uuid4().hex}"
            with store.open_output_stream(name, compression=None) as out:
                out.write(self.held.tobytes())
            self.blocks.append(name)
            self.held = array("H")

    def pop(self) -> int:
        if not self.held:
            store, _ = open_store(self.folder)
            name = self.blocks.pop()
            with store.open_input_stream(name, compression=None) as source:
                self.held.frombytes(source.read())
            store.delete_file(name)
        return self.held.pop()


class _Repair:
    """State of one conversation."""

    def __init__(self, conv: str | None, edits: _Edits, folder: str, block: int) -> None:
        self.conv, self.edits = conv, edits
        self.costs, self.cost = tuple(2 * n for n in _TAIL), 0
        self.pointers = _Backpointers(folder, block)
        self.state = self.seq = self.illegal = self.turns = 0
        self.counts = [0] * len(FAULTS)
        self.last: int | None = None
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.total: int | None = None

    def back(self, initial: int, fault: int) -> None:
        if fault == GONE:
            return
        self.counts[fault] += 1
        more, self.costs, packed = self.edits.back(self.costs, initial, fault)
        self.cost += more
        self.pointers.push(packed)

    def insert(self) -> tuple:
        role = _ROLE[self.state]
        self.state = _NEXT[self.state]
        return self.row(None, "I", role, "")

    def row(self, turn: int | None, edit: str | None, role: str | None, text: str | None, counts: tuple = ()) -> tuple:
        self.seq += 1
        return (self.conv, self.seq - 1, turn, edit, role, text, *(counts or (None,) * 6))

    def forth(self, initial: int, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        if self.last is not None and (self.last, initial) not in _LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.total is None:
            self.total = self.cost + self.costs[0]
        inserts, edit = divmod(self.pointers.pop() >> 4 * self.state & 15, 3)
        for _ in range(inserts):
            yield self.insert()
        if edit == 0:
            yield self.row(turn, "D", role, text)
        elif edit == 1:
            self.state = _KEEP[self.state][initial]
            yield self.row(turn, "K", role, text)
        else:
            role = _ROLE[self.state]
            self.state = _NEXT[self.state]
            yield self.row(turn, "R", role, text)

    def end(self) -> Iterator[tuple]:
        for _ in range(_TAIL[self.state]):
            yield self.insert()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        yield self.row(None, None, None, None, (gaps, *self.counts[1:], self.illegal, self.total or 0))


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Frames of bounded numbers of rows and characters."""
    names = [field.split()[0] for field in OUT_SCHEMA.split(", ")]

    def frame(held: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(held, columns=names)
        whole = ["seq", "turn", *names[6:]]
        return out.astype({name: "Int64" for name in whole})

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[5] or "")
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield frame(held)
            held, chars = [], 0
    if held:
        yield frame(held)


def _stream(folder: str, block: int):
    def repaired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            edits, own = _Edits(), None
            for frame in frames:
                columns = (frame[c].tolist() for c in ("conv", "forth", "initial", "fault", "dated", "turn", "role", "text"))
                for conv, forth, initial, fault, dated, turn, role, text in zip(*columns, strict=True):
                    if own is None or own.conv != conv:
                        if own is not None:
                            yield from own.end()
                        own = _Repair(conv, edits, folder, block)
                    if forth:
                        yield from own.forth(initial, turn if dated else None, role, text)
                    else:
                        own.back(initial, fault)
            if own is not None:
                yield from own.end()

        yield from _frames(rows())

    return repaired


def edited_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    gone: Column | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every edit of every conversation, in order within its partition, and one closing row a conversation.

    Edits carry ``conv`` (the id as text), ``seq``, ``turn``, ``edit``, ``role`` and ``text`` as repaired; deleted
    rows keep theirs. The closing row has no ``edit`` and carries the counts: ``gaps`` in the turns, rows by first
    fault, ``illegal`` neighbours and the ``cost``. Rows for which ``gone`` holds only say that their conversation
    exists. Rows go by turn, NULL first, then role and text; of equal rows all but the first are repeated. NULL role
    or text counts as one space, a NULL id is a conversation of its own. Other columns are left out.
    """
    folder = new_folder(df.sparkSession, "conversations")
    gone = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
    rows = df.select(
        F.col(f"`{conv_col}`").cast("string").alias("conv"), gone.alias("gone"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
    ).repartition("conv")
    by_turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv", "gone", "role", "text").orderBy(by_turn)
    order = Window.partitionBy("conv", "gone").orderBy(by_turn, "role", "text", "nth")
    rows = rows.withColumn("nth", F.row_number().over(same)).withColumn("place", F.row_number().over(order))
    initial = F.left("role", F.lit(1))
    code = F.lit(len(_INITIALS))
    for letter, number in _INITIALS.items():
        code = F.when(initial == letter, number).otherwise(code)
    fault = F.when(F.col("gone"), GONE).otherwise(faults(F.col("role"), F.col("text"), F.col("nth")))
    nothing = F.lit(None).cast("string")

    def record(forth: bool) -> Column:
        return F.struct(
            F.lit(forth).alias("forth"), (F.col("place") if forth else -F.col("place")).alias("at"),
            (F.col("role") if forth else nothing).alias("role"), (F.col("text") if forth else nothing).alias("text"),
        )

    both = F.when(F.col("gone"), F.array(record(False))).otherwise(F.array(record(False), record(True)))
    stream = rows.select(
        "conv", code.alias("initial"), fault.alias("fault"), F.col("turn").isNotNull().alias("dated"),
        F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), F.explode(both).alias("r"),
    ).select("conv", "initial", "fault", "dated", "turn", "r.*")
    ordered = stream.sortWithinPartitions(F.col("conv").asc_nulls_first(), "forth", "at")
    return ordered.mapInPandas(_stream(folder, block_rows), OUT_SCHEMA)


def repair(df: DataFrame, **options) -> DataFrame:
    """The repaired turns: ``conv``, ``seq`` and the original ``turn`` (NULL where inserted), ``role``, ``text``, ``edit``."""
    turns = edited_turns(df, **options).filter(F.col("edit").isin("K", "R", "I"))
    return turns.select("conv", "seq", "turn", "role", "text", "edit")


REPORT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in REPORT.split(", ")]
    audit: list[str] = []
    digest, any_row = hashlib.sha256(), False
    for frame in frames:
        held = []
        columns = (frame[c].tolist() for c in ("conv", "edit", "role", "text", *names[1:7]))
        for conv, edit, role, text, *counts in zip(*columns, strict=True):
            if edit is None:
                held.append((conv, *map(int, counts), "".join(audit), digest.hexdigest()))
                audit, digest, any_row = [], hashlib.sha256(), False
                continue
            audit.append(edit)
            if edit != "D":
                digest.update(b"\n" * any_row)
                digest.update(f"{role}:{text}".encode())
                any_row = True
        if held:
            yield pd.DataFrame(held, columns=names)


def reports(edited: DataFrame) -> DataFrame:
    """One row a conversation: its counts, the ``audit`` of edit initials and a digest of the repaired turns.

    Takes the rows of :func:`edited_turns` in their order, without a shuffle.
    """
    return edited.mapInPandas(_reports, REPORT)


def with_damage(df: DataFrame, parts: int = 20) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn``: dropped, emptied, without sentence ends, repeated, of role user.

    Dropped rows stay with ``gone`` set, so that a conversation without rows is still known.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    part = F.crc32(name.cast("binary")) % parts
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    damaged = df.select(
        "conv_id", "turn", (part == 0).alias("gone"),
        F.when(part == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(part == 1, "").when(part == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(part == 3, 2).otherwise(1).alias("copies"),
    )
    return damaged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")
