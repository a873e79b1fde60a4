"""Conversation repair against trying every edit."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from powerflow.llm import conversation

SCHEMA = "conv_id long, turn long, role string, text string"


def judged(rows):
    """Rows in order with their first fault."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    seen, out = set(), []
    for _, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        bare = text.strip(conversation.BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "none" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return not initials or bool(rest) and rest == "ua" * (len(rest) // 2) and len(rest) % 2 == 0


def best_repair(rows):
    """Every choice of edits with up to two inserts at each place."""
    rows = judged(rows)

    @cache
    def repairs(at, state):
        """All (cost, audit, turns) from a place on; the state is the initials so far without repetition."""
        found = []
        if at == len(rows):
            if legal(state):
                found.append((0, "", ()))
        else:
            _, role, text, fault = rows[at]
            more = int(fault == "truncated")
            options = [(3, "D", None)]
            if fault in ("none", "truncated"):
                options += [(more, "K", (role, text)), (2 + more, "R", ("user", text)), (2 + more, "R", ("assistant", text))]
            for cost, edit, turn in options:
                after = state if turn is None else shorter(state + (turn[0][:1] or "?"))
                if after is not None:
                    own = () if turn is None else (turn,)
                    found += [(cost + c, edit + a, own + t) for c, a, t in best(at + 1, after)]
        return found

    @cache
    def best(at, state):
        found = []
        for inserted in itertools.chain([()], itertools.product(("user", "assistant"), repeat=1), itertools.product(("user", "assistant"), repeat=2)):
            after = state
            for role in inserted:
                after = shorter(after + role[0]) if after is not None else None
            if after is not None:
                turns = tuple((role, "") for role in inserted)
                found += [(2 * len(inserted) + c, "I" * len(inserted) + a, turns + t) for c, a, t in repairs(at, after)]
        return [min(found)] if found else []

    cost, audit, turns = best(0, "")[0]
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def shorter(initials):
    """The same prefix with its repeated pairs left out; None if nothing legal begins so."""
    rest = initials[1:] if initials[:1] == "s" else initials
    if any(c != "ua"[i % 2] for i, c in enumerate(rest)):
        return None
    head = initials[: len(initials) - len(rest)]
    return head + rest[: 2 + len(rest) % 2] if len(rest) > 2 else initials


def found(df, **options):
    report = conversation.reports(conversation.edited_turns(df, **options))
    return {row["conv"]: row for row in report.collect()}


@pytest.mark.parametrize("block", [conversation.BLOCK_ROWS, 2])
def test_cheapest_repairs_match_brute_force(spark, block):
    rng = random.Random(block)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Ja.", "Nein!", "und", "", " \t", "Was? ", "a\x0b", None, "Gut.\n"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    got = found(spark.createDataFrame(rows, SCHEMA), block_rows=block)
    for conv in range(150):
        own = [r for r in rows if r[0] == conv]
        cost, audit, digest = best_repair(own)
        row = got[str(conv)]
        assert (row["cost"], row["audit"], row["repaired_sha256"]) == (cost, audit, digest), own
        faults = [r[3] for r in judged(own)]
        assert (row["blank"], row["duplicate"], row["truncated"]) == tuple(map(faults.count, conversation.FAULTS[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        assert row["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        initials = [r[1][:1] for r in judged(own)]
        assert row["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))


def test_repaired_turns_are_rows(spark):
    rows = [(7, 0, "user", "Wo?"), (7, 1, "user", "Hier."), (7, 2, "user", "Hier.")]
    turns = conversation.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()
    assert [(t["role"], t["text"], t["turn"], t["edit"]) for t in turns] == [
        ("user", "Wo?", 0, "K"), ("assistant", "Hier.", 1, "R"),
    ]


def test_giant_conversation_leaves_no_blocks(spark, tmp_path, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], f"Zeile {i}.") for i in range(5000)]
    rows.append((1, 5000, "user", "x" * 2_000_000))
    monkeypatch.setattr(conversation, "new_folder", lambda *_: str(tmp_path))
    row = found(spark.createDataFrame(rows, SCHEMA), block_rows=64)["1"]
    assert row["audit"] == "K" * 5000 + "D" and row["cost"] == 3 and row["truncated"] == 1
    assert not [p for p in tmp_path.rglob("edits-*")]


def test_dropped_rows_leave_their_conversation(spark):
    rows = [(1, 0, "user", "Ja.", "x", True), (2, 0, "user", "Ja.", "x", False), (None, None, None, None, "x", None)]
    df = spark.createDataFrame(rows, SCHEMA + ", conv string, gone_ boolean")
    got = found(df, gone=F.col("gone_"))
    assert set(got) == {"1", "2", None}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got["1"]["cost"], got["1"]["audit"], got["1"]["repaired_sha256"]) == (0, "", empty)
    assert got["2"]["audit"] == "KI"
    assert (got[None]["blank"], got[None]["audit"], got[None]["cost"]) == (1, "D", 3)


def test_empty_table_gives_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversation.reports(conversation.edited_turns(df)).collect() == []
    assert conversation.repair(df).collect() == []


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "Ein. Zwei! Drei?") for c in range(20) for t in (*range(10), None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("gone", F.lit("clash"))
    got = {}
    for r in conversation.with_damage(df).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["gone"], r["role"], r["text"]))
    for conv, turn, role, text in rows:
        part = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if part == 4 else role
        text = {1: "", 2: "Ein Zwei Drei"}.get(part, text)
        assert got[conv, turn] == [(part == 0, role, text)] * (2 if part == 3 else 1)
