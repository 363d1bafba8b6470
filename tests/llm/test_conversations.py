from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from snapledger.llm import conversations
from snapledger.llm.conversation_queries import damaged
from snapledger.llm.queries import QUERIES
from tests.llm import brute

CODES = {"s": 0, "u": 1, "a": 2, "x": 3}


def _codes(turns):
    return bytes(CODES[role] << 2 | fault for role, fault in turns)


@pytest.mark.parametrize("piece", [512, 3, 1])
def test_cheapest_edits(monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    r = random.Random(piece)
    for _ in range(1500):
        turns = [(r.choice("suasuax"), r.choice([0, 0, 0, 1, 2, 3])) for _ in range(r.randrange(7))]
        assert conversations.least_edits(_codes(turns)) == brute.cheapest_edits(turns)


def test_pieces_do_not_matter(monkeypatch):
    r = random.Random(2)
    codes = _codes([(r.choice("suax"), r.choice([0, 0, 1, 2, 3])) for _ in range(2000)])
    found = []
    for piece in (1, 7, 512, 4000):
        monkeypatch.setattr(conversations, "PIECE", piece)
        found.append(conversations.least_edits(codes))
    assert len(set(found)) == 1 and len(found[0][1].replace("I", "")) == 2000


def test_cheap_insertions_are_used(monkeypatch):
    """With other costs, turns are inserted, also at the end and twice in a row."""
    monkeypatch.setitem(conversations.COST, "I", 1)
    for cached in (conversations.edges, conversations.endings):
        cached.cache_clear()
    try:
        assert conversations.least_edits(_codes([("s", 0)])) == (2, "D")
        assert conversations.least_edits(_codes([("s", 0), ("u", 0)])) == (1, "KKI")
        assert conversations.least_edits(_codes([("s", 0), ("u", 0), ("a", 0), ("x", 1), ("s", 3)])) == (4, "KKKDD")
        assert conversations.least_edits(_codes([("u", 0), ("u", 0)])) == (1, "KR")
        assert conversations.least_edits(_codes([("a", 0)])) == (1, "IK")
    finally:
        monkeypatch.undo()
        for cached in (conversations.edges, conversations.endings):
            cached.cache_clear()


def _expected(rows):
    """From (conv_id, turn, role, text) before damage to the rows of the query."""
    groups = {}
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        turns = groups.setdefault(conv, [])
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        if fault:
            turns += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        faults, seen = [], set()
        for _, role, text in turns:
            bare = text.strip(brute.SPACES)
            faults.append(1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3)
            seen.add((role, text))
        cost, audit = brute.cheapest_edits([(t[1][:1], f) for t, f in zip(turns, faults, strict=True)])
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = zip(turns, turns[1:], strict=False)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        digest = hashlib.sha256("\n".join(brute.repaired([t[1:] for t in turns], audit)).encode()).hexdigest()
        yield (conv, gaps, *[faults.count(k) for k in (1, 2, 3)], illegal, cost, audit, digest, len(turns))


def test_conversation_repair_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op12_conversation_repair"](spark, tables).collect()
    assert sorted(map(tuple, found)) == sorted(_expected(rows))


def _odd_turns(spark, path):
    rows = [
        (None, 0, "user", "Hi."), (None, None, "user", "First."), (None, 1, "assistant", "So."), (1, None, None, None),
        (1, 5, "user", ""), (1, 9, "tool", "x."), (2, 0, "", "No role."), (2, 1, "user", "\x85"), (2, 2, "assistant", "ok ! \n"),
        *[(7, t, "user", "Again.") for t in range(12)], *[(8, 3, "assistant", "Same.")] * 4,
        *[(9, t, ("user", "assistant")[t % 2], "y " * 200_000 + "." * (t % 3)) for t in range(6)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "role AS _role", "turn AS _piece", "text AS `a.b`").repartition(3).write.parquet(path)
    return rows


def test_odd_conversations(spark, tmp_path):
    rows = _odd_turns(spark, f"{tmp_path}/conversations.parquet")
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(_expected(rows), key=repr)


def test_all_turns_dropped_and_no_turns(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    schema = "conv_id long, turn long, role string, text string"
    for name, rows in (("one", [(gone, 0, "user", "x.")]), ("none", [])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    (row,) = QUERIES["op12_conversation_repair"](spark, f"{tmp_path}/one").collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)
    assert QUERIES["op12_conversation_repair"](spark, f"{tmp_path}/none").collect() == []


def test_repaired_turns(spark, tables, monkeypatch):
    """The rows that stay, of all conversations, in order; also if conversations have many pieces."""
    monkeypatch.setattr(conversations, "PIECE", 2)
    turns = damaged(spark.read.parquet(f"{tables}/conversations.parquet"))
    report = {r.conv_id: r for r in conversations.repair_report(turns).collect()}
    kept = {}
    for r in conversations.repaired_turns(turns).collect():
        kept.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}", r.edit))
    assert report
    for conv, r in report.items():
        lines = sorted(kept.get(conv, []))
        assert [p for p, _, _ in lines] == list(range(len(lines)))
        assert [e for _, _, e in lines] == [e for e in r.audit if e != "D"]
        assert r.repaired_sha256 == hashlib.sha256("\n".join(t for _, t, _ in lines).encode()).hexdigest()


def test_a_long_conversation(spark):
    """More turns than a piece or an Arrow batch holds, with one text all over."""
    rows = [(1, t, ("user", "assistant")[t % 2], "Same." if t % 3 else f"{t}.") for t in range(25_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    (found,) = conversations.repair_report(turns).collect()
    faults, seen = [], set()
    for _, _, role, text in rows:
        faults.append(2 if (role, text) in seen else 0)
        seen.add((role, text))
    codes = _codes([(r[2][:1], f) for r, f in zip(rows, faults, strict=True)])
    assert (found.cost, found.audit) == conversations.least_edits(codes) and found.n_turns == 25_000
    assert (found.duplicate, found.gaps, found.illegal) == (faults.count(2), 0, 0)
