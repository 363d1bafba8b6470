"""Repair of conversation structure at least cost, the edits decided by shortest paths of whole numbers.

A conversation in order should read as an optional system turn followed by pairs of a user and an assistant turn.
Each turn is kept, given another role, or deleted, and turns may be inserted. All ways to do so are paths
through a layered graph: a layer for each turn, a node for each state of the wanted pattern. An edge carries one whole
number. Its high digits are the cost; its low digits are those of the turn's place, where the letters of the edits at
this turn stand in a fixed width, filled up with zeros at their end. No such group of letters begins another one, so the least
sum is the least cost and, of equal costs, the ASCII-least letters. One pass of integer minima decides everything, and the
letters are read off the digits of the result.

Long conversations are worked on in pieces of ``PIECE`` turns, so that numbers stay short: from piece to piece go the cost to
each state and the rank of the letters that led there, which is a digit above the letters of the next piece. For
each piece and state the letters and the state that they come from are kept, and a pass from the last piece to the first
picks those of the best path. Turns stream through tasks in order; no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapledger.llm.common import SPACES, row_key
from snapledger.session import materialize

#: Costs of edits, and what an undeleted truncated turn adds.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5

#: Turns of a piece.
PIECE = 512

#: Roles by the code of their first letter; any other is the last code.
ROLES = ("system", "user", "assistant")
OTHER = 3
#: Faults by their code.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)

#: Letters in ASCII order are digits in this order, three bits each.
LETTERS = "DIKR"
BITS = 3
#: At most two turns are inserted before a turn: a third only repeats a state that a cheaper path has.
WIDTH = 3

#: States: nothing yet, after system, after user, after assistant. Where each role leads, by its code.
STATES = 4
NEXT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
ACCEPTED = (0, 3)


def _insertions(state: int) -> list[tuple[str, int]]:
    """The insertions that may come before a turn, with the state after them."""
    found = [("", state)]
    for _ in range(WIDTH - 1):
        letters, at = found[-1]
        found.append((letters + "I", 3 if at == 2 else 2))
    return found


def _number(letters: str, cost: int) -> int:
    """Letters in a group's fixed width, below the cost."""
    digits = 0
    for k in range(WIDTH):
        digits = digits << BITS | (LETTERS.index(letters[k]) + 1 if k < len(letters) else 0)
    return cost << WIDTH * BITS | digits


@cache
def edges(code: int) -> list[tuple[int, int, int, int]]:
    """For a turn of role and fault ``code``: from state, to state, cost and digits of the best edge."""
    role, fault = code >> 2, code & 3
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    best: dict[tuple[int, int], int] = {}

    def offer(a: int, b: int, letters: str, cost: int) -> None:
        number = _number(letters, cost + COST["I"] * letters.count("I"))
        best[a, b] = min(best.get((a, b), number), number)

    for a in range(STATES):
        for inserted, at in _insertions(a):
            offer(a, at, inserted + "D", COST["D"])
            if fault in (BLANK, DUPLICATE):
                continue
            if (at, role) in NEXT:
                offer(a, NEXT[at, role], inserted + "K", COST["K"] + more)
            offer(a, 3 if at == 2 else 2, inserted + "R", COST["R"] + more)
    mask = (1 << WIDTH * BITS) - 1
    return [(a, b, n >> WIDTH * BITS, n & mask) for (a, b), n in best.items()]


@cache
def endings() -> list[tuple[int, int, int, int]]:
    """What may follow the last turn: from state, to state, cost and digits."""
    offers = [(a, at, len(t) * COST["I"], _number(t, 0)) for a in range(STATES) for t, at in _insertions(a)]
    return [o for o in offers if o[1] in ACCEPTED]


def _layers(codes: bytes, last: bool) -> list[list[tuple[int, int, int, int]]]:
    layers = [edges(c) for c in codes]
    return [*layers, endings()] if last else layers


def step(weights: list[int | None], codes: bytes, last: bool) -> tuple[list[int | None], list[tuple[int, str] | None]]:
    """Integer minima over one piece.

    ``weights`` are those of the states before it: cost and, as two low bits, the rank of the letters so far. Returned are those
    after it, and for each state which one its best path came from and the letters of that path within the piece.
    """
    layers = _layers(codes, last)
    low = WIDTH * BITS * len(layers)
    # Above the letters: two bits of the rank, two of the state at the beginning, which the rank decides; then the cost.
    cost_at = low + 4
    now: list[int | None] = [
        None if w is None else (w >> 2) << cost_at | (w & 3) << low + 2 | p << low for p, w in enumerate(weights)
    ]
    for k, layer in enumerate(layers):
        at = low - WIDTH * BITS * (k + 1)
        after: list[int | None] = [None] * STATES
        for a, b, cost, digits in layer:
            before = now[a]
            if before is not None:
                total = before + (cost << cost_at) + (digits << at)
                other = after[b]
                if other is None or total < other:
                    after[b] = total
        now = after
    below = (1 << cost_at) - 1
    order = sorted({n & below for n in now if n is not None})
    weights_after = [None if n is None else (n >> cost_at) << 2 | order.index(n & below) for n in now]
    chosen = [None if n is None else ((n >> low) & 3, _letters(n & (1 << low) - 1)) for n in now]
    return weights_after, chosen


#: An octal digit is a letter; zeros only fill up.
_DIGITS = {ord("0"): None} | {ord(str(i)): letter for i, letter in enumerate(LETTERS, 1)}


def _letters(digits: int) -> str:
    return oct(digits)[2:].translate(_DIGITS)


def least_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the best repair of a conversation that is given as codes of roles and faults."""
    weights: list[int | None] = [0, None, None, None]
    kept = []
    pieces = range(0, max(1, len(codes)), PIECE)
    for at in pieces:
        weights, chosen = step(weights, codes[at : at + PIECE], at == pieces[-1])
        kept.append(chosen)
    state = best_end(weights)
    cost, letters = weights[state] >> 2, []
    for chosen in reversed(kept):
        state, text = chosen[state]
        letters.append(text)
    return cost, "".join(reversed(letters))


def best_end(weights: list[int | None]) -> int:
    """The accepted state of the least weight."""
    return min((w, p) for p, w in enumerate(weights) if w is not None and p in ACCEPTED)[1]


def _light(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns without their texts: key, place, hashes, and the code of role and fault before duplicates are known."""
    said, who = F.col(f"`{text}`"), F.col(f"`{role}`")
    bare = F.btrim(said, F.lit(SPACES))
    fault = (
        F.when(F.coalesce(bare, F.lit("")) == "", BLANK)
        .when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE)
        .otherwise(TRUNCATED)
    )
    initial = F.left(who, F.lit(1))
    code = F.lit(OTHER)
    for k, name in enumerate(ROLES):
        code = F.when(initial == name[0], k).otherwise(code)
    keyed = turns.select(*_place(conv, turn, role), said.alias("_text"), fault.alias("_fault"), code.alias("_role_code"))
    k1, k2 = row_key(F.col("_conv"), F.col("_role"), F.col("_text"))
    return keyed.select("*", k1, k2).drop("_text")


def _place(conv: str, turn: str, role: str) -> list[Column]:
    c1, c2 = row_key(F.col(f"`{conv}`"))
    return [
        F.col(f"`{conv}`").alias("_conv"),
        c1.alias("_c1"),
        c2.alias("_c2"),
        F.col(f"`{turn}`").cast("long").alias("_turn"),
        F.col(f"`{role}`").alias("_role"),
    ]


#: Turns in order: by turn, those without one first; ties by role, then by a hash of conversation, role and text.
ORDER = ["_c1", "_c2", "_turn", "_role", "_k1", "_k2"]

_COUNTERS = ["n_turns", "gaps", "blank", "duplicate", "truncated", "illegal"]
_OPTION = T.ArrayType(T.StructType([T.StructField("origin", T.IntegerType()), T.StructField("letters", T.StringType())]))


class _Open:
    """A conversation whose turns are still coming."""

    def __init__(self, conv, c1: int, c2: int):
        self.key = (conv, c1, c2)
        self.weights: list[int | None] = [0, None, None, None]
        self.codes = bytearray()
        self.piece = 0
        self.counts = dict.fromkeys(_COUNTERS, 0)
        self.first_turn = self.last_turn = None
        self.distinct = 0
        self.last_role = None
        self.last_said = None


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to pieces: the options of each, and with the last one the counts and the state it ends in."""
    out: list[tuple] = []
    conversation: _Open | None = None

    def close(last: bool) -> None:
        c = conversation
        c.weights, chosen = step(c.weights, bytes(c.codes), last)
        end, counts = None, None
        if last:
            end = best_end(c.weights)
            counts = c.counts | {"cost": c.weights[end] >> 2}
            if c.first_turn is not None:
                counts["gaps"] = c.last_turn - c.first_turn + 1 - c.distinct
        options = [None if x is None else {"origin": x[0], "letters": x[1]} for x in chosen]
        out.append((*c.key, c.piece, options, end, counts))
        c.codes.clear()
        c.piece += 1

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("_conv", "_c1", "_c2", "_turn", "_k1", "_k2", "_fault", "_role_code", "_again")]
        for conv, c1, c2, turn, k1, k2, fault, role, again in zip(*columns, strict=True):
            if conversation is None or conversation.key[1:] != (c1, c2):
                if conversation is not None:
                    close(True)
                conversation = _Open(conv, c1, c2)
            c = conversation
            if len(c.codes) == PIECE:
                close(False)
            if fault != BLANK and (again or c.last_said == (turn, k1, k2)):
                fault = DUPLICATE
            counts = c.counts
            counts["n_turns"] += 1
            if fault != FINE:
                counts[("", "blank", "duplicate", "truncated")[fault]] += 1
            if c.last_role is not None and (c.last_role, role) not in _LEGAL:
                counts["illegal"] += 1
            if turn is not None and turn != c.last_turn:
                c.distinct += 1
                c.first_turn = turn if c.first_turn is None else c.first_turn
                c.last_turn = turn
            c.last_role, c.last_said = role, (turn, k1, k2)
            c.codes.append(role << 2 | fault)
        if len(out) >= 1000:
            yield _batch(out)
            out.clear()
    if conversation is not None:
        close(True)
    if out:
        yield _batch(out)


_COUNTS_TYPE = pa.struct([(n, pa.int64()) for n in [*_COUNTERS, "cost"]])
_OPTION_TYPE = pa.list_(pa.struct([("origin", pa.int32()), ("letters", pa.string())]))
_PIECE_NAMES = ["_c1", "_c2", "_piece", "_options", "_end", "_counts"]


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), _OPTION_TYPE, pa.int32(), _COUNTS_TYPE]
    values = list(zip(*[p[1:] for p in pieces], strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(values, types, strict=True)], _PIECE_NAMES)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from the last to the first: the letters of the best path."""
    state = None
    for batch in batches:
        rows = batch.to_pylist()
        letters = []
        for r in rows:
            state = r["_end"] if r["_end"] is not None else state
            state, text = r["_options"][state].values()
            letters.append(text)
        chosen = [*[batch.column(n) for n in ("_c1", "_c2", "_piece")], pa.array(letters, pa.string()), batch.column("_counts")]
        yield pa.RecordBatch.from_arrays(chosen, ["_c1", "_c2", "_piece", "_letters", "_counts"])


def plan_repairs(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The best edits of every conversation, in pieces: ``_c1``, ``_c2`` (its key hashed), ``_piece``, ``_letters``, ``_counts``."""
    light = _light(turns, conv, turn, role, text)
    same = light.groupBy("_k1", "_k2").agg(
        F.min("_turn").alias("_least"), F.max("_turn").alias("_most"), F.max(F.col("_turn").isNull()).alias("_none")
    )
    # Few texts come again in another turn of their conversation. Stored, so that a join can split their many rows.
    several = same.filter((F.col("_least") < F.col("_most")) | (F.col("_none") & F.col("_most").isNotNull()))
    several = materialize(several.select("_k1", "_k2", "_least", "_none"), "repeated")
    later = F.coalesce(F.when(F.col("_none"), F.col("_turn").isNotNull()).otherwise(F.col("_turn") > F.col("_least")), F.lit(False))
    marked = light.join(several, ["_k1", "_k2"], "left").withColumn("_again", later)
    columns = [*ORDER, "_conv", "_fault", "_role_code", "_again"]
    # All turns of a conversation pass through one task in order, since each decision depends on those before it.
    ordered = marked.select(*columns).repartition("_c1", "_c2").sortWithinPartitions(*ORDER)
    counts = T.StructType([T.StructField(n, T.LongType()) for n in [*_COUNTERS, "cost"]])
    key = [T.StructField(n, T.LongType()) for n in ("_c1", "_c2", "_piece")]
    end = T.StructField("_end", T.IntegerType())
    pieces = ordered.mapInArrow(_forward, T.StructType([*key, T.StructField("_options", _OPTION), end, T.StructField("_counts", counts)]))
    # The same partitions hold the pieces, but in the other order.
    pieces = pieces.repartition("_c1", "_c2").sortWithinPartitions("_c1", "_c2", F.desc("_piece"))
    return pieces.mapInArrow(
        _backward, T.StructType([*key, T.StructField("_letters", T.StringType()), T.StructField("_counts", counts)])
    )


class _Edits:
    """The edits of one conversation, applied to its turns as they come. The letters are a few bytes a turn."""

    def __init__(self, conv):
        self.conv, self.letters, self.at, self.state = conv, "", 0, 0
        self.counts: dict | None = None

    def _inserted(self) -> Iterator[tuple]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = 3 if self.state == 2 else 2
            yield self.conv, None, ROLES[self.state - 1], "", "I"

    def turn(self, turn, role: str | None, text: str | None) -> Iterator[tuple]:
        """Conversation, turn, role, text and edit of each turn that takes the place of one."""
        yield from self._inserted()
        edit = self.letters[self.at]
        self.at += 1
        if edit == "K":
            code = next((k for k, name in enumerate(ROLES) if (role or "")[:1] == name[0]), OTHER)
            self.state = NEXT[self.state, code]
        elif edit == "R":
            self.state = 3 if self.state == 2 else 2
            role = ROLES[self.state - 1]
        yield self.conv, turn, role, text, edit

    def end(self) -> Iterator[tuple]:
        yield from self._inserted()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[_Edits | tuple]:
    """For every conversation its turns after the edits, the deleted ones with a ``D``, and at its end the edits."""
    edits, key = None, None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in _EVENT]
        for conv, c1, c2, turn, role, said, letters, counts in zip(*columns, strict=True):
            if key != (c1, c2):
                if edits is not None:
                    yield from edits.end()
                    yield edits
                edits, key = _Edits(conv), (c1, c2)
            if letters is not None:
                # A conversation's pieces stand before its turns.
                edits.letters += letters
                edits.counts = counts or edits.counts
            else:
                edits.conv = conv
                yield from edits.turn(turn, role, said)
    if edits is not None:
        yield from edits.end()
        yield edits


_EVENT = ["_conv", "_c1", "_c2", "_turn", "_role", "_said", "_letters", "_counts"]


def _events(turns: DataFrame, plan: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The pieces of every conversation and then its turns, in order, each conversation within one partition.

    This is the only shuffle of texts.
    """
    said = turns.select(*_place(conv, turn, role), F.col(f"`{text}`").alias("_said"))
    k1, k2 = row_key(F.col("_conv"), F.col("_role"), F.col("_said"))
    said = said.select("*", k1, k2, F.lit(None).cast("long").alias("_piece"))
    both = said.unionByName(plan, allowMissingColumns=True)
    ordered = both.repartition("_c1", "_c2").sortWithinPartitions("_c1", "_c2", F.col("_piece").asc_nulls_last(), *ORDER[2:])
    return ordered.select(*_EVENT)


def repaired_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns of all conversations after the cheapest edits: the four columns, ``place`` from 0 on, and ``edit``.

    ``edit`` is ``K`` (kept), ``R`` (another role) or ``I`` (inserted, without a turn number and with empty text). Deleted
    turns are missing. Rows of a conversation stand together and in order.

    * Turns of one conversation are ordered by number, those without one first; ties by role, then a hash of the text.
    * A null or empty role, or one that begins with another letter than s, u or a, cannot be kept. Null text is blank.
    * A null conversation key is a conversation. Repeated rows are duplicates. An empty table has no turns.
    * Other input columns do not come back: an inserted turn could not have them.
    """
    events = _events(turns, plan_repairs(turns, conv, turn, role, text), conv, turn, role, text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        for x in _edited(batches):
            if isinstance(x, _Edits):
                place = 0
            elif x[4] != "D":
                held.append((*x, place))
                place += 1
            if len(held) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema=schema)

    kind = turns.schema[conv].dataType
    fields = [(conv, kind), (turn, T.LongType()), (role, T.StringType()), (text, T.StringType()), ("edit", T.StringType()), ("place", T.LongType())]
    out = T.StructType([T.StructField(n, t) for n, t in fields])
    schema = to_arrow_schema(out)
    return events.mapInArrow(rows, out)


def repair_report(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its key, counts of turns and faults, ``cost``, ``audit`` and ``repaired_sha256``.

    ``gaps`` are turn numbers that are missing between the least and the greatest. ``illegal`` counts neighbours whose roles
    don't follow each other. ``audit`` holds the letters of all edits in order, deletions included. The digest is of
    the lines ``role:text`` of the repaired turns, joined by line feeds; null counts as empty text. Orders, nulls and ties are
    as in ``repaired_turns``. A digest runs over a conversation in order, so one task reads each conversation, as a stream.
    """
    events = _events(turns, plan_repairs(turns, conv, turn, role, text), conv, turn, role, text)
    counts = [*_COUNTERS, "cost"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, between = [], hashlib.sha256(), b""
        for x in _edited(batches):
            if isinstance(x, _Edits):
                held.append({conv: x.conv, **x.counts, "audit": x.letters, "repaired_sha256": digest.hexdigest()})
                digest, between = hashlib.sha256(), b""
            elif x[4] != "D":
                digest.update(between + f"{x[2] or ''}:{x[3] or ''}".encode())
                between = b"\n"
            if len(held) >= 1000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    fields = [(conv, turns.schema[conv].dataType), *[(n, T.LongType()) for n in counts], ("audit", T.StringType()), ("repaired_sha256", T.StringType())]
    out = T.StructType([T.StructField(n, t) for n, t in fields])
    schema = to_arrow_schema(out)
    return events.mapInArrow(rows, out)
