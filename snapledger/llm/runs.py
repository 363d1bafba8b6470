"""Periodic runs of words: stretches that repeat a group of words several times in a row.

Recompression turns the words of a slice of documents into a run-length grammar: rounds replace blocks of one
symbol by a symbol with a count, and pairs of a left and a right symbol by one symbol, until one symbol is
left. Both choices depend on the symbols alone, so equal stretches are parsed alike but for their edges. How far two
places agree then follows from going up the grammar while parents are equal and down where they differ: a few
steps a level. Candidates come from a harmonic grid: for each period, one place in so many words that every run long
enough holds one. Nothing is approximate; each run is extended exactly, in both directions, by the grammar.

Documents are worked on where they lie, without a shuffle, in slices of a few MB; a longer document is a slice of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapledger.llm.common import sent, unpacked

#: Bytes of text whose grammar is built at a time.
SLICE_BYTES = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


class Grammar:
    """A run-length grammar of a sequence whose first and last symbol occur nowhere else.

    Nodes are numbered level by level: those below ``size`` are the symbols of the sequence itself. ``name`` says which
    nodes of a level stand for equal stretches. ``to_right`` and ``to_left`` count the equal neighbours of a node, itself
    included, in each direction.
    """

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        levels, names, base, round_number = [], symbols.astype(np.int64), 0, 0
        while True:
            block = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            lengths = np.diff(np.append(block, len(names)))
            index = np.arange(len(names)) - np.repeat(block, lengths)
            level = {"name": names, "to_left": index + 1, "to_right": np.repeat(lengths, lengths) - index}
            levels.append(level)
            if len(names) == 1:
                break
            if len(block) < len(names):
                heads, key = block, names[block] * (len(names) + 1) + lengths
            else:
                heads, key = _pairs(names, round_number)
                round_number += 1
            counts = np.diff(np.append(heads, len(names)))
            level["parent"] = np.repeat(np.arange(len(heads)), counts) + base + len(names)
            level["first"], level["last"] = np.zeros(len(names), bool), np.zeros(len(names), bool)
            level["first"][heads], level["last"][heads + counts - 1] = True, True
            children = (heads + base, heads + counts - 1 + base)
            base += len(names)
            names = pd.factorize(key)[0].astype(np.int64)
            level["children"] = children
        top = levels[-1]
        top["parent"], top["first"], top["last"] = np.array([base]), np.array([False]), np.array([False])
        # The leaves have no children; their own number keeps the arrays in step.
        leaves = np.arange(self.size)
        below = [(leaves, leaves), *[level["children"] for level in levels[:-1]]]
        flat = lambda parts: np.concatenate([*parts]).astype(np.int32)
        self.name = flat(level["name"] for level in levels)
        self.parent = flat(level["parent"] for level in levels)
        self.to_left, self.to_right = (flat(level[k] for level in levels) for k in ("to_left", "to_right"))
        self.first, self.last = (np.concatenate([level[k] for level in levels]) for k in ("first", "last"))
        self.first_child, self.last_child = flat(b[0] for b in below), flat(b[1] for b in below)

    def agreement(self, a: np.ndarray, b: np.ndarray, forward: bool = True) -> np.ndarray:
        """For pairs of different places, how many symbols from ``a`` on equal those from ``b`` on; or up to them."""
        edge, child = (self.first, self.first_child) if forward else (self.last, self.last_child)
        left, sign = (self.to_right, 1) if forward else (self.to_left, -1)
        x, y = a.astype(np.int64), b.astype(np.int64)
        found, active = x.copy(), np.arange(len(x))
        while len(active):
            up, other = self.parent[x], self.parent[y]
            rise = edge[x] & edge[y] & (self.name[up] == self.name[other])
            same = self.name[x] == self.name[y]
            ended = ~same & ~rise & (x < self.size)
            found[active[ended]] = x[ended]
            # A step passes all symbols that both blocks still have; unequal nodes give way to their children.
            step = sign * np.minimum(left[x], left[y])
            x = np.where(rise, up, np.where(same, x + step, child[x]))
            y = np.where(rise, other, np.where(same, y + step, child[y]))
            go_on = ~ended
            active, x, y = active[go_on], x[go_on], y[go_on]
        return sign * (found - a)


def _pairs(names: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs and single symbols begin, and what each is made of. Sides are drawn anew each round."""
    mixed = (names.astype(np.uint64) + np.uint64(number * 0x9E37 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    right = (mixed >> np.uint64(61)) & np.uint64(1) == 1
    joined = ~right[:-1] & right[1:]
    if not joined.any():
        # An unlucky draw; a pair alone must still shrink.
        right = ~right
        joined = ~right[:-1] & right[1:]
    heads = np.flatnonzero(np.append(True, ~joined))
    width = int(names.max()) + 2
    second = np.append(np.where(joined, names[1:] + 1, 0), 0)
    return heads, names[heads] * width + second[heads]


def runs_of(sequences: list[np.ndarray], min_words: int = 6, min_times: int = 4) -> tuple[np.ndarray, ...]:
    """All runs of several sequences of codes: sequence, start, length and period, in this order.

    A run is a stretch with smallest period q and at least ``min_times * q`` and ``min_words`` symbols that no neighbour
    extends.
    """
    sizes = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    none = np.zeros(0, np.int64)
    if longest < min_words:
        return none, none, none, none
    # Longer sequences first, each after a symbol of its own, so that the places for a period are a prefix.
    marks = max(int(s.max(initial=0)) for s in sequences) + 1 + np.arange(len(sequences) + 1)
    parts = [p for k, i in enumerate(order) for p in (marks[k : k + 1], sequences[i])]
    symbols = np.concatenate([*parts, marks[-1:]]).astype(np.int64)
    begins = np.cumsum(sizes[order] + 1) - sizes[order]
    ends = begins + sizes[order]
    places, periods = [], []
    for q in range(1, longest // min_times + 1):
        stop = int(ends[np.searchsorted(-sizes[order], -min_times * q, side="right") - 1])
        grid = (min_times - 1) * q
        hit = np.flatnonzero(symbols[: stop - q : grid] == symbols[q:stop:grid]) * grid
        if len(hit):
            # A run agrees with itself in more than one place in a row.
            near = (symbols[hit + 1] == symbols[hit + 1 + q]) | (symbols[hit - 1] == symbols[hit - 1 + q])
            hit = hit[near]
            places.append(hit)
            periods.append(np.full(len(hit), q))
    at = np.concatenate([*places, none])
    if not len(at):
        return none, none, none, none
    q = np.concatenate(periods)
    grammar = Grammar(symbols)
    length = grammar.agreement(at, at + q)
    back = grammar.agreement(at - 1, at - 1 + q, forward=False)
    start, length = at - back, length + back + q
    enough = length >= np.maximum(min_words, min_times * q)
    start, length, q = start[enough], length[enough], q[enough]
    # The same stretch has been found for multiples of its period, too, but for the smallest first.
    _, first = np.unique(start * (len(symbols) + 1) + length, return_index=True)
    start, length, q = start[first], length[first], q[first]
    place = np.searchsorted(begins, start, side="right") - 1
    sequence = order[place]
    start = start - begins[place]
    sort = np.lexsort((q, start, sequence))
    return sequence[sort], start[sort], length[sort], q[sort]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``SLICE_BYTES`` together."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        value = (text.as_py() or "").encode()
        if held and size + len(value) > SLICE_BYTES:
            yield first, held
            first, held, size = k, [], 0
        held.append(value)
        size += len(value)
    if held:
        yield first, held


def slice_runs(texts: list[bytes], min_words: int, min_times: int) -> tuple[list[int], pa.ListArray, list[bytes]]:
    """Numbers of words, runs and collapsed texts of a slice."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    sequence, start, length, period = runs_of(
        [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], min_words, min_times
    )
    # Words that a run drops: all after its first period, counted by where drops begin and end.
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, bounds[sequence] + start + period, 1)
    np.add.at(change, bounds[sequence] + start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    with_runs = set(sequence.tolist())
    collapsed = [
        b" ".join(compress(w, kept[bounds[k] : bounds[k + 1]]) if k in with_runs else w) for k, w in enumerate(words)
    ]
    stops = np.searchsorted(sequence, np.arange(len(texts) + 1)).astype(np.int32)
    fields = [pa.array(v, pa.int64()) for v in (start, length, period)]
    runs = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.StructArray.from_arrays(fields, RUN.names))
    return sizes.tolist(), runs, collapsed


def find_runs(
    docs: DataFrame, text_col: str = "text", min_words: int = 6, min_times: int = 4, keep: Sequence[str] | None = None
) -> DataFrame:
    """Every input row, or its columns ``keep``, with ``n_words``, ``runs`` and ``collapsed``.

    Words are stretches without ASCII white space, numbered from 0. ``runs`` holds a struct of ``start``, ``length`` and
    ``period`` for every run, by start, then period. ``collapsed`` is the text without the words that repeat others: words
    that some run holds after its first period go, the others are joined by one space.

    * Null, empty and white texts have no words, no runs (an empty array) and an empty collapsed text.
    * Input columns of the three names are replaced; repeated rows stay; an empty table stays empty.
    * ``min_times`` is 2 at least and ``min_words`` 3 at least; anything else is an error.
    """
    if min_times < 2 or min_words < 3:
        raise ValueError("a run has two periods and three words at least")
    added = ["n_words", "runs", "collapsed"]
    rows, texts_of = sent(docs, text_col, added, keep)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(texts_of(batch)):
                sizes, runs, collapsed = slice_runs(texts, min_words, min_times)
                columns = [
                    batch.column("_row").slice(first, len(texts)),
                    pa.array(sizes, pa.int64()),
                    runs,
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_row", *added])

    types = [T.LongType(), T.ArrayType(RUN), T.StringType()]
    fields = [T.StructField(n, t) for n, t in zip(added, types, strict=True)]
    out = rows.mapInArrow(found, T.StructType([rows.schema["_row"], *fields]))
    return out.select(*unpacked(out), *added)
