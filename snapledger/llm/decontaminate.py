"""Benchmark decontamination by templates.

Words become tokens: numbers, names and units are replaced by typed placeholders, other words are lower-cased and
lose the punctuation around them. A capitalised word that opens a sentence may be a name or not, so there are two templates:
one takes such words as they are, the other as names. Windows of ``WINDOW`` tokens of documents and benchmark items are hash-joined, as
templates and, to be sure of verbatim copies whatever their capitals, as plain words. Where a document
holds windows of an item in the same alignment, the fillers of the slots are checked: a name or unit of the
item must stand for one and the same filler throughout. Numbers may be anything: that is what a re-parameterised
question changes.

Documents send only windows to the join whose hash may be an item's, by a bitmap of a fixed number of bits; it is
the same for any number of items, and what it lets through in vain is dropped by the join. A passage
that very many documents hold is one key with many rows on the documents' side, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import packed, row_key, unpacked
from snapledger.llm.wordhash import Words, mix, segment_hashes, text_slices, windows
from snapledger.session import materialize

#: Tokens of a window; items of fewer tokens are one window.
WINDOW = 8
#: Bits of the bitmap of item windows, as a power of two.
BITMAP_BITS = 24
#: Percentage of an item's windows from which a document is contaminated.
LEAK_PERCENT = 50

#: Number words and units that become placeholders.
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    " nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm km kg mg lb lbs oz ml gb mb kb hz khz mhz ghz kwh meter meters metre metres kilometer kilometers kilometre"
    " kilometres centimeter centimeters centimetre centimetres inch inches foot feet yard yards mile miles gram grams"
    " kilogram kilograms pound pounds ounce ounces liter liters litre litres gallon gallons second seconds minute minutes"
    " hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees"
).split()

LITERAL, NUMBER, NAME, UNIT = range(4)

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_EDGE = np.zeros(256, bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    joined = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(segment_hashes(joined, ends - [len(w) for w in words], ends))


_NUMBERS, _UNITS = _word_hashes(NUMBER_WORDS), _word_hashes(UNIT_WORDS)
_PLACEHOLDERS = mix(np.arange(101, 105, dtype=np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Tokens:
    """Tokens of a slice of texts: hashes of plain words and of templates, types, and bounds per text."""

    def __init__(self, words: Words):
        data, starts, ends = words.data, words.starts.copy(), words.ends.copy()
        text = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
        # A word after the end of a sentence, or a text's first, may be capitalised without being a name.
        opening = np.ones(len(starts), bool)
        opening[1:] = _STOP[data[ends[:-1] - 1]] | (text[1:] != text[:-1])
        left = np.flatnonzero(_EDGE[data[starts]]) if len(starts) else starts
        while len(left):
            starts[left] += 1
            left = left[starts[left] < ends[left]]
            left = left[_EDGE[data[starts[left]]]]
        left = np.flatnonzero((ends > starts) & _EDGE[data[ends - 1]]) if len(starts) else starts
        while len(left):
            ends[left] -= 1
            left = left[_EDGE[data[ends[left] - 1]]]
        # A mark that stood alone passes its effect on the next word on.
        kept = np.flatnonzero(ends > starts)
        first_of = np.append(-1, kept[:-1]) + 1 if len(kept) else kept
        spans = np.maximum.reduceat(opening, first_of) if len(kept) else opening[:0]
        starts, ends, self.text = starts[kept], ends[kept], text[kept]
        self.starts, self.bounds = starts, np.searchsorted(self.text, np.arange(len(words.bounds)))
        self.plain = segment_hashes(_lowered(data), starts, ends)
        digits = np.append(0, np.cumsum(_DIGIT[data]))
        first = data[starts]
        self.kind = np.full(len(starts), LITERAL, np.int8)
        self.kind[(first >= 65) & (first <= 90) & ~spans] = NAME
        self.kind[_among(self.plain, _UNITS)] = UNIT
        self.kind[(digits[ends] > digits[starts]) | _among(self.plain, _NUMBERS)] = NUMBER
        # The second template's types: words that open a sentence are names, too.
        self.open_kind = np.where((first >= 65) & (first <= 90) & (self.kind == LITERAL), NAME, self.kind).astype(np.int8)

    def kinds(self, level: int) -> np.ndarray:
        return self.kind if level == 1 else self.open_kind

    def template(self, level: int) -> np.ndarray:
        kind = self.kinds(level)
        return np.where(kind == LITERAL, self.plain, _PLACEHOLDERS[kind])


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


#: Templates by their level: 0 is the plain window, 1 takes words that open a sentence as they are, 2 as names.
LEVELS = (1, 2)
#: A window has a template if at least one of so many tokens is literal; fillers decide on the others.
TOKENS_PER_LITERAL = 4


def _keys(tokens: Tokens, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all windows of a size, their first token, and the level of the key.

    A window with slots has a key for each template besides its plain one; the second only where it differs from the first.
    """
    plain, text, first = windows(tokens.plain, tokens.bounds, size)
    last = np.minimum(first + size, tokens.bounds[1:][text])
    keys, firsts, levels = [mix(plain + np.uint64(size))], [first], [np.zeros(len(plain), np.int8)]
    before = np.zeros(len(plain), np.int64)
    for level in LEVELS:
        template, _, _ = windows(tokens.template(level), tokens.bounds, size)
        slots = np.append(0, np.cumsum(tokens.kinds(level) != LITERAL))
        n = slots[last] - slots[first]
        slotted = np.flatnonzero((n > before) & (TOKENS_PER_LITERAL * (last - first - n) >= last - first))
        keys.append(mix(template[slotted] + np.uint64(size + 1000 * level)))
        firsts.append(first[slotted])
        levels.append(np.full(len(slotted), level, np.int8))
        before = n
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(levels)


def _slots(tokens: Tokens, first: np.ndarray, size: int, level: np.ndarray) -> pa.Array:
    """The fillers of names and units in template windows, in their order, as lists of hashes."""
    stop = tokens.bounds[1:][tokens.text[first]] if len(first) else first
    lengths, parts = np.zeros(len(first) + 1, np.int32), []
    for k in range(size):
        at = np.minimum(first + k, len(tokens.kind) - 1)
        kind = np.where(level == 2, tokens.open_kind[at], tokens.kind[at]) if len(at) else np.zeros(0, np.int8)
        use = (level > 0) & (first + k < stop) & ((kind == NAME) | (kind == UNIT))
        rows = np.flatnonzero(use)
        parts.append((rows, tokens.plain[at[rows]]))
        lengths[rows + 1] += 1
    rows = np.concatenate([r for r, _ in parts])
    values = np.concatenate([v for _, v in parts])[np.argsort(rows, kind="stable")]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(values.view(np.int64)))


_ROWS = "key long, owner long, place int, level byte, slots array<long>"


def _windows_of(rows: DataFrame, sizes: tuple[int, ...], bitmap: np.ndarray | None) -> DataFrame:
    """Windows of texts (``_k1``, ``_text``): key, owner, place of the first token, fillers of the slots.

    ``sizes`` are the sizes of windows taken; for items (no ``bitmap``) only whole items of fewer tokens than
    WINDOW have a smaller one, and ``n_windows`` and ``n_tokens`` are added.
    """
    items = bitmap is None
    shared = None if items else rows.sparkSession.sparkContext.broadcast(bitmap)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, words in text_slices(batch.column("_text"), lower=False):
                tokens = Tokens(words)
                for size in sizes:
                    keys, first, level = _keys(tokens, size)
                    counts = np.diff(tokens.bounds)[tokens.text[first]] if len(first) else first
                    if items:
                        # windows() takes a shorter text as one window of its own size.
                        keep = np.arange(len(keys))
                    else:
                        keep = np.flatnonzero(_has(shared.value, keys) & (counts >= size))
                    keys, first, level = keys[keep], first[keep], level[keep]
                    text = tokens.text[first]
                    columns = [
                        pa.array(keys.view(np.int64)),
                        batch.column("_k1").take(pa.array(text + begin)),
                        pa.array((first - tokens.bounds[text]).astype(np.int32)),
                        pa.array(level, pa.int8()),
                        _slots(tokens, first, size, level),
                    ]
                    if items:
                        n = counts[keep]
                        columns += [pa.array(np.maximum(n - size + 1, 1)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["key", "owner", "place", "level", "slots", "n_windows", "n_tokens"][: 7 if items else 5]
    schema = _ROWS + ", n_windows long, n_tokens long" if items else _ROWS
    return rows.select("_k1", "_text").mapInArrow(found, schema)


def _item_windows(items: DataFrame) -> DataFrame:
    """The windows of items; an item of fewer tokens than WINDOW is keyed by its own size."""
    long = _windows_of(items, (WINDOW,), None).filter(F.col("n_tokens") >= WINDOW)
    short = _windows_of(items, tuple(range(1, WINDOW)), None)
    # Of a short item the one window of exactly its size is taken.
    sized = short.filter((F.col("n_tokens") < WINDOW) & (F.col("n_windows") == 1) & (F.col("place") == 0))
    return long.unionByName(sized)


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bitmap(item_windows: DataFrame) -> np.ndarray:
    """The keys' low bits as a bitmap: at most 2 ** BITMAP_BITS / 32 small rows come to the driver, whatever the data."""
    low = F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(key & 31 as int))")
    words = item_windows.groupBy(F.shiftright(low, 5).alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 5), "<u4")
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = LEAK_PERCENT,
) -> DataFrame:
    """One row per document and benchmark item that it holds: ids, ``n_matched`` and ``n_windows`` of the item,
    ``verbatim`` (all matched windows agree as plain words), and ``_k1``, ``_k2``, hashes of the document's id and text.

    An item is held if at least ``percent`` of its windows occur in the document, counted over alignments
    in which every name and unit has one filler.

    * Null texts, and texts without tokens, match nothing. Items of fewer than WINDOW tokens must occur whole.
    * Repeated rows of documents or items give one row; equal texts of different ids one each. Null ids are
      kept as they are. Other columns are not read. Empty tables give no rows.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    item, item_text = F.col(f"`{item_id_col}`"), F.col(f"`{item_text_col}`")
    rows = docs.select(ident.alias("_id"), *row_key(ident, text), text.alias("_text"))
    items = benchmark.select(item.alias("_item"), row_key(item, item_text)[0], item_text.alias("_text")).distinct()
    known = materialize(_item_windows(items), "item-windows")
    sizes = [r[0] for r in known.select(F.least("n_tokens", F.lit(WINDOW))).distinct().collect()]
    if not sizes:
        sizes = [WINDOW]
    hits = _windows_of(rows, tuple(sorted(int(s) for s in sizes)), _bitmap(known))
    wanted = known.select(
        "key", F.col("owner").alias("_i"), F.col("place").alias("_ip"), F.col("slots").alias("_is"), "n_windows"
    )
    # Every template is judged by itself: the second one's fillers must not spoil what the first one finds.
    levels = F.when(F.col("level") == 2, F.array(F.lit(2))).otherwise(F.array(*map(F.lit, LEVELS)))
    joined = hits.join(wanted, "key").select(
        "owner", "_i", "n_windows", "_ip", (F.col("place") - F.col("_ip")).alias("_shift"),
        F.arrays_zip(F.col("_is").alias("a"), F.col("slots").alias("b")).alias("_pairs"), (F.col("level") > 0).alias("template"),
        F.explode(levels).alias("_by"),
    )
    aligned = joined.groupBy("owner", "_i", "n_windows", "_by", "_shift").agg(
        F.collect_set("_ip").alias("_places"),
        F.collect_set(F.when(~F.col("template"), F.col("_ip"))).alias("_same"),
        F.array_distinct(F.flatten(F.collect_set("_pairs"))).alias("_pairs"),
    )
    fillers = F.size(F.array_distinct(F.transform("_pairs", lambda p: p["a"])))
    steady = aligned.filter(fillers == F.size("_pairs"))
    held = steady.groupBy("owner", "_i", "n_windows", "_by").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("_places")))).cast("long").alias("n_matched"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_same")))).cast("long").alias("_n_same"),
    )
    # The template that matches more counts; of equal ones the first.
    best = F.max(F.struct("n_matched", (-F.col("_by")).alias("_by"), "_n_same")).alias("_best")
    held = held.groupBy("owner", "_i", "n_windows").agg(best).select("owner", "_i", "n_windows", "_best.n_matched", "_best._n_same")
    leaks = held.filter(100 * F.col("n_matched") >= percent * F.col("n_windows"))
    names = rows.select(F.col("_k1").alias("owner"), "_k2", "_id").distinct()
    item_names = items.select(F.col("_k1").alias("_i"), "_item")
    return leaks.join(names, "owner").join(item_names, "_i").select(
        F.col("_id").alias(id_col),
        F.col("_item").alias(item_id_col),
        "n_matched",
        "n_windows",
        (F.col("_n_same") == F.col("n_matched")).alias("verbatim"),
        F.col("owner").alias("_k1"),
        "_k2",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows without those that hold a benchmark item, with their columns."""
    keys = row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    leaks = find_leaks(docs, benchmark, id_col, text_col, **options).select("_k1", "_k2").distinct()
    clean = docs.select(packed(docs, []), *keys).join(leaks, ["_k1", "_k2"], "left_anti")
    return clean.select(*unpacked(clean))
