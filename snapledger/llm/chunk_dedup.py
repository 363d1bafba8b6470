"""Substring dedup by content-defined chunking with a gear rolling hash.

A gear hash rolls over the bytes of a text; where it falls below a bound, a chunk begins. Boundaries depend on the
last ``GEAR_WINDOW`` bytes only, so an insertion changes the chunks around it and no others. Each chunk is hashed
together with the one after it, and digests found in more than one document are repeated. Neighbouring repeated
pairs of chunks form spans; spans of at least ``min_chars`` characters are reported, and removed everywhere but in the
document of the least id that holds them.

Digests are aggregated to two numbers before they are shuffled, so that a passage in a third of all documents costs
one row per task. Texts are not shuffled to find the spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import packed, row_key, unpacked
from snapledger.llm.wordhash import mix, segment_hashes
from snapledger.session import materialize

#: Bytes that a boundary depends on; the least and the largest size of a chunk in bytes.
GEAR_WINDOW = 8
LEAST = 4
LARGEST = 256
#: Bytes of text worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
#: The document number of rows without an id: they count as one document, the last.
_NO_ID = (1 << 63) - 1


def _gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the gears of the last bytes, each shifted by its distance."""
    rolled, width = _GEAR[data], 1
    while width < GEAR_WINDOW:
        shifted = np.zeros_like(rolled)
        shifted[width:] = rolled[:-width] << np.uint32(width)
        rolled = rolled + shifted
        width *= 2
    return rolled


def chunk_starts(data: np.ndarray, texts_at: np.ndarray, average: int) -> np.ndarray:
    """Where chunks begin in the bytes of UTF-8 texts given end to end; a text begins a chunk."""
    low = _gear(data) < np.uint32((1 << 32) // average)
    # Of boundaries closer than LEAST only the first counts; a local rule, so copies agree.
    begins = low.copy()
    for k in range(1, LEAST):
        begins[k:] &= ~low[:-k]
    starts = np.flatnonzero(begins[:-1]) + 1
    # A chunk begins with a whole character.
    for _ in range(3):
        inside = (data[np.minimum(starts, len(data) - 1)] & 0xC0) == 0x80
        starts = starts + inside
    first = texts_at[:-1][np.diff(texts_at) > 0]
    starts = np.unique(np.concatenate([starts[starts < len(data)], first]))
    gaps = np.diff(np.append(starts, len(data)))
    long = np.flatnonzero(gaps > LARGEST)
    if len(long):
        n = (gaps[long] - 1) // LARGEST
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        more = np.repeat(starts[long], n) + step * LARGEST
        for _ in range(3):
            more = more + ((data[np.minimum(more, len(data) - 1)] & 0xC0) == 0x80)
        starts = np.unique(np.concatenate([starts, more[more < len(data)]]))
    return starts


def _pairs(texts: pa.Array, average: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For slices of texts: of each chunk its text, digest with the next chunk, place in the text, and where
    the two begin and end in characters. The last chunk of a text is a pair by itself."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole, first = texts.buffers()[2], 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        begin, end = int(offsets[first]), int(offsets[last])
        if end > begin:
            data = np.frombuffer(whole, np.uint8, end - begin, begin)
            texts_at = offsets[first : last + 1] - begin
            starts = chunk_starts(data, texts_at, average)
            stops = np.append(starts[1:], len(data))
            text = np.searchsorted(texts_at, starts, side="right") - 1
            digest = segment_hashes(data, starts, stops)
            joined = np.append(text[1:] == text[:-1], False)
            pair = mix(digest + np.where(joined, mix(np.append(digest[1:], digest[:1])), np.uint64(1)))
            pair_stops = np.where(joined, np.append(stops[1:], 0), stops)
            chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            at = texts_at[text]
            number = np.arange(len(starts)) - np.searchsorted(starts, at)
            yield text + first, pair, number, chars[starts] - chars[at], chars[pair_stops] - chars[at]
        first = last


def _chunk_rows(docs: DataFrame, average: int, places: bool) -> DataFrame:
    """One row per pair of chunks: ``digest`` and ``doc``, or with their place also ``key``, ``number``, ``start``, ``end``."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_doc")
            for text, pair, number, start, end in _pairs(batch.column("_text"), average):
                taken = pa.array(text)
                digest = pa.array(pair.view(np.int64))
                if places:
                    integers = [pa.array(x.astype(np.int32)) for x in (number, start, end)]
                    columns = [digest, batch.column("_k1").take(taken), *integers]
                else:
                    columns = [digest, ids.take(taken)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["digest", "key", "number", "start", "end"] if places else ["digest", "doc"]
    schema = "digest long, key long, number int, start int, end int" if places else "digest long, doc long"
    return docs.select("_k1", "_doc", "_text").mapInArrow(chunked, schema)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    number = F.coalesce(ident.cast("long"), F.lit(_NO_ID))
    return docs.select(row_key(ident, text)[0], number.alias("_doc"), text.alias("_text"))


def _spans(ordered: Column, min_chars: int) -> Column:
    """Spans of consecutive pairs as an array of structs, empty if none is long enough.

    ``ordered`` is a column of the table, sorted by place: what a lambda names is computed for every element.
    """
    first = F.filter(ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)["number"] + 1 < x["number"]))
    last = F.filter(
        ordered, lambda x, i: F.coalesce(F.get(ordered, i + 1)["number"] > x["number"] + 1, F.lit(True))
    )
    spans = F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
    return F.filter(spans, lambda s: s["end"] - s["start"] >= min_chars)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", average: int = 20, min_chars: int = 170
) -> DataFrame:
    """One row per document that holds a repeated passage.

    Columns: ``id_col`` (long), ``repeated`` and ``removed`` (arrays of ``start`` and ``end``, in characters, end excluded),
    ``n_repeated`` and ``n_removed`` (characters in them), and ``key``, a hash of id and text.

    * A passage is repeated if it occurs in documents of different ids. ``removed`` spans are those also found in a
      document of a lesser id. Edges are those of chunks: up to some ``average`` bytes of a passage stay on either side.
    * Ids are whole numbers; rows without an id count as one document, the last. Equal rows give one result.
    * Null and empty texts have no chunks. Other columns are not read. An empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    documents = F.min("doc").alias("first"), F.max("doc").alias("_last")
    counted = _chunk_rows(keyed, average, places=False).groupBy("digest").agg(*documents).filter("first <> _last")
    repeated = materialize(counted.select("digest", "first"), "repeated-chunks")
    found = _chunk_rows(keyed, average, places=True).join(repeated, "digest")
    piece = F.struct("number", "start", "end", "first")
    lists = found.groupBy("key").agg(F.sort_array(F.collect_set(piece)).alias("_pieces"))
    ids = keyed.select(F.col("_k1").alias("key"), "_doc").distinct()
    # Spans of all repeated pairs first: most documents have none that is long enough.
    spans = lists.withColumn("repeated", _spans(F.col("_pieces"), min_chars)).filter(F.size("repeated") > 0)
    named = spans.join(ids, "key")
    later = named.withColumn("_later", F.filter(F.col("_pieces"), lambda p: p["first"] < F.col("_doc")))
    shaped = later.withColumn("removed", _spans(F.col("_later"), min_chars))

    def length(name: str) -> Column:
        return F.aggregate(name, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])

    return shaped.select(
        F.when(F.col("_doc") != _NO_ID, F.col("_doc")).alias(id_col),
        "repeated",
        "removed",
        length("repeated").alias("n_repeated"),
        length("removed").alias("n_removed"),
        "key",
    )


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every input row with the ``removed`` spans of ``repeated_spans`` taken out of its text, and ``n_removed``.

    Null text stays null. An input column ``n_removed`` is replaced.
    """
    spans = repeated_spans(docs, id_col, text_col, **options).select("key", "removed", "n_removed")
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(packed(docs, [text_col, "n_removed"]), row_key(ident, text)[0].alias("key"), text.alias("_text"))
    joined = rows.join(spans, "key", "left")
    ends = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["end"]))
    starts = F.concat(F.transform("removed", lambda s: s["start"]), F.array(F.length("_text")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(F.col("_text"), a + 1, b - a))
    cut = F.when(F.size("removed") > 0, F.array_join(kept, "")).otherwise(F.col("_text"))
    out = joined.select(*unpacked(joined), cut.alias(text_col), F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"))
    order = [c for c in docs.columns if c.lower() != "n_removed"]
    return out.select(*[f"`{c}`" for c in order], "n_removed")
