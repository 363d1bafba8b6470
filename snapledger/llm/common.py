"""What the operators share: text helpers, clash-free columns and stored intermediates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a class of a Java pattern.
SPACE_CLASS = r"[\x20\x09-\x0D]"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def row_key(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes of a row's values, as ``_k1`` and ``_k2``; nulls count as nothing."""
    marks = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    present = [c.isNull() for c in columns]
    return [
        F.xxhash64(*marks, *present).alias("_k1"),
        F.xxhash64(F.lit("second"), *present, *marks).alias("_k2"),
    ]


def packed(docs: DataFrame, replaced: Sequence[str]) -> Column:
    """All columns but ``replaced`` (in any case of letters) as one struct ``_row``.

    Operators work on ``_row`` beside columns of their own, so that no input name can clash
    with a working name; ``_row.*`` restores them.
    """
    gone = {c.lower() for c in replaced}
    kept = [docs[f"`{c}`"] for c in docs.columns if c.lower() not in gone]
    # A struct needs a field even if every input column is replaced.
    return F.struct(*(kept or [F.lit(None).cast("string").alias("_none")])).alias("_row")


def unpacked(df: DataFrame) -> list[Column]:
    return [F.col(f"_row.`{f.name}`") for f in df.schema["_row"].dataType.fields if f.name != "_none"]


def sent(
    docs: DataFrame, text_col: str, replaced: Sequence[str] = (), keep: Sequence[str] | None = None
) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """What a function over Arrow batches gets of ``docs``, and how it reads the texts from a batch.

    ``_row`` holds the columns that come back: those of ``keep``, or all, but ``replaced``. A text that comes back is read
    from there, so that it travels once; else it stands beside ``_row`` and does not come back.
    """
    gone = {c.lower() for c in replaced}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in gone]
    fields = [docs[f"`{c}`"].alias(c) for c in kept] or [F.lit(None).cast("string").alias("_none")]
    row = F.struct(*fields).alias("_row")
    place = next((k for k, c in enumerate(kept) if c.lower() == text_col.lower()), None)
    if place is None:
        return docs.select(row, F.col(f"`{text_col}`").alias("_text")), lambda batch: batch.column("_text")
    return docs.select(row), lambda batch: batch.column("_row").field(place)
