"""Sinks: every one is written by the executors, and takes the place of an earlier result only once it is whole.

Beside the rows lies a hidden file ``_manifest``: the columns, the number of rows and a checksum of their values, counted while
they were written. Readers pass over it; ``verified`` compares rows that were read back with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.clean import scaled_units, units_text
from snapledger.operators.ordering import with_position
from snapledger.session import remove_folder, replace_folder
from snapledger.sources.delimited import escape_breaks


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    escape_line_breaks: bool = False,
) -> None:
    """CSV with a header, quotes doubled inside quotes; null is an empty field and empty text a quoted one.

    Line breaks stand inside quotes, or as codes with ``escape_line_breaks``, so that every row is one line;
    ``read_typed`` reads both (``line_breaks="quoted"`` or ``"escaped"``).
    """
    if escape_line_breaks:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: escape_breaks(F.col(f"`{c}`")) for c in texts})

    def write(rows: DataFrame, target: str, how: str) -> None:
        writer = rows.write.mode(how).options(
            header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.csv(target)

    if mode == "overwrite":
        _replaced(df, path, write)
    else:
        write(df, path, mode)


def _replaced(df: DataFrame, path: str, write: Callable[[DataFrame, str, str], None]) -> None:
    """Write into a folder beside ``path`` and let it take that place at the end; a failure leaves what was there."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    seen = Observation(f"written-{uuid.uuid4().hex}")
    try:
        write(df.observe(seen, *_measures(df)), staged, "error")
        manifest = {"columns": df.columns, **seen.get}
        text = json.dumps(manifest)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{staged}/_manifest")
        replace_folder(spark, staged, path.rstrip("/"))
    finally:
        remove_folder(spark, staged)


def _measures(df: DataFrame) -> list[Column]:
    """The number of rows, and a checksum that does not depend on their order; repeated rows count as often as they are there."""
    hashed = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in df.columns])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.pmod(hashed, F.lit(1 << 31))), F.lit(0)).alias("checksum")]


def read_manifest(spark: SparkSession, path: str) -> dict:
    """``columns``, ``rows`` and ``checksum`` of what was written to ``path``."""
    return json.loads(spark.read.text(f"{path.rstrip('/')}/_manifest").first()[0])


def verified(df: DataFrame, path: str) -> DataFrame:
    """``df``, which was read from ``path`` with the types that it was written with; an error if any row is not as it was written."""
    manifest = read_manifest(df.sparkSession, path)
    rows = df.select(*[f"`{c}`" for c in manifest["columns"]])
    found = rows.agg(*_measures(rows)).first().asDict()
    wrong = [f"{n} {found[n]}, written {manifest[n]}" for n in found if found[n] != manifest[n]]
    if wrong:
        raise ValueError(f"{path}: {'; '.join(wrong)}")
    return df


def write_key_list(df: DataFrame, key: str, path: str, mode: str = "overwrite") -> None:
    write_csv(df.select(key), path, mode)


def write_csv_with_position(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column],
    name: str = "position",
    ties: bool = True,
) -> None:
    """CSV whose first column is the 0-based row number in the declared order."""
    numbered = with_position(df, order_by, name, ties)
    write_csv(numbered.select(name, *df.columns), path)


def fixed_decimal_lines(
    df: DataFrame, columns: Sequence[str], digits: int = 2, separator: str = " "
) -> DataFrame:
    """One text line per row, numbers with a fixed count of decimals as C prints them, ``nan`` for null."""
    # The units are a projection of their own, so that they are worked out once.
    numbers = [F.col(c).cast("double") for c in columns]
    scaled = df.select(
        *[x.alias(f"x{i}") for i, x in enumerate(numbers)], *[scaled_units(x, digits).alias(f"units{i}") for i, x in enumerate(numbers)]
    )
    texts = [units_text(F.col(f"x{i}"), F.col(f"units{i}"), digits) for i in range(len(columns))]
    return scaled.select(F.concat_ws(separator, *[F.coalesce(t, F.lit("nan")) for t in texts]).alias("value"))


def write_fixed_decimals(
    df: DataFrame, path: str, columns: Sequence[str], digits: int = 2, separator: str = " "
) -> None:
    lines = fixed_decimal_lines(df, columns, digits, separator)
    _replaced(lines, path, lambda rows, target, how: rows.write.mode(how).text(target))
