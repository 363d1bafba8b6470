"""Small literal tables with a declared column order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType | str
) -> DataFrame:
    """Rows given by name; the schema alone decides order and types (193 may fill a double)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    unknown = {name for row in rows for name in row} - set(names)
    if unknown:
        raise ValueError(f"columns not in the schema: {sorted(unknown)}")
    texts = [tuple(None if row.get(n) is None else str(row[n]) for n in names) for row in rows]
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.createDataFrame(texts, as_text).select(*typed)
