"""The registered query of benchmark decontamination; tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm.decontaminate import find_leaks
from snapledger.llm.registry import query, table


@query()
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a benchmark item, verbatim or with other numbers, names and units."""
    found = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_matched", "n_windows", "verbatim")
