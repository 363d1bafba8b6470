"""The registered query of the licence scan; tested on held-out paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.license_scan import scan_licenses
from snapledger.llm.registry import query, table


@query()
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence families that documents state, with the template that confirms each."""
    found = scan_licenses(table(spark, folder, "documents"))
    rounded = {c: F.round(c, 4) for c in ("probability", "cover")}
    return found.withColumns(rounded)
