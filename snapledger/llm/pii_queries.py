"""The registered query of personal data; tested against the patterns run plainly and on held-out examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.pii import BASE_KINDS, find_personal_data
from snapledger.llm.registry import query, table


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def _count(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == kind)).cast("long")


@query()
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base kinds in all texts, and the base and all spans."""
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [_count(kinds, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    added = [
        _count(F.transform("all_spans", lambda s: s["kind"]), "secret").alias("n_secret"),
        (F.size("all_spans") - F.size("base_spans")).cast("long").alias("n_added"),
        F.size("all_spans").cast("long").alias("n_spans"),
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_listed("base_spans"), 256).alias("base_sha256"), _listed("all_spans").alias("spans"), *added
    )
