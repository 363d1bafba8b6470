"""The registered query of periodic runs; tested against a brute-force version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import SPACE_CLASS
from snapledger.llm.registry import query, table
from snapledger.llm.runs import find_runs


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one document in ten repeats some of its words from a place on to its end.

    With h, the crc32 of the decimal id, and g = h / 10, words from a = g % n on become a period of
    1 + (n - a) / (3 + g % 8) words if h ends in 0. A null id counts as empty text.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split("text", f"{SPACE_CLASS}+"), "")
    # Each step is a projection of its own, so that no expression is worked out for every place it is used in.
    rows = docs.select("doc_id", "text", h.alias("h"))
    rows = rows.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
    rows = rows.select("*", F.size("words").cast("long").alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    a, rest = F.col("a").cast("int"), (F.col("n") - F.col("a")).cast("int")
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, F.col("p")), times)), F.lit(1), rest)
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def _lines(runs: Column) -> Column:
    """One line ``start,length,period`` per run."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of at least four periods and six words in all whole texts, a tenth of which repeat words on purpose."""
    found = find_runs(planted(table(spark, folder, "documents")), min_words=6, min_times=4, keep=["doc_id"])
    order = lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    found = found.withColumn("best", F.array_max(F.transform("runs", order)))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
