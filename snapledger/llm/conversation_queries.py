"""The registered query of conversation repair; tested against a brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.conversations import repair_report
from snapledger.llm.registry import query, table


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults put in, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the turn, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role
    ``user``. Nulls count as one space, in the key as well as in role and text.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fault.alias("fault"))
    rows = rows.filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


@query()
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations after damage: their faults, the cheapest repair and a digest of what it leaves."""
    turns = table(spark, folder, "conversations")
    report = repair_report(damaged(turns))
    report = report.withColumnRenamed("conv_id", "_conv")
    every = turns.select("conv_id").distinct()
    both = every.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return both.select(
        "conv_id",
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        zero("n_turns"),
    )
