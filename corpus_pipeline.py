"""A training corpus from raw documents: quality rules, line dedup, near-duplicates, decontamination, tokens.

Each stage is a function (spark, docs, folder of the tables) -> DataFrame. All but the last take and return the
columns of ``documents``; each works on what the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.bpe import default_codec, encode_texts
from snapledger.llm.decontaminate import drop_leaks
from snapledger.llm.line_dedup import dedup_lines
from snapledger.llm.near_dup import drop_near_duplicates
from snapledger.llm.quality import filter_quality
from snapledger.session import discard, materialize

#: Distinct texts from which a line that they share is dropped, and percent of similarity from which one document stays.
MIN_DOCS = 10
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that meet the current policy."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many distinct texts share; ``n_chars`` follows the text.

    Copies count once and keep their text: choosing one of them is up to the near-duplicate stage.
    """
    kept = dedup_lines(docs, min_docs=MIN_DOCS, copies_once=True)
    kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    return drop_near_duplicates(docs, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all texts, their number, and a digest of what they decode to."""
    decoded = encode_texts(docs, default_codec(), decoded_col="decoded", keep=["doc_id", "lang", "source"])
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Tokenizing has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored for the next, and removed once that has read it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
