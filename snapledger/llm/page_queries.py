"""The registered query of HTML extraction; tested against pages whose text is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.registry import query, table
from snapledger.llm.site_tree import extract_text


@query()
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    texts = extract_text(table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_judged", "n_site_blocks")
