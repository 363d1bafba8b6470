"""The registered queries of the tokenizers; tested against the libraries that they agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.bpe import default_codec, encode_texts
from snapledger.llm.registry import query, table
from snapledger.llm.token_files import read_sequences, write_sequences
from snapledger.session import new_folder


@query()
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All whole texts as ids of the multilingual vocabulary, and what the ids decode to."""
    codec = default_codec()
    both = encode_texts(table(spark, folder, "documents"), codec, decoded_col="decoded", keep=["doc_id"])
    return both.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All whole texts written as framed ids with an end id, and read back from the files."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()
    files = new_folder(spark, "token-files")
    write_sequences(table(spark, folder, "documents"), f"{files}/ids", model, vocabulary_size=49_408, end_id=2)
    read = read_sequences(spark, f"{files}/ids")
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("token_ids").alias("ids_crc32"),
    )
