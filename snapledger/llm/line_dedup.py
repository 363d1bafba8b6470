"""Dropping lines that many documents share.

Normalised lines are exploded and hashed, distinct documents are counted per hash, and the lines
whose hash is too frequent are taken out of every document, the rest staying in its order.
DataFrame functions only.

* Only hashes, ids and positions are shuffled for the decision; the text itself moves once, when
  the decisions meet their documents.
* Distinct documents are counted over (hash, document), so a line that a third of all documents
  hold is spread over all tasks and only partial counts meet.
* The few lines that make up at least ``1 / HOT_SHARE`` of all droppable occurrences are marked by a
  broadcast of at most ``HOT_SHARE`` hashes, whatever the data; the others are joined by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import SPACES, ascii_lower, packed, row_key, unpacked
from snapledger.session import materialize

#: The inverse of the share of occurrences from which a line is marked by broadcast.
HOT_SHARE = 10_000


def line_key(line: Column) -> Column:
    """A line's key: white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key).alias("_h2")]


def _exploded(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line long enough to be dropped: document, row key, position, hash of the key."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        *row_key(F.col(f"`{id_col}`"), text),
        F.posexplode(F.split(text, "\n", -1)).alias("_at", "_line"),
    )
    keyed = lines.select("_id", "_k1", "_k2", "_at", line_key(F.col("_line")).alias("_key"))
    return keyed.filter(F.length("_key") >= min_chars).select("_id", "_k1", "_k2", "_at", *_key_hash(F.col("_key")))


def frequent_lines(
    docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int, copies_once: bool = False
) -> DataFrame:
    """Hashes (``_h1``, ``_h2``) of the lines in at least ``min_docs`` documents, with that count ``_n``.

    With ``copies_once`` distinct whole texts are counted, not ids.
    """
    if copies_once:
        # The row key of a row without its id is a digest of the text.
        docs = docs.select(F.lit(None).cast("long").alias(id_col), F.col(f"`{text_col}`"))
    holder = ["_k1", "_k2"] if copies_once else ["_id"]
    found = _exploded(docs, id_col, text_col, min_chars).select("_h1", "_h2", *holder).distinct()
    counts = found.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") >= min_docs)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    copies_once: bool = False,
) -> DataFrame:
    """The documents without the lines whose key occurs in ``min_docs`` or more of them.

    Returns every input row with ``text_col`` replaced by the lines that stay, joined by line feeds,
    and with ``n_lines`` (before dropping) and ``n_dropped``, which replace input columns of these names.

    * Null or empty text is one empty line. Keys shorter than ``min_chars`` are never dropped.
    * If no line stays, the text is empty.
    * With ``copies_once`` documents of equal texts count as one, and a text of which nothing but white space would stay is
      kept whole, so that a group of copies is never lost, whatever other texts share its lines.
    * Documents are told apart by ``id_col``: repeated rows and repeated lines of one document count once;
      rows without an id count as one document.
    * An empty table gives an empty table. Two keys are taken as equal if 128 bits of hash are.
    """
    frequent = materialize(frequent_lines(docs, id_col, text_col, min_docs, min_chars, copies_once), "frequent-lines")
    least = frequent.agg(F.coalesce(F.sum("_n"), F.lit(0)) / HOT_SHARE).scalar()
    # At most HOT_SHARE hashes can each have that share of the sum.
    hot = frequent.filter(F.col("_n") >= least).select("_h1", "_h2", F.lit(True).alias("_hot"))
    lines = _exploded(docs, id_col, text_col, min_chars).drop("_id")
    marked = lines.join(F.broadcast(hot), ["_h1", "_h2"], "left")
    marked_hot = marked.filter("_hot").select("_k1", "_k2", "_at")
    others = marked.filter("_hot IS NULL").drop("_hot")
    marked_rest = others.join(frequent.filter(F.col("_n") < least), ["_h1", "_h2"], "left_semi")
    dropped = (
        marked_hot.unionByName(marked_rest.select("_k1", "_k2", "_at"))
        .groupBy("_k1", "_k2")
        .agg(F.collect_set("_at").alias("_dropped"))
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    whole = docs.select(
        packed(docs, [text_col, "n_lines", "n_dropped"]),
        *row_key(F.col(f"`{id_col}`"), text),
        text.alias("_text"),
    )
    joined = whole.join(dropped, ["_k1", "_k2"], "left")
    split = joined.withColumn("_lines", F.split("_text", "\n", -1))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    stay = F.transform(F.array_except(places, F.col("_dropped")), lambda i: F.get(F.col("_lines"), i))
    split = split.withColumn("_kept", F.when(F.col("_dropped").isNotNull(), F.array_join(stay, "\n")))
    if copies_once:
        whole_stays = F.btrim("_kept", F.lit(SPACES)) == ""
        split = split.withColumn("_dropped", F.when(~whole_stays, F.col("_dropped")))
    kept = F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(F.col("_kept"))
    shaped = split.select(
        *unpacked(split),
        kept.alias(text_col),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    order = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped"}]
    return shaped.select(*[f"`{c}`" for c in order], "n_lines", "n_dropped")
