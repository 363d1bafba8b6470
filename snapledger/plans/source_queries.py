"""Source and sink queries: the given tables go through files in the shared folder and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger import sinks
from snapledger.plans.registry import query, table
from snapledger.session import new_folder
from snapledger.sources import delimited, literal


def _append_lines(lines: DataFrame, header: str, path: str) -> None:
    """Add files of ready lines below the given header."""
    raw = {"header": "true", "sep": "\u0001", "quote": ""}
    lines.toDF(header).write.mode("append").options(**raw).csv(path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_dropmalformed(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer once as a good line, once too short and once too long: the good ones stay."""
    customer = table(spark, folder, "customer")
    path = new_folder(spark, "csv")
    sinks.write_csv(customer, path)
    header = ",".join(customer.columns)
    _append_lines(customer.select(F.concat_ws(",", "c_custkey", "c_name")), header, path)
    _append_lines(customer.select(F.concat_ws(",", *customer.columns, F.lit("x"))), header, path)
    return delimited.read_typed(spark, path, customer.schema, mode="DROPMALFORMED")


def _torn_customers(spark: SparkSession, folder: str) -> delimited.Checked:
    """Every customer once as a good line, and some as lines that are too short, too long, or hold no number where one must be."""
    customer = table(spark, folder, "customer")
    path = new_folder(spark, "csv")
    sinks.write_csv(customer, path)
    header, rest = ",".join(customer.columns), F.col("c_custkey") % 5
    _append_lines(customer.filter(rest == 1).select(F.concat_ws(",", "c_custkey", "c_name")), header, path)
    _append_lines(customer.filter(rest == 2).select(F.concat_ws(",", "c_custkey", F.lit('"a, ""b"" c"'), "c_nationkey", F.lit(""), F.lit(""), F.lit("x"))), header, path)
    _append_lines(customer.filter(rest == 3).select(F.concat_ws(",", "c_custkey", "c_name", F.lit("none"), F.lit("1.5"), "c_mktsegment")), header, path)
    _append_lines(customer.filter(rest == 4).select(F.concat_ws(",", "c_name", "c_name", "c_nationkey", F.lit(""), F.lit('"x, y"'))), header, path)
    return delimited.read_checked(spark, path, customer.schema)


@query(
    """
    SELECT 'too few fields' AS reason, NULL AS column, 2 AS n_fields, c_custkey || ',' || c_name AS line FROM customer WHERE c_custkey % 5 = 1
    UNION ALL
    SELECT 'too many fields', NULL, 6, c_custkey || ',"a, ""b"" c",' || c_nationkey || ',,,x' FROM customer WHERE c_custkey % 5 = 2
    UNION ALL
    SELECT 'unreadable value', 'c_nationkey', 5, c_custkey || ',' || c_name || ',none,1.5,' || c_mktsegment FROM customer WHERE c_custkey % 5 = 3
    UNION ALL
    SELECT 'unreadable value', 'c_custkey', 5, c_name || ',' || c_name || ',' || c_nationkey || ',,"x, y"' FROM customer WHERE c_custkey % 5 = 4
    """
)
def src_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Every line that was not taken, with its reason; the file is left out, as its name is made up anew each time."""
    return _torn_customers(spark, folder).rejected.drop("file")


@query(
    """
    SELECT '' AS reason, count(*) AS rows FROM customer
    UNION ALL SELECT 'too few fields', count(*) FROM customer WHERE c_custkey % 5 = 1
    UNION ALL SELECT 'too many fields', count(*) FROM customer WHERE c_custkey % 5 = 2
    UNION ALL SELECT 'unreadable value', count(*) FROM customer WHERE c_custkey % 5 IN (3, 4)
    """
)
def src_csv_checked_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines were taken, and how many not, by reason."""
    return _torn_customers(spark, folder).counts()


@query(
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT c_custkey, c_name, NULL, NULL, NULL FROM customer
    """
)
def src_csv_permissive(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that end early are kept, with nulls in the missing places."""
    customer = table(spark, folder, "customer")
    path = new_folder(spark, "csv")
    sinks.write_csv(customer, path)
    _append_lines(customer.select(F.concat_ws(",", "c_custkey", "c_name")), ",".join(customer.columns), path)
    return delimited.read_typed(spark, path, customer.schema, mode="PERMISSIVE")


@query(
    """
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    FROM part
    """
)
def src_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv")
    sinks.write_csv(table(spark, folder, "part"), path)
    return delimited.read_inferred(spark, path)


# How urgent each priority is.
_PRIORITIES = [
    {"o_orderpriority": "1-URGENT", "days": 1},
    {"days": 2, "o_orderpriority": "2-HIGH"},
    {"o_orderpriority": "3-MEDIUM", "days": 5},
    {"days": 9, "o_orderpriority": "5-LOW"},
    {"o_orderpriority": "4-NOT SPECIFIED"},
]


@query(
    """
    SELECT v.days, o.o_orderpriority, count(*) AS orders
    FROM orders o JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 5), ('5-LOW', 9),
                               ('4-NOT SPECIFIED', CAST(NULL AS INTEGER))) v(o_orderpriority, days)
      ON o.o_orderpriority = v.o_orderpriority
    GROUP BY 1, 2
    """
)
def src_inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Literal rows in any field order get the declared column order; orders are counted by them.

    The orders are counted before the join, so at most one row per priority meets the literals.
    """
    days = literal.literal_rows(spark, _PRIORITIES, "days int, o_orderpriority string")
    counts = table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return days.join(counts, "o_orderpriority").select("days", "o_orderpriority", "orders")


@query(
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem
    """
)
def sink_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    path = new_folder(spark, "csv")
    sinks.write_csv(lineitem, path)
    return delimited.read_typed(spark, path, lineitem.schema)


_TEXTS = """
    SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  "' || text || '", 100%0A ' || chr(13) || chr(10)
                   ELSE text END AS text
    FROM documents
"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with nulls, empty texts, quotes, blanks at the ends and line breaks."""
    text, rest = F.col("text"), F.col("doc_id") % 5
    quoted = F.concat(F.lit('  "'), text, F.lit('", 100%0A \r\n'))
    changed = F.when(rest == 0, F.lit(None)).when(rest == 1, "").when(rest == 2, quoted).otherwise(text)
    return table(spark, folder, "documents").select("doc_id", changed.alias("text"))


@query(_TEXTS)
def sink_csv_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Any text comes back from files with one line per row, which stay splittable."""
    texts, path = _texts(spark, folder), new_folder(spark, "csv")
    sinks.write_csv(texts, path, escape_line_breaks=True)
    return delimited.read_typed(spark, path, texts.schema, line_breaks="escaped")


@query(_TEXTS)
def sink_csv_quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Line breaks inside quotes, as other programs write and read them."""
    texts, path = _texts(spark, folder), new_folder(spark, "csv")
    sinks.write_csv(texts, path)
    return delimited.read_typed(spark, path, texts.schema, line_breaks="quoted")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_csv_header_order(spark: SparkSession, folder: str) -> DataFrame:
    """A schema finds its columns by name, in whatever order the file has them."""
    customer, path = table(spark, folder, "customer"), new_folder(spark, "csv")
    sinks.write_csv(customer.select("c_mktsegment", "c_acctbal", "c_name", "c_custkey"), path)
    return delimited.read_typed(spark, path, customer.select("c_custkey", "c_name", "c_acctbal").schema)


@query("SELECT CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def sink_key_list(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "keys")
    sinks.write_key_list(table(spark, folder, "orders"), "o_custkey", path)
    return delimited.read_text_columns(spark, path)


@query(
    """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position,
           o_orderkey, o_custkey, o_totalprice
    FROM orders
    """
)
def sink_csv_indexed(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = new_folder(spark, "csv")
    sinks.write_csv_with_position(orders, path, ["o_orderdate", "o_orderkey"], ties=False)
    written = T.StructType([T.StructField("position", T.LongType()), *orders.schema.fields])
    return delimited.read_typed(spark, path, written).drop("o_orderdate")


@query(
    """
    SELECT printf('%.2f', l_quantity) || ' ' || printf('%.2f', l_extendedprice / 7) || ' '
           || printf('%.2f', -l_tax / 3) || ' ' || printf('%.2f', l_quantity / 8) || ' '
           || printf('%.2f', l_quantity + 0.005::DOUBLE) AS value
    FROM lineitem
    """
)
def sink_fixed_decimals(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem").select(
        "l_quantity",
        (F.col("l_extendedprice") / 7).alias("share"),
        (-F.col("l_tax") / 3).alias("tax"),
        (F.col("l_quantity") / 8).alias("eighth"),
        (F.col("l_quantity") + 0.005).alias("tie"),
    )
    path = new_folder(spark, "decimals")
    sinks.write_fixed_decimals(lineitem, path, ["l_quantity", "share", "tax", "eighth", "tie"])
    return spark.read.text(path)
