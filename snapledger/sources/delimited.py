"""CSV sources: columns are found by the names in the header, and no line or value is lost in silence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.session import materialize, stored

#: Quotes are doubled inside quotes, as in pandas' files. An unquoted empty field is null and a quoted one is empty text:
#: the parser tells them apart if null has a notation that no field has.
DIALECT = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\u0000"}

#: How line breaks, and the sign itself, are written in files of one line per row.
BREAKS = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"))


def escape_breaks(text: Column) -> Column:
    """Text without line breaks, from which ``unescape_breaks`` makes the text again."""
    for sign, code in BREAKS:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescape_breaks(text: Column) -> Column:
    for sign, code in reversed(BREAKS):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def read_text_columns(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    mode: str = "FAILFAST",
    line_breaks: str = "none",
    **options: str,
) -> DataFrame:
    """Columns as text: those named in ``columns``, found by their names in the header, or all that have a name.

    ``mode`` decides on lines of too few or too many fields: ``FAILFAST`` is an error, ``PERMISSIVE`` fills up with nulls
    or cuts off, ``DROPMALFORMED`` leaves them out. All files must have the same header; another one is an
    error, except in the last two modes, where a file may be damaged in any way.

    ``line_breaks`` says how values may hold them: ``none``; ``quoted``, as they are inside quotes, for which every file is
    read by one task; ``escaped``, as ``write_csv`` writes them on request, which keeps files splittable.
    """
    settings = {**DIALECT, "multiLine": str(line_breaks == "quoted").lower(), **options}
    names = spark.read.options(**settings).csv(path).columns
    wanted = [n for i, n in enumerate(names) if n.strip() and n != f"_c{i}"]
    reader = spark.read.options(**settings).option("mode", mode)
    if mode.upper() != "PERMISSIVE":
        # The parser must look at whole lines whatever columns the query wants; pruning happens after it.
        reader = reader.option("columnPruning", "false")
    if mode.upper() == "FAILFAST" and len(wanted) == len(names):
        reader = reader.option("enforceSchema", "false")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if columns is not None:
        known = {n.lower(): n for n in wanted}
        missing = [c for c in columns if c.lower() not in known]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header {', '.join(names)}")
        wanted = list(columns)
    text = reader.schema(schema).csv(path)
    values = [F.col(f"`{c}`") for c in wanted]
    if line_breaks == "escaped":
        values = [unescape_breaks(v) for v in values]
    return text.select(*[v.alias(c) for v, c in zip(values, wanted, strict=True)])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns whose header was blank (such as a written row index)."""
    unnamed = [name for i, name in enumerate(df.columns) if not name.strip() or name == f"_c{i}"]
    return df.drop(*unnamed)


def read_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    mode: str = "FAILFAST",
    drop_unreadable: bool = False,
    line_breaks: str = "none",
    **options: str,
) -> DataFrame:
    """The columns of ``schema``, found by name, with their declared types and without an inference pass.

    Unreadable values become null, or drop their row with ``drop_unreadable``. Both hold for
    every projection, as the check uses whole rows read as text.
    """
    text = read_text_columns(spark, path, schema.fieldNames(), mode, line_breaks, **options)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if drop_unreadable:
        for f in schema.fields:
            raw = F.col(f"`{f.name}`")
            text = text.filter(raw.isNull() | raw.try_cast(f.dataType).isNotNull())
    return text.select(*typed)


#: Columns of rejected lines: the file, what is wrong, in which column, how many fields the line has, and the line itself.
REJECT_COLUMNS = ("file", "reason", "column", "n_fields", "line")
TOO_FEW, TOO_MANY, BROKEN, UNREADABLE = "too few fields", "too many fields", "broken line", "unreadable value"
_LINE, _FILE, _REJECT = "_corrupt_line", "_source_file", "_reject"


@dataclass(frozen=True)
class Checked:
    """Rows that were taken, lines that were not, both of one pass over the files."""

    accepted: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """``(reason, rows)``; rows without a reason were accepted."""
        taken = self.accepted.agg(F.lit("").alias("reason"), F.count(F.lit(1)).alias("rows"))
        return taken.unionByName(self.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def _field_count(line: Column, separator: str) -> Column:
    """Fields of a line: separators outside quotes and one more. An odd quote opens a field to the line's end."""
    plain = F.regexp_replace(line, r'"(?:[^"]|"")*("|$)', "")
    return (F.length(plain) - F.length(F.replace(plain, F.lit(separator), F.lit(""))) + 1).cast("int")


def _checked_rows(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    line_breaks: str = "none",
    **options: str,
) -> DataFrame:
    """All lines as rows of the wanted columns, with ``_reject``: null, or a struct of ``REJECT_COLUMNS``."""
    settings = {**DIALECT, "multiLine": str(line_breaks == "quoted").lower(), **options}
    names = spark.read.options(**settings).csv(path).columns
    named = [n for i, n in enumerate(names) if n.strip() and n != f"_c{i}"]
    if schema is None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in named])
    known = {n.lower(): n for n in named}
    missing = [n for n in schema.fieldNames() if n.lower() not in known]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header {', '.join(names)}")
    # Whole lines are parsed whatever the query wants, and a line of another number of fields comes along as it stands.
    reader = spark.read.options(**settings, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, columnPruning="false")
    fields = [T.StructField(n, T.StringType()) for n in [*names, _LINE]]
    text = reader.schema(T.StructType(fields)).csv(path).withColumn(_FILE, F.col("_metadata.file_path"))
    raw = {f.name: F.col(f"`{known[f.name.lower()]}`") for f in schema.fields}
    if line_breaks == "escaped":
        raw = {n: unescape_breaks(v) for n, v in raw.items()}
    kinds = {f.name: f.dataType for f in schema.fields}
    values = {n: raw[n] if kinds[n] == T.StringType() else raw[n].try_cast(kinds[n]) for n in raw}
    lost = [F.when(raw[n].isNotNull() & values[n].isNull(), F.lit(n)) for n in raw if kinds[n] != T.StringType()]
    unreadable = F.coalesce(*lost) if lost else F.lit(None).cast("string")
    line, count = F.col(_LINE), _field_count(F.col(_LINE), settings.get("sep", ","))
    torn = F.when(count < len(names), TOO_FEW).when(count > len(names), TOO_MANY).otherwise(BROKEN)
    written = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), {"quote": '"', "escape": '"', "sep": settings.get("sep", ",")})
    found = [
        F.col(_FILE),
        F.when(line.isNotNull(), torn).otherwise(UNREADABLE),
        F.when(line.isNull(), unreadable),
        F.when(line.isNotNull(), count).otherwise(len(names)),
        F.coalesce(line, written),
    ]
    bad = F.struct(*[c.alias(n) for n, c in zip(REJECT_COLUMNS, found, strict=True)])
    reject = F.when(line.isNotNull() | unreadable.isNotNull(), bad)
    return text.select(*[values[n].alias(n) for n in raw], reject.alias(_REJECT))


def _split(rows: DataFrame) -> Checked:
    good = [F.col(f"`{c}`") for c in rows.columns if c != _REJECT]
    return Checked(
        rows.filter(F.col(_REJECT).isNull()).select(*good), rows.filter(F.col(_REJECT).isNotNull()).select(f"{_REJECT}.*")
    )


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    line_breaks: str = "none",
    **options: str,
) -> Checked:
    """The columns of ``schema``, or all named ones as text, and apart from them every line that does not fit.

    A line is rejected if it has more or fewer fields than the header, or, with a schema, if a value cannot be read as the type of
    its column; an empty field is null and fits. Nothing gets lost: every line is in one of the two tables. The files are read
    once; the parsed rows are stored in the shared folder, so any number of queries on both tables parse nothing again.
    ``column`` is the first that cannot be read; the line is then written anew from its fields.
    """
    return _split(materialize(_checked_rows(spark, path, schema, line_breaks, **options), "checked"))


@contextmanager
def checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    line_breaks: str = "none",
    **options: str,
) -> Iterator[Checked]:
    """:func:`read_checked` for the body of a ``with`` block; the stored rows go when it ends."""
    with stored(_checked_rows(spark, path, schema, line_breaks, **options), "checked") as rows:
        yield _split(rows)


def read_inferred(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Types from the data. Costs one more pass over the files: prefer :func:`read_typed`."""
    return drop_unnamed(spark.read.options(**{**DIALECT, "inferSchema": "true", **options}).csv(path))
