"""The latest version of each entity as a stored table that takes in one day's versions at a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.operators.snapshot import latest_per_key

_OLD, _NEW = "_stored", "_arrived"


@dataclass(frozen=True)
class LatestTable:
    """One row per key, in files that are bucketed and sorted by it.

    Each merge writes the table anew below its folder, as another version, and leaves the earlier ones alone: a failed
    merge changes nothing, and a reader of an earlier version goes on. The stored rows are never shuffled: the arriving ones are
    reduced to their latest per key and sent to the buckets.
    """

    folder: str
    key: str
    order_by: tuple[str, ...]
    schema: T.StructType
    buckets: int
    version: int = 0

    @property
    def path(self) -> str:
        return f"{self.folder}/version={self.version}"

    @classmethod
    def create(cls, versions: DataFrame, folder: str, key: str, order_by: Sequence[str], buckets: int) -> LatestTable:
        """A new table with the latest of each key of ``versions``, which may be empty. Rows without a key are left out."""
        table = cls(folder, key, tuple(order_by), versions.schema, buckets)
        latest = latest_per_key(versions.filter(F.col(key).isNotNull()), key, order_by)
        table._write(latest.select(*versions.columns).repartition(buckets, key))
        return table

    @classmethod
    def open(cls, spark: SparkSession, folder: str, key: str, order_by: Sequence[str], buckets: int) -> LatestTable:
        """The newest whole version below a folder; one that a failed merge left unfinished does not count."""
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(path)]
        whole = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
        numbers = [int(n.split("=")[1]) for n in whole if n.startswith("version=")]
        if not numbers:
            raise ValueError(f"no version in {folder}")
        schema = spark.read.parquet(f"{folder}/version={max(numbers)}").schema
        return cls(folder, key, tuple(order_by), schema, buckets, max(numbers))

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows as a table that Spark knows to be bucketed. The catalog's entry is for this session alone."""
        name = f"latest_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`)"
            f" INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return spark.table(name).select(*self.schema.fieldNames())

    def merged(self, versions: DataFrame) -> DataFrame:
        """What the table holds once ``versions`` have come in: of each key the row with the largest ordering.

        Versions may come late or twice: a stored row only gives way to a larger one; equal orderings are decided by
        the other columns, as in ``latest_per_key``, so that the result does not depend on how versions were dealt to merges.
        """
        spark = versions.sparkSession
        arrived = latest_per_key(versions.filter(F.col(self.key).isNotNull()), self.key, self.order_by)
        old = self.read(spark).select(F.col(self.key), self._ranked().alias(_OLD))
        new = arrived.select(F.col(self.key), self._ranked().alias(_NEW))
        both = old.join(new, self.key, "full")
        # The greater of two structs; a missing one is null and loses.
        larger = F.greatest(_OLD, _NEW).alias("_latest")
        picked = both.select(self.key, larger)
        return picked.select(*[F.col(n) if n == self.key else F.col(f"_latest.`{n}`") for n in self.schema.fieldNames()])

    def merge(self, versions: DataFrame) -> LatestTable:
        """The table's next version with ``versions`` taken in."""
        after = replace(self, version=self.version + 1)
        # The join leaves every bucket in one partition, so it is written without another shuffle.
        after._write(self.merged(versions.select(*self.schema.fieldNames())))
        return after

    def _ranked(self) -> Column:
        others = [n for n in self.schema.fieldNames() if n != self.key and n not in self.order_by]
        return F.struct(*self.order_by, *others)

    def _write(self, rows: DataFrame) -> None:
        name = f"latest_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.mode("error").option("path", self.path).saveAsTable(name)
        # The table is external: its files stay.
        rows.sparkSession.sql(f"DROP TABLE {name}")
