"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with AQE, early skew-join splitting and a fixed time zone.

    ``settings`` uses ``__`` for dots (``spark__sql__shuffle__partitions="400"``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "3")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own;
    a cluster session without it is an error, as a machine-local folder would be lost
    with its machine. On a cluster a path that names no file system and means local disks is warned of.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    if configured:
        if not local and ":" not in configured:
            default = context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
            if default.startswith("file:"):
                warnings.warn(f"spark.checkpoint.dir {configured} is on local disks unless they are shared", stacklevel=2)
        return configured.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="snapledger-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/snapledger/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A path can be marked for removal only once it exists.
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, so that repeated passes
    (model fitting, row numbering) see the same rows in the same partitions.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` stored, once nothing reads it any more."""
    for file in df.inputFiles()[:1]:
        path = file.rsplit("/", 1)[0]
        if "/snapledger/" not in path:
            raise ValueError(f"{path} was not stored by this package")
        remove_folder(df.sparkSession, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Let a finished folder take the place of ``path``, whose earlier content stays until that has worked.

    Both must be in one file system. Where renaming copies, as in some object stores, a reader may find either content meanwhile.
    """
    new, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.before-{uuid.uuid4().hex}")
    kept = files.exists(target)
    if kept and not files.rename(target, old):
        raise OSError(f"{path} cannot be put aside")
    files.mkdirs(target.getParent())
    if not files.rename(new, target):
        if kept:
            files.rename(old, target)
        raise OSError(f"{staged} cannot take the place of {path}")
    if kept:
        files.delete(old, True)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder for the body of a ``with`` block; the files go when it ends."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for the body of a ``with`` block and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative learners a place for their periodic checkpoints."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/snapledger/checkpoints")
