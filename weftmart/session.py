"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings every plan relies on. Sizes (shuffle partitions, file split size) are left to the
# cluster; AQE coalesces or splits shuffle partitions from the measured sizes.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dir: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "weftmart", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # a session that runs many loads keeps their generated classes
    builder = builder.config("spark.sql.codegen.cache.maxEntries", "1000")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="weftmart-")
    return _local_dir


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/weftmart/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table from the file system it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end; what outlives them must be written elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is run inside as soon as its result is written."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows between Spark and Python, for tables whose rows are large."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Write parquet and return the written rows as a new DataFrame with a short lineage."""
    if partition_by:
        # one folder per value: gather its rows, and let AQE cut large folders into several files
        sized = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
        sized.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    # partition columns come back last and untyped from folder names, so name the schema
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """The parquet rows under a path, none if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared folder; it survives the loss of an executor."""
    return write_table(df, scratch_path(df.sparkSession, label))


def materialise_narrow(df: DataFrame, label: str) -> DataFrame:
    """The same for rows of a few numbers: at most four tasks per core write it, however many shuffle partitions there are."""
    return materialise(df.coalesce(max(24, 4 * df.sparkSession.sparkContext.defaultParallelism)), label)
