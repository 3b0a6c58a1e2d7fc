"""Session settings the engine relies on, and the shared working folder."""

from __future__ import annotations

import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings applied to every session the engine works in.
#  * UTC: naive and zoned event times must agree, and local time must be shifted once only.
#  * AQE with skew handling: partition counts follow the data, hot join partitions are split.
#  * canChangeCachedPlanOutputPartitioning: the same for batches kept in memory.
#  * requireAllClusterKeysForCoPartition=false: a merge whose sides are both already
#    partitioned by bucket may join on (bucket, key) without another exchange.
#  * fileCleanup: the shuffle files of a query go when it ends, not when the driver's heap is
#    next collected; a frame that is run again makes them again.
#  * RocksDB state: the events that a stream remembers lie on disk, not in the executors' heap.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Spark derives a "the array is not empty" filter from every explode and pushes it below the
# projection that parses the array, so that each JSON text is parsed twice. Left out.
EXCLUDED_RULE = "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    excluded = spark.conf.get("spark.sql.optimizer.excludedRules", None) or ""
    if EXCLUDED_RULE not in excluded:
        rules = [r for r in (excluded, EXCLUDED_RULE) if r]
        spark.conf.set("spark.sql.optimizer.excludedRules", ",".join(rules))
    return spark


def build_session(app_name: str = "orderlake", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the engine's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or else below the warehouse,
    which driver and executors share too."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/orderlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """What is run meanwhile has another session setting."""
    usual = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


@contextmanager
def kept(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`df` computed once, as compressed files in the shared folder while they are needed. Nested
    rows take a fraction there of what they take in a cache."""
    path = work_path(df.sparkSession, label)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(df.sparkSession, path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, on whatever file system it is; none if it is absent."""
    folder, files = _folder(spark, path)
    return [e.getPath().getName() for e in files.listStatus(folder)] if files.exists(folder) else []


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the engine's own, on whatever file system it is."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def entry_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the files of a folder."""
    folder, files = _folder(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return {e.getPath().getName(): e.getLen() for e in found if e.isFile()}


def move(spark: SparkSession, old: str, new: str) -> None:
    folder, files = _folder(spark, old)
    if not files.rename(folder, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not be moved to {new}")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Leave the file that Spark's writers leave in a complete folder."""
    _, files = _folder(spark, path)
    files.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"), True).close()


def folder_bytes(spark: SparkSession, path: str, prefix: str = "") -> int:
    """Bytes below the entries of a folder whose names begin with `prefix`."""
    folder, files = _folder(spark, path)
    found = [e.getPath() for e in files.listStatus(folder)] if files.exists(folder) else []
    return sum(files.getContentSummary(p).getLength() for p in found if p.getName().startswith(prefix))
