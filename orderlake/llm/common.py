"""What the operators share: their input, stored steps and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import delete_folder, work_path

# A stored table up to this size may be sent to every executor; beyond it a join shuffles.
BROADCAST_BYTES = 6 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: its lineage ends here."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Remove a stored step that nothing reads any more: what was made of it is stored itself."""
    files = table.inputFiles()
    if files:
        delete_folder(table.sparkSession, files[0].rpartition("/")[0])


def stored_bytes(df: DataFrame) -> int:
    """Size of the files below a stored table."""
    files = df.inputFiles()
    if not files:
        return 0
    jvm = df.sparkSession.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(conf).getContentSummary(folder).getLength()


def sent_if_small(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast if its files are small; else joins shuffle it."""
    return F.broadcast(table) if stored_bytes(table) <= limit else table


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column | str = "text") -> Column:
    """128-bit content address of a text; NULL stays NULL."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def python_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """`df` through `fn`, an Arrow function from record batches to record batches."""
    return df.mapInArrow(fn, schema)
