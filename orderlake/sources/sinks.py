"""Table writes: append with schema merge, fan-out, dead letters, retyping rewrite."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.stored import StoredTable
from orderlake.session import kept


def _batch_writer(
    df: DataFrame, path: str, batch_id: int | None, writer: str
) -> tuple[DataFrameWriter, str]:
    """Writer and folder of a batch. A numbered batch is overwritten by its replay, so an
    at-least-once input does not append it twice; unnumbered rows are simply appended.

    Numbers are only unique within one writer: a second stream, or one whose checkpoint was
    reset, begins at 0 again, so its name (its query id) is part of the folder.
    """
    if batch_id is None:
        return df.write.mode("append"), f"{path}/batch=unnumbered"
    return df.write.mode("overwrite"), f"{path}/batch={writer}-{batch_id}"


def append_table(
    df: DataFrame,
    path: str,
    batch_id: int | None = None,
    partition_by: list[str] | None = None,
    writer: str = "batch",
) -> None:
    """Append rows; the first append creates the table, later ones may bring new columns."""
    writer, target = _batch_writer(df, path, batch_id, writer)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)


def read_appended(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """All appended rows. Columns are merged over the files unless a schema is declared;
    declare one for large tables, since merging opens every file's footer."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    df = reader.parquet(path)
    return df.drop("batch") if "batch" in df.columns else df


def save_or_merge(table: StoredTable, df: DataFrame, **merge_options) -> bool:
    """Create the table from the first non-empty batch, upsert later ones. False if empty."""
    return table.merge(df, **merge_options)


def fan_out(
    batch: DataFrame,
    transforms: dict[str, Callable[[DataFrame], DataFrame]],
    write: Callable[[str, DataFrame], None],
    in_files: bool = False,
) -> int:
    """Feed one batch to several tables; returns its number of rows. The batch is computed once
    and kept as files, unless it is read from files as it is (`in_files`). Two writes run side by
    side, so that no more than two tables' work files lie on disk at a time, and nothing is
    written if the batch is empty. The first error is raised after all writes have ended."""
    with nullcontext(batch) if in_files else kept(batch, "batch") as rows:
        n = rows.count()
        if n:
            with ThreadPoolExecutor(max_workers=2) as pool:
                writes = [pool.submit(write, name, fn(rows)) for name, fn in transforms.items()]
            for done in writes:
                done.result()
        return n


def write_dead_letters(
    df: DataFrame,
    path: str,
    consumer: str,
    stage: str,
    batch_id: int | None = None,
    writer: str = "batch",
) -> None:
    """Keep rejected bodies as compressed JSON under consumer and stage (and batch, replay-safe)."""
    writer, target = _batch_writer(df, f"{path}/consumer={consumer}/stage={stage}", batch_id, writer)
    writer.option("compression", "gzip").json(target)


def read_dead_letters(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rejected bodies of all batches, with their consumer and stage."""
    return spark.read.schema(schema).json(path).drop("batch")


def rewrite_with_type(
    df: DataFrame, column: str, kind: str | T.DataType, out_path: str, value: Column | None = None
) -> DataFrame:
    """Write a copy in which one column has another type; returns the copy."""
    new = (F.col(column) if value is None else value).cast(kind)
    retyped = df.withColumn(column, new)
    retyped.write.mode("overwrite").parquet(out_path)
    return df.sparkSession.read.schema(retyped.schema).parquet(out_path)
