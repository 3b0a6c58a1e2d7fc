"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEW_KEYS = 100_000  # hashes of repeated keys, eight bytes each, that are sent to every executor


def newest_first(*columns: str) -> list[Column]:
    """Descending, NULLs last: a row without a time never beats one that has it."""
    return [F.col(c).desc_nulls_last() for c in columns]


def dedup_latest(
    df: DataFrame, keys: list[str], order_by: list[Column], keep_rn: bool = False
) -> DataFrame:
    """Keep the first row of every key under `order_by`.

    The `row_number() = 1` filter lets Spark put a group limit before the shuffle: each map
    task passes on at most one row per key, so a key holding a large part of all rows costs
    one row per map task on the reduce side.
    """
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    latest = ranked.filter(F.col("rn") == 1)
    return latest.withColumn("rn", F.col("rn").cast("long")) if keep_rn else latest.drop("rn")


def repeated_hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes (`_hash`) that more than one row's key has: of repeated keys, and of few others."""
    hashes = df.select(F.xxhash64(*keys).alias("_hash"))
    return hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_hash")


def dedup_latest_stored(df: DataFrame, keys: list[str], order_by: list[Column]) -> tuple[DataFrame, bool]:
    """`dedup_latest` of rows that lie in files or are cheap to make again, and whether it is the
    rows as they were.

    Whole rows are shuffled only where a key is repeated: the hashes of all keys are counted first.
    With many repeated keys all rows are.
    """
    hashes = repeated_hashes(df, keys)
    n = hashes.count()
    if n == 0:
        return df, True
    if n > FEW_KEYS:
        return dedup_latest(df, keys, order_by), False
    found = F.broadcast(df.sparkSession.createDataFrame(hashes.collect(), "_hash LONG"))
    rows = df.withColumn("_hash", F.xxhash64(*keys))
    again = dedup_latest(rows.join(found, "_hash", "left_semi"), keys, order_by)
    once = rows.join(found, "_hash", "left_anti")
    return once.select(*df.columns).unionByName(again.select(*df.columns)), False
