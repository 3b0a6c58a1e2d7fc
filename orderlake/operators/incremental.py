"""Incremental reads against a high-watermark of the target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BEGINNING = "TIMESTAMP '0001-01-01 00:00:00'"


def high_watermark(df: DataFrame, ts: str) -> DataFrame:
    """One row: the newest value of `ts`, NULL for an empty table."""
    return df.agg(F.max(ts).alias("high_watermark"))


def lower_bound(
    target: DataFrame, ts: str, lookback: str = "15 minutes", on_empty: str = "none"
) -> DataFrame:
    """One row: the time after which source rows are to be read.

    on_empty="none": NULL on an empty target, so a comparison with it selects nothing.
    on_empty="all":  the beginning of time, so that a first load reads everything.
    """
    if on_empty not in ("none", "all"):
        raise ValueError(f"unknown on_empty: {on_empty}")
    bound = F.col("high_watermark") - F.expr(f"INTERVAL {lookback}")
    if on_empty == "all":
        bound = F.coalesce(bound, F.expr(_BEGINNING).cast(target.schema[ts].dataType))
    return high_watermark(target, ts).select(bound.alias("bound"))


def incremental(
    source: DataFrame,
    target: DataFrame,
    ts: str,
    lookback: str = "15 minutes",
    on_empty: str = "none",
    date_partition: str | None = None,
) -> DataFrame:
    """Source rows strictly newer than the target's newest `ts` minus the look-back.

    The bound is a scalar subquery: it is known before the source scan starts and is pushed
    into it. `date_partition` names a date column the source is partitioned by (the date
    of `ts`); older partitions are then not even listed into tasks.
    """
    bound = lower_bound(target, ts, lookback, on_empty)
    newer: Column = F.col(ts) > bound.scalar()
    if date_partition:
        day = bound.select(F.to_date("bound"))
        newer = newer & (F.col(date_partition) >= day.scalar())
    return source.filter(newer)


def newer_than(source: DataFrame, ts: str, bound: Column) -> DataFrame:
    """Source rows strictly newer than a bound known beforehand (e.g. from a commit record)."""
    return source.filter(F.col(ts) > bound)
