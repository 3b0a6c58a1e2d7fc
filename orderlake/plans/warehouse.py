"""Warehouse refresh: look-back read, latest row per key, newer-wins upsert, per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.functions import local_time_ms
from orderlake.operators.dedup import dedup_latest, newest_first
from orderlake.operators.incremental import incremental
from orderlake.operators.merge import merge_upsert
from orderlake.operators.quality import conform
from orderlake.operators.stored import ORDERS_PER_BLOCK, StoredTable, order_block

CLOCK = "updated_datetime"  # processing time, compared by the look-back


@dataclass(frozen=True)
class WarehouseTable:
    """key: merge key. event_time: the newer of two rows of a key wins. tie_break: order
    among rows of equal event time, so that a rerun picks the same one."""

    name: str
    key: str
    event_time: str
    tie_break: list[str] = field(default_factory=list)

    @property
    def guard(self) -> str:
        return f"t.{self.event_time} < s.{self.event_time}"


TABLES = {
    "row": WarehouseTable(
        "row",
        "row_bk",
        "source_updated_datetime",
        ["SKU", "OrderedQuantity", "TotalAmount", "VATRate", "ReturnedQuantity"],
    ),
    "payment": WarehouseTable("payment", "payment_bk", "EventEnqueuedUtcTime", ["amount"]),
    "order": WarehouseTable("order", "order_bk", "EventEnqueuedUtcTime", ["status_value"]),
}


def latest(stream: DataFrame, name: str) -> DataFrame:
    """Latest row per key in the layout of the warehouse table (`rn` kept, always 1)."""
    table = TABLES[name]
    order = newest_first(table.event_time, *table.tie_break)
    rows = dedup_latest(stream, [table.key], order, keep_rn=True)
    if name == "row":
        rows = rows.withColumn("orderDateLocal", local_time_ms("orderDate"))
    return conform(rows, schemas.struct(schemas.WAREHOUSE[name]))


def refresh_state(
    stream: DataFrame,
    target: DataFrame,
    name: str,
    lookback: str = "15 minutes",
    on_empty: str = "all",
    strategy: str = "shuffle",
) -> DataFrame:
    """Next state of one warehouse table."""
    table = TABLES[name]
    fresh = latest(incremental(stream, target, CLOCK, lookback, on_empty), name)
    return merge_upsert(
        target,
        fresh,
        [table.key],
        guard=table.guard,
        on_source_duplicates="assume_unique",
        strategy=strategy,
    )


def warehouse_refresh(
    streams: dict[str, DataFrame],
    tables: dict[str, StoredTable],
    lookback: str = "15 minutes",
    on_empty: str = "all",
) -> None:
    """Refresh the stored tables, one after the other: row, payment, order.

    Where to read on comes from one column of the table, as a scalar subquery; only blocks with
    fresh rows are rewritten.
    """
    for name in [n for n in TABLES if n in tables]:
        table, spec, stream = tables[name], TABLES[name], streams[name]
        table.recover()
        if table.exists():
            stream = incremental(stream, table.read(), CLOCK, lookback, on_empty)
        elif on_empty == "none":
            continue
        table.merge(latest(stream, name), guard=spec.guard, on_source_duplicates="assume_unique")


def warehouse_tables(
    spark: SparkSession,
    root: str,
    orders_per_block: int = ORDERS_PER_BLOCK,
    record_changes: bool = False,
) -> dict[str, StoredTable]:
    """The stored tables, laid out by order number."""

    def table(name: str, key: str) -> StoredTable:
        block, schema = order_block(key, orders_per_block), schemas.struct(schemas.WAREHOUSE[name])
        return StoredTable(spark, f"{root}/orderupdated_{name}", [key], block, schema, record_changes)

    return {name: table(name, t.key) for name, t in TABLES.items()}
