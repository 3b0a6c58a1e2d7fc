"""History-grain batch: preprocess, keep the latest document per order and status, fan out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.functions import stamp
from orderlake.operators.dedup import dedup_latest, dedup_latest_stored, newest_first, repeated_hashes
from orderlake.operators.flatten import ORDER_KEY_H, READS_H, parse_raw, preprocess_bronze
from orderlake.operators.merge import has_null_key
from orderlake.operators.quality import broken_documents, parse_checked_raw, whole_documents
from orderlake.operators.stored import ORDERS_PER_BLOCK, StoredTable, order_block
from orderlake.operators.tables import listed_bytes
from orderlake.plans.registry import transforms
from orderlake.session import kept
from orderlake.sources.sinks import fan_out, save_or_merge, write_dead_letters

# The order's own date decides; enqueue time and sequence number settle ties.
LATEST = ("orderDate", "EventEnqueuedUtcTime", "SequenceNumber")


def latest_documents(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Newest raw document per order and status. Only `status` is parsed before the shuffle."""
    keyed = preprocess_bronze(raw, as_of)
    return dedup_latest(keyed, list(ORDER_KEY_H), _newest(keyed))


def _newest(keyed: DataFrame) -> list[Column]:
    return newest_first(*[c for c in LATEST if c in keyed.columns])


def silver_tables(
    spark: SparkSession, root: str, orders_per_block: int = ORDERS_PER_BLOCK, record_changes: bool = False
) -> dict[str, StoredTable]:
    """A stored table per registered transform, laid out by the order number its business key
    (`<name>_bk`) starts with. Columns are what the transform makes of a raw document."""
    documents = parse_raw(preprocess_bronze(spark.createDataFrame([], schemas.RAW_H)))

    def table(name: str) -> StoredTable:
        t = transforms()[name]
        schema = t.fn(documents).schema if name in READS_H else None
        block = order_block(f"{name}_bk", orders_per_block)
        return StoredTable(spark, f"{root}/{t.table}", t.keys, block, schema, record_changes)

    return {name: table(name) for name in transforms()}


def json_columns(names: list[str]) -> list[str] | None:
    """JSON text columns that the transforms called `names` read; None for all."""
    if any(n not in READS_H for n in names):
        return None
    return sorted({"status"} | {path.split(".")[0] for n in names for path in READS_H[n]})


def upsert_silver(
    raw: DataFrame,
    tables: dict[str, StoredTable],
    batch_id: int | None = None,
    as_of: Column | None = None,
    on_source_duplicates: str = "latest",
    writer: str = "silver",
    dead_letters: str | None = None,
) -> None:
    """Upsert one raw batch into the silver tables. Each JSON text is parsed once, and the batch is
    kept as files. Whole documents or child rows are shuffled to find the latest only where a key
    occurs twice.

    Documents with a JSON text that does not convert are left out before anything else, so they
    hide no older good document. A document may hold one child key twice. "latest" stores the
    child that is largest by its columns; "error" stores all of them on the first load and
    fails on a later merge. With `dead_letters`, a folder, both kinds of rejected rows are kept
    there: broken documents under stage `parse`, children under `duplicate_<table>`.
    """
    # One processing time for all tables.
    checked = parse_checked_raw(raw, json_columns(list(tables))).withColumn("_stamp", stamp(as_of))
    known = transforms()

    def write(name: str, rows: DataFrame) -> None:
        table, keys = tables[name], known[name].keys
        tie_break = [F.col(c).desc_nulls_last() for c in rows.columns if c not in keys]

        def save(rows: DataFrame, mode: str, **layout: bool) -> None:
            save_or_merge(table, rows, on_source_duplicates=mode, order_by=tie_break, **layout)

        def reject(losers: DataFrame) -> None:
            write_dead_letters(losers, dead_letters, "silver", f"duplicate_{name}", batch_id, writer)

        if not dead_letters or on_source_duplicates != "latest":
            return save(rows, on_source_duplicates, in_files=True)
        if repeated_hashes(rows.filter(~has_null_key(keys)), keys).isEmpty():
            reject(rows.limit(0))
            return save(rows, "assume_unique", in_files=True)
        # Ranked once: the first of each key is stored, the others are kept beside.
        with kept(table.ranked(rows, tie_break, listed_bytes(rows)), "ranked") as ranked:
            reject(ranked.filter("_nth > 1").drop("_nth"))
            save(ranked.filter("_nth = 1").drop("_nth"), "assume_unique", in_files=True, in_blocks=True)

    with kept(checked, "checked") as rows:
        if dead_letters:
            broken = broken_documents(rows).drop("_stamp")
            write_dead_letters(broken, dead_letters, "silver", "parse", batch_id, writer)
        keyed = preprocess_bronze(whole_documents(rows), F.col("_stamp")).drop("_stamp")
        documents, as_read = dedup_latest_stored(keyed, list(ORDER_KEY_H), _newest(keyed))
        fan_out(documents, {name: known[name].fn for name in tables}, write, in_files=as_read)
