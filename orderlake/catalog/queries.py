"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas
from orderlake.catalog.updates import nested_folder, order_updates, table
from orderlake.functions import (
    business_key_h,
    business_key_s,
    hash_key,
    local_time,
    local_time_ms,
    stamp,
    utc_text_timestamp,
)
from orderlake.operators import aggregates, flatten, incremental, merge, quality, tables
from orderlake.operators.dedup import dedup_latest, newest_first
from orderlake.operators.stored import StoredTable, replay
from orderlake.plans import registry, warehouse
from orderlake.plans.silver import json_columns, latest_documents, silver_tables, upsert_silver
from orderlake.session import configure, delete_folder, work_path
from orderlake.sources import events as sources
from orderlake.sources import sinks
from orderlake.streaming.upsert import (
    STREAM_TABLES,
    batch_counts,
    start_ingest_stream,
    start_upsert_stream,
    trigger,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Orders placed before this day are in a target before it is refreshed.
ORDER_CUT = "1998-07-01 00:00:00"
EVENT_CUT = "2024-01-20 00:00:00"
FIRST_CUT = "2024-01-10 00:00:00"
# The fixed clock of the freshness checks.
AS_OF = "2024-01-31 00:00:00"


def naive(df: DataFrame) -> DataFrame:
    """Show zoned times as plain UTC times."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def register(name: str, fn: Query) -> None:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return naive(fn(configure(spark), sf_dir))

    QUERIES[name] = run


def query(fn: Query) -> Query:
    """Register under the function's name, less a closing `_`."""
    register(fn.__name__.rstrip("_"), fn)
    return fn


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --- inputs ----------------------------------------------------------------------------
def clock() -> Column:
    """Processing time of an update: two minutes after it was enqueued."""
    return F.col("EventEnqueuedUtcTime") + F.expr("INTERVAL 2 MINUTES")


def documents(spark: SparkSession, sf_dir: str, paths: list[str] | None = None) -> DataFrame:
    """Typed snapshot-grain events, or the fields of them that `paths` name."""
    updates = order_updates(spark, sf_dir, ["body", "EventEnqueuedUtcTime"])
    return flatten.parse_events(updates, paths)


def raw_updates(spark: SparkSession, sf_dir: str, texts: list[str] | None = None) -> DataFrame:
    """History-grain raw rows, with all JSON texts or those named."""
    unread = set() if texts is None else set(schemas.RAW_JSON_H) - set(texts)
    columns = [*schemas.struct(schemas.RAW_H).names, "o_orderkey", "v"]
    return order_updates(spark, sf_dir, [n for n in columns if n not in unread])


def keyed_raw(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """Preprocessed history-grain raw rows, with the JSON texts that the transform `name` reads."""
    texts = ["status"] if name is None else json_columns([name])
    return flatten.preprocess_bronze(raw_updates(spark, sf_dir, texts), clock())


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    fn = getattr(flatten, f"flatten_{name}_s")
    return fn(documents(spark, sf_dir, flatten.READS_S[name]), clock())


def stored_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """`stream_table` for a query that reads it more than once. Orders are a small part of the texts
    that they are parsed from, so they are written once and read as files; the other tables are
    as large as the texts, and are made again."""
    stream = stream_table(spark, sf_dir, name)
    if name != "order":
        return stream
    path = work_path(spark, "stream-order")
    stream.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(stream.schema).parquet(path)


def first_versions(stream: DataFrame) -> DataFrame:
    """What the warehouse knew at the cut: first versions of the orders placed before it."""
    event_time = "source_updated_datetime" if "row_bk" in stream.columns else "EventEnqueuedUtcTime"
    return stream.filter((F.col("status_value") == "new") & (F.col(event_time) < at(ORDER_CUT)))


def last_per_user(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Latest event per user and type."""
    rows = table(spark, sf_dir, "events")
    if until:
        rows = rows.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return dedup_latest(rows, ["user_id", "event_type"], newest_first("ts", "event_id"))


def per_block(spark: SparkSession, sf_dir: str, name: str = "orders", key: str = "o_orderkey") -> int:
    """Key values of a block: so many that there is one for 64 MB of a table, at least eight."""
    rows = table(spark, sf_dir, name)
    blocks = max(8, -(-tables.listed_bytes(rows) // (64 << 20)))
    return -(-(1 + rows.agg(F.max(key)).first()[0]) // blocks)


def _parts_of(df: DataFrame) -> int:
    """Parts of about 64 MB of a file-backed table."""
    return max(1, -(-tables.listed_bytes(df) // (64 << 20)))


def user_block(spark: SparkSession, sf_dir: str) -> Column:
    return F.floor(F.col("user_id") / per_block(spark, sf_dir, "events", "user_id"))


# --- sources and sinks -------------------------------------------------------------------
@query
def raw_scan(spark, sf_dir):
    return sources.read_table(spark, f"{sf_dir}/events.parquet").select("*")


@query
def ndjson_scan(spark, sf_dir):
    path = work_path(spark, "ndjson")
    updates = order_updates(spark, sf_dir, schemas.struct(schemas.ENVELOPE).names)
    flatten.parse_events(updates).write.option("compression", "gzip").json(path)
    return sources.read_events_json(spark, path).select(
        "orderNumber",
        "orderDate",
        F.col("status.value").alias("status_value"),
        F.array_size("buckets").alias("n_buckets"),
        "EventEnqueuedUtcTime",
        F.col("SequenceNumber").cast("long").alias("sequence_number"),
        "Offset",
        "PartitionKey",
    )


@query
def append_schema_merge(spark, sf_dir):
    path = work_path(spark, "append")
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")
    sinks.append_table(orders.filter(early).drop("o_orderpriority", "o_totalprice"), path)
    sinks.append_table(orders.filter(~early), path)
    return sinks.read_appended(spark, path)


@query
def first_load(spark, sf_dir):
    target = silver_tables(spark, work_path(spark, "first"), per_block(spark, sf_dir))["row"]
    sinks.save_or_merge(target, flatten.flatten_row_h(keyed_raw(spark, sf_dir, "row")))
    return target.read()


@query
def fanout_counts(spark, sf_dir):
    targets = silver_tables(spark, work_path(spark, "fanout"), per_block(spark, sf_dir))
    upsert_silver(raw_updates(spark, sf_dir), targets, as_of=clock(), on_source_duplicates="error")
    return aggregates.table_counts({name: t.read() for name, t in targets.items()})


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event bodies of which some are cut off, no objects, empty objects, followed by another
    object, more fields or junk, or surrounded by white space."""
    kind = F.col("o_orderkey") % 97
    body = (
        F.when(kind == 0, F.lit('{"orderNumber":'))
        .when(kind == 1, F.lit("[1]"))
        .when(kind == 2, F.lit("{}"))
        .when(kind == 3, F.lit('{"orderNumber":"3"}{"orderNumber":"4"}'))
        .when(kind == 4, F.lit('{"orderNumber":"3"} junk'))
        .when(kind == 5, F.concat(F.lit("\n\t\r "), F.col("body"), F.lit(" \n")))
        .when(kind == 6, F.lit('{"orderNumber":"3"},"y":{"orderNumber":"4"}'))
        .when(kind == 7, F.lit('{"orderNumber":"3"},"x":{"orderNumber":"4"}'))
        .when(kind == 8, F.lit('{"orderNumber":"3"}} junk'))
        .otherwise(F.col("body"))
    )
    meta = ["EventEnqueuedUtcTime", "Offset", "PartitionKey"]
    updates = order_updates(spark, sf_dir, ["body", *meta, "o_orderkey"])
    return updates.select(body.alias("body"), *meta)


@query
def dead_letter_rows(spark, sf_dir):
    path = work_path(spark, "deadletters")
    _, bad = quality.split_valid(damaged(spark, sf_dir))
    sinks.write_dead_letters(bad, path, "orderlake", "parse")
    kept = sinks.read_dead_letters(spark, path, bad.schema)
    return kept.select("body", "EventEnqueuedUtcTime", "Offset", "PartitionKey")


@query
def valid_rows(spark, sf_dir):
    good, _ = quality.split_valid(damaged(spark, sf_dir))
    return good.select(
        "orderNumber",
        F.col("status.value").alias("status_value"),
        "orderDate",
        "EventEnqueuedUtcTime",
        "Offset",
    )


@query
def dead_letter_raw(spark, sf_dir):
    """History grain: documents of which a JSON text does not convert, as a stream rejects them."""
    kind = F.col("o_orderkey") % 89
    cut = lambda name, k, text: F.when(kind == k, F.lit(text)).otherwise(F.col(name))
    raw = raw_updates(spark, sf_dir).withColumns(
        {
            "status": cut("status", 0, '{"value":'),
            "buckets": cut("buckets", 1, '[{"bucketNumber":1}'),
            "payments": cut("payments", 2, "[] junk"),
            "offers": cut("offers", 3, "urgent"),
            "total": cut("total", 3, '{"totalAmount":{}}'),
        }
    )
    behind = lambda name, k, text: F.when(kind == k, F.concat(F.coalesce(name, F.lit("[]")), F.lit(text))).otherwise(F.col(name))
    raw = raw.withColumns({"offers": behind("offers", 4, ',"y":[1]'), "payments": behind("payments", 5, ',"x":[]')})
    raw = raw.withColumn("buckets", behind("buckets", 6, "] junk"))
    path = work_path(spark, "deadletters")
    targets = silver_tables(spark, work_path(spark, "silver"), per_block(spark, sf_dir))
    upsert_silver(raw, targets, 0, clock(), dead_letters=path)
    bad = sinks.read_dead_letters(spark, f"{path}/consumer=silver/stage=parse", "orderNumber STRING, Offset STRING, broken ARRAY<STRING>")
    good = targets["order"].read().select("orderNumber", F.lit(None).cast("string").alias("Offset"), F.lit("").alias("broken"))
    return bad.select("orderNumber", "Offset", F.array_join(F.array_sort("broken"), ",").alias("broken")).union(good)


@query
def retype_rewrite(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", text)
    return sinks.rewrite_with_type(orders, "o_orderdate", "timestamp", work_path(spark, "retype"))


# --- filters -------------------------------------------------------------------------
@query
def like_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_type like 'PROMO%'")


@query
def prefix_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_name").startswith("red "))


# --- flatten ---------------------------------------------------------------------------
@query
def preprocess_bronze(spark, sf_dir):
    return keyed_raw(spark, sf_dir).select(
        "orderNumber", "orderDate", "status_value", "status_title", "updated_datetime"
    )


@query
def flatten_order(spark, sf_dir):
    return documents(spark, sf_dir).select(
        *flatten.project(
            [
                "orderNumber",
                "status.value",
                "source.isExternal",
                "invoiceAddress.firstName",
                "invoiceAddress.address.countryCode",
                "total.totalAmount",
            ]
        )
    )


def _register_flattens() -> None:
    def snapshot(name: str) -> Query:
        return lambda spark, sf_dir: stream_table(spark, sf_dir, name)

    def history(name: str) -> Query:
        return lambda spark, sf_dir: registry.apply(keyed_raw(spark, sf_dir, name), name)

    for name in warehouse.TABLES:
        register(f"flatten_{name}_s", snapshot(name))
    for name in registry.transforms():
        register(f"flatten_{name}_h", history(name))


_register_flattens()


@query
def flatten_outer(spark, sf_dir):
    parsed = documents(spark, sf_dir, flatten.READS_S["row"])
    rows = flatten.flatten_row_s(parsed, clock(), outer=True)
    return rows.select("bucket_bk", "row_bk", "orderNumber", "status_value", "BucketNumber", "RowNumber", "SKU")


@query
def sql_flatten_row(spark, sf_dir):
    documents(spark, sf_dir).createOrReplaceTempView("order_documents")
    return spark.sql(
        """
        WITH rows AS (
          SELECT d.orderNumber, d.status.value AS status_value, d.EventEnqueuedUtcTime,
                 b.bucketNumber AS BucketNumber, r
          FROM order_documents d
          LATERAL VIEW explode(d.buckets) x AS b
          LATERAL VIEW explode(b.rows) y AS r
        )
        SELECT concat(coalesce(orderNumber, ''), '_', coalesce(BucketNumber, '')) AS bucket_bk,
               concat(coalesce(orderNumber, ''), '_', coalesce(BucketNumber, ''), '_',
                      coalesce(r.rowNumber, '')) AS row_bk,
               orderNumber, status_value, BucketNumber, r.rowNumber AS RowNumber, r.sku AS SKU,
               r.name AS Name, r.orderedQuantity AS OrderedQuantity, r.totalAmount AS TotalAmount,
               EventEnqueuedUtcTime AS source_updated_datetime
        FROM rows
        """
    )


# --- keys ------------------------------------------------------------------------------
def _key_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Column]]:
    """Order columns as key parts, the middle one NULL for finished orders."""
    parts = [F.col("o_orderkey"), F.nullif("o_orderstatus", F.lit("F")), F.col("o_orderpriority")]
    return table(spark, sf_dir, "orders"), parts


@query
def business_key_h_(spark, sf_dir):
    orders, parts = _key_parts(spark, sf_dir)
    return orders.select("o_orderkey", business_key_h(*parts).alias("bk"))


@query
def business_key_s_(spark, sf_dir):
    orders, parts = _key_parts(spark, sf_dir)
    return orders.select("o_orderkey", business_key_s(*parts).alias("bk"))


@query
def hash_key_(spark, sf_dir):
    orders, parts = _key_parts(spark, sf_dir)
    return orders.select("o_orderkey", hash_key(*parts).alias("hashkey"))


# --- aggregates, sort, sets ----------------------------------------------------------
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query
def table_counts(spark, sf_dir):
    return aggregates.table_counts({n: table(spark, sf_dir, n) for n in BASE_TABLES})


@query
def high_watermark(spark, sf_dir):
    return incremental.high_watermark(table(spark, sf_dir, "events"), "ts")


@query
def status_summary(spark, sf_dir):
    groups = {"n_open": "O", "n_finished": "F", "n_partial": "P"}
    return aggregates.status_summary(table(spark, sf_dir, "orders"), "o_orderstatus", groups)


@query
def top_recent(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(1000)


# --- latest row per key ------------------------------------------------------------
@query
def dedup_latest_h(spark, sf_dir):
    """First versions arrive twice, the second time an hour earlier or an hour later."""
    updates = raw_updates(spark, sf_dir, ["status"])
    hours = F.when(F.col("o_orderkey") % 2 == 1, 1).otherwise(-1)
    again = updates.filter("v = 1").withColumns(
        {
            "EventEnqueuedUtcTime": F.col("EventEnqueuedUtcTime") + F.make_dt_interval(hours=hours),
            "Offset": F.concat(F.lit("again-"), F.col("Offset")),
        }
    )
    latest = latest_documents(updates.union(again), clock())
    return latest.select("orderNumber", "status_value", "orderDate", "EventEnqueuedUtcTime", "Offset")


@query
def dedup_latest_events(spark, sf_dir):
    return last_per_user(spark, sf_dir)


def _register_per_warehouse_table() -> None:
    def latest(name: str) -> Query:
        return lambda spark, sf_dir: warehouse.latest(stream_table(spark, sf_dir, name), name)

    def newer(name: str) -> Query:
        def run(spark, sf_dir):
            spec, stream = warehouse.TABLES[name], stored_stream(spark, sf_dir, name)
            # Rows in the target alone, in the source alone, and in both: the source's older,
            # equal or newer, and told apart by its status.
            order = F.substring_index(spec.key, "_", 1).cast("bigint")
            older = F.col(spec.event_time) - F.expr("INTERVAL 10 DAYS")
            target = warehouse.latest(first_versions(stream).filter(order % 7 != 0), name)
            source = warehouse.latest(stream.filter(order % 5 != 0), name).withColumns(
                {
                    "status_value": F.lit("again"),
                    spec.event_time: F.when(order % 3 == 0, older).otherwise(F.col(spec.event_time)),
                }
            )
            return merge.merge_upsert(
                target, source, [spec.key], spec.guard, on_source_duplicates="assume_unique"
            )

        return run

    def refreshed(name: str) -> Query:
        def run(spark, sf_dir):
            stream = stored_stream(spark, sf_dir, name)
            root = work_path(spark, "warehouse")
            stored = warehouse.warehouse_tables(spark, root, per_block(spark, sf_dir))[name]
            stored.merge(warehouse.latest(first_versions(stream), name), on_source_duplicates="assume_unique")
            warehouse.warehouse_refresh({name: stream}, {name: stored})
            return stored.read()

        return run

    for name in warehouse.TABLES:
        register(f"dedup_latest_{name}_s", latest(name))
        register(f"merge_newer_{name}", newer(name))
        register(f"warehouse_refresh_{name}", refreshed(name))


_register_per_warehouse_table()


# --- upsert, incremental, changes -----------------------------------------------------
@query
def merge_update_all(spark, sf_dir):
    orders = flatten.flatten_order_h(keyed_raw(spark, sf_dir, "order"))
    known = orders.filter((F.col("status_value") == "new") & (F.col("orderDate") < at(ORDER_CUT)))
    outdated = known.withColumn("fraudStatus_value", F.lit("pending"))
    source = orders.filter(F.col("orderNumber").cast("bigint") % 5 != 0)
    return merge.merge_upsert(outdated, source, ["order_hashkey"], on_source_duplicates="error")


@query
def merge_condition(spark, sf_dir):
    before, after = last_per_user(spark, sf_dir, EVENT_CUT), last_per_user(spark, sf_dir)
    return merge.merge_upsert(
        before, after, ["user_id", "event_type"], "t.value <= s.value", "assume_unique"
    )


@query
def merge_broadcast_source(spark, sf_dir):
    before, after = last_per_user(spark, sf_dir, EVENT_CUT), last_per_user(spark, sf_dir)
    older = F.when(F.col("user_id") % 3 == 0, F.col("ts") - F.expr("INTERVAL 60 DAYS"))
    after = after.filter("user_id % 5 <> 0").withColumn("ts", F.coalesce(older, "ts"))
    staged = work_path(spark, "merge-source")
    after.write.parquet(staged)
    return merge.merge_upsert(
        before,
        spark.read.parquet(staged),
        ["user_id", "event_type"],
        "t.ts < s.ts",
        "assume_unique",
        strategy="auto",
    )


@query
def merge_null_keys(spark, sf_dir):
    """Click events have no key here, so each of them is kept and each is inserted again."""
    before, after = last_per_user(spark, sf_dir, EVENT_CUT), last_per_user(spark, sf_dir)
    hidden = F.nullif("event_type", F.lit("click"))
    before, after = (d.withColumn("event_type", hidden) for d in (before, after))
    return merge.merge_upsert(
        before, after, ["user_id", "event_type"], "t.ts < s.ts", "error", null_keys="insert"
    )


@query
def incremental_lookback(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    target = events.filter(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz"))
    return incremental.incremental(events, target, "ts", "15 minutes")


@query
def incremental_strict(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    target = events.filter(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz"))
    return incremental.incremental(events, target, "ts", "0 minutes")


@query
def incremental_empty_target(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    target = spark.createDataFrame([], events.schema)
    loads = {
        mode: incremental.incremental(events, target, "ts", on_empty=mode) for mode in ("none", "all")
    }
    return aggregates.table_counts(loads).withColumnRenamed("table_name", "on_empty")


@query
def change_feed(spark, sf_dir):
    before, after = last_per_user(spark, sf_dir, EVENT_CUT), last_per_user(spark, sf_dir)
    source = merge.delete_where(after, "event_type = 'signup'")
    keys = ["user_id", "event_type"]
    return merge.merge_changes(before, source, keys, "t.ts < s.ts", "t.event_type = 'signup'", version=2)


@query
def state_changes(spark, sf_dir):
    """The same changes, from the two states alone."""
    before, after = last_per_user(spark, sf_dir, EVENT_CUT), last_per_user(spark, sf_dir)
    kept = merge.delete_where(after, "event_type = 'signup'")
    return merge.read_changes(before, kept, ["user_id", "event_type"], version=2)


def _recorded(spark: SparkSession, sf_dir: str) -> StoredTable:
    """Latest events per user and type, stored up to two days and then to the end, and the sign-ups
    deleted: four versions of recorded changes."""
    keys = ["user_id", "event_type"]
    stored = StoredTable(spark, work_path(spark, "recorded"), keys, user_block(spark, sf_dir), record_changes=True)
    for until in (FIRST_CUT, EVENT_CUT, None):
        stored.merge(last_per_user(spark, sf_dir, until), "t.ts < s.ts", "assume_unique")
    stored.delete("event_type = 'signup'")
    return stored


@query
def change_feed_recorded(spark, sf_dir):
    changes = _recorded(spark, sf_dir).changes(since=2)
    return changes.groupBy("_commit_version", "_change_type", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def change_feed_replayed(spark, sf_dir):
    """The first state, and the changes since then, give the last one."""
    changes = _recorded(spark, sf_dir).changes(since=2)
    return replay(last_per_user(spark, sf_dir, FIRST_CUT), changes, ["user_id", "event_type"])


@query
def delete_stored(spark, sf_dir):
    """Finished orders of the first quarter of all order numbers leave a stored table."""
    block = F.floor(F.col("o_orderkey") / per_block(spark, sf_dir))
    stored = StoredTable(spark, work_path(spark, "delete"), ["o_orderkey"], block)
    orders = table(spark, sf_dir, "orders")
    stored.merge(orders)
    quarter = orders.agg(F.max("o_orderkey")).first()[0] // 4
    stored.delete(f"nullif(o_orderstatus, 'P') = 'F' AND o_orderkey <= {quarter}")
    return stored.read()


@query
def stored_upsert_recent(spark, sf_dir):
    """The latest tenth of all orders comes again, with another priority: rows of each block, and
    whether its files are still those of the first load."""
    orders = table(spark, sf_dir, "orders")
    size = -(-(1 + orders.agg(F.max("o_orderkey")).first()[0]) // 8)
    block = F.floor(F.col("o_orderkey") / size)
    stored = StoredTable(spark, work_path(spark, "recent"), ["o_orderkey"], block)
    stored.merge(orders)
    file = F.regexp_extract("_metadata.file_path", "[^/]+$", 0)
    files = lambda: spark.read.parquet(stored.path).select("*", file.alias("file"))
    before = [r["file"] for r in files().select("file").distinct().collect()]
    recent = orders.filter(F.col("o_orderkey") >= size * 8 * 9 // 10).withColumn("o_orderpriority", F.lit("late"))
    stored.merge(recent, on_source_duplicates="assume_unique")
    late = F.count_if(F.col("o_orderpriority") == "late").alias("n_late")
    kept = F.min(F.col("file").isin(before)).alias("kept")
    return files().groupBy(F.col("block").cast("long").alias("block")).agg(F.count(F.lit(1)).alias("n"), late, kept)


@query
def delete_where(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return merge.delete_where(orders, "nullif(o_orderstatus, 'P') = 'F'")


# --- scalar functions --------------------------------------------------------------------
def _order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times spread over the minutes of the day, so that clock changes are met."""
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    orders = table(spark, sf_dir, "orders")
    at_minute = (F.col("o_orderdate").cast("timestamp") + minutes).alias("at")
    return orders.select("o_orderkey", "o_orderstatus", at_minute)


@query
def json_struct(spark, sf_dir):
    parsed = F.from_json("props", "k INT")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query
def local_time_(spark, sf_dir):
    text = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _order_times(spark, sf_dir).select("o_orderkey", local_time(text).alias("local"))


@query
def local_time_roundtrip(spark, sf_dir):
    text = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    again = local_time(F.to_utc_timestamp(text, "UTC"))
    return _order_times(spark, sf_dir).select("o_orderkey", again.alias("local"))


@query
def local_time_ms_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", local_time_ms(F.col("ts").cast("timestamp")).alias("local"))


@query
def parse_timestamp(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return _order_times(spark, sf_dir).select("o_orderkey", F.try_to_timestamp(text).alias("parsed"))


@query
def utc_text_timestamp_(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select("event_id", utc_text_timestamp(text).alias("at"))


@query
def cast_matrix(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_id").cast("string").alias("id_text"),
        text.cast("timestamp").alias("ts_zoned"),
        text.cast("date").alias("day"),
        F.col("value").cast("string").cast("double").alias("value_again"),
        F.col("user_id").cast("string").cast("int").alias("user_int"),
    )


# --- streaming -----------------------------------------------------------------------
@query
def stream_ingest_rows(spark, sf_dir):
    root, events = work_path(spark, "ingest"), table(spark, sf_dir, "events")
    events.repartitionByRange(4, "ts").write.parquet(f"{root}/in")
    stream = sources.read_events(spark, f"{root}/in", events.schema, max_files_per_trigger=2)
    sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(**trigger()).start(f"{root}/out").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/out")


def _silver_runs(spark: SparkSession, sf_dir: str, name: str, landings: list[tuple[DataFrame, str]]) -> DataFrame:
    """A silver table after its stream ran once for each landing: rows, and the checkpoint's name.
    Runs with one checkpoint share a landing folder."""
    root = work_path(spark, "stream")
    for rows, checkpoint in landings:
        rows.write.mode("append").option("compression", "zstd").parquet(f"{root}/in-{checkpoint}")
        start_upsert_stream(
            spark,
            f"{root}/in-{checkpoint}",
            f"{root}/silver",
            f"{root}/{checkpoint}",
            as_of=clock(),
            orders_per_block=per_block(spark, sf_dir),
            names=[name],
        ).awaitTermination()
    return silver_tables(spark, f"{root}/silver")[name].read()


def _changed_later(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All documents, then a third of them again in another currency: the second batch merges."""
    updates = raw_updates(spark, sf_dir)
    changed = updates.filter("o_orderkey % 3 = 0").withColumn("currency", F.lit("XXX"))
    return _silver_runs(spark, sf_dir, name, [(updates, "cp"), (changed, "cp")])


def _landing_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of a landing of all documents: four, or one for 64 MB of nested orders if these are more.
    As a batch takes so many files, it is bounded by them."""
    return max(4, _parts_of(spark.read.parquet(nested_folder(spark, sf_dir))))


def _land_bodies(spark: SparkSession, sf_dir: str, folder: str, files: int | None = None) -> None:
    """Append all event bodies, some of them damaged, to a landing folder."""
    bodies = damaged(spark, sf_dir).withColumn("SequenceNumber", F.col("Offset").cast("decimal(20,0)"))
    landed = bodies.coalesce(files) if files else bodies
    landed.write.mode("append").option("compression", "zstd").parquet(folder)


@query
def stream_ingest_tables(spark, sf_dir):
    """Event bodies, some of them damaged, through the ingest stream into the row table."""
    root = work_path(spark, "bodies")
    _land_bodies(spark, sf_dir, f"{root}/in")
    start_ingest_stream(
        spark, f"{root}/in", root, f"{root}/checkpoint", max_files_per_trigger=4, as_of=clock()
    ).awaitTermination()
    return sinks.read_appended(spark, f"{root}/{STREAM_TABLES['row'][1]}")


@query
def stream_replayed_events(spark, sf_dir):
    """The events arrive twice, in different batches, and a third time after a restart."""
    root = work_path(spark, "replayed")
    files = _landing_files(spark, sf_dir)
    for times in (2, 1):
        for _ in range(times):
            _land_bodies(spark, sf_dir, f"{root}/in", files)
        start_ingest_stream(
            spark, f"{root}/in", root, f"{root}/checkpoint", max_files_per_trigger=4, as_of=clock()
        ).awaitTermination()
    return sinks.read_appended(spark, f"{root}/{STREAM_TABLES['row'][1]}")


@query
def stream_batch_counts(spark, sf_dir):
    """What the batches of an ingest stream report of themselves, summed up."""
    root = work_path(spark, "counted")
    _land_bodies(spark, sf_dir, f"{root}/in", _landing_files(spark, sf_dir))
    running = start_ingest_stream(spark, f"{root}/in", root, f"{root}/checkpoint", max_files_per_trigger=1)
    running.awaitTermination()
    counts = spark.createDataFrame(batch_counts(running), "batch_id LONG, n_events LONG, n_valid LONG, n_rejected LONG")
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns[1:]])


@query
def stream_admission(spark, sf_dir):
    """Six files, two for each batch, which then go to an archive: rows of the batches."""
    root, events = work_path(spark, "admission"), table(spark, sf_dir, "events")
    for i in range(6):
        events.filter(F.col("event_id") % 6 == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = sources.read_events(spark, f"{root}/in", events.schema, max_files_per_trigger=2, archive_dir=f"{root}/archive")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    sink = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(**trigger()).start().awaitTermination()
    batches = spark.read.parquet(f"{root}/out/*").groupBy("batch_id", (F.col("event_id") % 6).alias("file"))
    return batches.agg(F.count(F.lit(1)).alias("n"))


@query
def stream_repeating(spark, sf_dir):
    """A stream that repeats its batches until it is stopped; files arrive while it runs."""
    root, events = work_path(spark, "repeating"), table(spark, sf_dir, "events")
    later = F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp_ntz")
    events.filter(~later).coalesce(2).write.parquet(f"{root}/in")
    stream = sources.read_events(spark, f"{root}/in", events.schema)
    sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    running = sink.trigger(**trigger("1 second")).start(f"{root}/out")
    try:
        running.processAllAvailable()
        events.filter(later).coalesce(2).write.mode("append").parquet(f"{root}/in")
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(events.schema).parquet(f"{root}/out")


@query
def stream_upsert_order(spark, sf_dir):
    return _changed_later(spark, sf_dir, "order")


@query
def stream_upsert_row(spark, sf_dir):
    return _changed_later(spark, sf_dir, "row")


@query
def stream_restart(spark, sf_dir):
    """The second run finds its checkpoint and adds nothing; after a reset the stream begins
    with a new checkpoint, and what arrives then must not be taken for batches already seen."""
    updates = raw_updates(spark, sf_dir)
    early, late = updates.filter("o_orderkey % 4 <> 1"), updates.filter("o_orderkey % 4 = 1")
    return _silver_runs(spark, sf_dir, "payment", [(early, "cp"), (early.limit(0), "cp"), (late, "reset")])


def _late_merge(spark: SparkSession, sf_dir: str, shift: str) -> DataFrame:
    """Stored orders, then all first versions again under another status and enqueue time."""
    orders = stored_stream(spark, sf_dir, "order")
    target = warehouse.latest(orders, "order")
    again = orders.filter(F.col("status_value") == "new").withColumns(
        {
            "EventEnqueuedUtcTime": F.col("EventEnqueuedUtcTime") + F.expr(f"INTERVAL {shift}"),
            "status_value": F.lit("late"),
        }
    )
    spec = warehouse.TABLES["order"]
    source = warehouse.latest(again, "order")
    state = merge.merge_upsert(
        target, source, [spec.key], spec.guard, on_source_duplicates="assume_unique"
    )
    return state.select("order_bk", "status_value", "EventEnqueuedUtcTime", "total_totalAmount")


@query
def late_event_ignored(spark, sf_dir):
    return _late_merge(spark, sf_dir, "-1 HOUR")


@query
def late_event_applied(spark, sf_dir):
    return _late_merge(spark, sf_dir, "1 HOUR")


@query
def replay_idempotent(spark, sf_dir):
    """The same source merged twice into a stored table gives the state after one merge."""
    keys = ["user_id", "event_type"]
    stored = StoredTable(spark, work_path(spark, "replay"), keys, user_block(spark, sf_dir))
    stored.merge(last_per_user(spark, sf_dir, EVENT_CUT))
    for _ in range(2):
        stored.merge(last_per_user(spark, sf_dir), "t.ts < s.ts", "assume_unique")
    return stored.read()


# --- quality and table care ---------------------------------------------------------
def _aged_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Events by type, and two tables that are long out of date."""
    events = table(spark, sf_dir, "events").withColumn("updated", F.col("ts").cast("timestamp"))
    checked = {
        f"events_{t}": events.filter(F.col("event_type") == t) for t in ("click", "error", "view")
    }
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    checked["orders"] = orders.withColumn("updated", F.col("o_orderdate").cast("timestamp"))
    checked["lineitem"] = lines.withColumn("updated", F.col("l_shipdate").cast("timestamp"))
    return checked


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(_aged_tables(spark, sf_dir), "updated", at(AS_OF), "36 hours")


@query
def freshness_counts(spark, sf_dir):
    return _freshness(spark, sf_dir)


@query
def freshness_failures(spark, sf_dir):
    return quality.freshness_failures(_freshness(spark, sf_dir))


@query
def add_columns(spark, sf_dir):
    added = "o_orderstatus STRING, source_name STRING, source_isExternal BOOLEAN, discount DOUBLE"
    return quality.evolve(table(spark, sf_dir, "orders"), added)


@query
def compact_preserves(spark, sf_dir):
    path = work_path(spark, "compact")
    return tables.compact(
        table(spark, sf_dir, "lineitem"), path, 256 * 1024, ["l_shipdate", "l_orderkey"]
    )


@query
def compact_small_files(spark, sf_dir):
    """A partitioned table: of two flags, folders with many small files, and of one, folders with a
    single file, which keeps its name. A folder holds a block of a flag's rows, about 64 MB of all
    lines, so that no task has to write a flag's rows alone. Files are counted by folder."""
    path, lines = work_path(spark, "small"), table(spark, sf_dir, "lineitem")
    blocks = _parts_of(lines)
    row = F.xxhash64(*lines.columns)
    lines = lines.withColumn("block", F.pmod(row, F.lit(blocks)).cast("int"))
    many = F.col("l_returnflag") != "R"
    # Ranges end between blocks or within one: each block is dealt over about six files, or one.
    by_flag = lambda df, n, *by: df.repartitionByRange(n, *by).write.mode("append").partitionBy("l_returnflag", "block")
    by_flag(lines.filter(many), 6 * blocks, "block", row).parquet(path)
    by_flag(lines.filter(~many), blocks, "block").parquet(path)
    name = F.regexp_extract("path", "[^/]+$", 0)

    def files() -> DataFrame:
        where = F.col("_metadata.file_path").alias("path")  # names are cut out of a path a file, not a row
        found = spark.read.parquet(path).groupBy("l_returnflag", "block", where).count()
        return found.withColumn("file", name)

    before = {r["file"] for r in files().collect()}
    tables.compact_files(spark, path)
    kept = F.max(F.col("file").isin(list(before)).cast("int")).alias("kept")
    folders = files().groupBy("l_returnflag", "block").agg(F.sum("count").alias("n_rows"), F.count("file").alias("n_files"), kept)
    return folders.groupBy("l_returnflag").agg(F.sum("n_rows").alias("n_rows"), F.max("n_files").alias("n_files"), F.max("kept").alias("kept"))


@query
def table_detail(spark, sf_dir):
    """Files and rows of a table that has one file for each ship mode."""
    path, parts = work_path(spark, "detail"), work_path(spark, "detail-parts")
    # Split by mode first, where the rows lie: then the task that writes a mode's file reads no other
    # rows, and passes them on one by one, without a shuffle or a sort.
    table(spark, sf_dir, "lineitem").write.partitionBy("l_returnflag").option("compression", "zstd").parquet(parts)
    for folder in tables.partition_folders(spark, parts):
        rows = spark.read.parquet(folder)
        rows.coalesce(1).write.parquet(f"{path}/{folder.rpartition('/')[2]}")
    delete_folder(spark, parts)
    return tables.table_detail(spark.read.parquet(path)).select("num_files", "num_rows")


def _in_database(spark: SparkSession, work: Callable[[str, str], DataFrame]) -> DataFrame:
    """The result of `work(database, folder)`, stored before the new database is dropped."""
    name, path = f"care_{uuid.uuid4().hex}", work_path(spark, "care")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/db'")
    try:
        work(name, path).write.parquet(f"{path}/result")
        return spark.read.parquet(f"{path}/result")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query
def evolve_stored_table(spark, sf_dir):
    """Columns are added to a stored table; then rows come that fill them. Old rows read NULL."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    early = F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")

    def work(database: str, path: str) -> DataFrame:
        stored = f"{database}.orders"
        orders.filter(early).drop("o_orderpriority").write.option("path", f"{path}/orders").saveAsTable(stored)
        tables.add_stored_columns(spark, stored, "O_ORDERSTATUS STRING, o_orderpriority STRING, isExternal BOOLEAN")
        orders.filter(~early).withColumn("isExternal", F.col("o_orderkey") % 2 == 0).write.insertInto(stored)
        return spark.table(stored)

    return _in_database(spark, work)


@query
def catalog_listing(spark, sf_dir):
    """Tables of a database by prefix, with those properties whose names match a pattern."""

    def work(database: str, path: str) -> DataFrame:
        found = []
        for name in ("orders", "orders_old", "lineitem"):
            rows = table(spark, sf_dir, name.split("_")[0])
            rows.write.option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}")
            n = rows.count()
            spark.sql(f"ALTER TABLE {database}.{name} SET TBLPROPERTIES ('load.rows' = '{n}', 'load.source' = '{name}', 'owner.team' = 'x')")
        for r in tables.tables_like(spark, database, "orders").collect():
            own = tables.table_properties(spark, f"{database}.{r['table_name']}", "load.%")
            found.append(own.select(F.lit(r["table_name"]).alias("table_name"), "key", "value"))
        return aggregates.union_all(found)

    return _in_database(spark, work)


@query
def compact_matching_tables(spark, sf_dir):
    """Two tables of a database, one partitioned, before and after compaction: the same rows."""
    name, path = f"compact_{uuid.uuid4().hex}", work_path(spark, "tables")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/db'")
    try:
        orders = table(spark, sf_dir, "orders")
        orders = orders.repartition(max(6, _parts_of(orders)))
        orders.write.option("path", f"{path}/o").saveAsTable(f"{name}.orders_flat")
        by_status = orders.write.partitionBy("o_orderstatus").option("path", f"{path}/p")
        by_status.saveAsTable(f"{name}.orders_by_status")
        results = tables.compact_tables(spark, name, "orders", f"{path}/new")
        results = results.select("table_name", "status")
        read = [
            spark.table(f"{name}.{t}").select(F.lit(t).alias("table_name"), "o_orderkey", "o_orderstatus", F.col("_metadata.file_path").contains("/new/").alias("moved"))
            for t in ("orders_flat", "orders_by_status")
        ]
        rows = read[0].union(read[1]).join(F.broadcast(results), "table_name")
        rows.write.parquet(f"{path}/result")
        return spark.read.parquet(f"{path}/result")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query
def empty_batch(spark, sf_dir):
    """An empty batch neither creates a table nor changes one."""
    events = table(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / per_block(spark, sf_dir, "events", "event_id"))
    target = StoredTable(spark, work_path(spark, "empty"), ["event_id"], block)
    steps = [sinks.save_or_merge(target, df) for df in (events.limit(0), events, events.limit(0))]
    return target.read().withColumn("steps", F.lit(",".join(map(str, steps))))


@query
def raised_error(spark, sf_dir):
    """The error of the freshness check, as a row for each stale table that it names."""
    try:
        message = quality.assert_fresh(_freshness(spark, sf_dir)).first()["result"]
    except PySparkException as e:
        found = re.search("no fresh records in tables: ([a-z_, ]+)", str(e))
        message = found[1].strip() if found else str(e)
    events = table(spark, sf_dir, "events").groupBy("event_type").count()
    return events.withColumn("message", F.lit(message))


@query
def freshness_script(spark, sf_dir):
    """The same check as a SQL script, of all tables and then of those that it did not name."""
    tables_ = _aged_tables(spark, sf_dir)
    for name, df in tables_.items():
        df.createOrReplaceTempView(name)

    def verdict(names: list[str]) -> str:
        script = quality.freshness_script(names, "updated", f"TIMESTAMP '{AS_OF}'", "36 HOURS")
        try:
            return spark.sql(script).first()["result"]
        except PySparkException as e:
            found = re.search("no fresh records in tables: ([a-z_, ]+)", str(e))
            return found[1].strip() if found else str(e)

    try:
        stale = verdict(list(tables_))
        fresh = verdict([n for n in tables_ if n not in stale.split(", ")])
    finally:
        for name in tables_:
            spark.catalog.dropTempView(name)
    counts = table(spark, sf_dir, "events").groupBy("event_type").count()
    return counts.withColumns({"stale": F.lit(stale), "others": F.lit(fresh)})


@query
def processing_stamp(spark, sf_dir):
    """One processing time for all rows of a query, not before the query began."""
    began = spark.sql("SELECT now()").first()[0]
    stamped = table(spark, sf_dir, "events").withColumn("at", stamp())
    one, later = F.count_distinct("at").alias("n_stamps"), (F.min("at") >= F.lit(began)).alias("is_now")
    return stamped.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), one, later)


@query
def contract_check(spark, sf_dir):
    """Warehouse rows in their declared layout: column by column, name, type and filled rows."""
    rows = warehouse.latest(stream_table(spark, sf_dir, "payment"), "payment")
    checked = quality.check_schema(rows, schemas.struct(schemas.WAREHOUSE["payment"]))
    counts = checked.agg(*[F.count(c).alias(c) for c in checked.columns])
    each = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("kind"), F.col(f.name).alias("filled"))
        for i, f in enumerate(checked.schema)
    ]
    return counts.select(F.explode(F.array(*each)).alias("c")).select("c.*")
