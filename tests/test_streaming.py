import json
import os
import shutil
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators.flatten import READS_S, flatten_order_s, parse_events
from orderlake.plans import silver, warehouse
from orderlake.sources.events import read_events
from orderlake.sources.sinks import read_appended, read_dead_letters
from orderlake.streaming import upsert

T0 = datetime(2025, 9, 18, 6)


def document(number, status, **more):
    return {
        "orderNumber": str(number),
        "orderDate": "2025-09-18T06:05:10Z",
        "status": {"value": status},
        "payments": [{"title": "Card", "amount": 1.0}],
        "buckets": [{"bucketNumber": 1, "rows": [{"rowNumber": 1, "sku": "A"}, {"rowNumber": 2, "sku": "B"}]}],
        **more,
    }


def land_raw(spark, folder, docs, sequence=0):
    """One landing file of raw history-grain rows."""
    names = schemas.struct(schemas.RAW_H).names

    def row(i, d):
        values = {k: json.dumps(v) if k in schemas.RAW_JSON_H else v for k, v in d.items()}
        values |= {"EventEnqueuedUtcTime": T0 + timedelta(minutes=sequence + i), "SequenceNumber": Decimal(sequence + i)}
        return tuple(values.get(n) for n in names)

    data = [row(i, d) for i, d in enumerate(docs)]
    spark.createDataFrame(data, schemas.RAW_H).coalesce(1).write.mode("append").parquet(folder)


def land_bodies(spark, folder, bodies, sequence=0):
    data = [
        (b, T0 + timedelta(minutes=sequence + i), Decimal(sequence + i), str(sequence + i), "p")
        for i, b in enumerate(bodies)
    ]
    spark.createDataFrame(data, schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(folder)


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_silver_stream_upserts_and_continues_from_its_checkpoint(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "cp"))
    options = {"names": ["order", "row"]}
    land_raw(spark, source, [document(1, "new"), document(2, "new"), document(1, "new", salesBrand="later")])
    run(upsert.start_upsert_stream(spark, source, target, checkpoint, **options))
    tables = silver.silver_tables(spark, target)
    assert rows(tables["order"].read(), "order_bk", "salesBrand") == [("1_new", "later"), ("2_new", None)]
    assert tables["row"].read().count() == 4
    assert not tables["payment"].exists()

    # nothing new: nothing is written
    run(upsert.start_upsert_stream(spark, source, target, checkpoint, **options))

    # the last batch wins, an order is kept once per status
    land_raw(spark, source, [document(2, "new", salesBrand="changed"), document(2, "sent")], 10)
    run(upsert.start_upsert_stream(spark, source, target, checkpoint, **options))
    assert rows(tables["order"].read(), "order_bk", "salesBrand") == [
        ("1_new", "later"), ("2_new", "changed"), ("2_sent", None),
    ]


def test_files_per_batch_are_limited(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "cp"))
    for i in range(3):
        land_raw(spark, source, [document(i, "new")], i)
    query = run(
        upsert.start_upsert_stream(spark, source, target, checkpoint, max_files_per_trigger=1, names=["order"])
    )
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    stored = silver.silver_tables(spark, target)["order"]
    assert stored.read().count() == 3


def test_batches_are_planned_adaptively(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    land_raw(spark, source, [document(1, "new")])
    stream = spark.readStream.schema(schemas.RAW_H).parquet(source)
    run(
        upsert.start_batches(
            stream,
            lambda batch, *_: seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled")),
            str(tmp_path / "cp"),
        )
    )
    assert seen == ["true"]


def test_replayed_batch_repairs_only_what_is_missing(spark, tmp_path):
    source = str(tmp_path / "in")
    land_raw(spark, source, [document(1, "new")])
    raw = spark.read.schema(schemas.RAW_H).parquet(source)
    tables = silver.silver_tables(spark, str(tmp_path / "silver"))
    first = {"order": tables["order"]}
    silver.upsert_silver(raw, first, batch_id=0, writer="s")
    # the same batch again, after a failure before the other tables were written
    silver.upsert_silver(raw, tables, batch_id=0, writer="s")
    assert tables["row"].read().count() == 2
    silver.upsert_silver(raw.limit(0), tables, batch_id=1, writer="s")


def test_repeated_child_keys(spark, tmp_path):
    source = str(tmp_path / "in")
    buckets = [{"bucketNumber": 1, "rows": [{"rowNumber": 1, "sku": "A"}, {"rowNumber": 1, "sku": "B"}]}]
    land_raw(spark, source, [document(1, "new", buckets=buckets)])
    raw = spark.read.schema(schemas.RAW_H).parquet(source)
    kept = silver.silver_tables(spark, str(tmp_path / "latest"))
    silver.upsert_silver(raw, {"row": kept["row"]})
    assert rows(kept["row"].read(), "SKU") == [("B",)]
    every = silver.silver_tables(spark, str(tmp_path / "error"))
    silver.upsert_silver(raw, {"row": every["row"]}, on_source_duplicates="error")
    assert every["row"].read().count() == 2
    with pytest.raises(Exception, match="several source rows"):
        silver.upsert_silver(raw, {"row": every["row"]}, on_source_duplicates="error")


def test_a_reset_checkpoint_loses_nothing(spark, tmp_path):
    source, again, target = (str(tmp_path / n) for n in ("in", "again", "silver"))
    options = {"names": ["order"]}
    land_raw(spark, source, [document(1, "new")])
    run(upsert.start_upsert_stream(spark, source, target, str(tmp_path / "cp"), **options))
    land_raw(spark, again, [document(2, "new")])
    run(upsert.start_upsert_stream(spark, again, target, str(tmp_path / "cp2"), **options))
    tables = silver.silver_tables(spark, target)
    assert rows(tables["order"].read(), "order_bk") == [("1_new",), ("2_new",)]
    # the same folder name for the checkpoint, emptied in between
    third = str(tmp_path / "third")
    land_raw(spark, third, [document(3, "new")])
    shutil.rmtree(tmp_path / "cp2")
    run(upsert.start_upsert_stream(spark, third, target, str(tmp_path / "cp2"), **options))
    assert rows(tables["order"].read(), "order_bk") == [("1_new",), ("2_new",), ("3_new",)]


def test_two_ingest_streams_share_tables(spark, tmp_path):
    target = str(tmp_path / "stream")
    for i, bad in ((1, "[1]"), (2, "[2]")):
        source = str(tmp_path / f"in{i}")
        land_bodies(spark, source, [json.dumps(document(i, "new")), bad])
        run(upsert.start_ingest_stream(spark, source, target, str(tmp_path / f"cp{i}")))
    orders = read_appended(spark, f"{target}/{upsert.STREAM_TABLES['order'][1]}")
    assert rows(orders, "order_bk") == [("1",), ("2",)]
    dead = read_dead_letters(spark, f"{target}/deadletters", "body STRING")
    assert rows(dead, "body") == [("[1]",), ("[2]",)]


def test_rejected_rows_of_a_silver_stream_are_kept(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "silver")
    twice = [{"bucketNumber": 1, "rows": [{"rowNumber": 1, "sku": "A"}, {"rowNumber": 1, "sku": "B"}]}]
    land_raw(spark, source, [document(1, "new", buckets=twice), document(2, "new"), document(3, "new")])
    raw = spark.read.schema(schemas.RAW_H).parquet(source)
    broken = F.when(F.col("orderNumber") == "2", F.lit("[{")).otherwise(F.col("buckets"))
    status = F.when(F.col("orderNumber") == "3", F.lit('{"value":')).otherwise(F.col("status"))
    landed = str(tmp_path / "landed")
    raw.withColumns({"buckets": broken, "status": status}).write.parquet(landed)
    stream = spark.readStream.schema(schemas.RAW_H).parquet(landed)
    run(upsert.upsert_stream(stream, target, str(tmp_path / "cp"), names=["order", "row"], orders_per_block=100))
    tables = silver.silver_tables(spark, target)
    assert rows(tables["order"].read(), "order_bk") == [("1_new",)]
    assert rows(tables["row"].read(), "SKU") == [("B",)]
    dead = spark.read.json(f"{target}/deadletters/consumer=silver/stage=parse")
    assert rows(dead, "orderNumber", "broken") == [("2", ["buckets"]), ("3", ["status"])]
    lost = spark.read.json(f"{target}/deadletters/consumer=silver/stage=duplicate_row")
    assert rows(lost, "SKU") == [("A",)]


def test_triggers():
    assert upsert.trigger() == {"availableNow": True}
    assert upsert.trigger(upsert.INTERVAL) == {"processingTime": "5 minutes"}


def test_repeating_trigger_runs_until_stopped(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "cp"))
    land_raw(spark, source, [document(1, "new")])
    query = upsert.start_upsert_stream(
        spark, source, target, checkpoint, interval=upsert.INTERVAL, names=["order"]
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert silver.silver_tables(spark, target)["order"].read().count() == 1


def test_ingest_stream_and_warehouse_refresh(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "stream", "cp"))
    as_of = F.col("EventEnqueuedUtcTime") + F.expr("INTERVAL 2 MINUTES")

    def ingest():
        run(upsert.start_ingest_stream(spark, source, target, checkpoint, "c1", as_of=as_of))

    def streams():
        return {n: read_appended(spark, f"{target}/{t}") for n, (_, t) in upsert.STREAM_TABLES.items()}

    good = [json.dumps(document(1, "new")), json.dumps(document(2, "new"))]
    land_bodies(spark, source, [*good, '{"orderNumber":', "[1]"])
    ingest()
    assert {n: d.count() for n, d in streams().items()} == {"order": 2, "payment": 2, "row": 4}
    dead = read_dead_letters(spark, f"{target}/deadletters", "body STRING, Offset STRING")
    assert rows(dead, "body", "Offset", "consumer") == [("[1]", "3", "c1"), ('{"orderNumber":', "2", "c1")]

    tables = warehouse.warehouse_tables(spark, str(tmp_path / "wh"))
    warehouse.warehouse_refresh(streams(), tables, on_empty="none")
    assert not tables["order"].exists()  # an empty target loads nothing in this mode
    warehouse.warehouse_refresh(streams(), tables)
    assert rows(tables["order"].read(), "order_bk", "status_value", "rn") == [("1", "new", 1), ("2", "new", 1)]
    assert {n: len(t.read().columns) for n, t in tables.items()} == {"order": 34, "payment": 13, "row": 37}

    # a newer version of order 1 arrives, and an old event of order 2 that the look-back still sees
    land_bodies(spark, source, [json.dumps(document(1, "sent"))], 30)
    land_bodies(spark, source, [json.dumps(document(2, "late"))], -1)
    ingest()
    assert streams()["order"].count() == 4
    warehouse.warehouse_refresh(streams(), tables)
    assert rows(tables["order"].read(), "order_bk", "status_value") == [("1", "sent"), ("2", "new")]
    assert tables["order"].read().agg(F.max("updated_datetime")).first()[0] == T0 + timedelta(minutes=32)

    # nothing new: the look-back reads the last rows again and changes nothing
    before = rows(tables["row"].read())
    warehouse.warehouse_refresh(streams(), tables)
    assert rows(tables["row"].read()) == before


def test_event_older_than_the_lookback_is_not_read(spark):
    bodies = [(json.dumps(document(i, "new")), T0 + timedelta(hours=i), None, None, None) for i in range(3)]
    events = parse_events(spark.createDataFrame(bodies, schemas.ENVELOPE), READS_S["order"])
    stream = flatten_order_s(events, F.col("EventEnqueuedUtcTime"))
    target = warehouse.latest(stream.filter("order_bk = '1'"), "order")
    state = warehouse.refresh_state(stream, target, "order")
    assert rows(state, "order_bk") == [("1",), ("2",)]
    assert rows(warehouse.refresh_state(stream, target.limit(0), "order"), "order_bk") == [("0",), ("1",), ("2",)]
    assert warehouse.refresh_state(stream, target.limit(0), "order", on_empty="none").count() == 0


def test_events_that_arrive_again_are_stored_once(spark, tmp_path):
    """In the same batch, in a later one, after a restart; old events are not late, and events
    without a number are all kept."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def ingest():
        run(upsert.start_ingest_stream(spark, source, target, checkpoint, max_files_per_trigger=1))

    def orders():
        return rows(read_appended(spark, f"{target}/{upsert.STREAM_TABLES['order'][1]}"), "order_bk")

    bodies = [json.dumps(document(i, "new")) for i in (1, 2)]
    land_bodies(spark, source, [*bodies, "[1]"])
    land_bodies(spark, source, [*bodies, "[1]"])
    ingest()
    assert orders() == [("1",), ("2",)]
    land_bodies(spark, source, [*bodies, "[1]"])
    land_bodies(spark, source, [json.dumps(document(3, "new"))], -100_000)
    ingest()
    assert orders() == [("1",), ("2",), ("3",)]
    assert read_dead_letters(spark, f"{target}/deadletters", "body STRING").count() == 1
    none = [(json.dumps(document(4, "new")), T0, None, None, None)] * 2
    spark.createDataFrame(none, schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(source)
    ingest()
    assert orders() == [("1",), ("2",), ("3",), ("4",), ("4",)]


def test_batches_report_their_counts(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    land_bodies(spark, source, [json.dumps(document(1, "new")), "[1]", "{"])
    listener = upsert.BatchCounts()
    spark.streams.addListener(listener)
    try:
        query = run(upsert.start_ingest_stream(spark, source, target, str(tmp_path / "cp")))
        deadline = time.time() + 20
        while not any(n["ingest"]["n_events"] for _, _, n in listener.rows) and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    expected = {"n_events": 3, "n_valid": 1, "n_rejected": 2}
    assert upsert.batch_counts(query) == [{"batch_id": 0, **expected}]
    assert (str(query.id), 0, {"ingest": expected}) in listener.rows


def test_read_files_go_to_an_archive_and_bytes_limit_a_batch(spark, tmp_path):
    source, archive = str(tmp_path / "in"), str(tmp_path / "archive")
    for i in range(3):
        land_bodies(spark, source, [json.dumps(document(i, "new"))], i)
    stream = read_events(spark, source, max_bytes_per_trigger=1, archive_dir=archive)
    sizes = []
    run(upsert.start_batches(stream, lambda batch, *_: sizes.append(batch.count()), str(tmp_path / "cp")))
    assert sizes == [1, 1, 1]
    left = [f for _, _, names in os.walk(source) for f in names if f.endswith(".parquet")]
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".parquet")]
    assert len(left) + len(moved) == 3 and moved
