import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.catalog.updates import order_updates
from orderlake.operators.stored import StoredTable
from orderlake.session import configure, shared_root, work_path
from orderlake.sources import events, sinks


def test_append_merges_schemas(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_table(spark.createDataFrame([(1, "a")], "id INT, x STRING"), path)
    sinks.append_table(spark.createDataFrame([(2, 0.5)], "id INT, y DOUBLE"), path)
    got = sinks.read_appended(spark, path)
    assert rows(got, "id", "x", "y") == [(1, "a", None), (2, None, 0.5)]
    assert rows(sinks.read_appended(spark, path, "id INT")) == [(1,), (2,)]


def test_replayed_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1):
        sinks.append_table(spark.createDataFrame([(batch,)], "id INT"), path, batch_id=batch)
    sinks.append_table(spark.createDataFrame([(9,)], "id INT"), path)
    got = sinks.read_appended(spark, path)
    assert got.columns == ["id"] and rows(got) == [(0,), (1,), (9,)]


def test_empty_batch_does_not_create_a_table(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ["id"], F.col("id"))
    empty = spark.createDataFrame([], "id INT")
    assert not sinks.save_or_merge(table, empty) and not table.exists()
    assert sinks.save_or_merge(table, spark.createDataFrame([(1,)], "id INT")) and table.exists()


def test_fan_out_computes_the_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    batch = spark.range(10, numPartitions=1).mapInPandas(count, "id BIGINT")
    written = {}
    sinks.fan_out(
        batch,
        {"all": lambda d: d, "even": lambda d: d.filter("id % 2 = 0")},
        lambda name, d: written.__setitem__(name, d.count()),
    )
    assert written == {"all": 10, "even": 5}
    assert seen.value <= 20  # side-by-side writes may both start before the batch is kept
    assert not batch.is_cached


def test_fan_out_reports_the_error_after_the_other_writes(spark):
    written = []

    def write(name, df):
        if name == "bad":
            raise RuntimeError("disk full")
        written.append((name, df.count()))

    with pytest.raises(RuntimeError, match="disk full"):
        sinks.fan_out(spark.range(3), {"bad": lambda d: d, "good": lambda d: d}, write)
    assert written == [("good", 3)]


def test_dead_letters_by_consumer_and_stage(spark, tmp_path):
    path = str(tmp_path / "dead")
    df = spark.createDataFrame([("{oops",)], "body STRING")
    for _ in range(2):
        sinks.write_dead_letters(df, path, "c1", "parse", batch_id=7)
    sinks.write_dead_letters(df, path, "c2", "parse")
    got = sinks.read_dead_letters(spark, path, "body STRING")
    assert rows(got, "body", "consumer", "stage") == [("{oops", "c1", "parse"), ("{oops", "c2", "parse")]


def test_retype(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-01T10:00:00Z",)], "t STRING")
    out = sinks.rewrite_with_type(df, "t", "timestamp", str(tmp_path / "r"))
    assert rows(out) == [(datetime(2025, 1, 1, 10),)]


def test_json_lines_with_declared_schema(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    lines = [
        {"orderNumber": "1", "orderDate": "2025-09-18T06:05:10Z", "extra": 1, "SequenceNumber": 18446744073709551615,
         "EventEnqueuedUtcTime": "2025-09-18T06:05:11.5Z", "buckets": [{"deliveryEstimate": {"date": "2025-09-20"}}],
         "logs": [{"a": 1}]},
    ]
    path.write_text("\n".join(json.dumps(x) for x in lines) + '\n{"orderNumber":')
    df = events.read_events_json(spark, str(path)).cache()
    assert "extra" not in df.columns
    good = df.filter(F.col(schemas.CORRUPT).isNull()).first()
    assert str(good.SequenceNumber) == "18446744073709551615"
    assert good.EventEnqueuedUtcTime == datetime(2025, 9, 18, 6, 5, 11, 500000)
    assert str(good.buckets[0].deliveryEstimate.date) == "2025-09-20"
    assert good.logs == ['{"a": 1}']  # the text as it came
    assert df.filter(F.col(schemas.CORRUPT).isNotNull()).count() == 1


def test_kafka_source_options_and_envelope(spark):
    options = events.kafka_options("host:9093", "orders", startingOffsets="earliest")
    assert "maxOffsetsPerTrigger" not in options  # no cap unless one is asked for
    assert events.kafka_options("h", "t", maxOffsetsPerTrigger="5")["maxOffsetsPerTrigger"] == "5"
    assert options["minOffsetsPerTrigger"] == "100"
    assert options["maxTriggerDelay"] == "2m"
    records = spark.sql("SELECT binary('k') key, binary('{}') value, 5L offset, timestamp'2025-01-01' timestamp")
    df = events.kafka_envelope(records)
    assert df.schema.names == schemas.struct(schemas.ENVELOPE).names
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.struct(schemas.ENVELOPE)]


def test_work_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    assert work_path(spark, "x").startswith(shared_root(spark))
    assert work_path(spark, "x") != work_path(spark, "x")


def test_without_a_shared_folder_work_goes_below_the_warehouse():
    class Conf:
        def get(self, key, default=None):
            return "hdfs://x/wh" if key == "spark.sql.warehouse.dir" else default

    class Session:
        conf = Conf()

    assert shared_root(Session()) == "hdfs://x/wh/_work"


def test_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for writer, value in (("a", 1), ("b", 2), ("a", 1)):
        sinks.append_table(spark.createDataFrame([(value,)], "id INT"), path, 0, writer=writer)
    assert sorted(r.id for r in sinks.read_appended(spark, path).collect()) == [1, 2]


def test_staged_orders_hold_no_texts(spark, tmp_path):
    """Texts are made by those who read them: what is staged has only what they are made of."""
    ddl = {
        "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
        "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING",
        "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_mktsegment STRING",
        "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
        "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_size INT, p_retailprice DOUBLE",
    }
    data = {
        "orders": [(4, 1, "F", 10.0, datetime(1998, 1, 1), "1-URGENT"), (6, None, None, None, None, None)],
        "lineitem": [(4, 1, 1, 1, 2.0, 5.0, 0.06, 0.1, "R"), (4, 9, 1, 2, None, None, None, None, None)],
        "customer": [(1, "c", 1, "M")],
        "nation": [(1, "JAPAN", 2)],
        "part": [(1, "p", "b", 3, 1.5)],
    }
    for name, kind in ddl.items():
        spark.createDataFrame(data[name], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    made = order_updates(spark, str(tmp_path))
    assert set(made.columns) == {"body", *schemas.struct(schemas.RAW_H).names, "o_orderkey", "v"}
    staged = {f.rpartition("/")[0] for f in made.inputFiles()}
    assert not set(spark.read.parquet(*staged).columns) & {"body", *schemas.RAW_JSON_H}
    assert order_updates(spark, str(tmp_path), ["v", "body"]).columns == ["v", "body"]
    found = {(r["orderNumber"], r["v"]): json.loads(r["body"]) for r in made.collect()}
    assert set(found) == {("4", 1), ("4", 2), ("6", 1)}
    rows_ = {r["rowNumber"]: r for r in found["4", 2]["buckets"][0]["rows"]}
    assert rows_[1]["offers"] == [{"campaignId": "C6", "discount": 0.06}, {"campaignId": "BULK", "discount": 0.01}]
    assert rows_[1]["returnedQuantity"] == 2 and rows_[2]["returnedQuantity"] == 0
    assert rows_[2]["sku"] == "9" and "name" not in rows_[2]
    assert "buckets" not in found["6", 1]


def test_a_fanned_out_batch_is_kept_as_files(spark):
    """A cache of nested rows fills the memory or the disk of the executors."""
    seen = []
    made = sinks.fan_out(spark.range(3).toDF("n"), {"a": lambda rows: rows, "b": lambda rows: rows}, lambda _, rows: seen.append((rows.is_cached, rows.count(), bool(rows.inputFiles()))))
    assert made == 3 and seen == [(False, 3, True)] * 2


def test_streams_remember_on_disk(spark):
    assert "RocksDB" in configure(spark).conf.get("spark.sql.streaming.stateStore.providerClass")
