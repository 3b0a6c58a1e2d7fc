from datetime import datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import aggregates, incremental, quality

T0 = datetime(2025, 1, 1, 12)


def times(spark, *minutes):
    return spark.createDataFrame([(T0 + timedelta(minutes=m),) for m in minutes], "ts TIMESTAMP")


def test_bodies_are_judged_one_by_one(spark):
    bodies = [
        '{"orderNumber":"1","buckets":[{"bucketNumber":1}]}', "{}", ' {"orderNumber":"2"}', "[1]", '"text"', "null",
        '{"orderNumber":', "", None, '{"buckets":[{"bucketNumber":"one"}]}', '{"total":{"discount":"free"}}',
        '{"orderNumber":"3"},"y":{}', '{"orderNumber":"3"},"x":{"orderNumber":"4"}', '{"orderNumber":"3"}} junk',
        '{"orderNumber":"3"}],"z":[{}', '{"orderNumber":"3"}]', '{"orderNumber":"3"},{}', '{"orderNumber":"3"}},"y":{"a":1',
    ]
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "body STRING, Offset INT")
    good, bad = quality.split_valid(df)
    assert rows(good, "Offset", "orderNumber") == [(0, "1"), (1, None), (2, "2")]
    assert rows(bad, "Offset") == sorted([(i,) for i in range(3, 18)], key=repr)
    assert bad.columns == ["body", "Offset"]


def test_checked_batch_is_not_parsed_again(spark):
    df = spark.createDataFrame([("{}",)], "body STRING")
    checked = quality.parse_checked(df)
    good, _ = quality.split_valid(checked)
    assert "event" in checked.columns and good.count() == 1


def from_json_calls(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_each_text_is_parsed_once(spark):
    """Filters on the verdict do not parse a second time."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    body = spark.createDataFrame([("{}", "x")], "body STRING, Offset STRING")
    good, bad = quality.split_valid(body)
    assert from_json_calls(good) == 1 and from_json_calls(bad) == 1
    raw = spark.createDataFrame([], schemas.RAW_H)
    good, bad = quality.split_raw(raw)
    assert from_json_calls(good) == len(schemas.RAW_JSON_H)


def test_raw_texts_are_one_value_each(spark):
    texts = ['[{"title":"a"}]', '[],"y":[1]', '[{"title":"a"}],"x":[]', "[]]", "[] junk", "[", None, " [] ", '[{"amount":"much"}]', "[]}"]
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "orderNumber STRING, payments STRING")
    good, bad = quality.split_raw(raw, ["payments"])
    assert rows(good, "orderNumber") == [("0",), ("6",), ("7",)]
    assert rows(bad, "orderNumber", "payments") == [(str(i), texts[i]) for i in (1, 2, 3, 4, 5, 8, 9)]
    assert {tuple(r.broken) for r in bad.collect()} == {("payments",)}


def test_freshness(spark):
    as_of = F.lit(T0).cast("timestamp")
    tables = {"exact": times(spark, -60), "late": times(spark, -61, -90), "none": times(spark), "two": times(spark, -5, 5)}
    counts = quality.freshness(tables, "ts", as_of)
    assert rows(counts) == [("exact", 1), ("late", 0), ("none", 0), ("two", 2)]
    assert rows(quality.freshness_failures(counts)) == [("late, none",)]
    with pytest.raises(PySparkException, match="no fresh records in tables: late, none"):
        quality.assert_fresh(counts).collect()
    fine = quality.freshness({"two": tables["two"]}, "ts", as_of)
    assert rows(quality.freshness_failures(fine)) == [(None,)]
    assert quality.assert_fresh(fine).first()[0] == "all tables are fresh"


def test_freshness_uses_the_clock_by_default(spark):
    now = spark.range(1).select(F.current_timestamp().alias("ts"))
    assert rows(quality.freshness({"now": now, "old": times(spark, 0)}, "ts")) == [("now", 1), ("old", 0)]


def test_evolve_adds_only_what_is_missing(spark):
    df = spark.createDataFrame([(1, "x")], "id INT, Name STRING")
    out = quality.evolve(df, "name STRING, added BOOLEAN, at TIMESTAMP")
    assert out.dtypes == [("id", "int"), ("Name", "string"), ("added", "boolean"), ("at", "timestamp")]
    assert quality.evolve(df, "id INT") is df


def test_schema_contract(spark):
    contract = schemas.struct("SKU STRING, n BIGINT")
    df = spark.createDataFrame([("a", 1)], "sku STRING, n INT")
    problems = quality.schema_problems(df, contract)
    assert problems == ["missing SKU", "unexpected sku", "n is int, not bigint"]
    with pytest.raises(ValueError, match="missing SKU"):
        quality.check_schema(df, contract)
    good = quality.conform(df.withColumnRenamed("sku", "SKU"), contract)
    assert quality.check_schema(good, contract) is good


def test_counts_and_summary(spark):
    df = spark.createDataFrame([("O",), ("F",), ("F",), (None,)], "s STRING")
    assert rows(aggregates.table_counts({"a": df, "b": df.limit(0)})) == [("a", 4), ("b", 0)]
    assert aggregates.status_summary(df, "s", {"o": "O", "f": "F", "p": "P"}).first() == (4, 1, 2, 0)


def test_lookback_is_strict_and_starts_at_the_newest_target_row(spark):
    source, target = times(spark, -16, -15, -14, 0, 1), times(spark, -100, 0)
    got = incremental.incremental(source, target, "ts")
    assert rows(got) == [(T0 + timedelta(minutes=m),) for m in (-14, 0, 1)]
    strict = incremental.incremental(source, target, "ts", "0 minutes")
    assert rows(strict) == [(T0 + timedelta(minutes=1),)]


def test_empty_target(spark):
    source, target = times(spark, 0, 1), times(spark)
    assert incremental.incremental(source, target, "ts").count() == 0
    assert incremental.incremental(source, target, "ts", on_empty="all").count() == 2
    with pytest.raises(ValueError):
        incremental.incremental(source, target, "ts", on_empty="some")
    assert rows(incremental.high_watermark(target, "ts")) == [(None,)]


def test_bound_is_pushed_into_the_scan_and_prunes_days(spark, tmp_path):
    path = str(tmp_path / "s")
    days = times(spark, *range(0, 10 * 1440, 60)).withColumn("day", F.to_date("ts"))
    days.write.partitionBy("day").parquet(path)
    source, target = spark.read.parquet(path), times(spark, 9 * 1440)
    got = incremental.incremental(source, target, "ts", date_partition="day")
    scan = next(line for line in plan(got).splitlines() if "FileScan" in line and "day" in line)
    assert "ts" in scan.split("DataFilters")[1].split("]")[0]
    assert "subquery" in scan.split("PartitionFilters")[1].lower()
    expected = source.filter(F.col("ts") > F.lit(T0 + timedelta(minutes=9 * 1440 - 15)))
    assert rows(got, "ts") == rows(expected, "ts")
    bound = F.lit(T0 + timedelta(minutes=9 * 1440 - 15)).cast("timestamp")
    assert rows(incremental.newer_than(source, "ts", bound), "ts") == rows(expected, "ts")
