from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from orderlake.functions import (
    business_key_h,
    business_key_s,
    hash_key,
    local_time,
    local_time_ms,
    round_to_millis,
    utc_text_timestamp,
)

PARTS = "a STRING, b STRING, c INT"


def test_history_key_skips_null_parts(spark):
    df = spark.createDataFrame([("o", None, 1), ("o", "x", None), (None, None, None)], PARTS)
    assert rows(df.select(business_key_h("a", "b", "c"))) == [("",), ("o_1",), ("o_x",)]


def test_history_keys_of_different_rows_may_collide(spark):
    df = spark.createDataFrame([("o", None, 1), ("o", "1", None)], PARTS)
    assert df.select(hash_key("a", "b", "c").alias("h")).distinct().count() == 1


def test_hash_of_all_null_parts_is_the_hash_of_empty_text(spark):
    df = spark.createDataFrame([(None, None, None)], PARTS)
    assert rows(df.select(hash_key("a", "b", "c"))) == [("d41d8cd98f00b204e9800998ecf8427e",)]


def test_snapshot_key_keeps_separators(spark):
    df = spark.createDataFrame([("o", None, 1), ("o", "x", None), (None, None, None)], PARTS)
    assert rows(df.select(business_key_s("a", "b", "c"))) == [("__",), ("o__1",), ("o_x_",)]


def test_generated_keys_are_known_not_to_be_null(spark):
    df = spark.createDataFrame([("o", None, 1)], PARTS)
    keys = df.select(business_key_s("a", "b").alias("s"), hash_key("a", "b").alias("h"))
    assert not any(f.nullable for f in keys.schema)


def test_local_time_shifts_once_and_follows_clock_changes(spark):
    texts = ["2025-01-15T08:00:00Z", "2025-03-30T00:59:59Z", "2025-03-30T01:00:00Z", "2025-10-26T01:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert rows(df.select(local_time("t"))) == [
        (datetime(2025, 1, 15, 9, 0),),
        (datetime(2025, 10, 26, 2, 0),),
        (datetime(2025, 3, 30, 1, 59, 59),),
        (datetime(2025, 3, 30, 3, 0),),
    ]


def test_milliseconds_are_rounded_half_up(spark):
    df = spark.sql(
        "SELECT timestamp'2025-07-01 10:00:00.000500' a, timestamp'2025-07-01 10:00:00.000499' b, "
        "timestamp'2025-07-01 10:00:00.999600' c"
    )
    got = df.select(round_to_millis("a"), round_to_millis("b"), round_to_millis("c")).first()
    assert got[0].microsecond == 1000
    assert got[1].microsecond == 0
    assert got[2] == datetime(2025, 7, 1, 10, 0, 1)
    assert df.select(local_time_ms("a")).first()[0] == datetime(2025, 7, 1, 12, 0, 0, 1000)


def test_utc_text_ignores_the_session_zone(spark):
    df = spark.createDataFrame([("2025-07-01 10:00:00.123456",)], "t STRING")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Stockholm")
    try:
        explicit = df.select(utc_text_timestamp("t").cast("double").alias("s")).first()[0]
        implicit = df.select(F.to_timestamp("t").cast("double").alias("s")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert explicit - implicit == 7200
