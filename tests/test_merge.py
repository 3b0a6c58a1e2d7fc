from datetime import datetime

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake.operators import merge
from orderlake.operators.dedup import dedup_latest, newest_first
from orderlake.operators.merge import (
    delete_where,
    fail_on_duplicates,
    measured_bytes,
    merge_upsert,
    read_changes,
    split_null_keys,
)

T1, T2, T3 = (datetime(2025, 1, d) for d in (1, 2, 3))
SCHEMA = "k STRING, ts TIMESTAMP, v STRING"
NEWER = "t.ts < s.ts"


def frame(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def test_latest_with_ties_and_nulls(spark):
    df = frame(spark, [("a", T1, "x"), ("a", T2, "y"), ("a", T2, "z"), ("b", None, "n"), ("b", T1, "m"), (None, T1, "p"), (None, T2, "q")])
    latest = dedup_latest(df, ["k"], newest_first("ts", "v"), keep_rn=True)
    assert dict(latest.dtypes)["rn"] == "bigint"
    assert rows(latest) == [("a", T2, "z", 1), ("b", T1, "m", 1), (None, T2, "q", 1)]


def test_latest_sends_one_row_per_key_and_task_to_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = plan(dedup_latest(df, ["user_id"], newest_first("ts"))).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])
    assert sum("Exchange" in line for line in lines) == 1


def test_update_all_overwrites_with_nulls_and_ignores_time(spark):
    target = frame(spark, [("a", T3, "old"), ("b", T1, "kept")])
    source = frame(spark, [("a", T1, None), ("c", None, "new")])
    assert rows(merge_upsert(target, source, ["k"])) == [
        ("a", T1, None),
        ("b", T1, "kept"),
        ("c", None, "new"),
    ]


@pytest.mark.parametrize("strategy", ["shuffle", "auto"])
def test_guard_is_three_valued(spark, strategy):
    target = frame(
        spark, [("older", T1, "t"), ("equal", T2, "t"), ("newer", T3, "t"), ("null_t", None, "t"), ("null_s", T1, "t"), ("alone", T1, "t")]
    )
    source = frame(
        spark, [("older", T2, "s"), ("equal", T2, "s"), ("newer", T2, "s"), ("null_t", T2, "s"), ("null_s", None, "s"), ("fresh", None, "s")]
    )
    merged = merge_upsert(target, source, ["k"], NEWER, strategy=strategy)
    assert rows(merged, "k", "v") == [
        ("alone", "t"), ("equal", "t"), ("fresh", "s"), ("newer", "t"), ("null_s", "t"), ("null_t", "t"), ("older", "s"),
    ]


@pytest.mark.parametrize("strategy", ["shuffle", "auto"])
def test_null_keys(spark, strategy):
    target = frame(spark, [(None, T1, "t"), ("a", T1, "t")])
    source = frame(spark, [(None, T2, "s"), (None, T2, "s"), ("a", T2, "s")])
    merged = merge_upsert(target, source, ["k"], NEWER, strategy=strategy)
    assert rows(merged) == [("a", T2, "s"), (None, T1, "t"), (None, T2, "s"), (None, T2, "s")]
    again = merge_upsert(target, source, ["k"], NEWER, null_keys="quarantine", strategy=strategy)
    assert rows(again) == [("a", T2, "s"), (None, T1, "t")]
    good, bad = split_null_keys(source, ["k"])
    assert (good.count(), bad.count()) == (1, 2)


def test_duplicate_source_keys(spark):
    target = frame(spark, [("a", T1, "t")])
    source = frame(spark, [("a", T2, "x"), ("a", T3, "y"), ("b", T1, "z")])
    with pytest.raises(PySparkException, match="several source rows for one merge key: a"):
        merge_upsert(target, source, ["k"]).collect()
    merged = merge_upsert(
        target, source, ["k"], on_source_duplicates="latest", order_by=newest_first("ts")
    )
    assert rows(merged) == [("a", T3, "y"), ("b", T1, "z")]
    with pytest.raises(ValueError):
        merge_upsert(target, source, ["k"], on_source_duplicates="latest")


def test_the_duplicate_check_sends_two_rows_per_key_and_task_to_the_shuffle(spark):
    lines = plan(fail_on_duplicates(frame(spark, [("a", T1, "x")]), ["k"])).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("row_number(), 2, Partial" in line for line in lines[exchange:])


def test_columns_may_differ_and_types_follow_the_target(spark):
    target = spark.createDataFrame([("a", 1, "only target")], "k STRING, n BIGINT, t STRING")
    source = spark.createDataFrame([("a", 2, "only source"), ("b", 3, "x")], "k STRING, n INT, s STRING")
    merged = merge_upsert(target, source, ["k"])
    assert dict(merged.dtypes)["n"] == "bigint"
    assert rows(merged, "k", "n", "t", "s") == [("a", 2, "only target", "only source"), ("b", 3, None, "x")]


def test_composite_keys(spark):
    schema = "a INT, b INT, v STRING"
    target = spark.createDataFrame([(1, 1, "t"), (1, 2, "t"), (1, None, "t")], schema)
    source = spark.createDataFrame([(1, 2, "s"), (2, 1, "s"), (1, None, "s")], schema)
    assert rows(merge_upsert(target, source, ["a", "b"])) == [
        (1, 1, "t"), (1, 2, "s"), (1, None, "s"), (1, None, "t"), (2, 1, "s"),
    ]


def test_merge_is_idempotent(spark):
    target = frame(spark, [("a", T1, "t"), ("b", T3, "t")])
    source = frame(spark, [("a", T2, "s"), ("b", T2, "s"), ("c", T1, "s")])
    once = merge_upsert(target, source, ["k"], NEWER)
    assert rows(merge_upsert(once, source, ["k"], NEWER)) == rows(once)


def test_deduplicated_source_is_joined_without_another_shuffle(spark):
    df = frame(spark, [("a", T1, "t")])
    latest = dedup_latest(df, ["k"], newest_first("ts"))
    merged = merge_upsert(df, latest, ["k"], NEWER, "assume_unique", keys_not_null=True)
    assert plan(merged).count("Exchange hashpartitioning") == 2  # one per side


def test_broadcast_merge_does_not_shuffle_the_target(spark, tmp_path):
    frame(spark, [("a", T1, "t")]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = frame(spark, [("a", T2, "s")])
    merged = merge_upsert(target, source, ["k"], NEWER, "assume_unique", keys_not_null=True, strategy="auto")
    assert "Exchange hashpartitioning" not in plan(merged).split("LeftAnti")[0]


def test_a_source_above_the_limit_is_not_broadcast(spark, tmp_path, monkeypatch):
    frame(spark, [("a", T1, "t")]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(merge, "BROADCAST_LIMIT", 10)
    merged = merge_upsert(target, frame(spark, [("a", T2, "s")]), ["k"], NEWER, strategy="auto")
    assert "BroadcastExchange" not in plan(merged) and rows(merged) == [("a", T2, "s")]


def test_measured_bytes_grow_with_the_rows(spark):
    one = measured_bytes(frame(spark, [("a", T1, "x" * 100)]))
    many = measured_bytes(frame(spark, [("a", T1, "x" * 100)] * 10))
    assert one > 100 and many == 10 * one
    assert measured_bytes(frame(spark, [])) == 0


def test_delete_where_keeps_unknown(spark):
    df = frame(spark, [("a", T1, "x"), ("b", T1, None), ("c", T1, "y")])
    assert rows(delete_where(df, "v = 'x'"), "k") == [("b",), ("c",)]
    assert rows(delete_where(df, F.col("v").isNull()), "k") == [("a",), ("c",)]
    assert delete_where(df, "true").count() == 0


def test_change_kinds(spark):
    before = frame(spark, [("same", T1, None), ("gone", T1, "x"), ("mod", T1, "x"), (None, T1, "n"), (None, T1, "n")])
    after = frame(spark, [("same", T1, None), ("mod", T1, None), ("new", T2, "y"), (None, T1, "n"), (None, T2, "n")])
    got = rows(read_changes(before, after, ["k"], version=4), "_change_type", "k", "v", "_commit_version")
    assert got == [
        ("delete", "gone", "x", 4), ("delete", None, "n", 4), ("insert", "new", "y", 4),
        ("insert", None, "n", 4), ("update_postimage", "mod", None, 4), ("update_preimage", "mod", "x", 4),
    ]


states = st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.sampled_from([T1, T2, None]), st.sampled_from(["x", "y", None])))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=states, after=states)
def test_changes_lead_from_before_to_after(spark, before, after):
    old = frame(spark, [(k, *v) for k, v in before.items()])
    new = frame(spark, [(k, *v) for k, v in after.items()])
    state = dict(before)
    changes = read_changes(old, new, ["k"]).collect()
    for c in changes:
        if c["_change_type"] in ("delete", "update_preimage"):
            assert state.pop(c["k"]) == (c["ts"], c["v"])
    for c in changes:
        if c["_change_type"] in ("insert", "update_postimage"):
            assert c["k"] not in state
            state[c["k"]] = (c["ts"], c["v"])
    assert state == after


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=states, after=states)
def test_merge_agrees_with_a_plain_loop(spark, before, after):
    expected = dict(before)
    for k, (ts, v) in after.items():
        if k not in expected or (expected[k][0] is not None and ts is not None and expected[k][0] < ts):
            expected[k] = (ts, v)
    old = frame(spark, [(k, *v) for k, v in before.items()])
    new = frame(spark, [(k, *v) for k, v in after.items()])
    merged = merge_upsert(old, new, ["k"], NEWER)
    assert {r.k: (r.ts, r.v) for r in merged.collect()} == expected
