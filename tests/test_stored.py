import os
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from orderlake.operators import stored as module
from orderlake.operators.stored import StoredTable, order_block, replay

T1, T2, T3 = (datetime(2025, 1, d) for d in (1, 2, 3))
SCHEMA = "k STRING, ts TIMESTAMP, v STRING"
NEWER = "t.ts < s.ts"


def frame(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def make(spark, path, **options):
    return StoredTable(spark, str(path), ["k"], order_block("k", 5), **options)


@pytest.fixture
def table(spark, tmp_path):
    made = make(spark, tmp_path / "t")
    made.merge(frame(spark, [(str(i), T1, "t") for i in range(20)]))
    return made


def files(path):
    """Data files by block, with their times."""
    found = {}
    for folder in os.listdir(path):
        if folder.startswith("block="):
            names = [f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]
            found[int(folder[6:])] = sorted((f, os.stat(f"{path}/{folder}/{f}").st_mtime_ns) for f in names)
    return found


def test_absent_and_empty(spark, tmp_path):
    table = make(spark, tmp_path / "none")
    assert not table.exists()
    with pytest.raises(ValueError):
        table.read()
    assert not table.merge(frame(spark, [])) and not table.exists()
    assert table.merge(frame(spark, [("1", T1, "t")])) and not table.merge(frame(spark, []))
    assert table.read().columns == ["k", "ts", "v"]


def test_only_touched_blocks_are_rewritten(spark, table):
    before = files(table.path)
    assert sorted(before) == [0, 1, 2, 3]
    assert table.merge(frame(spark, [("3", T2, "s"), ("x", T1, "s"), ("41", T1, "s")]), NEWER)
    after = files(table.path)
    assert {b: after[b] for b in (1, 2, 3)} == {b: before[b] for b in (1, 2, 3)}
    assert after[0] != before[0] and 8 in after and min(after) < 0
    assert rows(table.read().filter("v = 's'"), "k") == [("3",), ("41",), ("x",)]
    assert table.read().count() == 22
    table.merge(frame(spark, [("3", T1, "old")]), NEWER)
    assert rows(table.read().filter("k = '3'"), "v") == [("s",)]


def test_a_merge_reads_only_touched_blocks(spark, table):
    scan = next(x for x in plan(table.blocks([0, 2])).splitlines() if "FileScan" in x)
    assert "block" in scan.split("PartitionFilters")[1].split("]")[0]


def test_a_dead_writer_leaves_nothing_or_is_finished(spark, table, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(StoredTable, "_apply", fail)
        with pytest.raises(RuntimeError):
            table.merge(frame(spark, [("3", T2, "s")]), NEWER)
    assert table.read().filter("v = 's'").count() == 0
    with monkeypatch.context() as broken:  # dies while the copy is put in place
        broken.setattr(module, "_write_blocks", fail)
        with pytest.raises(RuntimeError):
            table.recover()
    table.recover()
    assert rows(table.read().filter("v = 's'"), "k") == [("3",)] and table.read().count() == 20
    staged = f"{table.path}/_staged/merge-9"
    frame(spark, [("lost", T1, "s")]).write.parquet(staged)
    os.remove(f"{staged}/_SUCCESS")
    table.merge(frame(spark, [("4", T2, "s")]), NEWER)
    assert rows(table.read().filter("v <> 't'"), "k") == [("3",), ("4",)]
    assert os.listdir(f"{table.path}/_staged") == []


def test_null_keys_are_inserted_again_or_left_out(spark, table):
    source = frame(spark, [(None, T1, "a"), (None, T1, "a"), ("3", T2, "s")])
    for expected in (2, 4):
        table.merge(source, NEWER)
        assert table.read().filter("k IS NULL").count() == expected
    table.merge(source, NEWER, null_keys="quarantine")
    assert table.read().filter("k IS NULL").count() == 4 and table.read().count() == 24


def test_duplicates_first_load_takes_all_a_later_merge_fails(spark, tmp_path):
    twice = frame(spark, [("a", T1, "x"), ("a", T1, "y")])
    table = make(spark, tmp_path / "d")
    table.merge(twice)
    assert table.read().count() == 2
    with pytest.raises(Exception, match="several source rows"):
        table.merge(twice)
    assert table.read().count() == 2
    other = make(spark, tmp_path / "l")
    other.merge(twice, on_source_duplicates="latest", order_by=[F.desc("v")])
    assert rows(other.read(), "v") == [("y",)]


def test_new_columns_of_a_source_are_added(spark, table):
    table.merge(frame(spark, [("3", T2, "s")]).withColumn("extra", F.lit(1)), NEWER)
    assert table.read().columns == ["k", "ts", "v", "extra"]
    assert rows(table.read().filter("extra IS NOT NULL"), "k") == [("3",)]
    assert table.read().count() == 20
    declared = make(spark, table.path, schema=frame(spark, []).schema)
    assert declared.read().columns == ["k", "ts", "v"]


def test_a_wider_source_type_leaves_the_table_its_own(spark, tmp_path):
    table = make(spark, tmp_path / "w")
    table.merge(spark.createDataFrame([(str(i), i) for i in range(20)], "k STRING, v BIGINT"))
    table.merge(spark.createDataFrame([("3", 33.0), (None, 7.0), ("x", 1.0)], "k STRING, v DOUBLE"))
    assert dict(table.read().dtypes)["v"] == "bigint" and table.read().count() == 22
    assert rows(table.read().filter("k = '3' OR k IS NULL"), "v") == [(33,), (7,)]


def test_a_large_block_is_merged_by_several_tasks(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "h"), ["k"], order_block("k", 1000), part_bytes=512)
    table.merge(frame(spark, [(str(i), T1, "t") for i in range(200)]))
    assert table._parts() > 2
    table.merge(frame(spark, [(str(i), T2, "s") for i in range(100)]), NEWER)
    assert table.read().filter("v = 's'").count() == 100 and table.read().count() == 200


def test_a_block_filled_by_one_key_is_spread_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        value = F.sha2(F.col("id").cast("string"), 256).alias("v")
        hot = spark.range(60_000).select(F.lit("hot").alias("k"), F.lit(T1).alias("ts"), value)
        table = make(spark, tmp_path / "h")
        table.merge(hot.repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.read().count() == 60_000 and len(table.read().inputFiles()) > 1


def test_delete_rewrites_only_blocks_with_matches(spark, table):
    before = files(table.path)
    assert table.delete("k IN ('7', '8') OR k BETWEEN '15' AND '19'")
    after = files(table.path)
    assert sorted(after) == [0, 1, 2]  # the last block lost all its rows
    assert after[0] == before[0] and after[2] == before[2]
    assert table.read().count() == 13
    assert not table.delete("k = 'none'") and not table.delete(F.lit(None).cast("boolean"))
    assert files(table.path) == after


def test_recorded_changes_replay_to_the_last_state(spark, tmp_path):
    table = make(spark, tmp_path / "c", record_changes=True)
    table.merge(frame(spark, [(str(i), T1, "t") for i in range(20)] + [(None, T1, "n")]))
    first = frame(spark, [tuple(r) for r in table.read().collect()])
    table.merge(frame(spark, [("3", T2, "s"), ("50", T1, "new"), ("4", T1, "older"), (None, T2, "n")]), NEWER)
    table.merge(frame(spark, [("3", T3, "u"), ("51", T1, "new")]).withColumn("extra", F.lit(1)), NEWER)
    table.delete("k IN ('3', '50') OR (k IS NULL AND v = 'n' AND ts = timestamp'2025-01-01')")
    table.merge(frame(spark, [("50", T3, "again")]), NEWER)
    kinds = table.changes().groupBy("_commit_version", "_change_type").count()
    assert rows(kinds) == [
        (1, "insert", 21), (2, "insert", 2), (2, "update_postimage", 1), (2, "update_preimage", 1), (3, "insert", 1),
        (3, "update_postimage", 1), (3, "update_preimage", 1), (4, "delete", 3), (5, "insert", 1),
    ]
    images = table.changes(3).filter("k = '3'")
    assert rows(images, "_change_type", "v", "extra") == [
        ("delete", "u", 1), ("update_postimage", "u", 1), ("update_preimage", "s", None),
    ]
    last = table.read().drop("extra")
    assert rows(replay(first, table.changes(2), ["k"])) == rows(last)
    assert rows(replay(first.limit(0), table.changes(), ["k"])) == rows(last)
    scan = next(x for x in plan(table.changes(4)).splitlines() if "FileScan" in x)
    assert "version" in scan.split("PartitionFilters")[1].split("]")[0]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = make(spark, tmp_path / "r", record_changes=True)
    batch = frame(spark, [("3", T2, "s"), ("4", T1, "s")])
    for _ in range(3):
        table.merge(batch)
    assert rows(table.read()) == rows(batch)
    assert rows(table.changes(), "_commit_version", "_change_type") == [(1, "insert"), (1, "insert")]


def test_a_task_rewrites_a_part_at_most(spark, tmp_path):
    """Staged blocks are put in place by several tasks, as the writer sorts what a task reads."""
    block = F.floor(F.col("id") / 100_000)
    table = StoredTable(spark, str(tmp_path / "t"), ["id"], block, part_bytes=64 << 10)
    table.merge(spark.range(20_000).selectExpr("id", "sha2(string(id), 256) AS v"))
    table.merge(spark.range(19_000, 21_000).selectExpr("id", "'new' AS v"), on_source_duplicates="assume_unique")
    files = {r[0] for r in table.read().select(F.col("_metadata.file_path")).distinct().collect()}
    assert len(files) > 8 and table.read().count() == 21_000 and table.read().filter("v = 'new'").count() == 2_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(64 << 10)
