"""Table care in place, catalog rows, freshness as a script."""

import os

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake.catalog import queries
from orderlake.operators import quality, tables


def parquet(folder):
    return {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")}


@pytest.fixture
def mixed(spark, tmp_path):
    """One large file, five small ones, and a partition folder that has a single small file."""
    path = str(tmp_path / "t")
    big = spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("p"))
    big.coalesce(1).write.partitionBy("p").parquet(path)
    big.limit(500).repartition(5).write.mode("append").partitionBy("p").parquet(path)
    big.limit(9).withColumn("p", F.lit("b c")).coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    return path


def test_only_small_files_are_joined(spark, mixed):
    before, other = parquet(f"{mixed}/p=a"), parquet(f"{mixed}/p=b c")
    expected = rows(spark.read.parquet(mixed).groupBy("p").agg(F.count("*"), F.sum("id")))
    done = tables.compact_files(spark, mixed, target_bytes=1 << 20)
    assert rows(done, "files_before", "files_after", "joined") == [(1, 1, 0), (6, 2, 5)]
    after = parquet(f"{mixed}/p=a")
    large = max(before, key=before.get)
    assert len(after) == 2 and after[large] == before[large] and parquet(f"{mixed}/p=b c") == other
    assert rows(spark.read.parquet(mixed).groupBy("p").agg(F.count("*"), F.sum("id"))) == expected
    assert tables.compact_files(spark, mixed, 1 << 20).agg(F.sum("joined")).first()[0] == 0


@pytest.mark.parametrize("step", ["move", "delete_folder"])
def test_a_compaction_that_died_is_finished(spark, mixed, monkeypatch, step):
    expected = rows(spark.read.parquet(mixed).groupBy("p").agg(F.count("*"), F.sum("id")))
    real, calls = getattr(tables, step), []

    def dies(*args):
        calls.append(args)
        if len(calls) > (1 if step == "delete_folder" else 0):
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(tables, "WORKERS", 1)
    monkeypatch.setattr(tables, step, dies)
    with pytest.raises(RuntimeError):
        tables.compact_files(spark, mixed, 1 << 20)
    monkeypatch.setattr(tables, step, real)
    tables.compact_files(spark, mixed, 1 << 20)
    assert rows(spark.read.parquet(mixed).groupBy("p").agg(F.count("*"), F.sum("id"))) == expected
    assert not os.path.exists(f"{mixed}/p=a/_compacting") and len(parquet(f"{mixed}/p=a")) == 2


def test_bytes_are_those_of_the_listed_files(spark, mixed):
    everything = sum(sum(parquet(f"{mixed}/{p}").values()) for p in ("p=a", "p=b c"))
    assert tables.listed_bytes(spark.read.parquet(mixed)) == everything
    one, size = next(iter(parquet(f"{mixed}/p=a").items()))
    assert tables.listed_bytes(spark.read.parquet(f"{mixed}/p=a/{one}")) == size


def test_added_columns_read_null_in_old_rows(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS evolving")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("evolving.t")
        assert tables.add_stored_columns(spark, "evolving.t", "ID LONG, extra STRING, price DOUBLE") == ["extra", "price"]
        assert tables.add_stored_columns(spark, "evolving.t", "extra STRING") == []
        spark.sql("INSERT INTO evolving.t VALUES (9, 'x', 1.5)")
        assert rows(spark.table("evolving.t")) == [(0, None, None), (1, None, None), (2, None, None), (9, "x", 1.5)]
        spark.sql("CREATE OR REPLACE VIEW evolving.t_view AS SELECT * FROM evolving.t")
        assert rows(tables.tables_like(spark, "evolving", "t")) == [("t",), ("t_view",)]
        spark.sql("ALTER TABLE evolving.t SET TBLPROPERTIES ('a.x' = '1', 'a.y' = '2', 'b' = '3')")
        assert rows(tables.table_properties(spark, "evolving.t", "a.%")) == [("a.x", "1"), ("a.y", "2")]
    finally:
        spark.sql("DROP DATABASE evolving CASCADE")


def test_freshness_script(spark):
    spark.sql("SELECT now() AS at").createOrReplaceTempView("fresh_one")
    spark.sql("SELECT timestamp'2020-01-01' AS at").createOrReplaceTempView("stale")
    assert rows(spark.sql(quality.freshness_script(["fresh_one"], "at"))) == [("all tables are fresh",)]
    with pytest.raises(PySparkException, match="no fresh records in tables: stale"):
        spark.sql(quality.freshness_script(["fresh_one", "stale"], "at")).collect()
    as_of = quality.freshness_script(["stale"], "at", "timestamp'2020-01-01 01:00:00'")
    assert rows(spark.sql(as_of)) == [("all tables are fresh",)]


def test_partitions_are_compacted_one_by_one(spark, tmp_path, monkeypatch):
    """Nothing is shuffled or sorted for it; odd names and NULL are partitions like others."""
    rows_ = spark.range(900).selectExpr("id", "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b c/ä:%' END AS p").repartition(4)
    spark.sql("CREATE DATABASE IF NOT EXISTS parted")
    try:
        rows_.write.partitionBy("p").option("path", str(tmp_path / "old")).saveAsTable("parted.t")
        expected = rows(spark.table("parted.t"), "id", "p")
        monkeypatch.setattr(type(rows_), "repartitionByRange", None)
        done = tables.compact_tables(spark, "parted", "t", str(tmp_path / "new"))
        assert rows(done) == [("t", "ok", None)]
        assert rows(spark.table("parted.t"), "id", "p") == expected
        files = [r["file"] for r in tables.file_sizes(spark.table("parted.t")).collect()]
        assert len(files) == 3 and all("/new/" in f for f in files)
    finally:
        spark.sql("DROP DATABASE parted CASCADE")


def test_small_files_lie_in_blocks(spark, sf_dir, tmp_path, monkeypatch):
    """No task writes all rows of a flag: they are spread over folders, each with one file at the end."""
    monkeypatch.setattr(queries, "_parts_of", lambda df: 3, raising=False)
    monkeypatch.setattr(queries, "work_path", lambda spark, label: str(tmp_path / label))
    found = rows(queries.QUERIES["compact_small_files"](spark, sf_dir))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count()
    assert found == [(flag, n, 1, int(flag == "R")) for flag, n in rows(lines)]
    for flag in "ANR":
        folders = sorted(os.listdir(tmp_path / "small" / f"l_returnflag={flag}"))
        assert folders == ["block=0", "block=1", "block=2"]


def test_detail_of_files_written_without_a_shuffle(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "repartition", None)
    assert rows(queries.QUERIES["table_detail"](spark, sf_dir))[0][0] == 3
