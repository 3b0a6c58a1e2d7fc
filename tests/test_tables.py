import os
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from orderlake.operators import tables
from orderlake.operators.tables import compact, compact_tables, table_detail

T1 = datetime(2025, 1, 1)
SCHEMA = "k STRING, ts TIMESTAMP, v STRING"


def frame(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def test_detail(spark, tmp_path):
    path = str(tmp_path / "p")
    frame(spark, [("a", T1, "x")] * 10).repartition(2).write.parquet(path)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")]
    detail = table_detail(spark.read.parquet(path)).first()
    assert (detail.num_files, detail.num_rows) == (len(files), 10)
    assert detail.size_bytes == sum(os.path.getsize(f) for f in files)


def test_compaction_keeps_rows_and_joins_files_without_a_shuffle(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    df.repartition(20).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    packed = compact(many, str(tmp_path / "packed"))
    assert rows(packed) == rows(df)
    assert table_detail(packed).first().num_files == 1


def test_compaction_cuts_a_hot_sort_value(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 3 * 0).alias("hot"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.repartition(4).write.parquet(str(tmp_path / "hot"))
    hot = spark.read.parquet(str(tmp_path / "hot"))
    size = table_detail(hot).first().size_bytes
    packed = compact(hot, str(tmp_path / "cut"), size // 4, ["hot"])
    assert table_detail(packed).first().num_files >= 4
    assert packed.exceptAll(hot).count() == 0 and packed.count() == 20_000


def test_compact_catalog_tables(spark, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS care")
    try:
        for name in ("fact_a", "fact_b", "other"):
            spark.range(100).repartition(5).write.mode("overwrite").saveAsTable(f"care.{name}")
        spark.sql("CREATE OR REPLACE VIEW care.fact_view AS SELECT * FROM care.fact_a")
        result = compact_tables(spark, "care", "fact_", str(tmp_path / "out"), sort_cols={"fact_b": ["id"]})
        assert rows(result, "table_name", "status") == [("fact_a", "ok"), ("fact_b", "ok"), ("fact_view", "view")]
        assert spark.table("care.fact_a").count() == 100
        assert spark.table("care.fact_view").count() == 100
        assert len(spark.table("care.fact_a").inputFiles()) == 1
        assert len(spark.table("care.other").inputFiles()) == 5

        def fail(*args):
            raise RuntimeError("no space")

        monkeypatch.setattr(tables, "compact", fail)
        again = compact_tables(spark, "care", "oth", str(tmp_path / "out2"))
        assert rows(again) == [("other", "failed", "no space")]
    finally:
        spark.sql("DROP DATABASE care CASCADE")
