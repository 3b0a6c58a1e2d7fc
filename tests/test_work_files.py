"""What queries and batches leave on disk while they run."""

import json
import threading
import time

from conftest import plan, rows
from pyspark.sql import functions as F
from test_streaming import T0, document, land_bodies, land_raw

from orderlake import schemas
from orderlake.catalog import queries
from orderlake.operators import dedup
from orderlake.operators.dedup import dedup_latest, dedup_latest_stored, newest_first
from orderlake.operators.stored import StoredTable
from orderlake.plans import silver
from orderlake.session import child_names, shared_root
from orderlake.sources import sinks
from orderlake.streaming import upsert


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return [f for f in files.split("\n") if "/shuffle_" in f]


def test_shuffle_files_go_when_a_query_ends(spark):
    before = set(shuffle_files(spark))
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(counts.collect()) == 7 and counts.count() == 7
    deadline = time.time() + 10  # files are removed in the background
    while set(shuffle_files(spark)) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not set(shuffle_files(spark)) - before


def versions(spark, values):
    return spark.createDataFrame(values, "k STRING, s STRING, ts INT, v STRING")


def test_latest_of_stored_rows_is_the_latest(spark, monkeypatch):
    order = newest_first("ts", "v")
    odd = versions(spark, [("1", "a", 1, "x"), ("1", "a", 2, "y"), ("1", None, 1, "x"), (None, None, 1, "p"), (None, None, None, "q"), ("2", "a", None, "z")])
    for few in (dedup.FEW_KEYS, 1):
        monkeypatch.setattr(dedup, "FEW_KEYS", few)
        latest, as_read = dedup_latest_stored(odd, ["k", "s"], order)
        assert not as_read and latest.columns == odd.columns
        assert rows(latest) == rows(dedup_latest(odd, ["k", "s"], order))
    single = odd.filter("v <> 'y' AND v <> 'q'")
    latest, as_read = dedup_latest_stored(single, ["k", "s"], order)
    assert as_read and latest is single
    assert dedup_latest_stored(odd.limit(0), ["k", "s"], order)[1]


def test_no_more_than_two_tables_are_written_at_a_time(spark):
    running, most, lock = [0], [0], threading.Lock()

    def write(name, rows):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.3)
        with lock:
            running[0] -= 1

    assert sinks.fan_out(spark.range(3), {n: lambda d: d for n in "abcdef"}, write) == 3
    assert most[0] == 2


def test_ranks_follow_the_blocks(spark, tmp_path):
    """One shuffle ranks rows and lays them out, and the first load has none."""
    table = StoredTable(spark, str(tmp_path / "t"), ["k"], F.floor(F.col("k").cast("int") / 10))
    source = spark.createDataFrame([(str(i), v) for i in range(40) for v in ("a", "b")] + [(None, "c"), (None, "d")], "k STRING, v STRING")
    ranked = table.ranked(source, [F.col("v").desc()], 1)
    assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(ranked.filter("_nth > 1"), "k", "v") == sorted((str(i), "a") for i in range(40))
    ranked.write.parquet(str(tmp_path / "ranked"))
    winners = spark.read.parquet(str(tmp_path / "ranked")).filter("_nth = 1").drop("_nth")
    table.merge(winners, on_source_duplicates="assume_unique", in_files=True, in_blocks=True)
    assert rows(table.read()) == sorted([(str(i), "b") for i in range(40)] + [(None, "c"), (None, "d")], key=repr)


def test_batches_leave_small_dead_letters_and_no_work_files(spark, tmp_path):
    source, dead = str(tmp_path / "in"), str(tmp_path / "dead")
    twice = [{"bucketNumber": 1, "rows": [{"rowNumber": 1, "sku": "A"}, {"rowNumber": 1, "sku": "B"}]}]
    land_raw(spark, source, [document(1, "new", buckets=twice), document(2, "new"), document(2, "new", salesBrand="later")])
    raw = spark.read.schema(schemas.RAW_H).parquet(source)
    broken = raw.filter("orderNumber = '1'").withColumns({"orderNumber": F.lit("3"), "offers": F.lit("urgent")})
    tables = silver.silver_tables(spark, str(tmp_path / "silver"))
    before = set(child_names(spark, f"{shared_root(spark)}/orderlake"))
    silver.upsert_silver(raw.union(broken), tables, 0, F.lit(T0), dead_letters=dead)
    assert set(child_names(spark, f"{shared_root(spark)}/orderlake")) == before
    assert rows(tables["order"].read(), "order_bk", "salesBrand") == [("1_new", None), ("2_new", "later")]
    assert rows(tables["row"].read(), "row_bk", "SKU") == [("1_new_1_1", "B"), ("2_new_1_1", "A"), ("2_new_1_2", "B")]
    lost = sinks.read_dead_letters(spark, f"{dead}/consumer=silver/stage=duplicate_row", "row_bk STRING, SKU STRING")
    assert rows(lost, "row_bk", "SKU") == [("1_new_1_1", "A")]
    bad = sinks.read_dead_letters(spark, f"{dead}/consumer=silver/stage=parse", f"{schemas.RAW_H}, broken ARRAY<STRING>, _stamp STRING")
    assert rows(bad, "orderNumber", "offers", "broken", "_stamp") == [("3", "urgent", ["offers"], None)]
    assert all(f.endswith(".json.gz") for f in bad.inputFiles())
    # a replay of the batch changes nothing
    silver.upsert_silver(raw.union(broken), tables, 0, F.lit(T0), dead_letters=dead)
    assert tables["row"].read().count() == 3 and sinks.read_dead_letters(spark, f"{dead}/consumer=silver/stage=duplicate_row", "row_bk STRING").count() == 1


def test_batches_leave_no_shuffle_files_and_keep_rejected_texts_only(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    bodies = [json.dumps(document(i, "new")) for i in range(5)]
    for i in range(2):  # the second file brings the same events again
        land_bodies(spark, source, [*bodies, "[1]"])
    seen, left, usual, drop = [], [], upsert.fan_out, upsert.drop_shuffle_files

    def fan_out(batch, outputs, write):
        def texts(kept):
            seen.append(kept.filter("is_valid AND body IS NOT NULL").count())
            return outputs["order"](kept)

        return usual(batch, {**outputs, "order": texts}, write)

    monkeypatch.setattr(upsert, "fan_out", fan_out)
    monkeypatch.setattr(upsert, "drop_shuffle_files", lambda batch: (left.append(len(shuffle_files(spark))), drop(batch)))
    before = len(shuffle_files(spark))
    query = upsert.start_ingest_stream(spark, source, target, str(tmp_path / "cp"), max_files_per_trigger=1, as_of=F.lit(T0))
    query.awaitTermination()
    assert query.exception() is None and len(left) >= 2 and set(seen) == {0}
    deadline = time.time() + 10
    while len(shuffle_files(spark)) > before and time.time() < deadline:
        time.sleep(0.1)
    assert max(left) > before and len(shuffle_files(spark)) <= before
    assert sinks.read_appended(spark, f"{target}/orderupdates_orderstream").count() == 5
    bad = sinks.read_dead_letters(spark, f"{target}/deadletters", "body STRING")
    assert rows(bad, "body") == [("[1]",)]


def test_order_streams_are_parsed_once(spark, sf_dir):
    """A query that reads the orders twice reads them from files; they are those of the bodies."""
    stored = queries.stored_stream(spark, sf_dir, "order")
    assert "from_json" not in plan(stored) and "to_json" not in plan(stored) and stored.inputFiles()
    made = queries.stream_table(spark, sf_dir, "order")
    assert stored.schema == made.schema and rows(stored) == rows(made)
    assert "from_json" in plan(queries.stored_stream(spark, sf_dir, "payment"))
    assert "from_json" not in plan(queries.QUERIES["late_event_applied"](spark, sf_dir))


def test_landings_have_more_files_where_there_is_more(spark, sf_dir, monkeypatch):
    assert queries._landing_files(spark, sf_dir) == 4
    monkeypatch.setattr(queries.tables, "listed_bytes", lambda df: 640 << 20)
    assert queries._landing_files(spark, sf_dir) == 10
