"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()
# Queries whose checks need an answer that SQL can't give are tested in tests/llm.
NAMES = [n for n in entry.queries() if n not in entry.LLM_QUERIES]


@pytest.fixture(scope="module")
def sql_tables(sf_dir):
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in data)


def test_every_query_has_sql():
    assert set(NAMES) == set(SQL) - set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, sql_tables, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = sql_tables.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())


def test_an_order_keeps_its_number_whatever_its_size(spark, sf_dir, tmp_path):
    """One order with very many line items is one document with all of them."""
    for name in ("orders", "customer", "nation", "part"):
        os.symlink(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = lines.selectExpr("max(l_orderkey)").first()[0]
    many = lines.where(f"l_orderkey = {key}").limit(1).crossJoin(spark.range(20_000)).drop("id")
    lines.where(f"l_orderkey <> {key}").union(many).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = entry.queries()["flatten_row_s"](spark, str(tmp_path)).where(f"orderNumber like '{key}%'")
    events = 2 if key % 4 == 0 else 1
    assert rows.groupBy("orderNumber").count().collect() == [(str(key), 20_000 * events)]


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
