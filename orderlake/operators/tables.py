"""Care of stored tables: detail, compaction, catalog metadata, added columns."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.session import child_names, delete_folder, entry_sizes, move

WORKERS = 5  # fixed value: tables compacted side by side


# --- table care -------------------------------------------------------------------------
def file_sizes(df: DataFrame) -> DataFrame:
    """`file`, `bytes`, `rows` of each file of a file-backed DataFrame."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def table_detail(df: DataFrame) -> DataFrame:
    """One row: number of files, bytes and rows of a file-backed DataFrame."""
    return file_sizes(df).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("bytes").alias("size_bytes"),
        F.sum("rows").alias("num_rows"),
    )


def listed_bytes(df: DataFrame) -> int:
    """Bytes of the files of a file-backed DataFrame, from the listing of their folders."""
    by_folder: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, _, name = unquote(file).rpartition("/")
        by_folder.setdefault(folder, set()).add(name)
    sizes = (entry_sizes(df.sparkSession, folder) for folder in by_folder)
    return sum(size for names, found in zip(by_folder.values(), sizes) for name, size in found.items() if name in names)


def compact(
    df: DataFrame, out_path: str, target_bytes: int = 512 * 1024 * 1024,
    sort_cols: list[str] | None = None, partition_by: list[str] | None = None,
) -> DataFrame:
    """Rewrite a file-backed DataFrame into files of about `target_bytes`; returns the copy.

    Without sort columns, neighbouring input partitions are joined and nothing is shuffled.
    With them, rows are range-partitioned by the columns and, last, by a hash of the row: a
    value that fills a large part of the table is cut into several files. A table with
    partition columns is ranged by these first, so each partition gets few files.
    """
    files = max(1, -(-listed_bytes(df) // target_bytes))
    by = [*(partition_by or []), *(sort_cols or [])]
    if by:
        ranged = df.repartitionByRange(files, *by, F.xxhash64(*df.columns))
        packed = ranged.sortWithinPartitions(*by)
    else:
        packed = df.coalesce(files)
    writer = packed.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out_path)
    return df.sparkSession.read.schema(df.schema).parquet(out_path)


COMPACTING = "_compacting"  # hidden from readers, as its name begins with an underscore


def compact_files(
    spark: SparkSession, path: str, target_bytes: int = 512 * 1024 * 1024, small_bytes: int | None = None
) -> DataFrame:
    """Join the small files of each folder of a Parquet table, in place; large files stay.

    Files below `small_bytes` (three quarters of the target) are small; a folder with fewer than
    two of them is left alone. The joined files are first written completely beside the others.
    Then the small ones are removed and the joined ones moved in; a run that died in between
    is finished by the next one, so no row is lost or doubled, but a reader of just this moment
    may miss some. Returns a row per folder: files before and after, and how many were joined.
    """
    small = target_bytes * 3 // 4 if small_bytes is None else small_bytes
    folders = [path.rstrip("/"), *partition_folders(spark, path)]

    def one(folder: str) -> tuple[str, int, int, int] | None:
        _finish_compaction(spark, folder)
        files = {n: size for n, size in entry_sizes(spark, folder).items() if n[0] not in "_."}
        few = sorted(n for n, size in files.items() if size < small)
        if not files:
            return None
        if len(few) < 2:
            return folder, len(files), len(files), 0
        work, total = f"{folder}/{COMPACTING}", sum(files[n] for n in few)
        names = spark.createDataFrame([(n,) for n in few], "value STRING")
        names.coalesce(1).write.mode("overwrite").text(f"{work}/inputs")
        rows = spark.read.option("mergeSchema", "true").parquet(*[f"{folder}/{n}" for n in few])
        rows.coalesce(-(-total // target_bytes)).write.mode("overwrite").parquet(f"{work}/files")
        _finish_compaction(spark, folder)
        after = [n for n in entry_sizes(spark, folder) if n[0] not in "_."]
        return folder, len(files), len(after), len(few)

    with ThreadPoolExecutor(max_workers=WORKERS) as pool:
        found = [r for r in pool.map(one, folders) if r]
    return spark.createDataFrame(found, "folder STRING, files_before INT, files_after INT, joined INT")


def _finish_compaction(spark: SparkSession, folder: str) -> None:
    """Replace the small files by the joined ones where these are complete."""
    work = f"{folder}/{COMPACTING}"
    made = child_names(spark, f"{work}/files")
    if "_SUCCESS" in made:
        for r in spark.read.text(f"{work}/inputs").collect():
            delete_folder(spark, f"{folder}/{r['value']}")
        for name in made:
            if name[0] not in "_.":
                move(spark, f"{work}/files/{name}", f"{folder}/{name}")
    delete_folder(spark, work)


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Partition folders (`name=value`) below a folder, at any depth."""
    own = [f"{path.rstrip('/')}/{n}" for n in child_names(spark, path) if "=" in n and n[0] not in "_."]
    return [f for folder in own for f in (folder, *partition_folders(spark, folder))]


def compact_tables(
    spark: SparkSession,
    database: str,
    prefix: str,
    out_root: str,
    target_bytes: int = 512 * 1024 * 1024,
    sort_cols: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Compact every catalog table of a database whose name starts with `prefix`.

    Each table is rewritten below `out_root`, then its location is switched, so readers see
    either the old or the new files. Of a partitioned table this holds for each partition: these
    are rewritten one by one, so without sort columns nothing is sorted or shuffled. With them the
    table is rewritten as one. Views are skipped. Tables are worked on side by side. Returns one
    row per item.
    """
    results, work = [], []
    for item in spark.catalog.listTables(database):
        if item.isTemporary or not item.name.startswith(prefix):
            continue
        name = f"`{database}`.`{item.name}`"
        if item.tableType == "VIEW":
            results.append((item.name, "view", None))
            continue
        work.append((item.name, name, f"{out_root.rstrip('/')}/{item.name}"))

    def one(short: str, name: str, out: str) -> tuple[str, str, str | None]:
        try:
            keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
            by = (sort_cols or {}).get(short)
            if not keys or by:
                compact(spark.table(name), out, target_bytes, by, keys)
            if not keys:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{out}'")
            for row in spark.sql(f"SHOW PARTITIONS {name}").collect() if keys else []:
                values = [part.partition("=")[::2] for part in row[0].split("/")]
                spec = ", ".join(f"`{k}`='{unescaped(v)}'" for k, v in values)
                if not by:
                    compact(partition_rows(spark.table(name), values), f"{out}/{row[0]}", target_bytes)
                spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{out}/{row[0]}'")
            spark.catalog.refreshTable(name)
            return short, "ok", None
        except Exception as e:  # one bad table must not keep the others from being compacted
            return short, "failed", str(e).splitlines()[0]

    if work:
        with ThreadPoolExecutor(max_workers=WORKERS) as pool:
            results += pool.map(lambda item: one(*item), work)
    return spark.createDataFrame(results, "table_name STRING, status STRING, error STRING")


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of rows whose partition column is NULL


def partition_rows(df: DataFrame, values: list[tuple[str, str]]) -> DataFrame:
    """Rows of one partition, given by the parts of its folder's name, without these columns."""
    for name, value in values:
        column = F.col("`" + unquote(name).replace("`", "``") + "`")
        df = df.filter(column.isNull() if value == NO_VALUE else column.cast("string") == unquote(value))
    return df.drop(*[unquote(name) for name, _ in values])


def unescaped(value: str) -> str:
    """A partition value as it stands in SQL text, from its form in a folder name."""
    return unquote(value).replace("\\", "\\\\").replace("'", "\\'")


# --- catalog ------------------------------------------------------------------------------
def tables_like(spark: SparkSession, database: str, prefix: str = "") -> DataFrame:
    """`table_name` of the stored tables and views of a database whose names start with `prefix`."""
    found = spark.sql(f"SHOW TABLES IN `{database}`").filter(~F.col("isTemporary"))
    return found.filter(F.col("tableName").startswith(prefix)).select(F.col("tableName").alias("table_name"))


def table_properties(spark: SparkSession, table: str, like: str = "%") -> DataFrame:
    """`key`, `value` of a catalog table's properties whose keys are LIKE the pattern."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key").like(like))


def add_stored_columns(spark: SparkSession, table: str, new_columns: str) -> list[str]:
    """Add the columns of a DDL text that a catalog table lacks, and name them. Its files stay as
    they are: rows of old files read NULL there."""
    known = {c.lower() for c in spark.table(table).columns}
    missing = [f for f in schemas.struct(new_columns) if f.name.lower() not in known]
    if missing:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return [f.name for f in missing]
