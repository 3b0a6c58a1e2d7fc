"""Upserts into plain Parquet tables that are partitioned by ranges of their key.

A table is a folder of Parquet files below `block=<n>`. A merge reads and replaces only the blocks
its source touches, with dynamic partition overwrite. The new content of these blocks is first
written beside the table and then copied in, so a writer that dies leaves either nothing or a
complete copy, which the next write puts in place. With `record_changes`, the same copy yields
the row changes: they are appended below `_changes/version=<n>` and read back from a version on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.merge import (
    BEFORE,
    CHANGE,
    has_null_key,
    merge_flagged,
    one_row_per_key,
    split_null_keys,
)
from orderlake.session import child_names, delete_folder, folder_bytes, mark_complete, setting

BLOCK, PART = "block", "_part"
CODEC = "zstd"  # of all files of a table
ORDERS_PER_BLOCK = 1_000_000
OTHER_BLOCKS, LOOSE_BLOCKS = 64, 16  # for orders without a number, and for rows without a key
PART_BYTES = 16 << 20  # of rows as snappy files that one task merges or rewrites; rows take some 25 times that


def order_block(business_key: str, orders_per_block: int = ORDERS_PER_BLOCK) -> Column:
    """Block of the order a business key starts with: numbered orders by number, others by hash
    below zero. Orders that arrive together then share a few blocks."""
    order = F.substring_index(business_key, "_", 1)
    other = -1 - F.pmod(F.xxhash64(order), F.lit(OTHER_BLOCKS))
    return F.coalesce(F.floor(order.try_cast("bigint") / orders_per_block), other)


class StoredTable:
    """An upsertable Parquet table of one key. One writer at a time.

    block           column of whole numbers that is a function of the key. Where new and changed
                    keys lie close together, a batch then touches few blocks of a large table.
    schema          columns; without it they are merged from the files, which opens all footers,
                    so declare it for large tables. Columns that a source adds are stored, but a
                    declared schema has to name them before they are read.
    record_changes  keep the row changes of every merge and delete.

    Rows with a NULL key match nothing: each merge inserts them again, also that of a batch which
    is replayed; leave them out with `null_keys="quarantine"` where that matters. They have blocks
    of their own, by content. A replayed batch of complete keys changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        block: Column,
        schema: T.StructType | None = None,
        record_changes: bool = False,
        part_bytes: int = PART_BYTES,
    ):
        self.spark, self.path, self.keys, self.block = spark, path.rstrip("/"), keys, block
        self.schema, self.record_changes = schema, record_changes
        self.part_bytes = part_bytes // 2  # of zstd files, about half as large

    # --- reading ----------------------------------------------------------------------
    def exists(self) -> bool:
        return "_SUCCESS" in child_names(self.spark, self.path)

    def _read(self) -> DataFrame:
        if not self.exists():
            raise ValueError(f"{self.path} is no table yet")
        reader = self.spark.read
        if self.schema is None:
            rows = reader.option("mergeSchema", "true").parquet(self.path)
        else:
            rows = reader.schema(T.StructType(self.schema.fields).add(BLOCK, "long")).parquet(self.path)
        return rows.withColumn(BLOCK, F.col(BLOCK).cast("long"))

    def read(self) -> DataFrame:
        return self._read().drop(BLOCK)

    def blocks(self, numbers: list[int]) -> DataFrame:
        """Rows of some blocks, with their number: no other folder is read."""
        return self._read().filter(F.col(BLOCK).isin(numbers))

    def changes(self, since: int = 0) -> DataFrame:
        """Recorded changes from version `since` on; older folders are not read."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/_changes")
        found = rows.filter(F.col("version") >= since)
        return found.withColumn("_commit_version", F.col("version").cast("long")).drop("version")

    # --- writing ---------------------------------------------------------------------
    def merge(
        self,
        source: DataFrame,
        guard: str | None = None,
        on_source_duplicates: str = "error",
        order_by: list[Column] | None = None,
        null_keys: str = "insert",
        in_files: bool = False,
        in_blocks: bool = False,
    ) -> bool:
        """Upsert. False if the source has no rows: then no table is created or changed.

        The first load takes every row of a source, unless duplicates are settled by "latest".
        A source that is read from files (`in_files`) is read again where others are persisted; if
        these files follow the blocks (`in_blocks`), the first load does not shuffle.
        """
        self.recover()
        known = self.exists()
        if not known and on_source_duplicates == "error":
            on_source_duplicates = "assume_unique"
        kept: list[DataFrame] = []
        try:
            rows = self._unique(source, on_source_duplicates, order_by, null_keys, kept)
            rows = rows.withColumn(BLOCK, self._block_of(rows))
            if not in_files and (known or self.record_changes):
                rows = rows.persist()
                kept.append(rows)
            if not known and not self.record_changes:
                return self._create(rows, in_blocks)
            touched = [r[0] for r in rows.select(BLOCK).distinct().collect()]
            if not touched:
                return False
            state = self._merged(rows, touched, guard) if known else rows.withColumn(CHANGE, F.lit("insert"))
            self._stage(state, "merge")
            return True
        finally:
            for df in kept:
                df.unpersist()

    def delete(self, condition: str | Column) -> bool:
        """Remove the rows for which the condition is true. Blocks without such rows stay as they
        are. False if there was no such row."""
        self.recover()
        found = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
        touched = [r[0] for r in self._read().filter(found).select(BLOCK).distinct().collect()]
        if touched:
            self._stage(self.blocks(touched).withColumn(CHANGE, F.when(found, F.lit("delete"))), "delete")
        return bool(touched)

    def recover(self) -> None:
        """Put in place what an earlier write has staged completely; drop what it has not."""
        for name in child_names(self.spark, f"{self.path}/_staged"):
            staged = f"{self.path}/_staged/{name}"
            if "_SUCCESS" in child_names(self.spark, staged):
                self._apply(staged, *name.rpartition("-")[::2])
            delete_folder(self.spark, staged)

    def ranked(self, rows: DataFrame, order_by: list[Column], stored_bytes: int) -> DataFrame:
        """Rows with `_nth`, their place among the rows of their key (1 without a key), in tasks that
        follow the blocks, so that neither the ranks nor a first load shuffle once more.
        `stored_bytes` is the size of the files that the rows are read from."""
        laid = rows.withColumn(BLOCK, self._block_of(rows)).withColumn(PART, F.hash(*self.keys))
        parts = -(-stored_bytes // self.part_bytes)
        usual = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Without a number, small partitions are joined.
        laid = laid.repartitionByRange(*([parts] if parts > usual else []), BLOCK, PART)
        nth = F.row_number().over(Window.partitionBy(BLOCK, PART, *self.keys).orderBy(*order_by))
        return laid.withColumn("_nth", F.when(has_null_key(self.keys), 1).otherwise(nth)).drop(BLOCK, PART)

    def _block_of(self, df: DataFrame) -> Column:
        loose = -1 - OTHER_BLOCKS - F.pmod(F.xxhash64(*df.columns), F.lit(LOOSE_BLOCKS))
        return F.when(has_null_key(self.keys), loose).otherwise(self.block).cast("long")

    def _create(self, rows: DataFrame, in_blocks: bool = False) -> bool:
        """First load, straight into the folder, which counts as a table once it is complete.
        Rebalancing gathers small blocks in one task and cuts a block that one key fills."""
        seen = Observation()
        laid = rows if in_blocks else rows.hint("rebalance", BLOCK)
        writer = laid.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", CODEC)
        writer.mode("overwrite").partitionBy(BLOCK).parquet(self.path)
        if not seen.get["n"]:
            delete_folder(self.spark, self.path)
        return bool(seen.get["n"])

    def _merged(self, rows: DataFrame, touched: list[int], guard: str | None) -> DataFrame:
        """Next state of the touched blocks, each row flagged with its change."""
        old = self.blocks(touched)
        parts = self._parts()
        old_keyed, old_loose = split_null_keys(old, self.keys)
        new_keyed, new_loose = split_null_keys(rows, self.keys)
        # Both sides are partitioned by block and, within large blocks, by key, so the join and the
        # write need no further shuffle. Rows without a key skip all of it.
        part = F.pmod(F.hash(*self.keys), F.lit(parts))
        sides = [d.withColumn(PART, part).repartition(parts * len(touched), BLOCK, PART) for d in (old_keyed, new_keyed)]
        state = merge_flagged(*sides, [BLOCK, PART, *self.keys], guard, images=self.record_changes).drop(PART)
        for loose, change in ((old_loose, None), (new_loose, "insert")):
            # A table keeps the types of its columns, whatever a source brings.
            typed = loose.select(*[F.col(f.name).cast(f.dataType) for f in state.schema if f.name in loose.columns])
            typed = typed.withColumn(CHANGE, F.lit(change).cast("string"))
            state = state.unionByName(typed, allowMissingColumns=True)
        return state

    def _parts(self) -> int:
        """Tasks for a block of average size."""
        blocks = [n for n in child_names(self.spark, self.path) if n.startswith(f"{BLOCK}=")]
        average = folder_bytes(self.spark, self.path, f"{BLOCK}=") // max(1, len(blocks))
        return max(1, -(-average // self.part_bytes))

    def _stage(self, state: DataFrame, kind: str) -> None:
        names = child_names(self.spark, f"{self.path}/_changes")
        version = 1 + max([int(n.partition("=")[2]) for n in names if n.startswith("version=")], default=0)
        state.write.option("compression", CODEC).mode("overwrite").parquet(f"{self.path}/_staged/{kind}-{version}")
        self.recover()

    def _apply(self, staged: str, kind: str, version: str) -> None:
        """Both steps may be repeated: they replace whole folders."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(staged)
        lives = ~F.col(CHANGE).eqNullSafe("delete")
        columns = [c for c in rows.columns if c not in (CHANGE, BEFORE)]
        if self.record_changes:
            _images(rows, columns).write.option("compression", CODEC).mode("overwrite").parquet(f"{self.path}/_changes/version={version}")
        # The writer sorts what a task reads by block, so a task reads no more than one that merges.
        with setting(self.spark, "spark.sql.files.maxPartitionBytes", str(self.part_bytes)):
            _write_blocks(rows.filter(lives).select(*columns), self.path)
        if not self.exists():
            mark_complete(self.spark, self.path)
        if kind == "delete":
            left = rows.groupBy(BLOCK).agg(F.max(lives).alias("left")).filter("NOT left")
            for r in left.select(BLOCK).collect():
                delete_folder(self.spark, f"{self.path}/{BLOCK}={r[0]}")

    def _unique(
        self, source: DataFrame, mode: str, order_by: list[Column] | None, null_keys: str, kept: list[DataFrame]
    ) -> DataFrame:
        """The source with one row per complete key; rows with a NULL key all stay or all go."""
        if mode == "assume_unique":
            return source if null_keys == "insert" else split_null_keys(source, self.keys)[0]
        if any(source.schema[k].nullable for k in self.keys):
            source = source.persist()  # read by both branches below
            kept.append(source)
            keyed, loose = split_null_keys(source, self.keys)
        else:
            keyed, loose = source, None
        keyed = one_row_per_key(keyed, self.keys, mode, order_by)
        return keyed if loose is None or null_keys == "quarantine" else keyed.unionByName(loose)


def _write_blocks(rows: DataFrame, path: str) -> None:
    """Replace the blocks that have rows; all others stay."""
    writer = rows.write.option("compression", CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BLOCK).parquet(path)


def _images(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Change rows of a staged state: an update has an image from before and one from after."""
    columns = [c for c in columns if c != BLOCK]

    def image(kind: Column, prefix: str = "") -> Column:
        return F.struct(kind.alias(CHANGE), *[F.col(prefix + c).alias(c) for c in columns])

    single = F.array(image(F.col(CHANGE)))
    images = single
    if BEFORE in rows.columns:
        before = {f.name for f in rows.schema[BEFORE].dataType.fields}
        none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in columns}
        fields = [(F.col(BEFORE)[c] if c in before else none[c]).alias(c) for c in columns]
        pre = F.struct(F.lit("update_preimage").alias(CHANGE), *fields)
        images = F.when(F.col(CHANGE) == "update", F.array(pre, image(F.lit("update_postimage")))).otherwise(single)
    return rows.filter(F.col(CHANGE).isNotNull()).select(F.explode(images).alias("c")).select("c.*")


def replay(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A later state from an earlier one and the changes since: the last change of a key counts.
    Rows without a key only come and go: their inserts are added, their deletes taken away."""
    after = changes.filter(f"{CHANGE} <> 'update_preimage'")
    keyed = after.filter(~has_null_key(keys))
    last = keyed.groupBy(*keys).agg(F.max_by(F.struct(*keyed.columns), "_commit_version").alias("c")).select("c.*")
    old, loose = split_null_keys(state, keys)
    kept = old.join(last.select(*keys), keys, "left_anti").select(*state.columns)
    came = last.filter(f"{CHANGE} <> 'delete'").select(*state.columns)
    lost = after.filter(has_null_key(keys) & (F.col(CHANGE) == "delete")).select(*state.columns)
    added = after.filter(has_null_key(keys) & (F.col(CHANGE) == "insert")).select(*state.columns)
    return kept.unionByName(came).unionByName(loose.unionByName(added).exceptAll(lost))
