"""Upsert, delete and change reads as plain joins over two DataFrames.

Nothing here writes: a merge returns the next state of the target. `stored.StoredTable` stores
such states.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators.dedup import dedup_latest

# Columns of a flagged state: what happened to a row, and the row it replaced.
CHANGE, BEFORE = "_change_type", "_before"

# A merge source below this many bytes (its rows as text, measured) may be broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024


def has_null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as JSON text: one narrow pass with a partial sum. Use on staged data."""
    # to_json leaves NULL fields out, so each column counts eight bytes besides.
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 8 * len(df.columns))
    return df.agg(F.coalesce(size, F.lit(0)).cast("long")).first()[0]


def fail_on_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Same rows, but the query fails once it meets a second row of one key.

    Only two rows per key survive the map-side group limit, so a hot key stays cheap.
    """
    first_or_second = Window.partitionBy(*keys).orderBy(*keys)
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("several source rows for one merge key: "), shown)
    unique = F.when(F.col("_nth") == 1, F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return (
        df.withColumn("_nth", F.row_number().over(first_or_second))
        .filter(F.col("_nth") <= 2)
        .filter(unique)
        .drop("_nth")
    )


def one_row_per_key(
    source: DataFrame, keys: list[str], mode: str, order_by: list[Column] | None
) -> DataFrame:
    if mode == "assume_unique":
        return source
    if mode == "error":
        return fail_on_duplicates(source, keys)
    if mode == "latest":
        if not order_by:
            raise ValueError("on_source_duplicates='latest' needs order_by")
        return dedup_latest(source, keys, order_by)
    raise ValueError(f"unknown on_source_duplicates: {mode}")


def _next_state(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    guard: Column,
    how: str,
    flags: bool = False,
    images: bool = False,
) -> DataFrame:
    """Join both sides and pick, row by row, the side that wins.

    Presence flags decide what is matched; column NULLs never do, so real NULLs overwrite.
    A guard that is NULL counts as false. With `flags`, CHANGE tells inserts and updates; with
    `images`, BEFORE holds the row that was updated. An update to the same values is none.
    """
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    inserted = F.col("_in_target").isNull()
    updated = F.col("_in_source").isNotNull() & F.coalesce(guard, F.lit(False))
    take_source = inserted | updated

    def pick(name: str) -> Column:
        if name not in target.columns:  # added by the source: old rows read NULL
            return F.when(take_source, F.col(f"s.{name}")).alias(name)
        old, kind = F.col(f"t.{name}"), target.schema[name].dataType
        if name not in source.columns:  # unknown to the source: kept as it is
            return old.alias(name)
        return F.when(take_source, F.col(f"s.{name}").cast(kind)).otherwise(old).alias(name)

    names = target.columns + [c for c in source.columns if c not in target.columns]
    extra = []
    if flags:
        both = [c for c in source.columns if c not in keys]
        old = {f.name: F.col(f"t.{f.name}") for f in target.schema}
        new = {c: F.col(f"s.{c}").cast(target.schema[c].dataType) if c in old else F.col(f"s.{c}") for c in both}
        same = reduce(lambda a, b: a & b, [new[c].eqNullSafe(old.get(c)) for c in both], F.lit(True))
        changed = F.col("_in_target").isNotNull() & updated & ~same
        extra.append(F.when(inserted, F.lit("insert")).when(changed, F.lit("update")).alias(CHANGE))
        if images:
            extra.append(F.when(changed, F.struct(*[old[c].alias(c) for c in old])).alias(BEFORE))
    return t.join(s, on, how).select(*[pick(n) for n in names], *extra)


def merge_flagged(
    target: DataFrame, source: DataFrame, keys: list[str], guard: str | None = None, images: bool = False
) -> DataFrame:
    """`merge_upsert` of sides with unique, complete keys; every row is flagged with its change."""
    condition = F.lit(True) if guard is None else F.expr(guard)
    return _next_state(target, source, keys, condition, "full_outer", True, images)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    guard: str | Column | None = None,
    on_source_duplicates: str = "error",
    order_by: list[Column] | None = None,
    null_keys: str = "insert",
    keys_not_null: bool = False,
    strategy: str = "shuffle",
) -> DataFrame:
    """Next state of `target` after upserting `source`.

    guard                 condition over `t.` and `s.` columns; matched rows are updated only
                          where it is true (None: always).
    on_source_duplicates  "error", "latest" (needs order_by) or "assume_unique".
    null_keys             a NULL key never matches: "insert" adds such source rows again,
                          "quarantine" leaves them out (see `split_null_keys`).
    keys_not_null         promise that no key is NULL on either side; saves the side branch,
                          for which a side with nullable keys is read a second time.
    strategy              "shuffle": one full outer join. "auto": measures the (staged) source;
                          below BROADCAST_LIMIT it goes to every executor and the target is
                          not shuffled, else as "shuffle".
    """
    if null_keys not in ("insert", "quarantine"):
        raise ValueError(f"unknown null_keys: {null_keys}")
    if strategy not in ("shuffle", "auto"):
        raise ValueError(f"unknown strategy: {strategy}")
    condition = F.lit(True) if guard is None else F.expr(guard) if isinstance(guard, str) else guard

    def nullable(df: DataFrame) -> bool:
        return not keys_not_null and any(df.schema[k].nullable for k in keys)

    # Rows with a NULL key go around the join: they match nothing, and in a join they would
    # all meet in one partition.
    extra = []
    keyed_target, keyed_source = target, source
    if nullable(target):
        keyed_target = target.filter(~has_null_key(keys))
        extra.append(target.filter(has_null_key(keys)))
    if nullable(source):
        keyed_source = source.filter(~has_null_key(keys))
        if null_keys == "insert":
            extra.append(source.filter(has_null_key(keys)))
    keyed_source = one_row_per_key(keyed_source, keys, on_source_duplicates, order_by)

    small = strategy == "auto" and measured_bytes(keyed_source) < BROADCAST_LIMIT
    if not small:
        state = _next_state(keyed_target, keyed_source, keys, condition, "full_outer")
    else:
        # Matched keys are a subset of the small source, so both joins below broadcast a
        # side of the checked size; the second reads only the key columns of the target.
        kept = _next_state(keyed_target, F.broadcast(keyed_source), keys, condition, "left")
        source_keys = F.broadcast(keyed_source.select(*keys))
        matched = keyed_target.select(*keys).join(source_keys, keys, "left_semi")
        fresh = keyed_source.join(matched, keys, "left_anti")
        extra.insert(0, fresh)
        state = kept

    for more in extra:
        aligned = more.select(
            *[F.col(f.name).cast(f.dataType) for f in state.schema if f.name in more.columns]
        )
        state = state.unionByName(aligned, allowMissingColumns=True)
    return state


def split_null_keys(source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with complete keys, rows to quarantine)."""
    return source.filter(~has_null_key(keys)), source.filter(has_null_key(keys))


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows left after deleting those where the condition is true (NULL deletes nothing)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(cond, F.lit(False)))


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    guard: str | Column | None = None,
    delete_unmatched: str | Column | None = None,
    version: int | None = None,
) -> DataFrame:
    """The row changes that a merge makes, out of its one join: insert, update_preimage and
    update_postimage, and delete for target rows that no source row matches and for which
    `delete_unmatched` (a condition on `t.` columns) is true.

    Source keys are unique. A source row with a NULL key matches nothing: it is an insert.
    """
    names = target.columns
    text = lambda c: F.expr(c) if isinstance(c, str) else c
    condition = F.lit(True) if guard is None else text(guard)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    in_target, in_source = F.col("_in_target").isNotNull(), F.col("_in_source").isNotNull()
    deleted = F.lit(False) if delete_unmatched is None else text(delete_unmatched)

    def image(side: str, kind: str) -> Column:
        columns = [
            (F.col(f"{side}.{f.name}") if side == "t" or f.name in source.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema
        ]
        return F.struct(F.lit(kind).alias("_change_type"), *columns)

    updates = F.array(image("t", "update_preimage"), image("s", "update_postimage"))
    images = (
        F.when(in_target & in_source & F.coalesce(condition, F.lit(False)), updates)
        .when(~in_target, F.array(image("s", "insert")))
        .when(~in_source & F.coalesce(deleted, F.lit(False)), F.array(image("t", "delete")))
    )
    how = "right" if delete_unmatched is None else "full_outer"
    changes = t.join(s, on, how).select(F.explode(images).alias("c")).select("c.*")
    changes = changes.select("_change_type", *names)
    return changes if version is None else changes.withColumn("_commit_version", F.lit(version).cast("long"))


def read_changes(
    before: DataFrame, after: DataFrame, keys: list[str], version: int | None = None
) -> DataFrame:
    """Row changes between two states: insert, delete, update_preimage, update_postimage.

    Keys are unique where they are not NULL. Rows with a NULL key have no identity, so they
    are compared as a multiset and only ever count as inserted or deleted.
    """
    names = after.columns
    old = before.filter(~has_null_key(keys)).withColumn("_old", F.lit(True)).alias("b")
    new = after.filter(~has_null_key(keys)).withColumn("_new", F.lit(True)).alias("a")
    on = reduce(lambda x, y: x & y, [F.col(f"b.{k}") == F.col(f"a.{k}") for k in keys])
    same = reduce(
        lambda x, y: x & y,
        [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in names if c not in keys],
        F.lit(True),
    )
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def image(side: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), *[F.col(f"{side}.{c}") for c in names])

    images = (
        F.when(both, F.array(image("b", "update_preimage"), image("a", "update_postimage")))
        .when(F.col("_new").isNotNull(), F.array(image("a", "insert")))
        .otherwise(F.array(image("b", "delete")))
    )
    changed = old.join(new, on, "full_outer").filter(~(both & same))
    keyed = changed.select(F.explode(images).alias("c")).select("c.*")

    columns = ["_change_type", *names]
    if not any(d.schema[k].nullable for d in (before, after) for k in keys):
        return keyed if version is None else keyed.withColumn("_commit_version", F.lit(version).cast("long"))
    old_loose, new_loose = (d.filter(has_null_key(keys)).select(*names) for d in (before, after))
    added = new_loose.exceptAll(old_loose).withColumn("_change_type", F.lit("insert"))
    removed = old_loose.exceptAll(new_loose).withColumn("_change_type", F.lit("delete"))
    changes = keyed.unionByName(added.select(*columns)).unionByName(removed.select(*columns))
    return changes if version is None else changes.withColumn("_commit_version", F.lit(version).cast("long"))
