"""Dead-letter routing, freshness, schema evolution and schema contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas
from orderlake.operators.aggregates import union_all


# --- dead letters --------------------------------------------------------------------
def whole_json(text: Column, kind: T.DataType) -> Column:
    """`text` as the field `x` of a struct that also has the corrupt-record field.

    The text is parsed as the value of a field, so arrays have a corrupt record too. The options
    keep Spark from parsing only the referenced fields, which would miss bad ones. Use it with
    `is_one_value`: a parser stops where the value it reads ends.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    fields = [T.StructField("x", kind), T.StructField(schemas.CORRUPT, T.StringType())]
    return F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), T.StructType(fields), options)


def is_one_value(text: Column) -> Column:
    """Whether a text in which `whole_json` finds a value is that one JSON value and no more.

    As the only element of an array it has length one. A text that closes more brackets than it
    opens ends either the array or the object around it too early, but not both.
    """
    length = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(length == 1, F.lit(False))


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """`df.filter(condition)`, evaluated where it stands: Spark pushes filters below projections,
    and what these parse would be parsed once more for the filter."""
    kept = F.explode(F.when(condition, F.array(F.lit(True))))
    return df.select("*", kept.alias("_kept")).drop("_kept")


def parse_checked(df: DataFrame, body_ddl: str = schemas.BODY_S) -> DataFrame:
    """Envelope rows plus `event` (typed body) and `is_valid`.

    A body is valid when it is one JSON object, white space around it aside, all of whose
    declared fields convert.
    """
    body = F.col("body")
    checked = df.withColumn("parsed", whole_json(body, schemas.struct(body_ddl)))
    clean = F.col("parsed.x").isNotNull() & F.col(f"parsed.{schemas.CORRUPT}").isNull()
    valid = body.rlike("^[ \\t\\n\\r]*\\{") & clean & is_one_value(body)
    return checked.withColumns({"event": F.col("parsed.x"), "is_valid": F.coalesce(valid, F.lit(False))}).drop("parsed")


def parse_checked_raw(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Raw rows with their JSON text columns (those in `names`) parsed, `broken`, the names of
    those that are not one value or do not convert, and `texts`, their texts where one is broken."""
    found = {
        name: schemas.struct(f"x {kind}")["x"].dataType
        for name, kind in schemas.RAW_JSON_H.items()
        if (names is None or name in names) and name in df.columns
    }
    parsed = df.withColumns({f"_{name}": whole_json(F.col(name), kind) for name, kind in found.items()})

    def broken(name: str) -> Column:
        value = F.col(f"_{name}")
        clean = value.isNotNull() & value[schemas.CORRUPT].isNull() & is_one_value(F.col(name))
        return F.when(F.col(name).isNotNull() & ~clean, F.lit(name))

    marked = parsed.withColumn("broken", F.array_compact(F.array(*[broken(n) for n in found])))
    texts = F.when(F.size("broken") > 0, F.struct(*found))
    values = {name: F.col(f"_{name}.x") for name in found}
    return marked.withColumn("texts", texts).withColumns(values).drop(*[f"_{n}" for n in found])


def whole_documents(checked: DataFrame) -> DataFrame:
    """The parsed rows of which no text is broken."""
    return keep(checked, F.size("broken") == 0).drop("broken", "texts")


def broken_documents(checked: DataFrame) -> DataFrame:
    """Dead letters: the other rows, unchanged, with `broken`."""
    rows = keep(checked, F.size("broken") > 0)
    texts = {n: F.col(f"texts.{n}") for n in checked.schema["texts"].dataType.names}
    return rows.withColumns(texts).drop("texts")


def split_raw(df: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed raw rows whose JSON texts all convert, dead letters). Persist `parse_checked_raw`
    and use the two functions above where both are written."""
    checked = parse_checked_raw(df, names)
    return whole_documents(checked), broken_documents(checked)


def split_valid(df: DataFrame, body_ddl: str = schemas.BODY_S) -> tuple[DataFrame, DataFrame]:
    """(typed good events, dead letters with their unchanged body). Row-level: one bad body
    does not take its batch along. Persist the input's `parse_checked` when both are written."""
    checked = df if "is_valid" in df.columns else parse_checked(df, body_ddl)
    meta = [c for c in checked.columns if c not in ("body", "event", "is_valid")]
    fields = schemas.struct(body_ddl).names
    good = keep(checked, F.col("is_valid")).select(*[F.col(f"event.{n}") for n in fields], *meta)
    bad = keep(checked, ~F.col("is_valid")).select("body", *meta)
    return good, bad


# --- freshness ---------------------------------------------------------------------
def freshness(
    tables: dict[str, DataFrame], ts: str, as_of: Column | None = None, window: str = "1 hour"
) -> DataFrame:
    """Rows per table with `ts` at or after `as_of - window`."""
    clock = F.current_timestamp() if as_of is None else as_of
    since = clock - F.expr(f"INTERVAL {window}")
    return union_all(
        [
            df.filter(F.col(ts) >= since)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ]
    )


def freshness_failures(counts: DataFrame) -> DataFrame:
    """One row: the names of the tables without fresh rows, in order; NULL when there are none."""
    names = F.when(F.col("n") == 0, F.col("table_name"))
    listed = F.concat_ws(", ", F.sort_array(F.collect_list(names)))
    return counts.agg(F.nullif(listed, F.lit("")).alias("failed_tables"))


def assert_fresh(counts: DataFrame) -> DataFrame:
    """Fails the query when a table has no fresh rows, else one row saying that all is well."""
    failed = F.col("failed_tables")
    message = F.concat(F.lit("no fresh records in tables: "), failed)
    verdict = F.when(failed.isNotNull(), F.raise_error(message).cast("string")).otherwise(
        F.lit("all tables are fresh")
    )
    return freshness_failures(counts).select(verdict.alias("result"))


def freshness_script(tables: list[str], ts: str, as_of: str = "current_timestamp()", window: str = "1 HOUR") -> str:
    """A SQL script over tables or views of the session: it counts the fresh rows of each table
    into a variable and then either raises an error that names the stale ones or says that all
    is well. `as_of` and `window` are SQL texts."""
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count_if(`{ts}` >= {as_of} - INTERVAL {window}) AS n FROM `{name}`" for name in tables
    )
    return f"""
        BEGIN
          DECLARE failed STRING;
          SET failed = (
            SELECT nullif(concat_ws(', ', sort_array(collect_list(CASE WHEN n = 0 THEN table_name END))), '')
            FROM ({counts}));
          IF failed IS NOT NULL THEN
            SELECT raise_error(concat('no fresh records in tables: ', failed)) AS result;
          ELSE
            SELECT 'all tables are fresh' AS result;
          END IF;
        END"""


# --- schema ------------------------------------------------------------------------
def evolve(df: DataFrame, new_columns: str) -> DataFrame:
    """Add the columns of a DDL text that are missing, as NULLs. Existing columns stay."""
    known = {c.lower() for c in df.columns}
    missing = [f for f in schemas.struct(new_columns) if f.name.lower() not in known]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select and cast to a contract; missing columns become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract
        ]
    )


def schema_problems(df: DataFrame, contract: T.StructType) -> list[str]:
    """Differences to a contract: missing or extra columns (case matters) and wrong types."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in contract}
    problems = [f"missing {n}" for n in want if n not in have]
    problems += [f"unexpected {n}" for n in have if n not in want]
    problems += [
        f"{n} is {have[n].simpleString()}, not {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    return problems


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The DataFrame itself, or a ValueError naming all differences."""
    problems = schema_problems(df, contract)
    if problems:
        raise ValueError("; ".join(problems))
    return df
