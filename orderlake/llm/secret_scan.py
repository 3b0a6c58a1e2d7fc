"""Secrets in every version of every text, by a ledger of scanned contents.

A version's content is addressed by the SHA-256 of its text. The ledger, a Parquet folder, has
one row for each content, rule and version of the rule that was scanned: the spans found, or
none. A run scans only the (content, rule version) pairs that the ledger lacks, appends them,
and joins the findings back to all rows that hold the content. A changed rule gets a new
version and is scanned anew; old rows stay for its older versions.

Only DataFrame functions are used. Spans are found by splitting a text at a rule's matches: the
lengths of the parts and of the matches between them add up to the positions.

Rows: one result row per input row. NULL texts count as empty; an empty text has no secrets
and an empty list of spans. Repeated rows each get their row. Other columns are not read. An
empty table gives an empty result and leaves the ledger as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import sent_if_small, stored
from orderlake.session import child_names, work_path


@dataclass(frozen=True)
class Rule:
    """A pattern; of its leftmost matches those count whose `group` has `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str  # a cheap pattern that every text with a counting match contains


# The kinds of secrets, in the order in which ties are listed.
RULES = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ),
    Rule("access", 1, r"(AKIA[A-Z0-9]+)", 1, 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"([0-9a-f]+)", 1, 24, "[0-9a-f]{24}"),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:int,stop:int>>"
_NO_SPANS = "CAST(array() AS array<struct<start:int,stop:int>>)"


def blob_of(text: Column) -> Column:
    """Content address of a text; a NULL text is an empty one."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def spans_of(text: Column, rule: Rule) -> Column:
    """Positions (code points, end exclusive) of the matches of a rule, from the left."""
    pattern = F.lit(rule.pattern)
    parts = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    # Each step adds the part before a match and the match itself to the position so far.
    steps = F.zip_with(
        F.slice(parts, F.lit(1), F.size(found)),
        F.zip_with(found, values, lambda m, v: F.struct(m.alias("m"), v.alias("v"))),
        lambda p, mv: F.struct(
            F.char_length(p).alias("before"), F.char_length(mv["m"]).alias("length"),
            (F.char_length(mv["v"]) >= rule.least).alias("counts"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr(_NO_SPANS).alias("spans"))
    walked = F.aggregate(
        steps,
        start,
        lambda acc, s: F.struct(
            (acc["at"] + s["before"] + s["length"]).alias("at"),
            F.when(
                s["counts"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + s["before"]).alias("start"),
                            (acc["at"] + s["before"] + s["length"]).alias("stop"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(text.rlike(rule.hint), walked).otherwise(F.expr(_NO_SPANS))


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return the ledger.

    `versions` has a column `text`. Distinct contents are shuffled once, by their address.
    """
    spark = versions.sparkSession
    names = child_names(spark, ledger)
    known = (
        spark.read.schema(LEDGER).parquet(ledger)
        if any(n.endswith(".parquet") for n in names)
        else spark.createDataFrame([], LEDGER)
    )
    wanted = F.lit(len(rules))
    current = F.lit(False)
    for rule in rules:
        current = current | ((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
    done = known.where(current).groupBy("blob").agg(F.collect_set("kind").alias("done"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    contents = versions.select(blob_of(F.col("text")).alias("blob"), text.alias("text"))
    unseen = contents.dropDuplicates(["blob"]) if not names else (
        contents.dropDuplicates(["blob"])
        .join(done, "blob", "left")
        .where(F.coalesce(F.size("done"), F.lit(0)) < wanted)
    )
    seen = F.coalesce(F.col("done"), F.array().cast("array<string>")) if names else F.array().cast("array<string>")
    scans = F.array(
        *(
            F.when(
                ~F.array_contains(seen, rule.kind),
                F.struct(
                    F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
                    spans_of(F.col("text"), rule).alias("spans"),
                ),
            )
            for rule in rules
        )
    )
    scanned = unseen.select("blob", F.explode(F.filter(scans, lambda s: s.isNotNull())).alias("scan"))
    scanned.select("blob", "scan.*").write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger).where(current)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`blob`, `found`: all spans of contents that have any, by start, then by rule. A pair that two
    writers, or a job that was run again, have put into the ledger twice counts once."""
    order = F.lit(len(rules))
    for i, rule in enumerate(rules):
        order = F.when(F.col("kind") == rule.kind, i).otherwise(order)
    each = ledger.where(F.size("spans") > 0).select("blob", order.alias("order"), "kind", F.explode("spans").alias("span"))
    one = F.struct("span.start", "order", "span.stop", "kind")
    return each.groupBy("blob").agg(F.sort_array(F.collect_set(one)).alias("found"))


def listed(found: Column) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    each = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return F.coalesce(F.array_join(each, ","), F.lit(""))


def secret_report(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`doc_id`, number of spans of each kind, `base_sha256`, `spans` of every row of `docs`.

    `ledger`: folder of the ledger; without one a new ledger begins in the shared folder.
    """
    ledger = ledger or work_path(docs.sparkSession, "ledger")
    found = findings(scan_unseen(docs, ledger, rules), rules)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_of(F.col("text")).alias("blob"))
    joined = rows.join(found, "blob", "left")
    number = lambda kind: F.coalesce(
        F.size(F.filter("found", lambda s: s["kind"] == kind)), F.lit(0)
    ).cast("long")
    counts = [number(rule.kind).alias(f"n_{rule.kind}") for rule in rules]
    spans = listed(F.col("found"))
    return joined.select(
        "doc_id", *counts, F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans")
    )


def masked(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """`text` with each stretch of overlapping spans replaced by `mask`."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate(
        found,
        start,
        lambda acc, s: F.struct(
            F.when(
                s["start"] < acc["at"], acc["out"]
            ).otherwise(
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
            ).alias("out"),
            F.greatest(acc["at"], s["stop"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    return F.when(found.isNull(), text).otherwise(walked)


def without_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with their secrets masked and `n_chars`, if there is one, counted anew for those texts."""
    ledger = ledger or work_path(docs.sparkSession, "ledger")
    found = findings(scan_unseen(docs, ledger, rules), rules)
    packed = docs.select(F.struct("*").alias("row"), blob_of(F.col("text")).alias("blob"))
    joined = packed.join(sent_if_small(stored(found, "findings")), "blob", "left")
    text = masked(F.col("row.text").cast("string"), F.col("found"))
    columns = [
        text.alias(c) if c == "text"
        else F.when(F.col("found").isNull(), F.col("row")[c]).otherwise(F.char_length(text)).cast(t).alias(c)
        if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c, t in docs.dtypes
    ]
    return joined.select(*columns)

