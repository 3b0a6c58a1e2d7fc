"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text.

Leaves are paragraphs: lines, cut at the ends of sentences and, within those, every 96 code
points, so that the leaves together are the text. A leaf's digest is the MD5 of its text. A section
ends after a leaf whose digest starts with 0 or 1 (about every eighth), so an edit moves no section
ends but those near it. A section's digest is the MD5 of those of its leaves, the root the MD5 of
the sections'. So equal roots mean equal texts, but for a chance of about n^2 / 2^129 among n texts.
The fingerprint is the root and the first `DIGEST` hexadecimal digits of the leaves' digests, which
only serve likeness.

Where roots differ, the edit is located from the root down: sections that both texts begin or end
with are passed over, then leaves, and what is left is the place of the edit, how many leaves it
removed there and how many it put in. It covers removed, repeated and moved leaves too.

Likeness of two fingerprints: twice the number of common leaf digests over the sum of the
numbers of digests of either (each counted once per text); 1 for equal texts, 0 for an empty
text and one that is not.

Only DataFrame functions are used. The next document is found by sorting ids in ranges: a row's
next one is in its range, or the first of the next range; only the first row of each range
meets in one task. Texts are shuffled once by row, and their first third once more.

Rows: one result row per input row. NULL texts are empty. Documents follow one another by
descending id, NULL last, then by descending MD5 of the text; repeated rows (same id and text)
have one place in this order and the same result. A single document is its own next one. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import stored

LEAF = r"[^\n.!?]{0,95}[.!?\n]+|[^\n.!?]{1,96}"
DIGEST = 8  # hexadecimal digits of a leaf's digest in a fingerprint's list
WHOLE = 32  # of a whole one
SECTION = r"(?:[2-9a-f][0-9a-f]{%d})*+[01][0-9a-f]{%d}|(?:[2-9a-f][0-9a-f]{%d})++"


def leaf_digests(text: Column, digits: int = WHOLE) -> Column:
    leaves = F.regexp_extract_all(text, F.lit(LEAF), F.lit(0))
    return F.transform(leaves, lambda leaf: F.substring(F.md5(leaf), 1, digits))


def short(digests: Column) -> Column:
    return F.transform(digests, lambda d: F.substring(d, 1, DIGEST))


def sections(digests: Column) -> Column:
    """The sections of a list of leaf digests: the digests of their leaves, joined."""
    return F.regexp_extract_all(F.array_join(digests, ""), F.lit(SECTION % ((WHOLE - 1,) * 3)), F.lit(0))


def root(digests: Column) -> Column:
    return F.md5(F.array_join(F.transform(sections(digests), lambda run: F.md5(run)), ""))


def fingerprint(digests: Column) -> Column:
    return F.concat(root(digests), F.lit(":"), F.array_join(short(digests), ""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` worked out once."""
    return F.transform(F.array(value), use)[0]


def equal_start(a: Column, b: Column) -> Column:
    """How many elements two lists begin with in common."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    end = F.greatest(F.size(a), F.size(b))
    return _let(F.array_position(same, F.lit(False)).cast("int"), lambda n: F.when(n == 0, end).otherwise(n - 1))


def common_ends(a: Column, b: Column) -> Column:
    """Struct of how many elements two lists have in common at their `start`, and at the `end` of
    what is left."""
    left = lambda x, n: F.reverse(F.slice(x, n + 1, F.size(x) - n))
    return _let(equal_start(a, b), lambda n: F.struct(n.alias("start"), equal_start(left(a, n), left(b, n)).alias("end")))


def edit_region(before: Column, after: Column) -> Column:
    """Struct of `start` (leaf, from 0), `removed` and `added` (numbers of leaves) of the edit between
    two lists of leaf digests; nothing removed and added where the roots are equal."""

    def leaves(runs: Column) -> Column:
        return F.aggregate(runs, F.lit(0), lambda n, run: n + (F.char_length(run) / WHOLE).cast("int"))

    def of_sections(s: Column) -> Column:
        """Numbers of leaves in the sections at both ends."""

        def counted(ends: Column) -> Column:
            head = leaves(F.slice(s["own"], F.lit(1), ends["start"]))
            return F.struct(head.alias("head"), leaves(F.slice(F.reverse(s["own"]), F.lit(1), ends["end"])).alias("tail"))

        return _let(common_ends(s["own"], s["other"]), counted)

    def of_leaves(n: Column) -> Column:
        part = lambda x: F.slice(x, n["head"] + 1, F.size(x) - n["head"] - n["tail"])

        def region(ends: Column) -> Column:
            kept = n["head"] + n["tail"] + ends["start"] + ends["end"]
            return F.struct(
                (n["head"] + ends["start"]).alias("start"),
                (F.size(before) - kept).alias("removed"),
                (F.size(after) - kept).alias("added"),
            )

        return _let(common_ends(part(before), part(after)), region)

    own = F.struct(sections(before).alias("own"), sections(after).alias("other"))
    return _let(_let(own, of_sections), of_leaves)


def likeness(a: Column, b: Column) -> Column:
    """Of two lists of leaf digests."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    common = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * common / total)


def ordered_links(ids: DataFrame) -> DataFrame:
    """`ids` (`doc_id`, `key`, `rid`, `n`) in a ring: each with the `rid` of its next one."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").desc()]
    ranged = ids.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    inside = Window.partitionBy("range").orderBy(*order)
    placed = ranged.withColumn("place", F.row_number().over(inside)).withColumn("after", F.lead("rid").over(inside))
    placed = stored(placed, "places")
    # One row for each range of ids: as many as there are partitions.
    firsts = placed.where("place = 1").select("range", F.col("rid").alias("first"))
    ring = Window.orderBy("range")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = firsts.select(
        "range", F.coalesce(F.lead("first").over(ring), F.first("first").over(whole)).alias("next_first")
    )
    return placed.join(F.broadcast(nexts), "range").select(
        "rid", "doc_id", "n", F.coalesce("after", "next_first").alias("next_rid")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and edited text, and their likenesses."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    key = F.md5(text)
    rid = F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("-")), key)
    ids = docs.select(doc_id.alias("doc_id"), key.alias("key"), rid.alias("rid"), F.char_length(text).alias("n"))
    links = stored(ordered_links(ids.distinct()), "links")
    rows = docs.select(rid.alias("rid"), text.alias("text"))

    # What each row gives to the one before it: its first code points and its digests.
    wants = links.select(
        F.col("next_rid").alias("rid"), F.col("rid").alias("for"), "doc_id", F.floor(F.col("n") / 3).cast("int").alias("k")
    )
    given = (
        rows.join(wants, "rid")
        .select(
            F.col("for").alias("rid"), "doc_id", "k",
            F.expr("substring(text, 1, k)").alias("head"), leaf_digests(F.col("text"), DIGEST).alias("next"),
        )
        .dropDuplicates(["rid"])
    )
    edited = rows.join(given, "rid").select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "text",
        F.expr("concat(substring(text, 1, char_length(text) - k), head)").alias("edited"),
        "next",
    )
    digested = edited.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        leaf_digests(F.col("text")).alias("own"), leaf_digests(F.col("edited")).alias("other"), "next",
    )
    # The lists are worked out once, before they are used more than once.
    located = digested.withColumns(
        {"edit": edit_region(F.col("own"), F.col("other")), "o": short(F.col("own")), "e": short(F.col("other"))}
    )
    return located.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("o"), F.col("e")).alias("near_edited"),
        likeness(F.col("o"), F.col("next")).alias("near_next"),
        *(F.col(f"edit.{c}").cast("long").alias(f"edit_{c}") for c in ("start", "removed", "added")),
    )
