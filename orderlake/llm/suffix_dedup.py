"""Removal of long byte strings that occur more than once.

A byte is removed if it lies in a string of `SPAN` bytes that also starts anywhere else, in the
same text or another one.

Which suffixes can share so long a prefix is found without sorting all of them. Every string of
`SPAN` bytes contains an anchor: a place where the hash of `GRAM` bytes is the smallest among all
such places of the string. Equal strings have equal anchors at equal places, so only anchors
whose hash occurs twice matter, and of those only where the text around them (`SPAN` bytes on,
and back as far as the anchor can lie behind the start of a string) is not the same.

There the suffixes that start at an anchor, and the prefixes that end at it read backwards, are
sorted deep-shallow: multikey quicksort orders them by their first bytes, and groups that are
still equal are ordered by blind tries, which compare each string with one other only. The
longest common prefixes of neighbours in both orders give, for each pair of places, how far they
agree on both sides; where that is `SPAN` bytes together, they are removed.

No task sorts more than `SORTED_TOGETHER` surroundings. Larger groups are parted by further bytes,
as multikey quicksort parts them, but by a shuffle: a string that begins `b` bytes before the
anchor, for `b` in some interval, holds the bytes that all such strings share. The interval is
halved, and surroundings with the same shared bytes form a group for their half. Of those that
also agree in all bytes that such strings may have, one stands for all, and none needs to be sorted
to know its reach. Groups still too large are halved again; where the interval is one place, all
of a group agree, so this ends after eight rounds.

All joins shuffle, at every size: none of the tables that texts or anchors meet has a bound.

Rows: one result row per input row. NULL texts are empty. Rows with equal texts are copies of
each other, so all their bytes are removed if there are `SPAN` of them. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import forget, stored
from orderlake.llm.tokens import by_bytes

SPAN = 200
GRAM = 32
BACK = SPAN - GRAM  # how far an anchor can lie behind the start of a string
SHALLOW = 40
SORTED_TOGETHER = 1_000
_BYTE_CODES = np.random.default_rng(20_240_602).integers(0, 1 << 63, 256).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15


# --- deep-shallow sorting ------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def multikey_quicksort(strings: list[bytes], ids: list[int], depth: int, shallow: int, out: list[int]) -> None:
    """Append `ids` to `out` by their strings, which agree before `depth`; 8 bytes are one key."""
    todo = [(ids, depth)]
    while todo:
        ids, depth = todo.pop()
        if len(ids) < 2:
            out.extend(ids)
        elif depth >= shallow:
            out.extend(blind_trie_order(strings, ids))
        else:
            pivot = strings[ids[len(ids) // 2]][depth : depth + 8]
            less, same, more = [], [], []
            for i in ids:
                key = strings[i][depth : depth + 8]
                (same if key == pivot else less if key < pivot else more).append(i)
            # A key of less than 8 bytes ends its string, so these are equal.
            todo += [(more, depth), (same, depth + 8 if len(pivot) == 8 else shallow), (less, depth)]


def blind_trie_order(strings: list[bytes], ids: list[int]) -> list[int]:
    """`ids` in the order of their strings. Nodes know a depth and the bytes that branch there."""
    root: list = [0, {}]

    def branch(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    for i in ids:
        s, node = strings[i], root
        while len(node) == 2:  # blindly down to some leaf
            children = node[1]
            if not children:
                break
            node = children.get(branch(s, node[0])) or next(iter(children.values()))
        if len(node) == 2:
            root[1][branch(s, 0)] = [i, len(s), [i]]
            continue
        other = strings[node[0]]
        at = common_prefix(s, other)
        if at == len(s) == len(other):
            node[2].append(i)
            continue
        node = root
        while True:  # down again, to where the two part
            child = node[1].get(branch(s, node[0]))
            if child is None or len(child) == 3 or child[0] > at:
                break
            node = child
        if node[0] == at or child is None:
            node[1][branch(s, node[0])] = [i, len(s), [i]]
        else:
            node[1][branch(s, node[0])] = [at, {branch(other, at): child, branch(s, at): [i, len(s), [i]]}]
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if len(node) == 3:
            order.extend(node[2])
        else:
            todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
    return order


def sorted_with_lcp(strings: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Order of the strings, and the common prefix of each with the one before it in that order."""
    order: list[int] = []
    multikey_quicksort(strings, list(range(len(strings))), 0, SHALLOW, order)
    lcp = [0, *(common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:]))]
    return order, np.array(lcp, dtype=np.int16)


def agreement(strings: list[bytes]) -> np.ndarray:
    """Common prefixes of all pairs: minima over runs of neighbours in sorted order."""
    order, lcp = sorted_with_lcp(strings)
    out = np.zeros((len(strings), len(strings)), np.int16)
    where = np.array(order)
    for a in range(len(order) - 1):
        run = np.minimum.accumulate(lcp[a + 1 :])
        out[where[a], where[a + 1 :]] = run
        out[where[a + 1 :], where[a]] = run
    return out


def extents(behind: list[bytes], ahead: list[bytes]) -> list[tuple[int, int]]:
    """How far back and on from an anchor strings of `SPAN` bytes reach that also occur at another
    of its places; (0, 0) for none. `behind` is read backwards from the anchor."""
    if len(ahead) == 2:
        back, on = common_prefix(*behind), common_prefix(*ahead)
        both = (back, on) if back + on >= SPAN else (0, 0)
        return [both, both]
    back, on = agreement(behind), agreement(ahead)
    enough = back + on >= SPAN
    np.fill_diagonal(enough, False)
    far = [np.where(enough, m, 0).max(axis=1) for m in (back, on)]
    return list(zip(far[0].tolist(), far[1].tolist()))


# --- anchors -------------------------------------------------------------------------------


def sliding(best, x: np.ndarray, width: int) -> np.ndarray:
    """`best` (minimum or maximum) of every `width` neighbours, by doubling."""
    step = 1
    while 2 * step <= width:
        x, step = best(x[:-step], x[step:]), 2 * step
    return best(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text and the hashes of the `GRAM` bytes there."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, step, base = _BYTE_CODES[np.frombuffer(data, np.uint8)], 1, _BASE
    while step < GRAM:
        h = h[:-step] * np.uint64(base) + h[step:]
        step, base = 2 * step, base * base % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    low = sliding(np.minimum, h, BACK + 1)
    edge = np.zeros(BACK, np.uint64)
    places = np.flatnonzero(h == sliding(np.maximum, np.concatenate([edge, low, edge]), BACK + 1))
    return places, h[places].view(np.int64)


def around(data: bytes, place: int) -> tuple[bytes, int]:
    """The text around an anchor, and how much of it lies before the anchor."""
    start = max(0, place - BACK)
    return data[start : place + SPAN], place - start


def utf8(part: pa.RecordBatch) -> Iterator[bytes]:
    return (t.encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist())


OCCURRENCE = "anchor long, ctx long, k1 long, k2 long, place int, back short, on short"


def occurrences(texts: DataFrame) -> DataFrame:
    """All anchors of `texts` (`k1`, `k2`, `text`, `weight`), and hashes of what is around them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "ctx", "k1", "k2", "place", "back", "on", "weight"]
        for batch in batches:
            for part in by_bytes(batch, "text"):
                columns: list[list[np.ndarray]] = [[] for _ in names]
                keys = (part.column(c).to_numpy() for c in ("k1", "k2", "weight"))
                for data, k1, k2, weight in zip(utf8(part), *keys):
                    places, hashes = anchors(data)
                    around_ = [around(data, p) for p in places.tolist()]
                    ctx = [xxhash.xxh3_64_intdigest(c, seed=b) for c, b in around_]
                    n = len(places)
                    back = np.minimum(places, BACK)
                    on = np.minimum(len(data) - places, SPAN)
                    found = (
                        hashes, np.array(ctx, np.uint64).view(np.int64), np.full(n, k1), np.full(n, k2),
                        places.astype(np.int32), back.astype(np.int16), on.astype(np.int16), np.full(n, weight, np.int16),
                    )
                    for column, values in zip(columns, found):
                        column.append(values)
                if columns[0]:
                    arrays = [pa.array(np.concatenate(c)) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.select("k1", "k2", "text", "weight").mapInArrow(find, f"{OCCURRENCE}, weight short")


def surroundings(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text around one occurrence of each wanted (`anchor`, `ctx`)."""
    one = F.struct("anchor", "ctx", "place", "twice")
    per_text = stored(wanted.groupBy("k1", "k2").agg(F.collect_list(one).alias("wanted")), "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows: tuple[list, ...] = ([], [], [], [], [])
                for data, asked in zip(utf8(part), part.column("wanted").to_pylist()):
                    for w in asked:
                        text, back = around(data, w["place"])
                        for column, value in zip(rows, (w["anchor"], w["ctx"], w["twice"], back, text)):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int16(), pa.binary())
                arrays = [pa.array(r, k) for r, k in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "ctx", "twice", "back", "around"])

    joined = texts.select("k1", "k2", "text").join(per_text.hint("merge"), ["k1", "k2"])
    return joined.select("text", "wanted").mapInArrow(
        cut, "anchor long, ctx long, twice boolean, back short, around binary"
    )


# --- extents of what is repeated ----------------------------------------------------------


_REACH = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("back", pa.int16()), ("on", pa.int16())])
REACH = "anchor long, ctx long, back short, on short"


def sorted_extents(around_: DataFrame, keys: tuple[str, ...] = ("anchor",)) -> DataFrame:
    """`anchor, ctx, back, on` by sorting what is around each anchor, or each group of one."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, {}

        def solved() -> list[dict]:
            if len(group) < 2:
                return []
            behind = [text[:back][::-1] for back, text, _ in group.values()]
            ahead = [text[back:] for back, text, _ in group.values()]
            found = zip(group.items(), extents(behind, ahead))
            return [
                {"anchor": key[0], "ctx": ctx, "back": back, "on": on}
                for (ctx, (_, _, twice)), (back, on) in found
                if on and not twice
            ]

        for batch in batches:
            rows = []
            for *own, ctx, twice, back, text in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    rows += solved()
                    key, group = own, {}
                group[ctx] = (back, text, twice)
            yield pa.RecordBatch.from_pylist(rows, _REACH)
        yield pa.RecordBatch.from_pylist(solved(), _REACH)

    by_group = around_.select(*keys, "ctx", "twice", "back", "around").repartition(*keys).sortWithinPartitions(*keys, "ctx")
    return by_group.mapInArrow(solve, REACH)


_GROUP = ("anchor", "lo", "hi", "g1", "g2")
_CLASS = (*_GROUP, "u1", "u2")


def halves(around_: DataFrame) -> DataFrame:
    """Surroundings in both halves of their interval [`lo`, `hi`] of places where a string may
    begin, with digests of the bytes that all strings of the half share (`g1`, `g2`) and of those
    that any may have (`u1`, `u2`), which are kept."""
    names = [*_CLASS, "ctx", "twice", "back", "around"]
    kinds = [pa.int64(), pa.int16(), pa.int16(), *[pa.int64()] * 5, pa.bool_(), pa.int16(), pa.binary()]

    def digest(data: bytes, seed: int) -> tuple[int, int]:
        return tuple(np.frombuffer(xxhash.xxh3_128_digest(data, seed=seed), ">i8").tolist())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for anchor, ctx, twice, back, text, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                on, mid = len(text) - back, (lo + hi) // 2
                for low, high in ((lo, mid), (mid + 1, hi)):
                    before, after = min(back, high), min(on, SPAN - low)
                    if before < low or after < SPAN - high or before + after < SPAN:
                        continue  # no string of this half fits into the text
                    shared, kept = text[back - low : back + SPAN - high], text[back - before : back + after]
                    rows.append((anchor, low, high, *digest(shared, 0), *digest(kept, before), ctx, twice, before, kept))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    fields = "anchor long, lo short, hi short, g1 long, g2 long, u1 long, u2 long, ctx long, twice boolean, back short, around binary"
    return around_.select("anchor", "ctx", "twice", "back", "around", "lo", "hi").mapInArrow(cut, fields)


def parted_extents(around_: DataFrame) -> DataFrame:
    """The same for groups that are too large for a task; see the module."""
    rows = around_.dropDuplicates(["anchor", "ctx"]).withColumns({"lo": F.lit(0).cast("short"), "hi": F.lit(BACK).cast("short")})
    found = []
    while True:
        parts = stored(halves(rows), "parts")
        classes = parts.groupBy(*_CLASS).agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n"), F.min("ctx").alias("ctx"))
        classes = stored(classes, "classes")
        groups = classes.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("members"))
        groups = stored(groups.where("members > 1"), "groups")
        same = classes.where("n > 1").select(*_CLASS)
        known = parts.where("not twice").select(*_CLASS, "ctx", "back", F.octet_length("around").alias("length"))
        known = known.join(same, list(_CLASS), "left_semi")
        known = known.select("anchor", "ctx", "back", (F.col("length") - F.col("back")).cast("short").alias("on"))
        found.append(stored(known, "known"))
        chosen = classes.join(groups, list(_GROUP)).select(*_CLASS, "ctx", "n", "members")
        one = parts.join(chosen, [*_CLASS, "ctx"]).withColumn("twice", F.col("n") > 1)
        one = stored(one.select(*_GROUP, "ctx", "twice", "back", "around", "members"), "chosen")
        forget(parts)
        hot = F.col("members") > SORTED_TOGETHER
        found.append(sorted_extents(one.where(~hot), _GROUP))
        if groups.where(hot).isEmpty():
            break
        rows = one.where(hot)
    reach = found[0]
    for more in found[1:]:
        reach = reach.union(more)
    return reach.groupBy("anchor", "ctx").agg(F.max("back").alias("back"), F.max("on").alias("on"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """`k1`, `k2`, `spans` (start, stop; sorted) of the texts that hold repeated strings.

    `texts` has one row for each distinct text: `k1`, `k2`, `text`, and `weight`, 2 for a text
    that occurs more than once and 1 for others.
    """
    every = stored(occurrences(texts), "anchors")
    by_anchor = every.groupBy("anchor").agg(
        F.sum("weight").alias("n"), (F.min("ctx") != F.max("ctx")).alias("differ")
    )
    shared = stored(by_anchor.where("n > 1").select("anchor", "differ"), "shared")
    occ = stored(every.join(shared.hint("merge"), "anchor"), "repeated")
    forget(every)  # by far the largest step
    place = F.struct("k1", "k2", "place")
    contexts = occ.groupBy("anchor", "ctx").agg(
        (F.sum("weight") > 1).alias("twice"), F.first("differ").alias("differ"),
        F.first("back").alias("back"), F.first("on").alias("on"), F.min(place).alias("at"),
    )
    contexts = stored(contexts, "contexts")
    whole = contexts.where("twice").select("anchor", "ctx", "back", "on")
    # Surroundings are only compared where one of an anchor's occurs once.
    unsure = contexts.where("differ").groupBy("anchor").agg(
        F.count("*").alias("n"), F.min(F.col("twice").cast("int")).alias("all")
    )
    unsure = stored(unsure.where("all = 0").select("anchor", "n"), "unsure")
    wanted = contexts.join(unsure.hint("merge"), "anchor").select("at.k1", "at.k2", "at.place", "anchor", "ctx", "twice")
    around_ = stored(surroundings(texts, wanted), "around")
    hot = stored(unsure.where(F.col("n") > SORTED_TOGETHER).select("anchor"), "hot").hint("merge")
    reach = sorted_extents(around_.join(hot, "anchor", "left_anti"))
    if not hot.isEmpty():
        reach = reach.union(parted_extents(around_.join(hot, "anchor", "left_semi")))
    reach = stored(whole.where(F.col("back") + F.col("on") >= SPAN).union(reach), "reach")
    covers = occ.select("anchor", "ctx", "k1", "k2", "place").join(reach.hint("merge"), ["anchor", "ctx"])
    span = F.struct((F.col("place") - F.col("back")).alias("start"), (F.col("place") + F.col("on")).alias("stop"))
    return covers.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans."""
    runs: list[tuple[int, int]] = []
    for s in spans:
        if runs and s["start"] <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], s["stop"]))
        else:
            runs.append((s["start"], s["stop"]))
    return runs


def text_keys(text: Column) -> tuple[Column, Column]:
    """A 128-bit content address as two numbers."""
    digest = F.md5(text)
    half = lambda start: F.conv(F.substring(digest, start, 16), 16, -10).cast("long")
    return half(1).alias("k1"), half(17).alias("k2")


def keyed_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` as `doc_id, text, k1, k2, copied`, and one row for each distinct text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *text_keys(text))
    copies = rows.select("doc_id", "k1", "k2").groupBy("k1", "k2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_id")
    )
    copies = stored(copies.where("n > 1").select("k1", "k2", "first_id"), "copies")
    marked = rows.join(copies.withColumn("copied", F.lit(True)).hint("merge"), ["k1", "k2"], "left")
    marked = marked.withColumn("copied", F.coalesce("copied", F.lit(False)))
    # Of rows with the same id and text each counts as a copy: they are removed in any case.
    distinct = marked.where(~F.col("copied") | F.col("doc_id").eqNullSafe(F.col("first_id")))
    weight = F.when(F.col("copied"), 2).otherwise(1).cast("short")
    return marked, distinct.select("k1", "k2", "text", weight.alias("weight"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256` of every row of `docs`."""
    marked, texts = keyed_texts(docs)
    spans = stored(repeated_spans(texts), "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows: tuple[list, ...] = ([], [], [], [], [])
                columns = (part.column(c).to_pylist() for c in ("doc_id", "copied", "spans"))
                for data, doc_id, copied, found in zip(utf8(part), *columns):
                    runs = [(0, len(data))] if copied and len(data) >= SPAN else merged(found or [])
                    kept, at = hashlib.sha256(), 0
                    for start, stop in runs:
                        kept.update(data[at:start])
                        at = stop
                    kept.update(data[at:])
                    n_removed = sum(stop - start for start, stop in runs)
                    for column, value in zip(rows, (doc_id, len(data), n_removed, len(runs), kept.hexdigest())):
                        column.append(value)
                kinds = (*[pa.int64()] * 4, pa.string())
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

    joined = marked.select("doc_id", "text", "k1", "k2", "copied").join(spans.hint("merge"), ["k1", "k2"], "left")
    return joined.select("doc_id", "text", "copied", "spans").mapInArrow(keep, RESULT)
