"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five words (`\\w+`, lower case; a shorter text is one run
of all its words). Two texts are linked when the weighted Jaccard similarity of their multisets,
sum of minima over sum of maxima, is 0.8 or more; classes are the connected parts.

BagMinHash. Each shingle owns a Poisson process on (weight, time); a shingle of weight w sees
the points below w. The weight axis is cut into bands [0,1), [1,2), [2,4), [4,8), ..., each a
process of its own; a band is halved, and its halves again, when a point of it matters, down to
unit weights, where a point lowers the signature component it is assigned to. Points come in
order of time, so whatever lies beyond a text's largest component is never made. Components
of two texts agree with probability equal to their weighted Jaccard similarity.

Links. 28 bands of 5 components miss a pair at 0.8 with probability (1 - 0.8^5)^28 < 2e-5.
Within a bucket, texts are compared with one hub first, and verified links are joined to
classes. Buckets that still hold texts of different classes are compared as they lie, each
text with all others by an inverted index, in blocks; only links that join classes come out, no
pairs. So no link between different classes of a bucket is left out, and every link used was
verified on the whole texts.

Rows: equal texts always share a class. NULL texts, and texts of white space only, are alone,
each in a class of its own. `class_id` is the smallest id in the class (NULL if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.common import BROADCAST_BYTES, sent_if_small, stored, stored_bytes, text_key
from orderlake.llm.tokens import by_bytes
from orderlake.llm.words import GOLDEN, Words, mixed

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 5
BLOCK = 800  # texts of a bucket compared in one task
_BATCH_WORK, _TEXT_WORK = 600_000, 250  # shingles signed together; a text counts as so many more

def gaps(seeds: np.ndarray) -> np.ndarray:
    """Exponential numbers with mean 1, one for each seed."""
    return -np.log(((mixed(seeds) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


class Shingler:
    """Multisets of hashes of word runs."""

    def __init__(self, words: int = WORDS):
        self.words, self.hasher = words, Words()

    def hashes(self, text: str) -> np.ndarray:
        ids = self.hasher.of(text)[2]
        n = min(self.words, len(ids))
        if not n:
            return ids
        out = np.zeros(len(ids) - n + 1, np.uint64)
        for i in range(n):
            out *= GOLDEN
            out += ids[i : len(ids) - n + 1 + i]
        return mixed(out)

    def multiset(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in ascending order and how often each occurs."""
        return np.unique(self.hashes(text), return_counts=True)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima; 1 for two empty multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    high = int(a[1].sum() + b[1].sum()) - low
    return low / high if high else 1.0


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """BagMinHash signatures of several multisets (hashes, weights), one row each."""
    signature = np.full((len(bags), size), np.inf)
    owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    element = np.concatenate([b[0] for b in bags]) if bags else np.zeros(0, np.uint64)
    weight = np.concatenate([b[1] for b in bags]).astype(np.int64) if bags else np.zeros(0, np.int64)

    def start(pick: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        n = len(pick)
        band = np.full(n, low, np.uint64) * GOLDEN + np.uint64(high)
        seed = mixed(element[pick] ^ mixed(band))
        at = gaps(seed) / (high - low)
        return owner[pick], element[pick], weight[pick], np.full(n, low), np.full(n, high), seed, at

    bands, low, high = [], 0, 1
    while len(pick := np.flatnonzero(weight > low)):
        bands.append(start(pick, low, high))
        low, high = high, 2 * high
    if not bands:
        return signature
    own, el, w, lo, hi, seed, at = (np.concatenate(c) for c in zip(*bands))
    flat, limit, turn = signature.reshape(-1), np.full(len(bags), np.inf), 0
    while len(own):
        unit = hi - lo == 1
        # Points of unit processes lower a component; the process goes on to its next point.
        o, s = own[unit], seed[unit]
        component = (mixed(s + GOLDEN) % np.uint64(size)).astype(np.int64)
        np.minimum.at(flat, o * size + component, at[unit])
        seed[unit] = mixed(s + np.uint64(1))
        at[unit] += gaps(seed[unit])
        # Points of wider processes lie in one half; the other half makes a later one of its own.
        wide = np.flatnonzero(~unit)
        if len(wide):
            mid = (lo[wide] + hi[wide]) // 2
            right = (mixed(seed[wide] + GOLDEN) & np.uint64(1)).astype(bool)
            halves = []
            for is_right in (False, True):
                l2, h2 = (mid, hi[wide]) if is_right else (lo[wide], mid)
                s2 = mixed(seed[wide] ^ mixed(l2.astype(np.uint64) * GOLDEN + h2.astype(np.uint64)))
                later = at[wide] + gaps(s2) / (h2 - l2)
                t2 = np.where(right == is_right, at[wide], later)
                seen = l2 < w[wide]
                halves.append(tuple(c[seen] for c in (own[wide], el[wide], w[wide], l2, h2, s2, t2)))
            old = (own, el, w, lo, hi, seed, at)
            own, el, w, lo, hi, seed, at = (
                np.concatenate([c[unit], x, y]) for c, x, y in zip(old, *halves)
            )
        turn += 1
        if turn % 4 == 1:  # an older limit is only wider
            live = np.unique(own)
            limit[live] = signature[live].max(axis=1)
        keep = at <= limit[own]
        own, el, w, lo, hi, seed, at = (c[keep] for c in (own, el, w, lo, hi, seed, at))
    return signature


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit number per band; bands of different position never share a number by design."""
    bits = np.ascontiguousarray(signature[:, : bands * rows]).view(np.uint64).reshape(-1, bands, rows)
    out = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), bits.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out * GOLDEN + bits[:, :, i])
    return out.view(np.int64)


def signatures(keyed: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """`key`, `n_shingles`, `bands` of each distinct text that has a word."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, keys, bags, n = Shingler(words), [], [], 0

        def out() -> pa.RecordBatch:
            hashes = band_hashes(bag_signatures(bags, bands * rows), bands, rows)
            arrays = [
                pa.array(keys, pa.binary()),
                pa.array([int(b[1].sum()) for b in bags], pa.int64()),
                pa.array(list(hashes), pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "n_shingles", "bands"])

        for batch in batches:
            for part in by_bytes(batch, "text"):
                for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    bag = shingler.multiset(text)
                    if len(bag[0]):
                        keys.append(key)
                        bags.append(bag)
                        n += len(bag[0]) + _TEXT_WORK
                    if n > _BATCH_WORK:
                        yield out()
                        keys, bags, n = [], [], 0
        if keys:
            yield out()

    signed = keyed.where("key IS NOT NULL").select("key", "text").mapInArrow(
        sign, "key binary, n_shingles long, bands array<long>"
    )
    return signed.dropDuplicates(["key"])


def compared(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs `(a, b)` of keys and whether their texts are at least that similar (`linked`)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, hub, hub_bag = Shingler(words), None, None
        for batch in batches:
            for part in by_bytes(batch, "text_b"):
                linked = []
                columns = (part.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
                for a, text_a, text_b in zip(*columns):
                    if a != hub:
                        hub, hub_bag = a, shingler.multiset(text_a)
                    linked.append(weighted_jaccard(hub_bag, shingler.multiset(text_b)) >= similarity)
                columns = [part.column("a"), part.column("b"), pa.array(linked, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked"])

    with_texts = (
        pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return with_texts.mapInArrow(check, "a binary, b binary, linked boolean")


def connected(edges: DataFrame) -> DataFrame:
    """`key`, `label` of every end of the edges `(a, b)`: the smallest key in its connected part.

    Labels spread along edges, and between a key and its label in both directions, so the number
    of rounds grows with the logarithm of a part's length.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("key", "other")
    labels = both.groupBy("key").agg(F.least(F.col("key"), F.min("other")).alias("label"))
    while True:
        shortcut = labels.where("label <> key")
        links = both.union(shortcut.select("key", "label")).union(shortcut.select("label", "key"))
        near = links.join(labels.withColumnRenamed("key", "other"), "other").groupBy("key").agg(
            F.min("label").alias("near")
        )
        spread = labels.join(near, "key", "left").select(
            "key", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        spread = stored(spread, "labels")
        labels = spread.select("key", "label")
        if spread.where("label <> was").isEmpty():
            return labels


def classes(
    keyed: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """`key`, `label` of the distinct texts that are linked with another one.

    `keyed` has columns `key` (content address) and `text`; texts without a key take no part.
    """
    signed = stored(signatures(keyed, words, bands, rows), "signatures")
    posted = signed.select("key", "n_shingles", F.explode("bands").alias("bucket"))
    shared = posted.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("key", "n_shingles")).alias("hub"))
    # Only buckets of two or more distinct texts go on: few beside all the postings.
    shared = stored(shared.where("n > 1").select("bucket", "hub"), "buckets")
    members = stored(posted.join(sent_if_small(shared), "bucket"), "members")
    nodes = members.select("key").distinct()
    nodes = F.broadcast(nodes) if stored_bytes(members) <= BROADCAST_BYTES else nodes
    texts = keyed.join(nodes, "key", "left_semi").select("key", "text")
    texts = stored(texts.dropDuplicates(["key"]), "texts")

    def similar_sizes(x: str, y: str):
        return F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9

    pairs = members.where(F.col("key") != F.col("hub.key")).where(similar_sizes("n_shingles", "hub.n_shingles"))
    pairs = pairs.select(F.col("hub.key").alias("a"), F.col("key").alias("b")).distinct()
    tried = stored(compared(pairs, texts, words, similarity), "compared")
    edges = tried.where("linked").select("a", "b")
    labels = connected(edges)
    open_ = stored(_open_buckets(members, labels), "open")
    more = stored(_links_in_buckets(open_, texts, words, similarity, block), "links")
    return labels if more.isEmpty() else connected(edges.union(more))


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """`bucket, key, label, n`: members of the buckets that hold texts of more than one class."""
    label = F.coalesce("label", "key").alias("label")
    labelled = members.join(sent_if_small(labels), "key", "left").select("bucket", "key", label)
    open_ = labelled.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")
    )
    return labelled.join(open_.where("low <> high").select("bucket", "n"), "bucket")


def _links_in_buckets(open_: DataFrame, texts: DataFrame, words: int, similarity: float, block: int) -> DataFrame:
    """Links between different classes in open buckets: enough of them to join what is linked.

    A bucket's texts are compared where they lie together, by an inverted index of their
    shingles; a bucket of more than `block` texts is cut into blocks, and each two blocks meet
    in a task of their own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                bags = [shingler.multiset(t) for t in part.column("text").to_pylist()]
                hashes = pa.array([b[0].view(np.int64) for b in bags], pa.list_(pa.int64()))
                counts = pa.array([b[1].astype(np.int32) for b in bags], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("key"), hashes, counts], names=["key", "h", "c"])

    nodes = open_.select("key").distinct()
    nodes = F.broadcast(nodes) if stored_bytes(open_) <= BROADCAST_BYTES else nodes
    bags = texts.join(nodes, "key", "left_semi").select("key", "text")
    bags = bags.mapInArrow(count, "key binary, h array<long>, c array<int>")
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("key"), n_blocks).cast("int")
    meets = F.explode(F.sequence(F.lit(0), n_blocks - 1))
    placed = open_.select("bucket", "key", "label", mine.alias("mine"), meets.alias("other")).select(
        "bucket", "key", "label", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    )
    groups = placed.join(bags, "key").groupBy("bucket", "low", "high")
    found = groups.applyInArrow(lambda group: _links_of(group, similarity), "a binary, b binary")
    return found.distinct()


def _links_of(group: pa.Table, similarity: float) -> pa.Table:
    """Links between different classes among the texts of one group: a spanning forest."""
    keys, labels = group.column("key").to_pylist(), group.column("label").to_pylist()
    n, out = len(keys), ([], [])
    h, c = (group.column(x).combine_chunks() for x in ("h", "c"))
    ends = np.cumsum([0, *(len(x) for x in h)])
    _, shingle = np.unique(h.flatten().to_numpy(), return_inverse=True)
    count = c.flatten().to_numpy()
    owner = np.repeat(np.arange(n), np.diff(ends))
    total = np.bincount(owner, count, minlength=n)
    order = np.argsort(shingle, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(shingle))])
    class_of = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)[1]
    for i in range(n):
        mine = slice(ends[i], ends[i + 1])
        sizes = first[shingle[mine] + 1] - first[shingle[mine]]
        # Places of all postings of this text's shingles, one run after the other.
        run = np.repeat(first[shingle[mine]] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        postings = order[run + np.arange(sizes.sum())]
        low = np.minimum(count[postings], np.repeat(count[mine], sizes))
        overlap = np.bincount(owner[postings], low, minlength=n)
        near = overlap >= similarity * (total + total[i] - overlap)
        for j in np.flatnonzero(near & (class_of != class_of[i])).tolist():
            if class_of[j] != class_of[i]:
                out[0].append(keys[i])
                out[1].append(keys[j])
                class_of[class_of == class_of[j]] = class_of[i]
        if (class_of == class_of[0]).all():
            break
    return pa.table([pa.array(x, pa.binary()) for x in out], names=["a", "b"])


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """`doc_id`, `class_id`, `class_rows`: one row per row of `docs`.

    `options` are those of `classes`.
    """
    text = F.col("text").cast("string")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.trim(F.regexp_replace(text, r"\s+", " ")) != "", text_key(text)).alias("key"),
        text.alias("text"),
    )
    labels = classes(keyed, **options)
    rows = keyed.select("doc_id", "key").join(sent_if_small(labels), "key", "left").select(
        "doc_id", F.coalesce("label", "key").alias("class")
    )
    rows = stored(rows, "classed")
    sizes = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows")
    )
    return rows.join(sizes.where("class_rows > 1"), "class", "left").select(
        "doc_id",
        F.when(F.col("class_rows").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).cast("long").alias("class_rows"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each class the row with the smallest id.

    Ids that are NULL come last; among rows with that id the one with the smallest content
    address stays, and of repeated rows one. All columns are kept.
    """
    packed = docs.select(F.struct("*").alias("row"))
    text = F.col("row.text").cast("string")
    keyed = packed.select(
        "row",
        F.when(F.trim(F.regexp_replace(text, r"\s+", " ")) != "", text_key(text)).alias("key"),
        text.alias("text"),
    )
    labels = classes(keyed.select("key", "text"), **options)
    place = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("id"), "key")
    rows = keyed.select("row", "key", place.alias("place")).join(sent_if_small(labels), "key", "left")
    rows = rows.withColumn("class", F.coalesce("label", "key"))
    narrow = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min("place").alias("place"), F.count("*").alias("n")
    )
    crowded = stored(narrow.where("n > 1"), "crowded")
    # Rows of classes with one row go straight on; only the others meet to leave one of each.
    marked = rows.join(
        sent_if_small(crowded.select("class", F.col("place").alias("first"))), "class", "left"
    )
    alone = marked.where("first IS NULL").select("row.*")
    one = marked.where("place = first").dropDuplicates(["class"]).select("row.*")
    return alone.union(one)
