"""Mixing sources to target weights, in blocks of words.

The words of each source are packed into blocks of `BLOCK` words. (Documents of a source are
packed in chunks, drawn by a hash; the last block of a chunk may be shorter.) The mix is a
sequence of slots, cut into shards. How many slots of each source a shard has is drawn: the
counts are multinomial, given the totals that the targets ask for. They are drawn by halving:
the slots of a range of shards are split over its two halves hypergeometrically, with a
generator seeded by the range, so each shard finds its counts and its place among the slots of
each source alone. A source's slots run through its blocks in the order of a pseudorandom
permutation, and through another one when all its blocks are used. Slots and blocks are joined
by block number.

Targets: sources by code point, NULL last, weigh 3, 1, 2, repeating; they share 150 % of all
words; no target is above twice its source's size, and what is over is shared again by weight.

The list of sources (name, size, number of blocks) is gathered on the driver: it has a row for
each source, whatever the number of documents.

Rows: `taken` counts the words of a row that the mix takes, repeats included. A NULL text has no
words. A NULL source is a source of its own. Repeated rows are packed as often as they come.
Other columns are not read by `mix`, and kept by `mixed_documents`. Without any word nothing is
taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import quoted, stored
from orderlake.llm.tokens import by_bytes

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCK = 64
CHUNK_ROWS = 2_000  # documents packed together, on average over all sources
SHARD_SLOTS = 20_000
SEED = 20_240_601
_WORD = re.compile(WORD)


@dataclass(frozen=True)
class Source:
    number: int
    size: int
    target: float
    n_blocks: int
    n_slots: int


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Shares of `share` times all words by weight, none above `most` times its source's size."""
    total = share * sum(sizes)
    full: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        rest = total - sum(most * sizes[i] for i in full)
        level = rest / sum(weights[i] for i in free) if free else 0.0
        over = {i for i in free if level * weights[i] > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in full else level * weights[i] for i in range(len(sizes))]
        full |= over


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def halved(rng: np.random.Generator, counts: np.ndarray, n_left: int, n_all: int) -> np.ndarray:
    """How many of `counts` (slots by source) fall on `n_left` of all `n_all` slots."""
    left, rest, room = np.zeros_like(counts), int(counts.sum()), n_left
    for i, n in enumerate(counts):
        n, others = int(n), rest - int(n)
        if room and n:
            if rest < 1_000_000_000:
                left[i] = rng.hypergeometric(n, others, room)
            else:  # beyond the generator's range the normal approximation is exact to the slot
                mean = n * (room / rest)
                spread = np.sqrt(mean * (others / rest) * ((rest - room) / max(1, rest - 1)))
                left[i] = int(np.clip(round(rng.normal(mean, spread)), max(0, room - others), min(n, room)))
        room -= int(left[i])
        rest = others
    return left


def shard_counts(shard: int, n_shards: int, counts: np.ndarray, shard_slots: int, seed: int = SEED):
    """Slots of each source in a shard, and how many of each come before it."""
    low, high, before = 0, n_shards, np.zeros_like(counts)
    while high - low > 1:
        mid = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        n_all = int(counts.sum())
        left = halved(rng, counts, min(n_all, (mid - low) * shard_slots), n_all)
        if shard < mid:
            high, counts = mid, left
        else:
            low, counts, before = mid, counts - left, before + left
    return counts, before


def permuted(index: np.ndarray, n: int, source: int, epoch: int, seed: int = SEED) -> np.ndarray:
    """Images of `index` under a pseudorandom permutation of 0..n-1: a Feistel network, walked."""
    bits = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)
    keys = np.random.default_rng([seed, source, epoch]).integers(1, 1 << 62, 4).astype(np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & mask
        for key in keys:
            h = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h ^ (h >> np.uint64(32))) & mask)
        return (left << np.uint64(bits)) | right

    out = once(index.astype(np.uint64))
    while len(beyond := np.flatnonzero(out >= np.uint64(n))):
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def packed_rows(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`rows` with `chunk`; `rows` has `doc_id`, `source` and `size`."""
    n_chunks = F.lit(max(1, rows.count() // chunk_rows))
    return rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size"), n_chunks).cast("int"))


def chunk_table(sizes: DataFrame, block: int) -> DataFrame:
    """`source`, `chunk`, `words`, `n_blocks`, `first_block` of each packed chunk."""
    chunks = sizes.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    n_blocks = F.ceil(F.col("words") / block).cast("long")
    chunks = chunks.select("source", "chunk", "words", n_blocks.alias("n_blocks"))
    order = Window.partitionBy("source").orderBy("chunk")
    return chunks.withColumn("first_block", F.sum("n_blocks").over(order) - F.col("n_blocks"))


def source_list(chunks: DataFrame) -> tuple[DataFrame, list[Source]]:
    """Sources in order, as a table of name and number, and as what the draw needs of each."""
    totals = chunks.groupBy("source").agg(F.sum("words").alias("size"), F.sum("n_blocks").alias("n_blocks"))
    rows = totals.collect()
    rows.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    aims = targets([r["size"] for r in rows], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))])
    sources = []
    for i, (r, aim) in enumerate(zip(rows, aims)):
        slots = round(aim * r["n_blocks"] / r["size"]) if r["size"] else 0
        sources.append(Source(i, r["size"], aim, r["n_blocks"], min(slots, int(MOST) * r["n_blocks"])))
    named = [(r.source, s.number, s.size, s.target) for r, s in zip(rows, sources)]
    schema = "source string, number int, source_size long, target double"
    return chunks.sparkSession.createDataFrame(named, schema), sources


def drawn_slots(spark, sources: list[Source], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: `shard`, `slot` (its place among its source's slots), `number` of the source, `epoch`, `block`."""
    counts = np.array([s.n_slots for s in sources], dtype=np.int64)
    n_shards = max(1, -(-int(counts.sum()) // shard_slots))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                mine, before = shard_counts(shard, n_shards, counts, shard_slots, seed)
                for s in sources:
                    slot = np.arange(before[s.number], before[s.number] + mine[s.number])
                    if not len(slot):
                        continue
                    epoch = slot // s.n_blocks
                    block = np.empty_like(slot)
                    for e in np.unique(epoch):
                        here = epoch == e
                        block[here] = permuted(slot[here] % s.n_blocks, s.n_blocks, s.number, int(e), seed)
                    whole = (np.full_like(slot, v) for v in (shard, s.number))
                    columns = [pa.array(c) for c in (*whole, slot, epoch, block)]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "number", "slot", "epoch", "block"])

    shards = spark.range(0, n_shards, 1, min(n_shards, 200)) if sources else spark.range(0)
    return shards.mapInArrow(draw, "shard long, number long, slot long, epoch long, block long")


def taken_blocks(chunks: DataFrame, names: DataFrame, slots: DataFrame) -> DataFrame:
    """`source`, `chunk`, `times`: how often the mix takes each block of a chunk, in order."""
    blocks = chunks.join(F.broadcast(names.select("source", "number")), chunks.source.eqNullSafe(names.source)).select(
        chunks.source.alias("source"), "chunk", F.col("number").cast("long").alias("number"), "first_block",
        F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("within"),
    )
    blocks = blocks.withColumn("block", F.col("first_block") + F.col("within"))
    hits = slots.groupBy("number", "block").count()
    # As many rows as blocks: never sent, however small a stored table may look.
    used = blocks.join(hits.hint("merge"), ["number", "block"])
    each = F.struct("within", F.col("count").cast("int").alias("times"))
    return used.groupBy("source", "chunk").agg(F.map_from_entries(F.collect_list(each)).alias("times"))


def with_takes(rows: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """`rows` (`doc_id`, `source`, `size`, `chunk`, maybe more) with `source_size`, `target`,
    `start` (in the words of its chunk) and `times` (of each of its blocks)."""
    spark = rows.sparkSession
    chunks = stored(chunk_table(rows.where("size > 0").select("source", "size", "chunk"), block), "chunks")
    names, sources = source_list(
        chunks.select("source", "words", "n_blocks").union(
            rows.select("source", F.lit(0).cast("long"), F.lit(0).cast("long")).distinct()
        )
    )
    times = stored(taken_blocks(chunks, names, drawn_slots(spark, sources, seed=seed)), "times")
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("of")  # NULL is a source too
    times = times.select(key, "chunk", F.col("times").alias("all"))
    names = names.select(key, "source_size", "target")
    order = Window.partitionBy("of", "chunk").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select("*", key).withColumn("start", F.sum("size").over(order) - F.col("size"))
    # The rows lie by source and chunk already; only the small table of takes is shuffled to them.
    joined = placed.join(F.broadcast(names), "of").join(times.hint("merge"), ["of", "chunk"], "left")
    first = F.floor(F.col("start") / block).cast("long")
    last = F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")
    mine = F.transform(F.sequence(first, last), lambda b: F.coalesce(F.col("all")[b], F.lit(0)))
    nothing = F.array().cast("array<int>")
    return joined.withColumn("times", F.when(F.col("size") > 0, mine).otherwise(nothing)).drop("of", "all")


def words_taken(block: int = BLOCK) -> Column:
    """Words of a row that the mix takes: each of its blocks' share of the row, times its uses."""
    begin, end = F.col("start"), F.col("start") + F.col("size")
    first = F.floor(begin / block) * block
    shares = F.transform(
        "times",
        lambda t, i: (
            F.least(end, first + (i + 1) * block) - F.greatest(begin, first + i * block)
        ) * t,
    )
    return F.aggregate(shares, F.lit(0).cast("long"), lambda a, x: a + x)


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """`doc_id, size, source_size, target, taken` of every row of `docs`."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"),
    )
    rows = packed_rows(stored(rows, "sizes"))
    out = with_takes(rows, block, seed)
    return out.select("doc_id", "size", "source_size", "target", words_taken(block).alias("taken"))


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The documents of the mix, with all their columns.

    A row comes once for each time that some of its words are taken, with just these words as
    text (the whole text, unchanged, where all are) and their number of characters in
    `n_chars`, if there is such a column. Rows without words are not part of a mix.
    """
    others = [c for c in docs.columns if c != "text"]  # the text goes beside the row, once
    rest = T.StructType([f for f in docs.schema if f.name != "text"])
    packed = docs.select(
        F.struct(*[quoted(c) for c in others]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
        n_words(F.col("text").cast("string")).alias("size"),
    )
    rows = stored(packed.where("size > 0"), "sized")
    out = with_takes(packed_rows(rows), block, seed).select("row", "text", "size", "start", "times")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                picked, texts = [], []
                columns = (part.column(c).to_pylist() for c in ("text", "size", "start", "times"))
                for i, (text, size, start, times) in enumerate(zip(*columns)):
                    for use in range(1, max(times, default=0) + 1):
                        picked.append(i)
                        texts.append(text if min(times) >= use else taken_text(text, size, start, times, use, block))
                chosen = part.column("row").take(pa.array(picked, pa.int64()))
                yield pa.RecordBatch.from_arrays([chosen, pa.array(texts, pa.string())], names=["row", "text"])

    cut_rows = out.mapInArrow(cut, T.StructType().add("row", rest).add("text", "string"))
    columns = [
        F.col("text").alias(c) if c == "text"
        else F.char_length("text").cast(t).alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c, t in docs.dtypes
    ]
    return cut_rows.select(*columns)


def taken_text(text: str, size: int, start: int, times: list[int], use: int, block: int) -> str:
    """The words of the blocks that are taken at least `use` times, with the space after them."""
    begins = [m.start() for m in _WORD.finditer(text)]
    begins.append(len(text))
    first = start // block * block
    parts = []
    for i, t in enumerate(times):
        low = max(0, first + i * block - start)
        high = min(size, first + (i + 1) * block - start)
        if t >= use:
            parts.append(text[begins[low] : begins[high]])
    return "".join(parts)
