"""Packing documents into as few sequences of fixed length as possible.

Lengths are whole numbers up to the capacity, so a table of how many pieces have each length
says all that matters for packing, however many documents there are. Only this table (at most
`capacity` rows) reaches the driver, which searches it for a packing by bin completion: take
the largest length left, list the undominated fillings of the room beside it, follow the one
with the least waste, prune what wastes more than an improvement may, and keep the best
solution so far, at first that of best fit. A step places as many sequences alike as the
counts allow, so the search is over kinds of sequences. It ends when a solution meets the
lower bound or after `NODES` steps; the best complete solution is then used.

Back in Spark every piece gets its number among the pieces of its length (numbered in chunks,
so that a frequent length is not one task) and with it a place in a sequence.

Rows: one per piece. Repeated rows and repeated ids are packed as often as they come. A NULL
text is empty: its document is one end token. Other columns are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import sent_if_small, stored
from orderlake.llm.tokens import by_bytes, little_endian, text_encoder, tokenizer_path

CAPACITY = 1024
END_ID = 2
NODES = 4_000  # steps of the search
FILLINGS = 24  # fillings looked at in a step, those with the least waste first
CHUNK_ROWS = 5_000  # pieces numbered together, on average

Kind = tuple[tuple[int, ...], int]  # lengths in a sequence, number of such sequences

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, path: str | None, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every document: its ids and `end_id`; where too long, all but the first full."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows: tuple[list, ...] = ([], [], [], [], [])
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = (encoder.ids(text) if text else []) + [end_id]
                    start, stop, piece = 0, len(ids) % capacity or capacity, 0
                    while start < len(ids):
                        crc = zlib.crc32(little_endian(ids[start:stop]))
                        for column, value in zip(rows, (doc_id, piece, start, stop - start, crc)):
                            column.append(value)
                        start, stop, piece = stop, stop + capacity, piece + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(r, k) for r, k in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[Kind]:
    """Best fit, longest first, over counts of lengths; sequences alike are placed together."""
    open_: dict[int, list[Kind]] = {}
    rooms: list[int] = []  # sorted keys of `open_`

    def put(room: int, kind: Kind) -> None:
        if kind[1]:
            if room not in open_:
                rooms.insert(bisect_left(rooms, room), room)
            open_.setdefault(room, []).append(kind)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                put(capacity - each * length, ((length,) * each, left // each))
                put(capacity - left % each * length, ((length,) * (left % each), int(left % each > 0)))
                break
            room = rooms[at]
            lengths, times = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = min(room // length, left)
            used = min(times, left // each)
            put(room, (lengths, times - used))
            put(room - each * length, (lengths + (length,) * each, used))
            left -= each * used
    return [kind for kinds in open_.values() for kind in kinds]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: total length, and lengths that exclude one another."""
    bound = -(-sum(k * n for k, n in counts.items()) // capacity)
    sizes = sorted(counts)
    for alpha in [0, *(s for s in sizes if s <= capacity // 2)]:
        large = sum(n for k, n in counts.items() if k > capacity - alpha)
        middle = {k: n for k, n in counts.items() if capacity // 2 < k <= capacity - alpha}
        small = sum(k * n for k, n in counts.items() if alpha <= k <= capacity // 2)
        room = sum((capacity - k) * n for k, n in middle.items())
        bound = max(bound, large + sum(middle.values()) + max(0, -(-(small - room) // capacity)))
    return bound


def fillings(room: int, counts: dict[int, int], sizes: list[int], waste: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill `room` that leave at most `waste`, the fullest first."""
    if room in counts:
        return [(room,)]  # one document that fills it all dominates every other way
    found: list[tuple[int, ...]] = []
    visits = 0

    def dominated(filling: tuple[int, ...], left: int) -> bool:
        """One longer document fits in place of one of these, or of two of them."""
        for i, a in enumerate(filling):
            at = bisect_right(sizes, a)
            if at < len(sizes) and sizes[at] <= a + left and counts[sizes[at]] > filling.count(sizes[at]):
                return True
            for b in filling[i + 1 :]:
                at = bisect_left(sizes, a + b)
                if at < len(sizes) and sizes[at] <= a + b + left:
                    return True
        return False

    def extend(filling: tuple[int, ...], left: int, largest: int) -> None:
        nonlocal visits
        visits += 1
        exact = left in counts and left <= largest and counts[left] > filling.count(left)
        if exact or not left:
            found.append((*filling, left) if exact else filling)
            return
        for at in range(bisect_right(sizes, min(left, largest)) - 1, -1, -1):
            size = sizes[at]
            if size == left or counts[size] <= filling.count(size):
                continue
            if len(found) >= FILLINGS or visits > 40 * FILLINGS:
                return
            extend((*filling, size), left - size, size)
        smallest = next((s for s in sizes if counts[s] > filling.count(s)), room + 1)
        if smallest > left and left <= waste and not dominated(filling, left):
            found.append(filling)

    extend((), room, room)
    return sorted(found, key=lambda f: (room - sum(f), len(f)))[:FILLINGS]


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[Kind]:
    """The best packing found by bin completion; never worse than best fit."""
    best = best_fit(counts, capacity)
    n_best, bound = sum(t for _, t in best), lower_bound(counts, capacity)
    total = sum(k * n for k, n in counts.items())
    # A branch: counts left, kinds placed, sequences placed, waste so far.
    stack = [(dict(counts), (), 0, 0)]
    while stack and n_best > bound and nodes > 0:
        nodes -= 1
        left, placed, n_placed, wasted = stack.pop()
        if not left:
            if n_placed < n_best:
                kinds, link = [], placed
                while link:
                    link, kind = link
                    kinds.append(kind)
                best, n_best = kinds, n_placed
            continue
        allowed = (n_best - 1) * capacity - total - wasted  # more waste can't improve on the best
        if allowed < 0:
            continue
        largest = max(left)
        rest = {k: n for k, n in left.items() if k < largest or n > 1}
        rest.update({largest: left[largest] - 1} if left[largest] > 1 else {})
        sizes = sorted(s for s in rest if s <= capacity - largest)
        ways = fillings(capacity - largest, rest, sizes, allowed) if sizes else []
        for way in reversed(ways or [()]):
            kind = (largest, *way)
            uses = {s: kind.count(s) for s in set(kind)}
            times = min(left[s] // n for s, n in uses.items())
            waste = capacity - sum(kind)
            if waste:
                times = min(times, allowed // waste)
            if times:
                after = {s: n - uses.get(s, 0) * times for s, n in left.items() if n > uses.get(s, 0) * times}
                stack.append((after, (placed, (kind, times)), n_placed + times, wasted + waste * times))
    return best


def seats(kinds: list[Kind]) -> list[tuple[int, int, int, int, int, int]]:
    """Places for the pieces of each length, by their number: runs of seats alike, as (length,
    first number, number after the last, first sequence, pieces of that length in a sequence,
    offset of the first of them)."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    taken: dict[int, int] = {}
    first = 0
    for lengths, times in kinds:
        lengths = tuple(sorted(lengths, reverse=True))
        offset = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            start = taken.get(length, 0)
            taken[length] = start + each * times
            runs.append((length, start, taken[length], first, each, offset))
            offset += each * length
        first += times
    return runs


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    nodes: int = NODES,
) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset` of every piece."""
    spark = docs.sparkSession
    pieces = stored(cut_documents(docs, path, capacity, end_id), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    n_chunks = max(1, sum(counts.values()) // CHUNK_ROWS)

    chunk = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_chunks)).alias("chunk")
    chunked = pieces.select("*", chunk)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("chunk")) - F.col("count")
    sizes = chunked.groupBy("length", "chunk").count().select("length", "chunk", before.alias("before"))
    sizes = sent_if_small(stored(sizes, "sizes"))
    number = F.row_number().over(
        Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32", "start")
    )
    numbered = chunked.withColumn("within", number).join(sizes, ["length", "chunk"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("within") - 1)

    # As many rows as kinds of sequences have lengths: this grows with the capacity, not the data.
    runs = spark.createDataFrame(
        seats(complete_bins(counts, capacity, nodes)),
        "of long, first long, stop long, sequence long, each long, at long",
    )
    seated = (F.col("length") == F.col("of")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("stop"))
    nth = F.col("number") - F.col("first")
    return numbered.join(F.broadcast(runs), seated).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
