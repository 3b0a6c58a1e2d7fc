"""Prefix trie of conversations, with count-min screening of prefix digests.

A conversation is rebuilt from the first turns of the first conversation of its hundred and its own
later turns. Every distinct sequence of first turns is a node.

1. *Order.* Turns, as digests without their texts, are sorted over all partitions by hundred,
   conversation and turn and stored in blocks. What a block has to know of its neighbours (a
   conversation in progress, the first turns of the hundred's first conversation) is one small row
   a block, summed up on the driver: about as many rows as tasks, whatever a conversation's length.
2. *Digest.* A prefix is the sum of its turns' digests, each mixed with its depth, so a block needs
   only the sum before it. A conversation may thus lie in any number of blocks.
3. *Screen.* Count-min counters, which stop at two, take every prefix. A prefix whose estimate is
   one belongs to one conversation: it is a row of the result at once. Only others shuffle.
4. *Group.* Possibly shared prefixes are grouped exactly; a falsely suspected one comes out as a
   node of one conversation. What is summed over subtrees is a sum over members: a node counts
   where its smallest member passes, and these depths are the last ones of each conversation.

Counters are sized by the number of prefixes up to `CELLS`; beyond that more prefixes shuffle and
the result is the same. Digests have 128 bits.

Rows: turns whose conv_id is NULL belong to no conversation. A NULL role or text is empty; NULL
turns come first; ties of a turn are settled by role, then digest; repeated rows are turns of their
own. A conversation without turns left ends at the root. Texts may have any length: they are
digested where they are read. Other columns are not read. An empty table has no node, not even a
root.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stored
from orderlake.llm.words import mixed

HUNDRED, HEADS = 100, 6  # conversations of a family; a head has fewer turns than this
BLOCK = 1 << 18  # turns of a block at most
CELLS, LANES, PIECE = 1 << 25, 2, 1 << 19  # counters of a lane at most, lanes, counters sent together
IDS = 1 << 16  # conversations hashed together

_TURN = np.dtype([("conv", "<i8"), ("m1", "<u8"), ("m2", "<u8"), ("size", "<i8")])


def family(conv: Column) -> Column:
    return conv - conv % HUNDRED


def blocks_of_turns(conversations: DataFrame) -> DataFrame:
    """`block`, `turns`: all turns in the order of rebuilding, as packed arrays."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("mark"),
        F.char_length(text).cast("long").alias("size"),
    ).where(F.col("conv").isNotNull())
    family_first = family(F.col("conv")).alias("family")
    # Equal rows may change places, so a number that differs in each row lets them part.
    turns = turns.select("*", family_first, (F.col("conv") != family_first).alias("later"), F.monotonically_increasing_id().alias("serial"))
    order = [F.col("family"), F.col("later"), F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark"), F.col("serial")]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, done = [], 0, 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([done], pa.int64()), pa.array([b"".join(held)], pa.binary())], names=["n", "turns"])

        for batch in batches:
            rows = np.empty(batch.num_rows, _TURN)
            rows["conv"], rows["size"] = batch.column("conv"), batch.column("size")
            marks = np.frombuffer(b"".join(batch.column("mark").to_pylist()), "<u8").reshape(-1, 2)
            rows["m1"], rows["m2"] = marks[:, 0], marks[:, 1]
            held.append(rows.tobytes())
            n += len(rows)
            if n >= BLOCK:
                yield block()
                held, n, done = [], 0, done + 1
        if n:
            yield block()

    packed = ordered.select("conv", "mark", "size").mapInArrow(pack, "n long, turns binary")
    return packed.select((F.spark_partition_id().cast("long") * (1 << 32) + F.col("n")).alias("block"), "turns")


def head_size(conv: int) -> int:
    """How many turns a conversation takes from the first one of its hundred."""
    return zlib.crc32(b"%d" % conv) % HEADS


def first_of(conv: int) -> int:
    """The first conversation of the hundred; as in SQL, the rest of a division has its sign."""
    return conv - (abs(conv) % HUNDRED) * (1 if conv >= 0 else -1)


class Block:
    """The rebuilt prefixes that begin in one block, given what came before it."""

    def __init__(self, turns: bytes, before: dict):
        rows = np.frombuffer(turns, _TURN)
        conv = rows["conv"]
        start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        stop = np.r_[start[1:], len(rows)]
        self.convs = [int(c) for c in conv[start]]
        self.firsts = [first_of(c) for c in self.convs]
        self.rows, self.start, self.stop = rows, start, stop
        self.continues = before.get("conv") == self.convs[0]
        self.at = before["count"] if self.continues else 0
        kept_first, kept = before.get("family"), before.get("heads", [])
        self.heads: dict[int, list] = {kept_first: list(kept)} if kept_first is not None else {}
        for c, f, s, e in zip(self.convs, self.firsts, start.tolist(), stop.tolist()):
            if c == f:
                own = self.heads.setdefault(f, [])
                own += [(int(t["m1"]), int(t["m2"]), int(t["size"])) for t in rows[s : min(e, s + HEADS - len(own))]]
                del own[HEADS:]

    def after(self) -> dict:
        """What the next block has to know of this one and those before it."""
        count = int(self.stop[-1] - self.start[-1]) + (self.at if len(self.convs) == 1 else 0)
        return {"conv": self.convs[-1], "count": count, "family": self.firsts[-1], "heads": self.heads.get(self.firsts[-1], [])}

    def prefixes(self, ahead: int = 0) -> dict[str, np.ndarray]:
        """Columns of the prefixes: run (place of the conversation), depth, two digests of the last
        turn, its size, and the conversation's number of rebuilt turns. `ahead`: turns of the
        last conversation in later blocks."""
        n = len(self.convs)
        wanted = np.array([0 if c == f else head_size(c) for c, f in zip(self.convs, self.firsts)], np.int64)
        taken = [self.heads.get(f, [])[:w] for f, w in zip(self.firsts, wanted.tolist())]
        n_head = np.array([len(t) for t in taken], np.int64)
        offset = np.zeros(n, np.int64)
        offset[0] = self.at
        count = self.stop - self.start + offset
        count[-1] += ahead
        length = n_head + np.maximum(0, count - wanted)
        run = np.repeat(np.arange(n), self.stop - self.start)
        pos = np.arange(len(self.rows)) - self.start[run] + offset[run]
        own = pos >= wanted[run]
        new = np.arange(1 if self.continues else 0, n)
        flat = [(r, d + 1, *t) for r in new.tolist() for d, t in enumerate(taken[r])]
        head = np.array(flat, np.dtype("i8,i8,u8,u8,i8"))
        none = np.zeros(len(new), np.int64)
        columns = {
            "run": np.concatenate([new, head["f0"], run[own]]),
            "depth": np.concatenate([none, head["f1"], (n_head[run] + pos - wanted[run] + 1)[own]]),
            "m1": np.concatenate([none.astype(np.uint64), head["f2"], self.rows["m1"][own]]),
            "m2": np.concatenate([none.astype(np.uint64), head["f3"], self.rows["m2"][own]]),
            "size": np.concatenate([none, head["f4"], self.rows["size"][own]]),
        }
        order = np.lexsort((columns["depth"], columns["run"]))
        columns = {k: v[order] for k, v in columns.items()}
        depth = columns["depth"].astype(np.uint64)
        for lane, name in enumerate(("m1", "m2"), 1):
            x = mixed(columns[name] ^ mixed(depth * np.uint64(2 * lane + 1) + np.uint64(lane)))
            x[depth == 0] = 0
            columns[name] = x
        columns["length"] = length[columns["run"]]
        return columns


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: its first and last conversation, how many turns of them it holds, and the
    first turns of the last hundred's first conversation."""
    for batch in batches:
        for block, turns in zip(*(c.to_pylist() for c in batch.columns)):
            b = Block(turns, {})
            last = b.after()
            heads = np.array(last["heads"], np.dtype("u8,u8,i8")).tobytes()
            firsts = [block, b.convs[0], int(b.stop[0]), len(b.convs), last["conv"], last["count"], last["family"], heads]
            yield pa.RecordBatch.from_pylist([dict(zip(_OUTLINE, firsts))], schema=pa.schema([(n, pa.binary() if n == "heads" else pa.int64()) for n in _OUTLINE]))


_OUTLINE = ("block", "first", "n_first", "n_convs", "conv", "count", "family", "heads")


def _linked(outlines: list) -> list[dict]:
    """For each block, in order, what came before it and how many turns of its last conversation
    come after it."""
    linked, before = [], {}
    for o in outlines:
        own = [tuple(x) for x in np.frombuffer(o["heads"], np.dtype("u8,u8,i8")).tolist()]
        linked.append({"block": o["block"], "before": before, "ahead": 0})
        same = before.get("conv") == o["first"] and o["n_convs"] == 1
        heads = own if before.get("family") != o["family"] else [*before["heads"], *own][:HEADS]
        before = {"conv": o["conv"], "count": o["count"] + (before["count"] if same else 0), "family": o["family"], "heads": heads}
    for o, later, x, y in zip(outlines[-2::-1], outlines[:0:-1], linked[-2::-1], linked[:0:-1]):
        if o["conv"] == later["first"]:
            x["ahead"] = later["n_first"] + (y["ahead"] if later["n_convs"] == 1 else 0)
    return linked


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for each conversation and depth: `conv_id`, `depth`, digests `k1`, `k2` of the prefix
    and `p1`, `p2` of its parent, code points `size` of its last turn and `rest` of that and all
    later ones, and whether it is the `last`."""
    spark = conversations.sparkSession
    blocks = stored(blocks_of_turns(conversations), "turns")
    kinds = ", ".join(f"{n} {'binary' if n == 'heads' else 'long'}" for n in _OUTLINE)
    linked = _linked(sorted(blocks.mapInArrow(_outlines, kinds).collect(), key=lambda o: o["block"]))
    shared = spark.sparkContext.broadcast({x["block"]: x for x in linked})

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the first and of the last conversation's prefixes in a block."""
        for batch in batches:
            for block, turns in zip(*(c.to_pylist() for c in batch.columns)):
                x = shared.value[block]
                b = Block(turns, x["before"])
                c = b.prefixes(x["ahead"])
                first, last = c["run"] == 0, c["run"] == len(b.convs) - 1
                found = [block, len(b.convs), int(c["size"][first].sum()), *(int(c[m][last].sum(dtype=np.uint64).view(np.int64)) for m in ("m1", "m2")), int(c["size"][last].sum())]
                yield pa.RecordBatch.from_pylist([dict(zip(_SUMS, found))], schema=pa.schema([(n, pa.int64()) for n in _SUMS]))

    found = sorted(blocks.mapInArrow(sums, ", ".join(f"{n} long" for n in _SUMS)).collect(), key=lambda s: s["block"])
    m1 = m2 = behind = 0
    for x, s, o in zip(linked, found, linked[1:] + [None]):
        goes_on = o is not None and x["ahead"] > 0
        x["sums"] = (m1, m2, behind)
        from_before = x["before"].get("count", 0) and s["n_convs"] == 1 and x.get("joined", False)
        m1, m2, behind = ((s["m1"] + (m1 if from_before else 0)) % 2**64, (s["m2"] + (m2 if from_before else 0)) % 2**64, s["size"] + (behind if from_before else 0))
        if o is not None:
            o["joined"] = goes_on
        if not goes_on:
            m1 = m2 = behind = 0
    later = 0
    for x, s in zip(reversed(linked), reversed(found)):
        x["later"] = later if x["ahead"] else 0
        later = s["first_size"] + (x["later"] if s["n_convs"] == 1 else 0)
    summed = spark.sparkContext.broadcast({x["block"]: x for x in linked})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, turns in zip(*(c.to_pylist() for c in batch.columns)):
                x = summed.value[block]
                b = Block(turns, x["before"])
                c = b.prefixes(x["ahead"])
                if not len(c["run"]):
                    continue
                run, n = c["run"], len(b.convs)
                begin = np.searchsorted(run, np.arange(n))
                carried = x["sums"] if b.continues else (0, 0, 0)
                out = {}
                for key, parent, name, carry in (("k1", "p1", "m1", carried[0]), ("k2", "p2", "m2", carried[1])):
                    total = np.r_[np.uint64(0), np.cumsum(c[name], dtype=np.uint64)]
                    base = total[begin]
                    base[0] -= np.uint64(carry)
                    out[key] = (total[1:] - base[run]).view(np.int64)
                    out[parent] = (total[:-1] - base[run]).view(np.int64)
                total = np.r_[0, np.cumsum(c["size"])]
                whole = total[np.r_[begin[1:], len(run)]] - total[begin]
                whole[-1] += x["later"]
                rest = whole[run] - (total[:-1] - total[begin][run])
                out |= {"conv_id": np.array(b.convs, np.int64)[run], "depth": c["depth"], "size": c["size"], "rest": rest, "last": c["depth"] == c["length"]}
                yield pa.RecordBatch.from_arrays([pa.array(out[name]) for name in _PREFIX], names=list(_PREFIX))

    return blocks.mapInArrow(digest, ", ".join(f"{n} {'boolean' if n == 'last' else 'long'}" for n in _PREFIX))


_SUMS = ("block", "n_convs", "first_size", "m1", "m2", "size")
_PREFIX = ("conv_id", "depth", "k1", "k2", "p1", "p2", "size", "rest", "last")


def _cells(k1: np.ndarray, k2: np.ndarray, cells: int) -> list[np.ndarray]:
    a, b = mixed(k1.view(np.uint64).copy()), mixed(k2.view(np.uint64).copy())
    return [((a + np.uint64(i) * b) & np.uint64(cells - 1)).astype(np.int64) for i in range(LANES)]


def count_min(found: DataFrame, n: int) -> tuple[int, list[np.ndarray]]:
    """Counters of all prefixes below the root: the number of cells of a lane, and for each lane
    which cells counted two or more, as packed bits."""
    cells = max(1 << 12, min(CELLS, 1 << int(8 * n).bit_length()))
    piece = min(PIECE, cells)
    per_lane = cells // piece

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros((LANES, cells), bool), np.zeros((LANES, cells), bool)
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(c)) for c in ("k1", "k2"))
            for lane, at in enumerate(_cells(k1, k2, cells)):
                at, times = np.unique(at, return_counts=True)
                twice[lane, at[(times > 1) | once[lane, at]]] = True
                once[lane, at] = True
        for lane in range(LANES):
            for p in range(per_lane):
                part = slice(p * piece, (p + 1) * piece)
                if once[lane, part].any():
                    yield _piece(lane * per_lane + p, np.packbits(once[lane, part]), np.packbits(twice[lane, part]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for p, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
                if p in sums:
                    before = sums[p]
                    once, twice = before[0] | once, before[1] | twice | (before[0] & once)
                sums[p] = once, twice
        for p, (once, twice) in sums.items():
            yield _piece(p, once, twice)

    kinds = "piece long, once binary, twice binary"
    partial = found.where("depth > 0").select("k1", "k2").mapInArrow(count, kinds)
    merged = partial.repartition(min(32, LANES * per_lane), "piece").mapInArrow(merge, kinds).collect()
    lanes = [np.zeros(cells // 8, np.uint8) for _ in range(LANES)]
    for p, _, twice in merged:
        lane, at = divmod(p, per_lane)
        lanes[lane][at * piece // 8 : (at + 1) * piece // 8] = np.frombuffer(twice, np.uint8)
    return cells, lanes


def _piece(p: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    data = [pa.array([p], pa.int64()), pa.array([once.tobytes()], pa.binary()), pa.array([twice.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(data, names=["piece", "once", "twice"])


def screened(found: DataFrame) -> DataFrame:
    """Stored prefixes with `alone` (the estimate is one) and `parent_alone`."""
    cells, lanes = count_min(found, found.count())
    sketch = found.sparkSession.sparkContext.broadcast(lanes)

    def alone(k1: np.ndarray, k2: np.ndarray, depth: np.ndarray) -> np.ndarray:
        one = np.zeros(len(k1), bool)
        for bits, at in zip(sketch.value, _cells(k1, k2, cells)):
            one |= ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1) == 0
        return one & (depth > 0)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, p1, p2, depth = (np.asarray(batch.column(c)) for c in ("k1", "k2", "p1", "p2", "depth"))
            own, parent = alone(k1, k2, depth), alone(p1, p2, depth - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(parent)], names=[*_PREFIX, "alone", "parent_alone"])

    kinds = ", ".join(f"{n} {'boolean' if n == 'last' else 'long'}" for n in _PREFIX)
    return found.select(*_PREFIX).mapInArrow(screen, f"{kinds}, alone boolean, parent_alone boolean")


def ends(members: DataFrame) -> DataFrame:
    """`k1`, `k2`, `ends_sha256` of the conversations (`conv_id`) that end at a node: lists are put
    together in pieces by ranges of all ids, and only the pieces of a node meet."""
    order = ["k1", "k2", "conv_id"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, conv = (np.asarray(batch.column(c)) for c in order)
            edges = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            begins = [b for s, e in zip(edges, np.r_[edges[1:], len(k1)]) for b in range(s, e, IDS)]
            lists = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(begins, [*begins[1:], len(k1)])]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[begins]) for x in (k1, k2, conv)), pa.array(lists, pa.string())], names=[*order, "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == (k1, k2):
                    state.update(b"," + ids.encode())
                else:
                    done += [(*key, state.hexdigest())] if key else []
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield _digests(done)
        yield _digests([(*key, state.hexdigest())] if key else [])

    parts = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = parts.mapInArrow(pieces, "k1 long, k2 long, conv_id long, ids string")
    return parts.repartition("k1", "k2").sortWithinPartitions(*order).mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
        names=["k1", "k2", "ends_sha256"],
    )


NONE_SHA256 = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node; see the module for columns that are sums over subtrees."""
    rows = stored(screened(stored(prefixes(conversations), "prefixes")), "screened")
    tails, shared = rows.where("alone"), rows.where("not alone")
    heads = tails.where("not parent_alone")
    key = ["k1", "k2"]

    nodes = stored(
        shared.groupBy(*key).agg(
            F.min(F.struct("conv_id", "rest")).alias("least"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("depth").alias("depth"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
        ).select(*key, "least.conv_id", "least.rest", "n_convs", "depth", "p1", "p2"),
        "nodes",
    )
    parent = [F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 0").select(*parent).unionByName(heads.select(*parent))
    children = children.groupBy(*key).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "inner")

    # From which depth on a conversation is the smallest member, what is left there, and whether
    # it stands for a childless node at its end.
    of_nodes = nodes.select("conv_id", "depth", "rest", (F.col("n_children") == 0).alias("leaf"))
    of_tails = tails.where("last or not parent_alone").select("conv_id", "depth", "rest", F.col("last").alias("leaf"))
    own = of_nodes.unionByName(of_tails).groupBy("conv_id").agg(
        F.min(F.struct("depth", "rest")).alias("own"), F.max(F.col("leaf").cast("long")).alias("leaf")
    ).select("conv_id", F.col("own.depth").alias("own_depth"), F.col("own.rest").alias("own_rest"), "leaf")
    owned = F.when(F.col("depth") >= F.col("own_depth"), F.col("rest")).otherwise(F.coalesce("own_rest", F.lit(0)))
    sums = shared.join(own, "conv_id", "left").groupBy(*key).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
        F.sum(F.col("rest") - owned).cast("long").alias("saved_tokens"),
    )

    inner = nodes.join(sums, key, "left").join(ends(shared.where("last")), key, "left")
    columns = "conv_id depth n_convs n_children n_leaves saved_tokens ends_sha256 p1 p2".split()
    one_end = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NONE_SHA256))
    alone = tails.select(
        "conv_id", "depth", F.lit(1).cast("long").alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), one_end.alias("ends_sha256"), "p1", "p2", "parent_alone",
    )
    inner = inner.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE_SHA256))).select(*columns)
    met = inner.unionByName(alone.where("not parent_alone").select(*columns))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    met = met.join(above, ["p1", "p2"], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    )
    result = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return met.select(*result).unionByName(alone.where("parent_alone").withColumn("parent_conv_id", F.col("conv_id")).select(*result))
