"""Nearest neighbours by a permutation index.

A vector is represented by the order of `PIVOTS` pivots, nearest first. It is posted in the
inverted files of its `POSTED` nearest pivots. A query looks into the files of its `LOOKED_UP`
nearest pivots, ranks what it finds by the footrule distance of the two orders (the sum of the
differences of places), and reranks the best `RERANKED` share of each file by cosine in double
precision. A vector that a query could find in several files is taken from the first of them.

Pivots are a sample of at most `PIVOTS` distinct vectors, drawn by a hash; every vector is
posted. Files are split into blocks of vectors and queries into blocks too, so a pivot that is
near to a third of all vectors is many tasks. The query set is a fixed share of the rows, so
work grows with the product of the two; measured recall is in the README.

Rows: vectors that are NULL, zero, or hold a NULL or non-finite component take no part, nor do
rows with a NULL id or with another number of components than most rows. Of several vectors with
one id the smallest is taken. Ties of score go to the smaller id. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import stored

PIVOTS = 128
POSTED, LOOKED_UP = 4, 40
RERANKED, RERANKED_LEAST = 0.3, 200
BLOCK_VECTORS, BLOCK_QUERIES = 4_000, 500
QUERY_EVERY, NEIGHBOURS = 50, 5


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `v` (array of doubles): one row per id, all with as many components."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id IS NOT NULL AND size(v) > 0"
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == sizes[0]["n"]) if sizes else rows


def pivots(rows: DataFrame, n: int) -> np.ndarray:
    """At most `n` distinct vectors of length 1, drawn by a hash of the vector."""
    drawn = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(n).collect()
    found = np.array([r["v"] for r in drawn], dtype=np.float64)
    return found / np.linalg.norm(found, axis=1, keepdims=True) if len(found) else found


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def ordered(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """`rows` with `nearest` (pivots, nearest first) and `places` (place of each pivot)."""
    n = len(centers)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), centers.shape[1])
            near = np.argsort(-(v @ centers.T), axis=1, kind="stable").astype(np.int16)
            places = np.empty_like(near)
            np.put_along_axis(places, near.astype(np.int64), np.arange(n, dtype=np.int16)[None, :], axis=1)
            arrays = [pa.array(list(x), pa.list_(pa.int16())) for x in (near, places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=["vec_id", "v", "nearest", "places"])

    return rows.select("vec_id", "v").mapInArrow(order, "vec_id long, v array<double>, nearest array<short>, places array<short>")


def nearest_in_block(queries: pa.Table, posted: pa.Table, width: int, n_pivots: int, looked_up: int, k: int) -> pa.Table:
    """The `k` nearest of a block of postings for each query of a block."""
    q_id, v_id = queries.column("query_id").to_numpy(), posted.column("vec_id").to_numpy()
    qv, vv = matrix(queries.column("query_v"), width), matrix(posted.column("v"), width)
    q_places, v_places = matrix(queries.column("query_places"), n_pivots), matrix(posted.column("places"), n_pivots)
    files, nth = matrix(posted.column("files"), min(POSTED, n_pivots)), posted.column("nth").to_numpy()
    v_norm = np.sqrt((vv * vv).sum(axis=1))
    out: tuple[list, list, list] = ([], [], [])
    for i in range(len(q_id)):
        near = q_places[i] < looked_up
        earlier = np.zeros(len(v_id), bool)
        for j in range(files.shape[1] - 1):
            earlier |= near[files[:, j]] & (nth > j)
        mine = np.flatnonzero(~earlier & (v_id != q_id[i]))
        if not len(mine):
            continue
        footrule = np.abs(v_places[mine] - q_places[i]).sum(axis=1, dtype=np.int32)
        keep = max(RERANKED_LEAST, int(RERANKED * len(mine)))
        if keep < len(mine):  # ties with the last one kept stay
            mine = mine[footrule <= np.partition(footrule, keep)[keep]]
        q_norm = np.sqrt((qv[i] * qv[i]).sum())
        score = (vv[mine] * qv[i]).sum(axis=1) / (v_norm[mine] * q_norm)
        best = np.lexsort((v_id[mine], -score))[:k]
        out[0].extend([q_id[i]] * len(best))
        out[1].extend(v_id[mine[best]])
        out[2].extend(score[best])
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=["query_id", "vec_id", "score"])


def neighbours(
    vectors: DataFrame,
    every: int = QUERY_EVERY,
    k: int = NEIGHBOURS,
    n_pivots: int = PIVOTS,
    looked_up: int = LOOKED_UP,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `k` nearest found of each query, nearest first."""
    result = "query_id long, vec_id long, score double"
    rows = usable(vectors)
    centers = pivots(rows, n_pivots)
    if not len(centers):
        empty = vectors.sparkSession.createDataFrame([], result)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    width, n = centers.shape[1], len(centers)
    indexed = stored(ordered(rows, centers), "index")
    files = F.slice("nearest", 1, min(POSTED, n))
    posted = indexed.select("vec_id", "v", "places", files.alias("files"), F.posexplode(files).alias("nth", "pivot"))
    asking = indexed.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("query_v"), F.col("places").alias("query_places"),
        F.explode(F.slice("nearest", 1, min(looked_up, n))).alias("pivot"),
    )
    # How many blocks each file and its queries make: a row for each pivot.
    blocks = lambda df, size: df.groupBy("pivot").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    sizes = blocks(posted, BLOCK_VECTORS).withColumnRenamed("n", "n_v").join(
        blocks(asking, BLOCK_QUERIES).withColumnRenamed("n", "n_q"), "pivot"
    )
    sizes = F.broadcast(stored(sizes, "sizes"))
    spread = lambda of, n: F.pmod(F.xxhash64(of), F.col(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asking.join(sizes, "pivot").select(
        F.col("pivot").alias("query_pivot"), "query_id", "query_v", "query_places",
        spread("query_id", "n_q").alias("query_qb"), every_block("n_v").alias("query_vb"),
    )
    right = posted.join(sizes, "pivot").select(
        "pivot", "vec_id", "v", "places", "files", "nth",
        spread("vec_id", "n_v").alias("vb"), every_block("n_q").alias("qb"),
    )
    key = ("pivot", "vb", "qb")
    found = left.groupBy(*(f"query_{k}" for k in key)).cogroup(right.groupBy(*key)).applyInArrow(
        lambda a, b: nearest_in_block(a, b, width, n, looked_up, k), result
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
