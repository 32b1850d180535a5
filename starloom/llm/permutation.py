"""Nearest neighbours through a permutation index.

*Pivots* are a bounded sample of the distinct vectors: the ``PIVOTS`` smallest
vector hashes. Every vector, row or query, is represented by its ``NEAREST``
nearest pivots in order.

*Inverted files.* The rows lie in index blocks of about ``BLOCK`` vectors. Within
a block each pivot has a posting list of (vector, place of the pivot in the
vector's order). A block of queries visits the lists of its own pivots only and
so accumulates the footrule distance: the sum over both orders' pivots of the
difference of their places, a missing pivot counting as place ``NEAREST``.

*Rerank.* In every block, the vectors whose footrule distance is among the
smallest ``SHARE`` of the block (all that tie with the last of them) are ranked
by Euclidean distance in double precision; the best of all blocks are merged by a
window. ``SHARE`` is a share, not a count, so the index behaves alike at every
size; 1.0 makes the search exact. At least as many as are kept are reranked.

Exact copies of a vector are indexed once, with their smallest ids, which is all
that a list of k neighbours can show of them; equal queries are searched once.

Vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null id, take no part; of rows with one id and one vector one counts.
Vectors of another length than most (the smaller length where lengths tie) take
no part. An empty table, or one without queries, gives no rows; fewer than k
candidates give them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.scratch import partitions, ship, stored

PIVOTS = 256
NEAREST = 64
SHARE = 0.3
BLOCK = 4096
QUERY_BLOCK = 4096
K = 10


def usable(vector: Column) -> Column:
    """Whether a vector takes part (null counts as no)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def orders(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The ``nearest`` nearest pivots of each vector, in order, ties by number."""
    d = (pivots * pivots).sum(1)[None, :] - 2.0 * (vectors @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :nearest]


class InvertedFile:
    """Posting lists of one block: per pivot, the vectors that hold it and where."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, nearest: int):
        order = orders(vectors, pivots, nearest)
        self.n, self.nearest = len(vectors), order.shape[1]
        flat = order.reshape(-1)
        by = np.argsort(flat, kind="stable")
        self.first = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        self.vector, self.place = by // self.nearest, (by % self.nearest).astype(np.int64)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of one order to every vector of the block."""
        m = self.nearest
        # nothing in common: every pivot of either side is missing on the other
        out = np.full(self.n, m * (m + 1), dtype=np.int64)
        lists = [slice(self.first[p], self.first[p + 1]) for p in order]
        place = np.concatenate([self.place[s] for s in lists])
        mine = np.repeat(np.arange(len(order)), [s.stop - s.start for s in lists])
        saved = (m - mine) + (m - place) - np.abs(mine - place)
        return out - np.bincount(
            np.concatenate([self.vector[s] for s in lists]), weights=saved, minlength=self.n
        ).astype(np.int64)


def search_block(vectors, queries, pivots, nearest: int, share: float, keep: int):
    """``(query, vector, distance)`` of the ``keep`` nearest found of each query,
    and all that tie with the last."""
    q, v, d = [], [], []
    index = InvertedFile(vectors, pivots, nearest) if share < 1.0 else None
    order = orders(queries, pivots, nearest) if index else None
    for i, x in enumerate(queries):
        if index is None:
            found = np.arange(len(vectors))
        else:
            far = index.footrule(order[i])
            n = min(len(far), max(keep, int(np.ceil(share * len(far)))))
            found = np.flatnonzero(far <= np.partition(far, n - 1)[n - 1])
        dist = np.sqrt(((vectors[found] - x) ** 2).sum(axis=1))
        if len(dist) > keep:
            near = dist <= np.partition(dist, keep - 1)[keep - 1]
            found, dist = found[near], dist[near]
        q.append(np.full(len(found), i))
        v.append(found)
        d.append(dist)
    return np.concatenate(q), np.concatenate(v), np.concatenate(d)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest_neighbours(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    share: float = SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row that ``is_query`` selects."""
    spark = table.sparkSession
    ship(spark)
    rows = table.where(F.col(id_col).isNotNull() & usable(F.col(vector))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector, lambda x: x.cast("double")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    )
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == most["d"]).withColumn("h", F.xxhash64("v"))
    # the smallest ids of each distinct vector: k neighbours and the query itself
    byte_equal = Window.partitionBy("h", "v").orderBy("id")
    kept = rows.select("h", "v", "id").distinct()
    kept = kept.withColumn("r", F.row_number().over(byte_equal)).where(F.col("r") <= k + 1)
    # at most k + 1 ids a vector; hash and vector name it
    distinct = stored(
        kept.groupBy("h", "v").agg(F.collect_list("id").alias("ids")).withColumn("id", F.array_min("ids")), "vectors"
    )
    sample = distinct.orderBy("h", "id").limit(pivots).select("v").toArrow()
    centres = spark.sparkContext.broadcast(_matrix(sample.column("v")))
    count = distinct.count()
    blocks = max(1, -(-count // block))
    asked = rows.where("q").select("h", "v", F.col("id").alias("query_id")).distinct()
    ask = stored(asked.groupBy("h", "v").agg(F.min("query_id").alias("ask")), "queries")
    ask_blocks = max(1, -(-ask.count() // QUERY_BLOCK))

    index = distinct.select(
        F.pmod("h", F.lit(blocks)).cast("int").alias("block"), "id", "v"
    )
    # each block of queries visits each index block: vectors travel once a block, never as pairs
    visits = ask.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.col("ask").alias("id"), "v", F.pmod("h", F.lit(ask_blocks)).cast("int").alias("part"),
    )

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"ask": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, v, d = search_block(
            _matrix(left.column("v")), _matrix(right.column("v")), centres.value, nearest, share, k + 1
        )
        ids, asks = left.column("id").to_numpy(), right.column("id").to_numpy()
        return pa.table({"ask": asks[q], "id": ids[v], "score": d})

    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))))
    found = spread.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInArrow(
        run, "ask long, id long, score double"
    )
    # of every distinct query the best of all blocks, each with its copies' ids
    best = Window.partitionBy("ask").orderBy("score", "id")
    top = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    copies = top.join(distinct.select("id", "ids"), "id").select("ask", "score", F.explode("ids").alias("vec_id"))
    names = asked.join(ask, ["h", "v"]).select("query_id", "ask")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        names.join(copies, "ask")
        .where("vec_id <> query_id")
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op8_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(table, F.col("vec_id") % 100 == 0)


__all__ = ["usable", "orders", "InvertedFile", "search_block", "nearest_neighbours", "op8_nearest_neighbours"]
