"""Connected components by alternating stars, as joins and aggregates.

No component is gathered anywhere: every step moves single edges, and a hot
node's edges are counted by partial aggregates and joined under adaptive skew
splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.scratch import stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """``(u, m)``: the smallest of u and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"),
        ).first()
    )


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with a link; root is the smallest node it reaches.

    Self links and repeated links are allowed. Empty input gives no rows. Raises
    if the stars have not settled after ``max_rounds`` (they need about the
    logarithm of a component's size).
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_smallest(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        edges = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = stored(edges, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
