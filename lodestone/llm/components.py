"""Connected components of a distributed edge list by alternating large-star and small-star steps.

Each round is two joins with map-side combined minima; nothing is collected, a hot node is split by
Spark's skew join, and the lineage is cut in the shared folder after every round.  The number of
rounds grows with the logarithm of the longest path; none follows once the edges are stars, which
counts per node tell: the driver's memory follows the number of queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import checkpointed, few_parts, release


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller node
    low = e.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    hung = e.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return hung.union(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def _told(e: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether they are stars: every u has one edge, and no v is a u."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = e.select(F.col("u").alias("x"), one.alias("out"), none.alias("root")).union(e.select(F.col("v").alias("x"), none.alias("out"), one.alias("root")))
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    n, tangled = nodes.agg(F.sum("out"), F.max((F.col("out") + F.col("root") > 1).cast("int"))).first()
    return n or 0, not tangled


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """u, v -> node, component: the smallest node of each node's component, for all nodes with an edge.

    Self links and repeated links are allowed; an empty edge list gives an empty result.
    """
    # every edge points from the larger to the smaller node
    e = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    n, stars = _told(e)
    for _ in range(rounds):
        if stars:
            break
        e = checkpointed(_small_star(_large_star(few_parts(e, n))))
        n, stars = _told(e)
        release(e.sparkSession)  # the files of the round before
    if not stars:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    e = few_parts(e, n)
    release(e.sparkSession)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
