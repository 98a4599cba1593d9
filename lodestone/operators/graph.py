"""Graphs as edge tables: degrees, bounded search, components, levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(df: DataFrame, by: list[str], rows: int, each: int = 500_000) -> DataFrame:
    """Deals about so many rows to partitions of ``each``, so that what a task groups does not grow with the input."""
    return df.repartition(max(1, -(-rows // each)), *by)


def degrees(edges: DataFrame) -> DataFrame:
    """node, n_out, n_in over distinct edges src, dst; isolated nodes need their own table."""
    e = edges.select("src", "dst").distinct()
    ends = F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return e.select(F.inline(ends)).groupBy("node").agg(F.sum("o").cast("long").alias("n_out"), F.sum("i").cast("long").alias("n_in"))


def centrality(edges: DataFrame) -> DataFrame:
    """Adds (in + out) / (2 (n - 1))."""
    d = degrees(edges)
    n = d.agg(F.count(F.lit(1)).alias("n"))
    return d.crossJoin(F.broadcast(n)).withColumn("centrality", F.when(F.col("n") > 1, (F.col("n_in") + F.col("n_out")) / (2 * (F.col("n") - 1))).otherwise(0.0)).drop("n")


def few(df: DataFrame, most: int = 500_000) -> DataFrame:
    """Stores narrow rows and marks them for broadcast if there are at most so many; beyond that they are joined by a shuffle."""
    stored = _settled(df)
    return F.broadcast(stored) if stored.count() <= most else stored


def reachable(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """node, depth of nodes within so many hops of start (column node), edges followed both ways.

    Edges may repeat: only the nodes that a hop reaches are made distinct, and a front of few nodes is sent to the edges.
    """
    front = few(start.select("node", F.lit(0).alias("depth")).distinct())
    seen = front
    for d in range(1, depth + 1):
        ways = [edges.join(front.select("node"), F.col(a) == F.col("node")).select(F.col(b).alias("node")) for a, b in (("src", "dst"), ("dst", "src"))]
        front = few(ways[0].union(ways[1]).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(d)))
        seen = seen.union(front)
    return seen


def _settled(df: DataFrame) -> DataFrame:
    """Stores a round's rows: by checkpoint() where the session names a folder, else in memory."""
    return df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist()


def smallest_reachable(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component: the smallest node of each component, by label propagation with pointer jumps.

    Raises an error where the labels have not settled after ``rounds``; the rows of a round are let go
    when the next ones are there.
    """
    both = _settled(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    label = both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("component"))
    last, before = None, None
    for _ in range(rounds):
        low = both.join(label, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("component").alias("m"))
        label = label.join(low, F.col("node") == F.col("src"), "left").select("node", F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = label.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        label = _settled(label.join(jump, F.col("component") == F.col("n2"), "left").select("node", F.least("component", F.coalesce("c2", "component")).alias("component")))
        total = label.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if before is not None:
            before.unpersist()
        if total == last:
            return label
        last, before = total, label
    raise RuntimeError(f"components did not settle within {rounds} rounds")


def _chains(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For nodes with one dependency: node, to, w, the first node behind that has none or several, w steps away; and
    node of those whose only way leads into a cycle.  Every round doubles the steps."""
    single = e.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("to")).where("n = 1")
    at = _settled(single.select(F.col("src").alias("node"), "to", F.lit(1).cast("long").alias("w"), F.lit(True).alias("open")))
    last = None
    while True:
        ahead = at.select(F.col("node").alias("k"), F.col("to").alias("further"), F.col("w").alias("more"))
        joined = at.join(ahead, F.col("to") == F.col("k"), "left")
        step = _settled(joined.select("node", F.coalesce("further", "to").alias("to"), (F.col("w") + F.coalesce("more", F.lit(0))).alias("w"), F.col("k").isNotNull().alias("open")))
        number = step.where("open").count()
        at.unpersist()
        at = step
        # a way that ends closes at least one node more in every round
        if number in (0, last):
            return at.where("not open").drop("open"), at.where("open").select("node")
        last = number


def leaf_first(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, level: 0 for nodes that depend on nothing, else one more than the highest dependency; null on and above cycles.

    edges: src depends on dst; edges from other nodes are ignored, other nodes depended on count as 0.  Chains of nodes
    with one dependency are gone along by doubling; then each round takes the nodes with several, all of whose
    dependencies have a level, so that there are as many rounds as such nodes on the longest way.
    """
    known = nodes.select("node").distinct()
    e = _settled(edges.where("src <> dst").select("src", "dst").distinct().join(known, F.col("src") == F.col("node"), "left_semi"))
    ways, stuck = _chains(e)
    several = e.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("src").alias("node"))
    ends = ways.select(F.col("node").alias("k"), "to", "w")
    far = e.join(several, F.col("src") == F.col("node"), "left_semi").join(ends, F.col("dst") == F.col("k"), "left")
    far = _settled(far.groupBy("src", F.coalesce("to", "dst").alias("to")).agg(F.max(F.coalesce("w", F.lit(0)) + 1).alias("w")))
    left, done = _settled(several), known.sparkSession.createDataFrame([], nodes.select("node").schema).withColumn("level", F.lit(0).cast("long"))
    parts = []
    while True:
        waits = left.union(stuck).withColumnRenamed("node", "k")
        blocked = far.join(waits, F.col("to") == F.col("k"), "left_semi").select(F.col("src").alias("node"))
        free = left.join(blocked, "node", "left_anti")
        ready = far.join(free, F.col("src") == F.col("node"), "left_semi").join(done.withColumnRenamed("node", "k"), F.col("to") == F.col("k"), "left")
        now = _settled(ready.groupBy(F.col("src").alias("node")).agg(F.max(F.coalesce("level", F.lit(0)) + F.col("w")).alias("level")))
        if now.isEmpty():
            break
        parts.append(now)
        done = done.union(now)
        rest = _settled(left.join(now, "node", "left_anti"))
        none = rest.isEmpty()
        left.unpersist()
        left = rest
        if none:
            break
        if len(parts) == 16:
            # one table instead of many, so that plans stay short
            done = _settled(done)
            done.count()
            for x in parts:
                x.unpersist()
            parts = []
    reached = ways.join(done.withColumnRenamed("node", "k"), F.col("to") == F.col("k"), "left")
    reached = reached.join(left.select(F.col("node").alias("l")), F.col("to") == F.col("l"), "left")
    reached = reached.select("node", F.when(F.col("l").isNull(), F.coalesce("level", F.lit(0)) + F.col("w")).alias("level"))
    never = left.union(stuck).withColumn("level", F.lit(None).cast("long"))
    levels = done.union(reached).union(never)
    return known.join(levels, "node", "left").join(e.select(F.col("src").alias("s")).distinct(), F.col("node") == F.col("s"), "left").select("node", F.when(F.col("s").isNull(), 0).otherwise(F.col("level")).cast("int").alias("level"))


def simple_paths(edges: DataFrame, start, end, most_edges: int = 5, most_paths: int = 5) -> DataFrame:
    """path: paths without repeated nodes from start to end, shortest first; a bounded number of them, as asked for."""
    g = edges.select("src", "dst").distinct()
    path, found = g.sparkSession.createDataFrame([([start],)], "path array<long>"), None
    for _ in range(most_edges):
        path = path.join(g, F.element_at("path", -1) == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.array_append("path", F.col("dst")).alias("path"))
        here = path.where(F.element_at("path", -1) == end)
        found = here if found is None else found.union(here)
        path = path.where(F.element_at("path", -1) != end)
    return found.orderBy(F.size("path"), "path").limit(most_paths)
