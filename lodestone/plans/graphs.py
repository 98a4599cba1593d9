"""Call-graph queries over supplier-part edges, orders of dependencies and components."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import graph
from lodestone.sources import load

EDGES = "e AS (SELECT DISTINCT l_suppkey AS src, l_partkey + 1000000 AS dst FROM lineitem)"
DEGREES = f"{EDGES}, d AS (SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in FROM (SELECT src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) GROUP BY 1)"


def links(spark, d):
    return load(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + 1000000).alias("dst"))


def edges(spark, d):
    e = links(spark, d)
    return graph.dealt(e, ["src", "dst"], e.count()).distinct()


@query("q_degree_centrality", f"WITH {DEGREES} SELECT node, n_out, n_in, round((n_in + n_out) / (2.0 * ((SELECT count(*) FROM d) - 1)), 9) AS centrality FROM d ORDER BY centrality DESC, node LIMIT 20")
def degree_centrality(spark, d):
    return graph.centrality(edges(spark, d)).select("node", "n_out", "n_in", F.round("centrality", 9).alias("centrality")).orderBy(F.desc("centrality"), "node").limit(20)


@query("q_entry_leaf", f"WITH {DEGREES} SELECT node, CASE WHEN n_out > 2 AND (n_in = 0 OR n_out / (n_in + 1) > 2) THEN 'entry' ELSE 'leaf' END AS kind FROM d WHERE (n_out > 2 AND (n_in = 0 OR n_out / (n_in + 1) > 2)) OR (n_in > 2 AND (n_out = 0 OR n_in / (n_out + 1) > 2))")
def entry_leaf(spark, d):
    def much(a, b):
        return (F.col(a) > 2) & ((F.col(b) == 0) | (F.col(a) / (F.col(b) + 1) > 2))

    g = graph.degrees(edges(spark, d))
    return g.where(much("n_out", "n_in") | much("n_in", "n_out")).select("node", F.when(much("n_out", "n_in"), "entry").otherwise("leaf").alias("kind"))


@query("q_graph_stats", f"WITH {DEGREES} SELECT (SELECT count(*) FROM d) AS nodes, (SELECT count(*) FROM e) AS edges, round(2.0 * (SELECT count(*) FROM e) / (SELECT count(*) FROM d), 6) AS mean_degree, max(n_out) AS most_out FROM d")
def graph_stats(spark, d):
    s = graph.degrees(edges(spark, d)).agg(F.count(F.lit(1)).alias("nodes"), F.sum("n_out").alias("edges"), F.max("n_out").alias("most_out"))
    return s.select("nodes", "edges", F.round(2.0 * F.col("edges") / F.col("nodes"), 6).alias("mean_degree"), "most_out")


@query("q_bfs_2hop", f"""
    WITH {EDGES}, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), s AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth),
    h1 AS (SELECT DISTINCT dst AS node FROM b WHERE src = 1 AND dst <> 1), h2 AS (SELECT DISTINCT b.dst AS node FROM b JOIN h1 ON b.src = h1.node WHERE b.dst <> 1 AND b.dst NOT IN (SELECT node FROM h1))
    SELECT * FROM s UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2""")
def bfs_2hop(spark, d):
    return graph.reachable(links(spark, d), spark.createDataFrame([(1,)], "node long"), 2)


GRID = "g AS (SELECT n_nationkey AS src, (n_nationkey * 7 + 3) % 25 AS dst FROM nation UNION SELECT n_nationkey, (n_nationkey * 3 + 1) % 25 FROM nation)"


@query("q_paths", f"""
    WITH RECURSIVE {GRID}, r(path, tail) AS (SELECT [CAST(1 AS BIGINT)], 1 UNION ALL SELECT list_append(path, CAST(dst AS BIGINT)), dst FROM r JOIN g ON tail = src WHERE len(path) <= 5 AND NOT list_contains(path, dst) AND tail <> 20)
    SELECT array_to_string(path, '>') AS path FROM r WHERE tail = 20 ORDER BY len(r.path), r.path LIMIT 5""")
def paths(spark, d):
    """Up to five simple paths of up to five edges between two nodes."""
    n = load(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("src"))
    g = n.select("src", ((F.col("src") * 7 + 3) % 25).alias("dst")).union(n.select("src", ((F.col("src") * 3 + 1) % 25)))
    return graph.simple_paths(g, 1, 20).select(F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


# Documents that share a long number, and documents of a source that follow each other by seven.
SHARED = "x AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[0-9]{5,}')) AS v FROM documents), m AS (SELECT v, min(doc_id) AS low FROM x GROUP BY 1), e AS (SELECT DISTINCT doc_id AS src, low AS dst FROM x JOIN m USING (v))"


@query("q_components", f"""
    WITH RECURSIVE {SHARED}, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), r(node, reach) AS (SELECT src, src FROM b UNION SELECT r.node, b.dst FROM r JOIN b ON r.reach = b.src)
    SELECT node, min(reach) AS component FROM r GROUP BY 1""")
def components(spark, d):
    """Documents joined by the numbers that they share; a number's documents meet at the first, not pairwise."""
    x = load(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]{5,}"), F.lit(0)))).alias("v"))
    low = x.groupBy(F.col("v").alias("w")).agg(F.min("doc_id").alias("dst"))
    return graph.smallest_reachable(x.join(low, F.col("v") == F.col("w")).select(F.col("doc_id").alias("src"), "dst"))


# Parts depend on smaller keys of their brand's rule; keys that 97 divides are on a ring.
DEPENDS = "n AS (SELECT p_partkey AS node FROM part), e AS (SELECT p_partkey AS src, p_partkey // 3 AS dst FROM part WHERE p_partkey > 0 UNION SELECT p_partkey, p_partkey // 2 - 1 FROM part WHERE p_partkey > 3 UNION SELECT p_partkey, p_partkey + 97 FROM part WHERE p_partkey % 97 = 0 AND p_partkey > 1000 AND p_partkey + 97 IN (SELECT p_partkey FROM part))"


@query("q_leaf_first", f"""
    WITH RECURSIVE {DEPENDS}, d AS (SELECT * FROM e WHERE src <> dst AND dst IN (SELECT node FROM n)), c(node, reach) AS (SELECT src, dst FROM d WHERE src % 97 = 0 AND src > 1000 UNION SELECT c.node, d.dst FROM c JOIN d ON c.reach = d.src),
         cyc AS (SELECT DISTINCT node FROM c WHERE node = reach), bad(node) AS (SELECT node FROM cyc UNION SELECT d.src FROM d JOIN bad ON d.dst = bad.node),
         l(node, depth) AS (SELECT node, 0 FROM n UNION SELECT d.src, l.depth + 1 FROM l JOIN d ON d.dst = l.node WHERE d.src NOT IN (SELECT node FROM bad))
    SELECT n.node, CASE WHEN n.node IN (SELECT node FROM bad) THEN NULL ELSE max(depth) END AS level FROM n JOIN l ON n.node = l.node GROUP BY 1""")
def leaf_first(spark, d):
    """Levels of a leaf-first order over real dependencies; nodes on or above a cycle have none and come last."""
    p = load(spark, d, "part").select(F.col("p_partkey").alias("k"))
    ring = p.where("k % 97 = 0 and k > 1000").select(F.col("k").alias("src"), (F.col("k") + 97).alias("dst")).join(p, F.col("dst") == F.col("k"), "left_semi")
    e = p.where("k > 0").select(F.col("k").alias("src"), F.floor(F.col("k") / 3).alias("dst")).union(p.where("k > 3").select("k", F.floor(F.col("k") / 2) - 1)).union(ring)
    return graph.leaf_first(e, p.withColumnRenamed("k", "node"))


@query("q_expansion", f"""
    WITH {EDGES}, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), deg AS (SELECT src AS node, count(*) AS degree FROM b GROUP BY 1)
    SELECT s.src AS start, b.dst AS node, degree FROM (VALUES (1), (7), (1000005)) s(src) JOIN b ON b.src = s.src JOIN deg ON deg.node = b.dst QUALIFY row_number() OVER (PARTITION BY s.src ORDER BY degree DESC, b.dst) <= 4""")
def expansion(spark, d):
    """The best connected neighbours of a few nodes: four each at most."""
    from pyspark.sql import Window as W

    b = links(spark, d)
    b = b.union(b.select("dst", "src"))
    near = graph.few(b.where(F.col("src").isin(1, 7, 1000005)).select(F.col("src").alias("start"), F.col("dst").alias("near")).distinct())
    # only the neighbours' own edges are counted
    theirs = b.join(graph.few(near.select("near").distinct()), F.col("src") == F.col("near"), "left_semi").distinct()
    degree = theirs.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    near = degree.join(near, F.col("near") == F.col("node")).select("start", "node", "degree")
    return near.withColumn("rn", F.row_number().over(W.partitionBy("start").orderBy(F.desc("degree"), "node"))).where("rn <= 4").drop("rn")


@query("q_domain_members", "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 20")
def domain_members(spark, d):
    """Twenty members of each domain at most."""
    from pyspark.sql import Window as W

    w = W.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return load(spark, d, "part").withColumn("rn", F.row_number().over(w)).where("rn <= 20").select("p_brand", "p_partkey")


@query("q_component_units", f"""
    WITH {EDGES}, o AS (SELECT dst, min(src) AS grp FROM e GROUP BY 1), r AS (SELECT grp, dst, ceil(row_number() OVER (PARTITION BY grp ORDER BY dst) / 40.0)::BIGINT AS unit FROM o),
         c AS (SELECT r.grp, r.unit, r.dst, count(CASE WHEN e.src = r.grp THEN 1 END) AS inner_callers, count(CASE WHEN e.src <> r.grp THEN 1 END) AS outer_callers FROM r JOIN e ON e.dst = r.dst GROUP BY 1, 2, 3)
    SELECT grp, unit, count(*) AS members, min(dst) AS first_member, CAST(sum(outer_callers) AS BIGINT) AS external FROM c GROUP BY 1, 2""")
def component_units(spark, d):
    """Groups cut into units of forty, with the references that come from outside."""
    from pyspark.sql import Window as W

    e = edges(spark, d)
    o = e.groupBy("dst").agg(F.min("src").alias("grp"), (F.count("*") - 1).alias("outer"))
    unit = F.ceil(F.row_number().over(W.partitionBy("grp").orderBy("dst")) / 40.0).cast("long")
    return o.withColumn("unit", unit).groupBy("grp", "unit").agg(F.count("*").alias("members"), F.min("dst").alias("first_member"), F.sum("outer").alias("external"))


@query("q_dispatch_walk", f"""
    WITH RECURSIVE {GRID}, r(node, depth) AS (SELECT 2, 0 UNION SELECT g.dst, depth + 1 FROM r JOIN g ON r.node = g.src WHERE depth < 6) SELECT CAST(node AS BIGINT) AS node, min(depth) AS depth FROM r GROUP BY 1""")
def dispatch_walk(spark, d):
    """Tables reached from a root, each visited once, up to six steps."""
    n = load(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("src"))
    g = n.select("src", ((F.col("src") * 7 + 3) % 25).alias("dst")).union(n.select("src", ((F.col("src") * 3 + 1) % 25)))
    seen = front = spark.createDataFrame([(2, 0)], "node long, depth int")
    for depth in range(1, 7):
        front = front.join(g, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(depth))
        seen = seen.union(front)
    return seen


@query("q_fingerprint_groups", r"""
    WITH f AS (SELECT doc_id, sha256(regexp_replace(lower(trim(text)), '[ \t\n\r]+', ' ', 'g')) AS fingerprint FROM documents)
    SELECT fingerprint, min(doc_id) AS canonical, count(*) AS n, count(*) - 1 AS avoided FROM f GROUP BY 1 HAVING count(*) > 1""")
def fingerprint_groups(spark, d):
    f = F.sha2(F.regexp_replace(F.lower(F.trim("text")), r"[ \t\n\r]+", " "), 256)
    g = load(spark, d, "documents").select("doc_id", f.alias("fingerprint")).groupBy("fingerprint").agg(F.min("doc_id").alias("canonical"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.withColumn("avoided", F.col("n") - 1)
