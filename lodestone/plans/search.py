"""Vector and hybrid search."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import norm
from lodestone.operators import retrieval
from lodestone.sources import load

DOT = "list_sum(list_transform(list_zip(e.embedding, q.embedding), lambda x: CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE)))"
LENGTH = "sqrt(list_sum(list_transform({}.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
KNN = f"SELECT e.vec_id, e.label, round({DOT} / ({LENGTH.format('e')} * {LENGTH.format('q')}), 6) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q"


def query_vector(spark, d):
    row = load(spark, d, "embeddings").where("vec_id = 0").select("embedding").first()
    return row[0] if row else []  # no vector has that dimension


@query("q_knn", f"SELECT vec_id, score FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 5")
def knn(spark, d):
    return retrieval.nearest(load(spark, d, "embeddings"), "vec_id", "embedding", query_vector(spark, d), 5)


@query("q_knn_label_vote", f"SELECT label, count(*) AS votes, round(max(score), 6) AS best FROM (SELECT * FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 15) GROUP BY label")
def knn_label_vote(spark, d):
    e = load(spark, d, "embeddings")
    top = retrieval.nearest(e, "vec_id", "embedding", query_vector(spark, d), 15)
    return top.join(e.select("vec_id", "label"), "vec_id").groupBy("label").agg(F.count(F.lit(1)).alias("votes"), F.round(F.max("score"), 6).alias("best"))


KEYWORD = r"""SELECT doc_id, round((length(lower(text)) - length(replace(lower(text), 'thatin', ''))) // 6 / greatest(len(list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda x: x <> '')), 1), 9) AS score
    FROM documents WHERE contains(lower(text), 'thatin') ORDER BY score DESC, doc_id LIMIT 10"""


@query("q_hybrid_search", f"""
    SELECT doc_id, round(sum(s), 6) AS score, string_agg(DISTINCT kind, '+' ORDER BY kind) AS kinds FROM (
      SELECT doc_id, 0.4 * score AS s, 'keyword' AS kind FROM ({KEYWORD}) UNION ALL
      SELECT vec_id, 0.6 * score, 'semantic' FROM (SELECT * FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 10)) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def hybrid_search(spark, d):
    k = retrieval.keyword_top(load(spark, d, "documents"), "doc_id", "text", ["thatin"], 10)
    s = retrieval.nearest(load(spark, d, "embeddings"), "vec_id", "embedding", query_vector(spark, d), 10).withColumnRenamed("vec_id", "doc_id")
    return retrieval.hybrid(k, s, "doc_id", 5)


@query("q_knowledge_budget", f"""
    SELECT doc_id, relative, used FROM (SELECT doc_id, round(score / max(score) OVER (), 6) AS relative, sum(n_chars) OVER (ORDER BY score DESC, doc_id) AS used
      FROM ({KEYWORD}) k JOIN (SELECT doc_id, n_chars FROM documents) n USING (doc_id)) WHERE used <= 200000""")
def knowledge_budget(spark, d):
    """Best keyword hits, scores relative to the best, until the characters run out."""
    docs = load(spark, d, "documents")
    top = retrieval.keyword_top(docs, "doc_id", "text", ["thatin"], 10).join(docs.select("doc_id", "n_chars"), "doc_id")
    best = top.agg(F.max("score").alias("best"))
    filled = retrieval.budget_fill(top, [F.desc("score"), F.col("doc_id")], "n_chars", 200000)
    return filled.crossJoin(best).select("doc_id", F.round(F.col("score") / F.col("best"), 6).alias("relative"), "used")


@query("q_vector_health", f"SELECT count(*) AS n, round(avg(x), 6) AS mean_norm, round(stddev_pop(x), 6) AS std_norm FROM (SELECT {LENGTH.format('e')} AS x FROM embeddings e)")
def vector_health(spark, d):
    e = load(spark, d, "embeddings").select(norm(F.col("embedding")).alias("x"))
    return e.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 6).alias("mean_norm"), F.round(F.stddev_pop("x"), 6).alias("std_norm"))


@query("q_knowledge_merge", f"""
    WITH k AS (SELECT doc_id, score / max(score) OVER () AS s FROM ({KEYWORD})), v AS (SELECT vec_id AS doc_id, score / max(score) OVER () AS s FROM (SELECT * FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 10))
    SELECT doc_id, round(sum(0.5 * s), 6) AS score FROM (SELECT * FROM k UNION ALL SELECT * FROM v) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def knowledge_merge(spark, d):
    """Both lists over their best score, half each; three remain."""
    k = retrieval.keyword_top(load(spark, d, "documents"), "doc_id", "text", ["thatin"], 10)
    v = retrieval.nearest(load(spark, d, "embeddings"), "vec_id", "embedding", query_vector(spark, d), 10).withColumnRenamed("vec_id", "doc_id")
    over = lambda x: x.crossJoin(x.agg(F.max("score").alias("best"))).select("doc_id", (0.5 * F.col("score") / F.col("best")).alias("s"))  # noqa: E731  ten rows
    return over(k).union(over(v)).groupBy("doc_id").agg(F.round(F.sum("s"), 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(3)


@query("q_graph_expanded", f"""
    WITH t AS (SELECT * FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 5), e AS (SELECT DISTINCT l_suppkey % 500 AS src, l_partkey % 500 AS dst FROM lineitem), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
         deg AS (SELECT src AS node, count(*) / (2.0 * 499) AS centrality FROM b GROUP BY 1), n AS (SELECT DISTINCT dst AS node FROM b JOIN t ON b.src = t.vec_id WHERE dst NOT IN (SELECT vec_id FROM t))
    SELECT vec_id AS node, score, 'hit' AS kind FROM t UNION ALL (SELECT n.node, round(0.3 + 0.3 * centrality, 6), 'neighbour' FROM n JOIN deg ON n.node = deg.node ORDER BY 2 DESC, 1 LIMIT 10)""")
def graph_expanded(spark, d):
    """Hits, and their neighbours in the call graph scored by centrality."""
    t = retrieval.nearest(load(spark, d, "embeddings"), "vec_id", "embedding", query_vector(spark, d), 5).withColumnRenamed("vec_id", "node")
    e = load(spark, d, "lineitem").select((F.col("l_suppkey") % 500).alias("src"), (F.col("l_partkey") % 500).alias("dst")).distinct()
    b = e.union(e.select("dst", "src")).distinct()
    degree = b.groupBy(F.col("src").alias("k")).agg((F.count("*") / (2.0 * 499)).alias("centrality"))
    n = b.join(F.broadcast(t.select(F.col("node").alias("hit"))), F.col("src") == F.col("hit")).select(F.col("dst").alias("node")).distinct().join(t.select("node"), "node", "left_anti")
    near = n.join(degree, F.col("node") == F.col("k")).select("node", F.round(0.3 + 0.3 * F.col("centrality"), 6).alias("score"), F.lit("neighbour").alias("kind")).orderBy(F.desc("score"), "node").limit(10)
    return t.select("node", "score", F.lit("hit").alias("kind")).union(near)


@query("q_search_dispatch", f"""
    WITH k AS (SELECT doc_id, score FROM ({KEYWORD}) ORDER BY score DESC, doc_id LIMIT 5), v AS (SELECT vec_id AS doc_id, score FROM ({KNN}) ORDER BY score DESC, vec_id LIMIT 5),
         n AS (SELECT p_partkey AS doc_id, round(CASE WHEN lower(p_name) = 'red widget' THEN 1.0 ELSE 10.0 / length(p_name) END, 6) AS score FROM part WHERE contains(lower(p_name), 'red widget') ORDER BY score DESC, doc_id LIMIT 5)
    SELECT 'keyword' AS mode, * FROM k UNION ALL SELECT 'semantic', * FROM v UNION ALL SELECT 'name', * FROM n""")
def search_dispatch(spark, d):
    """One search by each mode; the number of results is held between 1 and 20."""

    def search(mode, top_k):
        k = max(1, min(top_k, 20))
        if mode == "keyword":
            return retrieval.keyword_top(load(spark, d, "documents"), "doc_id", "text", ["thatin"], k)
        if mode == "semantic":
            return retrieval.nearest(load(spark, d, "embeddings"), "vec_id", "embedding", query_vector(spark, d), k).withColumnRenamed("vec_id", "doc_id")
        p = load(spark, d, "part").where(F.contains(F.lower("p_name"), F.lit("red widget")))
        score = F.round(F.when(F.lower("p_name") == "red widget", 1.0).otherwise(F.lit(10.0) / F.length("p_name")), 6)
        return p.select(F.col("p_partkey").alias("doc_id"), score.alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)

    out = None
    for mode in ("keyword", "semantic", "name"):
        one = search(mode, 5).select(F.lit(mode).alias("mode"), "doc_id", "score")
        out = one if out is None else out.union(one)
    return out


@query("q_multi_query", """
    WITH h AS (SELECT doc_id, CASE WHEN contains(lower(text), 'password') THEN 0 WHEN contains(lower(text), 'token') THEN 1 WHEN contains(lower(text), 'secret') THEN 2 WHEN contains(lower(text), 'license') THEN 3 END AS q, n_chars FROM documents)
    SELECT ['password', 'token', 'secret', 'license'][q + 1] AS category, count(*) AS docs, min(doc_id) AS first_doc, count_if(n_chars > 3000) AS high_risk FROM h WHERE q IS NOT NULL GROUP BY 1""")
def multi_query(spark, d):
    """Several queries in order: the first that hits a document gives its category; risk by size."""
    hit = F.lit(None).cast("string")
    for w in ("license", "secret", "token", "password"):
        hit = F.when(F.contains(F.lower("text"), F.lit(w)), w).otherwise(hit)
    h = load(spark, d, "documents").select("doc_id", "n_chars", hit.alias("category")).where("category is not null")
    return h.groupBy("category").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"), F.count_if(F.col("n_chars") > 3000).alias("high_risk"))


@query("q_similar_sessions", r"""
    WITH t AS (SELECT conv_id, list_distinct(regexp_extract_all(lower(string_agg(text, ' ')), '[a-z]{4,}')) AS w FROM conversations GROUP BY 1), q AS (SELECT w FROM t WHERE conv_id = 0)
    SELECT t.conv_id, round(len(list_intersect(t.w, q.w)) / (len(t.w) + len(q.w) - len(list_intersect(t.w, q.w))), 6) AS score FROM t, q WHERE t.conv_id <> 0 AND len(t.w) + len(q.w) > 0 ORDER BY score DESC, t.conv_id LIMIT 5""")
def similar_sessions(spark, d):
    """Sessions whose words are most like those of one session."""
    from lodestone.functions import jaccard

    words = F.array_distinct(F.regexp_extract_all(F.lower(F.array_join(F.collect_list("text"), " ")), F.lit("[a-z]{4,}"), F.lit(0)))
    t = load(spark, d, "conversations").groupBy("conv_id").agg(words.alias("w"))
    q = F.broadcast(t.where("conv_id = 0").select(F.col("w").alias("q")))  # one session
    return t.where("conv_id <> 0").crossJoin(q).where("size(w) + size(q) > 0").select("conv_id", F.round(jaccard(F.col("w"), F.col("q")), 6).alias("score")).orderBy(F.desc("score"), "conv_id").limit(5)
