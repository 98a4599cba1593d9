"""Evaluation statistics."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.sources import load


@query("q_corpus_stats", """
    SELECT metric, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, median(v) AS median, min(v) AS low, max(v) AS high FROM
    (SELECT 'quantity' AS metric, l_quantity AS v FROM lineitem UNION ALL SELECT 'discount', l_discount FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem) GROUP BY 1""")
def corpus_stats(spark, d):
    x = load(spark, d, "lineitem").select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).alias("v")) for n, c in (("quantity", "l_quantity"), ("discount", "l_discount"), ("tax", "l_tax"))])).alias("s")).select("s.*")
    # equal values are counted before any median: a metric's task holds its distinct values
    c = x.where("v is not null").groupBy("metric", "v").agg(F.count("*").alias("k"))
    middle = c.groupBy(F.col("metric").alias("m")).agg(F.expr("percentile(v, 0.5, k)").alias("median"))
    out = x.groupBy("metric").agg(F.count("v").alias("n"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("std"), F.min("v").alias("low"), F.max("v").alias("high"))
    return out.join(middle, F.col("metric") == F.col("m")).select("metric", "n", "mean", "std", "median", "low", "high")


@query("q_weighted_score", """
    SELECT d.doc_id, CASE WHEN w > 0 THEN round(s / w, 6) ELSE 0.0 END AS score FROM (
      SELECT d.doc_id, CASE WHEN quality IS NULL THEN 0 ELSE 0.35 END + CASE WHEN toxic IS NULL THEN 0 ELSE 0.35 END + 0.15 AS w,
             coalesce(0.35 * quality, 0) + coalesce(0.35 * (1 - toxic), 0) + 0.15 * least(n_chars, 5000) / 5000.0 AS s FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) d""")
def weighted_score(spark, d):
    """Weights are renormalised over the metrics that are present."""
    x = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id", "left")
    parts = [(0.35, F.col("quality").cast("double")), (0.35, 1 - F.col("toxic").cast("double")), (0.15, F.least("n_chars", F.lit(5000)) / 5000.0)]
    w = sum((F.when(v.isNull(), 0.0).otherwise(x0) for x0, v in parts), F.lit(0.0))
    s = sum((F.coalesce(v * x0, F.lit(0.0)) for x0, v in parts), F.lit(0.0))
    return x.select("doc_id", F.when(w > 0, F.round(s / w, 6)).otherwise(0.0).alias("score"))


@query("q_prf", """
    WITH p AS (SELECT quality = 1 AS gold, NOT contains(text, '!!') AS said FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
    SELECT count_if(gold AND said) AS tp, count_if(said AND NOT gold) AS fp, count_if(gold AND NOT said) AS fn,
      round(CASE WHEN count_if(said) = 0 THEN 1.0 ELSE count_if(gold AND said) / count_if(said) END, 3) AS precision_, round(CASE WHEN count_if(gold) = 0 THEN 1.0 ELSE count_if(gold AND said) / count_if(gold) END, 3) AS recall_ FROM p""")
def prf(spark, d):
    """Precision and recall; an empty denominator gives 1."""
    p = load(spark, d, "labels").join(load(spark, d, "documents").select("doc_id", (~F.contains("text", F.lit("!!"))).alias("said")), "doc_id").withColumn("gold", F.col("quality") == 1)
    c = p.agg(F.count_if(F.col("gold") & F.col("said")).alias("tp"), F.count_if(F.col("said") & ~F.col("gold")).alias("fp"), F.count_if(F.col("gold") & ~F.col("said")).alias("fn"))
    share = lambda b: F.round(F.when(F.col("tp") + F.col(b) == 0, 1.0).otherwise(F.col("tp") / (F.col("tp") + F.col(b))), 3)
    return c.select("tp", "fp", "fn", share("fp").alias("precision_"), share("fn").alias("recall_"))


@query("q_count_by", "SELECT lang, count(*) AS n, sum(n_chars) AS chars, CAST(sum(n_chars) AS BIGINT) // 4 AS tokens FROM documents GROUP BY 1")
def count_by(spark, d):
    g = load(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    return g.withColumn("tokens", F.floor(F.col("chars") / 4))


@query("q_mean_vector", "SELECT label, i - 1 AS i, round(avg(embedding[i]), 6) AS v FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY 1, 2")
def mean_vector(spark, d):
    e = load(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", F.col("i").cast("long").alias("i")).agg(F.round(F.avg("x"), 6).alias("v"))
