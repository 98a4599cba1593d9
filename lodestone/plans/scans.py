"""Catalog scans, filters, lookups and set checks."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators.intervals import containing
from lodestone.sources import load


@query("q_page_functions", """
    SELECT p_partkey, p_name, total, least(offset_ + 50, total) AS shown_to, CASE WHEN offset_ + 50 < total THEN offset_ + 50 END AS next_offset
    FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS rn, count(*) OVER () AS total, 100 AS offset_ FROM part)
    WHERE rn > 100 AND rn <= 150""")
def page_functions(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_name")
    page = part.orderBy("p_partkey").offset(100).limit(50)
    total = part.agg(F.count(F.lit(1)).alias("total"))
    return page.crossJoin(total).select("p_partkey", "p_name", "total", F.least(F.lit(150).cast("long"), "total").alias("shown_to"), F.when(F.col("total") > 150, F.lit(150).cast("long")).alias("next_offset"))


@query("q_distinct_namespaces", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL ORDER BY source")
def distinct_namespaces(spark, d):
    return load(spark, d, "documents").select("source").where("source is not null").distinct().orderBy("source")


@query("q_import_refs", """
    WITH c AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
         f AS (SELECT l_partkey, string_agg(CAST(l_suppkey AS VARCHAR), ', ' ORDER BY l_suppkey) AS callers FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS rn FROM c) WHERE rn <= 5 GROUP BY 1),
         n AS (SELECT l_partkey, count(*) AS refs FROM lineitem GROUP BY 1),
         k AS (SELECT l_partkey, count(*) AS k FROM c GROUP BY 1)
    SELECT p_partkey, coalesce(refs, 0) AS ref_count, CASE WHEN k > 5 THEN callers || ', ...' ELSE coalesce(callers, '') END AS callers
    FROM part LEFT JOIN n ON p_partkey = n.l_partkey LEFT JOIN f ON p_partkey = f.l_partkey LEFT JOIN k ON p_partkey = k.l_partkey""")
def import_refs(spark, d):
    """Reference counts and the first five distinct callers; counted before any list is built."""
    pairs = load(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    ranked = pairs.withColumn("rn", F.row_number().over(W.partitionBy("l_partkey").orderBy("l_suppkey")))
    first = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rn") <= 5, F.col("l_suppkey")))), lambda x: x.cast("string")), ", ")
    refs = ranked.groupBy("l_partkey").agg(F.sum("n").alias("refs"), F.count(F.lit(1)).alias("k"), first.alias("c"))
    out = load(spark, d, "part").select("p_partkey").join(refs, F.col("p_partkey") == F.col("l_partkey"), "left")
    return out.select("p_partkey", F.coalesce("refs", F.lit(0)).alias("ref_count"), F.when(F.col("k") > 5, F.concat("c", F.lit(", ..."))).otherwise(F.coalesce("c", F.lit(""))).alias("callers"))


@query("q_name_search", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') ORDER BY p_name, p_partkey")
def name_search(spark, d):
    return load(spark, d, "part").where(F.contains(F.lower("p_name"), F.lit("ring"))).select("p_partkey", "p_name").orderBy("p_name", "p_partkey")


@query("q_name_score", """
    SELECT p_partkey, p_name, CASE WHEN lower(p_name) = 'red widget' THEN 1.0 ELSE round(6.0 / length(p_name), 6) END AS score
    FROM part WHERE contains(lower(p_name), 'widget')""")
def name_score(spark, d):
    p = load(spark, d, "part").where(F.contains(F.lower("p_name"), F.lit("widget")))
    score = F.when(F.lower("p_name") == "red widget", 1.0).otherwise(F.round(F.lit(6.0) / F.length("p_name"), 6))
    return p.select("p_partkey", "p_name", score.alias("score"))


@query("q_string_filter", "SELECT page_id, url FROM pages WHERE contains(lower(url), 'a') ORDER BY page_id LIMIT 50")
def string_filter(spark, d):
    return load(spark, d, "pages").where(F.contains(F.lower("url"), F.lit("a"))).select("page_id", "url").orderBy("page_id").limit(50)


@query("q_containing_range", """
    WITH r AS (SELECT o_orderkey AS range_id, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 181) AS lo, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 181 + 60 + o_custkey % 200) AS hi FROM orders)
    SELECT event_id, range_id FROM events LEFT JOIN r ON ts >= lo AND ts < hi""")
def containing_range(spark, d):
    """Events in ranges of uneven width that overlap and leave gaps; events outside all of them are kept."""
    e = load(spark, d, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    zero = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    lo = zero + F.col("o_orderkey") * 181_000_000
    r = load(spark, d, "orders").select(F.col("o_orderkey").alias("range_id"), lo.alias("lo"), (lo + (60 + F.col("o_custkey") % 200) * 1_000_000).alias("hi"))
    return containing(e, "at", r, "lo", "hi", 300_000_000).select("event_id", "range_id")


@query("q_precedence_lookup", """
    SELECT s_suppkey, coalesce(p.name, s_name) AS name, CASE WHEN p.name IS NULL THEN 'inferred' ELSE 'authoritative' END AS kind
    FROM supplier LEFT JOIN (SELECT p_partkey, p_name AS name FROM part WHERE p_size > 25) p ON s_suppkey = p_partkey""")
def precedence_lookup(spark, d):
    p = load(spark, d, "part").where("p_size > 25").select("p_partkey", F.col("p_name").alias("pn"))
    s = load(spark, d, "supplier").join(p, F.col("s_suppkey") == F.col("p_partkey"), "left")
    return s.select("s_suppkey", F.coalesce("pn", "s_name").alias("name"), F.when(F.col("pn").isNull(), "inferred").otherwise("authoritative").alias("kind"))


@query("q_anti_or", """
    SELECT s_suppkey FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49.5 AND l_discount > 0.09)
      AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 5)""")
def anti_or(spark, d):
    """Skip rows known by either key: two anti joins, not one with OR."""
    busy = load(spark, d, "lineitem").where("l_quantity > 49.5 and l_discount > 0.09").select("l_suppkey").distinct()
    near = load(spark, d, "nation").where("n_nationkey < 5").select("n_nationkey")
    s = load(spark, d, "supplier").join(busy, F.col("s_suppkey") == F.col("l_suppkey"), "left_anti")
    return s.join(near, F.col("s_nationkey") == F.col("n_nationkey"), "left_anti").select("s_suppkey")


@query("q_partition_check", """
    SELECT 'unknown' AS kind, count(*) AS n FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)
    UNION ALL SELECT 'missing', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    UNION ALL SELECT 'duplicate', count(*) FROM (SELECT doc_id FROM labels GROUP BY 1 HAVING count(*) > 1)""")
def partition_check(spark, d):
    docs, labels = load(spark, d, "documents").select("doc_id"), load(spark, d, "labels").select("doc_id")
    n = F.count(F.lit(1)).alias("n")
    out = labels.join(docs, "doc_id", "left_anti").distinct().agg(n).select(F.lit("unknown").alias("kind"), "n")
    out = out.union(docs.join(labels, "doc_id", "left_anti").distinct().agg(n).select(F.lit("missing"), "n"))
    return out.union(labels.groupBy("doc_id").count().where("count > 1").agg(n).select(F.lit("duplicate"), "n"))


@query("q_units_40", """
    SELECT p_brand, CAST(ceil(rn / 40.0) AS BIGINT) AS unit, count(*) AS n, min(p_partkey) AS entry FROM
    (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) GROUP BY 1, 2""")
def units_40(spark, d):
    w = W.partitionBy("p_brand").orderBy("p_partkey")
    p = load(spark, d, "part").select("p_brand", "p_partkey", F.ceil(F.row_number().over(w) / 40.0).cast("long").alias("unit"))
    return p.groupBy("p_brand", "unit").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("entry"))


@query("q_left_lookup", """
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality, d.lang FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id""")
def left_lookup(spark, d):
    labels = load(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return load(spark, d, "documents").select("doc_id", "lang").join(labels, "doc_id", "left").select("doc_id", F.coalesce("q", F.lit(-1)).alias("quality"), "lang")


@query("q_asof_next", """
    SELECT event_id, user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event FROM events""")
def asof_next(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    return load(spark, d, "events").select("event_id", "user_id", F.lead("event_id").over(w).alias("next_event"))
