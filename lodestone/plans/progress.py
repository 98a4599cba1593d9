"""Counters, progress, comparison statistics, ordering and windows."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import cosine, token_estimate
from lodestone.sources import load

COSINE = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query("q_name_accuracy", "SELECT count_if(quality IS NOT DISTINCT FROM CASE WHEN toxic = 1 THEN 0 WHEN doc_id % 5 = 0 THEN NULL ELSE 1 END) / count(*) AS accuracy FROM labels")
def name_accuracy(spark, d):
    """Share of equal values; two nulls are equal."""
    said = F.when(F.col("toxic") == 1, 0).when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(1)
    return load(spark, d, "labels").agg((F.count_if(F.col("quality").eqNullSafe(said)) / F.count("*")).alias("accuracy"))


@query("q_timing", "SELECT event_type, round(avg(value), 6) AS mean, round(sum(value), 4) AS total FROM events GROUP BY 1")
def timing(spark, d):
    return load(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.sum("value"), 4).alias("total"))


@query("q_similarity_sample", f"WITH s AS (SELECT * FROM embeddings ORDER BY vec_id LIMIT 5) SELECT a.vec_id AS a, b.vec_id AS b, round({COSINE}, 6) AS score FROM s a, s b")
def similarity_sample(spark, d):
    """Similarities among five vectors."""
    s = load(spark, d, "embeddings").orderBy("vec_id").limit(5).select("vec_id", "embedding")
    b = F.broadcast(s.select(F.col("vec_id").alias("b"), F.col("embedding").alias("other")))
    return s.crossJoin(b).select(F.col("vec_id").alias("a"), "b", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


@query("q_dump_stats", """
    SELECT count(*) AS n, count_if(n_chars < 200) AS filtered, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(sum(CASE WHEN n_chars < 200 THEN n_chars ELSE 0 END) AS BIGINT) AS saved_chars,
      CAST(sum(CASE WHEN n_chars >= 200 THEN n_chars ELSE 0 END) AS BIGINT) // 4 AS tokens FROM documents""")
def dump_stats(spark, d):
    small = F.col("n_chars") < 200
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n_chars"))), F.lit(0))
    n = load(spark, d, "documents").agg(F.count("*").alias("n"), F.count_if(small).alias("filtered"), F.sum("n_chars").alias("chars"), total(small).alias("saved_chars"), total(~small).alias("kept"))
    return n.select("n", "filtered", "chars", "saved_chars", F.floor(F.col("kept") / 4).alias("tokens"))


@query("q_outcome_counters", """
    SELECT o_orderpriority, count(*) AS total, count_if(o_orderstatus = 'F') AS done, count_if(o_orderstatus = 'P') AS running, count(*) - count_if(o_orderstatus IN ('F', 'P')) AS waiting FROM orders GROUP BY 1""")
def outcome_counters(spark, d):
    """Counts by status; what has none of them waits."""
    n = load(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "P").alias("running"))
    return n.withColumn("waiting", F.col("total") - F.col("done") - F.col("running"))


@query("q_ab_compare", """
    WITH s AS (SELECT l.doc_id, CAST(quality AS DOUBLE) AS a, 1.0 - toxic + least(n_chars, 1000) / 4000.0 AS b FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
    SELECT round(avg(a), 6) AS mean_a, round(avg(b), 6) AS mean_b, count_if(b > a) AS better, count_if(b < a) AS worse, count_if(a = b) AS same,
      CASE WHEN avg(b) > avg(a) THEN 'better' WHEN avg(b) < avg(a) THEN 'worse' ELSE 'same' END AS verdict FROM s""")
def ab_compare(spark, d):
    s = load(spark, d, "labels").join(load(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality").cast("double").alias("a"), (1.0 - F.col("toxic") + F.least("n_chars", F.lit(1000)) / 4000.0).alias("b"))
    m = s.agg(F.avg("a").alias("x"), F.avg("b").alias("y"), F.count_if(F.col("b") > F.col("a")).alias("better"), F.count_if(F.col("b") < F.col("a")).alias("worse"), F.count_if(F.col("a") == F.col("b")).alias("same"))
    return m.select(F.round("x", 6).alias("mean_a"), F.round("y", 6).alias("mean_b"), "better", "worse", "same", F.when(F.col("y") > F.col("x"), "better").when(F.col("y") < F.col("x"), "worse").otherwise("same").alias("verdict"))


@query("q_tag_confidence", """
    WITH o AS (SELECT DISTINCT user_id AS key, event_type AS tag, CAST(json_extract(props, '$.k') AS BIGINT) AS seen FROM events WHERE value > 60),
         v AS (SELECT key, count(DISTINCT seen) AS votes, count(DISTINCT tag) AS diversity FROM o GROUP BY 1),
         t AS (SELECT key, tag, count(*) AS n, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, tag) AS rn FROM o GROUP BY 1, 2),
         r AS (SELECT v.key, votes, diversity, max(CASE WHEN rn = 1 THEN tag END) AS top_tag, max(CASE WHEN rn = 1 THEN n END) / votes AS agreement,
                 (max(CASE WHEN rn = 1 THEN n END) - coalesce(max(CASE WHEN rn = 2 THEN n END), 0)) / votes AS margin FROM v JOIN t ON v.key = t.key GROUP BY 1, 2, 3)
    SELECT key, top_tag, votes, diversity, round(agreement, 4) AS agreement, round(margin, 4) AS margin,
      round(CASE WHEN votes < 3 OR agreement < 0.3 OR margin < 0.05 THEN least(0.50, 0.20 + 0.10 * agreement + 0.05 * least(votes, 4)) ELSE greatest(0.0, least(0.92, 0.45 + 0.25 * agreement + 0.20 * margin + least(0.15, 0.03 * sqrt(votes)))) END, 4) AS confidence FROM r""")
def tag_confidence(spark, d):
    """Top tag of each key over distinct observations: agreement, clearance over the runner-up, confidence."""
    # fixed values of this query: floors for votes, agreement and margin; the curve's constants
    o = load(spark, d, "events").where("value > 60").select(F.col("user_id").alias("key"), F.col("event_type").alias("tag"), F.get_json_object("props", "$.k").cast("long").alias("seen")).distinct()
    n = o.groupBy("key", "tag").agg(F.count("*").alias("n"))
    top = n.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "tag"))), 1, 2).alias("top"), F.count("*").alias("diversity"))  # tags are few
    votes = o.groupBy("key").agg(F.countDistinct("seen").alias("votes"))
    best, second = -F.col("top")[0]["m"], F.coalesce(-F.get("top", F.lit(1))["m"], F.lit(0))
    r = top.join(votes, "key").select("key", F.col("top")[0]["tag"].alias("top_tag"), "votes", "diversity", (best / F.col("votes")).alias("agreement"), ((best - second) / F.col("votes")).alias("margin"))
    weak = (F.col("votes") < 3) | (F.col("agreement") < 0.3) | (F.col("margin") < 0.05)
    low = F.least(F.lit(0.50), 0.20 + 0.10 * F.col("agreement") + 0.05 * F.least("votes", F.lit(4)))
    high = F.greatest(F.lit(0.0), F.least(F.lit(0.92), 0.45 + 0.25 * F.col("agreement") + 0.20 * F.col("margin") + F.least(F.lit(0.15), 0.03 * F.sqrt("votes"))))
    return r.select("key", "top_tag", "votes", "diversity", F.round("agreement", 4).alias("agreement"), F.round("margin", 4).alias("margin"), F.round(F.when(weak, low).otherwise(high), 4).alias("confidence"))


@query("q_stage_eta", """
    WITH m AS (SELECT event_type, median(value) AS m, count(*) AS n FROM events GROUP BY 1) SELECT round(sum(m), 6) AS eta, count(*) AS stages, min(n) AS fewest FROM m""")
def stage_eta(spark, d):
    """Sum of the stages' median durations; equal values are counted before any median."""
    c = load(spark, d, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    m = c.groupBy("event_type").agg(F.expr("percentile(value, 0.5, n)").alias("m"), F.sum("n").alias("n"))
    return m.agg(F.round(F.sum("m"), 6).alias("eta"), F.count("*").alias("stages"), F.min("n").alias("fewest"))


@query("q_throughput", """
    WITH u AS (SELECT user_id, count(*) AS n, date_diff('second', min(ts), max(ts)) AS span FROM events WHERE event_type = 'click' AND value > 95 GROUP BY 1)
    SELECT user_id, n, CASE WHEN n >= 3 AND span > 0 THEN round(3600.0 * n / span, 6) END AS per_hour, CASE WHEN n >= 3 AND span > 0 THEN round(100.0 * span / n / 3600, 4) END AS eta_hours FROM u""")
def throughput(spark, d):
    """Work an hour and time for 100 more, unknown before three samples."""
    second = lambda c: F.unix_seconds(F.date_trunc("second", c).cast("timestamp"))
    u = load(spark, d, "events").where("event_type = 'click' and value > 95").groupBy("user_id").agg(F.count("*").alias("n"), (second(F.max("ts")) - second(F.min("ts"))).alias("span"))
    known = (F.col("n") >= 3) & (F.col("span") > 0)
    return u.select("user_id", "n", F.when(known, F.round(3600.0 * F.col("n") / F.col("span"), 6)).alias("per_hour"), F.when(known, F.round(100.0 * F.col("span") / F.col("n") / 3600, 4)).alias("eta_hours"))


@query("q_ledger", """
    WITH n AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS done FROM events GROUP BY 1) SELECT day, done, CAST(sum(done) OVER (ORDER BY day) AS BIGINT) AS so_far, round(sum(done) OVER (ORDER BY day) / sum(done) OVER (), 6) AS progress FROM n""")
def ledger(spark, d):
    """Progress by day: the windows see one row a day."""
    n = load(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("done"))
    so_far = F.sum("done").over(W.orderBy("day"))
    return n.select("day", "done", so_far.alias("so_far"), F.round(so_far / F.sum("done").over(W.partitionBy()), 6).alias("progress"))


@query("q_context_usage", "SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS used, round(sum(length(text)) / 2000.0, 6) AS share, sum(length(text)) > 2000 AS over_ FROM conversations GROUP BY 1")
def context_usage(spark, d):
    c = load(spark, d, "conversations").groupBy("conv_id").agg(F.sum(F.length("text")).alias("used"))
    return c.select("conv_id", "used", F.round(F.col("used") / 2000.0, 6).alias("share"), (F.col("used") > 2000).alias("over_"))


@query("q_coverage_ratio", """
    WITH a AS (SELECT user_id, count(DISTINCT event_type) AS areas, count(DISTINCT CASE WHEN value > 90 THEN event_type END) AS covered FROM events WHERE value > 30 GROUP BY 1),
         u AS (SELECT c_custkey FROM customer)
    SELECT c_custkey, CASE WHEN coalesce(areas, 0) = 0 THEN 1.0 ELSE round(covered / areas, 6) END AS ratio FROM u LEFT JOIN a ON c_custkey = user_id""")
def coverage_ratio(spark, d):
    """Covered areas over planned ones; nothing planned counts as covered."""
    e = load(spark, d, "events").where("value > 30").groupBy("user_id", "event_type").agg(F.max(F.col("value") > 90).alias("hit"))
    a = e.groupBy("user_id").agg(F.count("*").alias("areas"), F.count_if("hit").alias("covered"))
    j = load(spark, d, "customer").select("c_custkey").join(a, F.col("c_custkey") == F.col("user_id"), "left")
    return j.select("c_custkey", F.when(F.coalesce("areas", F.lit(0)) == 0, 1.0).otherwise(F.round(F.col("covered") / F.col("areas"), 6)).alias("ratio"))


@query("q_extraction_counts", "SELECT count(*) AS n, count_if(contains(html, '<title>')) AS titled, count_if(contains(html, '<table')) AS tables, count_if(regexp_matches(html, '<!--')) AS commented, round(avg(length(html)), 4) AS mean_length FROM pages")
def extraction_counts(spark, d):
    has = lambda t: F.count_if(F.contains("html", F.lit(t)))
    return load(spark, d, "pages").agg(F.count("*").alias("n"), has("<title>").alias("titled"), has("<table").alias("tables"), has("<!--").alias("commented"), F.round(F.avg(F.length("html")), 4).alias("mean_length"))


@query("q_embedding_sweep", f"""
    WITH s AS (SELECT a.label, {COSINE} AS x FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b)
    SELECT label, round(min(x), 6) AS low, round(avg(x), 6) AS mean, round(median(x), 6) AS median, round(stddev_pop(x), 6) AS std, round(max(x), 6) AS high FROM s GROUP BY 1""")
def embedding_sweep(spark, d):
    """Similarity to one vector by model: low, mean, median, deviation, high."""
    e = load(spark, d, "embeddings")
    q = F.broadcast(e.where("vec_id = 0").limit(1).select(F.col("embedding").alias("q")))
    x = e.crossJoin(q).select("label", cosine(F.col("embedding"), F.col("q")).alias("x"))
    r = lambda f: F.round(f, 6)
    return x.groupBy("label").agg(r(F.min("x")).alias("low"), r(F.avg("x")).alias("mean"), r(F.median("x")).alias("median"), r(F.stddev_pop("x")).alias("std"), r(F.max("x")).alias("high"))


@query("q_cache_hits", "SELECT user_id, count(*) AS calls, count(*) - count(DISTINCT props) AS hits, round((count(*) - count(DISTINCT props)) / count(*), 6) AS rate FROM events GROUP BY 1")
def cache_hits(spark, d):
    """Calls that repeat an earlier one of the same user are hits."""
    k = load(spark, d, "events").groupBy("user_id", "props").agg(F.count("*").alias("n"))
    c = k.groupBy("user_id").agg(F.sum("n").alias("calls"), (F.sum("n") - F.count("*")).alias("hits"))
    return c.withColumn("rate", F.round(F.col("hits") / F.col("calls"), 6))


@query("q_tool_breakdown", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1")
def tool_breakdown(spark, d):
    n = load(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("k")).groupBy("event_type").agg(F.sum("k").alias("n"), F.count("*").alias("users"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


@query("q_session_tools", "SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS calls, count(DISTINCT event_type) AS tools FROM events GROUP BY 1, 2")
def session_tools(spark, d):
    return load(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("calls"), F.countDistinct("event_type").alias("tools"))


@query("q_nested_usage", """
    WITH s AS (SELECT user_id, list({'tool': event_type, 'value': value}) AS calls FROM events GROUP BY 1), x AS (SELECT user_id, unnest(calls) AS c FROM s) SELECT c.tool AS tool, count(*) AS n, count(DISTINCT user_id) AS sessions, round(max(c.value), 4) AS most FROM x GROUP BY 1""")
def nested_usage(spark, d):
    """Calls inside session documents, exploded and counted."""
    s = load(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.struct(F.col("event_type").alias("tool"), "value")).alias("calls"))
    x = s.select("user_id", F.explode("calls").alias("c"))
    return x.groupBy(F.col("c.tool").alias("tool")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("sessions"), F.round(F.max("c.value"), 4).alias("most"))


@query("q_first_occurrence", """
    WITH f AS (SELECT user_id, props, min(event_id) AS original FROM events GROUP BY 1, 2) SELECT event_id, original FROM events JOIN f USING (user_id, props) WHERE event_id <> original""")
def first_occurrence(spark, d):
    """Repeated calls and the step that they repeat."""
    e = load(spark, d, "events").select("event_id", "user_id", "props")
    f = e.groupBy("user_id", "props").agg(F.min("event_id").alias("original"))
    return e.join(f, ["user_id", "props"]).where("event_id <> original").select("event_id", "original")


@query("q_prune", "SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3 THEN text ELSE '[pruned ' || length(text) || ' chars]' END AS body FROM conversations")
def prune(spark, d):
    """All but the last three results are replaced by a note of their length."""
    rn = F.row_number().over(W.partitionBy("conv_id").orderBy(F.desc("turn")))
    c = load(spark, d, "conversations").select("conv_id", "turn", "text", rn.alias("rn"))
    return c.select("conv_id", "turn", F.when(F.col("rn") <= 3, F.col("text")).otherwise(F.concat(F.lit("[pruned "), F.length("text").cast("string"), F.lit(" chars]"))).alias("body"))


LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"


@query("q_sections", f"""
    WITH {LINES}, h AS (SELECT *, last_value(CASE WHEN length(line) BETWEEN 1 AND 60 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS heading FROM l)
    SELECT doc_id, heading, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM h WHERE heading IS NOT NULL GROUP BY 1, 2""")
def sections(spark, d):
    """Short lines are headings that hold until the next; chunks by heading. A window sees one document."""
    x = load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    heading = F.last(F.when(F.length("line").between(1, 60), F.col("line")), ignorenulls=True).over(W.partitionBy("doc_id").orderBy("i"))
    return x.withColumn("heading", heading).where("heading is not null").groupBy("doc_id", "heading").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("q_target_rank", f"""
    WITH s AS (SELECT a.vec_id, a.label, round({COSINE}, 9) AS x FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b), t AS (SELECT label, min(vec_id) AS target FROM embeddings GROUP BY 1)
    SELECT t.label, target, 1 + count(r.vec_id) AS rank FROM t JOIN s ON s.vec_id = target LEFT JOIN s r ON r.x > s.x GROUP BY 1, 2""")
def target_rank(spark, d):
    """Ranks of a few targets in the order of similarity: all rows are counted against them, none is sorted."""
    e = load(spark, d, "embeddings")
    q = F.broadcast(e.where("vec_id = 0").limit(1).select(F.col("embedding").alias("q")))
    x = e.crossJoin(q).select("vec_id", "label", F.round(cosine(F.col("embedding"), F.col("q")), 9).alias("x"))
    targets = x.groupBy("label").agg(F.min_by(F.struct("vec_id", "x"), "vec_id").alias("t"))
    marks = targets.agg(F.array_sort(F.collect_list("t.x")).alias("marks"))  # one number per label
    above = x.crossJoin(F.broadcast(marks)).select(F.explode(F.filter("marks", lambda m: m < F.col("x"))).alias("m")).groupBy("m").agg(F.count("*").alias("n"))
    j = targets.select("label", F.col("t.vec_id").alias("target"), F.col("t.x").alias("x")).join(above, F.col("x") == F.col("m"), "left")
    return j.groupBy("label", "target").agg((1 + F.coalesce(F.max(F.col("n") / F.lit(1)), F.lit(0))).cast("long").alias("rank"))


@query("q_exempt_loop", """
    SELECT event_id, n FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events WHERE event_type NOT IN ('view', 'click')) WHERE n = 3""")
def exempt_loop(spark, d):
    """The third identical call of a user; read-only tools are exempt."""
    w = W.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    e = load(spark, d, "events").where(~F.col("event_type").isin("view", "click"))
    return e.select("event_id", F.row_number().over(w).cast("long").alias("n")).where("n = 3")


@query("q_concat_budget", """
    WITH c AS (SELECT conv_id, turn, text, sum(length(text) // 4) OVER (PARTITION BY conv_id ORDER BY turn) - length(text) // 4 AS before FROM conversations WHERE role <> 'system')
    SELECT conv_id, string_agg(CASE WHEN before = 0 THEN substr(text, 1, 240) ELSE text END, chr(10) ORDER BY turn) AS body FROM c WHERE before + length(text) // 4 <= 60 OR before = 0 GROUP BY 1""")
def concat_budget(spark, d):
    """Texts joined while their tokens last; the first is cut to the budget."""
    n = token_estimate(F.col("text"))
    c = load(spark, d, "conversations").where("role <> 'system'").withColumn("n", n).withColumn("before", F.sum("n").over(W.partitionBy("conv_id").orderBy("turn")) - F.col("n"))
    kept = c.where((F.col("before") + F.col("n") <= 60) | (F.col("before") == 0)).select("conv_id", F.struct("turn", F.when(F.col("before") == 0, F.substring("text", 1, 240)).otherwise(F.col("text")).alias("t")).alias("x"))
    return kept.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("body"))


@query("q_significance", """
    SELECT p_type, p_brand, count(*) AS mentions, CASE WHEN count(*) >= 30 THEN 2 WHEN count(*) >= 15 THEN 1 ELSE 0 END AS significance FROM part GROUP BY 1, 2 ORDER BY significance DESC, mentions DESC, p_type, p_brand LIMIT 20""")
def significance(spark, d):
    n = load(spark, d, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("mentions"))
    return n.withColumn("significance", F.when(F.col("mentions") >= 30, 2).when(F.col("mentions") >= 15, 1).otherwise(0)).orderBy(F.desc("significance"), F.desc("mentions"), "p_type", "p_brand").limit(20)


@query("q_source_ranking", """
    SELECT doc_id, (length(text) - length(replace(text, 'the', ''))) // 3 AS score FROM documents ORDER BY score DESC, length(text), doc_id LIMIT 30""")
def source_ranking(spark, d):
    """Score descending, of equal scores the shorter text, then the key."""
    score = ((F.length("text") - F.length(F.replace(F.col("text"), F.lit("the"), F.lit("")))) / 3).cast("long")
    return load(spark, d, "documents").select("doc_id", score.alias("score"), F.length("text").alias("n")).orderBy(F.desc("score"), "n", "doc_id").limit(30).select("doc_id", "score")


@query("q_unit_order", """
    SELECT o_orderkey, o_orderpriority, coalesce(deps, 0) AS deps FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS deps FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey ORDER BY o_orderpriority, deps, o_orderkey LIMIT 50""")
def unit_order(spark, d):
    deps = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_partkey").alias("deps"))
    j = load(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(deps, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", "o_orderpriority", F.coalesce("deps", F.lit(0)).alias("deps")).orderBy("o_orderpriority", "deps", "o_orderkey").limit(50)


@query("q_top_bottom", """
    (SELECT 'top' AS side, p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10) UNION ALL (SELECT 'bottom', p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 10)""")
def top_bottom(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_retailprice")
    side = lambda name, order: p.orderBy(order, "p_partkey").limit(10).select(F.lit(name).alias("side"), "p_partkey", "p_retailprice")
    return side("top", F.desc("p_retailprice")).union(side("bottom", F.asc("p_retailprice")))


@query("q_context_priority", """
    SELECT conv_id, turn, CASE WHEN contains(lower(text), 'then') THEN 2 ELSE 0 END + CASE WHEN contains(lower(text), 'tion') THEN 2 ELSE 0 END + CASE role WHEN 'assistant' THEN 5 WHEN 'user' THEN 2 ELSE -1 END
      - CASE WHEN contains(substr(lower(text), 1, 200), 'err') THEN 3 ELSE 0 END AS score FROM conversations""")
def context_priority(spark, d):
    """Goal words of over three letters, the tool's kind, and a penalty for an error near the start."""
    low = F.lower("text")
    goal = sum((F.when(F.contains(low, F.lit(w)), 2).otherwise(0) for w in ("the", "then", "tion") if len(w) > 3), F.lit(0))
    kind = F.when(F.col("role") == "assistant", 5).when(F.col("role") == "user", 2).otherwise(-1)
    return load(spark, d, "conversations").select("conv_id", "turn", (goal + kind - F.when(F.contains(F.substring(low, 1, 200), F.lit("err")), 3).otherwise(0)).alias("score"))


@query("q_largest_session", """
    WITH s AS (SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, arg_max(day, (n, day)) AS day, max(n) AS n FROM s GROUP BY 1""")
def largest_session(spark, d):
    s = load(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return s.groupBy("user_id").agg(F.max_by("day", F.struct("n", "day")).alias("day"), F.max("n").alias("n"))


@query("q_lead_dedup", "SELECT o_custkey, o_orderstatus, o_orderpriority, min(o_orderkey) AS lead, count(*) AS n FROM orders GROUP BY 1, 2, 3")
def lead_dedup(spark, d):
    """Leads with one signature are one lead, the first."""
    return load(spark, d, "orders").groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(F.min("o_orderkey").alias("lead"), F.count("*").alias("n"))


@query("q_distinct_calls", """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS n, min(l_partkey) AS first_call, sha256(string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR))) AS digest FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1""")
def distinct_calls(spark, d):
    """Calls of a function, sorted, itself left out."""
    p = load(spark, d, "lineitem").where("l_partkey <> l_suppkey").select("l_suppkey", "l_partkey").distinct()
    names = F.array_join(F.array_sort(F.collect_list(F.col("l_partkey").cast("string"))), ",")
    return p.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.min("l_partkey").alias("first_call"), F.sha2(names.cast("binary"), 256).alias("digest"))


@query("q_priority_budget", """
    WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) SELECT conv_id, turn, CAST(floor(6000 // n * CASE role WHEN 'system' THEN 2.0 WHEN 'assistant' THEN 1.5 ELSE 1.0 END) AS BIGINT) AS budget FROM conversations JOIN n USING (conv_id)""")
def priority_budget(spark, d):
    """What is left shared evenly, times the priority's multiplier."""
    c = load(spark, d, "conversations").select("conv_id", "turn", "role")
    n = c.groupBy("conv_id").agg(F.count("*").alias("n"))
    times = F.when(F.col("role") == "system", 2.0).when(F.col("role") == "assistant", 1.5).otherwise(1.0)
    return c.join(n, "conv_id").select("conv_id", "turn", F.floor(F.floor(F.lit(6000) / F.col("n")) * times).alias("budget"))


@query("q_l2_normalised", """
    SELECT vec_id, i - 1 AS i, round(embedding[i] / norm, 6) AS x FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def l2_normalised(spark, d):
    from lodestone.functions import norm

    e = load(spark, d, "embeddings").select("vec_id", norm(F.col("embedding")).alias("n"), F.posexplode("embedding").alias("i", "x"))
    return e.select("vec_id", F.col("i").cast("long").alias("i"), F.round(F.col("x") / F.col("n"), 6).alias("x"))


@query("q_ordered_rules", r"""
    WITH r(rule, rx, severity, conf) AS (VALUES ('mail', '@', 2, 0.6), ('secret', 'token *=', 1, 0.9), ('key', '[0-9a-f]{32}', 1, 0.7), ('licence', '(?i)licen[sc]ed', 4, 0.5))
    SELECT rule, severity, conf, count(*) AS n FROM documents, r WHERE severity <= 3 AND regexp_matches(text, rx) GROUP BY ALL ORDER BY severity, conf DESC""")
def ordered_rules(spark, d):
    """All rules up to a severity, worst and surest first; the rules are columns of one scan."""
    rules = [("mail", "@", 2, 0.6), ("secret", "token *=", 1, 0.9), ("key", "[0-9a-f]{32}", 1, 0.7), ("licence", "(?i)licen[sc]ed", 4, 0.5)]
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(x), F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"), F.lit(c).alias("conf"))) for n, x, s, c in rules if s <= 3]))
    return load(spark, d, "documents").select(F.explode(hits).alias("h")).groupBy("h.rule", "h.severity", "h.conf").agg(F.count("*").alias("n")).orderBy("severity", F.desc("conf"))
