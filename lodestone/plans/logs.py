"""Windows and correlations over tool logs and conversations."""

import hashlib
import tempfile

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import token_estimate
from lodestone.operators import retrieval
from lodestone.sources import load
from lodestone.streaming import drain, first_seen


@query("q_latest_wins", "SELECT user_id, arg_max(event_id, (ts, -event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def latest_wins(spark, d):
    """The latest record of each key, ties by the smallest id: an aggregate, no sort."""
    e = load(spark, d, "events")
    return e.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", (-F.col("event_id")).alias("i"))).alias("event_id"), F.max("ts").alias("ts"))


@query("q_doom_loop", """
    SELECT event_id, user_id, event_type, n FROM (SELECT *, count(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events) WHERE n >= 3""")
def doom_loop(spark, d):
    w = W.partitionBy("user_id", "event_type").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, 0)
    return load(spark, d, "events").select("event_id", "user_id", "event_type", F.count(F.lit(1)).over(w).alias("n")).where("n >= 3")


@query("q_recent_duplicate", """
    SELECT event_id FROM (SELECT event_id, event_type, list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS seen FROM events) WHERE list_contains(seen, event_type)""")
def recent_duplicate(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-10, -1)
    return load(spark, d, "events").withColumn("seen", F.collect_list("event_type").over(w)).where(F.array_contains("seen", F.col("event_type"))).select("event_id")


@query("q_islands", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM events)
    SELECT user_id, event_type, min(event_id) AS first_event, count(*) AS n FROM r GROUP BY user_id, event_type, g HAVING count(*) >= 3""")
def islands(spark, d):
    order = ["ts", "event_id"]
    g = F.row_number().over(W.partitionBy("user_id").orderBy(*order)) - F.row_number().over(W.partitionBy("user_id", "event_type").orderBy(*order))
    r = load(spark, d, "events").withColumn("g", g)
    return r.groupBy("user_id", "event_type", "g").agg(F.min("event_id").alias("first_event"), F.count(F.lit(1)).alias("n")).where("n >= 3").drop("g")


@query("q_tiering", """
    SELECT conv_id, turn, CASE WHEN last - turn = 0 THEN 'full' WHEN last - turn = 1 THEN 'bullets' ELSE 'reference' END AS tier FROM (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)""")
def tiering(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", (F.max("turn").over(W.partitionBy("conv_id")) - F.col("turn")).alias("age"))
    return c.select("conv_id", "turn", F.when(F.col("age") == 0, "full").when(F.col("age") == 1, "bullets").otherwise("reference").alias("tier"))


@query("q_budget_prefix", """
    SELECT conv_id, turn, used FROM (SELECT conv_id, turn, sum(length(text) // 4) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS used FROM conversations) WHERE used <= 300""")
def budget_prefix(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", token_estimate(F.col("text")).alias("n"))
    return retrieval.budget_fill(c, [F.desc("turn")], "n", 300, ["conv_id"]).select("conv_id", "turn", "used")


@query("q_budget_skip")
def budget_skip(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", token_estimate(F.col("text")).alias("n"))
    return retrieval.budget_fill_skipping(c, "conv_id", ["turn"], "n", 300)


@query("q_evict", """
    SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE rn <= n // 5""")
def evict(spark, d):
    """The lowest fifth of each user's entries."""
    w = W.partitionBy("user_id")
    e = load(spark, d, "events").select("event_id", F.row_number().over(w.orderBy("value", "ts", "event_id")).alias("rn"), F.count(F.lit(1)).over(w).alias("n"))
    return e.where("rn <= floor(n / 5)").select("event_id")


@query("q_correlation", r"""
    WITH t AS (SELECT 'documents' AS tool, unnest(regexp_extract_all(text, '[0-9]{2,}')) AS x FROM documents UNION ALL SELECT 'conversations', unnest(regexp_extract_all(text, '[0-9]{2,}')) FROM conversations UNION ALL SELECT 'pages', unnest(regexp_extract_all(html, '[0-9]{2,}')) FROM pages)
    SELECT x, count(DISTINCT tool) AS tools, count(*) AS n, CASE WHEN count(DISTINCT tool) >= 3 THEN 'HIGH' ELSE 'MEDIUM' END AS significance FROM t GROUP BY 1 HAVING count(DISTINCT tool) >= 2""")
def correlation(spark, d):
    """Values that more than one tool reports; counted by tool first, so a hot value is one row per task."""
    parts = [load(spark, d, n).select(F.lit(n).alias("tool"), F.explode(F.regexp_extract_all(c, F.lit("[0-9]{2,}"), F.lit(0))).alias("x")) for n, c in (("documents", "text"), ("conversations", "text"), ("pages", "html"))]
    by = parts[0].union(parts[1]).union(parts[2]).groupBy("x", "tool").agg(F.count(F.lit(1)).alias("k"))
    out = by.groupBy("x").agg(F.count(F.lit(1)).alias("tools"), F.sum("k").alias("n")).where("tools >= 2")
    return out.withColumn("significance", F.when(F.col("tools") >= 3, "HIGH").otherwise("MEDIUM"))


@query("q_coverage", """
    WITH a(area) AS (VALUES ('click'), ('error'), ('view'), ('export')), h AS (SELECT event_type, min(event_id) AS first_event FROM events GROUP BY 1)
    SELECT area, first_event, first_event IS NOT NULL AS covered FROM a LEFT JOIN h ON area = event_type""")
def coverage(spark, d):
    areas = spark.createDataFrame([("click",), ("error",), ("view",), ("export",)], "area string")
    hits = load(spark, d, "events").groupBy("event_type").agg(F.min("event_id").alias("first_event"))
    return areas.join(hits, F.col("area") == F.col("event_type"), "left").select("area", "first_event", F.col("first_event").isNotNull().alias("covered"))


@query("q_tool_usage", """
    WITH m AS (SELECT max(ts) AS now FROM events) SELECT event_type, count(*) AS n, count_if(ts > now - INTERVAL 24 HOUR) AS last_day, count_if(ts > now - INTERVAL 7 DAY) AS last_week FROM events, m GROUP BY 1""")
def tool_usage(spark, d):
    e = load(spark, d, "events")
    e = e.crossJoin(e.agg(F.max("ts").alias("now")))
    since = lambda x: F.count_if(F.col("ts") > F.col("now") - F.expr(f"interval {x}"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), since("24 hours").alias("last_day"), since("7 days").alias("last_week"))


@query("q_json_props", "SELECT event_type, count(k) AS n, min(k) AS low, max(k) AS high, round(avg(k), 6) AS mean FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1")
def json_props(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return load(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.round(F.avg("k"), 6).alias("mean"))


@query("q_trace_divergence", """
    WITH t AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
    SELECT a.user_id, min(a.i) AS frame FROM t a JOIN t b ON b.user_id = a.user_id + 1 AND a.i = b.i WHERE abs(a.value - b.value) > 50 GROUP BY 1""")
def trace_divergence(spark, d):
    """First frame at which a user's trace and the next user's differ by more than the tolerance."""
    t = load(spark, d, "events").select("user_id", "value", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("i"))
    b = t.select((F.col("user_id") - 1).alias("user_id"), "i", F.col("value").alias("other"))
    return t.join(b, ["user_id", "i"]).where("abs(value - other) > 50").groupBy("user_id").agg(F.min("i").alias("frame"))


@query("q_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    """A stream over the events that lets each fingerprint through once, drained into a table."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        base = f"file://{tempfile.mkdtemp(prefix='lodestone-stream-')}"
    folder = f"{base.rstrip('/')}/stream-{hashlib.sha256(d.encode()).hexdigest()[:12]}"  # the same table goes on where a run stopped
    table = load(spark, d, "events")
    source = spark.readStream.schema(table.schema)
    # a stream reads folders: a table of one file is picked out of its folder by name
    one_file = any(f.rstrip("/").endswith("/events.parquet") for f in table.inputFiles())
    stream = source.option("pathGlobFilter", "events.parquet").parquet(d) if one_file else source.parquet(f"{d}/events.parquet")
    return drain(first_seen(stream.select("user_id", "event_type"), ["user_id", "event_type"]), f"{folder}/out", f"{folder}/state")
