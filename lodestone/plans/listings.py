"""Pointer tables, line windows, excerpts, commands and diffs."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import listings
from lodestone.sources import load


@query("q_pointer_tables", """
    WITH w AS (SELECT l_suppkey, l_orderkey // 1000 AS block, l_partkey, row_number() OVER (PARTITION BY l_suppkey, l_orderkey // 1000 ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS i FROM lineitem),
         v AS (SELECT w.*, i - row_number() OVER (PARTITION BY l_suppkey, block ORDER BY i) AS run FROM w JOIN part ON l_partkey = p_partkey WHERE p_size > 10)
    SELECT l_suppkey, block, 4096 + 8 * min(i) AS table_address, count(*) AS entry_count, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY i) AS pointers FROM v GROUP BY l_suppkey, block, run HAVING count(*) >= 3""")
def pointer_tables(spark, d):
    """Supplied parts written as little-endian words, a segment per supplier and thousand orders, then scanned."""
    digits = F.lpad(F.hex("l_partkey"), 16, "0")
    word = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8))])
    cells = load(spark, d, "lineitem").select("l_suppkey", F.floor(F.col("l_orderkey") / 1000).alias("block"), F.struct("l_orderkey", "l_linenumber", "l_partkey", word.alias("w")).alias("x"))
    data = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["w"]), ""))
    segments = cells.groupBy("l_suppkey", "block").agg(data.alias("data")).withColumn("base", F.lit(4096).cast("long"))
    functions = load(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("addr"), F.col("p_name").alias("name"))
    out = listings.pointer_tables(segments, ["l_suppkey", "block"], functions)
    return out.select("l_suppkey", "block", "table_address", "entry_count", F.array_join(F.transform("entries", lambda x: x["pointer"].cast("string")), ",").alias("pointers"))


@query("q_merged_windows", r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
         h AS (SELECT doc_id, greatest(0, i - 2) AS lo, least(n, i + 3) AS hi FROM l JOIN (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents) USING (doc_id) WHERE contains(lower(line), 'the') OR contains(lower(line), 'ch')),
         m AS (SELECT *, max(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h),
         g AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM m)
    SELECT doc_id, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY doc_id, g""")
def merged_windows(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.explode(listings.merged_windows(F.col("text"), ["the", "ch"], 2)).alias("w"))
    return docs.select("doc_id", F.col("w.lo").cast("long").alias("lo"), F.col("w.hi").cast("long").alias("hi"))


@query("q_excerpts")
def excerpts(spark, d):
    """Greedy choice by score; no SQL, held against a plain loop by the tests."""
    docs = load(spark, d, "documents").select("doc_id", F.explode(listings.best_excerpts(F.col("text"), ["the", "ch", "que"], 2)).alias("w"))
    return docs.select("doc_id", F.col("w.lo").cast("long").alias("lo"), F.col("w.hi").cast("long").alias("hi"))


@query("q_commands", """
    SELECT event_id, event_type AS name, CAST(user_id AS VARCHAR) AS user_arg, json_extract_string(props, '$.k') AS k_arg FROM events""")
def commands(spark, d):
    """Every event written as a command twice over, then parsed: repeats count once."""
    e = load(spark, d, "events")
    call = F.format_string('EXECUTE: %s(user="%s", k="%s")', "event_type", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"))
    found = e.select("event_id", F.explode(listings.commands(F.concat_ws("\n", F.lit("Plan:"), call, call))).alias("c"))
    a = listings.command_arguments(F.col("c"))
    return found.select("event_id", listings.command_name(F.col("c")).alias("name"), a["user"].alias("user_arg"), a["k"].alias("k_arg"))


@query("q_diff_statistics", r"""
    SELECT conv_id, count(*) AS files, count(*) AS hunks, sum(CASE WHEN role = 'user' THEN 0 ELSE len(string_split(text, chr(10))) END)::BIGINT AS added, sum(CASE WHEN role = 'user' THEN len(string_split(text, chr(10))) ELSE 0 END)::BIGINT AS removed
    FROM conversations GROUP BY conv_id""")
def diff_statistics(spark, d):
    """Each turn as a one-hunk diff: user lines removed, other lines added; statistics summed by conversation."""
    sign = F.when(F.col("role") == "user", "-").otherwise("+")
    body = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(sign, x)), "\n")
    diff = F.concat_ws("\n", F.lit("--- a/turn"), F.lit("+++ b/turn"), F.lit("@@ -1 +1 @@"), body)
    s = load(spark, d, "conversations").select("conv_id", listings.diff_statistics(diff).alias("s"))
    return s.groupBy("conv_id").agg(*[F.sum(f"s.{x}").alias(x) for x in ("files", "hunks", "added", "removed")])
