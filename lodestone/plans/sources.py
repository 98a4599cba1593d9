"""Queries over source files that Spark writes from a table, several to a folder."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import source_code
from lodestone.sources import load, shared_folder

LINE = '  if (size > 1) { name = "}{"; }'


@query("q_source_functions", f"""
    WITH p AS (SELECT p_partkey AS k, replace(p_brand, '#', '') || '-' || (p_partkey // 1000) AS file, p_size % 4 AS m, p_name FROM part)
    SELECT file, 'part_' || k AS function_name, 2 + coalesce(sum(4 + m) OVER (PARTITION BY file ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS line_number,
           'int part_' || k || '(int size, const char *name)' AS signature, 'Part ' || p_name AS docstring, 1 + m AS complexity, 2 + m * {len(LINE) + 1} + length('  return size; // }}') + 2 AS body_length FROM p""")
def source_functions(spark, d):
    """A C function for each part, a file for each brand and thousand parts; then the functions that a scan of the files finds."""
    p = load(spark, d, "part").withColumn("file", F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("-"), F.floor(F.col("p_partkey") / 1000)))
    head = F.concat(F.lit("/** Part "), "p_name", F.lit(" */\nstatic int part_"), "p_partkey", F.lit("(int size, const char *name) {\n"))
    text = F.concat(head, F.repeat(F.lit(f"{LINE}\n"), F.col("p_size") % 4), F.lit("  return size; // }\n}"))
    folder = shared_folder(spark, "sources")
    p.select("file", "p_partkey", text.alias("value")).repartition("file").sortWithinPartitions("file", "p_partkey").drop("p_partkey").write.partitionBy("file").text(folder)
    found = source_code.scanned(source_code.read_sources(spark, folder))
    return found.select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("file"), "function_name", "line_number", "signature", "docstring", "complexity", F.length("body").alias("body_length"))
