"""Listings: tables of pointers in bytes, windows of lines around hits, excerpts by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def little_endian(data: Column, at: Column, size: int = 8) -> Column:
    """Unsigned little-endian word at a byte offset, as a long (words over 2**63 - 1 give null)."""
    part = F.hex(F.substring(data, at + 1, F.lit(size)))
    digits = F.concat(*[F.substring(part, 2 * k + 1, 2) for k in reversed(range(size))])
    return F.conv(digits, 16, 10).try_cast("long")


def pointer_tables(segments: DataFrame, keys: list[str], functions: DataFrame, least: int = 3, size: int = 8) -> DataFrame:
    """keys, table_address, entry_count, entries: runs of at least so many words that are addresses of functions.

    segments: keys, base (address of the first byte), data (binary). functions: addr, name, one row per addr.
    Only the words that are addresses are sorted, and runs are found by their distance from their rank.
    """
    at = F.sequence(F.lit(0), (F.octet_length("data") / size).cast("int") - 1)
    words = segments.where(F.octet_length("data") >= size).select(*keys, "base", "data", F.explode(at).alias("i"))
    words = words.select(*keys, "base", "i", little_endian(F.col("data"), F.col("i") * size, size).alias("pointer"))
    valid = words.join(functions, F.col("pointer") == F.col("addr"))
    run = F.col("i") - F.row_number().over(W.partitionBy(*keys).orderBy("i"))
    tables = valid.withColumn("run", run).groupBy(*keys, "run").agg(F.min(F.col("base") + F.col("i") * size).alias("table_address"), F.count(F.lit(1)).alias("entry_count"), F.array_sort(F.collect_list(F.struct("i", "pointer", "name"))).alias("entries"))
    return tables.where(F.col("entry_count") >= least).drop("run")


def line_hits(text: Column, needles: list[str]) -> Column:
    """Lines of a text as structs (i, score): how many of the needles each contains, in either case."""
    found = lambda x: sum((F.contains(F.lower(x), F.lit(n.lower())).cast("int") for n in needles), F.lit(0))
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), found(x).alias("score")))


def merged_windows(text: Column, needles: list[str], radius: int) -> Column:
    """Ranges (lo, hi) of lines around hits, hi exclusive; ranges that overlap or touch are one."""
    n = F.size(F.split(text, "\n"))
    windows = F.transform(F.filter(line_hits(text, needles), lambda x: x["score"] > 0), lambda x: F.struct(F.greatest(F.lit(0), x["i"] - radius).alias("lo"), F.least(n, x["i"] + radius + 1).alias("hi")))

    def add(done: Column, w: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], w["hi"]).alias("hi"))))
        return F.when((F.size(done) > 0) & (w["lo"] <= F.try_element_at(done, F.lit(-1))["hi"]), joined).otherwise(F.concat(done, F.array(w)))

    return F.aggregate(windows, F.array().cast("array<struct<lo:int,hi:int>>"), add)


def best_excerpts(text: Column, needles: list[str], half: int) -> Column:
    """Ranges (lo, hi) of lines in order: windows around the best lines first, those that overlap a chosen one are left out."""
    n = F.size(F.split(text, "\n"))
    hits = F.filter(line_hits(text, needles), lambda x: x["score"] > 0)
    ranked = F.array_sort(F.transform(hits, lambda x: F.struct((-x["score"]).alias("s"), x["i"].alias("i"))))
    windows = F.transform(ranked, lambda x: F.struct(F.greatest(F.lit(0), x["i"] - half).alias("lo"), F.least(n, x["i"] + half).alias("hi")))

    def add(done: Column, w: Column) -> Column:
        return F.when(F.exists(done, lambda x: (w["lo"] < x["hi"]) & (w["hi"] > x["lo"])), done).otherwise(F.concat(done, F.array(w)))

    return F.array_sort(F.aggregate(windows, F.array().cast("array<struct<lo:int,hi:int>>"), add))


def commands(text: Column) -> Column:
    """Distinct commands of a model's answer, as written after EXECUTE: name(key="value", ...)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"EXECUTE:\s*(\w+\([^()]*\))"), F.lit(1)))


def command_name(command: Column) -> Column:
    return F.regexp_extract(command, r"^(\w+)\(", 1)


def command_arguments(command: Column) -> Column:
    """Map of the quoted arguments; of a repeated key the last one wins."""
    key, value = (F.regexp_extract_all(command, F.lit(r'(\w+)\s*=\s*"([^"]*)"'), F.lit(i)) for i in (1, 2))
    pairs = F.arrays_zip(key.alias("key"), value.alias("value"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def diff_statistics(text: Column) -> Column:
    """Struct of files, hunks, added and removed of a unified diff."""
    lines = F.split(text, "\n")
    count = lambda rule: F.size(F.filter(lines, rule)).cast("long")
    starts = lambda x, s: F.startswith(x, F.lit(s))
    return F.struct(
        count(lambda x: starts(x, "+++ ")).alias("files"),
        count(lambda x: starts(x, "@@ ")).alias("hunks"),
        count(lambda x: starts(x, "+") & ~starts(x, "+++ ")).alias("added"),
        count(lambda x: starts(x, "-") & ~starts(x, "--- ")).alias("removed"),
    )
