"""Mixing sources to target weights by pivotal dependent rounding.

Every document has a copy rate, its source's target over its source's size.  The whole part of the
rate is taken at once.  The fractional parts are rounded together: two documents meet, words move at
random from one to the other (the sum of size x fraction stays the same and so does each expected
value) until one of the fractions is 0 or 1, and the other one goes on to meet the next.  Documents
of a source are dealt to leaves of about ``fan_in`` rows; each node of a tree leaves one residual,
``fan_in`` residuals meet in the next node, and a coin decides the residual of a root.  The largest eighth
of a source's documents is rounded first, then the next eighth, the next quarter and the smaller half:
what one class misses by changes the rate of those after it, up to ``cap`` copies of a document, and the
coin is not tossed where they could not make up for one of its sides.  So the words taken from a source are
within about one small document of its target, no node ever holds more than a few hundred rows, and
a source with a third of all rows merely has more leaves.

All randomness is a hash of the seed and the ids that meet, so reruns agree.

Nulls and ties: a null text has size 0; a null source is a source of its own, ordered last; documents
of size 0 take no words (their copies follow the same rate by a coin each); repeated rows are rows
like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import WHITE, checkpointed, whole_text, words_by

ROW = ["id", "th", "ord", "size"]
RES = "struct<id:bigint,th:bigint,ord:bigint,size:bigint,whole:bigint,p:double>"
#: Classes of documents by falling size: the first ends at 1/8 of a source's documents, the next at 1/4 and 1/2.
SHARES = (8, 4, 2)
OUT = "array<struct<id:bigint,th:bigint,ord:bigint,size:bigint,copies:bigint>>"


def word_count(text: Column) -> Column:
    return F.size(words_by(text, WHITE)).cast("long")


def coin(*parts: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def source_targets(sources: DataFrame, weights: list[float], cap: float) -> DataFrame:
    """source, source_size, n, target from source, source_size, n: one row per source.

    The level L solves sum(min(cap * size, L * weight)) = sum(size); it is what repeated resharing of
    the excess by weight ends at.  The windows see one narrow row per source.
    """
    ranked = sources.withColumn("i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(cap))
    ranked = ranked.withColumns({"w": w, "full": full}).withColumn("r", F.col("full") / F.col("w"))
    order = W.orderBy("r", "i")
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    ranked = ranked.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0)),
        "wleft": F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)),
    }).withColumn("level", F.col("left") / F.col("wleft"))
    fits = F.when(F.col("level") <= F.col("r"), F.col("level"))
    level = F.min_by(fits, F.when(fits.isNotNull(), F.struct("r", "i"))).over(whole)
    return ranked.withColumn("target", F.least("full", F.coalesce(level * F.col("w"), F.col("full")))).select(
        "source", "source_size", "n", "target"
    )


def _pivot(items: Column, seed: int) -> Column:
    """Folds an array of fractional documents; leaves the decided ones and one residual."""

    def step(acc: Column, x: Column) -> Column:
        c = acc["res"]
        sc, sx = c["size"].cast("double"), x["size"].cast("double")
        # words that can move from the carried document to x, and from x to it
        give = F.least(c["p"] * sc, (1 - x["p"]) * sx)
        take = F.least((1 - c["p"]) * sc, x["p"] * sx)
        u = coin(F.lit(seed), *[y[f] for y in (c, x) for f in ROW[:3]])
        give_now = u * (give + take) < take
        # after the move one of the two is exactly 0 or 1; which one follows from the smaller bound
        c_ends = F.when(give_now, c["p"] * sc <= (1 - x["p"]) * sx).otherwise((1 - c["p"]) * sc <= x["p"] * sx)
        moved = F.when(give_now, give).otherwise(-take)
        c_end = F.when(give_now, F.lit(0)).otherwise(F.lit(1))
        kept_p = F.when(c_ends, x["p"] + moved / sx).otherwise(c["p"] - moved / sc)
        done = F.when(c_ends, c).otherwise(x)
        goes = F.when(c_ends, x).otherwise(c)
        end = F.when(c_ends, c_end).otherwise(1 - c_end)
        decided = F.struct(*[done[f].alias(f) for f in ROW], (done["whole"] + end).cast("long").alias("copies"))
        carried = F.struct(*[goes[f].alias(f) for f in ROW], goes["whole"].alias("whole"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), kept_p)).alias("p"))
        return F.struct(carried.cast(RES).alias("res"), F.array_append(acc["out"], decided).cast(OUT).alias("out"))

    first = F.struct(F.element_at(items, 1).cast(RES).alias("res"), F.array().cast(OUT).alias("out"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def _rounded(rows: DataFrame, sources: DataFrame, most: int, fan_in: int, seed: int, cap: float) -> DataFrame:
    """skey, id, th, ord, size, copies from skey, n (rows of the source), item: one reduction tree per skey.

    sources has skey, rest (words that smaller documents are to take, as expected) and after (their words).
    A coin decides a root's residual where they can make up for either side, else the side that they can.
    """
    key = [F.col(f"item.{f}") for f in ROW[:3]]
    leaf = F.pmod(F.xxhash64(F.lit(seed), *key), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / fan_in).cast("long")))
    level, decided = rows.select("skey", leaf.alias("node"), "item"), []
    depth = 1 if most <= fan_in else 1 + math.ceil(math.log(math.ceil(most / fan_in), fan_in))
    for k in range(depth):
        # a node gets about fan_in rows (leaves) or at most fan_in residuals (above)
        met = level.groupBy("skey", "node").agg(F.sort_array(F.collect_list("item")).alias("items"))
        met = checkpointed(met.select("skey", "node", _pivot(F.col("items"), seed + k).alias("a")).select("skey", "node", "a.*"))
        decided.append(met.select("skey", F.explode("out").alias("o")).select("skey", "o.*"))
        level = met.select("skey", (F.col("node") / fan_in).cast("long").alias("node"), F.col("res").alias("item"))
    size, p = F.col("item.size"), F.col("item.p")
    over, under = (1 - p) * size - F.col("rest"), F.col("rest") + p * size - cap * F.col("after")
    luck = coin(F.lit(seed), *key, F.lit(depth)) < p
    last = F.when(F.greatest(over, under) <= 0, luck).when(over == under, luck).otherwise(over < under)
    roots = _with_sources(level.select("skey", "item"), sources.select("skey", "rest", "after"))
    decided.append(roots.select("skey", *[F.col(f"item.{f}") for f in ROW], (F.col("item.whole") + last.cast("long")).cast("long").alias("copies")))
    return reduce(DataFrame.unionByName, decided)


def _with_sources(rows: DataFrame, sources: DataFrame, most: int = 100_000, salts: int = 64) -> DataFrame:
    """rows and the columns of sources, one row per skey: sent to every task if they are few, else dealt in ``salts`` copies, so that a hot source stays in no one task."""
    small = sources.withColumnRenamed("skey", "k")
    if sources.count() <= most:
        return rows.join(F.broadcast(small), F.col("skey") == F.col("k")).drop("k")
    small = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("row_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    return salted.join(small, (F.col("skey") == F.col("k")) & (F.col("row_salt") == F.col("salt"))).drop("k", "salt", "row_salt")


def row_skey() -> Column:
    """The source; null gets a key that no name has."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))


def row_key() -> list[Column]:
    """What tells rows apart beside ord: skey, id, th."""
    return [row_skey().alias("skey"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(whole_text()).alias("th")]


def mixed(docs: DataFrame, weights: list[float] = (5, 2, 1), cap: float = 3, seed: int = 20240229, fan_in: int = 128) -> DataFrame:
    """doc_id, skey, th, ord, size, source_size, target, copies, taken for every row.

    skey, th and ord tell rows of one doc_id apart: source, text hash, and a number among rows that agree
    in all of them.  weights repeat over the sources by code point, null last; a target stops at cap times
    the size of its source.
    """
    rows = docs.select(*row_key(), F.col("source").cast("string").alias("source"), word_count(whole_text()).alias("size"))
    # rows that agree are counted first, so that no task sees more than their number
    rows = rows.groupBy("skey", "source", "id", "th", "size").agg(F.count(F.lit(1)).alias("m"))
    rows = checkpointed(rows.select("skey", "source", "id", "th", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("ord")))  # the texts are read once
    sizes = checkpointed(rows.groupBy("skey", "source", "size").agg(F.count(F.lit(1)).alias("c")))
    sources = sizes.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("c")).alias("source_size"), F.sum("c").alias("n"))
    targets = source_targets(sources, list(weights), cap).select(row_skey().alias("skey"), "source_size", "n", "target")
    # large documents first: what rounding them misses by is shared by the smaller ones, class by class
    by_skey = W.partitionBy("skey")
    filled = sizes.where("size > 0").withColumns({"before": F.sum("c").over(by_skey.orderBy(F.desc("size"))) - F.col("c"), "all": F.sum("c").over(by_skey)})
    kind = sum(((F.col("before") * share >= F.col("all")).cast("int") for share in SHARES), F.lit(0))
    filled = filled.withColumn("kind", kind)
    cuts = [F.min(F.when(F.col("kind") <= k, F.col("size"))).alias(f"cut{k}") for k in range(len(SHARES))]
    words = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("size") * F.col("c"))), F.lit(0)).alias(f"w{k}") for k in range(len(SHARES) + 1)]
    rows_of = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("c"))), F.lit(0)).alias(f"n{k}") for k in range(len(SHARES) + 1)]
    each = checkpointed(targets.join(filled.groupBy("skey").agg(*cuts, *words, *rows_of), "skey", "left"))
    most = each.agg(*[F.max(f"n{k}") for k in range(len(SHARES) + 1)]).first()
    kind = sum(((F.col("size") < F.col(f"cut{k}")).cast("int") for k in range(len(SHARES))), F.lit(0))
    base = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = _with_sources(rows.select("skey", *ROW), each.select("skey", base.alias("base"), *[f"cut{k}" for k in range(len(SHARES))]))
    luck = F.when(coin(F.lit(seed), *[F.col(f) for f in ROW[:3]]) < F.col("base") - F.floor("base"), 1).otherwise(0)
    decided = [rated.where("size <= 0").select("skey", *ROW, (F.floor("base") + luck).cast("long").alias("copies"))]
    rated = rated.where("size > 0").select("skey", *ROW, kind.alias("kind"))
    item = F.struct(*ROW, "whole", "p").cast(RES)
    left = each.select("skey", F.col("target").alias("left"), F.col("source_size").alias("words"))
    for k in range(len(SHARES) + 1):
        now = left.join(each.select("skey", F.col(f"w{k}").alias("w"), F.col(f"n{k}").alias("n")), "skey")
        rate = F.when(F.col("words") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(cap)), F.col("left") / F.col("words")))).otherwise(F.lit(0.0))
        now = now.select("skey", "n", "left", "words", F.floor(rate).cast("long").alias("whole"), (rate - F.floor(rate)).alias("p"), (F.col("words") - F.col("w")).alias("after"), (F.col("left") - rate * F.col("w")).alias("rest"))
        now = checkpointed(now)
        own = _with_sources(rated.where(F.col("kind") == k), now.select("skey", "n", "whole", "p"))
        done = own.where("p <= 0").select("skey", *ROW, F.col("whole").alias("copies"))
        done = checkpointed(done.unionByName(_rounded(own.where("p > 0").select("skey", "n", item.alias("item")), now, most[k] or 0, fan_in, seed + 100 * k, cap)))
        decided.append(done)
        got = done.groupBy(F.col("skey").alias("gk")).agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
        left = now.join(got, F.col("skey") == F.col("gk"), "left").select("skey", (F.col("left") - F.coalesce("got", F.lit(0))).alias("left"), F.col("after").alias("words"))
    out = _with_sources(reduce(DataFrame.unionByName, decided), each.select("skey", "source_size", "target"))
    return out.select(F.col("id").alias("doc_id"), "skey", "th", "ord", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the input's columns."""
    names = ["__skey", "__id", "__th"]
    rows = docs.select("*", *[c.alias(n) for c, n in zip(row_key(), names, strict=True)])
    mix = mixed(docs, **how)
    ranked = not mix.where("ord > 0").isEmpty()
    # rows that agree are numbered only where there are any
    rows = rows.withColumn("__ord", F.row_number().over(W.partitionBy(*names).orderBy(*names)).cast("long") - 1 if ranked else F.lit(0).cast("long"))
    copies = mix.where("copies > 0").select(F.col("skey").alias("__mk"), F.col("doc_id").alias("__mid"), F.col("th").alias("__mth"), F.col("ord").alias("__mord"), F.col("copies").alias("__copies"))
    same = (F.col("__skey") == F.col("__mk")) & F.col("__id").eqNullSafe(F.col("__mid")) & (F.col("__th") == F.col("__mth"))
    joined = rows.join(copies, same & (F.col("__ord") == F.col("__mord")) if ranked else same)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*[F.col(c) for c in docs.columns])
