"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprint: every k-word shingle's XXH64 votes on 64 bits.  The fingerprints are counted natively:
shingles are exploded from the word array and packed sums take the votes.

Search: ``covering`` deals the fingerprints to the tables of a covering family of masks, so that every
pair within the radius collides in some table.  Only distinct fingerprints are searched: exact copies
and copies of one fingerprint never meet pairwise.

``similar_groups`` and ``drop_similar`` decide by the exact Jaccard similarity of word shingles
(``jaccard``): the covering tables over the SimHash of each shingle set find the first candidates, and
a lossless index those pairs that lie beyond the radius.

Nulls and ties: a null or blank text has fingerprint zero and is linked like any other; rows with a
null doc_id get a fingerprint and take part in links but carry no smallest id (a component of such
rows alone has a null component_id).  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import WHITE, ascii_lower, bounded_broadcast, checkpointed, hex16, voted_bits, votes, whole_text, words_by
from lodestone.llm.components import components
from lodestone.llm.covering import links
from lodestone.llm.jaccard import similar_rows


def shingles(words: Column, k: int) -> Column:
    """k-word shingles as structs; fewer than k words give one shingle of all of them."""
    whole = F.array(F.struct(F.array_join(words, " ").alias("s0"), *[F.lit(None).cast("string").alias(f"s{i}") for i in range(1, k)]))
    n = F.size(words)
    parts = [F.slice(words, i + 1, F.greatest(n - k + 1, F.lit(0))).alias(f"s{i}") for i in range(k)]
    zipped = F.arrays_zip(*parts)
    return F.when(n == 0, F.array().cast(f"array<struct<{','.join(f's{i}:string' for i in range(k))}>>")).when(n < k, whole).otherwise(zipped)


def fingerprints(docs: DataFrame, k: int = 3, more: int = 0) -> DataFrame:
    """doc_id, th, fp [, g0.., total]: one row per doc_id and text. ``more`` adds so many further 64-bit fingerprints with other seeds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"), F.monotonically_increasing_id().alias("row"))
    words = words_by(ascii_lower(F.col("t")), WHITE)
    terms = rows.select("doc_id", "row", F.xxhash64("t").alias("th"), words.alias("w")).select("doc_id", "th", "row", F.posexplode_outer(shingles(F.col("w"), k)).alias("at", "s"))
    text = F.concat_ws(" ", *[F.col(f"s.s{i}") for i in range(k)])
    terms = terms.select("doc_id", "th", "row", F.coalesce("at", F.lit(0)).alias("at"), F.when(F.col("s").isNotNull(), F.xxhash64(text)).alias("h"))
    # in a text without shingles there is nothing to vote
    terms = terms.select("*", *[F.when(F.col("h").isNotNull(), F.xxhash64("h", F.lit(i))).alias(f"h{i}") for i in range(more)])
    # rows that repeat an id and text vote apart: their counts together could leave a counter
    voted = votes(terms, ["doc_id", "th", "row"], ["h", *[f"h{i}" for i in range(more)]], "at")
    return voted.select("doc_id", "th", voted_bits(0, F.col("total")).alias("fp"), *[voted_bits(j + 1, F.col("total")).alias(f"g{j}") for j in range(more)]).dropDuplicates(["doc_id", "th"])


def near_groups(docs: DataFrame, k: int = 3, radius: int = 3, block: int = 2048) -> DataFrame:
    """doc_id, fingerprint, component_id for every row."""
    prints = checkpointed(fingerprints(docs, k))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    member = components(links(distinct.select(F.col("fp").alias("node"), "fp"), radius, block))
    # the smallest id of a component of fingerprints is that of its documents
    named = distinct.join(member, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("c"))
    lows = named.groupBy("c").agg(F.min("low").alias("component_id"))
    ids = named.join(lows, "c").select(F.col("fp").alias("f"), "component_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(whole_text()).alias("h"))
    joined = prints.join(ids, F.col("fp") == F.col("f")).select("doc_id", "th", "fp", "component_id")
    return rows.join(joined, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("th"))).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def similar_groups(docs: DataFrame, k: int = 5, similar: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, th, component_id: groups of documents with a Jaccard similarity of a/b or more of their k-word shingles.

    Groups are named by their smallest id; without ids the name is null.
    """
    rows = checkpointed(similar_rows(docs, k, similar))
    named = rows.groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "c")
    return rows.join(named, F.col("component") == F.col("c")).select("doc_id", "th", "component_id")


def drop_similar(docs: DataFrame, k: int = 5, similar: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row of each group, with all columns: the smallest doc_id, of equal ids the smallest text hash; null ids come last."""
    rows = checkpointed(similar_rows(docs, k, similar))
    best = rows.groupBy(F.col("component").alias("c")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("best"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    gone = rows.join(best, F.col("component") == F.col("c")).where(~stays).select(F.col("doc_id").alias("__gone"), F.col("th").alias("__gone_th")).distinct()
    keyed = docs.withColumn("__th", F.xxhash64(whole_text()))
    gone = bounded_broadcast(checkpointed(gone))
    kept = keyed.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone")) & (F.col("__th") == F.col("__gone_th")), "left_anti")
    # rows of one id and text are told apart only where there are any
    if not rows.groupBy("doc_id", "th").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__th"])
    return kept.drop("__th")
