"""Exact dedup: 128-bit content hash, bytes compared inside each hash group.

The text itself is a grouping key beside its 128-bit hash: the aggregation compares bytes, so texts
whose hashes collide stay apart.  Partial aggregation leaves at most one row per text and map task
before the shuffle, so a group with a third of all rows costs one row per task.  The classes go back
to the rows by hash and SHA-256; that join has one narrow row per class on its right side, and Spark
splits a hot hash on its left.

Nulls and ties: a null text counts as empty; a null doc_id is smaller than any other and stays only
if every equal row has a null doc_id; of rows that repeat a doc_id and text each is returned once per
input row, and with equal ids every one that carries keep_id is ``kept``.  An empty table gives an
empty result.  Other columns of the input are ignored by ``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import whole_text


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(docs: DataFrame, keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    keep: "smallest" or "largest" doc_id of a group stays.  hash_of may be replaced by a weaker hash;
    the result is the same.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    pick = F.min if keep == "smallest" else F.max
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    classes = (
        rows.groupBy(hash_of(F.col("t")).alias("h"), "t")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.col("h").alias("ch"), F.sha2(F.col("t").cast("binary"), 256).alias("cs"), "keep_id", "group_size")
    )
    keyed = rows.select("doc_id", hash_of(F.col("t")).alias("h"), F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"))
    return keyed.join(classes, (F.col("h") == F.col("ch")) & (F.col("text_sha256") == F.col("cs"))).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """One row of each group of equal texts, with all columns of the input."""
    best = F.max_by if keep == "largest" else F.min_by
    columns = [F.col(c) for c in docs.columns]
    keyed = docs.select(hash_of(whole_text()).alias("__h"), whole_text().alias("__t"), F.struct(*[c for c in columns if c is not None]).alias("__row"))
    # the text is a grouping key already; the row travels without it
    others = [c for c in docs.columns if c != "text"]
    keyed = keyed.select("__h", "__t", F.struct(*[F.col("__row")[c].alias(c) for c in others], F.col("__row")["text"].isNull().alias("__null")).alias("__row"))
    # a null doc_id ranks below all others for "largest" and above for "smallest"
    rank = F.coalesce(F.col("__row")["doc_id"], F.lit((1 << 63) - 1 if keep == "smallest" else -(1 << 63)))
    kept = keyed.groupBy("__h", "__t").agg(best(F.col("__row"), rank).alias("__row"))
    return kept.select(*[F.when(~F.col("__row")["__null"], F.col("__t")).alias("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])
