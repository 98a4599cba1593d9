"""Keyword, vector and hybrid retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import cosine, keyword_score


def keyword_top(docs: DataFrame, key: str, text: str, terms: list[str], k: int) -> DataFrame:
    """key, score of the k best rows; ties by key."""
    scored = docs.select(F.col(key), F.round(keyword_score(F.col(text), terms), 9).alias("score"))
    return scored.where("score > 0").orderBy(F.desc("score"), key).limit(k)


def nearest(vectors: DataFrame, key: str, vector: str, query: list[float], k: int) -> DataFrame:
    """key, score of the k rows of highest cosine; rows of another dimension are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.select(F.col(key), F.round(cosine(F.col(vector), q), 6).alias("score"))
    return scored.where("score is not null").orderBy(F.desc("score"), key).limit(k)


def hybrid(keyword: DataFrame, semantic: DataFrame, key: str, k: int, weights: tuple[float, float] = (0.4, 0.6)) -> DataFrame:
    """key, score, kinds: weighted union of two scored lists."""
    both = keyword.select(key, (F.col("score") * weights[0]).alias("s"), F.lit("keyword").alias("kind")).unionByName(semantic.select(key, (F.col("score") * weights[1]).alias("s"), F.lit("semantic").alias("kind")))
    merged = both.groupBy(key).agg(F.round(F.sum("s"), 6).alias("score"), F.array_join(F.array_sort(F.collect_set("kind")), "+").alias("kinds"))
    return merged.orderBy(F.desc("score"), key).limit(k)


def budget_fill(ranked: DataFrame, order: list, size: str, budget: int, partition: list[str] = ()) -> DataFrame:
    """Rows in order until the first that overflows the budget."""
    w = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return ranked.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def budget_fill_skipping(rows: DataFrame, partition: str, order: list[str], size: str, budget: int) -> DataFrame:
    """Rows in order, leaving out each that would overflow and going on; a partition is one group's rows."""

    def fill(pdf):
        pdf, used, keep = pdf.sort_values(order), 0, []
        for n in pdf[size]:
            fits = used + n <= budget
            used += n if fits else 0
            keep.append(fits)
        return pdf[keep]

    return rows.groupBy(partition).applyInPandas(fill, rows.schema)
