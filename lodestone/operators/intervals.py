"""Interval joins: a point and the range that holds it, by equal buckets first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def containing(points: DataFrame, at: str, ranges: DataFrame, lo: str, hi: str, width: int) -> DataFrame:
    """Every point with each range [lo, hi) that holds it; points without one are kept with nulls.

    Ranges are repeated for each bucket of ``width`` that they touch, so the join is on the bucket.
    """
    bucket = lambda x: F.floor(x / width)
    spread = ranges.where(F.col(hi) > F.col(lo)).withColumn("bucket_r", F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi) - 1))))
    keyed = points.withColumn("bucket_p", bucket(F.col(at)))
    joined = keyed.join(spread, (F.col("bucket_p") == F.col("bucket_r")) & (F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi)), "left")
    return joined.drop("bucket_p", "bucket_r")
