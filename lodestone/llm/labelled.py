"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import whole_text


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, mod modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % modulus


def remainder_of(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def training_sample(docs: DataFrame, labels: DataFrame, label: str, learns: Column, most: int, room: int = 64 << 20) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of at most ``most`` distinct labelled rows for which ``learns`` holds.

    The rows are those with the smallest hashes of the id, so the sample is the same whatever the
    partitions; in that order a text is left out that would take the sample beyond ``room`` bytes.  Ids
    and sizes of at most ``most`` rows are looked at before any text reaches the driver.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(learns & F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    own = own.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("order", F.xxhash64("doc_id"))
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in own.orderBy("order", "doc_id").limit(most).collect()], "i long, y int, order long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    # of rows that repeat an id one text counts, that of the smallest hash
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("i"))
    sizes = rows.groupBy("order", "doc_id").agg(F.min(F.struct(F.xxhash64("t").alias("th"), F.octet_length("t").alias("n"))).alias("x")).select("order", "doc_id", "x.*").orderBy("order", "doc_id").collect()
    kept, used = [], 0
    for r in sizes:
        if used + r.n <= room:
            used += r.n
            kept.append((r.doc_id, r.th))
    wanted = F.broadcast(spark.createDataFrame(kept, "k long, th long"))
    rows = rows.join(wanted, (F.col("doc_id") == F.col("k")) & (F.xxhash64("t") == F.col("th")))
    seen: dict[str, tuple[int, int]] = {}
    for r in rows.select("doc_id", "t", "y").dropDuplicates(["doc_id"]).toLocalIterator():
        if r.t not in seen or r.doc_id < seen[r.t][0]:
            seen[r.t] = (r.doc_id, r.y)
    ordered = sorted((i, t, y) for t, (i, y) in seen.items())
    return [t for _, t, _ in ordered], [y for _, _, y in ordered]
