"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame;
the caller writes it as Parquet and rereads it as the next stage's docs.  All stages but the last return
the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, mixing, near_dedup, sentencepiece_codec, toxicity
from lodestone.llm.common import ensure_checkpoint_dir, release
from lodestone.llm.registry import table, tokenizer_file


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts to be toxic (a score of 0.3 or more) go."""
    return toxicity.without_toxic(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8 or more) the smallest doc_id stays."""
    return near_dedup.drop_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: repeated rows are the mix's copies."""
    release(spark)  # what near-dedup stored and nothing refers to any more
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip of every row."""
    out = sentencepiece_codec.encoded(docs, tokenizer_file())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Toxicity, near-dedup, mixing and encoding have no SQL; tests/llm holds their operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each one keeps is written to the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
