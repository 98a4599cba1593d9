"""Queries of the training-data operators over the tables of a data folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import alignment, exact_dedup, fingerprint, licenses, mixing, near_dedup, packing, quality, ranked, secrets, sentencepiece_codec, token_output, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    """Path of a public tokenizer's vocabulary; any other path may be given to the operator."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of op7's tokenizer, stored and then dealt to shards as wide as its vocabulary needs; </s> ends a document."""
    import uuid

    folder = token_output.shard_folder(spark, f"shards-{uuid.uuid4().hex}")
    dtype, padding = token_output.width_for(alignment.vocabulary_size(tokenizer_file()))
    ids = alignment.piece_ids(table(spark, sf_dir, "documents"), tokenizer_file(), packed=dtype)
    ids.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(f"{folder}-ids")
    return token_output.materialised(spark.read.parquet(f"{folder}-ids"), folder, ids="ids", dtype=dtype, separator=2, padding=padding)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_codec.encoded(table(spark, sf_dir, "documents"), tokenizer_file(), verify=True, keep=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip", "parity")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digested(alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file()))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_exact_dedup": op1,
    "op2_quality_classifier": op2,
    "op3_license_scan": op3,
    "op4_token_output": op4,
    "op5_document_fingerprints": op5,
    "op6_simhash_near_dedup": op6,
    "op7_sentencepiece": op7,
    "op8_source_mixing": op8,
    "op9_toxicity": op9,
    "op10_secret_scan": op10,
    "op11_ranked_search": op11,
    "op12_token_alignment": op12,
    "op13_packing": op13,
}

SQL = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        found AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM found GROUP BY doc_id),
        totals AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sizes),
        asked AS (
            SELECT item_id, term, count(*) AS c
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM found, totals GROUP BY term, nn),
        long AS (SELECT doc_id, 100 - 25 + (25 * n * nn) // ll AS m FROM sizes, totals),
        scores AS (
            SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN found USING (term) JOIN long USING (doc_id) GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 20
    """,
}
