"""Ranked lexical search, score-at-a-time over impact-ordered postings.

One pass over the documents keeps, of each, its length and the occurrences of the items' terms, and
writes them to the shared folder; numbers of documents per term follow from that table, and with them
each posting's exact impact (term weight x saturated frequency, in integers).

A task then takes shards of that table, at most ``room`` postings at a time.  In a shard postings are
grouped by term and exact impact, highest first.  For an item the groups of its terms are taken from the
highest weighted impact down, in strides that halve the threshold; what is left of each list bounds what a
document can still get.  It stops only when a document not met so far cannot reach the k-th sum; the scores
of all documents that could still reach it are then completed from their own postings.  So each shard's
best k are exact, and so are the best k of all shards, which a window with partial ranking finds.

Items are taken in blocks of at most ``block`` distinct terms; each block reads the documents once.

Nulls and ties: a null text has no terms and matches nothing; equal scores rank by ascending doc_id, null
last; rows that repeat an id are ranked apart, and so are rows that repeat an item_id; an item without
matches has no rows; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, ensure_checkpoint_dir, pieces, trim, whole_text
from lodestone.llm.wordwise import buffers, ranges, sums

# Fixed value: the term rule.  Every byte from 0x80 on belongs to a character of a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULT = "item long, doc_id long, score long"


def byte_table() -> np.ndarray:
    """What each byte becomes: itself in lower case in a term, a blank between terms."""
    table = np.full(256, 0x20, np.uint8)
    for b in range(256):
        if b >= 0x80 or chr(b).isalnum():
            table[b] = ord(chr(b).lower()) if b < 0x80 else b
    return table


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a column of texts one after another (empty ones between them, too), and where those of each text start and the last ones end."""
    data, starts = buffers(texts)
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(starts)), pa.py_buffer(byte_table()[data])])
    lists = pc.split_pattern(plain, " ")
    return lists.values, np.asarray(lists.offsets)


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in ``terms``), tfs of every document that has a term."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # a block of the items' terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, most = pa.array(shared.value, pa.large_string()), max(1, len(shared.value))
        for batch in batches:
            at = 0
            for part in pieces(batch.column("t"), 1 << 21):
                doc_ids = batch.column("doc_id").slice(at, len(part))
                at += len(part)
                words, starts = split_terms(part)
                n = sums(pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False), starts)
                place = pc.fill_null(pc.index_in(words, value_set=wanted), -1).to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(part)), np.diff(starts))
                codes, tf = np.unique((doc * most + place)[place >= 0], return_counts=True)
                ends = np.searchsorted(codes, np.arange(len(part) + 1) * most).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (codes % most, tf)]
                out = pa.RecordBatch.from_arrays([doc_ids, pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))
        trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t")).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Postings of some documents in the order of documents, and in that of terms and falling impacts."""

    def __init__(self, doc_ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.doc_ids, self.null, self.terms, self.impacts = doc_ids, null, terms, impacts
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.sums, self.weight = np.zeros(len(doc_ids), np.int64), np.zeros(n_terms, np.int64)
        doc = np.repeat(np.arange(len(doc_ids), dtype=np.int32), lengths)
        order = np.lexsort((-impacts, terms))
        t, x = terms[order], impacts[order]
        # groups of one term and exact impact: where they start in ``docs``, and their impacts
        new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (x[1:] != x[:-1])])) if len(t) else np.empty(0, np.int64)
        self.docs, self.group_at, self.group_impact = doc[order], np.append(new, len(t)), x[new]
        self.term_groups = np.searchsorted(t[new], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the best k documents for terms that occur so often in an item."""
        at, end = self.term_groups[terms].copy(), self.term_groups[terms + 1]
        some = at < end
        terms, times, at, end = terms[some], times[some], at[some], end[some]
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        falling = -self.group_impact
        left = times * self.group_impact[at]  # the highest weighted impact that is left of each list
        threshold = int(left.max())
        while True:
            threshold //= 2
            # the groups whose weighted impact is above the threshold
            upto = np.array([a + np.searchsorted(falling[a:e], -(threshold // c), "left") for a, e, c in zip(at, end, times, strict=True)])
            first, size = self.group_at[at], self.group_at[upto] - self.group_at[at]
            groups = ranges(at, upto - at)
            gain = np.repeat(np.repeat(times, upto - at) * self.group_impact[groups], self.group_at[groups + 1] - self.group_at[groups])
            np.add.at(self.sums, self.docs[ranges(first, size)], gain)
            at = upto
            more = at < end
            left = np.where(more, times * self.group_impact[np.minimum(at, len(self.group_impact) - 1)], 0)
            rest = int(left.sum())
            met = np.flatnonzero(self.sums)
            partial = self.sums[met]
            kth = int(np.partition(partial, len(met) - k)[len(met) - k]) if len(met) >= k else 0
            if not more.any() or rest < kth:
                break
        found = met[partial + rest >= kth]
        self.sums[met] = 0
        self.weight[terms] = times
        first, size = self.starts[found], np.diff(self.starts)[found]
        places = ranges(first, size)
        scores = sums(self.weight[self.terms[places]] * self.impacts[places], np.concatenate([[0], np.cumsum(size)]))
        self.weight[terms] = 0
        best = np.lexsort((self.doc_ids[found], self.null[found], -scores))[:k]
        return found[best], scores[best]


def _block(docs: DataFrame, items: list[tuple[int, dict[str, int]]], k: int, room: int, folder: str) -> DataFrame:
    """item, doc_id, score: the best k of every shard for the items of one block, by their numbers."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in items for t in own})
    postings(docs, terms).write.mode("overwrite").parquet(folder)
    stored = spark.read.schema("doc_id long, n long, terms array<int>, tfs array<int>").parquet(folder)
    total = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(terms), np.int64)
    for r in stored.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the terms of a block
        df[r.t] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    place = {t: i for i, t in enumerate(terms)}
    asked = [(i, np.array([place[t] for t in own], np.int64), np.array(list(own.values()), np.int64)) for i, own in items]
    shared = spark.sparkContext.broadcast((weight, asked, total.n, total.l))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, asked, n_docs, n_words = shared.value

        def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, n = table["doc_id"], table["n"].to_numpy()
            t, tf = (table[c].combine_chunks() for c in ("terms", "tfs"))
            lengths = pc.list_value_length(t).to_numpy()
            t, tf = t.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
            m = np.repeat(75 + 25 * n * n_docs // max(1, n_words), lengths)
            impacts = weight[t] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            some = impacts > 0
            lengths = sums(some, np.concatenate([[0], np.cumsum(lengths)]))
            shard = Shard(pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(), lengths, t[some], impacts[some], len(weight))
            for i in range(0, len(asked), 256):
                own = [(item, *shard.search(terms, times, k)) for item, terms, times in asked[i : i + 256]]
                at = np.concatenate([x for _, x, _ in own])
                items = np.repeat(np.array([item for item, _, _ in own], np.int64), [len(x) for _, x, _ in own])
                yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(shard.doc_ids[at], mask=shard.null[at]), pa.array(np.concatenate([s for _, _, s in own]))], ["item", "doc_id", "score"])

        parts, used = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                parts.append(part)
                used += pc.sum(pc.list_value_length(part.column("terms"))).as_py() or 0
                if used >= room:
                    yield from found(parts)
                    parts, used = [], 0
        if parts:
            yield from found(parts)
        trim()

    return stored.where(F.size("terms") > 0).mapInArrow(run, RESULT)


def search(docs: DataFrame, items: DataFrame, k: int = 20, room: int = 1 << 20, block: int = 1 << 18) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item, scores above 0.

    room: postings of a shard; block: distinct terms of the items that are looked for in one pass.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.translate(whole_text(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TERM), F.lit(0))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    named, results, waiting, seen = [], [], [], set()

    def flush() -> None:
        if waiting:
            path = f"{folder}/{len(results)}"
            _block(docs, waiting, k, room, path).write.parquet(f"{path}-best")  # at most k rows an item and shard
            results.append(spark.read.parquet(f"{path}-best"))
            waiting.clear()
            seen.clear()

    # the items' texts pass one partition at a time, a block is kept
    for number, r in enumerate(items.select(F.col("item_id").cast("long").alias("item_id"), words.alias("terms")).toLocalIterator()):
        named.append((number, r.item_id))
        own: dict[str, int] = {}
        for t in r.terms:
            own[t] = own.get(t, 0) + 1
        if own:
            if len(seen | own.keys()) > block:
                flush()
            waiting.append((number, own))
            seen |= own.keys()
    flush()
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, results).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = spark.createDataFrame(named, "number long, item_id long")  # one narrow row an item
    return ranked.join(names, F.col("item") == F.col("number")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
