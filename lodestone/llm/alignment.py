"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A (byte-level, tokenizers library) encodes a blank and the text, tokenizer B (SentencePiece) the
text, to which it adds the blank.  The places where tokens end are set bits of two packed bitsets over the
bytes.  AND yields the shared cuts, which part the tokens into groups; popcounts before a cut (rank) give
the tokens of each side that end there, and the set bits of OR (select) are the ends of the links: between
two neighbours of them exactly one token of A and one of B overlap.

Both tokenizers end a token before a blank that follows no white space, so that texts are aligned chunk by
chunk and each distinct chunk once while it is remembered; that no piece of B has its marker after another
character is checked, and without it whole texts are chunks.  A text of which either side's bytes differ
has no tokens.

Corpus-wide: the links of each pair of ids are counted by distinct chunk and batch, then summed by Spark.
The count of each pair, and whether it is the highest of its B id, go to the second pass: at most ``most``
pairs are sent to the tasks at once; of more, a pass is made for each slice by hash, and the sums are added.

Nulls and ties: null and empty texts have no tokens; ties for the highest count are all best; each row is
aligned by itself, so rows that repeat an id or text appear as often; a null doc_id is kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import os
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, checkpointed, pieces, trim, whole_text
from lodestone.llm.sentencepiece_codec import BYTE, MARK, NORMAL, UNKNOWN, parse_model
from lodestone.llm.wordwise import Known, Words, byte_characters, chunked, flat, kept, ranges, sums

ONE = np.uint64(1)


class Ends:
    """A packed bitset over byte places, with popcounts before each word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, places: np.ndarray, n: int) -> Ends:
        bits = np.zeros((n // 64 + 1) * 64, np.uint8)
        bits[places] = 1
        return cls(np.packbits(bits, bitorder="little").view(np.uint64))

    def __and__(self, other: Ends) -> Ends:
        return Ends(self.words & other.words)

    def __or__(self, other: Ends) -> Ends:
        return Ends(self.words | other.words)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits at places smaller than each of these."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((ONE << bit) - ONE))

    def select(self) -> np.ndarray:
        """All set places in order."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


def links(a_ends: np.ndarray, b_ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two lists of ends over n bytes: numbers of the A and B tokens of each link, and the shared cuts."""
    a, b = Ends.of(a_ends, n), Ends.of(b_ends, n)
    at = (a | b).select()
    return a.rank(at), b.rank(at), (a & b).select()


class Spelling:
    """The bytes of a vocabulary's ids."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts, self.letters = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after another."""
        return self.letters[ranges(self.starts[ids], self.sizes[ids])]


class Pieces:
    """Ids of chunks by a SentencePiece model, and what its ids stand for."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model, m = sentencepiece.SentencePieceProcessor(model_proto=model), parse_model(model)
        self.bytes = Spelling([bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in m["pieces"]])
        # the marker starts pieces only, blanks stay as they are, and the model brings the text's first blank along
        self.apart = m["dummy_prefix"] and not m["squeeze"] and not m["charsmap"] and not any(MARK in p.lstrip(MARK) for p, _, kind in m["pieces"] if kind == NORMAL)
        # a last blank: alone it would be an empty text, which gets no marker
        self.blank = self.model.encode("x ")[len(self.model.encode("x")) :]

    def flat(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks one after another, and their numbers."""
        ids = self.model.encode([c.decode()[1:] for c in chunks], num_threads=1)
        return flat([x if c != b" " else self.blank for x, c in zip(ids, chunks, strict=True)], np.uint32)


class Pair:
    """Two tokenizers and what their ids stand for."""

    def __init__(self, a_file: str, b_model: bytes):
        import json

        self.words, self.pieces = Words(a_file, special=False), Pieces(b_model)
        back = {c: b for b, c in byte_characters().items()}
        named = json.loads(a_file)["model"]["vocab"]
        a_bytes = [b""] * (max(named.values()) + 1)
        for token, i in named.items():
            a_bytes[i] = bytes(back[c] for c in token)
        self.a_bytes, self.b_bytes, self.apart = Spelling(a_bytes), self.pieces.bytes, self.pieces.apart
        self.decimal = list(map(str, range(max(len(a_bytes), len(self.b_bytes.sizes)))))

    def aligned(self, chunks: list[bytes]) -> dict:
        """ids of both sides one after another with their numbers per chunk, which chunks both sides spell, and the links of those: token numbers, shared cuts."""
        sides = [self.words.flat(chunks), self.pieces.flat(chunks)]
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        starts, text = np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(chunks), np.uint8)
        good = np.ones(len(chunks), bool)
        for (ids, n), spelling in zip(sides, (self.a_bytes, self.b_bytes), strict=True):
            good &= sums(spelling.sizes[ids], np.concatenate([[0], np.cumsum(n)])) == sizes
            same = np.repeat(good, n)  # of the right size: the bytes decide
            differs = np.zeros(len(text), bool)
            own = ranges(starts[:-1][good], sizes[good])
            differs[own] = spelling.of(ids[same]) != text[own]
            good &= sums(differs, starts) == 0
        if not good.all():
            sides = [(ids[np.repeat(good, n)], np.where(good, n, 0)) for ids, n in sides]
        (a_ids, a_n), (b_ids, b_n) = sides
        a_ends, b_ends = np.cumsum(self.a_bytes.sizes[a_ids]), np.cumsum(self.b_bytes.sizes[b_ids])
        n = int(a_ends[-1]) if len(a_ends) else 0
        i, j, shared = links(a_ends, b_ends, n)
        cuts = [Ends.of(x, n).rank(shared) + 1 for x in (a_ends, b_ends)]
        return {"a": a_ids, "b": b_ids, "a_n": a_n, "b_n": b_n, "good": good, "links": (i, j), "pairs": a_ids[i].astype(np.int64) << 32 | b_ids[j], "cuts": cuts}

    def counted(self, chunks: list[bytes]) -> tuple[dict, dict]:
        """good and the pairs of ids of each link, for ``Known``."""
        x = self.aligned(chunks)
        per_chunk = sums(np.bincount(x["links"][0], minlength=len(x["a"])), np.concatenate([[0], np.cumsum(x["a_n"])]))
        return {"good": x["good"]}, {"pairs": (x["pairs"], per_chunk)}

    def scored(self, chunks: list[bytes], count_of) -> tuple[dict, dict]:
        """Counts, sums over links and the groups' spelling of each chunk, for ``Known``."""
        x = self.aligned(chunks)
        starts = np.concatenate([[0], np.cumsum(x["a_n"])])
        upto = np.concatenate([[0], np.cumsum(np.bincount(x["links"][0], minlength=len(x["a"])))])[starts]
        counts, best = count_of(x["pairs"])
        groups = np.searchsorted(x["cuts"][0], starts, "right")  # groups that end within the chunks before
        spelt = self._spelt(x)
        at = groups.tolist()
        text = [";".join(spelt[p:q]).encode() for p, q in zip(at, at[1:], strict=False)]
        letters = np.frombuffer(b"".join(text), np.uint8)
        columns = {"good": x["good"], "n_a": x["a_n"], "n_b": x["b_n"], "n_groups": np.diff(groups), "n_links": np.diff(upto), "n_best": sums(best, upto), "count_sum": sums(counts, upto)}
        return columns, {"groups": (letters, np.fromiter(map(len, text), np.int64, len(text)))}

    def _spelt(self, x: dict) -> list[str]:
        """``a1,a2|b1`` of every group."""
        a, b = (list(map(self.decimal.__getitem__, x[side].tolist())) for side in ("a", "b"))
        out, i, j = [], 0, 0
        for p, q in zip(*(c.tolist() for c in x["cuts"]), strict=True):
            out.append(f"{a[i]}|{b[j]}" if p - i == q - j == 1 else f"{','.join(a[i:p])}|{','.join(b[j:q])}")
            i, j = p, q
        return out


def _columns(texts: pa.Array, known: Known, apart: bool) -> tuple:
    """Numbers of distinct chunks, chunk codes, and the chunk bounds of every padded text (empty texts stay empty)."""
    padded = pc.if_else(pc.greater(pc.binary_length(texts), 0), pc.binary_join_element_wise(" ", texts, ""), "")
    if apart:
        numbers, codes, firsts, _ = chunked(padded, known)
        return numbers, codes, firsts
    values = padded.cast(pa.binary()).to_pylist()
    distinct = [x for x in dict.fromkeys(values) if x]
    place = {x: k for k, x in enumerate(distinct)}
    return known.take(distinct), np.array([place[x] for x in values if x], np.int64), np.cumsum([0, *(bool(x) for x in values)])


def _sources(spark: SparkSession, a_file: str, b_file: str):
    with open(a_file) as f, open(b_file, "rb") as g:
        return spark.sparkContext.broadcast((f.read(), g.read()))  # two vocabularies: their sizes are the files'


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))


def pair_counts(docs: DataFrame, a_file: str, b_file: str, memory: int = 176 << 20) -> DataFrame:
    """a, b, n: how many links of all documents hold each pair of ids linked."""
    bounded_batches(docs.sparkSession)
    shared, key = _sources(docs.sparkSession, a_file, b_file), f"kept-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"

        def remembering() -> tuple[Pair, Known]:
            pair = Pair(*shared.value)
            return pair, Known(pair.counted, memory)

        pair, known = kept(key, remembering)
        try:
            for batch in batches:
                for part in pieces(batch.column("t"), 1 << 21):
                    numbers, codes, firsts = _columns(part, known, pair.apart)
                    if not len(codes):
                        continue
                    bad = sums(~known.column("good", numbers)[codes], firsts) > 0
                    keep = np.repeat(~bad, np.diff(firsts))
                    times = np.bincount(codes[keep], minlength=len(numbers))
                    values, lengths = known.listed("pairs", numbers)
                    pairs, place = np.unique(values, return_inverse=True)
                    n = np.bincount(place, weights=np.repeat(times, lengths), minlength=len(pairs)).astype(np.int64)
                    pairs, n = pairs[n > 0], n[n > 0]
                    yield pa.RecordBatch.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["a", "b", "n"])
        finally:
            trim()

    found = _texts(docs).select("t").mapInArrow(run, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def aligned(docs: DataFrame, a_file: str, b_file: str, most: int = 1 << 21, memory: int = 176 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (``a1,a2|b1;a3|b2,b3``) of every row.

    most: pairs of ids that are sent to the tasks at once; memory: bytes of words that a Python worker remembers.
    """
    spark = docs.sparkSession
    counts = checkpointed(pair_counts(docs, a_file, b_file, memory))
    best = counts.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("highest"))  # one row per B id: a vocabulary at most
    counts = checkpointed(counts.join(best, F.col("b") == F.col("of")).select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best")))
    n = counts.count()
    slices = 1 if n <= most else math.ceil(1.1 * n / most)
    shared = _sources(spark, a_file, b_file)
    row = F.monotonically_increasing_id().alias("row")  # the same for each slice: partitions of a stored table
    rows = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    parts = [_scored(rows, shared, counts.where(F.pmod(F.hash("a", "b"), F.lit(slices)) == k) if slices > 1 else counts, memory) for k in range(slices)]
    if slices == 1:
        return parts[0].drop("row")
    once = [F.first(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return reduce(DataFrame.unionByName, parts).groupBy("row").agg(*once, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.first("groups").alias("groups")).drop("row")


def _scored(rows: DataFrame, shared, counts: DataFrame, memory: int) -> DataFrame:
    got = counts.toArrow()
    pairs = got["a"].to_numpy().astype(np.int64) << 32 | got["b"].to_numpy()
    order = np.argsort(pairs)
    table = rows.sparkSession.sparkContext.broadcast((pairs[order], got["n"].to_numpy()[order], got["best"].to_numpy(zero_copy_only=False)[order]))  # at most ``most`` pairs
    key = f"kept-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        codes_of, n_of, best_of = table.value

        def count_of(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(codes_of):
                return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            at = np.minimum(np.searchsorted(codes_of, pairs), len(codes_of) - 1)
            here = codes_of[at] == pairs
            return np.where(here, n_of[at], 0), best_of[at] & here

        def remembering() -> tuple[Pair, Known]:
            pair = Pair(*shared.value)
            return pair, Known(lambda chunks: pair.scored(chunks, count_of), memory)

        pair, known = kept(key, remembering)
        names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        try:
            for batch in batches:
                at = 0
                for part in pieces(batch.column("t"), 1 << 20):
                    about = [batch.column(c).slice(at, len(part)) for c in ("row", "doc_id")]
                    at += len(part)
                    numbers, codes, firsts = _columns(part, known, pair.apart)
                    none = np.zeros(0, np.int64)
                    good = sums(~known.column("good", numbers)[codes], firsts) == 0 if len(codes) else np.ones(len(part), bool)
                    out = [np.where(good, sums(known.column(c, numbers)[codes] if len(codes) else none, firsts), 0) for c in names]
                    letters, lengths = known.listed("groups", numbers) if len(numbers) else (np.zeros(0, np.uint8), none)
                    ends, raw = np.cumsum(lengths).tolist(), letters.tobytes()
                    spelt = [raw[p:q] for p, q in zip([0, *ends], ends, strict=False)]
                    spans, each = firsts.tolist(), codes.tolist()
                    groups = [b";".join(map(spelt.__getitem__, each[p:q])).decode() if g else "" for p, q, g in zip(spans, spans[1:], good.tolist(), strict=False)]
                    yield pa.RecordBatch.from_arrays([*about, *map(pa.array, out), pa.array(groups, pa.string())], ["row", "doc_id", *names, "groups"])
        finally:
            trim()

    return rows.mapInArrow(run, "row long, doc_id long, " + ", ".join(f"{c} long" for c in ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]) + ", groups string")


def digested(result: DataFrame) -> DataFrame:
    """groups_sha256 (lowercase hex; empty without tokens) in place of groups."""
    return result.withColumn("groups_sha256", F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))).drop("groups")



def vocabulary_size(model_file: str) -> int:
    """Pieces of a SentencePiece model."""
    with open(model_file, "rb") as f:
        return len(parse_model(f.read())["pieces"])


def piece_ids(docs: DataFrame, model_file: str, packed: str | None = None, memory: int = 128 << 20) -> DataFrame:
    """doc_id, ids of every text by a SentencePiece model, a null or empty text having none.

    ids is array<int>, or, where ``packed`` names a dtype that holds the vocabulary, their bytes in it: Spark moves
    and stores one value a text then, not one an id.
    """
    if packed is not None and np.iinfo(packed).max < vocabulary_size(model_file) - 1:
        raise ValueError(f"{packed} does not hold the ids of {model_file}")
    bounded_batches(docs.sparkSession)
    with open(model_file, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary: its size is the file's
    key = f"kept-pieces-{memory}-{hashlib.sha256(model).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def remembering() -> tuple[Pieces, Known]:
            made = Pieces(shared.value)
            return made, Known(lambda chunks: ({}, {"ids": made.flat(chunks)}), memory)

        made, known = kept(key, remembering)
        try:
            for batch in batches:
                at = 0
                for part in pieces(batch.column("t"), 1 << 21):
                    doc_ids = batch.column("doc_id").slice(at, len(part))
                    at += len(part)
                    numbers, codes, firsts = _columns(part, known, made.apart)
                    ids, lengths = known.listed("ids", numbers[codes]) if len(codes) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
                    ends = np.concatenate([[0], np.cumsum(lengths)])[firsts]
                    if packed is None:
                        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    else:
                        places = (ends * np.dtype(packed).itemsize).astype(np.int64)
                        lists = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(places), pa.py_buffer(ids.astype(packed))]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([doc_ids, lists], ["doc_id", "ids"])
        finally:
            trim()

    return _texts(docs).mapInArrow(run, f"doc_id long, ids {'array<int>' if packed is None else 'binary'}")
