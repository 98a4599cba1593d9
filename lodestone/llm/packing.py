"""Packing token sequences: best-fit decreasing into windows of a fixed length.

A document is its ids, as the tokenizer gives them, and an end id.  Overlong documents are first cut
into full windows, which are sequences by themselves; what is left of each document (less than a window)
goes to a block of ``room`` ids.  A full block is packed: longest first, each piece goes to the tightest
window that has room for it, found by a segment tree indexed by the remaining capacity.  Sequences
whose length is a power of two need no padding.  What other windows lack is filled by cutting the
pieces of the emptiest ones, and the last one of a block is cut into powers of two: nothing is padded.

A task packs its own partition, one block at a time, so that nothing is shuffled, memory follows the
block, and a lost task is done again from the same rows with the same result.  Sequences are numbered
partition x 2^33 + a count in the partition.

Tokens: words are encoded apart (the pre-tokenizer drops white space, so that no token reaches over it)
and each distinct one once while it is remembered.  Where the pre-tokenizer is the usual one of word
vocabularies, texts are cut as it cuts them, so that a word is the same one whatever stands around it.

Nulls and ties: a null or empty text is just the end id; each row is a document, rows that repeat an id
too; a null doc_id is kept; an empty table gives an empty result; other columns are ignored.  A very
long text is a row of its own in a batch and is cut into windows at once.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, pieces, trim, whole_text
from lodestone.llm.wordwise import Known, Words, chunked, kept

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ID = np.dtype("<u4")


class Tightest:
    """A segment tree over remaining capacities 0 to ``most``: each leaf holds the windows with that much room."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open: list[list[int]] = [[] for _ in range(self.size)]
        self.some = bytearray(2 * self.size)  # 1: a window below this node

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = self.size + room
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The window with the smallest room of at least ``least``, and that room; it is taken out."""
        node = self.size + least
        if not self.some[node]:
            while node & 1 or not self.some[node + 1]:  # up, until the right neighbour has a window
                node >>= 1
                if not node:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        room = node - self.size
        window = self.open[room].pop()
        if not self.open[room]:
            self.some[node] = 0
            while node := node >> 1:
                self.some[node] = self.some[2 * node] | self.some[2 * node + 1]
        return window, room


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Numbers of the pieces in each window, longest pieces first."""
    tree, windows = Tightest(length), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        window, room = found or (len(windows), length)
        if not found:
            windows.append([])
        windows[window].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], window)
    return windows


def _whole(used: int, length: int) -> bool:
    return used == length or used & (used - 1) == 0


def fill(windows: list[list[int]], lengths: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (piece, first, end) without padding: those that lack ids get them from the emptiest ones."""
    done, ragged = [], []
    for w in windows:
        used = sum(lengths[i] for i in w)
        (done if _whole(used, length) else ragged).append((used, [(i, 0, lengths[i]) for i in w]))
    ragged.sort(key=lambda x: -x[0])
    out = [w for _, w in done]
    low, high = 0, len(ragged) - 1
    while low < high:
        used, w = ragged[low]
        left, donor = ragged[high]
        while used < length and donor:
            i, a, b = donor.pop()
            n = min(length - used, b - a)
            w.append((i, b - n, b))
            if n < b - a:
                donor.append((i, a, b - n))
            used, left = used + n, left - n
        ragged[low], ragged[high] = (used, w), (left, donor)
        if used == length:
            out.append(w)
            low += 1
        if not donor:
            high -= 1
        elif _whole(left, length):  # nothing of it needs padding any more
            out.append(donor)
            high -= 1
    if low == high and ragged[low][1]:
        used, rest = ragged[low]
        rest = rest[::-1]
        for k in reversed(range(used.bit_length())):
            lack, w = used & 1 << k, []
            while lack:
                i, a, b = rest.pop()
                n = min(lack, b - a)
                w.append((i, a, a + n))
                lack -= n
                if n < b - a:
                    rest.append((i, a + n, b))
            if w:
                out.append(w)
    return out


class Block:
    """The rests of documents that wait to be packed."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.about: list[tuple[int | None, int, int]] = []  # doc_id, start, doc_tokens
        self.used = 0

    def add(self, ids: np.ndarray, doc_id: int | None, start: int, doc_tokens: int) -> None:
        self.ids.append(ids.copy())
        self.about.append((doc_id, start, doc_tokens))
        self.used += len(ids)

    def rows(self, length: int, first: int) -> tuple[list[tuple], int]:
        """Rows of all pieces, with sequences numbered from ``first``; the next number."""
        lengths, out = [len(x) for x in self.ids], []
        packed = fill(best_fit(lengths, length), lengths, length)
        for k, w in enumerate(packed):
            offset = 0
            for i, a, b in w:
                doc_id, start, n = self.about[i]
                out.append((doc_id, start + a, b - a, self.ids[i][a:b].tobytes(), n, first + k, offset))
                offset += b - a
        return out, first + len(packed)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def packed(docs: DataFrame, tokenizer_file: str, length: int = 2048, end: int = 1, room: int = 1 << 21, memory: int = 160 << 20) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    tokenizer_file: a tokenizers JSON file that the driver reads, whose pre-tokenizer drops white space.
    room: ids of a block; memory: bytes of words that a Python worker remembers.
    """
    if length < 1 or length & (length - 1):
        raise ValueError(f"a window of {length} ids is no power of two")
    bounded_batches(docs.sparkSession)
    with open(tokenizer_file) as f:
        file = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(file)  # one vocabulary: its size is the file's
    key = f"kept-packing-{memory}-{hashlib.sha256(file.encode()).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        def remembering() -> tuple[Known, Callable | None]:
            words = Words(shared.value)
            return Known(lambda parts: ({}, {"ids": words.parts_flat(parts)}), memory), words.cut

        (known, cut), block = kept(key, remembering), Block()
        sequence = TaskContext.get().partitionId() << 33
        try:
            for batch in batches:
                at = 0
                for part in pieces(batch.column("t"), 1 << 21):
                    doc_ids = batch.column("doc_id").slice(at, len(part)).to_pylist()
                    at += len(part)
                    numbers, codes, firsts, _ = chunked(part, known, cut)
                    ids, lengths = known.listed("ids", numbers, codes) if len(codes) else (np.empty(0, ID), np.empty(0, np.int64))
                    ends = np.concatenate([[0], np.cumsum(lengths)])[firsts].tolist()
                    rows: list[tuple] = []
                    for doc_id, a, b in zip(doc_ids, ends, ends[1:], strict=False):
                        doc = np.append(ids[a:b], ID.type(end))
                        whole = len(doc) // length * length
                        for start in range(0, whole, length):
                            rows.append((doc_id, start, length, doc[start : start + length].tobytes(), len(doc), sequence, 0))
                            sequence += 1
                        if whole < len(doc):
                            block.add(doc[whole:], doc_id, whole, len(doc))
                    if block.used >= room:
                        more, sequence = block.rows(length, sequence)
                        rows, block = rows + more, Block()
                    for i in range(0, len(rows), 512):
                        yield _batch(rows[i : i + 512])
            rows, sequence = block.rows(length, sequence)
            for i in range(0, len(rows), 512):
                yield _batch(rows[i : i + 512])
        finally:
            trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t")).mapInArrow(run, SCHEMA)
