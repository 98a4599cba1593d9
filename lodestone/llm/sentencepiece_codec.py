"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed (a small protobuf reader, no generated code) and rebuilt: its normaliser
(identity, dummy prefix, extra white space), the metaspace marker, byte fallback, and either a Unigram
model from the piece scores or, for a BPE model, the merges that its scores rank.  Batches of whole
texts are encoded, new words alone, and turned back into text; ``verify`` encodes
every text with the SentencePiece library too and compares.  ``decoded`` is the tokenizer's decoder.

The model's path is a parameter and may be any file that the driver reads; its bytes travel to the
executors with the task, whose size is that of one vocabulary.

Where no piece of the vocabulary has the marker after another character (this is checked), merges never
cross the start of a run of blanks: words are encoded apart, and very long texts in segments.  Where all
bytes have pieces, texts are cut further, between characters that no piece joins, directly or through
others (letters and punctuation, say).

Nulls and ties: a null text is empty and has no ids; every row is encoded by itself; a null doc_id is
kept; an empty table gives an empty result; other columns are ignored by ``encoded``.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, pieces, trim, whole_text

MARK = "▁"
STARTS = re.compile(f"(?<![ {MARK}])[ {MARK}](?=.)", re.DOTALL)  # where runs of blanks start that do not end the text at once
CUT = re.compile(f"{MARK}+[^{MARK}]*").findall
# Piece kinds and model kinds of the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    i = 0

    def varint() -> int:
        nonlocal i
        x = shift = 0
        while True:
            b = data[i]
            i += 1
            x |= (b & 127) << shift
            shift += 7
            if b < 128:
                return x

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 1:
            i += 8
            yield tag >> 3, data[i - 8 : i]
        elif kind == 2:
            n = varint()
            i += n
            yield tag >> 3, data[i - n : i]
        elif kind == 5:
            i += 4
            yield tag >> 3, data[i - 4 : i]
        else:
            raise ValueError(f"unknown wire type {kind}")


def parse_model(data: bytes) -> dict:
    """pieces [(piece, score, kind)], kind, byte_fallback, dummy_prefix, squeeze, charsmap, unk."""
    m = {"pieces": [], "kind": UNIGRAM, "byte_fallback": False, "dummy_prefix": True, "squeeze": True, "charsmap": b"", "unk": 0}
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m["pieces"].append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m["kind"] = v
                elif n == 35:
                    m["byte_fallback"] = bool(v)
                elif n == 40:
                    m["unk"] = v
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m["charsmap"] = v
                elif n == 3:
                    m["dummy_prefix"] = bool(v)
                elif n == 4:
                    m["squeeze"] = bool(v)
    return m


def build_tokenizer(data: bytes):
    """A tokenizers.Tokenizer with the model file's behaviour."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    m = parse_model(data)
    if m["kind"] not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are rebuilt")
    if m["kind"] == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m["pieces"]], unk_id=m["unk"], byte_fallback=m["byte_fallback"])
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(m["pieces"])}
        merges = []
        for piece, score, kind in m["pieces"]:
            if kind not in (NORMAL, USER) or len(piece) < 2:
                continue
            for j in range(1, len(piece)):
                left, right = vocab.get(piece[:j]), vocab.get(piece[j:])
                if left is not None and right is not None and m["pieces"][left][2] == m["pieces"][right][2] == NORMAL:
                    merges.append((-score, vocab[piece], left, piece[:j], piece[j:]))
        merges.sort(key=lambda x: x[:3])
        model = models.BPE(vocab, [x[3:] for x in merges], unk_token=m["pieces"][m["unk"]][0], byte_fallback=m["byte_fallback"], fuse_unk=True, cache_capacity=10_000)
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
    if m["squeeze"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if m["dummy_prefix"]:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    inner = any(MARK in p.lstrip(MARK) for p, _, kind in m["pieces"] if kind == NORMAL)
    if not inner:
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    tail = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence(tail + ([decoders.Strip(content=" ", left=1)] if m["dummy_prefix"] else []))
    return t


def parts_of(m: dict, most: int = 8):
    """A function from a text, with markers for blanks, to parts that are encoded apart.

    A piece lies in one class of characters, after any markers: two characters that stand together in a piece
    are in one class.  The ``most`` largest classes are told apart, the others make up one; a character that
    stands in no piece with another is a part.  Without all byte pieces neighbouring unknown characters are
    joined, so that texts are only cut where runs of markers start.
    """
    if not m["byte_fallback"] or sum(kind == BYTE for _, _, kind in m["pieces"]) < 256:
        return CUT
    pieces = [p for p, _, kind in m["pieces"] if m["kind"] == UNIGRAM or kind in (NORMAL, USER)]
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for p in pieces:
        p = p.lstrip(MARK)
        if MARK in p:
            return CUT
        for a, b in zip(p, p[1:]):
            root[find(a)] = find(b)
    classes = defaultdict(list)
    for c in root:
        classes[find(c)].append(c)
    large = sorted(classes.values(), key=lambda x: (-len(x), min(x)))
    large = [*large[:most], list(chain.from_iterable(large[most:]))]
    runs = [f"[{''.join(map(re.escape, x))}]+" for x in large if x]
    return re.compile(f"{MARK}*(?:{'|'.join([*runs, f'[^{MARK}]'])})|{MARK}+", re.DOTALL).findall


class _Ids(dict):
    """Little-endian ids of parts, found when they are first asked for, or when they are not among ``older``."""

    def __init__(self, found, older: dict[str, bytes]):
        self.found, self.older, self.used = found, older, 0

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("i", self.found(part)).tobytes()
        self[part] = ids
        self.used += len(part) + len(ids) + 200  # two objects and an entry
        return ids


_built: dict[str, object] = {}


class Codec:
    """Encodes whole texts, and compares each one's ids with the text and with the SentencePiece library's.

    Where no merge crosses the start of a run of blanks the tokenizer sees every distinct part (``parts_of``)
    once while it is known, and the ids of a text are joined from those of its parts.  About ``room`` bytes of
    them are kept: those asked for since half as much was, and those that were kept before.  Texts over ``longest`` characters are taken in segments that end where a cut does, so that the
    libraries' tables follow the segment and not the text; shorter texts are one segment.
    """

    def __init__(self, data: bytes, verify: bool, longest: int = 1 << 20, room: int = 64 << 20):
        m = parse_model(data)
        self.tokenizer, self.longest, self.room, self.library = build_tokenizer(data), longest, room, None
        self.cuts = m["dummy_prefix"] and not m["squeeze"] and not m["charsmap"] and self.tokenizer.pre_tokenizer is not None
        if self.cuts:  # cuts are normalised already, and bring their first blank along: the dummy prefix or the text's
            self.tokenizer.normalizer = self.tokenizer.pre_tokenizer = None
        self.parts, self.model = parts_of(m), self.tokenizer.model
        self.blank = "" if self.cuts or not m["dummy_prefix"] else " "
        # what each id stands for, as bytes: byte pieces join to characters
        self.surface = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in m["pieces"]]
        self.known = _Ids(self.alone, {})
        if verify:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=data)

    def segments(self, text: str) -> list[str]:
        if not self.cuts:
            return [text] if text else []
        out, at, padded = [], 0, f" {text}" if text else ""
        while len(padded) - at > self.longest and (found := STARTS.search(padded, at + self.longest)):
            out.append(padded[at : found.start()])
            at = found.start()
        return [*out, padded[at:]] if padded else []

    def alone(self, text: str) -> list[int]:
        # a part is normalised and no longer divided: the model alone has its say
        return [x.id for x in self.model.tokenize(text)]

    def joined(self, segments: list[str]) -> list[bytes]:
        """Little-endian ids of segments, from those of their parts."""
        out = []
        for x in segments:
            if self.known.used > self.room // 2:
                self.known.older = {}
                self.known = _Ids(self.alone, self.known)
            out.append(b"".join(map(self.known.__getitem__, self.parts(x.replace(" ", MARK)))))
        return out

    def forget(self) -> None:
        """Drops the kept parts."""
        self.known = _Ids(self.alone, {})
        trim()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[bool | None]]:
        """Little-endian ids, round_trip and parity (None without the library) of every text."""
        cut = [self.segments(t) for t in texts]
        flat = [x for xs in cut for x in xs]
        raw = self.joined(flat) if self.cuts else [array("i", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(flat, add_special_tokens=False)]
        numbers = [np.frombuffer(x, "<i4").tolist() for x in raw]
        back = [b"".join(map(self.surface.__getitem__, i)) == (self.blank + x).encode() for i, x in zip(numbers, flat, strict=True)]
        same = [None] * len(flat)
        if self.library:
            theirs = self.library.encode([x[1:] for x in flat] if self.cuts else flat, num_threads=1)
            same = [x == i for x, i in zip(theirs, numbers, strict=True)]
        out, round_trip, parity, at = [], [], [], 0
        for xs in cut:
            end = at + len(xs)
            out.append(b"".join(raw[at:end]))
            round_trip.append(all(back[at:end]))
            parity.append(all(same[at:end]) if self.library else None)
            at = end
        return out, round_trip, parity


def _codec(data: bytes, verify: bool, threads: int = 2) -> Codec:
    """One per Python worker and model; the library's thread pool starts with the first."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    key = hashlib.sha256(data).hexdigest() + str(verify)
    if key not in _built:
        _built[key] = Codec(data, verify)
    return _built[key]


def encoded(docs: DataFrame, model_file: str, verify: bool = False, threads: int = 2, keep: bool = False) -> DataFrame:
    """doc_id, ids array<int>, round_trip boolean, parity boolean (null unless verify) for every row.

    round_trip: what the ids stand for is the text.  parity: the SentencePiece library gives the same ids
    for the text.  threads: of the tokenizers library, per task.  keep: a Python worker keeps its parts (about
    64 MB) for its next task, which is faster; without it other operators get that memory back.
    """
    bounded_batches(docs.sparkSession)
    with open(model_file, "rb") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)  # one vocabulary: its size is the model file's

    def run(batches):
        codec = _codec(shared.value, verify, threads)
        try:
            for batch in batches:
                at = 0
                for part in pieces(batch.column("t"), 1 << 18):
                    ids, round_trip, same = codec.encode(part.to_pylist())
                    ends, values = np.cumsum([0, *map(len, ids)]) // 4, pa.array(np.frombuffer(b"".join(ids), "<i4"))
                    columns = [batch.column("doc_id").slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(round_trip, pa.bool_()), pa.array(same, pa.bool_())]
                    at += len(part)
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "round_trip", "parity"])
        finally:
            if keep:
                trim()
            else:
                codec.forget()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, round_trip boolean, parity boolean")


def decoded(tokens: DataFrame, model_file: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    bounded_batches(tokens.sparkSession)
    with open(model_file, "rb") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        t = _codec(shared.value, False).tokenizer
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": t.decode_batch([[] if x is None else list(x) for x in pdf["ids"]], skip_special_tokens=False)})

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInPandas(run, "doc_id long, text string")
