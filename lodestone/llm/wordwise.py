"""Texts cut at blanks into chunks that a tokenizer encodes apart, each distinct one once.

A chunk starts where a blank follows a character that is no white space, and at the start of a text.
Regular expressions of pre-tokenizers and word markers never reach over such a place, so that the
tokens of a text are those of its chunks in order; the operators that rely on it say why and check it.
Chunks are ranges of one buffer: no Python object is made for a word that is known already.

Where the pre-tokenizer is that of a word vocabulary, which drops white space, chunks of ASCII and
precomposed Latin letters are cut further, into the very parts that the model sees (``word_parts``).
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from lodestone.llm.common import trim

BLANK = 0x20


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the places where its texts start and the last one ends."""
    texts = texts.cast(pa.large_string())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def chunk_starts(data: np.ndarray, starts: np.ndarray, white: np.ndarray | None = None) -> np.ndarray:
    """Places where chunks start and the last one ends; texts without bytes have no chunk.

    white: which bytes count as blanks, if not only the blank itself does.
    A three-byte character that begins with E1, E2 or E3 may be white space, so that none starts behind one.
    """
    at = np.flatnonzero(data == BLANK if white is None else white)
    at = at[at > 0]
    before = data[at - 1]
    wide = (before >= 0x80) & (np.isin(data[np.maximum(at - 3, 0)], (0xE1, 0xE2, 0xE3)) | (data[np.maximum(at - 2, 0)] == 0xC2))
    at = at[(before > BLANK) & (before != 0x7F) & ~wide]
    mark = np.zeros(len(data) + 1, bool)
    mark[at] = mark[starts] = True
    return np.flatnonzero(mark)


def chunk_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The chunks as a binary column over the same bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... lengths[i] of them, one after another for every i."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


class Growing:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.values, self.n = np.empty(1 << 12, dtype), 0

    def extend(self, new: np.ndarray) -> None:
        if self.n + len(new) > len(self.values):
            more = np.empty(max(2 * len(self.values), self.n + len(new)), self.values.dtype)
            more[: self.n] = self.values[: self.n]
            self.values = more
        self.values[self.n : self.n + len(new)] = new
        self.n += len(new)

    @property
    def all(self) -> np.ndarray:
        return self.values[: self.n]


class Known:
    """Numbers distinct chunks and keeps what ``learn`` returns for them: columns, one value a chunk, and lists.

    learn takes a list of new chunks (bytes) and returns {name: array} and {name: (values, lengths)}.
    Beyond ``room`` bytes of chunks and lists all are forgotten, so memory follows no vocabulary of a corpus.
    """

    def __init__(self, learn: Callable, room: int = 48 << 20):
        self.learn, self.room = learn, room
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.columns: dict[str, Growing] = {}
        self.lists: dict[str, tuple[Growing, Growing]] = {}
        self.used = 0
        trim()

    def take(self, chunks: list[bytes]) -> np.ndarray:
        """The numbers of distinct chunks; new ones are learnt."""
        if self.used > self.room:
            self.forget()
        numbers = self.numbers
        get, first_new = numbers.get, len(numbers)
        found = np.fromiter([get(c, -1) for c in chunks], np.int64, len(chunks))
        unknown = np.flatnonzero(found < 0)
        new = [chunks[i] for i in unknown.tolist()]
        for i in range(0, len(new), 4096):  # encodings take kilobytes each until they are read
            part = new[i : i + 4096]
            columns, lists = self.learn(part)
            first = len(numbers)
            numbers.update(zip(part, range(first, first + len(part)), strict=True))
            for name, values in columns.items():
                self.columns.setdefault(name, Growing(values.dtype)).extend(values)
            for name, (values, lengths) in lists.items():
                kept, ends = self.lists.setdefault(name, (Growing(values.dtype), Growing(np.int64)))
                ends.extend(kept.n + np.cumsum(lengths))
                kept.extend(values)
                self.used += values.nbytes
            self.used += sum(map(len, part)) + 200 * len(part)
        found[unknown] = np.arange(first_new, first_new + len(new))
        return found

    def column(self, name: str, numbers: np.ndarray) -> np.ndarray:
        return self.columns[name].all[numbers]

    def listed(self, name: str, numbers: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The lists of chunks one after another, and their lengths; with codes, those of numbers[codes]."""
        values, ends = self.lists[name]
        ends = ends.all
        starts = np.where(numbers > 0, ends[np.maximum(numbers - 1, 0)], 0)
        lengths = ends[numbers] - starts
        if codes is not None:
            starts, lengths = starts[codes], lengths[codes]
        return values.all[ranges(starts, lengths)], lengths


def kept(key: str, make: Callable):
    """What a Python worker keeps for its next task, one thing at a time.

    Functions that travel by value bring new globals to each task, so it hangs on a module of its own.
    """
    store = vars(sys.modules.setdefault("lodestone_worker", types.ModuleType("lodestone_worker")))
    if key not in store:
        for old in [k for k in store if k.startswith("kept-")]:
            del store[old]
        trim()
        store[key] = make()
    return store[key]


def chunked(texts: pa.Array, known: Known, cut: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a column of texts: numbers of its distinct chunks, for every chunk its place among them,
    and the first chunk of every text and the end of the last; the bytes of the chunks.

    cut: gives data, starts and bounds of other chunks than ``chunk_starts``, as ``word_parts`` does.
    """
    data, starts = buffers(texts)
    data, starts, bounds = cut(data, starts) if cut else (data, starts, chunk_starts(data, starts))
    if len(bounds) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(starts), np.int64), np.empty(0, np.int64)
    coded = chunk_array(data, bounds).dictionary_encode()
    _, ends, raw = coded.dictionary.buffers()
    ends, raw = np.frombuffer(ends, np.int64)[: len(coded.dictionary) + 1], raw.to_pybytes()
    at = ends.tolist()
    distinct = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]  # much faster than to_pylist
    return known.take(distinct), coded.indices.to_numpy(), np.searchsorted(bounds, starts), np.diff(ends)


# Letters that the short way takes: ASCII and precomposed Latin, which normal form C leaves as they are.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# Fixed value: the pattern of the byte-level pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # that of a word vocabulary, after lower-casing
LONE = re.compile(f"(?:(?!\u0130)[{LETTERS}])+|[0-9]|(?:(?!<\\|)[!-/:-@[-`{{-~])+|'(?:[stmd]|re|ve|ll)").fullmatch  # one part for certain
SIMPLE = re.compile(f"(?:(?!<\\||\u0130)[ -~{LETTERS[6:]}])*").fullmatch  # no start of a special token, no I with a dot


# Kinds of bytes for ``word_parts``: white space, digits, letters (and all bytes of two-byte letters), odd ones, others.
WHITE, DIGIT, LETTER, ODD, MARK = range(5)


def _kinds() -> bytes:
    kinds = np.full(256, ODD, np.uint8)
    kinds[0x21:0x7F] = MARK
    kinds[[*b" \t\n\v\f\r"]] = WHITE
    kinds[0x30:0x3A] = DIGIT
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
    return kinds.tobytes()


KINDS = _kinds()
SMALL = bytes(b + 32 if 0x41 <= b < 0x5B else b for b in range(256))


def word_parts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lower-cased and without white space, the places where texts start and the last one ends,
    and those where the parts do that ``WORD_LEVEL`` finds.  Chunks with other characters than ASCII and Latin letters, or
    with what may begin a special token, stay whole and as they are; ``Words.parts_flat`` knows them by their bytes.
    """
    n, raw = len(data), data.tobytes()
    if not n:
        return data, starts, starts[-1:]
    kinds, small = (np.frombuffer(raw.translate(x), np.uint8) for x in (KINDS, SMALL))  # faster than by index
    begins = np.zeros(n + 2, bool)
    begins[starts] = True
    mark = np.zeros(n + 1, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=mark[1:n])
    mark |= begins[:-1]
    mark[:n] |= kinds == DIGIT
    # an apostrophe by itself takes the letters of a short form along
    at = np.flatnonzero(data[:-1] == 0x27)
    at = at[(kinds[at + 1] == LETTER) & ~begins[at + 1] & mark[at]]
    second, third = small[at + 1], np.where(begins[at + 2], 0, small[np.minimum(at + 2, n - 1)])
    one = np.isin(second, [*b"stmd"])
    two = (np.isin(second, [*b"rv"]) & (third == ord("e"))) | ((second == ord("l")) & (third == ord("l")))
    mark[at[one | two] + 1] = False
    mark[at[one] + 2] = mark[at[two] + 3] = True
    odd, keep = kinds == ODD, kinds != WHITE
    at = np.flatnonzero(data[:-1] == ord("<"))
    odd[at[(data[at + 1] == ord("|")) & ~begins[at + 1]]] = True
    at = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    lead, next_ = data[at], data[at + 1]  # the signs of times and division, the I with a dot, letters from U+0250 on
    odd[at[((lead == 0xC3) & ((next_ == 0x97) | (next_ == 0xB7))) | ((lead == 0xC4) & (next_ == 0xB0)) | ((lead == 0xC9) & (next_ >= 0x90))]] = True
    if odd.any():
        chunks = chunk_starts(data, starts, ~keep)
        whole = np.logical_or.reduceat(odd, chunks[:-1])
        inside = np.repeat(whole, np.diff(chunks))
        mark[:n] &= ~inside
        mark[chunks[:-1][whole]] = mark[chunks[1:][whole]] = True
        keep |= inside
        small = np.where(inside, data, small)
    gone = np.flatnonzero(~keep)
    bounds = np.append(np.flatnonzero(mark[:n][keep]), n - len(gone))
    return small[keep], starts - np.searchsorted(gone, starts), bounds


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where Latin-1 prints it, else one from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)}


class Words:
    """Ids of chunks by a tokenizers file.

    Chunks of ASCII and precomposed Latin letters are cut by the pre-tokenizer's own pattern here, and the model sees
    each distinct part once; all others, and those of files with another pre-tokenizer, go through the whole tokenizer.
    """

    def __init__(self, file: str, special: bool = True, room: int = 300_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.model, self.room, self.parts = Tokenizer.from_str(file), Tokenizer.from_str(file), room, {}
        self.tokenizer.encode_special_tokens = not special
        self.model.normalizer = self.model.pre_tokenizer = None
        about = json.loads(file)
        self.lower, find = False, None
        match about["normalizer"], about["pre_tokenizer"]:
            case None, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
                find = BYTE_LEVEL
            case {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "content": " "}, {"type": "Lowercase"}]}, {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "use_regex": False}]}:
                find, self.lower = pattern, True
        # parts of words are encoded many at once, apart by blanks
        vocab, suffix = about["model"]["vocab"], about["model"].get("end_of_word_suffix")
        self.by_parts = bool(
            self.lower
            and find == WORD_LEVEL
            and all(t["content"].startswith("<|") for t in about["added_tokens"])
            and suffix == "</w>"
            and all(c + suffix in vocab for c in byte_characters().values())
        )
        if self.by_parts:
            self.model.pre_tokenizer = WhitespaceSplit()
            self.last = np.zeros(1 + max(vocab.values()), bool)  # ids that end a part: no part spells the suffix itself, with its three kinds
            self.last[[k for x, k in vocab.items() if x.endswith(suffix)]] = True
        self.find = re.compile(find.replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9")).findall if find else None
        self.bytes = byte_characters()

    def packed(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of every chunk as little-endian unsigned 32-bit numbers."""
        texts = [c.decode() for c in chunks]
        if not self.find:
            return _raw(self.tokenizer, texts)
        if len(self.parts) > self.room:
            self.parts = {}
        simple = [t.isascii() and t.isprintable() and "<|" not in t or SIMPLE(t) is not None for t in texts]
        cut = [self.find(t.lower() if self.lower else t) if s else () for t, s in zip(texts, simple, strict=True)]
        if new := list({x for xs in cut for x in xs}.difference(self.parts)):
            self.parts.update(zip(new, _raw(self.model, [x.encode().decode("latin-1").translate(self.bytes) for x in new]), strict=True))
        part = self.parts.__getitem__
        rest = iter(_raw(self.tokenizer, [t for t, s in zip(texts, simple, strict=True) if not s]))
        return [(part(xs[0]) if len(xs) == 1 else b"".join(map(part, xs))) if s else next(rest) for xs, s in zip(cut, simple, strict=True)]

    def flat(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks one after another, and their numbers."""
        found = self.packed(chunks)
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


    @property
    def cut(self) -> Callable | None:
        """How ``chunked`` is to cut texts for ``parts_flat``."""
        return word_parts if self.by_parts else None

    def parts_flat(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``flat`` for the parts of ``cut``."""
        if not self.by_parts:
            return self.flat(parts)
        texts = [p.decode() for p in parts]
        lone = np.fromiter((LONE(t) is not None for t in texts), bool, len(texts))
        alone = [t if t.isascii() else t.lower().encode().decode("latin-1").translate(self.bytes) for t, x in zip(texts, lone.tolist(), strict=True) if x]
        ids = np.array(self.model.encode_batch_fast([" ".join(alone)], add_special_tokens=False)[0].ids, "<u4")
        lengths = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(alone) == len(texts):
            return ids, lengths
        others, other_lengths = flat([e.ids for e in self.tokenizer.encode_batch_fast([t for t, x in zip(texts, lone.tolist(), strict=True) if not x], add_special_tokens=False)], np.dtype("<u4"))
        both = np.empty(len(texts), np.int64)
        both[lone], both[~lone] = lengths, other_lengths
        values, first = np.empty(len(ids) + len(others), "<u4"), np.cumsum(both) - both
        values[ranges(first[lone], lengths)] = ids
        values[ranges(first[~lone], other_lengths)] = others
        return values, both


def _raw(tokenizer, texts: list[str]) -> list[bytes]:
    if not texts:
        return []
    values, lengths = flat([e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], np.dtype("<u4"))
    raw, ends = values.tobytes(), (4 * np.cumsum(lengths)).tolist()
    return [raw[p:q] for p, q in zip([0, *ends], ends, strict=False)]


def flat(lists: list[list[int]], dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists one after another, and their lengths."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype, int(lengths.sum())), lengths
