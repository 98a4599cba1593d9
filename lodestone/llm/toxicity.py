"""Toxicity: a linear-chain conditional random field over words.

Words are runs of letters, lower-cased.  Token labels come from document labels: a word (or
the beginning of inflected words) that is far more frequent in toxic training documents than in others is
an offending token in toxic documents, and all other tokens are ordinary; every window of every
sampled document is learned from.  The CRF (two labels) has
weights for the word itself, its beginnings and its end, the words beside it, and label transitions; it is trained on windows of 32 words by
Adagrad on the exact log-likelihood.

Inference runs forward-backward over every whole document.  With two labels the messages are ratios, so
a step is a handful of vector operations over all documents of a batch that are long enough.  The
marginals give a document's expected number of offending words and its largest marginal; a logistic of
both is its score.  ``spans`` gives the offsets of the words whose marginal is over one half.

Nulls and ties: null and empty texts have no words and the score of that; rows are scored one by one,
so repeated rows get the same score; a null doc_id is kept.  Without labelled rows of both kinds the
score is 0.  An empty table gives an empty result; other columns are ignored by ``scored``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, pieces, trim, whole_text
from lodestone.llm.labelled import remainder, training_sample

WORD = re.compile(r"[^\W\d_]+")
SLOTS, WINDOW, OWN = 1 << 20, 32, 8  # hashed weights, words in a training window, features of the word itself


KIND = [zlib.crc32(x) for x in (b"w ", b"s ", b"p ", b"l ", b"r ")]  # each kind of feature starts its hash


def slots_of(word: str) -> list[int]:
    """Hashed features of a word: itself, its end and its beginnings; as left and as right neighbour."""
    whole, crc = word.encode("utf-8", "surrogatepass"), zlib.crc32
    if len(whole) == len(word):
        end, starts = whole[-3:], [whole[:k] for k in range(3, 9)]
    else:
        end, *starts = (x.encode("utf-8", "surrogatepass") for x in (word[-3:], *(word[:k] for k in range(3, 9))))
    w, s, p, left, right = KIND
    return [x % SLOTS for x in (crc(whole, w), crc(end, s), *[crc(x, p) for x in starts], crc(whole, left), crc(whole, right))]


class Chain:
    """Feature scores by word as it is written, learned as they come, and the recursions."""

    def __init__(self, model: dict, most: int = 100_000):
        self.model, self.most = model, most
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, 3))

    def codes(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > max(self.most, len(new)):
            self.known.clear()
            new = list(set(words))
        if new:
            at = len(self.known)
            while len(self.scores) < at + len(new):
                self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
            f = self.model["weights"][np.array([slots_of(w.lower()) for w in new])]
            self.scores[at : at + len(new)] = np.stack([f[:, :OWN].sum(1), f[:, OWN], f[:, OWN + 1]], 1)
            self.known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def emissions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of the offending label by token, and tokens by text."""
        lists = [WORD.findall(t) for t in texts]  # each distinct word is lower-cased once
        n = np.array([len(x) for x in lists], np.int64)
        s = self.scores[:0] if not n.sum() else None
        if s is None:
            c = self.codes([w for x in lists for w in x])
            s = self.scores[c]
        ends = np.cumsum(n)
        e = s[:, 0] + self.model["bias"]
        if len(e):
            left, right = np.zeros(len(e)), np.zeros(len(e))
            left[1:], right[:-1] = s[:-1, 1], s[1:, 2]
            left[(ends - n)[n > 0]] = 0
            right[(ends - 1)[n > 0]] = 0
            e = e + left + right
        return np.clip(e, -30, 30), n

    def marginals(self, e: np.ndarray, n: np.ndarray) -> np.ndarray:
        """P(offending) of every token by forward-backward."""
        t00, t01, t10, t11 = np.exp(self.model["transitions"])
        order = np.argsort(-n, kind="stable")
        starts, lengths = (np.cumsum(n) - n)[order], n[order]
        x = np.exp(e)
        forward, backward = np.empty_like(x), np.ones_like(x)
        longest = int(lengths[0]) if len(lengths) else 0
        alive = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")  # texts with more than t words
        ratio = np.empty(0)
        for t in range(longest):
            at = starts[: alive[t]] + t
            ratio = x[at] if t == 0 else x[at] * (ratio[: alive[t]] * t11 + t01) / (ratio[: alive[t]] * t10 + t00)
            forward[at] = ratio
        for t in range(longest - 2, -1, -1):
            at = starts[: alive[t + 1]] + t
            m = x[at + 1] * backward[at + 1]
            backward[at] = (t10 + t11 * m) / (t00 + t01 * m)
        both = forward * backward
        return both / (1 + both)

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Expected number and largest marginal by text, all marginals, tokens by text."""
        e, n = self.emissions(texts)
        p = self.marginals(e, n)
        total, top = np.zeros(len(n)), np.zeros(len(n))
        has = n > 0
        if has.any():
            s = (np.cumsum(n) - n)[has]
            total[has], top[has] = np.add.reduceat(p, s), np.maximum.reduceat(p, s)
        return total, top, p, n

    def score(self, total: np.ndarray, top: np.ndarray) -> np.ndarray:
        a = self.model["logistic"]
        return 1 / (1 + np.exp(-np.clip(a[0] + a[1] * np.log1p(total) + a[2] * top, -30, 30)))


def words_of(text: str) -> list[str]:
    """The words of a text, lower-cased one by one: as many, and in the same places, as in the text itself."""
    return [w.lower() for w in WORD.findall(text)]


def beginnings(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in range(4, 9) if len(word) > k)]


def offending(texts: list[str], labels: list[int], share: float = 0.03, ratio: float = 9) -> set[str]:
    """Words and beginnings of words that mark toxic documents: in at least that share of them, and there so many times as
    frequent among all words as elsewhere.  Occurrences are compared, for a clean document may hold one by chance."""

    def counted(y: int, only: set[str] | None) -> tuple[Counter, Counter, int]:
        documents, times, words = Counter(), Counter(), 0
        for t, label in zip(texts, labels, strict=True):
            if label == y:
                found = Counter()
                for w, n in Counter(words_of(t)).items():
                    words += n
                    for b in beginnings(w):
                        if only is None or b in only:
                            found[b] += n
                documents.update(found.keys())
                times.update(found)
        return documents, times, words

    # only what is frequent in toxic documents is counted in the others
    documents, times, words = counted(1, None)
    often = {w for w, c in documents.items() if c >= max(3, share * labels.count(1))}
    _, elsewhere, others = counted(0, often)
    return {w for w in often if times[w] * others >= ratio * (elsewhere[w] + 0.5) * words}


def train(texts: list[str], labels: list[int], epochs: int = 6, seed: int = 5, folds: int = 2) -> dict | None:
    """CRF weights of all documents and the document logistic; None without both labels.

    The logistic is fitted on every document as a CRF of the other folds sees it, for a CRF is surer of what
    it has learned from.  Where a fold lacks a label, the CRF of all documents is used for it.
    """
    if len(set(labels)) < 2:
        return None
    chain = chain_weights(texts, labels, epochs, seed)
    part = lambda keep: ([x for i, x in enumerate(texts) if keep(i)], [y for i, y in enumerate(labels) if keep(i)])
    seen = []
    for k in range(min(folds, len(texts))):
        others, held = part(lambda i, k=k: i % folds != k), part(lambda i, k=k: i % folds == k)
        model = chain_weights(*others, epochs, seed) if len(set(others[1])) == 2 else chain
        seen.append((*observed(model, held[0]), held[1]))
    return chain | {"logistic": logistic(*(np.concatenate(x) for x in zip(*seen, strict=True)))}


def observed(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Expected number of offending words and largest marginal of each text."""
    chain = Chain(model, 100_000)
    parts = [chain.documents(texts[i : i + 100])[:2] for i in range(0, len(texts), 100)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def logistic(total: np.ndarray, top: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a document's label by its expected number of offending words and its largest marginal."""
    z, y, w = np.stack([np.ones(len(total)), np.log1p(total), top], 1), labels.astype(float), np.zeros(3)
    for _ in range(30):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w - np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 1e-2 * np.eye(3), z.T @ (p - y) + 1e-2 * w)
    return w


def chain_weights(texts: list[str], labels: list[int], epochs: int, seed: int) -> dict:
    """The CRF: hashed weights, bias and transitions."""
    marked, rng = offending(texts, labels), np.random.default_rng(seed)
    known: dict[str, int] = {}
    codes = [np.fromiter((known.setdefault(w, len(known)) for w in words_of(t)), np.int32) for t in texts]
    offends = np.array([not marked.isdisjoint(beginnings(w)) for w in known], bool)
    # one more word, without features, fills the last window of each document
    words, tags = [], []
    for c, y in zip(codes, labels, strict=True):
        words.append(np.pad(c, (0, -len(c) % WINDOW), constant_values=len(known)).reshape(-1, WINDOW))
        tags.append(np.pad(offends[c] & bool(y), (0, -len(c) % WINDOW)).reshape(-1, WINDOW))
    words, tags = np.concatenate(words), np.concatenate(tags)
    b, live = len(words), words < len(known)
    # hashed features in use, numbered: the weights of a step are as many as these
    slots = np.empty((len(known), OWN + 2), np.int32)
    for i, w in enumerate(known):
        slots[i] = slots_of(w)
    used, table = np.unique(slots, return_inverse=True)
    size = len(used)
    table = np.vstack([table.reshape(-1, OWN + 2), np.full(OWN + 2, size)]).astype(np.int32)
    del codes, known, slots

    def features(rows: np.ndarray) -> np.ndarray:
        f = table[words[rows]]
        f[:, 1:, OWN], f[:, :-1, OWN + 1] = f[:, :-1, OWN].copy(), f[:, 1:, OWN + 1].copy()
        f[:, 0, OWN] = f[:, -1, OWN + 1] = size
        f[~live[rows]] = size
        return f

    weights, bias, trans = np.zeros(size + 1), -2.0, np.array([0.0, -1.0, 0.0, -1.0])
    sums, tsum, bsum = np.full(size + 1, 1e-6), np.full(4, 1e-6), 1e-6
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(b), max(1, b // 256)):
            f, y, on = features(rows), tags[rows].astype(float), live[rows]
            e = np.where(on, np.clip(weights[f].sum(2) + bias, -30, 30), 0)
            t00, t01, t10, t11 = np.exp(trans)
            x, fw, bw = np.exp(e), np.ones_like(e), np.ones_like(e)
            fw[:, 0] = x[:, 0]
            for t in range(1, WINDOW):
                fw[:, t] = x[:, t] * (fw[:, t - 1] * t11 + t01) / (fw[:, t - 1] * t10 + t00)
            for t in range(WINDOW - 2, -1, -1):
                m = x[:, t + 1] * bw[:, t + 1]
                bw[:, t] = np.where(on[:, t + 1], (t10 + t11 * m) / (t00 + t01 * m), 1.0)
            p = fw * bw / (1 + fw * bw)
            d = np.where(on, p - y, 0) / len(rows)
            g = np.bincount(f.ravel(), np.repeat(d.ravel(), OWN + 2), size + 1)
            g[size] = 0
            sums += g * g
            weights -= 0.5 * g / np.sqrt(sums)
            bsum += d.sum() ** 2
            bias -= 0.2 * d.sum() / np.sqrt(bsum)
            # pair marginals from the forward ratio before and the message behind
            r0 = fw[:, :-1] / (1 + fw[:, :-1])
            m1 = x[:, 1:] * bw[:, 1:]
            q = np.stack([(1 - r0) * t00, (1 - r0) * t01 * m1, r0 * t10, r0 * t11 * m1])
            q /= q.sum(0)
            a, c = y[:, :-1], y[:, 1:]
            seen = np.stack([(1 - a) * (1 - c), (1 - a) * c, a * (1 - c), a * c])
            gt = ((q - seen) * on[:, 1:]).sum((1, 2)) / len(rows)
            tsum += gt * gt
            trans = trans - 0.2 * gt / np.sqrt(tsum)
    every = np.zeros(SLOTS, np.float32)
    every[used] = weights[:size]
    return {"weights": every, "bias": float(bias), "transitions": trans}


def scored(docs: DataFrame, model: dict | None, threshold: float = 0.3, chunk: int = 1 << 21) -> DataFrame:
    """doc_id, score, predicted, spans (start, end, probability) for every row; code point offsets."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the hashed weights: a fixed number of slots

    def run(batches):
        chain = Chain(shared.value) if shared.value else None
        for batch in batches:
            texts = batch.column("t").to_pylist()
            out, at, size = [], 0, 0
            for i in range(len(texts)):
                size += len(texts[i])
                if size >= chunk or i + 1 == len(texts):
                    out.append(_score(chain, texts[at : i + 1]))
                    at, size = i + 1, 0
            s = np.concatenate([x[0] for x in out]) if out else np.zeros(0)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
            spans = pa.array([y for x in out for y in x[1]], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), spans], ["doc_id", "score", "predicted", "spans"])
        del chain
        trim()

    schema = "doc_id long, score double, predicted int, spans array<struct<start:int,end:int,probability:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t")).mapInArrow(run, schema)


def _score(chain: Chain | None, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
    if chain is None:
        return np.zeros(len(texts)), [[] for _ in texts]
    total, top, p, n = chain.documents(texts)
    ends, spans = np.cumsum(n), [[] for _ in texts]
    for i in np.nonzero(top > 0.5)[0]:
        own = p[ends[i] - n[i] : ends[i]]
        spans[i] = [{"start": m.start(), "end": m.end(), "probability": float(x)} for m, x in zip(WORD.finditer(texts[i]), own, strict=True) if x > 0.5]
    return chain.score(total, top), spans


def without_toxic(docs: DataFrame, model: dict | None, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score below the threshold, with all columns, in one pass."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        chain = Chain(shared.value) if shared.value else None
        for batch in batches:
            at = 0
            for part in pieces(pc.fill_null(batch.column("text"), "")):
                keep = _score(chain, part.to_pylist())[0] < threshold
                yield batch.slice(at, len(keep)).filter(pa.array(keep))
                at += len(keep)
        del chain
        trim()

    return docs.mapInArrow(run, docs.schema)


def fitted(docs: DataFrame, labels: DataFrame, most: int = 4000, room: int = 32 << 20) -> dict | None:
    """A model from at most ``most`` labelled documents, ``room`` bytes, whose crc32 mod 4 is not 2."""
    return train(*training_sample(docs, labels, "toxic", remainder(4) != 2, most, room))


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end of offending words, code points, comma-joined).

    Rows whose crc32 mod 4 is 2 are held out of training.
    """
    out = scored(docs, fitted(docs, labels, most))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return out.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", "predicted", spans.alias("spans"))
