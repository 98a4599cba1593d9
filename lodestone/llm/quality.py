"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages of 512 bytes of its UTF-8, the last one shorter.  Each passage is
described by what kinds of bytes it has, hashed byte pairs, and how many of its byte quadruples are
distinct; a small tanh layer encodes it.  Gated attention (tanh x sigmoid) learns from document labels
alone which passages count; the score is a logistic of the attention-weighted mean passage.

The model is trained in numpy on a bounded sample (``most`` rows, ``room`` bytes of text) of labelled
documents and sent to the tasks (a few kilobytes); every passage of every document is scored there, batch by batch.

Nulls and ties: null and empty texts have one passage without bytes and so a score like any other;
rows are scored one by one, so repeated rows get the same score; a null doc_id is kept.  Without
labelled rows the score is 0.5.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, whole_text
from lodestone.llm.labelled import remainder, training_sample

PASSAGE, PAIRS, RUNS = 512, 64, 256
SIGNS = "!$%&*#|.,;:?'\"()-_/=@<>"
KINDS = 8 + len(SIGNS)


def _kinds() -> np.ndarray:
    table = np.full(256, 7, np.int64)  # other ASCII
    for c in range(256):
        ch = chr(c)
        if c >= 128:
            table[c] = 0
        elif "a" <= ch <= "z":
            table[c] = 1
        elif "A" <= ch <= "Z":
            table[c] = 2
        elif ch.isdigit():
            table[c] = 3
        elif ch == " ":
            table[c] = 4
        elif ch == "\n":
            table[c] = 5
        elif c < 32:
            table[c] = 6
        elif ch in SIGNS:
            table[c] = 8 + SIGNS.index(ch)
    return table


BY_KIND = np.eye(KINDS)[_kinds()]


def _counted(values: np.ndarray, ok: np.ndarray, bins: int) -> np.ndarray:
    """How often each value below ``bins`` is in each row where ok."""
    total = len(values)
    at = np.add(values, (np.arange(total) * bins)[:, None], dtype=np.int64)
    at[~ok] = total * bins  # a bin of its own
    return np.bincount(at.ravel(), minlength=total * bins + 1)[: total * bins].reshape(total, bins)


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the number of passages of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    n = np.maximum(1, -(-size // PASSAGE))
    used = np.full(n.sum(), PASSAGE, np.int64)
    used[np.cumsum(n) - 1] = size - (n - 1) * PASSAGE
    x = np.frombuffer(b"".join(r.ljust(k * PASSAGE, b"\0") for r, k in zip(raw, n.tolist(), strict=True)), np.uint8).reshape(-1, PASSAGE)
    ok = np.arange(PASSAGE) < used[:, None]
    kinds = _counted(x, ok, 256) @ BY_KIND
    two = x.astype(np.uint16)
    pairs = _counted((two[:, :-1] * np.uint16(37) + two[:, 1:] * np.uint16(101) >> np.uint16(2)) & np.uint16(PAIRS - 1), ok[:, 1:], PAIRS)
    # four bytes in a row, multiplied and cut to the top bits
    four = x.astype(np.uint32)
    four = four[:, :-3] | four[:, 1:-2] << np.uint32(8) | four[:, 2:-1] << np.uint32(16) | four[:, 3:] << np.uint32(24)
    runs = _counted(four * np.uint32(2654435761) >> np.uint32(24), ok[:, 3:], RUNS)
    size = np.maximum(used, 1)[:, None]
    spread = (runs > 0).sum(1, keepdims=True) / np.minimum(RUNS, np.maximum(used - 3, 1))[:, None]
    peak = runs.max(1, keepdims=True) / size
    return np.hstack([kinds / size, pairs / size, spread, peak, np.log1p(used)[:, None] / 6]), n


def _forward(m: dict, x: np.ndarray, n: np.ndarray):
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    h = np.tanh((x - m["mean"]) / m["std"] @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * g) @ m["w"]
    e -= np.repeat(np.maximum.reduceat(e, starts), n)
    a = np.exp(e)
    a /= np.repeat(np.add.reduceat(a, starts), n)
    z = np.add.reduceat(a[:, None] * h, starts)
    return h, t, g, a, z, 1 / (1 + np.exp(-np.clip(z @ m["c"] + m["d"], -30, 30))), starts


def train(texts: list[str], labels: list[int], hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 64, seed: int = 11) -> dict | None:
    """Model parameters by Adam on the document log-loss; None without both labels."""
    if len(set(labels)) < 2:
        return None
    parts = [(f.astype(np.float32), k) for f, k in (passages(texts[i : i + 100]) for i in range(0, len(texts), 100))]
    n = np.concatenate([k for _, k in parts])
    x = np.concatenate([f for f, _ in parts])
    del parts
    y, rng = np.array(labels, float), np.random.default_rng(seed)
    mean, std = x.mean(0, dtype=float), x.std(0, dtype=float) + 1e-3
    d = x.shape[1]
    m = {"W": rng.normal(0, d**-0.5, (d, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, 0.2, (hidden, gate)), "U": rng.normal(0, 0.2, (hidden, gate)), "w": rng.normal(0, 0.2, gate), "c": rng.normal(0, 0.2, hidden), "d": np.array(0.0)}
    fixed = {"mean": mean, "std": std}
    first, second, step = {k: 0 * v for k, v in m.items()}, {k: 0 * v for k, v in m.items()}, 0
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    for epoch in range(epochs):
        order, rate = rng.permutation(len(y)), 0.01 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(y), batch):
            docs = order[at : at + batch]
            rows = np.concatenate([np.arange(starts[i], starts[i] + n[i]) for i in docs])
            xs, ns = (x[rows] - mean) / std, n[docs]
            h, t, g, a, z, p, _ = _forward(m | fixed, x[rows], ns)
            ds = (p - y[docs]) / len(docs)
            dz = ds[:, None] * m["c"]
            dzr = np.repeat(dz, ns, 0)
            da = (dzr * h).sum(1)
            s = np.concatenate([[0], np.cumsum(ns)[:-1]])
            de = a * (da - np.repeat(np.add.reduceat(a * da, s), ns))
            dt, dg = de[:, None] * m["w"] * g * (1 - t * t), de[:, None] * m["w"] * t * g * (1 - g)
            dh = (a[:, None] * dzr + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
            grad = {"W": xs.T @ dh + 1e-4 * m["W"], "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": ((t * g) * de[:, None]).sum(0), "c": z.T @ ds + 1e-4 * m["c"], "d": ds.sum()}
            step += 1
            for k, v in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                m[k] = m[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return m | fixed


def score(model: dict | None, texts: list[str]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    x, n = passages(texts)
    return _forward(model, x, n)[5]


def scored(docs: DataFrame, model: dict | None, threshold: float = 0.3, chunk: int = 1 << 20) -> DataFrame:
    """doc_id, score, predicted for every row; chunk: characters of text worked on at once."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts, out, at, size = batch.column("t").to_pylist(), [], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= chunk:
                    out.append(score(shared.value, texts[at : i + 1]))
                    at, size = i + 1, 0
            out.append(score(shared.value, texts[at:]))
            s = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t")).mapInArrow(run, "doc_id long, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = 4000, room: int = 64 << 20) -> DataFrame:
    """doc_id, held_out, score, predicted; rows whose crc32 mod 5 is 0 are held out of training."""
    model = train(*training_sample(docs, labels, "quality", remainder(5) != 0, most, room))
    return scored(docs, model).select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")
