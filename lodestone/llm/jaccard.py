"""Near copies by the exact Jaccard similarity of their sets of k-word shingles.

Shingle sets: 64-bit hashes of the distinct k-word shingles; texts with equal sets are one node, named
by a hash of the set.  A pair with similarity of at least a/b shares at least ceil(a n / b) shingles,
for either one's size n, so in any order of all shingles the first n - ceil(a n / b) + 1 of both have
one in common: no pair is lost to the search.  The order puts shingles that are frequent in a sample
last, the others by their hash; it decides the cost, not the result.

Links: the SimHash of every set goes through the tables of ``covering`` first, which joins families of
near copies; each link is decided by the sets.  Then, in every bucket of the index (nodes with a
shingle in common among their first), members of other components than a pivot's meet it, first with
one pivot and then with three, and what is still apart meets pairwise.  Before sets are compared, pairs go whose sizes, whose parity bits
(256, one per shingle; they differ in no more bits than the sets do in shingles) or whose places of
common shingles exclude the similarity: after the last common one of the first shingles no more can be
common than what is left of the shorter rest.  A bucket whose members are all unlike costs the square
of its size in parity comparisons.  Links found later join the components known by then, so that
components are sought over the new links alone, and steps without pairs end at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bounded_batches, bounded_broadcast, checkpointed, compacted, counted, pieces, release, trim, whole_text
from lodestone.llm.components import components
from lodestone.llm.covering import links

PARITY = [f"b{i}" for i in range(4)]


def _spread(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted hashes of the distinct k-word shingles of texts; words are hashed once while they are known."""

    def __init__(self, k: int, most: int = 100_000):
        self.k, self.most, self.known = k, most, {}
        self.factors = _spread(np.arange(1, k + 2, dtype=np.uint64)) | np.uint64(1)

    def of(self, text: str) -> np.ndarray:
        # bytes are split at, and lower-cased in, ASCII alone
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        new = {w for w in words if w not in self.known}
        if len(self.known) + len(new) > max(self.most, len(new)):
            self.known.clear()
            new = set(words)
        for w in new:
            self.known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        x = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.k, len(x))
        with np.errstate(over="ignore"):
            h = self.factors[self.k] * np.uint64(width)
            for i in range(width):
                h = h + self.factors[i] * x[i : len(x) - width + 1 + i]
        return np.unique(_spread(h))


def _simhash(s: np.ndarray) -> int:
    """Each shingle's hash votes on 64 bits."""
    votes = np.unpackbits(s.view(np.uint8).reshape(len(s), 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(s)).view(np.int64)[0])


def _name(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parity(s: np.ndarray) -> list[int]:
    bits = np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


def _frequent(docs: DataFrame, k: int, sample: int = 20_000, most: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that at least three of about so many sampled texts hold, and how many do: the most frequent ones."""
    bounded_batches(docs.sparkSession)
    every = max(1, docs.count() // sample)

    def run(batches):
        shingles = Shingles(k)
        for batch in batches:
            for part in pieces(batch.column("t")):
                sets = [shingles.of(t) for t in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    some = docs.select(whole_text().alias("t")).where(F.pmod(F.xxhash64("t", F.lit(9)), F.lit(every)) == 0)
    counts = some.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    rows = counts.orderBy(F.desc("n"), "h").limit(most).collect()
    h, n = np.array([r.h for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def shingled(docs: DataFrame, k: int, similar: tuple[int, int]) -> DataFrame:
    """doc_id, th, node, n, SimHash, parity bits and the first shingles of every row."""
    a, b = similar
    bounded_batches(docs.sparkSession)
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, k))

    def run(batches):
        shingles, (often, counts) = Shingles(k), frequent.value
        for batch in batches:
            at = 0
            for part in pieces(batch.column("t")):
                sets = [shingles.of(t) for t in part.to_pylist()]
                first = []
                for s in sets:
                    c = np.zeros(len(s), np.int64)
                    if len(often) and len(s):
                        i = np.minimum(np.searchsorted(often, s), len(often) - 1)
                        c = np.where(often[i] == s, counts[i], 0)
                    # a stable sort: the sets are in the order of their hashes
                    first.append(s[np.argsort(c, kind="stable")][: len(s) - -(-a * len(s) // b) + 1].view(np.int64))
                ends = np.cumsum([0, *map(len, first)])
                rest = batch.slice(at, len(sets))
                at += len(sets)
                bits = np.array([_parity(s) for s in sets], np.int64).reshape(-1, len(PARITY))
                out = [rest.column("doc_id"), rest.column("th"), pa.array([_name(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([_simhash(s) for s in sets], pa.int64()), *[pa.array(bits[:, j]) for j in range(len(PARITY))], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(first)))]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "th", "node", "n", "fp", *PARITY, "first"])
        del shingles
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t")).select("doc_id", F.xxhash64("t").alias("th"), "t")
    return rows.mapInArrow(run, f"doc_id long, th long, node long, n long, fp long, {', '.join(f'{c} long' for c in PARITY)}, first array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node, set: the shingles of texts, for the comparison."""

    def run(batches):
        shingles = Shingles(k)
        for batch in batches:
            for part in pieces(batch.column("t")):
                sets = [shingles.of(t) for t in part.to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays([pa.array([_name(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))], ["node", "set"])
        del shingles
        trim()

    return docs.select("t").mapInArrow(run, "node long, set array<long>")


def _possible(similar: tuple[int, int], x: str, y: str) -> Column:
    """Whether sizes and parity bits allow the similarity: the sets differ in at most (b - a) / (b + a) of their sizes' sum."""
    a, b = similar
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    apart = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in PARITY), F.lit(0))
    return (F.least(n, m) * b >= F.greatest(n, m) * a) & (apart * (a + b) <= (n + m) * (b - a))


def _decided(docs: DataFrame, rows: DataFrame, pairs: DataFrame, k: int, similar: tuple[int, int], together: int = 64, at_once: int = 10_000, most: int = 8) -> DataFrame:
    """The pairs u, v whose similarity is large enough, by their sets.

    Sets are made again from the texts and sent once: the pairs of one v are dealt to groups of about
    ``together``, each of which gets the set of v and those of its u.  About ``at_once`` sets are sent in one
    go, by v, and their shuffle is let go before the next, so that not all sets are on disk together; there
    are at most ``most`` goes, each of which reads the texts.
    """
    spark = docs.sparkSession
    pairs, n = counted(pairs.select("u", "v").distinct())
    if not n:
        return pairs
    hubs = pairs.groupBy(F.col("v").alias("hv")).agg(F.ceil(F.count(F.lit(1)) / together).alias("groups"))
    dealt = pairs.join(hubs, F.col("v") == F.col("hv")).select("u", "v", F.pmod(F.xxhash64("u"), F.col("groups")).alias("g"))
    sent = dealt.select(F.col("u").alias("to"), "v", "g", F.lit(False).alias("hub")).union(dealt.select("v", "v", "g", F.lit(True)).distinct())
    sent, n = counted(sent)
    goes = max(1, min(most, -(-n // at_once)))
    del dealt, hubs, pairs
    release(spark)
    found = None
    for i in range(goes):
        part = compacted(_similar(docs, rows, sent.where(F.pmod(F.xxhash64("v", F.lit(5)), F.lit(goes)) == i), k, similar))
        found = part if found is None else found.union(part)
        release(spark)
    return found


def _similar(docs: DataFrame, rows: DataFrame, sent: DataFrame, k: int, similar: tuple[int, int]) -> DataFrame:
    """u, v of those sent to the same groups."""
    a, b = similar
    sent = bounded_broadcast(sent)
    asked = sent.select("to").distinct()
    # one row of each node asked for
    chosen = rows.join(asked, F.col("node") == F.col("to"), "left_semi").groupBy("node").agg(F.min(F.struct("th", "doc_id")).alias("x"))
    chosen, n = counted(chosen.select(F.col("x.th").alias("c_th"), F.col("x.doc_id").alias("c_id")))
    chosen = bounded_broadcast(chosen, n=n)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("t"))
    texts = texts.join(chosen, (F.xxhash64("t") == F.col("c_th")) & F.col("id").eqNullSafe(F.col("c_id")), "left_semi")
    sets = _sets(texts, k).join(sent, F.col("node") == F.col("to")).select("v", "g", F.struct("hub", "node", "set").alias("x"))
    met = sets.groupBy("v", "g").agg(F.collect_list("x").alias("l"))
    met = met.select("v", F.filter("l", lambda x: ~x["hub"]).alias("l"), F.element_at(F.filter("l", lambda x: x["hub"]), 1)["set"].alias("hub"))
    met = met.select("v", F.explode(F.transform("l", lambda x: F.struct(x["node"].alias("u"), F.size(F.array_intersect(x["set"], F.col("hub"))).alias("common"), (F.size(x["set"]) + F.size("hub")).alias("both")))).alias("x"))
    return met.where(F.col("x.common") * (a + b) >= F.col("x.both") * a).select("x.u", "v").distinct()


def _placed(pairs: DataFrame, shared: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (u_node, v_node, u_n, v_n) that the places of their common first shingles allow.

    Up to the last common one, all common shingles are among the first of both and so in ``shared``.
    """
    a, b = similar

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("u_n", "v_n"))
            lists = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("u_h", "u_at", "v_h", "v_at")]
            keep = np.zeros(len(n), bool)
            for i in range(len(n)):
                h, at, g, to = (values[ends[i] : ends[i + 1]] for ends, values in lists)
                _, x, y = np.intersect1d(h, g, assume_unique=True, return_indices=True)
                most = len(x) + min(n[i] - 1 - at[x].max(), m[i] - 1 - to[y].max()) if len(x) else 0
                keep[i] = most * (a + b) >= (n[i] + m[i]) * a
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("u_node", "v_node")], ["u", "v"])

    pairs, n = counted(pairs.select("u_node", "v_node", "u_n", "v_n").distinct())
    if not n:
        return pairs.select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
    asked, n = counted(pairs.select(F.explode(F.array("u_node", "v_node")).alias("asked")).distinct())
    asked = bounded_broadcast(asked, n=n)
    lists = shared.join(asked, F.col("node") == F.col("asked"), "left_semi").groupBy("node").agg(F.collect_list(F.struct("h", "at")).alias("l"))
    lists = checkpointed(lists.select("node", F.col("l.h").alias("h"), F.col("l.at").alias("at")))
    both = pairs
    for x in ("u_", "v_"):
        both = both.join(lists.select(F.col("node").alias(f"{x}k"), F.col("h").alias(f"{x}h"), F.col("at").alias(f"{x}at")), F.col(f"{x}node") == F.col(f"{x}k"))
    return both.select("u_node", "v_node", "u_n", "v_n", "u_h", "u_at", "v_h", "v_at").mapInArrow(run, "u long, v long")


def _shared(rows: DataFrame) -> DataFrame:
    """h, node, at, weight: the first shingles that more than one row has, their places, and how common a node's are in all."""
    keyed = rows.select("node", F.posexplode("first").alias("at", "h"))
    counts = keyed.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("h").alias("h2"), "c")
    shared = checkpointed(keyed.join(counts, F.col("h") == F.col("h2")).select("h", "node", "at", "c").distinct())
    weights = shared.groupBy(F.col("node").alias("k")).agg(F.sum("c").alias("weight"))
    return checkpointed(shared.join(weights, F.col("node") == F.col("k")).select("h", "node", "at", "weight"))


def _open(shared: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``shared`` whose bucket holds nodes of several components: within one there is nothing left to say.

    A pair of two components keeps all its common shingles, each of whose buckets holds both.
    """
    labels = known.select(F.col("node").alias("k"), "label")
    ends = shared.select("h", "node").join(labels, F.col("node") == F.col("k")).groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    return checkpointed(shared.join(ends.where("x <> y").select(F.col("h").alias("h2")), F.col("h") == F.col("h2"), "left_semi"))


def _labelled(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes, labelled with the smallest node that the links found join them to."""
    named = components(found).select(F.col("node").alias("k"), F.col("component").alias("label"))
    return checkpointed(nodes.join(named, F.col("node") == F.col("k"), "left").select(*nodes.columns, F.coalesce("label", "node").alias("label")))


def _relabelled(known: DataFrame, found: DataFrame) -> DataFrame:
    """Labelled nodes after further links: components are sought among the labels that these join."""
    labels = known.select("node", "label")
    ends = found.join(labels.select(F.col("node").alias("k"), F.col("label").alias("lu")), F.col("u") == F.col("k"))
    ends = ends.join(labels.select(F.col("node").alias("l"), F.col("label").alias("lv")), F.col("v") == F.col("l"))
    named = components(ends.select(F.col("lu").alias("u"), F.col("lv").alias("v"))).select(F.col("node").alias("old"), F.col("component").alias("new"))
    rest = [c for c in known.columns if c != "label"]
    return checkpointed(known.join(named, F.col("label") == F.col("old"), "left").select(*rest, F.coalesce("new", "label").alias("label")))


def node_labels(docs: DataFrame, rows: DataFrame, k: int, similar: tuple[int, int], radius: int = 2, pivots: tuple[int, ...] = (1, 3)) -> DataFrame:
    """node, label: the components of "the Jaccard similarity is at least a/b", named by their smallest node."""
    a, b = similar
    spark = docs.sparkSession
    nodes = checkpointed(rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "fp", *PARITY)]))
    found = _decided(docs, rows, links(nodes.where("n > 0").select("node", "fp"), radius), k, similar)

    def told(known: DataFrame, x: str) -> DataFrame:
        return known.select(*[F.col(c).alias(f"{x}{c}") for c in ("node", "label", "n", *PARITY)])

    apart = F.col("u_label") != F.col("v_label")
    known = _labelled(nodes.select("node", "n", *PARITY), found)
    shared = _open(_shared(rows), known)
    del found, nodes
    release(spark)
    for parts in pivots:
        if shared.isEmpty():
            return known.select("node", "label")
        # of a family of copies the member whose shingles are the most common is the nearest to all others
        chosen = shared.groupBy("h", F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part")).agg(F.max_by("node", F.struct("weight", "node")).alias("pivot"))
        chosen = chosen.join(told(known, "v_"), F.col("pivot") == F.col("v_node")).withColumnRenamed("h", "v_h")
        met = shared.select("h", F.col("node").alias("k")).join(told(known, "u_"), F.col("k") == F.col("u_node"))
        met = met.join(chosen, F.col("h") == F.col("v_h")).where(apart & _possible(similar, "u_", "v_"))
        found = _decided(docs, rows, _placed(met, shared, similar), k, similar)
        del met, chosen
        if not found.isEmpty():
            known = _relabelled(known, found)
            shared = _open(shared, known)
        del found
        release(spark)

    left = checkpointed(shared.join(told(known, "x_"), F.col("node") == F.col("x_node")).select("h", "at", *[F.col(f"x_{c}").alias(c) for c in ("node", "label", "n", *PARITY)]))
    one, two = (left.select(*[F.col(c).alias(f"{x}{c}") for c in left.columns]) for x in ("u_", "v_"))
    # where the first common shingle stands, no more can be common than what the shorter rest has
    rest = F.least(F.col("u_n") - F.col("u_at"), F.col("v_n") - F.col("v_at")) * (a + b) >= (F.col("u_n") + F.col("v_n")) * a
    pairs = one.join(two, (F.col("u_h") == F.col("v_h")) & (F.col("u_node") < F.col("v_node")) & apart & rest & _possible(similar, "u_", "v_"))
    found = _decided(docs, rows, _placed(pairs, shared, similar), k, similar)
    return (known if found.isEmpty() else _relabelled(known, found)).select("node", "label")


def similar_rows(docs: DataFrame, k: int = 5, similar: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, th, component: every row's group of similarity a/b or more, also through others."""
    rows = checkpointed(shingled(docs, k, similar))
    known = node_labels(docs, rows, k, similar).withColumnRenamed("node", "k")
    return rows.select("doc_id", "th", "node").join(known, F.col("node") == F.col("k")).select("doc_id", "th", F.col("label").alias("component"))
