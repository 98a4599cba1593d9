"""Dedup, fingerprints and mixing against brute force, with nulls, ties and odd texts."""

import hashlib
import math
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from lodestone.llm import components, covering, exact_dedup, fingerprint, mixing, near_dedup

BASE = " ".join(f"word{i % 37}x{i % 11} tail{i}" for i in range(300))
TEXTS = [(1, "a b c d e", "x"), (2, "a b c d e", "x"), (3, None, None), (4, "", "y"), (5, " \t\n", None), (6, "one", "z"), (7, BASE, "x"), (8, BASE.replace("tail7", "head7"), "x"), (9, BASE.replace("tail7 ", "head7 ").replace("tail90", "q"), "y"), (9, "dup id", "y"), (9, "dup id", "y"), (None, "no id", "y"), (10, "ÄÖ ü " * 50, "\U0001f600"), (11, "long " * 20000, "x")]
SCHEMA = "doc_id long, text string, source string, h string, t string, key string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in TEXTS], SCHEMA).repartition(3)


def weak(text):
    return F.substring(F.md5(text.cast("binary")), 1, 1)


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, weak])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(docs, keep, hash_of):
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(docs, keep, hash_of).collect())
    want = []
    for i, t, _ in TEXTS:
        same = [j for j, u, _ in TEXTS if (u or "") == (t or "")]
        ids = [j for j in same if j is not None]
        k = (max if keep == "largest" else min)(ids) if ids else None
        want.append((i or -1, k or -1, len(same), i == k, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    rows = exact_dedup.drop_copies(docs, keep, hash_of)
    assert rows.columns == docs.columns and rows.count() == len({t or "" for _, t, _ in TEXTS})


def prints(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def smallest(n, edges):
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_near_groups(docs):
    fp = prints([t for _, t, _ in TEXTS])
    label = smallest(len(fp), [(a, b) for a, b in combinations(range(len(fp)), 2) if (fp[a] ^ fp[b]).bit_count() <= 3])
    want = sorted((i or -1, f"{f:016x}", min((j for j, l in zip([x[0] for x in TEXTS], label, strict=True) if l == c and j is not None), default=-1)) for (i, _, _), f, c in zip(TEXTS, fp, label, strict=True))
    rows = near_dedup.near_groups(docs).distinct().collect()
    assert sorted({(r.doc_id or -1, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in rows}) == sorted(set(want))


def test_repeated_rows_keep_their_fingerprint(spark):
    rows = [(1, BASE)] * 10 + [(None, BASE)] * 10 + [(2, BASE)]
    got = {r.fingerprint for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {f"{prints([BASE])[0]:016x}"}


@pytest.mark.parametrize("block", [2048, 2])
def test_links_in_dense_buckets(spark, block):
    """A block of 2 sends nearly every bucket through the meeting points."""
    import random

    rng = random.Random(3)
    values = []
    for _ in range(6):
        c = rng.getrandbits(64)
        values += [c] + [c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 5]))) for _ in range(5)]
    values = sorted(set(values))
    df = spark.createDataFrame([(covering.signed(v),) for v in values], "fp long").withColumn("node", F.col("fp"))
    got = {r.node: r.component for r in components.components(covering.links(df, 3, block)).collect()}
    signed = sorted(map(covering.signed, values))
    label = smallest(len(signed), [(a, b) for a, b in combinations(range(len(signed)), 2) if ((signed[a] ^ signed[b]) & covering.M64).bit_count() <= 3])
    assert {v: got.get(v, v) for v in signed} == {v: signed[label[i]] for i, v in enumerate(signed)}


@pytest.mark.parametrize("radius", [1, 2, 3, 6])
def test_masks_cover(radius):
    import random

    masks, rng = covering.covering_masks(radius), random.Random(1)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(500):
        d = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & d for m in masks)


def test_similar_texts_leave_one(docs):
    kept = {(r.doc_id, r.text) for r in near_dedup.drop_similar(docs).select("doc_id", "text").collect()}
    assert (7, BASE) in kept and not any(i in (8,) for i, _ in kept) and (6, "one") in kept and (None, "no id") in kept


def test_similar_groups_are_those_of_brute_force(spark):
    """Pairs around a similarity of 0.8, in texts of 3 to 400 words, beside a line that most texts share."""
    import random

    rng, line = random.Random(6), "this line stands in most of the texts of the table "
    texts = ["", " ", "a b c", "A  b c", "a b d"]
    for n in (20, 60, 100, 100, 100, 200, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for edits in (0, 1, 1, 2, 2, 3, 3, 4, 8):
            words = list(base)
            for at in rng.sample(range(n), edits * n // 100 or edits):
                words[at] = f"x{rng.randrange(5000)}"
            texts.append((line if rng.random() < 0.7 else "") + " ".join(words))
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = [(a, b) for a, b in combinations(range(len(texts)), 2) if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert len(near) > 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dedup.similar_groups(df).collect()}
    assert got == dict(enumerate(smallest(len(texts), near)))


def test_rows_of_repeated_and_null_ids_stand_for_themselves(spark):
    other = " ".join(f"other{i}" for i in range(200))
    rows = [(7, BASE), (9, BASE.replace("tail90", "q")), (9, "dup id"), (9, "dup id"), (None, BASE.replace("tail80", "q")), (None, other), (None, other.replace("other150", "q")), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id or -1, r.text[:6]) for r in near_dedup.drop_similar(df).collect()))
    assert kept == [(-1, "no id"), (-1, "other0"), (7, "word0x"), (9, "dup id")]


def simhash(text):
    """128 bits by plain loops over pairs of words."""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    pairs = [(w[0], w[0])] if len(w) == 1 else list(zip(w, w[1:], strict=False))
    x = lambda v, seed: xxhash.xxh64_intdigest(v, seed=seed)
    votes, total = [0] * 128, 0
    for a, b in pairs:
        n = len(a) + len(b)
        weight = 3 if n > 12 else 2 if n > 6 else 1
        f0 = x(b.encode(), x(a.encode(), 42))
        f1 = x((1).to_bytes(4, "little"), x(a.encode(), x(b.encode(), 42)))
        total += weight
        for k in range(64):
            votes[k] += weight * (f0 >> k & 1)
            votes[64 + k] += weight * (f1 >> k & 1)
    bits = sum(1 << k for k in range(128) if 2 * votes[k] > total)
    return f"{bits & covering.M64:016x}{bits >> 64:016x}", total


def alike(a, b):
    (x, n), (y, m) = a, b
    if not n or not m:
        return float(n == m)
    return max(0.0, math.cos((int(x, 16) ^ int(y, 16)).bit_count() * math.pi / 128))


@pytest.mark.parametrize("ranges", [None, 3])
def test_fingerprints(spark, docs, ranges):
    """All columns against plain loops; ids are made distinct, for the order of equal ones is the operator's own."""
    texts = [(i, t or "") for i, (_, t, _) in enumerate(TEXTS)] + [(100, BASE.replace("tail299", "tail298")), (101, "x"), (None, "last")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    out = sorted(fingerprint.document_fingerprints(df, ranges).collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id, reverse=True)
    order = sorted(texts, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    own = [simhash(t) for _, t in order]
    label = smallest(len(own), [(a, b) for a, b in combinations(range(len(own)), 2) if (int(own[a][0], 16) ^ int(own[b][0], 16)).bit_count() <= 2])
    for k, ((i, t), r) in enumerate(zip(order, out, strict=True)):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own[k][0], simhash(e)[0])
        assert r.near_edited == pytest.approx(alike(own[k], simhash(e))) and r.near_next == pytest.approx(alike(own[k], simhash(nxt)))
        group = [order[j][0] for j in range(len(order)) if label[j] == label[k]]
        assert r.near_size == len(group) and r.near_group == min((j for j in group if j is not None), default=None)
    assert len(fingerprint.document_fingerprints(docs, ranges).collect()) == len(TEXTS)


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("few", [64, 1])
def test_linked_fingerprints(spark, radius, few):
    """A bound of 1 sends every bucket through the points."""
    import random

    rng = random.Random(8)
    c = [rng.getrandbits(128) for _ in range(5)]
    values = sorted({x ^ sum(1 << b for b in rng.sample(range(128), k)) for x in c for k in (0, 1, 1, 2, 2, 3, 4, 6)})
    low = lambda x: covering.signed(x & covering.M64)
    df = spark.createDataFrame([(i, low(v), low(v >> 64)) for i, v in enumerate(values)], "node long, f0 long, f1 long")
    got = {r.node: r.component for r in fingerprint.linked(df, radius, few).collect()}
    want = smallest(len(values), [(a, b) for a, b in combinations(range(len(values)), 2) if (values[a] ^ values[b]).bit_count() <= radius])
    assert [got.get(i, i) for i in range(len(values))] == want


def test_fingerprint_neighbours(spark):
    import random

    rng = random.Random(5)
    c = [rng.getrandbits(128) for _ in range(4)]
    values = sorted({x ^ sum(1 << b for b in rng.sample(range(128), k)) for x in c for k in (0, 2, 4, 6, 9)})
    low = lambda x: covering.signed(x & covering.M64)
    df = spark.createDataFrame([(low(v), low(v >> 64)) for v in values], "f0 long, f1 long")
    want = sum((a ^ b).bit_count() <= 7 for a, b in combinations(values, 2))
    assert fingerprint.neighbours(df, 7).count() == want


def test_mixing(spark, docs):
    out = mixing.mixed(docs, fan_in=4).collect()
    assert len(out) == len(TEXTS)
    rows = [(i, f"{'w ' * (1 + i * 7 % 40)}", f"s{i % 3}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(df).join(df.select("doc_id", "source"), "doc_id")
    sums = got.groupBy("source").agg(F.first("source_size").alias("s"), F.first("target").alias("t"), F.sum("taken").alias("x"), F.max(F.col("taken") / F.col("size")).alias("m")).orderBy("source").collect()
    total = sum(r.s for r in sums)
    assert sum(r.t for r in sums) == pytest.approx(total)
    for r, w in zip(sums, (5, 2, 1), strict=True):
        assert r.t == pytest.approx(total * w / 8) and abs(r.x - r.t) <= 45 and r.m <= 3
    again = mixing.mixed(df.repartition(7))
    assert sorted(map(tuple, mixing.mixed(df).collect())) == sorted(map(tuple, again.collect()))
    taken = mixing.take_mix(df).groupBy("doc_id").count()
    assert taken.join(mixing.mixed(df), "doc_id").where("count <> copies").count() == 0
    assert taken.count() == mixing.mixed(df).where("copies > 0").count()


def test_mixing_with_many_sources_is_the_same(spark, docs, monkeypatch):
    """Sources beyond the broadcast bound are joined in salted copies."""
    want = sorted(map(tuple, mixing.mixed(docs, fan_in=4).collect()), key=repr)
    monkeypatch.setattr(mixing._with_sources, "__defaults__", (0, 4))
    assert sorted(map(tuple, mixing.mixed(docs, fan_in=4).collect()), key=repr) == want


def test_copies_of_repeated_rows(docs):
    """Repeated rows and rows without an id are taken as often as their group's copies."""
    names = ["id", "skey", "th"]
    want = {tuple(r[c] for c in names): r.n for r in mixing.mixed(docs, fan_in=4).groupBy(F.col("doc_id").alias("id"), "skey", "th").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    taken = mixing.take_mix(docs, fan_in=4)
    got = {tuple(r[c] for c in names): r["count"] for r in taken.groupBy(*mixing.row_key()).count().collect()}
    assert got == want and taken.columns == docs.columns


def pivoted(items, seed):
    """The reduction of one node by plain Python, on exact fractions of the same coins."""
    carried, out = dict(items[0]), []
    for x in items[1:]:
        c, x = carried, dict(x)
        u = seed(c, x)
        give, take = min(c["p"] * c["size"], (1 - x["p"]) * x["size"]), min((1 - c["p"]) * c["size"], x["p"] * x["size"])
        move = give if u * (give + take) < take else -take
        c["p"], x["p"] = c["p"] - move / c["size"], x["p"] + move / x["size"]
        done, carried = (c, x) if min(c["p"], 1 - c["p"]) < min(x["p"], 1 - x["p"]) else (x, c)
        out.append((done["id"], done["whole"] + round(done["p"])))
    return out, carried


def test_pivots_are_those_of_a_loop(spark):
    import random

    rng = random.Random(9)
    rows = [[(i, 7, 0, rng.randrange(1, 60), rng.randrange(3), rng.random()) for i in range(n)] for n in (1, 2, 7, 60)]
    df = spark.createDataFrame([(r,) for r in rows], f"items array<{mixing.RES}>")
    pairs = {(a, b) for n in rows for a in range(len(n)) for b in range(len(n))}
    coins = {(r.a, r.b): r.u for r in spark.createDataFrame(sorted(pairs), "a long, b long").select("a", "b", mixing.coin(F.lit(3), F.col("a"), F.lit(7).cast("long"), F.lit(0).cast("long"), F.col("b"), F.lit(7).cast("long"), F.lit(0).cast("long")).alias("u")).collect()}
    names = ["id", "th", "ord", "size", "whole", "p"]
    for r in df.select("items", mixing._pivot(F.col("items"), 3).alias("a")).collect():
        out, carried = pivoted([dict(zip(names, x, strict=True)) for x in r["items"]], lambda c, x: coins[c["id"], x["id"]])
        assert [(x["id"], x.copies) for x in r.a.out] == out and r.a.res["id"] == carried["id"] and r.a.res.p == pytest.approx(carried["p"])
        spent = sum(x.size * x.copies for x in r.a.out) + r.a.res.size * (r.a.res.whole + r.a.res.p)
        assert spent == pytest.approx(sum(x.size * (x.whole + x.p) for x in r["items"]))


def test_targets_stop_at_the_cap(spark):
    df = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), (None, 500, 1)], "source string, source_size long, n long")
    t = {r.source: r.target for r in mixing.source_targets(df, [5, 2, 1], 3).collect()}
    assert t["a"] == 30 and t["b"] == pytest.approx(1480 * 2 / 3) and t[None] == pytest.approx(1480 / 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for f in (exact_dedup.exact_groups, exact_dedup.drop_copies, near_dedup.near_groups, near_dedup.drop_similar, fingerprint.document_fingerprints, mixing.mixed, mixing.take_mix):
        assert f(none).count() == 0


def test_targets_of_heavy_tails(spark):
    """Every source comes within one median document of its target, those of a few giants among short texts too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mixed(docs).groupBy("skey").agg(F.count("*").alias("n"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.median("size").alias("m"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= r.m for r in found if r.n >= 30) and all(r.over <= 0 for r in found)


def test_sets_sent_in_several_goes_give_the_same_links(spark):
    from lodestone.llm import jaccard
    from lodestone.llm.common import checkpointed, compacted

    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[: 60 - i % 3], f"x{i}"]) for i in range(9)] + ["other words of no kin to these at all"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = checkpointed(jaccard.shingled(docs, 5, (4, 5)))
    nodes = [r.node for r in rows.collect()]
    pairs = spark.createDataFrame([(u, v) for u in nodes for v in nodes if u < v], "u long, v long")
    one, some = ({tuple(r) for r in jaccard._decided(docs, rows, pairs, 5, (4, 5), at_once=n).collect()} for n in (10_000, 5))
    assert one == some and one
    assert compacted(spark.range(100).repartition(64)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_links_found_later_join_known_components(spark):
    from lodestone.llm import jaccard

    first, later = [(2, 1), (4, 3), (6, 5), (5, 7)], [(4, 2), (9, 7), (3, 1)]
    nodes = spark.createDataFrame([(i,) for i in range(1, 11)], "node long")
    one, two = (spark.createDataFrame(x, "u long, v long") for x in (first, later))
    got = {r.node: r.label for r in jaccard._relabelled(jaccard._labelled(nodes, one), two).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 5, 8: 8, 9: 5, 10: 10}


def test_near_dedup_asks_few_queries(spark):
    """The driver keeps a record of each query: components of stars take no round, and steps without pairs end."""

    def queries(f):
        before = spark._jsparkSession.sharedState().statusStore().executionsCount()
        out = f()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return out, spark._jsparkSession.sharedState().statusStore().executionsCount() - before

    stars = spark.createDataFrame([(3, 1), (2, 1), (9, 8)], "u long, v long")
    got, n = queries(lambda: components.components(stars).collect())
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)] and n <= 3
    texts = [" ".join(f"{a}{i}" for i in range(40)) for a in "xyz"]
    df = spark.createDataFrame(list(enumerate([*texts, texts[0] + " more"])), "doc_id long, text string")
    got, n = queries(lambda: sorted(r.doc_id for r in near_dedup.drop_similar(df).collect()))
    assert got == [0, 1, 2] and n <= 40, n
