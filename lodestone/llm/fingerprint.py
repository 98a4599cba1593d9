"""Document fingerprints: weighted SimHash and permuted block tables.

Terms are pairs of consecutive words (and single words of texts with one word); a term's 128-bit hash
votes on 128 signed bits with a weight of 1 to 3 that follows its length, a stand-in for rarity that
needs no corpus statistics.  ``likeness`` turns the Hamming distance into the cosine that it
estimates.  Equal texts have equal fingerprints.

Block tables: the bits are cut into radius + 1 blocks, one of which two near fingerprints share whole
(pigeonhole); one table per block puts it first as the key and the rest is compared.  ``linked`` groups
all fingerprints within a radius of up to 2 bits; ``neighbours`` lists the pairs of a small set.

``followed_by`` gives every row the text of the next one in descending doc_id.  Rows are dealt once to
ranges of doc_id found from approximate quantiles; the window runs inside a range, and only the first
row of each range travels to the range before it.

Nulls and ties: a null text is empty and has fingerprint zero; likeness of two empty texts is 1, of an
empty and a non-empty text 0.  Rows with equal doc_id are ordered by text hash; null doc_ids come
last.  A table of one row is followed by itself.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.common import WHITE, checkpointed, hex16, voted_bits, votes, whole_text, words_by
from lodestone.llm.components import components

BITS, MOST = 128, 3
RANGES, RANGE_BYTES = 1 << 16, 32 << 20  # at most so many range bounds reach the driver; text that a range should hold


def with_range(rows: DataFrame, ranges: int) -> DataFrame:
    """Adds bucket: the range of doc_id, ascending; null ids in the lowest."""
    ranges = max(1, min(ranges, RANGES))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 20 * max(ranges, 500))).first()[0] or []
    cuts = sorted(set(cuts))
    size = 1
    while size <= len(cuts):
        size *= 2
    top = (1 << 63) - 1
    bounds = F.lit(cuts + [top] * (size - len(cuts)))
    steps = [size >> i for i in range(1, size.bit_length())]
    if not steps:
        return rows.withColumn("bucket", F.lit(0))
    # binary search; a step looks at the last bound that it would skip
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(bounds, at + s - 1) < F.col("doc_id"), at + s).otherwise(at))
    return rows.withColumn("bucket", found)


def followed_by(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """bucket, rn, doc_id, t, next_id, nt, edge: each row with the text of the next, descending doc_id.

    edge marks the last row of a range, whose next row stands in another one.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    if ranges is None:
        size = texts.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
        ranges = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES)
    rows = with_range(texts, ranges)
    rows = rows.withColumn("tie", F.xxhash64("t"))
    order = W.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "tie")
    inner = rows.withColumns({"rn": F.row_number().over(order), "nt": F.lead("t").over(order)}).drop("tie")
    first = F.struct(F.col("doc_id").isNotNull().alias("a"), F.coalesce("doc_id", F.lit(0)).alias("b"), (-(F.col("tie") / 2)).alias("c"))
    heads = checkpointed(rows.groupBy("bucket").agg(F.max_by("t", first).alias("head")))
    below = W.orderBy(F.col("bucket").desc())  # one number per range
    order_of = heads.select("bucket").select(F.col("bucket").alias("b2"), F.coalesce(F.lead("bucket").over(below), F.first("bucket").over(below)).alias("b3"))
    follow = order_of.join(heads.select(F.col("bucket").alias("b4"), F.col("head").alias("follow")), F.col("b3") == F.col("b4")).select("b2", "follow")
    joined = inner.join(follow, F.col("bucket") == F.col("b2"), "left")
    edge = F.col("nt").isNull()
    return joined.select("bucket", "rn", "doc_id", "t", F.coalesce("nt", "follow").alias("nt"), edge.alias("edge"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))


def terms_of(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, at, h, g, weight: one row per term."""
    words = rows.select(*keys, words_by(F.lower(text), WHITE).alias("w"))
    pairs = F.when(F.size("w") == 1, F.arrays_zip(F.col("w").alias("a"), F.col("w").alias("b"))).otherwise(F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))).alias("a"), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("b")))
    terms = words.select(*keys, F.posexplode_outer(pairs).alias("at", "s"))
    length = F.length("s.a") + F.length("s.b")
    weight = F.when(length > 12, 3).when(length > 6, 2).otherwise(1)
    return terms.select(*keys, F.coalesce("at", F.lit(0)).alias("at"), F.when(F.col("s").isNotNull(), F.xxhash64("s.a", "s.b")).alias("h"), F.when(F.col("s").isNotNull(), F.xxhash64("s.b", "s.a", F.lit(1))).alias("g"), F.coalesce(weight, F.lit(1)).alias("weight"))


def voted(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, total, f0, f1: the 128-bit fingerprint of every text."""
    v = votes(terms_of(rows, keys, text), keys, ["h", "g"], "at", "weight", MOST)
    return v.select(*keys, "total", voted_bits(0, F.col("total")).alias("f0"), voted_bits(1, F.col("total")).alias("f1"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the distance of two fingerprints (structs of total, f0, f1) estimates, 0 to 1."""
    distance = F.bit_count(a["f0"].bitwiseXOR(b["f0"])) + F.bit_count(a["f1"].bitwiseXOR(b["f1"]))
    cosine = F.greatest(F.lit(0.0), F.cos(distance * F.lit(3.141592653589793 / BITS)))
    return F.when((a["total"] == 0) & (b["total"] == 0), 1.0).when((a["total"] == 0) | (b["total"] == 0), 0.0).otherwise(cosine)


def hex32(f: Column) -> Column:
    return F.concat(hex16(f["f0"]), hex16(f["f1"]))


def fingerprint_pairs(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, f0, f1 (the fingerprint's halves)."""
    rows = followed_by(docs, ranges).withColumn("e", edited(F.col("t"), F.col("nt")))
    digest = F.struct(F.char_length("t").cast("long").alias("n_chars"), F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"))
    # the texts that need a fingerprint: the row's own, the edited one, and the next row's where it stands in another range
    texts = F.array(F.struct(F.lit(0).alias("kind"), F.col("t").alias("x")), F.struct(F.lit(1).alias("kind"), F.col("e").alias("x")), F.struct(F.lit(2).alias("kind"), F.when(F.col("edge"), F.col("nt")).alias("x")))
    split = rows.select("bucket", "rn", "doc_id", digest.alias("d"), F.explode(texts).alias("x")).where("x.x is not null")
    split = split.select("bucket", "rn", "doc_id", F.when(F.col("x.kind") == 0, F.col("d")).alias("d"), F.col("x.kind").alias("kind"), F.col("x.x").alias("x"))
    split = split.select("bucket", "rn", "doc_id", F.col("d.n_chars").alias("n_chars"), F.col("d.edited_sha256").alias("edited_sha256"), "kind", "x")
    keys = ["bucket", "rn", "kind", "doc_id", "n_chars", "edited_sha256"]
    prints = voted(split, keys, "x")
    f = F.struct("total", "f0", "f1")
    pick = lambda k: F.max(F.when(F.col("kind") == k, f))
    # the grouping is by range and row, as the rows lie already: no further shuffle
    rowed = prints.groupBy("bucket", "rn").agg(F.max("doc_id").alias("doc_id"), F.max("n_chars").alias("n_chars"), F.max("edited_sha256").alias("edited_sha256"), pick(0).alias("own"), pick(1).alias("edit"), pick(2).alias("far"))
    following = F.coalesce("far", F.lead("own").over(W.partitionBy("bucket").orderBy("rn")))
    out = rowed.withColumn("nxt", following)
    return out.select("doc_id", "n_chars", "edited_sha256", hex32(F.col("own")).alias("fingerprint"), hex32(F.col("edit")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("nxt")).alias("near_next"), F.col("own.f0").alias("f0"), F.col("own.f1").alias("f1"))


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """table, key, f0, f1: radius + 1 permuted tables; near fingerprints share the key of one of them."""
    width = BITS // (radius + 1)
    entries = []
    for i in range(radius + 1):
        lo, hi = i * width, BITS if i == radius else (i + 1) * width
        mask = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        low, high = mask & ((1 << 64) - 1), mask >> 64
        lit = lambda x: F.lit(x - (1 << 64) if x >> 63 else x)
        entries.append(F.struct(F.lit(i).alias("table"), F.col("f0").bitwiseAND(lit(low)).alias("k0"), F.col("f1").bitwiseAND(lit(high)).alias("k1")))
    return prints.select("*", F.explode(F.array(*entries)).alias("e")).select(*prints.columns, "e.*")


def neighbours(prints: DataFrame, radius: int = 7) -> DataFrame:
    """a0, a1, b0, b1, distance: each pair of distinct fingerprints within the radius once, a before b."""
    t = block_tables(prints.select("f0", "f1").distinct(), radius)
    a = t.select("table", "k0", "k1", F.col("f0").alias("a0"), F.col("f1").alias("a1"))
    b = t.select(F.col("table").alias("tb"), F.col("k0").alias("kb0"), F.col("k1").alias("kb1"), F.col("f0").alias("b0"), F.col("f1").alias("b1"))
    distance = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("a1").bitwiseXOR(F.col("b1")))
    on = (F.col("table") == F.col("tb")) & (F.col("k0") == F.col("kb0")) & (F.col("k1") == F.col("kb1")) & ((F.col("a0") < F.col("b0")) | ((F.col("a0") == F.col("b0")) & (F.col("a1") < F.col("b1")))) & (distance <= radius)
    return a.join(b, on).select("a0", "a1", "b0", "b1", distance.alias("distance")).distinct()


def linked(prints: DataFrame, radius: int = 2, few: int = 64) -> DataFrame:
    """node, component over prints (node, f0, f1; distinct fingerprints): those within the radius, also through others.

    The block tables find the candidates.  In a bucket of a few all meet; a larger one is solved by
    points: two members are within 2 bits exactly if a point within one bit of either is the same, so
    every member lists those points (among the bits that the block leaves free) and all that list one are
    a star.  Both are linear in the number of fingerprints.
    """
    if not 0 <= radius <= 2:
        raise ValueError("links are found up to 2 bits")
    t = checkpointed(block_tables(prints.select("node", "f0", "f1"), radius))
    keys = ["table", "k0", "k1"]
    counts = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*[F.col(k).alias(f"c_{k}") for k in keys], "n")
    same = lambda p: (F.col("table") == F.col(f"{p}_table")) & (F.col("k0") == F.col(f"{p}_k0")) & (F.col("k1") == F.col(f"{p}_k1"))
    met = checkpointed(t.join(counts, same("c")).select("node", "f0", "f1", *keys, "n"))
    other = met.where(F.col("n") <= few).select(*[F.col(c).alias(f"o_{c}") for c in ("node", "f0", "f1", *keys)])
    distance = F.bit_count(F.col("f0").bitwiseXOR(F.col("o_f0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("o_f1")))
    pairs = met.where(F.col("n") <= few).join(other, same("o") & (F.col("node") < F.col("o_node")) & (distance <= radius)).select(F.col("node").alias("u"), F.col("o_node").alias("v"))
    # the bits within reach of a point: all of them, and none
    flips = [(0, 0), *[(1 << i if i < 64 else 0, 1 << (i - 64) if i >= 64 else 0) for i in range(BITS)]]
    lit = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
    width = BITS // (radius + 1)
    ends = [(i * width, BITS if i == radius else (i + 1) * width) for i in range(radius + 1)]
    free = [F.array(*[F.struct(lit(a).alias("a"), lit(b).alias("b")) for k, (a, b) in enumerate(flips) if k == 0 or not lo <= k - 1 < hi]) for lo, hi in ends]
    points = met.where(F.col("n") > few).select("node", "f0", "f1", "table", F.explode(F.get(F.array(*free), F.col("table"))).alias("x"))
    # with a radius of 1 one of the two is its own point
    reach = points.select("node", "table", F.col("f0").bitwiseXOR(F.col("x.a")).alias("p0"), F.col("f1").bitwiseXOR(F.col("x.b")).alias("p1"), ((F.col("x.a") == 0) & (F.col("x.b") == 0)).alias("own"))
    if radius < 2:
        reach = reach.where("own") if radius == 0 else reach
    stars = reach.groupBy(F.col("table").alias("st"), F.col("p0").alias("s0"), F.col("p1").alias("s1")).agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("k"), F.max("own").alias("met")).where("k > 1")
    if radius == 1:
        stars = stars.where("met")
    hung = reach.join(stars, (F.col("table") == F.col("st")) & (F.col("p0") == F.col("s0")) & (F.col("p1") == F.col("s1"))).select(F.col("node").alias("u"), "v").where("u <> v")
    return components(pairs.union(hung).distinct())


def document_fingerprints(docs: DataFrame, ranges: int | None = None, radius: int = 2) -> DataFrame:
    """fingerprint_pairs and near_group, near_size: smallest doc_id and number of the rows whose fingerprints are linked within the radius."""
    rows = checkpointed(fingerprint_pairs(docs, ranges))
    prints = rows.groupBy("f0", "f1").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size"))
    prints = checkpointed(prints.withColumn("node", F.monotonically_increasing_id()))
    member = linked(prints, radius).withColumnRenamed("node", "m")
    named = prints.join(member, F.col("node") == F.col("m"), "left").withColumn("c", F.coalesce("component", "node"))
    groups = named.groupBy("c").agg(F.min("low").alias("near_group"), F.sum("size").alias("near_size"))
    told = named.select(F.col("f0").alias("n0"), F.col("f1").alias("n1"), F.col("c").alias("nc")).join(groups, F.col("nc") == F.col("c")).select("n0", "n1", "near_group", "near_size")
    return rows.join(told, (F.col("f0") == F.col("n0")) & (F.col("f1") == F.col("n1"))).drop("f0", "f1", "n0", "n1")
