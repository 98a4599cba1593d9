"""Covering locality-sensitive hashing over 64-bit fingerprints.

The masks are those of a covering family for radius r.  Each of the 64 bits gets a random vector of
r + 1 bits; for each of the 2**(r+1) - 1 non-zero vectors v the mask keeps the bits whose vector has an
odd inner product with v.  Any r differing bits span at most r dimensions, so some v is orthogonal to
all of them: that mask keeps none of the differing bits and the pair collides.

A bucket of at most ``block`` fingerprints is compared in one task and gives the edges of a spanning
forest, never all of its pairs.  A larger bucket is solved exactly by meeting points: every member
emits the points within ceil(r / 2) bits of it (among the bits that the mask leaves free); two members
are within r exactly if a point of one's inner ball lies in the other's outer ball, and all members
around such a point form one star.  That is linear in the bucket.
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import checkpointed

M64 = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int, bits: int = 64, seed: int = 7) -> list[int]:
    """2**(radius+1) - 1 bit masks; any two fingerprints within radius agree on all bits of at least one.

    The vectors are dealt evenly over the bits, so that every mask keeps about half of them.
    """
    space = list(range(1, 1 << (radius + 1)))
    rng, dealt = random.Random(seed), []
    while len(dealt) < bits:
        rng.shuffle(space)
        dealt += space
    return [sum(1 << i for i in range(bits) if (dealt[i] & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))]


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest edges of a boolean adjacency matrix."""
    left, edges = np.ones(len(near), bool), []
    for i in range(len(near)):
        if not left[i]:
            continue
        left[i], front = False, [i]
        while front:
            j = front.pop()
            for x in np.nonzero(near[j] & left)[0]:
                left[x] = False
                edges.append((j, int(x)))
                front.append(int(x))
    return edges


def _meeting_points(dense: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links of buckets of any size: m, node, fp -> u, v."""
    outer, inner = (radius + 1) // 2, radius // 2

    def expand(batches):
        around = {}
        for pdf in batches:
            for m, part in pdf.groupby("m"):
                if m not in around:
                    free = [1 << i for i in range(64) if not masks[m] >> i & 1]
                    around[m] = [(np.array([sum(c) for c in combinations(free, d)], np.uint64), d <= inner) for d in range(outer + 1)]
                for at in range(0, len(part), 512):
                    fp, node = (part[c].to_numpy(np.int64)[at : at + 512] for c in ("fp", "node"))
                    for points, near in around[m]:
                        z = (fp.view(np.uint64)[:, None] ^ points[None, :]).view(np.int64).ravel()
                        yield pd.DataFrame({"m": m, "z": z, "node": np.repeat(node, len(points)), "near": near})

    points = dense.mapInPandas(expand, "m int, z bigint, node bigint, near boolean")
    # a point with no member's inner ball links nobody
    stars = points.groupBy("m", "z").agg(F.min("node").alias("v"), F.max("near").alias("met"), F.count(F.lit(1)).alias("n")).where("met and n > 1").select(F.col("m").alias("m2"), F.col("z").alias("z2"), "v")
    return points.join(stars, (F.col("m") == F.col("m2")) & (F.col("z") == F.col("z2"))).select(F.col("node").alias("u"), "v").where("u <> v").distinct()


def links(prints: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """u, v: links between nodes whose components are those of "fp differs in at most radius bits".

    prints: node, fp, one row per node.
    """
    masks = covering_masks(radius)
    literal = F.array(*[F.struct(F.lit(i).alias("m"), F.lit(signed(x)).alias("mask")) for i, x in enumerate(masks)])
    keyed = prints.select("node", "fp", F.explode(literal).alias("x")).select("node", "fp", F.col("x.m").alias("m"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"))
    counts = keyed.groupBy("m", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("m").alias("m2"), F.col("key").alias("key2"), "n")
    shared = checkpointed(keyed.join(counts, (F.col("m") == F.col("m2")) & (F.col("key") == F.col("key2"))).select("m", "key", "n", "node", "fp"))

    def compare(batches):
        for pdf in batches:
            u, v = [], []
            for members in pdf["members"]:
                node, fp = (np.array([r[c] for r in members], np.int64) for c in ("node", "fp"))
                near = np.bitwise_count(fp.view(np.uint64)[:, None] ^ fp.view(np.uint64)[None, :]) <= radius
                for i, j in _forest(near):
                    u.append(node[i])
                    v.append(node[j])
            yield pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    # n is known before the lists are built, so no list exceeds the block
    lists = shared.where(F.col("n") <= block).groupBy("m", "key").agg(F.collect_list(F.struct("node", "fp")).alias("members"))
    found = lists.select("members").mapInPandas(compare, "u bigint, v bigint").distinct()
    return found.union(_meeting_points(shared.where(F.col("n") > block).select("m", "node", "fp"), masks, radius))
