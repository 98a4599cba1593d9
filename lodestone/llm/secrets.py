"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

The base kinds are regular expressions.  The method adds tokens of which a first-order Markov model of
random strings is likelier than one of ordinary identifiers: both are trained from labelled samples by
counting character pairs, and the ratio is a table with one entry per pair of the alphabet's
characters, so a scan needs the text alone.  Candidates are maximal runs of token characters, their
parts between delimiters, and the subspan of a run with the largest summed ratio; a run that is random
as a whole is reported as one.  Base spans are blanked before runs are looked for, so no span of the
method overlaps one.

Positions are code points.  They come from the pieces between matches: what a split by the pattern
leaves, and what the pattern takes, alternate; their lengths are summed in blocks, so that a text with
many matches costs little more than its length.

Nulls and ties: a null text is empty and has no spans; every row is scanned by itself, so repeated rows
give repeated results and a null doc_id is kept.  An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import running, whole_text

# The base patterns; hex and access with their least lengths, which maximal runs allow.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN, PART = r"[A-Za-z0-9+/_=-]{16,}", r"[A-Za-z0-9+]{16,}"
SPAN = "s:int,k:int,e:int"
# hex digits that an assignment ends are one short where its first letter is a hex digit too
BLANK_HEX = HEX + r"|[0-9a-f]{31}(?=\x00)"

# Parts of ordinary identifiers.
PARTS = "get set list read write open close user name file path index count total value key map node tree table row column data base cache load save parse format string number error message request response client server session config option default test case build version release update delete insert select order group join filter window stream batch page text word line token label score model train sample document source target weight size length start end first last next previous the and with from into over under".split()


def labelled_samples(spark: SparkSession, n: int = 2500) -> DataFrame:
    """text, secret: random strings in five alphabets and identifiers in five styles, fixed by a seed."""
    out = []
    for i in range(n):
        d = hashlib.sha512(f"sample {i}".encode()).digest()
        kind = i % 5
        chars = ["0123456789abcdef", ALPHABET[:62], ALPHABET[:64], "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"][kind]
        out.append(("".join(chars[b % len(chars)] for b in d[: 20 + d[63] % 28]), True))
        words = [PARTS[b % len(PARTS)] for b in d[10 : 14 + i % 4]]
        style = d[40] % 5
        number = str(d[41] * 7) if d[42] % 2 else ""
        out.append((["_".join(words), "".join(w.title() for w in words), "-".join(words), "/".join(words), "_".join(words).upper()][style] + number, False))
    return spark.createDataFrame(out, "text string, secret boolean")


def pair_table(samples: DataFrame) -> list[float]:
    """log P(next | char) under the random model minus that under the ordinary one; one entry per pair."""
    k = len(ALPHABET)
    at = lambda c: F.instr(F.lit(ALPHABET), c)
    chars = F.split("text", "")
    pairs = samples.where("length(text) > 1").select("secret", F.explode(F.arrays_zip(F.slice(chars, 1, F.length("text") - 1).alias("a"), F.slice(chars, 2, F.length("text") - 1).alias("b"))).alias("p"))
    counts = pairs.groupBy("secret", at(F.col("p.a")).alias("a"), at(F.col("p.b")).alias("b")).count().where("a > 0 and b > 0")
    n = {True: [[0.5] * k for _ in range(k)], False: [[0.5] * k for _ in range(k)]}
    for r in counts.collect():  # at most two numbers per pair of the alphabet
        n[r.secret][r.a - 1][r.b - 1] += r["count"]
    table = []
    for a in range(k):
        t, f = sum(n[True][a]), sum(n[False][a])
        table += [math.log(n[True][a][b] / t) - math.log(n[False][a][b] / f) for b in range(k)]
    return table


def scored(token: Column, table: Column) -> Column:
    """total: summed log-likelihood ratio of a token's character pairs; best, s, e: that of its best subspan, and where."""
    k = len(ALPHABET)
    chars = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    state = "struct<p:int,i:int,total:double,run:double,at:int,best:double,s:int,e:int>"

    def step(a: Column, c: Column) -> Column:
        x = F.when(a["p"] < 0, 0.0).otherwise(F.get(table, a["p"] * k + c))
        run, at = F.greatest(a["run"] + x, F.lit(0.0)), F.when(a["run"] + x > 0, a["at"]).otherwise(a["i"])
        better = a["run"] + x > a["best"]
        out = [c, a["i"] + 1, a["total"] + x, run, at, F.greatest(a["best"], run), F.when(better, a["at"]).otherwise(a["s"]), F.when(better, a["i"] + 1).otherwise(a["e"])]
        return F.struct(*[v.alias(n) for v, n in zip(out, ["p", "i", "total", "run", "at", "best", "s", "e"], strict=True)]).cast(state)

    return F.aggregate(chars, F.struct(*[F.lit(v).alias(n) for v, n in zip([-1, 0, 0.0, 0.0, 0, 0.0, 0, 0], ["p", "i", "total", "run", "at", "best", "s", "e"], strict=True)]).cast(state), step)


def varied(token: Column) -> Column:
    """Whether at least half of a token's pairs, or 64, are different ones: a repeated character is not random."""
    # the characters once as an array: cutting each pair from the text would start from its beginning
    chars, n = F.split(token, ""), F.length(token)
    pairs = F.zip_with(F.slice(chars, 1, F.greatest(n - 1, F.lit(0))), F.slice(chars, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    return F.size(F.array_distinct(pairs)) >= F.least((n - 1) / 2, F.lit(64))


def cut_by(text: Column, pattern: str, group: int = 0) -> Column:
    """The text as gaps (g), each but the last followed by a match (m) and the match's group (v)."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    none = F.lit(None).cast("string")
    whole = F.array(F.struct(text.alias("g"), none.alias("m"), none.alias("v")))
    return F.when(text.rlike(pattern), F.arrays_zip(gaps.alias("g"), found.alias("m"), values.alias("v"))).otherwise(whole)


def spans_of(cuts: Column, kind: int, keep=None) -> Column:
    """Spans (s, k, e) and values (v) of the matches; keep(value) may reject some."""
    size = lambda x: F.coalesce(F.char_length(x), F.lit(0))
    at = running(F.transform(cuts, lambda x: size(x["g"]) + size(x["m"])))
    spans = F.zip_with(cuts, at, lambda x, a: F.struct((a + size(x["g"])).alias("s"), F.lit(kind).alias("k"), (a + size(x["g"]) + size(x["m"])).alias("e"), x["v"].alias("v")))
    return F.filter(spans, lambda x: x["v"].isNotNull() & (keep(x["v"]) if keep else F.lit(True))).cast(f"array<struct<{SPAN},v:string>>")


def blanked(cuts: Column, keep=None) -> Column:
    """The text with a zero character in place of each character of a match that is kept."""
    zeros = lambda x: F.repeat(F.lit("\0"), F.char_length(x["m"]))
    filled = lambda x: F.when(keep(x["v"]), zeros(x)).otherwise(x["m"]) if keep else zeros(x)
    return F.array_join(F.transform(cuts, lambda x: F.when(x["m"].isNull(), x["g"]).otherwise(F.concat(x["g"], filled(x)))), "")


def random_spans(token: Column, start: Column, table: Column, least: float) -> Column:
    """Spans of a run of token characters that look random: the run, or its parts and its best subspan."""
    enough = least * 19  # the evidence of the shortest token that the mean alone decides

    def odd(v: Column) -> Column:
        total = scored(v, table)["total"]
        return (total >= F.greatest(F.lit(enough), least * (F.length(v) - 1))) & varied(v)

    span = lambda s, e: F.struct((start + s).cast("int").alias("s"), F.lit(3).alias("k"), (start + e).cast("int").alias("e"))
    none = F.array().cast(f"array<struct<{SPAN}>>")
    parts = F.transform(spans_of(cut_by(token, PART), 3, odd), lambda x: span(x["s"], x["e"]))
    top = F.transform(F.array(scored(token, table)), lambda b: F.when((b["best"] >= enough) & (b["e"] - b["s"] >= 16) & varied(F.substring(token, b["s"] + 1, b["e"] - b["s"])), F.array(span(b["s"], b["e"]))).otherwise(none))
    # the best subspan of a part that is reported says nothing new
    inner = F.transform(F.array(parts), lambda q: F.concat(q, F.filter(F.flatten(top), lambda b: ~F.exists(q, lambda x: (x["s"] < b["e"]) & (b["s"] < x["e"])))))
    return F.when(odd(token), F.array(span(F.lit(0), F.length(token)))).otherwise(F.flatten(inner)).cast(f"array<struct<{SPAN}>>")


def secrets(docs: DataFrame, samples: DataFrame | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, assigns, accesses, hexes, randoms: arrays of (s, k, e) for every row.

    least: mean log-likelihood ratio per character pair from which a token counts as random; tokens and
    subspans under 20 characters need the sum that 20 characters would.
    """
    table = pair_table(samples if samples is not None else labelled_samples(docs.sparkSession))
    long_enough = lambda v: F.char_length(v) >= 8
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("t"))
    rows = rows.select("doc_id", "t", cut_by(F.col("t"), ASSIGN, 2).alias("a"))
    bare = lambda cuts, kind, keep=None: F.transform(spans_of(cuts, kind, keep), lambda x: x.dropFields("v"))
    rows = rows.select("doc_id", bare(F.col("a"), 0, long_enough).alias("assigns"), bare(cut_by(F.col("t"), ACCESS), 1).alias("accesses"), bare(cut_by(F.col("t"), HEX), 2).alias("hexes"), blanked(F.col("a"), long_enough).alias("t"))
    for pattern in (ACCESS, BLANK_HEX):
        rows = rows.withColumn("t", F.when(F.col("t").rlike(pattern), blanked(cut_by(F.col("t"), pattern))).otherwise(F.col("t")))
    # the table is bound once per row: the runs' lambda refers to it
    rows = rows.select("doc_id", "assigns", "accesses", "hexes", spans_of(cut_by(F.col("t"), TOKEN), 3).alias("runs"), F.lit(table).alias("table"))
    tokens = F.flatten(F.transform("runs", lambda r: random_spans(r["v"], r["s"], F.col("table"), least)))
    return rows.select("doc_id", "assigns", "accesses", "hexes", tokens.alias("randoms"))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    name = F.lit(KINDS)
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(name, x["k"]), x["s"], x["e"])), ",")


def secret_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    s = secrets(docs, **how)
    base = F.concat("assigns", "accesses", "hexes")
    n = lambda c: F.size(c).cast("long")
    return s.select("doc_id", n("assigns").alias("n_assign"), n("accesses").alias("n_access"), n("hexes").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.concat(base, F.col("randoms"))).alias("spans"))
