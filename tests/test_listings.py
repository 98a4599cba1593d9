"""Greedy excerpts and command arguments against plain Python."""

from pyspark.sql import functions as F

from lodestone.operators import listings


def greedy(text, needles, half):
    lines = text.split("\n")
    hits = sorted((-sum(n in x.lower() for n in needles), i) for i, x in enumerate(lines))
    chosen = []
    for s, i in hits:
        lo, hi = max(0, i - half), min(len(lines), i + half)
        if s and not any(lo < b and hi > a for a, b in chosen):
            chosen.append((lo, hi))
    return sorted(chosen)


def test_excerpts(spark):
    texts = ["a\nfoo\nb\nfoo bar\nc\nd\ne\nBAR\n\nfoo", "", "foo", "x\ny", "\n".join(f"foo {'bar' * (i % 3)}" for i in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: [tuple(x) for x in r.e] for r in df.select("i", listings.best_excerpts(F.col("t"), ["foo", "bar"], 2).alias("e")).collect()}
    assert got == {i: greedy(t, ["foo", "bar"], 2) for i, t in enumerate(texts)}


def test_commands(spark):
    df = spark.createDataFrame([('EXECUTE: f(a="1", b="x y", a="2")\nEXECUTE: g()\nEXECUTE: g()',), ("none",), (None,)], "t string")
    found = df.select(F.explode(listings.commands(F.col("t"))).alias("c"))
    got = [(r.n, r.a) for r in found.select(listings.command_name(F.col("c")).alias("n"), listings.command_arguments(F.col("c")).alias("a")).collect()]
    assert got == [("f", {"b": "x y", "a": "2"}), ("g", {})]


def test_pointer_tables(spark):
    words = [5, 7, 1, 5, 6, 7, 2**63 + 5]
    data = b"".join(w.to_bytes(8, "little") for w in words) + b"\x05"
    seg = spark.createDataFrame([(1, 64, bytearray(data)), (2, 0, bytearray(b"")), (3, 0, None)], "s int, base long, data binary")
    fns = spark.createDataFrame([(5, "e"), (6, "f"), (7, "g")], "addr long, name string")
    got = listings.pointer_tables(seg, ["s"], fns).collect()
    assert [(r.s, r.table_address, r.entry_count, [e.name for e in r.entries]) for r in got] == [(1, 88, 3, ["e", "f", "g"])]
