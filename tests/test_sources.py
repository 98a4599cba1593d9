"""Readers, writers, streams and the chunker over small files."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone import sources, streaming
from lodestone.operators import chunks


def test_symbol_map(spark, tmp_path):
    (tmp_path / "a.map").write_text("80003100 000010 80003100 4 memset \n8000310g 1 2 3 no\n80003200 x y z operator new (long)\n80003100 0 0 0 memcpy\n80003300 0 0 0\n\nshort\n")
    got = {r.address: r.name for r in sources.read_symbol_map(spark, str(tmp_path)).collect()}
    assert got == {0x80003100: "memcpy", 0x80003200: "operator new (long)"}


def test_offset_table(spark, tmp_path):
    (tmp_path / "n.md").write_text("text\n| offset | type | refs | meaning |\n|---|---|---|---|\n| 0x10, 0x1A | u8 | 3 | health |\n| 0x20 | u8 | too few |\n| 0x30 | u16 | 1 |  |\n| 0x10 | s16 | 4 | speed |\n")
    got = {r.offset: (r.kind, r.meaning) for r in sources.read_offset_table(spark, str(tmp_path)).collect()}
    assert got == {"0x10": ("s16", "speed"), "0x1a": ("u8", "health")}


def test_roster_and_index(spark, tmp_path):
    (tmp_path / "r.csv").write_text("filename,name\n PL0a1B ,x\nother,y\n,z\n")
    assert [(r.filename, r.name) for r in sources.read_roster(spark, str(tmp_path / "r.csv")).collect()] == [("pl0a1b", "x")]
    (tmp_path / "index.tsv").write_text("80001000\tf\tmore\n0x80002000\tf\nbad\tg\n8000300A\tg\nalone\n")
    assert {r.name: r.address for r in sources.read_index(spark, str(tmp_path / "index.tsv")).collect()} == {"f": "80001000", "g": "8000300a"}


def test_sessions(spark, tmp_path):
    f = {"address": "1", "old_name": "a", "new_name": "b", "behavior_summary": "s", "analysis_timestamp": 1.5}
    for name, when in (("old", "2024-01-01"), ("new", "2024-02-01")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"metadata": {"session_id": name, "last_modified": when, "total_functions": 9}, "analyzed_functions": {"1": f, "2": f | {"new_name": "a"}}, "rag_vectors": [[0.5, 1]], "analysis_log": []}, indent=1))
    s = sources.read_sessions(spark, f"{tmp_path}/*.json")
    assert [r.i for r in s.select(F.col("metadata")["session_id"].alias("i")).collect()] == ["new", "old"]
    assert sorted((r.session_id, r.key, r.new_name) for r in sources.session_functions(s).collect()) == [("new", "1", "b"), ("new", "2", "a"), ("old", "1", "b"), ("old", "2", "a")]
    sources.write_sessions(s, f"{tmp_path}/out", vectors=False)
    back = sources.read_sessions(spark, f"{tmp_path}/out").collect()
    assert [(r.metadata["total_functions"], r.metadata["renamed_functions"], r.rag_vectors) for r in back] == [("2", "1", None)] * 2


def test_vectors(spark, tmp_path):
    m = np.random.default_rng(1).random((5000, 3), np.float32)
    np.save(tmp_path / "vectors.npy", m)
    got = sorted((r.row, r.embedding) for r in sources.read_vectors(spark, f"{tmp_path}/vectors.npy").collect())
    assert [i for i, _ in got] == list(range(5000))
    assert np.array_equal(np.array([e for _, e in got], np.float32), m)


def test_events_rotate(spark, tmp_path):
    df, path = spark.range(10).select("id", F.lit("llm").alias("interaction_type")), f"{tmp_path}/events"
    for _ in range(2):
        sources.append_events(df, path)
    assert sources.read_events(spark, path, "id long").count() == 20
    sources.append_events(df, path, most=10)
    assert sources.read_events(spark, path, "id long").count() == 10
    assert sources.read_events(spark, f"{path}.1", "id long").count() == 20
    assert [r.id for r in sources.read_log(spark, path, "id long, interaction_type string", "llm", 2, "id").collect()] == [9, 8]


def test_chunk_files(spark, tmp_path):
    (tmp_path / "c.c").write_text("head\n// ==== 80001000 f ====\nint f;\n// ==== 0x80002000 g h ====\n")
    got = [(r.address, r.name, r.body) for r in sources.read_chunks(spark, str(tmp_path)).collect()]
    assert got == [("80001000", "f", "int f;\n"), ("80002000", "g h", "")]


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string").coalesce(1).write.json(source)
    run = lambda: streaming.drain(streaming.first_seen(streaming.tail(spark, source, "id int, k string"), ["k"]), out, state)
    assert sorted(r.k for r in run().collect()) == ["a", "b"]
    spark.createDataFrame([(4, "b"), (5, "c")], "id int, k string").write.mode("append").json(source)
    assert sorted(r.k for r in run().collect()) == ["a", "b", "c"]


def ends_by_trial(text, most, overlap, window):
    """Tries every end from the longest down, once for each kind."""
    out, start = [], 0
    while len(text) > most:
        end = min(start + most, len(text))
        if end < len(text):
            tried = [e for marks in (["\n\n"], ["\n"], [". ", ".\n", ";\n", "}\n"]) for e in range(end, start, -1) for m in marks if text[start:e].endswith(m) and e - len(m) > start + most // 2 and e - len(m) >= end - window]
            end = tried[0] if tried else end
        out += [text[start:end].strip()] * bool(text[start:end].strip())
        if end == len(text):
            return out or [text[:most]]
        start = max(start + 1, end - overlap)
    return [text]


@pytest.mark.parametrize(("most", "overlap", "window"), [(20, 5, 2000), (30, 0, 10), (8, 7, 3), (50, 10, 2000)])
def test_chunks(most, overlap, window):
    rng = np.random.default_rng(most)
    for n in (0, 1, 20, 21, 300):
        text = "".join(rng.choice(list("ab \n.;}"), n, p=[0.3, 0.2, 0.2, 0.1, 0.1, 0.05, 0.05]))
        assert chunks.cut(text, most, overlap, window) == ends_by_trial(text, most, overlap, window)


def test_chunks_of_rows(spark):
    df = spark.createDataFrame([(1, "ab. cd. ef"), (2, ""), (3, None)], "i int, t string")
    assert {r.i: r.c for r in df.select("i", chunks.chunks(F.col("t"), 6, 0).alias("c")).collect()} == {1: ["ab. cd", ". ef"], 2: [""], 3: [""]}


@pytest.mark.parametrize(("most", "overlap", "window"), [(20, 5, 2000), (30, 0, 10), (8, 7, 3), (50, 10, 2000), (1000, 100, 2000)])
def test_chunks_of_columns(spark, most, overlap, window):
    rng = np.random.default_rng(most + 1)
    texts = ["".join(rng.choice(list("ab \n.;}\x1c\U0001f600"), n, p=[0.3, 0.15, 0.2, 0.1, 0.1, 0.05, 0.04, 0.01, 0.05])) for n in (0, 1, most, most + 1, 3 * most, 3000)]
    df = spark.createDataFrame(list(enumerate([*texts, " " * (2 * most + 1), "x" * (5 * most)])), "i int, t string")
    for r in df.select("t", chunks.chunks(F.col("t"), most, overlap, window).alias("c")).collect():
        assert r.c == ends_by_trial(r.t, most, overlap, window)


def test_chunks_of_a_long_text(spark):
    text = "word and word. " * 200_000
    got = spark.createDataFrame([(text,)], "t string").select(chunks.chunks(F.col("t"), 1000, 100).alias("c")).first().c
    assert got == ends_by_trial(text[:20_000], 1000, 100, 2000)[:15] + got[15:] and len(got) > 3000


def test_chunks_without_ends_cost_few_searches():
    import time

    start = time.process_time()
    assert len(chunks.cut("x" * 2_000_000, 1000, 100)) == 2223
    assert time.process_time() - start < 1
