"""Ranked search, alignment and packing against brute force, with nulls, ties and odd texts."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import alignment, packing, ranked, registry
from lodestone.llm.wordwise import Known, Words, byte_characters, chunked

SCHEMA = "doc_id long, text string, ids string, t string, n string, row string, item string"
ODD = ["", None, " ", "   ", "tail ", "tail  ", "a  b\n\n c\td", "nbsp  x 　 y", "file\x1c sep", "x▁y z", "<|endoftext|> and </s> <s> <0x41>", "it's 'S O'Clock we'll", "déjà ÉTÉ İstanbul ŉ ΟΔΟΣ é", "漢字 かな 🙂 \x00 end", "12 345.67 --- ???", "ſtraße Ǆ ÿ", "w" * 5000, "blank " * 3000]


def rows_of(seed=1, n=40):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("token", "Wörter", "re", "x", "ung", "the") for b in ("", "s", ",", "tion.", "é")]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 60, 400]))) for _ in range(n)]
    rows = [(i, t, "c", "c", "c", "c", "c") for i, t in enumerate(texts)]
    return rows + [rows[-1]] * 3 + [(None, texts[-2], *rows[0][2:]), (None, texts[-2], *rows[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "docs")
    spark.createDataFrame(rows_of(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- tokens of chunks


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("special", [True, False])
def test_words_are_those_of_the_tokenizer(name, special):
    from tokenizers import Tokenizer

    file = open(registry.tokenizer_file(name)).read()
    plain = Tokenizer.from_str(file)
    plain.encode_special_tokens = not special
    chunks = [f" {t}" for t in ODD if t] + ["'s", "it's", " ŉx", "A1b2'll", " İI", "ǅǆ", " ~", "||<"]
    assert [np.frombuffer(x, "<u4").tolist() for x in Words(file, special).packed([c.encode() for c in chunks])] == [plain.encode(c, add_special_tokens=False).ids for c in chunks]
    other = json.loads(file) | {"pre_tokenizer": None}
    assert Words(json.dumps(other)).find is None


# ---------------------------------------------------------------- search


def terms_of(text):
    return re.findall(ranked.TERM, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def ranks(docs, items, k):
    found = [(i, Counter(terms_of(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms_of(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("k", "room", "block"), [(20, 1 << 20, 1 << 18), (3, 40, 1 << 18), (5, 1, 4), (1, 100, 1)])
def test_search(spark, k, room, block):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(60)] + ["Über", "the", "THE", "a\x7fb"]
    docs = [(i, " ".join(rng.choice(vocabulary[: rng.choice([8, 30, 64])]) for _ in range(rng.choice([1, 4, 30, 200])))) for i in range(70)]
    docs += [(70, None), (71, ""), (72, " .,; "), docs[3], docs[3], (None, docs[5][1]), (500, docs[5][1]), (73, "the " * 20000)]
    items = [(j, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 20])))) for j in range(12)] + [(50, None), (51, "absent"), (52, "the the the T1"), (52, "the the the T1")]
    d = spark.createDataFrame([(*x, 1, "c") for x in docs], "doc_id long, text string, n long, terms string").repartition(3)
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank long").repartition(2)
    got = sorted((tuple(r) for r in ranked.search(d, q, k, room, block).collect()), key=repr)
    assert got == ranks(docs, items, k)


def test_search_without_rows(spark):
    d, q = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(d.limit(0), q).count() == 0 and ranked.search(d, q.limit(0)).count() == 0
    assert [r.doc_id for r in ranked.search(d, q).collect()] == [1]


def test_stops_early_and_stays_exact():
    """Rare terms decide: the postings of the common term are never added up."""
    rng = np.random.default_rng(2)
    docs, terms, impacts = 3000, [], []
    for d in range(docs):
        own = [0] + ([1] if d % 100 == 0 else [])
        terms += own
        impacts += [int(rng.integers(1, 50)) if t == 0 else int(rng.integers(900, 1000)) for t in own]
    lengths = np.array([1 + (d % 100 == 0) for d in range(docs)])
    terms, impacts = np.array(terms), np.array(impacts)
    shard = ranked.Shard(np.arange(docs), np.zeros(docs, bool), lengths, terms, impacts, 2)
    added, whole = 0, np.add.at

    class Spy:
        @staticmethod
        def at(a, i, v):
            nonlocal added
            added += len(i)
            whole(a, i, v)

    real, np.add = np.add, Spy
    try:
        at, scores = shard.search(np.array([0, 1]), np.array([1, 1]), 20)
    finally:
        np.add = real
    sums = np.zeros(docs, np.int64)
    np.add.at(sums, np.repeat(np.arange(docs), lengths), impacts)
    want = sorted(range(docs), key=lambda d: (-sums[d], d))[:20]
    assert at.tolist() == want and scores.tolist() == sums[want].tolist() and added < 200


# ---------------------------------------------------------------- alignment


def test_bitsets():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.choice([1, 63, 64, 65, 300])
        a, b = (sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}) for _ in range(2))
        i, j, shared = alignment.links(np.array(a), np.array(b), n)
        spans = [list(pairwise([0, *x])) for x in (a, b)]
        want = [(p, q) for p, x in enumerate(spans[0]) for q, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
        assert list(zip(i.tolist(), j.tolist(), strict=True)) == want and shared.tolist() == sorted({*a} & {*b})


def align_by_loops(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_file = registry.tokenizer_file("byte_bpe_50k.json")
    t, sp = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=registry.tokenizer_file())
    t.encode_special_tokens = True
    back = {c: b for b, c in byte_characters().items()}
    found = []
    for text in texts:
        whole = f" {text or ''}".encode()
        a, b = (t.encode(f" {text}", add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        parts = [[bytes(back[c] for c in t.id_to_token(i)) for i in a], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]]
        found.append((a, b, *[np.cumsum([0, *map(len, p)]).tolist() for p in parts]) if text and all(b"".join(p) == whole for p in parts) else None)
    pairs = [[] if f is None else [(f[0][i], f[1][j]) for i in range(len(f[0])) for j in range(len(f[1])) if f[2][i] < f[3][j + 1] and f[3][j] < f[2][i + 1]] for f in found]
    counts, highest = Counter(x for p in pairs for x in p), defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for f, p in zip(found, pairs, strict=True):
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = [0, *sorted({*f[2][1:]} & {*f[3][1:]})]
        groups = ["|".join(",".join(str(x) for x, e in zip(f[k], f[k + 2][1:], strict=True) if lo < e <= hi) for k in (0, 1)) for lo, hi in pairwise(cuts)]
        out.append((len(f[0]), len(f[1]), len(groups), len(p), sum(counts[x] == highest[x[1]] for x in p), sum(counts[x] for x in p), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("most", [1 << 21, 40])
def test_alignment(spark, docs, most):
    rows = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 3000]
    small = docs.where("coalesce(length(text), 0) < 3000")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = alignment.digested(alignment.aligned(small, registry.tokenizer_file("byte_bpe_50k.json"), registry.tokenizer_file(), most))
    got = sorted(((r.doc_id, *[r[n] for n in names]) for r in out.collect()), key=repr)
    want = align_by_loops([r.text for r in rows])
    assert got == sorted(((r.doc_id, *w) for r, w in zip(rows, want, strict=True)), key=repr)
    assert sum(w[0] == 0 for w in want) >= 3  # null, empty, marker


def test_alignment_of_long_texts_and_of_none(spark, docs):
    a, b = registry.tokenizer_file("byte_bpe_50k.json"), registry.tokenizer_file()
    got = alignment.aligned(docs.where("length(text) >= 3000").select("doc_id", "text"), a, b).collect()
    assert len(got) >= 2 and all(r.n_links == r.n_a + r.n_b - r.n_groups > 0 for r in got)
    assert alignment.digested(alignment.aligned(docs.limit(0), a, b)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_a, r.groups_sha256) for r in alignment.digested(alignment.aligned(nothing, a, b)).collect()) == [(1, 0, ""), (2, 0, "")]


def test_whole_texts_as_chunks(spark, docs, monkeypatch):
    """Without a cut that both sides respect, texts are aligned whole, with the same result."""
    a, b = registry.tokenizer_file("byte_bpe_50k.json"), registry.tokenizer_file()
    pair = alignment.Pair(open(a).read(), open(b, "rb").read())
    assert pair.apart
    texts = [r.text for r in docs.collect() if r.text]
    import pyarrow as pa

    sums = []
    for apart in (True, False):
        known = alignment.Known(pair.counted)
        numbers, codes, firsts = alignment._columns(pa.array(texts), known, apart)
        per = known.listed("pairs", numbers)[1][codes]
        sums.append(alignment.sums(per, firsts)[[bool(x) for x in alignment.sums(~known.column("good", numbers)[codes], firsts) == 0]].tolist())
    assert sums[0] == sums[1]


# ---------------------------------------------------------------- packing


def test_tightest_window():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice([4, 8, 64])
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 50))]
        windows = packing.best_fit(sizes, length)
        rooms = []
        for s in sorted(sizes, reverse=True):
            fits = [r for r in rooms if r >= s]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else length) - s)
        assert sorted(sum(sizes[i] for i in w) for w in windows) == sorted(length - r for r in rooms)
        out = packing.fill(windows, sizes, length)
        used = [sum(b - a for _, a, b in w) for w in out]
        assert all(0 < u <= length and u & (u - 1) == 0 for u in used)
        assert sorted((i, p) for w in out for i, a, b in w for p in range(a, b)) == [(i, p) for i in range(len(sizes)) for p in range(sizes[i])]


@pytest.mark.parametrize(("length", "room"), [(2048, 1 << 21), (64, 500), (16, 1)])
def test_packing(spark, docs, length, room):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(registry.tokenizer_file("word_bpe_49k.json"))
    want = Counter((r.doc_id, tuple([*t.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.collect())
    pieces = packing.packed(docs, registry.tokenizer_file("word_bpe_49k.json"), length, room=room).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0  # nothing is padded
    left = Counter()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.doc_tokens, tuple(np.frombuffer(p.ids, "<u4").tolist())))
    for (doc, ids), n in want.items():
        for start, total, part in by_doc[doc]:
            if total == len(ids) and ids[start : start + len(part)] == part:
                left[doc, ids] += len(part)
    single = {k: n for k, n in want.items() if sum(d == k[0] for d, _ in want) == 1}
    assert all(left[k] == n * len(k[1]) for k, n in single.items()) and sum(p.length for p in pieces) == sum(n * len(k[1]) for k, n in want.items())


def encoded_by_parts(words, texts, room=1 << 20):
    """Ids of each text, and the parts that were learnt."""
    import pyarrow as pa

    seen = []

    def learn(parts):
        seen.extend(parts)
        return {}, {"ids": words.parts_flat(parts)}

    numbers, codes, firsts, _ = chunked(pa.array(texts), known := Known(learn, room), words.cut)
    ids, lengths = known.listed("ids", numbers, codes)
    ends = np.concatenate([[0], np.cumsum(lengths)])[firsts].tolist()
    return [ids[a:b].tolist() for a, b in pairwise(ends)], seen


def test_words_are_encoded_once_whatever_stands_around_them():
    from tokenizers import Tokenizer

    file = registry.tokenizer_file("word_bpe_49k.json")
    texts = ["word", "Word, (word).\nWORD's\tword!", "", " \n", "x1word2", "漢字 word 漢字", "word<|endoftext|>"]
    got, seen = encoded_by_parts(Words(open(file).read()), texts)
    assert got == [e.ids for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
    assert sorted(seen) == sorted([b"word", b",", b"(", b").", b"'s", b"!", b"x", b"1", b"2", "漢字".encode(), " 漢字".encode(), b"word<|endoftext|>"])


def test_parts_are_those_of_the_pre_tokenizer():
    from tokenizers import Tokenizer

    file, rng = registry.tokenizer_file("word_bpe_49k.json"), random.Random(3)
    words, t = Words(open(file).read()), Tokenizer.from_file(file)
    atoms = [*"'stmdrlveSTLVaÀé×÷İıßſǅɐɏªº01² \n\t\r\v\x00\x1c\x7f<|>/.-_\"中яΣς\u0301\u0338\u00a0\u0085\u2003\u200b\u212a", "<|", "<|endoftext|>", "</w>", "'re", "'LL", "''", "é", "🙂"]
    texts = [x for x in ODD if x is not None] + ["".join(rng.choices(rng.sample(atoms, rng.choice([4, 12, len(atoms)])), k=rng.randint(0, 12))) for _ in range(4000)]
    assert encoded_by_parts(words, texts)[0] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert all(encoded_by_parts(words, [x])[0] == [t.encode(x, add_special_tokens=False).ids] for x in texts[:300] if x.strip())


def test_other_word_vocabularies_are_not_cut_into_parts(spark, docs, tmp_path):
    """Another pattern, other special tokens or a missing byte: chunks go the way they went."""
    from tokenizers import Tokenizer

    about = json.load(open(registry.tokenizer_file("word_bpe_49k.json")))
    pattern = about["pre_tokenizer"]["pretokenizers"][0]["pattern"]
    kinds = [json.loads(json.dumps(about)) for _ in range(3)]
    kinds[0]["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": pattern["Regex"].replace("[\\p{N}]|", "[\\p{N}]+|")}
    kinds[1]["added_tokens"][0]["content"] = "[x]"
    kinds[2]["model"]["vocab"]["none</w>"] = kinds[2]["model"]["vocab"].pop("q</w>")
    kinds[2]["model"]["merges"] = [m for m in kinds[2]["model"]["merges"] if not (m if isinstance(m, str) else " ".join(m)).endswith("q</w>")]
    texts = ["word 12,345 [x] Q q's x", "a"]
    for i, kind in enumerate(kinds):
        (path := tmp_path / f"{i}.json").write_text(json.dumps(kind))
        words = Words(path.read_text())
        assert words.cut is None
        assert encoded_by_parts(words, texts[1:])[0] == [Tokenizer.from_file(str(path)).encode("a", add_special_tokens=False).ids]
    path = str(tmp_path / "0.json")
    pieces = packing.packed(spark.createDataFrame([(1, texts[0])], "doc_id long, text string"), path).orderBy("start").collect()
    assert np.frombuffer(b"".join(p.ids for p in pieces), "<u4").tolist() == [*Tokenizer.from_file(path).encode(texts[0], add_special_tokens=False).ids, 1]


def test_packing_of_none_and_digests(spark, docs):
    file = registry.tokenizer_file("word_bpe_49k.json")
    assert packing.packed(docs.limit(0), file).count() == 0
    row = packing.packed(spark.createDataFrame([(7, None)], "doc_id long, text string"), file).withColumn("c", F.crc32("ids")).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset, r.c) for r in row] == [(7, 0, 1, 1, 0, zlib.crc32(np.array([1], "<u4").tobytes()))]
    with pytest.raises(ValueError, match="power of two"):
        packing.packed(docs, file, 1000)


# ---------------------------------------------------------------- ids in shards


@pytest.mark.parametrize(("values", "dtype", "padding"), [([70_000, 5], "<u2", 0xFFFF), ([0xFFFF], "<u2", 0xFFFF), ([-1], "<u2", 0xFFFF), ([7], "<u4", 7)])
def test_ids_that_do_not_fit_are_errors(spark, tmp_path, values, dtype, padding):
    from lodestone.llm import token_output

    df = spark.createDataFrame([(1, [1, 2]), (2, values)], "doc_id long, ids array<int>")
    df.write.parquet(str(tmp_path / "ids"))
    with pytest.raises(Exception, match="do not fit"):
        token_output.materialised(spark.read.parquet(str(tmp_path / "ids")), str(tmp_path / "shards"), 4, ids="ids", dtype=dtype, separator=2, padding=padding)
    assert not (tmp_path / "shards" / "manifest.json").exists()  # an incomplete folder has none


def test_wide_ids_and_equal_neighbours(spark, tmp_path):
    from lodestone.llm import token_output

    assert token_output.width_for(65_535) == ("<u2", 0xFFFF) and token_output.width_for(65_536) == ("<u4", 0xFFFFFFFF)
    rows = [(5, [70_000, 0xFFFF, 3]), (5, [9]), (None, [8]), (6, None)]
    spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1).write.parquet(str(tmp_path / "ids"))
    dtype, padding = token_output.width_for(70_001)
    out = token_output.materialised(spark.read.parquet(str(tmp_path / "ids")), str(tmp_path / "shards"), 16, ids="ids", dtype=dtype, separator=2, padding=padding).collect()
    (slot,) = token_output.read_slots(str(tmp_path / "shards"), 0, 9)
    assert slot.tolist()[:9] == [70_000, 0xFFFF, 3, 2, 9, 2, 8, 2, 2] and slot.tolist()[9:] == [padding] * 7
    assert [(r.n_tokens, r.doc_ids) for r in out] == [(9, [5, 5, 6])]


def test_piece_ids(docs):
    import sentencepiece

    file = registry.tokenizer_file()
    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    assert alignment.vocabulary_size(file) == 32_000
    want = sorted(((r.doc_id, sp.encode(r.text or "")) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in alignment.piece_ids(docs, file).collect()), key=repr) == want
    for dtype in ("<u2", "<u4"):
        assert sorted(((r.doc_id, np.frombuffer(r.ids, dtype).tolist()) for r in alignment.piece_ids(docs, file, dtype).collect()), key=repr) == want
    with pytest.raises(ValueError, match="does not hold"):
        alignment.piece_ids(docs, file, "u1")


def test_packed_ids_are_laid_out_as_listed_ones(spark, tmp_path):
    from lodestone.llm import token_output

    rows = [(5, [70, 300, 3]), (5, [9]), (None, [8]), (6, None), (7, []), (8, list(range(3, 2000)))]
    spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1).write.parquet(str(tmp_path / "lists"))
    spark.createDataFrame([(i, None if x is None else np.array(x, "<u2").tobytes()) for i, x in rows], "doc_id long, ids binary").coalesce(1).write.parquet(str(tmp_path / "bytes"))
    one, two = (token_output.materialised(spark.read.parquet(str(tmp_path / x)), str(tmp_path / f"{x}-shards"), 16, ids="ids", dtype="<u2", separator=2, padding=0xFFFF) for x in ("lists", "bytes"))
    assert sorted(one.collect()) == sorted(two.collect())
    for values in (np.array([4, 0xFFFF], "<u2").tobytes(), b"abc"):
        spark.createDataFrame([(1, values)], "doc_id long, ids binary").write.mode("overwrite").parquet(str(tmp_path / "odd"))
        with pytest.raises(Exception, match="are no ids"):
            token_output.materialised(spark.read.parquet(str(tmp_path / "odd")), str(tmp_path / "odd-shards"), 16, ids="ids", dtype="<u2", separator=2, padding=0xFFFF)
