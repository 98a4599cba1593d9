"""Licence scans by a positional rare-token index.

Templates are word sequences with a label and a mandatory key phrase.  One pass counts in how many
documents each template word occurs.  A template is posted under its rarest words, with their offsets;
a document looks up those of its words that have postings: word o of a template at place p speaks for
the start p - o, and words that stand in their template's relative positions speak for one start.  The
key phrase is verified at the start, and the IDF weight of the words around it must reach ``least``.
All of this happens within a row, so nothing but the word counts is shuffled.

Base phrases are templates that consist of their key phrase alone: every place where the words stand
consecutively is found, without a limit.

Nulls and ties: a null text is empty (no words, no labels, score 0); rows with equal doc_id and text get
equal results, rows with equal doc_id and other texts their own; null doc_ids are kept.  An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ascii_lower, whole_text, words_by

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SHIFT = 1 << 12  # a start may lie this far before the text

# Phrases of the base labels.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Label, opening words of well-known licence texts and notices, mandatory key phrase.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "modify and or distribute this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]


def index_of(entries: list[tuple[str, list[str], list[str], bool]], idf: dict[str, float], rare: int) -> tuple[dict[str, list[tuple]], list[tuple]]:
    """Postings by word, (template, offset), and per template its label, whether it is a base phrase, its key phrase, the key's offset and the weighted words.

    Every template is posted under its ``rare`` rarest words and the rarest word of its key phrase, so that
    no place of a key phrase is missed; a base phrase is posted under its rarest word alone.
    """
    postings, templates = {}, []
    whole = {}  # by label: the weight of the shortest notice that has the phrase
    for label, words, _, is_base in entries:
        if not is_base:
            whole.setdefault(label, []).append(words)
    for i, (label, words, key, is_base) in enumerate(entries):
        at = next(j for j in range(len(words)) if words[j : j + len(key)] == key)
        by_rarity = sorted(range(len(words)), key=lambda j: (-idf[words[j]], j))
        must = list(range(at, at + len(key)))
        posted = {next(j for j in by_rarity if j in must)} | set([] if is_base else by_rarity[:rare])
        for j in sorted(posted):
            postings.setdefault(words[j], []).append((i, j))
        used = sorted({*must, *by_rarity[:rare]})
        weigh = lambda x: sum(idf[w] for w in x)
        around = [weigh(x) for x in whole.get(label, []) if any(x[j : j + len(key)] == key for j in range(len(x)))]
        total = min(around, default=weigh(words)) if is_base else weigh(words[j] for j in used)
        templates.append((label, is_base, key, at, [(j, words[j], idf[words[j]] / total) for j in used]))
    return postings, templates


def scan(docs: DataFrame, templates=TEMPLATES, base: dict[str, str] = BASE, rare: int = 4, least: float = 0.5) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    rare: words under which a template is posted.  A template counts where its key phrase stands and the
    IDF weight of its key phrase and rare words that stand at their places is at least ``least`` of their
    sum; a base phrase counts wherever it stands, and weighs against the shortest notice of its label that
    holds it.  Only counts of template words and the number of documents reach the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_by(ascii_lower(whole_text()), SEPARATOR).alias("w"))
    entries = [(label, phrase.split(), phrase.split(), True) for label, phrase in base.items()] + [(label, text.split(), key.split(), False) for label, text, key in templates]
    vocabulary = sorted({x for _, words, _, _ in entries for x in words})
    seen = rows.select(F.explode(F.array_append(F.array_intersect("w", F.lit(vocabulary)), F.lit(None).cast("string"))).alias("word"))
    counts = {r.word: r.n for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = {x: math.log((1 + counts.get(None, 0)) / (1 + counts.get(x, 0))) + 1 for x in vocabulary}
    postings, known = index_of(entries, idf, rare)

    entry = lambda t, j: F.struct(F.lit(t).alias("t"), F.lit(j).alias("off"), F.lit(known[t][3]).alias("at"), F.lit(known[t][2]).alias("key"))
    index = F.create_map(*[x for word, found in postings.items() for x in (F.lit(word), F.array(*[entry(t, j) for t, j in found]))])
    notices = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(is_base).alias("base"), F.array(*[F.struct(F.lit(j).alias("off"), F.lit(x).alias("word"), F.lit(v).alias("share")) for j, x, v in used]).alias("words")) for label, is_base, _, _, used in known])

    def verified(hit, e):
        """Template and start as one number, where the key phrase stands at its place."""
        start = hit["i"] - e["off"]
        stands = F.when(start + e["at"] >= 0, F.slice("w", F.greatest(start + e["at"], F.lit(0)) + 1, F.size(e["key"])) == e["key"])
        return F.when(stands, F.shiftleft(e["t"].cast("long"), 40) + start + SHIFT)

    hits = F.array_compact(F.transform("w", lambda x, i: F.when(x.isin(sorted(postings)), F.struct(i.alias("i"), x.alias("x")))))
    met = F.flatten(F.transform("hits", lambda h: F.array_compact(F.transform(F.element_at("index", h["x"]), lambda e: verified(h, e)))))
    rows = rows.select("doc_id", "w", hits.alias("hits")).select("doc_id", "w", "hits", F.when(F.size("hits") > 0, index).alias("index"))
    # the postings of one place meet in one number
    rows = rows.select("doc_id", "w", F.when(F.size("hits") > 0, F.array_distinct(met)).otherwise(F.array().cast("array<long>")).alias("met"))

    def place(x):
        notice, start = F.get(notices, F.shiftright(x, 40).cast("int")), (x.bitwiseAND(F.lit((1 << 40) - 1)) - SHIFT).cast("int")
        cover = F.aggregate(notice["words"], F.lit(0.0), lambda a, y: a + F.when(F.get(F.col("w"), start + y["off"]) == y["word"], y["share"]).otherwise(0.0))
        return F.struct(notice["label"].alias("label"), notice["base"].alias("base"), start.cast("long").alias("start"), cover.alias("cover"))

    found = F.filter(F.transform("met", place), lambda x: x["base"] | (x["cover"] >= least))
    out = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), found.alias("found"))
    based = F.transform(F.filter("found", lambda x: x["base"]), lambda x: x["start"])
    names = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return out.select(
        "doc_id", "n_words", F.size(based).cast("long").alias("n_base"), F.array_min(based).alias("first_word"), F.array_max(based).alias("last_word"),
        names(F.transform(F.filter("found", lambda x: x["base"]), lambda x: x["label"])).alias("base_labels"), names(F.transform("found", lambda x: x["label"])).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("found", lambda x: x["cover"])), F.lit(0.0))).alias("score"),
    )
