"""Text features, rules and scores."""

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lodestone.catalog import query
from lodestone.functions import boosted, blank_words, jaccard, keyword_score, weighted_contains
from lodestone.operators.chunks import chunks as bounded_chunks
from lodestone.operators.retrieval import keyword_top
from lodestone.sources import load


@query("q_code_metrics", r"""
    WITH m AS (SELECT page_id, len(regexp_extract_all(html, '[A-Za-z_][A-Za-z0-9_]*\(')) AS calls, len(regexp_extract_all(html, '<[a-z]+')) AS tags,
                      len(list_filter(string_split(html, chr(10)), lambda x: trim(x) <> '')) AS lines FROM pages)
    SELECT *, CASE WHEN calls <= 5 THEN 'simple' WHEN calls <= 15 THEN 'moderate' ELSE 'complex' END AS tier FROM m""")
def code_metrics(spark, d):
    p = load(spark, d, "pages")
    n = lambda x: F.size(F.regexp_extract_all("html", F.lit(x), F.lit(0))).cast("long")
    lines = F.size(F.filter(F.split("html", "\n"), lambda x: F.trim(x) != "")).cast("long")
    m = p.select("page_id", n(r"[A-Za-z_][A-Za-z0-9_]*\(").alias("calls"), n("<[a-z]+").alias("tags"), lines.alias("lines"))
    return m.withColumn("tier", F.when(F.col("calls") <= 5, "simple").when(F.col("calls") <= 15, "moderate").otherwise("complex"))


# Fixed values of this query: families in priority order.
FAMILIES = {"contact": r"[a-z0-9.]+@[a-z0-9.]+", "network": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "secret": "(?i)(token|password|secret) *[:=]", "legal": "(?i)licen[sc]e"}


@query("q_categories", r"""
    WITH c AS (SELECT doc_id, [CASE WHEN regexp_matches(text, '[a-z0-9.]+@[a-z0-9.]+') THEN 'contact' END, CASE WHEN regexp_matches(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') THEN 'network' END,
      CASE WHEN regexp_matches(text, '(?i)(token|password|secret) *[:=]') THEN 'secret' END, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'legal' END] AS raw FROM documents)
    SELECT doc_id, array_to_string(list_sort(list_filter(raw, lambda x: x IS NOT NULL)), ',') AS categories, coalesce(list_filter(raw, lambda x: x IS NOT NULL)[1], 'general') AS main FROM c""")
def categories(spark, d):
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), k) for k, p in FAMILIES.items()]))
    return load(spark, d, "documents").select("doc_id", hits.alias("c")).select("doc_id", F.array_join(F.array_sort("c"), ",").alias("categories"), F.coalesce(F.get("c", F.lit(0)), F.lit("general")).alias("main"))


@query("q_rule_match", r"""
    WITH r(rule, kind, rx, weight) AS (VALUES ('pii', 'mail', '[a-z0-9.]+@[a-z0-9.]+', 0.6), ('pii', 'ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+', 0.4), ('leak', 'assign', 'token *=', 0.7), ('leak', 'hex', '[0-9a-f]{32}', 0.5), ('legal', 'licence', '(?i)licen[sc]ed', 0.5)),
         t(rule, threshold, severity) AS (VALUES ('pii', 0.5, 2), ('leak', 0.7, 1), ('legal', 0.5, 3)),
         h AS (SELECT doc_id, rule, sum(weight) AS w FROM documents, r WHERE regexp_matches(text, rx) GROUP BY 1, 2)
    SELECT doc_id, h.rule, severity, round(least(1, w / (2 * threshold)), 6) AS confidence FROM h JOIN t ON h.rule = t.rule WHERE round(w, 9) >= threshold""")
def rule_match(spark, d):
    """Weighted rules; the rules are columns of one scan, so no text is multiplied."""
    rules = {"pii": (0.5, 2, [(r"[a-z0-9.]+@[a-z0-9.]+", 0.6), (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 0.4)]), "leak": (0.7, 1, [("token *=", 0.7), ("[0-9a-f]{32}", 0.5)]), "legal": (0.5, 3, [("(?i)licen[sc]ed", 0.5)])}
    hits = []
    for name, (threshold, severity, patterns) in rules.items():
        w = sum((F.when(F.col("text").rlike(p), x).otherwise(0.0) for p, x in patterns), F.lit(0.0))
        hits.append(F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), w.alias("w"), F.lit(threshold).alias("threshold")))
    x = load(spark, d, "documents").select("doc_id", F.explode(F.array(*hits)).alias("h")).where("round(h.w, 9) >= h.threshold")
    return x.select("doc_id", "h.rule", "h.severity", F.round(F.least(F.lit(1.0), F.col("h.w") / (2 * F.col("h.threshold"))), 6).alias("confidence"))


# Fixed values of this query: context words, the factor of each kind and the confidence that it starts from.
BOOSTS = {"path": (["token", "secret", "the", "licen"], 1.15, 0.6), "command": (["token", "key", "tion", "@"], 1.2, 0.7)}


@query("q_context_boost", " UNION ALL ".join(f"""
    SELECT doc_id, '{kind}' AS kind, ({" + ".join(f"contains(lower(coalesce(text, '')), '{w}')::INTEGER" for w in words)}) AS hits,
           round(least(1.0, {start} * pow({factor}, {" + ".join(f"contains(lower(coalesce(text, '')), '{w}')::INTEGER" for w in words)})), 6) AS confidence FROM documents""" for kind, (words, factor, start) in BOOSTS.items()))
def context_boost(spark, d):
    """Confidence of two kinds of findings in each text, raised by the context words near them and capped at one."""
    low = F.lower(F.coalesce("text", F.lit("")))
    kinds = [F.struct(F.lit(kind).alias("kind"), sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0)).alias("hits"), F.round(boosted(F.lit(start), F.col("text"), words, factor), 6).alias("confidence")) for kind, (words, factor, start) in BOOSTS.items()]
    return load(spark, d, "documents").select("doc_id", F.inline(F.array(*kinds)))


@query("q_security_score", """
    SELECT doc_id, round(least(1.0, CASE WHEN contains(lower(text), 'token') THEN 0.15 ELSE 0 END + CASE WHEN contains(lower(text), 'license') THEN 0.15 ELSE 0 END + CASE WHEN contains(lower(text), '@') THEN 0.05 ELSE 0 END + CASE WHEN contains(lower(text), 'secret') THEN 0.15 ELSE 0 END), 6) AS score FROM documents""")
def security_score(spark, d):
    s = weighted_contains(F.col("text"), {"token": 0.15, "license": 0.15, "@": 0.05, "secret": 0.15})
    return load(spark, d, "documents").select("doc_id", F.round(s, 6).alias("score"))


@query("q_keyword_topk", r"""
    SELECT doc_id, round((length(lower(text)) - length(replace(lower(text), 'thatin', ''))) // 6 / greatest(len(list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda x: x <> '')), 1), 9) AS score
    FROM documents WHERE contains(lower(text), 'thatin') ORDER BY score DESC, doc_id LIMIT 10""")
def keyword_topk(spark, d):
    return keyword_top(load(spark, d, "documents"), "doc_id", "text", ["thatin"], 10)


@query("q_relevance_rank", """
    WITH s AS (SELECT conv_id, turn, role, round(CASE role WHEN 'user' THEN 2.0 ELSE 1.0 END + least(length(text), 1000) / 1000.0 + CASE WHEN contains(lower(text), 'the') THEN 3.0 ELSE 0 END, 6) AS score FROM conversations)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY score DESC, conv_id, turn) AS rank FROM s) WHERE rank <= 5""")
def relevance_rank(spark, d):
    score = F.when(F.col("role") == "user", 2.0).otherwise(1.0) + F.least(F.length("text"), F.lit(1000)) / 1000.0 + F.when(F.contains(F.lower("text"), F.lit("the")), 3.0).otherwise(0.0)
    s = load(spark, d, "conversations").select("conv_id", "turn", "role", F.round(score, 6).alias("score"))
    w = W.partitionBy("role").orderBy(F.desc("score"), "conv_id", "turn")
    return s.withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 5")


@query("q_jaccard", r"""
    WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda x: x <> '')) AS w FROM conversations),
         p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS v FROM t)
    SELECT conv_id, turn, round(len(list_intersect(w, v)) / (len(w) + len(v) - len(list_intersect(w, v))), 9) AS similarity FROM p WHERE v IS NOT NULL AND len(w) + len(v) > 0""")
def jaccard_turns(spark, d):
    t = load(spark, d, "conversations").select("conv_id", "turn", F.array_distinct(blank_words(F.lower("text"))).alias("w"))
    p = t.withColumn("v", F.lag("w").over(W.partitionBy("conv_id").orderBy("turn"))).where("v is not null and size(w) + size(v) > 0")
    return p.select("conv_id", "turn", F.round(jaccard(F.col("w"), F.col("v")), 9).alias("similarity"))


@query("q_consensus", r"""
    WITH v AS (SELECT source, x AS tag, count(DISTINCT doc_id) AS votes FROM (SELECT doc_id, source, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{9,}'))) AS x FROM documents) GROUP BY 1, 2),
         df AS (SELECT tag, count(DISTINCT source) AS df FROM v GROUP BY 1), n AS (SELECT count(DISTINCT source) AS n FROM documents),
         r AS (SELECT source, v.tag, votes, round(votes * ln(1 + n / df), 9) AS weight FROM v JOIN df ON v.tag = df.tag, n),
         k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY weight DESC, tag) AS rn, lead(weight) OVER (PARTITION BY source ORDER BY weight DESC, tag) AS second FROM r)
    SELECT source, tag, votes, weight, round(weight - coalesce(second, 0), 6) AS margin FROM k WHERE rn = 1""")
def consensus(spark, d):
    """Distinct observations vote for tags, weighted by rarity; the best of each key and its margin."""
    docs = load(spark, d, "documents").select("doc_id", "source", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), F.lit(0)))).alias("tag"))
    votes = docs.groupBy("source", "tag").agg(F.countDistinct("doc_id").alias("votes"))
    df = votes.groupBy("tag").agg(F.count(F.lit(1)).alias("df"))
    n = load(spark, d, "documents").agg(F.countDistinct("source").alias("n"))
    r = votes.join(df, "tag").crossJoin(n).withColumn("weight", F.round(F.col("votes") * F.log(1 + F.col("n") / F.col("df")), 9))
    # the best two of each of 64 parts first, so that a source's tags are in no one task
    order = F.struct((-F.col("weight")).alias("w"), "tag", "votes").alias("a")
    w = W.partitionBy("source", "part").orderBy(F.desc("weight"), "tag")
    tops = r.withColumn("part", F.pmod(F.xxhash64("tag"), F.lit(64))).withColumn("rn", F.row_number().over(w)).where("rn <= 2").select("source", order)
    k = tops.groupBy("source").agg(F.slice(F.array_sort(F.collect_list("a")), 1, 2).alias("k"))
    best, second = F.col("k")[0], F.get("k", F.lit(1))
    return k.select("source", best["tag"].alias("tag"), best["votes"].alias("votes"), (-best["w"]).alias("weight"), F.round(-best["w"] + F.coalesce(second["w"], F.lit(0.0)), 6).alias("margin"))


@query("q_contamination", """
    SELECT item_id, count(*) AS n_docs, min(doc_id) AS first_doc FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE b.text <> '' GROUP BY 1""")
def contamination(spark, d):
    """Documents that hold a whole benchmark item, of any length.

    Items are looked up by their first eight words (or all that they have) without the first and the last,
    which a document may write on into longer words; a document's runs of words of the lengths that occur
    are joined to them by hash, and the whole item is then verified in the text.
    """
    words = lambda c: F.filter(F.split(c, r"[ \t\n\r]+"), lambda x: x != "")
    b = load(spark, d, "benchmark").where("text <> ''").select("item_id", F.col("text").alias("item"), words("text").alias("iw"))
    inner = F.when(F.size("iw") > 2, F.slice("iw", 2, F.least(F.size("iw") - 2, F.lit(6))))
    b = b.select("item_id", "item", F.size(inner).alias("k"), F.xxhash64(F.array_join(inner, " ")).alias("key"))
    lengths = sorted(r.k for r in b.select("k").where("k > 0").distinct().collect())  # six numbers at most
    docs = load(spark, d, "documents")

    def runs_of(k: int):
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - k, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice("w", i + 1, k), " ")))

    runs = [runs_of(k) for k in lengths]
    keyed = docs.select("doc_id", words("text").alias("w")).select("doc_id", F.explode(F.array_distinct(F.concat(*runs))).alias("h")) if runs else None
    hit = None
    if runs:
        met = keyed.join(b.where("k > 0"), F.col("h") == F.col("key")).select(F.col("doc_id").alias("i"), "item_id", "item")
        hit = docs.join(met, F.col("doc_id") == F.col("i")).where(F.contains("text", "item")).select("doc_id", "item_id").distinct()
    # items of one or two words have nothing between their first and last
    short = b.where("k is null").select("item_id", "item").collect() if not b.where("k is null").isEmpty() else []
    for r in short:
        one = docs.where(F.contains("text", F.lit(r.item))).select("doc_id", F.lit(r.item_id).alias("item_id"))
        hit = one if hit is None else hit.union(one)
    if hit is None:
        hit = docs.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"))
    return hit.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("q_rouge1", r"""
    WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS x FROM conversations), c AS (SELECT conv_id, turn, x, count(*) AS n FROM w GROUP BY 1, 2, 3),
         t AS (SELECT conv_id, turn, sum(n) AS total FROM c GROUP BY 1, 2),
         o AS (SELECT a.conv_id, a.turn, sum(least(a.n, b.n)) AS common FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1 AND a.x = b.x GROUP BY 1, 2)
    SELECT o.conv_id, o.turn, round(2.0 * common / (t.total + u.total), 6) AS f1 FROM o JOIN t ON o.conv_id = t.conv_id AND o.turn = t.turn JOIN t u ON o.conv_id = u.conv_id AND o.turn = u.turn + 1""")
def rouge1(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))).alias("x")).groupBy("conv_id", "turn", "x").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("conv_id", "turn").agg(F.sum("n").alias("total"))
    b = c.select("conv_id", (F.col("turn") + 1).alias("turn"), "x", F.col("n").alias("m"))
    o = c.join(b, ["conv_id", "turn", "x"]).groupBy("conv_id", "turn").agg(F.sum(F.least("n", "m")).alias("common"))
    u = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("total").alias("other"))
    return o.join(t, ["conv_id", "turn"]).join(u, ["conv_id", "turn"]).select("conv_id", "turn", F.round(2.0 * F.col("common") / (F.col("total") + F.col("other")), 6).alias("f1"))


@F.pandas_udf(DoubleType())
def rouge_l(a: pd.Series, b: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence of words."""

    def one(x: str, y: str) -> float:
        x, y = (x or "").lower().split(), (y or "").lower().split()
        if not x or not y:
            return 0.0
        # bit-parallel: one long integer holds a row of the table
        at, full = {}, (1 << len(x)) - 1
        for i, w in enumerate(x):
            at[w] = at.get(w, 0) | 1 << i
        row = full
        for w in y:
            u = row & at.get(w, 0)
            row = (row + u | row - u) & full
        common = len(x) - row.bit_count()
        return 2 * common / (len(x) + len(y))

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


@query("q_rougeL")
def rouge_l_turns(spark, d):
    t = load(spark, d, "conversations").withColumn("before", F.lag("text").over(W.partitionBy("conv_id").orderBy("turn"))).where("before is not null")
    return t.select("conv_id", "turn", F.round(rouge_l("text", "before"), 6).alias("f1"))


@query("q_chunks", """
    SELECT doc_id, i AS chunk, substr(text, CAST(i * 900 + 1 AS BIGINT), 1000) AS body FROM
    (SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil((length(text) - 100) / 900.0) AS BIGINT)))) AS i FROM documents)""")
def chunks(spark, d):
    """Chunks of 1,000 characters that overlap by 100."""
    n = F.greatest(F.lit(1).cast("long"), F.ceil((F.length("text") - 100) / 900.0).cast("long"))
    x = load(spark, d, "documents").select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("chunk"))
    return x.select("doc_id", "chunk", F.substring(F.col("text"), (F.col("chunk") * 900 + 1).cast("int"), F.lit(1000)).alias("body"))


@query("q_boundary_chunks")
def boundary_chunks(spark, d):
    """Chunks of at most 1,000 characters that end at a paragraph, line or sentence, and overlap by 100."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, str(4 << 20))  # workers hold a few megabytes of texts, however long these are
    cut = load(spark, d, "documents").select("doc_id", bounded_chunks(F.col("text"), 1000, 100).alias("c"))
    return cut.select("doc_id", F.posexplode("c").alias("chunk", "body"))


@query("q_keyword_rate", r"""
    SELECT doc_id, round((length(lower(text)) - length(replace(lower(text), 'tion', ''))) // 4 / greatest(len(list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda x: x <> '')), 1), 9) AS score FROM documents""")
def keyword_rate(spark, d):
    return load(spark, d, "documents").select("doc_id", F.round(keyword_score(F.col("text"), ["tion"]), 9).alias("score"))
