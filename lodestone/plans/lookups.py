"""Lookups, cross references, evidence joins and relational division."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import graph
from lodestone.operators.intervals import containing
from lodestone.sources import load

# Parts as functions in an address space: uneven sizes with gaps between them.
FUNCTIONS = "f AS (SELECT p_partkey AS fn, p_partkey * 61 + p_size % 7 AS lo, p_partkey * 61 + p_size % 7 + p_size AS hi FROM part)"


def functions(spark, d):
    lo = F.col("p_partkey") * 61 + F.col("p_size") % 7
    return load(spark, d, "part").select(F.col("p_partkey").alias("fn"), lo.alias("lo"), (lo + F.col("p_size")).alias("hi"))


@query("q_exports", "SELECT p_name AS name, p_partkey AS address FROM part WHERE p_size >= 45")
def exports(spark, d):
    return load(spark, d, "part").where("p_size >= 45").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("address"))


@query("q_data_items", """
    SELECT n_name AS block, s_suppkey AS address, coalesce(CASE WHEN s_acctbal >= 0 THEN s_name END, '(unnamed)') AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def data_items(spark, d):
    """Items by block; an item without a label gets a placeholder."""
    blocks = load(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("block"))
    s = load(spark, d, "supplier").join(blocks, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("block", F.col("s_suppkey").alias("address"), F.coalesce(F.when(F.col("s_acctbal") >= 0, F.col("s_name")), F.lit("(unnamed)")).alias("label"))


@query("q_address_lookup", f"""
    WITH {FUNCTIONS}, p AS (SELECT o_orderkey, o_orderkey * 17 % 130003 AS addr FROM orders)
    SELECT o_orderkey, addr, fn, CASE WHEN addr = lo THEN 'at' WHEN fn IS NOT NULL THEN 'containing' ELSE 'none' END AS kind FROM p LEFT JOIN f ON addr >= lo AND addr < hi""")
def address_lookup(spark, d):
    """Function at an address, else the one that contains it, else none."""
    p = load(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 17 % 130003).alias("addr"))
    j = containing(p, "addr", functions(spark, d), "lo", "hi", 64)
    return j.select("o_orderkey", "addr", "fn", F.when(F.col("addr") == F.col("lo"), "at").when(F.col("fn").isNotNull(), "containing").otherwise("none").alias("kind"))


@query("q_xrefs_to", f"""
    WITH {FUNCTIONS}, x AS (SELECT l_partkey AS target, l_orderkey * 17 % 130003 AS site, CASE l_returnflag WHEN 'R' THEN 'DATA' WHEN 'A' THEN 'JUMP' ELSE 'CALL' END AS kind FROM lineitem)
    SELECT target, kind, count(*) AS refs, count(DISTINCT fn) AS callers, min(fn) AS first_caller FROM x LEFT JOIN f ON site >= lo AND site < hi GROUP BY 1, 2""")
def xrefs_to(spark, d):
    """References by target and kind, with the functions that contain their sites."""
    kind = F.when(F.col("l_returnflag") == "R", "DATA").when(F.col("l_returnflag") == "A", "JUMP").otherwise("CALL")
    x = load(spark, d, "lineitem").select(F.col("l_partkey").alias("target"), (F.col("l_orderkey") * 17 % 130003).alias("site"), kind.alias("kind"))
    # 130,003 sites at most, whatever the number of references
    at = containing(x.select("site").distinct(), "site", functions(spark, d), "lo", "hi", 64).select(F.col("site").alias("at"), "fn")
    j = x.join(graph.few(at), F.col("site") == F.col("at"), "left").select("target", "kind", "fn")
    calls = graph.dealt(j, ["target", "kind"], x.count()).groupBy("target", "kind", "fn").agg(F.count(F.lit(1)).alias("n"))
    return calls.groupBy("target", "kind").agg(F.sum("n").alias("refs"), F.count("fn").alias("callers"), F.min("fn").alias("first_caller"))


@query("q_xref_target", """
    SELECT event_id, coalesce(s_name, p_name, 'unknown') AS target, CASE WHEN s_name IS NOT NULL THEN 'function' WHEN p_name IS NOT NULL THEN 'data' ELSE 'none' END AS kind
    FROM (SELECT event_id, (event_id * 7) % 2500 AS addr FROM events) LEFT JOIN supplier ON addr = s_suppkey LEFT JOIN part ON addr = p_partkey""")
def xref_target(spark, d):
    """What a reference points to: a function, else a data item, else nothing known."""
    e = load(spark, d, "events").select("event_id", (F.col("event_id") * 7 % 2500).alias("addr"))
    e = e.join(load(spark, d, "supplier").select("s_suppkey", "s_name"), F.col("addr") == F.col("s_suppkey"), "left").join(load(spark, d, "part").select("p_partkey", "p_name"), F.col("addr") == F.col("p_partkey"), "left")
    kind = F.when(F.col("s_name").isNotNull(), "function").when(F.col("p_name").isNotNull(), "data").otherwise("none")
    return e.select("event_id", F.coalesce("s_name", "p_name", F.lit("unknown")).alias("target"), kind.alias("kind"))


@query("q_name_lookup", r"""
    SELECT c_custkey, coalesce(s_suppkey, p.p_partkey, CAST(nullif(regexp_extract(c_name, '([0-9]+)$', 1), '') AS BIGINT)) AS address,
      CASE WHEN s_suppkey IS NOT NULL THEN 'symbol' WHEN p.p_partkey IS NOT NULL THEN 'scan' ELSE 'digits' END AS step
    FROM customer LEFT JOIN supplier ON s_name = replace(c_name, 'Customer', 'Supplier') AND s_acctbal > 0
    LEFT JOIN (SELECT p_type, min(p_partkey) AS p_partkey FROM part WHERE p_size > 49 GROUP BY 1) p ON p_type = c_mktsegment""")
def name_lookup(spark, d):
    """Address of a name by three steps: its symbol, a scan, the digits at its end."""
    c = load(spark, d, "customer").withColumn("symbol", F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Supplier")))
    s = load(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")
    p = load(spark, d, "part").where("p_size > 49").groupBy("p_type").agg(F.min("p_partkey").alias("p_partkey"))
    j = c.join(s, F.col("symbol") == F.col("s_name"), "left").join(p, F.col("c_mktsegment") == F.col("p_type"), "left")
    digits = F.regexp_extract("c_name", "([0-9]+)$", 1).try_cast("long")
    step = F.when(F.col("s_suppkey").isNotNull(), "symbol").when(F.col("p_partkey").isNotNull(), "scan").otherwise("digits")
    return j.select("c_custkey", F.coalesce("s_suppkey", "p_partkey", digits).alias("address"), step.alias("step"))


@query("q_claims_evidence", """
    WITH r AS (SELECT doc_id AS claim, unnest([doc_id, doc_id + 1, doc_id * 3]) AS ref FROM labels)
    SELECT claim, count(*) AS refs, count(*) - count(d.doc_id) AS missing, CASE WHEN count(*) = count(d.doc_id) THEN 'supported' ELSE 'failed' END AS status FROM r LEFT JOIN documents d ON ref = d.doc_id GROUP BY 1""")
def claims_evidence(spark, d):
    """Claims and the evidence that they name; a reference to nothing fails its claim."""
    r = load(spark, d, "labels").select(F.col("doc_id").alias("claim"), F.explode(F.array("doc_id", F.col("doc_id") + 1, F.col("doc_id") * 3)).alias("ref"))
    j = r.join(load(spark, d, "documents").select(F.col("doc_id").alias("e")), F.col("ref") == F.col("e"), "left")
    c = j.groupBy("claim").agg(F.count(F.lit(1)).alias("refs"), (F.count(F.lit(1)) - F.count("e")).alias("missing"))
    return c.withColumn("status", F.when(F.col("missing") == 0, "supported").otherwise("failed"))


@query("q_gold_claims", """
    WITH g AS (SELECT doc_id, quality AS status FROM labels), c AS (SELECT doc_id, CASE WHEN contains(text, '!!') THEN 0 ELSE 1 END AS status FROM documents WHERE doc_id % 3 <> 0)
    SELECT count_if(g.doc_id IS NOT NULL AND c.doc_id IS NOT NULL) AS both_, count_if(c.doc_id IS NULL) AS only_gold, count_if(g.doc_id IS NULL) AS only_candidate,
      round(CASE WHEN count(c.doc_id) = 0 THEN 1.0 ELSE count_if(g.doc_id IS NOT NULL AND c.doc_id IS NOT NULL) / count(c.doc_id) END, 3) AS precision_,
      round(CASE WHEN count(g.doc_id) = 0 THEN 1.0 ELSE count_if(g.doc_id IS NOT NULL AND c.doc_id IS NOT NULL) / count(g.doc_id) END, 3) AS recall_,
      round(CASE WHEN count_if(g.doc_id = c.doc_id) = 0 THEN 1.0 ELSE count_if(g.doc_id = c.doc_id AND g.status = c.status) / count_if(g.doc_id = c.doc_id) END, 3) AS status_accuracy
    FROM g FULL OUTER JOIN c ON g.doc_id = c.doc_id""")
def gold_claims(spark, d):
    """Candidate claims against gold ones: both sides kept, empty denominators give 1."""
    g = load(spark, d, "labels").select("doc_id", F.col("quality").alias("gold"))
    c = load(spark, d, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("c_id"), F.when(F.contains("text", F.lit("!!")), 0).otherwise(1).alias("said"))
    j = g.join(c, F.col("doc_id") == F.col("c_id"), "full")
    both = F.col("doc_id").isNotNull() & F.col("c_id").isNotNull()
    n = j.agg(F.count_if(both).alias("both_"), F.count_if(F.col("c_id").isNull()).alias("only_gold"), F.count_if(F.col("doc_id").isNull()).alias("only_candidate"), F.count("c_id").alias("nc"), F.count("doc_id").alias("ng"), F.count_if(both & (F.col("gold") == F.col("said"))).alias("same"))
    share = lambda a, b: F.round(F.when(F.col(b) == 0, 1.0).otherwise(F.col(a) / F.col(b)), 3)
    return n.select("both_", "only_gold", "only_candidate", share("both_", "nc").alias("precision_"), share("both_", "ng").alias("recall_"), share("same", "both_").alias("status_accuracy"))


@query("q_inferred_vs_proven", """
    WITH i AS (SELECT doc_id, CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS said FROM documents)
    SELECT CASE WHEN quality IS NULL THEN 'nocover' WHEN quality = said THEN 'agree' ELSE 'disagree' END AS verdict, count(*) AS n FROM i LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def inferred_vs_proven(spark, d):
    i = load(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 800, 1).otherwise(0).alias("said"))
    j = i.join(load(spark, d, "labels"), "doc_id", "left")
    verdict = F.when(F.col("quality").isNull(), "nocover").when(F.col("quality") == F.col("said"), "agree").otherwise("disagree")
    return j.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("q_covered_units", """
    SELECT l_orderkey AS unit, count(*) AS n FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45) ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) = count(p_partkey)""")
def covered_units(spark, d):
    """Units all of whose members are integrated: a division, by counting members and matches."""
    done = load(spark, d, "part").where("p_size <= 45").select("p_partkey")
    j = load(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(done, F.col("l_partkey") == F.col("p_partkey"), "left")
    n = j.groupBy(F.col("l_orderkey").alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.count("p_partkey").alias("k"))
    return n.where("n = k").select("unit", "n")


@query("q_pointer_walk", """
    WITH t AS (SELECT s_suppkey AS tab, s_suppkey * 613 AS lo, least(lead(s_suppkey * 613) OVER (ORDER BY s_suppkey), s_suppkey * 613 + 400) AS hi FROM supplier WHERE s_acctbal > 0)
    SELECT tab, lo, hi, count(o_orderkey) AS entries, min(o_orderkey) AS first_entry FROM (SELECT tab, lo, coalesce(hi, lo + 400) AS hi FROM t) LEFT JOIN orders ON o_orderkey >= lo AND o_orderkey < hi GROUP BY ALL""")
def pointer_walk(spark, d):
    """Tables run to the next label or to their greatest length; their entries are joined by bucket."""
    t = load(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("tab"), (F.col("s_suppkey") * 613).alias("lo"))
    nexts = F.lead("lo").over(W.orderBy("tab"))  # one narrow row per table
    t = t.withColumn("hi", F.coalesce(F.least(nexts, F.col("lo") + 400), F.col("lo") + 400))
    found = containing(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", t, "lo", "hi", 256).where("tab is not null").groupBy(F.col("tab").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_entry"))
    return t.join(found, F.col("tab") == F.col("k"), "left").select("tab", "lo", "hi", F.coalesce("n", F.lit(0)).alias("entries"), "first_entry")


@query("q_owner_dependencies", """
    WITH e AS (SELECT DISTINCT l_suppkey AS grp, l_partkey AS dep FROM lineitem), o AS (SELECT dep, min(grp) AS owner FROM e GROUP BY 1)
    SELECT grp, count(DISTINCT owner) AS n, min(owner) AS first_owner, max(owner) AS last_owner FROM e JOIN o USING (dep) WHERE owner <> grp GROUP BY 1""")
def owner_dependencies(spark, d):
    """Groups that a group depends on, through the owners of its dependencies; itself left out."""
    e = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("dep")).distinct()
    o = e.groupBy("dep").agg(F.min("grp").alias("owner"))
    p = e.join(o, "dep").where("owner <> grp").select("grp", "owner").distinct()
    return p.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("first_owner"), F.max("owner").alias("last_owner"))


@query("q_dependency_union", """
    SELECT p_brand, count(DISTINCT l_suppkey) AS n, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1""")
def dependency_union(spark, d):
    pairs = load(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct().join(load(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", F.col("l_suppkey").cast("string").alias("s")).distinct()
    return pairs.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("s")), ",").alias("suppliers"))


@query("q_neighbour_context", """
    WITH c AS (SELECT DISTINCT l_partkey AS fn, l_suppkey AS caller FROM lineitem), e AS (SELECT DISTINCT l_partkey AS fn, l_orderkey AS callee FROM lineitem),
         a AS (SELECT fn, list(caller ORDER BY caller)[1:5] AS callers FROM c GROUP BY 1), b AS (SELECT fn, list(callee ORDER BY callee)[1:5] AS callees FROM e GROUP BY 1),
         t AS (SELECT fn, array_to_string(callers, ',') AS x, array_to_string(callees, ',') AS y, array_to_string(callers[1:2], ',') AS x2, array_to_string(callees[1:1], ',') AS y2 FROM a JOIN b USING (fn))
    SELECT fn, CASE WHEN length(x) + length(y) <= 36 THEN x ELSE x2 END AS callers, CASE WHEN length(x) + length(y) <= 36 THEN y ELSE y2 END AS callees, length(x) + length(y) > 36 AS cut FROM t""")
def neighbour_context(spark, d):
    """The first five neighbours each way; over the budget, two callers and one callee."""
    li = load(spark, d, "lineitem").select(F.col("l_partkey").alias("fn"), "l_suppkey", "l_orderkey")

    def first(column, name):
        ranked = li.select("fn", column).distinct().withColumn("rn", F.row_number().over(W.partitionBy("fn").orderBy(column))).where("rn <= 5")
        return ranked.groupBy("fn").agg(F.transform(F.array_sort(F.collect_list(column)), lambda x: x.cast("string")).alias(name))

    t = first("l_suppkey", "a").join(first("l_orderkey", "b"), "fn")
    line = lambda c, n: F.array_join(F.slice(c, 1, n), ",")
    cut = F.length(line("a", 5)) + F.length(line("b", 5)) > 36
    return t.select("fn", F.when(cut, line("a", 2)).otherwise(line("a", 5)).alias("callers"), F.when(cut, line("b", 1)).otherwise(line("b", 5)).alias("callees"), cut.alias("cut"))


@query("q_use_sites", """
    SELECT p_partkey, coalesce(CAST(site AS VARCHAR), 'missing') AS site FROM part LEFT JOIN (SELECT l_partkey, min(l_orderkey) AS site FROM lineitem WHERE l_returnflag <> 'R' AND l_quantity > 40 GROUP BY 1) ON p_partkey = l_partkey""")
def use_sites(spark, d):
    """The first use of a symbol that is no definition, else missing."""
    u = load(spark, d, "lineitem").where("l_returnflag <> 'R' and l_quantity > 40").groupBy("l_partkey").agg(F.min("l_orderkey").alias("s"))
    return load(spark, d, "part").select("p_partkey").join(u, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", F.coalesce(F.col("s").cast("string"), F.lit("missing")).alias("site"))


@query("q_handler_map", """
    SELECT o_orderpriority AS slot, count(*) AS handlers, count_if(n_regionkey = 1) AS valid, min(CASE WHEN n_regionkey <> 1 THEN o_orderkey END) AS first_gap
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def handler_map(spark, d):
    """Slots and their handlers; a handler is valid where its root is the probe's, and the first gap is told."""
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey").join(load(spark, d, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    j = load(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("slot")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    ok = F.col("n_regionkey") == 1
    return j.groupBy("slot").agg(F.count(F.lit(1)).alias("handlers"), F.count_if(ok).alias("valid"), F.min(F.when(~ok, F.col("o_orderkey"))).alias("first_gap"))


@query("q_summary_lookup", """
    SELECT e.user_id, coalesce(c.c_name, s.s_name, 'none') AS summary, count(*) AS n FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_acctbal > 4000 LEFT JOIN supplier s ON e.user_id = s.s_suppkey AND s.s_acctbal > 0 GROUP BY 1, 2""")
def summary_lookup(spark, d):
    """A summary by one key, else by another, else none; the events are counted before the joins."""
    e = load(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    c = load(spark, d, "customer").where("c_acctbal > 4000").select("c_custkey", "c_name")
    s = load(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")
    j = e.join(c, F.col("user_id") == F.col("c_custkey"), "left").join(s, F.col("user_id") == F.col("s_suppkey"), "left")
    return j.select("user_id", F.coalesce("c_name", "s_name", F.lit("none")).alias("summary"), "n")


@query("q_ordered_calls", """
    WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS used FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
    SELECT user_id, string_agg(event_type, '>' ORDER BY used) AS calls FROM f GROUP BY 1""")
def ordered_calls(spark, d):
    """Distinct calls in the order of their first use, one kind left out."""
    f = load(spark, d, "events").where("event_type <> 'error'").groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("at"))
    return f.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "event_type"))), lambda x: x["event_type"]), ">").alias("calls"))


@query("q_fuzzy_names", """
    WITH q AS (SELECT unnest(['ring', 'red widget', 'BOLT', 'small']) AS term), m AS (SELECT term, p_name AS name, min(p_partkey) AS address FROM q, part WHERE contains(lower(p_name), lower(term)) GROUP BY 1, 2)
    SELECT term, name, address FROM m QUALIFY row_number() OVER (PARTITION BY term ORDER BY CASE WHEN lower(name) = lower(term) THEN 0 ELSE 1 END, length(name), name) <= 3""")
def fuzzy_names(spark, d):
    """For each term the exact name first, then the shortest that hold it: three at most."""
    names = load(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("address"))
    terms = F.array(*[F.when(F.contains(F.lower("name"), F.lit(t.lower())), F.lit(t)) for t in ("ring", "red widget", "BOLT", "small")])
    m = names.select("name", "address", F.explode(F.array_compact(terms)).alias("term"))
    w = W.partitionBy("term").orderBy(F.when(F.lower("name") == F.lower("term"), 0).otherwise(1), F.length("name"), "name")
    return m.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("term", "name", "address")


@query("q_any_keyword", "SELECT page_id FROM pages WHERE contains(lower(url), 'fr') OR contains(lower(html), 'widget') OR contains(lower(html), 'table')")
def any_keyword(spark, d):
    has = lambda c, t: F.contains(F.lower(c), F.lit(t))
    return load(spark, d, "pages").where(has("url", "fr") | has("html", "widget") | has("html", "table")).select("page_id")


@query("q_benchmark_filter", """
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE text IS NOT NULL AND (n_chars BETWEEN 200 AND 5000 OR n_chars IS NULL) AND (quality IS NULL OR quality >= 1) AND list_has_any([lang, source], ['en', 'fr'])""")
def benchmark_filter(spark, d):
    """Present text, a range that null passes, and any of some tags."""
    j = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id", "left")
    return j.where(F.col("text").isNotNull() & (F.col("n_chars").between(200, 5000) | F.col("n_chars").isNull()) & (F.col("quality").isNull() | (F.col("quality") >= 1)) & F.arrays_overlap(F.array("lang", "source"), F.array(F.lit("en"), F.lit("fr")))).select("doc_id")


@query("q_exclusion_reason", """
    SELECT p_partkey, CASE WHEN p_size <= 3 THEN 'thunk' WHEN p_name IN ('small ring', 'red widget') THEN 'platform name' WHEN starts_with(p_type, 'STA') OR starts_with(p_type, 'PRO') THEN 'platform prefix' ELSE 'eligible' END AS reason FROM part""")
def exclusion_reason(spark, d):
    p = load(spark, d, "part")
    reason = F.when(F.col("p_size") <= 3, "thunk").when(F.col("p_name").isin("small ring", "red widget"), "platform name").when(F.startswith("p_type", F.lit("STA")) | F.startswith("p_type", F.lit("PRO")), "platform prefix").otherwise("eligible")
    return p.select("p_partkey", reason.alias("reason"))


@query("q_enumeration_modes", r"""
    WITH m AS (SELECT p_partkey, regexp_matches(p_name, '^(small|large|red) ') AS rename_only, NOT (p_size <= 2 OR regexp_matches(p_type, '^(STANDARD|ECONOMY)$')) OR contains(p_name, 'ring') AS smart FROM part)
    SELECT 'full' AS mode, count(*) AS n, min(p_partkey) AS first_one FROM m UNION ALL SELECT 'rename_only', count(*), min(p_partkey) FROM m WHERE rename_only UNION ALL SELECT 'smart', count(*), min(p_partkey) FROM m WHERE smart""")
def enumeration_modes(spark, d):
    """Which functions each mode takes: all, those with placeholder names, or those that are no stubs or hold a wanted word."""
    p = load(spark, d, "part")
    rename = F.col("p_name").rlike("^(small|large|red) ")
    smart = ~((F.col("p_size") <= 2) | F.col("p_type").rlike("^(STANDARD|ECONOMY)$")) | F.contains("p_name", F.lit("ring"))
    modes = F.array_compact(F.array(F.lit("full"), F.when(rename, "rename_only"), F.when(smart, "smart")))
    return p.select("p_partkey", F.explode(modes).alias("mode")).groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_one"))


@query("q_recent_sessions", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 20")
def recent_sessions(spark, d):
    return load(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(20)


@query("q_active_leads", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25")
def active_leads(spark, d):
    return load(spark, d, "orders").where(F.col("o_orderstatus").isin("O", "P")).orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_orderpriority")


@query("q_category_rewrite", "SELECT event_id, CASE event_type WHEN 'click' THEN '.exe' WHEN 'error' THEN 'HKLM' WHEN 'view' THEN 'http' ELSE event_type END AS filter_ FROM events")
def category_rewrite(spark, d):
    """Categories that stand for a filter are rewritten, others pass."""
    rewrite = F.create_map(*[F.lit(x) for x in ("click", ".exe", "error", "HKLM", "view", "http")])
    return load(spark, d, "events").select("event_id", F.coalesce(rewrite[F.col("event_type")], F.col("event_type")).alias("filter_"))


@query("q_usable_entries", "SELECT c_custkey FROM customer WHERE NOT c_mktsegment = 'MACHINERY' AND c_acctbal / 10000 >= 0.60 AND regexp_matches(c_name, '^Customer#[0-9]{9}$')")
def usable_entries(spark, d):
    """Entries that are not negated, sure enough, and have a well-formed key."""
    return load(spark, d, "customer").where(~(F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") / 10000 >= 0.60) & F.col("c_name").rlike("^Customer#[0-9]{9}$")).select("c_custkey")


@query("q_first_per_name", "SELECT p_name, arg_min(p_partkey, (p_partkey % 97, p_partkey)) AS address FROM part GROUP BY 1")
def first_per_name(spark, d):
    """Of entries with one name the first in file order wins."""
    return load(spark, d, "part").groupBy("p_name").agg(F.min_by("p_partkey", F.struct(F.col("p_partkey") % 97, F.col("p_partkey"))).alias("address"))
