"""Features of code and prose: metrics, families, names, calls, addresses, literals, parsed answers."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import camel_to_snake, hex_dump, norm_addr
from lodestone.sources import load


def found(column, pattern, group=0):
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(group))


def sorted_words(column):
    return F.array_join(F.array_sort(F.array_distinct(column)), ",")


# Fixed values of this file: stop words, and words that open a branch.
STOP = ["the", "and", "that", "with", "from", "this"]
BRANCHES = r"\b(if|for|while|case|catch|and|or)\b"


@query("q_complexity", rf"""
    WITH m AS (SELECT page_id, len(list_filter(string_split(html, chr(10)), lambda x: trim(x) <> '' AND NOT starts_with(trim(x), '//'))) AS code_lines, 1 + len(regexp_extract_all(html, '{BRANCHES}')) AS complexity FROM pages)
    SELECT *, 2 * code_lines AS instructions, CASE WHEN complexity <= 5 THEN 'simple' WHEN complexity <= 15 THEN 'moderate' ELSE 'complex' END AS tier FROM m""")
def complexity(spark, d):
    """Code lines, branches plus one, and the tier."""
    lines = F.filter(F.split("html", "\n"), lambda x: (F.trim(x) != "") & ~F.startswith(F.trim(x), F.lit("//")))
    m = load(spark, d, "pages").select("page_id", F.size(lines).cast("long").alias("code_lines"), (1 + F.size(found("html", BRANCHES))).cast("long").alias("complexity"))
    return m.select("*", (2 * F.col("code_lines")).alias("instructions"), F.when(F.col("complexity") <= 5, "simple").when(F.col("complexity") <= 15, "moderate").otherwise("complex").alias("tier"))


# Fixed values of this query: families in priority order, each a pattern.
FAMILIES = {"crypto": "hash|cipher|key", "network": "http|socket|url", "file_io": "file|read|open", "memory": "alloc|copy", "string": "str|char", "validation": "check|valid", "registry": "regist|config", "process": "exec|run"}


@query("q_families", f"""
    WITH f AS (SELECT page_id, url, list_filter([{', '.join(f"CASE WHEN regexp_matches(lower(html), '{p}') THEN '{k}' END" for k, p in FAMILIES.items())}], lambda x: x IS NOT NULL) AS ops FROM pages)
    SELECT page_id, array_to_string(list_sort(ops), ',') AS ops, coalesce(ops[1], CASE WHEN contains(url, '/fr/') THEN 'french' ELSE 'unknown' END) AS domain, list_has_any(ops, ['crypto', 'network', 'registry']) AS security FROM f""")
def families(spark, d):
    """Families of operations, the first by priority as the domain, the name where there is none."""
    low = F.lower("html")
    ops = F.array_compact(F.array(*[F.when(low.rlike(p), k) for k, p in FAMILIES.items()]))
    f = load(spark, d, "pages").select("page_id", "url", ops.alias("ops"))
    domain = F.coalesce(F.get("ops", F.lit(0)), F.when(F.contains("url", F.lit("/fr/")), "french").otherwise("unknown"))
    return f.select("page_id", F.array_join(F.array_sort("ops"), ",").alias("ops"), domain.alias("domain"), F.arrays_overlap("ops", F.array(*map(F.lit, ("crypto", "network", "registry")))).alias("security"))


@query("q_signatures", r"""
    WITH s AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'void' ELSE 'int' END || CASE WHEN p_size % 2 = 0 THEN ' __stdcall ' ELSE ' ' END || replace(p_name, ' ', '_') || '(' || CASE WHEN p_size > 40 THEN '' ELSE 'int a, char *b' END || ')' AS sig FROM part),
         g AS (SELECT p_partkey, regexp_extract(sig, '^(\w+)\s+(?:(__\w+)\s+)?(\w+)\(([^)]*)\)', ['ret', 'conv', 'name', 'args']) AS x FROM s)
    SELECT p_partkey, x.ret AS returns, coalesce(nullif(x.conv, ''), 'default') AS convention, x.name AS name, CASE WHEN x.args = '' THEN 0 ELSE len(string_split(x.args, ',')) END AS params FROM g""")
def signatures(spark, d):
    """Signatures written out for parts, then parsed: return type, convention, name, number of parameters."""
    p = load(spark, d, "part")
    sig = F.concat(F.when(F.col("p_size") % 3 == 0, "void").otherwise("int"), F.when(F.col("p_size") % 2 == 0, " __stdcall ").otherwise(" "), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("("), F.when(F.col("p_size") > 40, "").otherwise("int a, char *b"), F.lit(")"))
    part = lambda i: F.regexp_extract("sig", r"^(\w+)\s+(?:(__\w+)\s+)?(\w+)\(([^)]*)\)", i)
    g = p.select("p_partkey", sig.alias("sig"))
    return g.select("p_partkey", part(1).alias("returns"), F.coalesce(F.nullif(part(2), F.lit("")), F.lit("default")).alias("convention"), part(3).alias("name"), F.when(part(4) == "", 0).otherwise(F.size(F.split(part(4), ","))).cast("long").alias("params"))


# Fixed values of this query: code patterns.
PATTERNS = {"script": "<script", "loop": "track[(]", "table": "<table", "list": "<li>", "link": "href=", "style": "[{][^}]*[}]", "comment": "<!--"}


@query("q_code_patterns", "WITH p AS (SELECT unnest([" + ", ".join(f"{{'pattern': '{k}', 'rx': '{p}'}}" for k, p in PATTERNS.items()) + "], recursive := true)) SELECT page_id, pattern FROM pages, p WHERE regexp_matches(html, rx)")
def code_patterns(spark, d):
    hits = F.array_compact(F.array(*[F.when(F.col("html").rlike(p), k) for k, p in PATTERNS.items()]))
    return load(spark, d, "pages").select("page_id", F.explode(hits).alias("pattern"))


@query("q_security_indicators", r"""
    WITH i AS (SELECT doc_id, CASE WHEN contains(lower(text), 'password') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'secret') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'token') THEN 1 ELSE 0 END AS indicators, CASE WHEN regexp_matches(text, '[0-9a-f]{32}') THEN 1 ELSE 0 END AS risks FROM documents)
    SELECT doc_id, indicators, risks, CASE WHEN risks > 0 AND indicators > 0 THEN 'critical' WHEN risks > 0 OR indicators > 1 THEN 'high' WHEN indicators > 0 THEN 'medium' ELSE 'low' END AS criticality FROM i""")
def security_indicators(spark, d):
    n = sum((F.when(F.contains(F.lower("text"), F.lit(w)), 1).otherwise(0) for w in ("password", "secret", "token")), F.lit(0))
    i = load(spark, d, "documents").select("doc_id", n.alias("indicators"), F.when(F.col("text").rlike("[0-9a-f]{32}"), 1).otherwise(0).alias("risks"))
    r, n = F.col("risks") > 0, F.col("indicators")
    return i.withColumn("criticality", F.when(r & (n > 0), "critical").when(r | (n > 1), "high").when(n > 0, "medium").otherwise("low"))


@query("q_data_flow", """
    WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[A-Z][a-z]+')) AS names, len(regexp_extract_all(text, '[.!?]')) AS returns, contains(text, ':') AS effects FROM documents)
    SELECT doc_id, array_to_string(list_sort(names)[1:10], ',') AS globals, returns, effects FROM w""")
def data_flow(spark, d):
    """Ten distinct globals, the number of returns, and whether there are side effects."""
    names = F.array_join(F.slice(F.array_sort(F.array_distinct(found("text", "[A-Z][a-z]+"))), 1, 10), ",")
    return load(spark, d, "documents").select("doc_id", names.alias("globals"), F.size(found("text", "[.!?]")).cast("long").alias("returns"), F.contains("text", F.lit(":")).alias("effects"))


@query("q_call_depth", """
    SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '([A-Za-z_][A-Za-z0-9_]*)[(]', 1))), ',') AS calls, len(regexp_extract_all(html, '[(][^()]*[(]')) AS nested FROM pages""")
def call_depth(spark, d):
    """Names that are called, and calls within calls."""
    return load(spark, d, "pages").select("page_id", sorted_words(found("html", "([A-Za-z_][A-Za-z0-9_]*)[(]", 1)).alias("calls"), F.size(found("html", "[(][^()]*[(]")).cast("long").alias("nested"))


@query("q_keyword_distill", f"""
    SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(lower(text), '[0-9a-f]{{8,}}'), list_filter(regexp_extract_all(lower(text), '[a-z_][a-z0-9_]+'), lambda x: length(x) >= 12 AND NOT list_contains({STOP}, x))))), ',') AS keywords FROM documents""")
def keyword_distill(spark, d):
    """Hex runs and long identifiers that are no stop words."""
    low = F.lower("text")
    ids = F.filter(found(low, "[a-z_][a-z0-9_]+"), lambda x: (F.length(x) >= 12) & ~x.isin(STOP))
    return load(spark, d, "documents").select("doc_id", sorted_words(F.concat(found(low, "[0-9a-f]{8,}"), ids)).alias("keywords"))


LISTING = "'0x' || lpad(to_hex(l_orderkey), 8, '0') || ':  BL   0x' || lpad(to_hex(l_partkey % 50), 8, '0') || ' ; call ' || l_linenumber"


@query("q_normalised_listing", f"""
    WITH c AS (SELECT l_suppkey, l_orderkey, regexp_replace(lower(trim(regexp_replace(regexp_replace(trim(regexp_replace({LISTING}, '\\s*;.*$', '')), '^\\s*(0[xX])?[0-9a-fA-F]+:\\s*', ''), '\\s+', ' ', 'g'))), 'zz', '') AS line FROM lineitem),
         f AS (SELECT l_suppkey, l_orderkey // 64 AS fn, string_agg(line, chr(10) ORDER BY line) AS body FROM c GROUP BY 1, 2)
    SELECT sha256(body) AS fingerprint, min(l_suppkey * 1000000 + fn) AS canonical, count(*) AS members FROM f GROUP BY 1""")
def normalised_listing(spark, d):
    """Listings without addresses and comments, in lower case; functions with equal ones are one group."""
    address = F.lpad(F.hex("l_orderkey"), 8, "0")
    line = F.concat(F.lit("0x"), address, F.lit(":  BL   0x"), F.lpad(F.hex(F.col("l_partkey") % 50), 8, "0"), F.lit(" ; call "), F.col("l_linenumber").cast("string"))
    bare = F.regexp_replace(F.trim(F.regexp_replace(line, r"\s*;.*$", "")), r"^\s*(0[xX])?[0-9a-fA-F]+:\s*", "")
    c = load(spark, d, "lineitem").select("l_suppkey", F.floor(F.col("l_orderkey") / 64).alias("fn"), F.lower(F.trim(F.regexp_replace(bare, r"\s+", " "))).alias("line"))
    f = c.groupBy("l_suppkey", "fn").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("body"))
    return f.groupBy(F.sha2(F.col("body").cast("binary"), 256).alias("fingerprint")).agg(F.min(F.col("l_suppkey") * 1000000 + F.col("fn")).alias("canonical"), F.count("*").alias("members"))


@query("q_direct_calls", f"SELECT l_suppkey, count(DISTINCT regexp_extract({LISTING}, '(?i)\\b(?:bl|bla|call)\\s+(?:0x)?([0-9a-f]{{8}})\\b', 1)) AS callees, min(regexp_extract({LISTING}, '(?i)\\b(?:bl|bla|call)\\s+(?:0x)?([0-9a-f]{{8}})\\b', 1)) AS first_callee FROM lineitem GROUP BY 1")
def direct_calls(spark, d):
    """Targets of the direct calls in listing lines."""
    line = F.concat(F.lit("0x"), F.lpad(F.hex("l_orderkey"), 8, "0"), F.lit(":  BL   0x"), F.lpad(F.hex(F.col("l_partkey") % 50), 8, "0"), F.lit(" ; call "), F.col("l_linenumber").cast("string"))
    callee = F.regexp_extract(line, r"(?i)\b(?:bl|bla|call)\s+(?:0x)?([0-9a-f]{8})\b", 1)
    return load(spark, d, "lineitem").select("l_suppkey", callee.alias("c")).groupBy("l_suppkey").agg(F.countDistinct("c").alias("callees"), F.min("c").alias("first_callee"))


@query("q_thunks", """
    SELECT l_orderkey, count(*) AS lines, min(l_partkey) AS target FROM lineitem GROUP BY 1 HAVING count(*) <= 3 AND count_if(l_returnflag <> 'R') = 1 AND count_if(l_returnflag = 'A') = 1""")
def thunks(spark, d):
    """At most three lines, one of them no return, and that a branch."""
    n = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.min("l_partkey").alias("target"), F.count_if(F.col("l_returnflag") != "R").alias("a"), F.count_if(F.col("l_returnflag") == "A").alias("b"))
    return n.where("lines <= 3 and a = 1 and b = 1").select("l_orderkey", "lines", "target")


@query("q_address_context", r"""
    WITH a AS (SELECT doc_id, text, regexp_extract(text, '[0-9]{6,}') AS address FROM documents WHERE regexp_matches(text, '[0-9]{6,}'))
    SELECT doc_id, address, substr(text, CAST(greatest(1, instr(text, address) - 50) AS BIGINT), CAST(instr(text, address) - greatest(1, instr(text, address) - 50) + length(address) + 50 AS BIGINT)) AS context FROM a""")
def address_context(spark, d):
    """The first long number of a text with 50 characters before and after."""
    a = load(spark, d, "documents").select("doc_id", "text", F.regexp_extract("text", "[0-9]{6,}", 0).alias("address")).where("address <> ''")
    at = F.instr(F.col("text"), F.col("address"))
    lo = F.greatest(F.lit(1), at - 50)
    return a.select("doc_id", "address", F.substring(F.col("text"), lo, at - lo + F.length("address") + 50).alias("context"))


@query("q_first_sentence", r"SELECT doc_id, trim(regexp_extract(text, '^[^.!?]*[.!?]')) AS sentence FROM documents WHERE regexp_matches(text, '^[^.!?]*[.!?]')")
def first_sentence(spark, d):
    s = F.regexp_extract("text", "^[^.!?]*[.!?]", 0)
    return load(spark, d, "documents").where(s != "").select("doc_id", F.trim(s).alias("sentence"))


@query("q_name_forms", r"""
    SELECT p_partkey, lower(regexp_replace(camel, '([a-z])([A-Z])', '\1_\2', 'g')) AS snake, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug, p_partkey AS address
    FROM (SELECT *, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), '') AS camel FROM part)""")
def name_forms(spark, d):
    """Camel case to snake case, slugs, and addresses out of names."""
    camel = F.array_join(F.transform(F.split("p_name", " "), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 20))), "")
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.concat_ws(" / ", "p_name", "p_type")), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return load(spark, d, "part").select("p_partkey", camel_to_snake(camel).alias("snake"), slug.alias("slug"), norm_addr(F.concat(F.lit("FUN_"), F.lpad(F.hex("p_partkey"), 8, "0"))).alias("address"))


@query("q_intents", """
    WITH n AS (SELECT conv_id, turn, [{'s': -((length(t) - length(replace(t, 'in', ''))) // 2), 'i': 0, 'name': 'data'}, {'s': -((length(t) - length(replace(t, 'er', ''))) // 2), 'i': 1, 'name': 'security'}, {'s': -((length(t) - length(replace(t, 'ou', ''))) // 2), 'i': 2, 'name': 'flow'}] AS k FROM (SELECT *, lower(text) AS t FROM conversations))
    SELECT conv_id, turn, CASE WHEN list_min(k).s = 0 THEN 'general' ELSE list_min(k).name END AS intent FROM n""")
def intents(spark, d):
    """The intent with the most keywords; of equal ones the first."""
    count = lambda w: ((F.length("t") - F.length(F.replace(F.col("t"), F.lit(w), F.lit("")))) / len(w)).cast("long")
    k = F.array_min(F.array(*[F.struct((-count(w)).alias("s"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, (w, n) in enumerate((("in", "data"), ("er", "security"), ("ou", "flow")))]))
    c = load(spark, d, "conversations").select("conv_id", "turn", F.lower("text").alias("t")).select("conv_id", "turn", k.alias("k"))
    return c.select("conv_id", "turn", F.when(F.col("k.s") == 0, "general").otherwise(F.col("k.name")).alias("intent"))


@query("q_semantic_tags", """
    SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars > 5000 THEN 'large' END, CASE WHEN contains(text, '@') THEN 'contact' END, CASE WHEN regexp_matches(text, '[0-9]{5,}') THEN 'numeric' END, lang], lambda x: x IS NOT NULL), ' ') AS tags FROM documents""")
def semantic_tags(spark, d):
    tags = F.array_compact(F.array(F.when(F.col("n_chars") > 5000, "large"), F.when(F.contains("text", F.lit("@")), "contact"), F.when(F.col("text").rlike("[0-9]{5,}"), "numeric"), F.col("lang")))
    return load(spark, d, "documents").select("doc_id", F.array_join(tags, " ").alias("tags"))


@query("q_index_documents", """
    WITH k AS (SELECT l_partkey, count(*) AS refs FROM lineitem GROUP BY 1)
    SELECT p_partkey, unnest(['name', 'signature', 'summary'] || CASE WHEN refs > 25 THEN ['callers'] ELSE [] END || CASE WHEN p_size > 30 THEN ['code'] ELSE [] END) AS kind,
      unnest([p_name, p_brand || ' ' || p_name, p_type || ' of size ' || p_size] || CASE WHEN refs > 25 THEN ['referenced ' || refs || ' times'] ELSE [] END || CASE WHEN p_size > 30 THEN [repeat('x', CAST(p_size AS INTEGER))] ELSE [] END) AS body FROM part LEFT JOIN k ON p_partkey = l_partkey""")
def index_documents(spark, d):
    """Three to five documents of each function for the vector index."""
    k = load(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("refs"))
    p = load(spark, d, "part").join(k, F.col("p_partkey") == F.col("l_partkey"), "left")
    doc = lambda kind, body: F.struct(F.lit(kind).alias("kind"), body.alias("body"))
    docs = F.array_compact(F.array(doc("name", F.col("p_name")), doc("signature", F.concat_ws(" ", "p_brand", "p_name")), doc("summary", F.concat("p_type", F.lit(" of size "), F.col("p_size").cast("string"))), F.when(F.col("refs") > 25, doc("callers", F.concat(F.lit("referenced "), F.col("refs").cast("string"), F.lit(" times")))), F.when(F.col("p_size") > 30, doc("code", F.repeat(F.lit("x"), F.col("p_size"))))))
    return p.select("p_partkey", F.explode(docs).alias("x")).select("p_partkey", "x.kind", "x.body")


@query("q_truncated", """
    SELECT conv_id, turn, CASE WHEN length(text) <= 300 THEN text WHEN role = 'assistant' THEN substr(text, 1, 200) || ' ... ' || right(text, 60) ELSE substr(text, 1, 260) || '...' END AS body,
      len(list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) > 0)) AS bullets FROM conversations""")
def truncated(spark, d):
    """Long texts cut by kind: head and tail of answers, heads of others; and their number of bullets."""
    body = F.when(F.length("text") <= 300, F.col("text")).when(F.col("role") == "assistant", F.concat(F.substring("text", 1, 200), F.lit(" ... "), F.right(F.col("text"), F.lit(60)))).otherwise(F.concat(F.substring("text", 1, 260), F.lit("...")))
    return load(spark, d, "conversations").select("conv_id", "turn", body.alias("body"), F.size(F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x)) > 0)).cast("long").alias("bullets"))


@query("q_source_tiers", "SELECT source, CASE WHEN contains(source, '1') THEN 'borg' WHEN contains(source, '2') THEN 'engine' ELSE 'neutral' END AS tier, count(*) AS n FROM documents GROUP BY 1")
def source_tiers(spark, d):
    tier = F.when(F.contains("source", F.lit("1")), "borg").when(F.contains("source", F.lit("2")), "engine").otherwise("neutral")
    return load(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).withColumn("tier", tier)


def number_windows(text):
    """Windows of 55 characters around long numbers in a line.

    A window ends within 55 characters of its number, so that the middle of a stretch without digits is in none;
    it goes, as do lines without a long number, before the windows are matched.
    """
    near = F.regexp_replace(text, r"(?<![^0-9\n])(?=[^0-9\n]{111})([^0-9\n]{55})[^0-9\n]+([^0-9\n]{55})", "$1\n$2")
    lines = F.filter(F.split(near, "\n"), lambda x: F.rlike(x, F.lit("[0-9]{4}")))
    return F.flatten(F.transform(lines, lambda x: found(x, ".{0,55}[0-9]{4,}.{0,55}")))


@query("q_tag_windows", r"""
    WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '.{0,55}[0-9]{4,}.{0,55}')) AS win FROM documents)
    SELECT tag, count(*) AS windows, count(DISTINCT doc_id) AS docs FROM w, (VALUES ('the'), ('er'), ('que')) t(tag) WHERE contains(win, tag) GROUP BY 1""")
def tag_windows(spark, d):
    """Vocabulary words within 55 characters of long numbers."""
    w = load(spark, d, "documents").select("doc_id", F.explode(number_windows(F.lower("text"))).alias("win"))
    tags = F.array_compact(F.array(*[F.when(F.contains("win", F.lit(t)), F.lit(t)) for t in ("the", "er", "que")]))
    return w.select("doc_id", F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("windows"), F.countDistinct("doc_id").alias("docs"))


# Fixed values of this query: kinds of artifacts and their patterns.
ARTIFACTS = {"email": "[a-z]+@[a-z]+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "hex": "[0-9a-f]{32}", "number": "[0-9]{9,}", "path": "/[a-z]+/", "key": "AKIA[A-Z0-9]+"}


@query("q_artifacts", "WITH a AS (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(list_distinct(regexp_extract_all(text, '{p}'))) AS value FROM documents" for k, p in ARTIFACTS.items()) + ") SELECT kind, count(*) AS n, count(DISTINCT value) AS distinct_values, min(value) AS first_value FROM a GROUP BY 1")
def artifacts(spark, d):
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.array_distinct(found("text", p)).alias("values")) for k, p in ARTIFACTS.items()])
    a = load(spark, d, "documents").select(F.explode(each).alias("a")).select("a.kind", F.explode("a.values").alias("value"))
    v = a.groupBy("kind", "value").agg(F.count("*").alias("n"))
    return v.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct_values"), F.min("value").alias("first_value"))


@query("q_rouge2", r"""
    WITH w AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM conversations), g AS (SELECT conv_id, turn, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS x FROM w),
         c AS (SELECT conv_id, turn, x, count(*) AS n FROM g GROUP BY 1, 2, 3), t AS (SELECT conv_id, turn, sum(n) AS total FROM c GROUP BY 1, 2),
         o AS (SELECT a.conv_id, a.turn, sum(least(a.n, b.n)) AS common FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1 AND a.x = b.x GROUP BY 1, 2)
    SELECT o.conv_id, o.turn, round(2.0 * common / (t.total + u.total), 6) AS f1 FROM o JOIN t ON o.conv_id = t.conv_id AND o.turn = t.turn JOIN t u ON o.conv_id = u.conv_id AND o.turn = u.turn + 1""")
def rouge2(spark, d):
    """F1 of shared pairs of words with the turn before."""
    w = load(spark, d, "conversations").select("conv_id", "turn", found(F.lower("text"), "[a-z0-9]+").alias("w")).where("size(w) > 1")
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))
    c = w.select("conv_id", "turn", F.explode(pairs).alias("x")).groupBy("conv_id", "turn", "x").agg(F.count("*").alias("n"))
    t = c.groupBy("conv_id", "turn").agg(F.sum("n").alias("total"))
    b = c.select("conv_id", (F.col("turn") + 1).alias("turn"), "x", F.col("n").alias("m"))
    o = c.join(b, ["conv_id", "turn", "x"]).groupBy("conv_id", "turn").agg(F.sum(F.least("n", "m")).alias("common"))
    u = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("total").alias("other"))
    return o.join(t, ["conv_id", "turn"]).join(u, ["conv_id", "turn"]).select("conv_id", "turn", F.round(2.0 * F.col("common") / (F.col("total") + F.col("other")), 6).alias("f1"))


@query("q_durations", """
    WITH s AS (SELECT user_id, date_diff('second', min(ts), max(ts)) AS s FROM events WHERE value > 97 GROUP BY 1)
    SELECT user_id, s, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE s || 's' END AS duration FROM s""")
def durations(spark, d):
    """Session lengths, and how they are written."""
    second = lambda c: F.unix_seconds(F.date_trunc("second", c).cast("timestamp"))
    s = load(spark, d, "events").where("value > 97").groupBy("user_id").agg((second(F.max("ts")) - second(F.min("ts"))).alias("s"))
    text = lambda x: F.floor(x).cast("string")
    two = lambda x: F.lpad(text(x), 2, "0")
    n = F.col("s")
    return s.select("user_id", "s", F.when(n >= 3600, F.concat(text(n / 3600), F.lit("h "), two(n % 3600 / 60), F.lit("m"))).when(n >= 60, F.concat(text(n / 60), F.lit("m "), two(n % 60), F.lit("s"))).otherwise(F.concat(text(n), F.lit("s"))).alias("duration"))


@query("q_printable", r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\t', '\\t', 'g'), '\n', '\\n', 'g'), '[^\x20-\x7E]', '?', 'g') AS body FROM documents")
def printable(spark, d):
    """Tabs and line ends escaped, other characters beyond ASCII replaced."""
    t = F.replace(F.replace(F.col("text"), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n"))
    return load(spark, d, "documents").select("doc_id", F.regexp_replace(t, r"[^\x20-\x7E]", "?").alias("body"))


@query("q_source_tokens", f"""
    SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(html, '[A-Z]?[a-z]+'), lambda x: lower(x)), lambda x: length(x) >= 6 AND NOT list_contains({STOP}, x)))), ' ') AS tokens FROM pages""")
def source_tokens(spark, d):
    """Identifiers and their camel parts, long enough and no stop words."""
    words = F.filter(F.transform(found("html", "[A-Z]?[a-z]+"), F.lower), lambda x: (F.length(x) >= 6) & ~x.isin(STOP))
    return load(spark, d, "pages").select("page_id", F.array_join(F.array_sort(F.array_distinct(words)), " ").alias("tokens"))


@query("q_markdown_leads", """
    SELECT 'HIGH' AS level, '0x' || lower(lpad(to_hex(o_orderkey), 6, '0')) AS address, min(o_orderkey) AS first_one FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2
    UNION ALL SELECT 'LOW', '0x' || lower(lpad(to_hex(o_orderkey), 6, '0')), min(o_orderkey) FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1, 2""")
def markdown_leads(spark, d):
    """Leads written as Markdown items, twice over, then parsed: equal ones are one."""
    level = F.when(F.col("o_orderpriority") == "1-URGENT", "HIGH").otherwise("LOW")
    item = F.concat(F.lit("- ["), level, F.lit("] 0x"), F.lower(F.lpad(F.hex("o_orderkey"), 6, "0")), F.lit(": look at order "), F.col("o_orderkey").cast("string"))
    text = load(spark, d, "orders").select(F.concat_ws("\n", F.lit("# Leads"), item, F.lit("- no lead"), item).alias("t"))
    part = lambda i: F.regexp_extract("line", r"^- \[(\w+)\] (0x[0-9a-f]+): .*?(\d+)$", i)
    lines = text.select(F.explode(F.split("t", "\n")).alias("line")).where(part(1) != "")
    return lines.groupBy(part(1).alias("level"), part(2).alias("address")).agg(F.min(part(3).cast("long")).alias("first_one"))


@query("q_identifier_jaccard", f"""
    WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z_][a-z0-9_]+'), lambda x: NOT list_contains({STOP}, x))) AS w FROM conversations), p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS v FROM t)
    SELECT conv_id, turn, round(len(list_intersect(w, v)) / (len(w) + len(v) - len(list_intersect(w, v))), 9) AS similarity FROM p WHERE v IS NOT NULL AND len(w) + len(v) > 0""")
def identifier_jaccard(spark, d):
    from lodestone.functions import jaccard

    words = F.array_distinct(F.filter(found(F.lower("text"), "[a-z_][a-z0-9_]+"), lambda x: ~x.isin(STOP)))
    t = load(spark, d, "conversations").select("conv_id", "turn", words.alias("w"))
    p = t.withColumn("v", F.lag("w").over(W.partitionBy("conv_id").orderBy("turn"))).where("v is not null and size(w) + size(v) > 0")
    return p.select("conv_id", "turn", F.round(jaccard(F.col("w"), F.col("v")), 9).alias("similarity"))


@query("q_address_union", r"""
    SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(lower(text), '\b[0-9a-f]{8,}\b'), list_transform(regexp_extract_all(text, '\b([0-9]{6,})\b', 1), lambda x: lower(to_hex(CAST(right(x, 15) AS BIGINT))))))), ',') AS addresses FROM documents""")
def address_union(spark, d):
    """Addresses in either writing: hex runs, and decimal ones turned into hex."""
    decimal = F.transform(found("text", r"\b([0-9]{6,})\b", 1), lambda x: F.lower(F.hex(F.right(x, F.lit(15)).cast("long"))))
    return load(spark, d, "documents").select("doc_id", sorted_words(F.concat(found(F.lower("text"), r"\b[0-9a-f]{8,}\b"), decimal)).alias("addresses"))


@query("q_line_grep", """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE contains(lower(text), 'token')),
         h AS (SELECT doc_id, i AS line_number, substr(line, 1, 500) AS body FROM l WHERE contains(lower(line), 'token') ORDER BY doc_id, i LIMIT 41)
    SELECT doc_id, line_number, body, (SELECT count(*) FROM h) > 40 AS truncated FROM h ORDER BY doc_id, line_number LIMIT 40""")
def line_grep(spark, d):
    """The first 40 lines with a word, and whether there are more."""
    hit = lambda c: F.contains(F.lower(c), F.lit("token"))
    x = load(spark, d, "documents").where(hit("text")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).where(hit("line"))
    h = x.select("doc_id", (F.col("i") + 1).cast("long").alias("line_number"), F.substring("line", 1, 500).alias("body")).orderBy("doc_id", "line_number").limit(41)
    more = F.count("*").over(W.partitionBy()) > 40  # 41 rows at most
    return h.withColumn("truncated", more).orderBy("doc_id", "line_number").limit(40)


@query("q_line_filter", """
    WITH l AS (SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
         h AS (SELECT *, CASE WHEN i < 3 OR i >= n - 2 THEN 0 ELSE 1 END AS inner_, contains(lower(line), 'then') AS hit FROM l),
         k AS (SELECT *, CASE WHEN inner_ = 1 THEN row_number() OVER (PARTITION BY doc_id, inner_, hit ORDER BY i) END AS rn FROM h)
    SELECT doc_id, i AS line_number, line FROM k WHERE inner_ = 0 OR (hit AND rn <= 5)""")
def line_filter(spark, d):
    """Head and tail lines, and the first few hits between them; hits are chosen within the row's array."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    x = load(spark, d, "documents").select("doc_id", lines.alias("l"))
    n = F.size("l")
    head, tail = F.slice("l", 1, 3), F.slice("l", F.greatest(F.lit(4), n - 1), 2)
    inner = F.filter(F.slice("l", 4, F.greatest(n - 5, F.lit(0))), lambda y: F.contains(F.lower(y["line"]), F.lit("then")))
    return x.select("doc_id", F.explode(F.concat(head, F.slice(inner, 1, 5), tail)).alias("y")).select("doc_id", F.col("y.i").cast("long").alias("line_number"), "y.line")


@query("q_line_range", """
    SELECT doc_id, array_to_string(string_split(text, chr(10))[2:5], chr(10)) AS body, len(string_split(text, chr(10))) > 5 AS truncated FROM documents WHERE contains(text, chr(10))""")
def line_range(spark, d):
    lines = F.split("text", "\n")
    return load(spark, d, "documents").where(F.contains("text", F.lit("\n"))).select("doc_id", F.array_join(F.slice(lines, 2, 4), "\n").alias("body"), (F.size(lines) > 5).alias("truncated"))


@query("q_hex_dump", """
    WITH b AS (SELECT s_suppkey, substr(s_name || '                ', 1, 16) AS t FROM supplier)
    SELECT s_suppkey, '00000000  ' || array_to_string(list_transform(range(1, 17), lambda i: lower(substr(hex(encode(t)), 2 * i - 1, 2))), ' ') || '  ' || t AS dump FROM b""")
def hex_dump_lines(spark, d):
    """Sixteen bytes a line with their printable characters."""
    return load(spark, d, "supplier").select("s_suppkey", hex_dump(F.rpad("s_name", 16, " ").cast("binary")).alias("dump"))


@query("q_read_bytes", "SELECT doc_id, lower(substr(hex(encode(text)), 7, 16)) AS bytes_ FROM documents WHERE strlen(text) >= 11")
def read_bytes(spark, d):
    """Eight bytes from the fourth on."""
    b = F.col("text").cast("binary")
    return load(spark, d, "documents").where(F.octet_length("text") >= 11).select("doc_id", F.lower(F.hex(F.substring(b, 4, 8))).alias("bytes_"))


@query("q_literal_forms", r"""
    WITH v AS (SELECT p_partkey, p_size FROM part), t AS (SELECT p_partkey, p_size, 'size ' || p_size || ', 0x' || lower(to_hex(p_partkey)) || '_x and 0x' || lower(to_hex(p_size)) AS body FROM v)
    SELECT p_partkey, regexp_matches(body, '(^|[^0-9a-z])' || p_size || '($|[^0-9a-z])') AS as_decimal, regexp_matches(body, '(^|[^0-9a-z])0x' || lower(to_hex(p_size + 1)) || '($|[^0-9a-z])') AS other_hex,
      regexp_matches(body, '(^|[^0-9a-z])0x' || lower(to_hex(p_size)) || '($|[^0-9a-z])') AS as_hex FROM t""")
def literal_forms(spark, d):
    """Whether a value stands in a text, in decimal or hex, and not as part of a longer word."""
    hx = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    body = F.concat(F.lit("size "), F.col("p_size").cast("string"), F.lit(", "), hx("p_partkey"), F.lit("_x and "), hx("p_size"))
    stands = lambda form: F.regexp_like(F.col("body"), F.concat(F.lit("(?<![0-9a-z])"), form, F.lit("(?![0-9a-z])")))
    t = load(spark, d, "part").select("p_partkey", "p_size", body.alias("body"))
    return t.select("p_partkey", stands(F.col("p_size").cast("string")).alias("as_decimal"), stands(hx(F.col("p_size") + 1)).alias("other_hex"), stands(hx("p_size")).alias("as_hex"))


@query("q_flattened", """
    SELECT user_id, 'type' AS path, event_type AS value, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT user_id, 'props.k', json_extract_string(props, '$.k'), count(*) FROM events GROUP BY ALL""")
def flattened(spark, d):
    """Nested documents as paths and values, counted."""
    e = load(spark, d, "events").select("user_id", "event_type", F.from_json("props", "map<string,string>").alias("p"))
    props = F.transform(F.map_entries("p"), lambda x: F.struct(F.concat(F.lit("props."), x["key"]).alias("path"), x["value"].alias("value")))
    pairs = F.concat(F.array(F.struct(F.lit("type").alias("path"), F.col("event_type").alias("value"))), props)
    return e.select("user_id", F.explode(pairs).alias("x")).groupBy("user_id", "x.path", "x.value").agg(F.count("*").alias("n"))


@query("q_fenced_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 3 <> 0")
def fenced_json(spark, d):
    """JSON between fences of an answer; answers without a fence give none."""
    k = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Here:\n```json\n"), F.col("props"), F.lit("\n```\nDone."))).otherwise(F.lit("no data"))
    body = F.regexp_extract(k, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    return load(spark, d, "events").select("event_id", body.alias("j")).where("j <> ''").select("event_id", F.get_json_object("j", "$.k").cast("long").alias("k"))


@query("q_judge_scores", """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) % 5 + 1 ELSE 3 END AS clarity, 3 AS overall FROM events""")
def judge_scores(spark, d):
    """Scores out of answers; what is missing or unreadable counts 3."""
    k = F.get_json_object("props", "$.k").cast("long") % 5 + 1
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('Scores: {"clarity": '), k.cast("string"), F.lit("} ok"))).otherwise(F.lit("I cannot say {broken"))
    j = F.regexp_extract(answer, r"\{[^{}]*\}", 0)
    score = lambda n: F.coalesce(F.get_json_object(j, f"$.{n}").cast("long"), F.lit(3).cast("long"))
    return load(spark, d, "events").select("event_id", score("clarity").alias("clarity"), score("overall").cast("int").alias("overall"))


@query("q_big_endian", "SELECT p_partkey, p_partkey * 4096 + p_size AS word, p_size AS low FROM part")
def big_endian(spark, d):
    """Words written as big-endian bytes, and read back."""
    data = F.unhex(F.lpad(F.hex(F.col("p_partkey") * 4096 + F.col("p_size")), 16, "0"))
    word = lambda c, at, n: F.conv(F.hex(F.substring(c, at, n)), 16, 10).cast("long")
    p = load(spark, d, "part").select("p_partkey", data.alias("b"))
    return p.select("p_partkey", word(F.col("b"), 1, 8).alias("word"), (word(F.col("b"), 7, 2) % 4096).cast("int").alias("low"))


@query("q_transitions", """
    WITH s AS (SELECT user_id, event_type AS state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_state FROM events) SELECT state, next_state, count(*) AS n, count(DISTINCT user_id) AS users FROM s WHERE next_state IS NOT NULL GROUP BY 1, 2""")
def transitions(spark, d):
    """State transitions of each run, counted."""
    nxt = F.lead("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    s = load(spark, d, "events").select("user_id", F.col("event_type").alias("state"), nxt.alias("next_state")).where("next_state is not null")
    c = s.groupBy("state", "next_state", "user_id").agg(F.count("*").alias("n"))
    return c.groupBy("state", "next_state").agg(F.sum("n").alias("n"), F.count("*").alias("users"))


@query("q_validation", """
    SELECT o_orderkey, array_to_string(list_filter([CASE WHEN c_custkey IS NULL THEN 'unknown customer' END, CASE WHEN l_orderkey IS NULL THEN 'no lines' END, CASE WHEN o_totalprice <= 0 THEN 'no price' END], lambda x: x IS NOT NULL), '; ') AS errors,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'low priority' ELSE '' END AS warnings, CASE WHEN c_custkey IS NULL OR l_orderkey IS NULL OR o_totalprice <= 0 THEN 'invalid' ELSE 'valid' END AS status
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey""")
def validation(spark, d):
    """Errors, warnings and status of every record."""
    c = load(spark, d, "customer").where("c_acctbal > 0").select("c_custkey")
    li = load(spark, d, "lineitem").select("l_orderkey").distinct()
    j = load(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    errors = F.array_compact(F.array(F.when(F.col("c_custkey").isNull(), "unknown customer"), F.when(F.col("l_orderkey").isNull(), "no lines"), F.when(F.col("o_totalprice") <= 0, "no price")))
    return j.select("o_orderkey", F.array_join(errors, "; ").alias("errors"), F.when(F.col("o_orderpriority") == "5-LOW", "low priority").otherwise("").alias("warnings"), F.when(F.size(errors) > 0, "invalid").otherwise("valid").alias("status"))


@query("q_struct_layout", """
    WITH f AS (SELECT DISTINCT p_brand AS struct_, p_size * 4 AS off FROM part), n AS (SELECT struct_, off, lead(off) OVER (PARTITION BY struct_ ORDER BY off) AS nxt FROM f) SELECT struct_, off, coalesce(nxt, off + 4) - off AS size_, coalesce(nxt, off + 4) - off > 4 AS padded FROM n""")
def struct_layout(spark, d):
    """Fields by offset, their sizes up to the next, and where there is padding."""
    f = load(spark, d, "part").select(F.col("p_brand").alias("struct_"), (F.col("p_size") * 4).alias("off")).distinct()
    size = F.coalesce(F.lead("off").over(W.partitionBy("struct_").orderBy("off")), F.col("off") + 4) - F.col("off")
    return f.select("struct_", "off", size.alias("size_"), (size > 4).alias("padded"))


@query("q_struct_header", """
    WITH f AS (SELECT DISTINCT p_brand AS struct_, p_size * 4 AS off FROM part)
    SELECT struct_, count(*) AS fields, CAST(ceil((max(off) + 4) / 16.0) * 16 AS BIGINT) AS bytes, string_agg(printf('    /* 0x%04x */ u32 f_%04x;', off, off), chr(10) ORDER BY off) AS body FROM f GROUP BY 1""")
def struct_header(spark, d):
    """The fields of a struct as text, and its size in whole blocks of 16."""
    f = load(spark, d, "part").groupBy(F.col("p_brand").alias("struct_")).agg(F.array_sort(F.collect_set((F.col("p_size") * 4).cast("int"))).alias("offs"))
    body = F.array_join(F.transform("offs", lambda o: F.format_string("    /* 0x%04x */ u32 f_%04x;", o, o)), "\n")
    return f.select("struct_", F.size("offs").cast("long").alias("fields"), (F.ceil((F.array_max("offs") + 4) / 16) * 16).cast("long").alias("bytes"), body.alias("body"))


@query("q_evidence_bundle", """
    SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, turn)) AS digest, count(*) AS items FROM conversations GROUP BY 1""")
def evidence_bundle(spark, d):
    """Evidence in the order of its tier, then its place, and the hash of all of it."""
    tier = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).otherwise(2)
    c = load(spark, d, "conversations").select("conv_id", F.struct(tier.alias("tier"), "turn", F.concat("role", F.lit(":"), "text").alias("t")).alias("x"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n")
    return c.groupBy("conv_id").agg(F.sha2(body.cast("binary"), 256).alias("digest"), F.count("*").alias("items"))
