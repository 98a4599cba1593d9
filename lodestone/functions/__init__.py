"""Column functions: text scores, tokens, addresses, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of a substring."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("long")


def blank_words(text: Column) -> Column:
    """Words between blanks, tabs and line ends; none for an empty text."""
    return F.filter(F.split(text, r"[ \t\n\r]+"), lambda x: x != "")


def keyword_score(text: Column, terms: list[str]) -> Column:
    """Substring occurrences of all terms over the number of words."""
    low = F.lower(text)
    hits = sum((occurrences(low, t.lower()) for t in terms), F.lit(0))
    return hits / F.greatest(F.size(blank_words(low)), F.lit(1))


def weighted_contains(text: Column, weights: dict[str, float], cap: float = 1.0) -> Column:
    """Sum of the weights of contained keywords, capped."""
    low = F.lower(text)
    return F.least(F.lit(cap), sum((F.when(F.contains(low, F.lit(k)), w).otherwise(0.0) for k, w in weights.items()), F.lit(0.0)))


def boosted(confidence: Column, text: Column, context: list[str], factor: float, cap: float = 1.0) -> Column:
    """Confidence times factor for each distinct context word that the text contains, at most cap; null counts as an empty text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    n = sum((F.contains(low, F.lit(w)).cast("int") for w in dict.fromkeys(c.lower() for c in context)), F.lit(0))
    return F.least(F.lit(cap), confidence * F.pow(F.lit(factor), n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector has no length, null where dimensions differ."""
    n = norm(a) * norm(b)
    return F.when(F.size(a) == F.size(b), F.when(n > 0, dot(a, b) / n).otherwise(0.0))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def token_estimate(text: Column) -> Column:
    """Four characters a token."""
    return (F.length(text) / 4).cast("long")


def norm_addr(text: Column) -> Column:
    """Address as a number, from hex with or without 0x or a name that ends in hex digits; null otherwise."""
    digits = F.regexp_extract(text, r"(?i)(?:^|0x|_)([0-9a-f]{1,15})$", 1)
    return F.when(digits != "", F.conv(digits, 16, 10).cast("long"))


def camel_to_snake(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"(?<!^)(?=[A-Z])", "_"))


def hex_dump(data: Column) -> Column:
    """16 bytes a line: offset, hex, printable characters."""
    rows = F.sequence(F.lit(0), F.greatest(F.lit(0), ((F.octet_length(data) - 1) / 16).cast("int")))

    def line(i: Column) -> Column:
        part = F.substring(data, i * 16 + 1, F.lit(16))
        text = F.regexp_replace(F.decode(part, "ISO-8859-1"), r"[^\x20-\x7E]", ".")
        return F.concat_ws("  ", F.lpad(F.lower(F.hex(i * 16)), 8, "0"), F.rpad(F.lower(F.regexp_replace(F.hex(part), "(..)(?!$)", "$1 ")), 47, " "), text)

    return F.when(F.octet_length(data) > 0, F.array_join(F.transform(rows, line), "\n")).otherwise("")
