"""Functions of C and C++ source files, with the comments that stand before them.

A scan over a whole file blanks comments, literals and preprocessor lines in a copy of the same length, so
that braces and parentheses in them count for nothing and offsets stay those of the file.  Over the copy it
follows the blocks: namespaces, classes and linkage blocks are looked into, bodies of functions are skipped
to the matching brace, whatever their depth.  Lines, complexity, tags and cleaned comments are columns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of this file: words that are no function names; the reach of a comment and what may stand
# between it and its function; what counts as a branch; words that give a tag.
KEYWORDS = frozenset("if else while for do switch case default return break continue goto sizeof typeof struct union enum typedef static extern const volatile inline register auto catch".split())
REACH, BETWEEN = 500, 50
BRANCHES = [r"\bif\s*\(", r"\belse\s+if\s*\(", r"\bwhile\s*\(", r"\bfor\s*\(", r"\bcase\s+", r"\bcatch\s*\(", r"\b\?\s*", r"\b&&\b", r"\b\|\|\b"]
TAGS = {
    "crypto": "encrypt decrypt aes rsa hash sha md5 cipher key",
    "network": "socket connect send recv http tcp udp port host",
    "file_io": "fopen fread fwrite fclose read write file path",
    "memory": "malloc free alloc realloc memcpy memset buffer",
    "string": "str sprintf printf sscanf parse format concat",
    "error_handling": "error exception fail errno perror",
    "init": "init setup create new construct",
    "cleanup": "cleanup destroy free close release delete",
    "validation": "valid check verify assert sanity",
}

# Parts of a file that hold no code: comments, raw and plain strings, characters, preprocessor lines with their continuations.
HIDDEN = re.compile(
    r"""(?P<block>/\*.*?(?:\*/|\Z)) | (?P<line>//(?:[^\n\\]|\\.)*)
      | R"(?P<mark>[^()\\\s]{0,16})\(.*?(?:\)(?P=mark)"|\Z) | "(?:[^"\\\n]|\\.)*(?:"|(?=\n)|\Z)
      | (?<![0-9A-Fa-f])'(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z) | ^[ \t]*\#(?:[^\n\\]|\\.)*""",
    re.VERBOSE | re.DOTALL | re.MULTILINE,
)
HEADER = re.compile(r"(?P<type>[\w:<>,*&~\[\]\s]*?[\s*&])(?P<name>~?\w+(?:::~?\w+)*)\s*\((?P<params>(?:[^()]|\([^()]*\))*)\)(?:\s*(?:const|noexcept|override|final|volatile|throw\s*\([^()]*\)))*(?:\s*:[^;{}]*)?\s*\Z")
TRANSPARENT = re.compile(r"(?:^|[\s>])(?:namespace|class|struct|union|extern)\b[^()=]*\Z")
ATTRIBUTES = re.compile(r"\b(?:static|inline|extern|virtual|explicit|constexpr)\b\s*|__attribute__\s*\(\((?:[^()]|\([^()]*\))*\)\)\s*|template\s*<[^<>{}]*>\s*")
SCHEMA = "function_name string, return_type string, parameters string, at int, line_number int, body string, comment string"


def blanked(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text with blanks for all that is no code (line ends stay), and where block comments stand."""
    comments, out, at = [], [], 0
    for m in HIDDEN.finditer(text):
        if m["block"] is not None:
            comments.append(m.span())
        out += [text[at : m.start()], re.sub(r"[^\n]", " ", m[0])]
        at = m.end()
    return "".join([*out, text[at:]]), comments


def functions(text: str) -> Iterator[tuple[str, str, str, int, int, str, str | None]]:
    """name, return type, parameters, offset, line, body and comment of each function, in order."""
    code, comments = blanked(text)
    lines = [m.start() for m in re.finditer("\n", text)]
    depth, start, opened = 0, 0, None  # depth: of braces that are not looked into
    for m in re.finditer(r"[{};]", code):
        at, mark = m.start(), m[0]
        if depth:
            depth += (mark == "{") - (mark == "}")
            if depth == 0:
                if opened:
                    name, kind, params, begun, body = opened
                    yield name, kind, params, begun, 1 + bisect_right(lines, begun - 1), text[body : at + 1], _comment(text, comments, begun)
                start, opened = at + 1, None
        elif mark == "{":
            head = code[start:at]
            begun = start + len(head) - len(head.lstrip())
            plain = ATTRIBUTES.sub("", head).strip()
            found = HEADER.match(" " + plain)
            if TRANSPARENT.search(head) and not found:
                start = at + 1
            else:
                depth = 1
                if found and found["type"].strip() and len(found["name"]) > 1 and found["name"] not in KEYWORDS and found["type"].split()[-1] not in ("return", "else"):
                    opened = (found["name"], " ".join(found["type"].split()), " ".join(found["params"].split()), begun, at)
        else:
            start = at + 1


def _comment(text: str, comments: list[tuple[int, int]], at: int) -> str | None:
    """The last documentation comment, else the last block comment, of those that lie whole within reach and are close enough."""
    i = bisect_right(comments, (at, at))
    near = [c for c in comments[max(0, i - REACH // 4) : i] if c[0] >= at - REACH and text[c[1] - 2 : c[1]] == "*/"]
    for opening in ("/**", "/*"):
        own = [c for c in near if text.startswith(opening, c[0]) and c[1] - c[0] >= len(opening) + 2]
        if own and len(text[own[-1][1] : at].strip()) < BETWEEN:
            return text[own[-1][0] + len(opening) : own[-1][1] - 2].strip()
    return None


def cleaned(comment: Column) -> Column:
    """Without the asterisks that lead its lines and without documentation tags; null if nothing is left."""
    c = F.regexp_replace(comment, r"(?m)^\s*\*\s?", "")
    c = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"@\w+\s*", "")
    c = F.regexp_replace(c, r"\\[a-z]+\s*", "")
    return F.when(F.length(c) > 0, c)


def complexity(body: Column) -> Column:
    """One, and one for each branch."""
    return sum((F.regexp_count(body, F.lit(p)) for p in BRANCHES), F.lit(1))


def tags(text: Column) -> Column:
    """The tags of which a word stands in the text."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.rlike("|".join(words.split())), tag) for tag, words in TAGS.items()]))


def scanned(files: DataFrame) -> DataFrame:
    """A row per function of files (path, text): path, its id, signature, place, body, docstring, complexity and tags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", *(x.split()[0] for x in SCHEMA.split(", "))]
        kinds = [pa.string()] * 4 + [pa.int32()] * 2 + [pa.string()] * 2
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows = [(path, *f) for f in functions(text or "")]
                for i in range(0, len(rows), 1000):
                    columns = zip(*rows[i : i + 1000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    found = files.select("path", "text").mapInArrow(run, f"path string, {SCHEMA}")
    doc = cleaned(F.col("comment"))
    said = F.concat_ws(" ", "function_name", "body", F.coalesce(doc, F.lit("")))
    return found.select(
        F.concat_ws(":", "path", "function_name", "line_number").alias("function_id"), "path", "function_name", "line_number",
        F.concat(F.col("return_type"), F.lit(" "), F.col("function_name"), F.lit("("), F.col("parameters"), F.lit(")")).alias("signature"),
        "body", doc.alias("docstring"), complexity(F.col("body")).alias("complexity"), tags(said).alias("tags"),
    )


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """path (below the folder), text of the source files of a folder, its subfolders too, one row a file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{c,cc,cpp,cxx,h,hpp,hxx,txt}").text(path, wholetext=True)
    base = path.rstrip("/").rpartition("/")[2]
    return files.select(F.substring_index(F.input_file_name(), f"/{base}/", -1).alias("path"), F.col("value").alias("text"))
