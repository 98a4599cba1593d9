"""Functions and comments of source files against a walk character by character."""

import random

from pyspark.sql import functions as F

from lodestone.operators import source_code

FILE = r'''#include <stdio.h>
#define OPEN {{{ \
    }
/* licence { */
namespace app {
/**
 * Sends @param x the {buffer}.
 */
static int send_all(int a, const char *b) {
  if (a) { while (b) { for (;;) { if (a && b) { return '}' + "}{\"}"[0]; } } } }
  // }
  /* } */ return R"x(}}} )" )x"[0];
}
class Box : public Base {
  int f_[3] = {1, 2, 3};
  Box() : Base(1), n(2) { n = 1; }
  void open(int (*cb)(int)) const { cb(1); }
};
}
extern "C" {
int declared(int);
/* plain note */

unsigned long *alloc_it(void) { return 0; }
}
int table[] = { 1, 2 };
/** far away */
int far_value = 1000000 + 2000000 + 3000000 + 4000000 + 5000000;
int x(int a) { return a; }
int after_far(int a) { switch (a) { case 1: return 1; } return a ? 1 : 0; }
struct P { int q; };
int unclosed(int a) { {
'''


def by_walk(text):
    """name and body of each function at any depth of namespaces and classes: a state for strings and comments, and counted braces."""
    plain, i, n = list(text), 0, len(text)

    def hide(a, b):
        for k in range(a, min(b, n)):
            if plain[k] != "\n":
                plain[k] = " "

    while i < n:
        if text.startswith("/*", i):
            j = text.find("*/", i + 2)
            j = n if j < 0 else j + 2
        elif text.startswith("//", i) or (text[i] == "#" and not text[text.rfind("\n", 0, i) + 1 : i].strip()):
            j = i
            while j < n and text[j] != "\n":
                j += 2 if text[j] == "\\" else 1
        elif text.startswith('R"x(', i):
            j = text.index(')x"', i) + 3
        elif text[i] in "\"'":
            j = i + 1
            while j < n and text[j] not in (text[i], "\n"):
                j += 2 if text[j] == "\\" else 1
            j += 1
        else:
            i += 1
            continue
        hide(i, j)
        i = j
    code, found, start, i = "".join(plain), [], 0, 0
    while i < n:
        if code[i] in ";}":
            start = i + 1
        elif code[i] == "{":
            head = code[start:i].strip()
            depth, j = 1, i + 1
            while j < n and depth:
                depth += (code[j] == "{") - (code[j] == "}")
                j += 1
            words = head.partition("(")[0].split()
            if "(" in head and "=" not in head and len(words) > 1 and depth == 0:
                name = words[-1].lstrip("*")
                if len(name) > 1:
                    found.append((name, text[i:j]))
            if not any(w in head.split() for w in ("namespace", "class", "extern", "struct")) or "(" in head:
                i = j - 1
            start = i + 1
        i += 1
    return found


def test_functions_of_a_file():
    got = list(source_code.functions(FILE))
    assert [f[0] for f in got] == ["send_all", "open", "alloc_it", "after_far"]
    assert [(f[0], f[5]) for f in got] == by_walk(FILE)
    assert [f[4] for f in got] == [1 + FILE[: FILE.index(x)].count("\n") for x in ("static int send_all", "void open", "unsigned long", "int after_far")]
    assert [f[6] for f in got] == ["* Sends @param x the {buffer}.", None, "plain note", None]
    assert [(f[1], f[2]) for f in got] == [("int", "int a, const char *b"), ("void", "int (*cb)(int)"), ("unsigned long *", "void"), ("int", "int a")]


def test_random_files():
    rng = random.Random(4)
    for _ in range(300):
        parts = []
        for k in range(rng.randint(0, 8)):
            inner = "".join(rng.choice(["{ a; }", "{ { } }", '"}"', "'{'", "/* } */", "// {\n", "x = y;", 'R"x(})x"', "if (a) { b; }", "\n"]) for _ in range(rng.randint(0, 8)))
            parts.append(rng.choice([f"int fn{k}(int a, char *b) {{{inner}}}\n", f"/* c{k} */ static void *fn{k}(void)\n{{{inner}}}\n", f"int v{k} = 3;\n", f"int t{k}[] = {{1, {{2}}}};\n", f"namespace n{k} {{ int in{k}(int q) {{{inner}}} }}\n", "#define A {\n", "// {\n", "struct S { int a; };\n"]))
        text = "".join(parts)
        assert [(f[0], f[5]) for f in source_code.functions(text)] == by_walk(text), text


def test_scan_of_a_folder(spark, tmp_path):
    (tmp_path / "src" / "deep").mkdir(parents=True)
    (tmp_path / "src" / "a.c").write_text(FILE)
    (tmp_path / "src" / "deep" / "b.cpp").write_text("/** Init @brief the \\e thing\n * twice */\nint init_key(int a) { return a ? check(a) : 0; }\n")
    (tmp_path / "src" / "deep" / "empty.h").write_text("")
    (tmp_path / "src" / "notes.md").write_text("int no(int a) { }")
    got = {r.function_id: r for r in source_code.scanned(source_code.read_sources(spark, str(tmp_path / "src"))).collect()}
    at = {name: 1 + FILE[: FILE.index(head)].count("\n") for name, head in (("send_all", "static int send"), ("open", "void open"), ("alloc_it", "unsigned long"), ("after_far", "int after_far"))}
    assert sorted(got) == sorted([*(f"a.c:{name}:{n}" for name, n in at.items()), "deep/b.cpp:init_key:3"])
    got |= {f"a.c:{name}": got[f"a.c:{name}:{n}"] for name, n in at.items()}
    r = got["deep/b.cpp:init_key:3"]
    assert (r.signature, r.docstring, r.tags, r.complexity) == ("int init_key(int a)", "Init the thing\ntwice", ["crypto", "init", "validation"], 1)
    assert got["a.c:send_all"].complexity == 5 and got["a.c:alloc_it"].docstring == "plain note" and "network" in got["a.c:send_all"].tags
    assert got["a.c:after_far"].complexity == 2


def test_empty_and_null_texts(spark):
    files = spark.createDataFrame([("a", None), ("b", ""), ("c", "{" * 1000), ("d", "int fn(int a) {" + "{}" * 200_000 + "}")], "path string, text string")
    got = source_code.scanned(files).select("path", F.length("body").alias("n")).collect()
    assert [(r.path, r.n) for r in got] == [("d", 400_002)]
