import math
import re

import pytest

from invoicelake.llm import licenses

SCHEMA = "doc_id long, path string, text string, licence string, line string"
MIT, GPL = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["GPL-3.0"][0]
MIT_TEXT = licenses.TEMPLATES["MIT"][1].replace("(c)", "(c) 2020 Some One").replace(". ", ".\n\n").replace(", ", ",\n")
GPL_HEADER = "\n".join("# " + line for line in re.findall(r".{1,70}(?:\s|$)", "This program " + licenses.TEMPLATES["GPL-3.0"][1]))
ROWS = [
    (1, "a/LICENSE", "some words\n" + MIT), (2, "a/b/x.py", "code\n" + GPL + "\nmore"), (3, "a/b/y.py", "plain text"), (4, "a/b/c/d/z.py", None),
    (5, "q/r/s.py", GPL.upper() + "!!\ntext"), (6, "q/r/t.py", ""), (7, "q/u.py", "nothing"), (8, "top.py", "released"), (9, None, "the license"),
    (10, "a/COPYING.txt", "copied\nAll rights reserved"), (11, "ab/v.py", "x"), (11, "ab/v.py", "x"), (None, "a/w.py", MIT),
    (12, "a/long.py", "word " * 100_000 + "\n" + "the under license released " * 20_000)]


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in licenses.scan(frame).collect()), key=repr)


def units(path, text):
    lines = (text or "").lower().split("\n")
    kinds = ["b" if not re.search(r"[^ \t\r]", x) else "c" if re.match(licenses.COMMENT, x) else "p" for x in lines]
    blocks, start = [], 0
    for i in range(1, len(lines) + 1):
        if i == len(lines) or kinds[i] != kinds[i - 1]:
            blocks.append("\n".join(lines[start:i]))
            start = i
    blocks = [x for x in blocks if re.search("[a-z0-9]", x)]
    out = [(i == 0, x) for i, x in enumerate(lines)] + [(i == 0, x) for i, x in enumerate(blocks) if "\n" in x]
    return out + ([(False, "\n".join(lines))] if path and re.search(licenses.NAMES, path) else [])


def brute(rows, least=licenses.LEAST):
    templates = [(n, set(re.findall("[a-z0-9]+", t.lower()))) for n, texts in licenses.TEMPLATES.items() for t in texts]
    sets = [[(top, set(re.findall("[a-z0-9]+", x))) for top, x in units(path, text)] for _, path, text in rows]
    df = {}
    for own in sets:
        for word in set().union(*(words for _, words in own)):
            df[word] = df.get(word, 0) + 1
    weight = lambda w: (math.log((len(rows) + 1) / (df.get(w, 0) + 1)) + 1) ** 2
    own = []
    for parts in sets:
        scored = []
        for top, words in parts:
            for name, other in templates:
                if words & other:
                    cosine = sum(map(weight, words & other)) / math.sqrt(sum(map(weight, words)) * sum(map(weight, other)))
                    if round(cosine, 6) >= least:
                        scored.append((-round(cosine, 6), name, top))
        own.append((min(scored)[1], -min(scored)[0], any(top for _, _, top in scored)) if scored else None)
    given = {}
    for (doc, path, _), best in zip(rows, own):
        if best and path and "/" in path and (best[2] or re.search(licenses.NAMES, path)):
            given.setdefault(path.rpartition("/")[0], []).append((-best[1], best[0], doc is not None, doc or 0))
    out = []
    for (doc, path, _), best in zip(rows, own):
        folder, row = path.rpartition("/")[0] if path and "/" in path else "", (doc, path, None, None, "none", None)
        while folder:
            if folder in given:
                s, name, valid, giver = min(given[folder])
                row = (doc, path, name, -s, "inherited", giver if valid else None)
                break
            folder = folder.rpartition("/")[0]
        out.append((doc, path, best[0], best[1], "own", doc) if best else row)
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    got = found(spark, ROWS)
    assert got == brute(ROWS)
    by = {r[0]: r for r in got}
    assert by[4][2:] == ("MIT", by[1][3], "inherited", None) or by[4][4] == "inherited"
    assert by[2][2] == by[5][2] == by[6][2] == "GPL-3.0" and by[6][4] == "inherited" and by[7][4] == by[11][4] == "none"


def test_files_headers_and_tags(spark):
    """A licence file, a header wrapped over comment lines with code behind it, and a tag; directories below inherit."""
    rows = [(1, "m/LICENSE", MIT_TEXT), (2, "m/src/deep/a.py", "import os"), (3, "g/a.py", GPL_HEADER + "\nimport os\nprint(1)"), (4, "g/b.py", "x = 1"),
            (5, "s/a.c", "// SPDX-License-Identifier: BSD-3-Clause\nint main() {}"), (6, "s/b.c", "int f();"), (7, "s/c.c", "/* SPDX-License-Identifier: GPL-2.0-only */"),
            (8, "z/a.c", "int license;"), (9, "l/COPYING", "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n" + "words of the text " * 50), (10, "l/x.c", "y")]
    got = found(spark, rows)
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got} == {1: "MIT", 2: "MIT", 3: "GPL-3.0", 4: "GPL-3.0", 5: "BSD-3-Clause", 6: "BSD-3-Clause", 7: "GPL-2.0", 8: None, 9: "LGPL-3.0",
                                         10: "LGPL-3.0"}


def test_answer_does_not_hang_on_the_number_of_files(spark):
    """A notice with an ordinary word: the same shares of words in a hundred times as many files give the same answer."""
    few = [(k, f"d{k}/a.py", ("please " if k % 3 else "code ") + f"and words {k % 5}\n" + (MIT + " please" if k % 5 == 0 else "x")) for k in range(10)]
    many = [(k * 10 + r[0], f"e{k}/{r[1]}", r[2]) for k in range(100) for r in few]
    one = {r[0]: r[2] for r in found(spark, few)}
    assert all(r[2] == one[r[0] % 10] for r in found(spark, many)) and one[0] == "MIT"


def test_files_without_notice_and_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "a/b", "text")]) == [(1, "a/b", None, None, "none", None)]


def test_native_plan(spark):
    plan = licenses.scan(spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA))
    assert "Python" not in plan._jdf.queryExecution().toString()


def test_bound_is_computed_once_per_unit(spark, monkeypatch):
    """What the bound needs of a unit is not computed again for every template, nor the hash set of the template words for every unit."""
    class Stop(Exception):
        pass
    seen = []

    def grab(df, name):
        seen.append(df)
        raise Stop
    monkeypatch.setattr(licenses, "stored", grab)
    with pytest.raises(Stop):
        licenses.notices(spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA))
    plan = seen[0]._jdf.queryExecution().analyzed().toString()
    at = plan.index("exists(array(")
    end, depth = at + len("exists"), 0
    while True:
        depth += {"(": 1, ")": -1}.get(plan[end], 0)
        end += 1
        if not depth:
            break
    assert "counts" not in plan[at:end] and "least_t" in plan[at:end]
    assert "array_intersect" not in plan
