from __future__ import annotations

import re
import random
import duckdb

from conftest import plan_text
from support import SCHEMA, docs, sample, sampled  # noqa: F401
from tripmill.llm.license_scan import TEMPLATES, complete_texts, license_scan
from tripmill.llm.line_dedup import line_dedup
from tripmill.llm.oracles import ORACLES


def brute_lines(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)
    return out


def test_lines_equal_brute_force(docs):
    texts = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb", "q\nq\nq\nq\nq", "\n\n\n\n", "b\nc\nd\ne\nb\nc\nd"]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(docs(*texts)).collect()}
    assert got == brute_lines(list(enumerate(texts)))
    assert got[1] == ("x\ny", 3) and got[0] == ("a\nb\nc\nd", 0)


def test_awkward_lines(docs):
    assert line_dedup(docs()).count() == 0
    rows = docs((1, None), (1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (2, "")).withColumnRenamed("lang", "n_lines")
    got = sorted((r.doc_id or 0, r.text or "", r.n_lines, r.n_removed) for r in line_dedup(rows).collect())
    # equal rows share a verdict; a null id sorts first, so its lines are the ones that stay
    assert got == [(0, "a\nb\nc", 3, 0), (1, "", 0, 0), (1, "", 3, 3), (1, "", 3, 3), (2, "", 1, 0)]


def test_licences_equal_sql(spark, sampled, sample):
    notices = ["Released under the MIT License.", "text\nLicensed under the Apache License, version 2.0\nmore", "Licensed under CC BY 4.0."]
    extra = [(10_000 + k, t, None, None, None) for k, t in enumerate(notices)]
    rows = spark.createDataFrame(extra, SCHEMA).unionByName(sampled)
    connection = duckdb.connect()
    connection.register("documents", rows.toPandas())
    expected = {r[0]: r[1:] for r in connection.execute(ORACLES["op1_license_scan"]).fetchall()}
    got = {r.doc_id: (r.n_matches, r.licenses, r.best_license, r.best_dice) for r in license_scan(rows).collect()}
    assert got == expected
    assert got[10_000][2] == "MIT" and got[10_001][2] == "Apache-2.0" and "CC-BY-4.0" in got[10_002][1]


def test_awkward_licences(docs):
    assert license_scan(docs()).count() == 0
    rows = docs(None, "", "MIT").withColumnRenamed("lang", "licenses")
    assert [(r.n_matches, r.licenses, r.best_license) for r in license_scan(rows).collect()] == [(0, "", None)] * 3
    assert license_scan(docs("a b c"), []).first().n_matches == 0
    assert license_scan(docs("A b, c"), [("own", "a b c"), ("own", "a b c"), ("none", "x")]).first().n_matches == 1


def test_passages_inside_documents(docs):
    import textwrap

    full, prose = dict(complete_texts()), "this is what the program does and how it is used " * 30
    header = textwrap.fill(dict((n, t) for n, t in TEMPLATES if "free of charge" in t)["MIT"], 78, initial_indent=" * ", subsequent_indent=" * ")
    notice = "\n".join(f"# {line}" for line in textwrap.wrap(dict(TEMPLATES)["GPL-3.0"], 40))
    texts = [
        f"/*\n * A file\n{header}\n */\n{prose}", full["MIT"].replace("<year> <copyright holders>", "2020 Some One"),
        f"{prose}\n{full['GPL-3.0']}\n{prose}", f"# {prose}\n{notice}\n{prose}", f"{prose}\n{full['Apache-2.0']}", prose, None, "",
    ]
    got = {r.doc_id: r.passages for r in license_scan(docs(*texts)).select("doc_id", "passages").collect()}
    names = {k: {p.license for p in v} for k, v in got.items()}
    assert [names[k] for k in (0, 1, 3, 5, 6, 7)] == [{"MIT"}, {"MIT"}, {"GPL-3.0"}, set(), set(), set()]
    assert "GPL-3.0" in names[2] and "Apache-2.0" in names[4]
    assert any(p.start == 2 and p.dice == 1.0 for p in got[0])


def brute_passages(text, templates, least):
    words = re.findall(r"[a-z0-9]+", text)
    pairs = list(zip(words, words[1:]))
    out = []
    for name, template in sorted(templates):
        w = template.split()
        own = set(zip(w, w[1:]))
        kept = []
        for i, pair in enumerate(pairs):
            if pair not in own:
                continue
            window = set(pairs[i : i + len(w) - 1])
            dice = 2 * len(window & own) / (len(window) + len(own))
            if dice < least:
                continue
            found = (name, i, min(i + len(w), len(words)), dice)
            if not kept or i >= kept[-1][2]:
                kept.append(found)
            elif dice > kept[-1][3]:
                kept[-1] = found
        out += kept
    return sorted(out)


def test_passages_equal_brute_force(docs):
    """Recurring bigrams, two copies of a passage, copies side by side, and damaged ones."""
    rng = random.Random(8)
    templates = [("rep", "a b a b c d e f g h"), ("plain", "one two three four five six"), ("twice", "x y x y x y z w"), ("pair", "q r")]
    texts = ["a b a b " + "a b a b c d e f g h", "one two three four five six and one two three four five six", ("one two three four five six " * 3).strip()]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(templates)[1].split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(["a", "b", "one", "x", "junk"])
            parts.append(" ".join(words) if rng.random() < 0.7 else " ".join(rng.choices("a b c x y one junk".split(), k=5)))
        texts.append("\n".join(parts))
    got = {r.doc_id: sorted((p.license, p.start, p.end, p.dice) for p in r.passages) for r in license_scan(docs(*texts), templates, complete=[]).collect()}
    assert got == {k: brute_passages(t, templates, 0.75) for k, t in enumerate(texts)}
    assert [p[0] for p in got[0]] == ["rep"] and len([p for p in got[1] if p[0] == "plain"]) == 2 and len(got[2]) == 3


def test_filters_above_the_scan_do_not_repeat_it(spark, docs):
    """Words and matches are computed once a row, also where a filter reads a result."""
    plan = plan_text(license_scan(docs("a b")).where("n_matches > 0").select("doc_id", "n_matches"))
    assert plan.split("== Initial Plan ==")[0].count("split(") <= 2
