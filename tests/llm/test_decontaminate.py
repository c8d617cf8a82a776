from __future__ import annotations

import hashlib
import random
import re

import pytest

from conftest import plan_text
from support import SF_DIR, docs  # noqa: F401
from tripmill.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=13):
    own = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        each = words(item)
        n = min(window, len(each))
        for i in range(len(each) - n + 1) if n else []:
            for at in range(len(own) - n + 1):
                if own[at : at + n] == each[i : i + n]:
                    hit |= set(range(at, at + n))
                    found.add(str(item_id))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(own)


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)] + ["the"] * 20
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, draw(rng.choice([1, 2, 5, 13, 14, 30]))) for k in range(15)] + [(99, None), (98, "--"), (3, draw(20)), (4, "the " * 20)]
    texts = []
    for k in range(60):
        body = draw(rng.randint(0, 60)).split()
        for _ in range(rng.randint(0, 2)):
            item = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(body))
            body[at:at] = item[rng.randint(0, 2) :]
        texts.append(" ".join(body).upper() if k % 3 else "\n".join(body))
    return [*texts, None, "", "the " * 50, "É " * 20], items


def test_hits_equal_brute_force(spark, docs, cases):
    texts, items = cases
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate(docs(*texts), benchmark)) == {k: brute(t, items) for k, t in enumerate(texts)}


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [tuple(r) for r in benchmark.collect()]
    by_words = {}
    for item_id, text in items:
        each = words(text)
        for i in range(len(each) - 12):
            by_words.setdefault(tuple(each[i : i + 13]), set()).add(str(item_id))
    got = result(decontaminate(docs, benchmark))
    for row in docs.collect():
        own = words(row.text)
        at = [i for i in range(len(own) - 12) if tuple(own[i : i + 13]) in by_words]
        hit = {i + k for i in at for k in range(13)}
        names = sorted({n for i in at for n in by_words[tuple(own[i : i + 13])]})
        assert got[row.doc_id][:3] == (len(own), len(hit), len(names))


def test_awkward_inputs(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(decontaminate(docs("a b"), none))[0][:3] == (2, 0, 0)
    assert decontaminate(docs(), none).count() == 0
    items = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "y z")], "item_id long, text string")
    rows = docs((1, "x y z"), (1, "x y z"), (None, "x y")).withColumnRenamed("lang", "spans")
    got = sorted((r.doc_id or 0, r.n_hit, r.n_items) for r in decontaminate(rows, items).collect())
    assert got == [(0, 2, 1), (1, 3, 2), (1, 3, 2)]


def near(text, items, window=13, slack=1):
    own, found = words(text), set()
    for item_id, item in items:
        each = words(item)
        n = min(window, len(each))
        d = min(slack, n // 4)
        for i in range(len(each) - n + 1) if n else []:
            for shift in range(-n - slack - i, len(own) + slack):
                at = []
                for p in range(i, i + n):
                    order = sorted(range(-slack, slack + 1), key=abs)
                    at += [p + shift + k for k in order if 0 <= p + shift + k < len(own) and own[p + shift + k] == each[p]][:1]
                if len(at) >= n - d:
                    found.add(str(item_id))
    return sorted(found)


def test_proximity_matches_equal_brute_force(spark, docs, cases):
    texts, items = cases
    rng = random.Random(9)
    changed = []
    for k, (_, item) in enumerate(i for i in items if len(words(i[1])) >= 13):
        for how in range(3):
            own = words(item)
            at = rng.randint(4, 8)
            own[at : at + (how != 1)] = [] if how == 0 else [f"new{k}"]
            changed.append(" ".join(["before", *own, "after"]))
    texts = texts[:20] + changed
    got = decontaminate(docs(*texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.near_items for r in got} == {k: near(t, items) for k, t in enumerate(texts)}
    assert result(decontaminate(docs(*texts), spark.createDataFrame(items, "item_id long, text string"))) == {k: brute(t, items) for k, t in enumerate(texts)}
    assert all(r.near_items and r.near_spans for r in got if r.doc_id >= 20)


def test_a_filter_on_the_verdict_does_not_repeat_the_search(spark, docs):
    """Words are split once for the verification, and the filter reads what was found."""
    found = decontaminate(docs("a b c"), spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    plan = plan_text(found.where("not contaminated").select("doc_id"))
    assert plan.count("split(") == 1
