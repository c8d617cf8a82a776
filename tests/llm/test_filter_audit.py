"""Transducer and hash table against plain Python, the audit against brute force over all orders."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa

from support import docs, sample  # noqa: F401
from tripmill.llm import filter_audit as audit

LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return len(w), len(set(w)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def test_transducer_equals_plain_counts(sample):  # noqa: F811
    rng = random.Random(4)
    alphabet = "ab Z#\t\n\x0b\x0c\r é中\U0001f600\x00\x1f\x85\xa0%|"
    texts = [r[1] for r in sample] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["w" * 200_000 + " " + "w" * 200_000 + " " + "w" * 199_999, "é" * 9, " ", None]
    found = audit.measure(pa.array(texts, pa.string()).slice(1))
    assert list(zip(*[v.tolist() for v in found.values()])) == [plain(t) for t in texts[1:]]
    assert all(len(v) == 0 for v in audit.measure(pa.array([], pa.string())).values())


def test_spans_of_equal_hash_are_verified(monkeypatch):
    """With a hash that always collides the table still tells all words apart."""
    monkeypatch.setattr(audit, "hashes", lambda eights, starts, *_: np.zeros(len(starts), "u8"))
    texts = [" ".join(f"word{k % 17}" for k in range(60)), "a b a ab ba a", "a b"]
    assert audit.measure(pa.array(texts))["n_distinct"].tolist() == [17, 4, 2]


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    fails = []
    for i, text, source in rows:
        n, distinct, capitals, chars, symbols = plain(text)
        f = "A" * (n < 200) + "B" * (100 * distinct < 50 * n) + "C" * (100 * capitals > 2 * chars) + "D" * (symbols > 0)
        e = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows)
        fails.append((i, source or "", f + "E" * e))
    out, shapley = {}, Counter()
    for part in {s for _, s, _ in fails}:
        own = [(i, f) for i, s, f in fails if s == part]
        for order in map("".join, permutations("ABCDE")):
            for k, letter in enumerate(order):
                before = [(i, f) for i, f in own if not set(f) & set(order[:k])]
                removed = [i for i, f in before if letter in f]
                shapley[part, letter] += len(removed)
                out[part, order, k + 1] = (
                    len(before) - len(removed), len(removed),
                    sum(letter in f for _, f in own) - len(removed), sum(f == letter for _, f in own),
                    sum(i in good for i in removed), sum(i in toxic for i in removed),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = [((r.part, r.filter_order, r.step), tuple(r[n] for n in names)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_audit_equals_brute_force(spark):
    rng = random.Random(1)
    long = " ".join(f"word{k}" for k in range(230))
    some = [long, long + " #", long.upper(), "same " * 300, "same " * 300 + "$ ABC", "", None, "short", long + " A" * 12]
    rows = [(k, rng.choice(some), rng.choice(["x", "y", None, ""])) for k in range(120)]
    rows += [rows[0], rows[0], (None, long, "x"), (None, long, "x"), (-5, "short", "z"), (500, None, "only null")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 120, 2)]
    labels += [(0, 1, 0), (0, 0, 1), (None, 1, 1), (9999, 1, 1)]
    schema = "doc_id long, text string, source string, part string, n int, good boolean, fails int, digest binary"
    frame = spark.createDataFrame([(*r, "own", 1, True, 3, b"x") for r in rows], schema).repartition(4)
    got = result(audit.filter_audit(frame, spark.createDataFrame(labels, LABELS)))
    assert got == brute(rows, labels)
    shares = {}
    for (part, order, step), v in got.items():
        shares[part, order[step - 1]] = v[-1]
    by_part = Counter()
    for (part, _), v in shares.items():
        by_part[part] += v
    # the shares of all filters add up to what any order removes, 120 times
    first = "ABCDE"
    for part in {p for p, _, _ in got}:
        assert by_part[part] == 120 * sum(got[part, first, k][1] for k in range(1, 6))


def test_no_documents(spark, docs):  # noqa: F811
    empty = docs().limit(0)
    assert audit.filter_audit(empty, spark.createDataFrame([], LABELS)).collect() == []
