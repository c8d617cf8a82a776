from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from support import docs, sample  # noqa: F401
from tripmill.llm.induced_sort import permuted_common_prefixes, suffix_array
from tripmill.llm.suffix_dedup import blocks_of, suffix_dedup


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_and_prefixes(values):
    text = np.array([*values, 0], "u2")
    order = suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    shared, before = permuted_common_prefixes(text, order, 9)
    for a, b in zip(order[1:].tolist(), order[:-1].tolist(), strict=True):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert (shared[a], before[a]) == (min(n, 9), b)


def brute(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(r[s : s + length] for _, r in raws for s in range(len(r) - length + 1))
    out = {}
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - length + 1):
            if times[raw[s : s + length]] > 1:
                gone[s] += 1
                gone[s + length] -= 1
        cover = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(raw, "u1")[~cover].tobytes()
        runs = int((np.diff(np.r_[0, cover.astype(int)]) == 1).sum())
        out[i] = len(raw), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("most", [4096, 1])
def test_removal_equals_brute_force(docs, sample, most):
    """With the shards' suffix arrays, and with every key split by its strings."""
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice(["alpha", "béta", "gamma", "d", "漢字"]) + str(rng.randint(0, 99)) for _ in range(n))
    passages = [words(n) for n in (60, 80, 200)]
    texts = [words(rng.randint(0, 90)) + rng.choice(["", *passages]) + words(rng.randint(0, 20)) for _ in range(40)]
    texts += [texts[3], passages[1] * 2, "a" * 1500, "ab" * 450, None, "", "x" * 399, "x" * 400]
    texts += [r[1] for r in sample[:60]]
    got = result(suffix_dedup(docs(*texts), max_segments=most))
    assert got == brute(list(enumerate(texts)), 400)


def test_awkward_rows(docs):
    assert suffix_dedup(docs()).count() == 0
    long = "".join(chr(97 + k * k % 26) for k in range(500))
    rows = docs((1, long), (1, long), (2, "short"), (2, "short"), (None, None)).withColumnRenamed("lang", "spans")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup(rows).collect())
    assert got == [(0, 0), (1, 500), (1, 500), (2, 0), (2, 0)]


def test_blocks_cover_every_start_once():
    raw = bytes(random.Random(1).choices(range(97, 101), k=3000))
    _, first, n = blocks_of(raw)
    assert first.tolist() == np.r_[0, np.cumsum(n)[:-1]].tolist() and n.sum() == 3000 - 399
    assert n.max() <= 128
