"""The trie and its sums against plain Python, with rounds of Spark and without."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from support import docs  # noqa: F401
from tripmill.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, d int, n int, comp string, rest long"


def build(spark, rows):
    return spark.createDataFrame([(*r, "own", 7, 7, "x", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[:2], x[2].encode(), x[3].encode()))] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
    out = set()
    for p, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(whole[c]) == len(p))))
        up = min(members[p[:-1]]) if p else None
        out.add((min(ids), len(p), up, len(ids), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def chatter(rng, n, long=0):
    said = ["hello there", "tell me more", "", None, "a  b\tc", "é中 \U0001f600", "one two three four"]
    rows = []
    for c in rng.sample(range(-60, 400), n):
        for k in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([k, k, None]), rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [(7, k, "user", f"turn {k % 5}") for k in range(long)]
    rows += [(47, k, "user", f"turn {k % 5}") for k in range(long // 2)]
    return rows + rows[:5] + [(None, 1, "user", "nobody's"), (None, None, None, None)]


def forest(rng, n, lean):
    parent = [-1]
    for k in range(1, n):
        parent.append(-1 if rng.random() < 0.03 else max(0, k - rng.randint(1, lean)))
    depth = []
    for p in parent:
        depth.append(0 if p < 0 else depth[p] + 1)
    order = list(range(n))
    rng.shuffle(order)
    at = {old: new for new, old in enumerate(order)}
    return np.array([at[parent[o]] if parent[o] >= 0 else -1 for o in order]), np.array([depth[o] + 3 for o in order])


@pytest.mark.parametrize("n, lean", [(0, 1), (1, 1), (2, 1), (500, 1), (700, 3), (700, 700)])
def test_centroid_rollup_equals_plain_sums(n, lean):
    rng = random.Random(n + lean)
    parent, depth = forest(rng, n, lean) if n else (np.empty(0, "i8"), np.empty(0, "i8"))
    values = np.array([[rng.randint(0, 9), 1] for _ in range(n)], "i8").reshape(n, 2)
    want = values.copy()
    for k in sorted(range(n), key=lambda i: -depth[i]):
        if parent[k] >= 0:
            want[parent[k]] += want[k]
    assert (trie.centroid_rollup(parent, depth, values) == want).all()


def test_trie_equals_brute_force(spark):
    rows = chatter(random.Random(3), 150)
    assert result(trie.conversation_trie(build(spark, rows))) == brute(rows)


def test_large_components_and_long_conversations_are_split(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "PIECE_BYTES", 8)
    rows = chatter(random.Random(5), 60, long=40)
    rows += [(1000 + k, 0, "user", "the same first turn") for k in range(40)]
    assert result(trie.conversation_trie(build(spark, rows), local_nodes=25)) == brute(rows)


def test_very_long_text_and_turnless_conversations(spark):
    # 21 takes its one turn from 20, which is absent, so nothing is left of it
    c = next(k for k in range(21, 40) if zlib.crc32(str(k).encode()) % 4 >= 1)
    rows = [(c, 0, "user", "word " * 200_000), (40, 0, "user", "word " * 200_000), (41, 0, "user", "x")]
    got = result(trie.conversation_trie(build(spark, rows)))
    assert got == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_no_conversations(spark):
    assert trie.conversation_trie(build(spark, [(None, 0, "user", "x")])).collect() == []
    assert trie.conversation_trie(build(spark, [(None, 0, "user", "x")]).limit(0)).collect() == []
