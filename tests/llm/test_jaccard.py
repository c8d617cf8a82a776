from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from support import docs, sample, sampled  # noqa: F401
from tripmill.llm import jaccard_join
from tripmill.llm.common import in_slices
from tripmill.llm.components import components
from tripmill.llm.jaccard_join import jaccard_components, one_of_each
from tripmill.llm.words import Words


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            least[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed: int, groups: int, size: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 900)}" for _ in range(rng.choice([4, 6, 30, 80]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            out.append(" ".join(words))
    return out


def test_groups_equal_brute_force(sampled, sample):
    assert result(jaccard_components(sampled)) == brute([(r[0], r[1]) for r in sample])


@pytest.mark.parametrize("least_frequent, combined", [(3, 48), (3, 2)])
def test_near_copies_equal_brute_force(docs, monkeypatch, least_frequent, combined):
    """Frequent tokens in pairs, and frequent tokens alone; the test above has rare lists alone."""
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", least_frequent)
    monkeypatch.setattr(jaccard_join, "MAX_COMBINED", combined)
    texts = near_copies(least_frequent, 6, 25)
    assert result(jaccard_components(docs(*texts))) == brute(list(enumerate(texts)))


def contained(seed: int, pairs: int) -> list[str]:
    """Texts that are parts of longer ones, of similarities about 3/4: unequal sizes, few shared prefix tokens."""
    rng = random.Random(seed)
    out = []
    for k in range(pairs):
        small = rng.randint(40, 500)
        large = round(small / rng.uniform(0.75, 0.82))
        words = [f"p{k}x{i}" for i in range(large + 4)]
        out += [" ".join(words[: small + 4]), " ".join(words)]
    return out


def test_contained_texts_equal_brute_force(docs):
    texts = contained(5, 150)
    expected = {}
    for at in range(0, len(texts), 2):
        expected |= brute([(at, texts[at]), (at + 1, texts[at + 1])])
    assert result(jaccard_components(docs(*texts))) == expected


def test_sketches_never_rule_out_a_link():
    """What sketches say two sets differ by is at most what they differ by, also where counts are cut at 255."""
    rng = np.random.default_rng(3)
    for n in (2, 3, 15, 33, 64, 500, 5000):
        for share in (0.0, 0.5, 0.8, 0.95, 1.0):
            a = np.unique(rng.integers(0, 1 << 63, n, "u8"))
            own = a[: int(share * len(a))]
            b = np.unique(np.r_[own, rng.integers(0, 1 << 63, int(n * 1.3) - len(own), "u8")])
            for x, y in ((a, b), (a << np.uint64(8), b << np.uint64(8))):
                x, y = np.unique(x), np.unique(y)
                differ = len(np.setxor1d(x, y))
                assert jaccard_join._differ(jaccard_join._sketch(x), jaccard_join._sketch(y)) <= differ
    far = [np.unique(rng.integers(0, 1 << 63, 1000, "u8")) for _ in range(2)]
    assert jaccard_join._differ(*map(jaccard_join._sketch, far)) > 2000 / 7


def test_texts_that_share_a_passage_equal_brute_force(docs):
    """Lists mixed of near copies and of texts that share half of their words: pairs beyond the stars."""
    rng = random.Random(11)
    passages = [[f"s{p}x{i}" for i in range(60)] for p in range(3)]
    texts = []
    for k in range(60):
        own = [f"o{k}x{i}" for i in range(rng.randint(8, 60))]
        texts.append(" ".join(rng.choice(passages) + own))
        if k % 4 == 0:
            texts.append(" ".join([*texts[-1].split(), f"more{k}"]))
    assert result(jaccard_components(docs(*texts))) == brute(list(enumerate(texts)))


def test_repeated_ids_and_texts(docs):
    text = " ".join(f"w{i}" for i in range(50))
    near = text + " end"
    got = result(jaccard_components(docs((4, text), (4, text), (4, text), (2, near), (2, near), (9, "another text of six words here"))))
    assert got == {4: (46, 2), 2: (47, 2), 9: (2, 9)}


def test_awkward_rows(docs):
    assert jaccard_components(docs()).count() == 0
    rows = docs((5, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (1, None), (2, " "), (None, "a b c d e f"), (9, "a"), (8, "A"))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_components(rows).collect())
    assert got == [(-1, 2, 3), (1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (5, 2, 3), (8, 1, 8), (9, 1, 8)]
    kept = sorted((r.doc_id or -1) for r in one_of_each(rows).collect())
    assert kept == [-1, 1, 2, 3, 8]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    least = {i: i for e in edges for i in e}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        least[y] = x
    expected = {i: root(i) for i in least if any(i in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_common_tokens_bound_what_is_shared(docs):
    """Counts equal brute force, in whatever blocks and ranges; only words of other classes count."""
    texts = near_copies(5, 6, 4) + [f"{' '.join(f'x{k}-{i}' for i in range(20))} a passage that many of the texts hold" for k in range(6)]
    texts = sorted(set(texts))
    rows = docs(*texts).repartition(3)
    sizes = jaccard_join._sets(rows.select("doc_id", "text")).where("range is null").select("doc_id", "n", "key")
    classes = sizes.selectExpr("key", "doc_id AS rep", "n")
    got = jaccard_join._common_tokens(classes.select("key"), rows, classes).join(classes, "key").collect()
    sets = [shingles(t) for t in texts]
    expected = {
        k: n for k, own in enumerate(sets) if (n := len(own & frozenset().union(*(o for j, o in enumerate(sets) if j != k))))
    }
    assert {r.rep: r.common for r in got if r.common} == expected


def test_part_of_the_tokens_bounds_what_is_shared(docs, monkeypatch):
    """Looked up in part, in blocks of few tokens, counts are at least those of brute force and at most the set."""
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 50)
    texts = sorted({*near_copies(5, 6, 4), *(" ".join(f"x{k}-{i}" for i in range(200)) for k in range(5))})
    rows = docs(*texts).repartition(3)
    sizes = jaccard_join._sets(rows.select("doc_id", "text")).where("range is null").select("doc_id", "n", "key")
    classes = sizes.selectExpr("key", "doc_id AS rep", "n")
    sets = [shingles(t) for t in texts]
    exact = [len(own & frozenset().union(*(o for j, o in enumerate(sets) if j != k))) for k, own in enumerate(sets)]
    for share in (24, 64):
        got = {r.rep: r.common for r in jaccard_join._common_tokens(classes.select("key"), rows, classes, share).join(classes, "key").collect()}
        assert all(exact[k] <= got[k] <= len(sets[k]) for k in range(len(sets)))
        assert share < 64 or [got[k] for k in range(len(sets))] == exact
        # a text of its own alone is ruled out by a part of its tokens
        assert all(got[k] < 0.75 * len(s) for k, s in enumerate(sets) if len(s) == 196)


def test_sets_that_sketches_rule_out_are_not_sent(docs, monkeypatch):
    """Texts that share a passage and little else meet in stars, but their sets are never compared."""
    compared, real = [], jaccard_join._compared

    def watched(pairs, *rest):
        compared.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_compared", watched)
    passage = [f"s{i}" for i in range(60)]
    texts = [" ".join(passage + [f"o{k}x{i}" for i in range(400)]) for k in range(12)]
    texts += [f"{t} and more" for t in texts[:3]]
    assert result(jaccard_components(docs(*texts))) == brute(list(enumerate(texts)))
    assert sum(compared) <= 6


MEMBERS = (
    "group long, key long, n long, most long, end long, label struct<size: long, id: long>, "
    "pivot long, pivot_end long, shared long, common long"
)


def members(spark, groups):
    """Members of groups; keys below 10 are one component of five, the others stand alone."""
    rows = [
        (group, key, 100, 100, jaccard_join.LAST, (5, 1) if key < 10 else (1, key), None, None, None, 100)
        for group, keys in groups.items() for key in keys
    ]
    return spark.createDataFrame(rows, MEMBERS)


@pytest.mark.parametrize("pairs_a_task", [1_000_000, 4])
def test_pairs_of_a_family_are_looked_at_once(spark, monkeypatch, pairs_a_task):
    """Many tokens that much the same members hold give each pair once, in parts of few pairs."""
    monkeypatch.setattr(jaccard_join, "PAIRS_A_TASK", pairs_a_task)
    family = {t: {1, 2, 3, 4, 5, 11, 12, 13} - {t % 5 + 1} for t in range(20)}
    # texts of other families that share a token with this component each: they are not brought together
    apart = {100 + t: {1, 20 + t} for t in range(4)}
    expected = {
        (min(a, b), max(a, b))
        for groups in (family,) for keys in groups.values() for a in keys for b in keys if a > 10 and a != b
    } | {(1, 20 + t) for t in range(4)}
    alone = [jaccard_join._units(members(spark, g))[1] for g in (family, apart)]
    assert alone == [8 * 3, 4 * 2]
    found = [tuple(r) for r in jaccard_join._apart(members(spark, family)).collect()]
    found += [tuple(r) for r in jaccard_join._apart(members(spark, apart)).collect()]
    assert sorted(found) == sorted(expected)


def test_pairs_in_parts_equal_brute_force(docs, monkeypatch):
    """Families with members that link to few of them, cut into parts of three pairs."""
    monkeypatch.setattr(jaccard_join, "PAIRS_A_TASK", 3)
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 3)
    monkeypatch.setattr(jaccard_join, "MAX_COMBINED", 2)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(50):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    assert result(jaccard_components(docs(*texts))) == brute(list(enumerate(texts)))


def test_words_are_hashed_once_a_slice(monkeypatch):
    """Hashing costs the distinct words, and one step an occurrence."""
    hashed, real = [], jaccard_join._final

    def counting(h):
        hashed.append(len(h))
        return real(h)

    monkeypatch.setattr(jaccard_join, "_final", counting)
    texts = [" ".join(f"w{i % 7}" for i in range(1000))] * 3 + ["", "one two", None]
    sets = jaccard_join.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [7, 7, 7, 0, 1, 0]
    assert all((s[1:] > s[:-1]).all() for s in sets)
    assert sum(hashed) <= 3000 + 5 * 9


def test_words_end_at_ascii_white_space_only():
    odd = ["".join(map(chr, range(1, 400))), " a\x0bb\x0c c\x1cd\x85e\xa0f\u2003g\u3000h \r\n\t", "", None, "  ", "x"]
    words = Words(pa.array(odd))
    got = [[] for _ in odd]
    for word, row in zip(words.ids, words.row, strict=True):
        got[row].append(words.unique[word].as_py())
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in odd]


def test_a_task_gives_back_what_arrow_keeps(monkeypatch):
    """Workers wait for later stages; the memory of a pass is not to stay with them."""
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"text": ["a"] * 1100})
    slices = in_slices(iter([batch, batch]))
    assert [next(slices).num_rows for _ in range(6)] == [512, 512, 76] * 2 and not released
    assert next(slices, None) is None and released == [True]
