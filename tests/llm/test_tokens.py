from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from support import docs, sample, sampled  # noqa: F401
from tripmill.llm import tokens
from tripmill.llm.packing import Mixture, pack
from tripmill.llm.queries import vocabulary
from tripmill.llm.token_store import blocks, fetch, read_store, write_store
from tripmill.llm.tokens import encoder


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t'aé1.,s日́\x1c\u0085 　<|"), max_size=20), max_size=5))
def test_pieces_encode_as_whole_texts(texts):
    tokenizer = Tokenizer.from_file(vocabulary())
    assert [ids(x) for x in encoder(vocabulary()).encode(texts)] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_table_starts_anew_and_meets_equal_hashes(whole, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcé.,'\n", k=rng.randint(1, 9))) for _ in range(80)) for _ in range(60)]
    texts += ["<|endoftext|>a <|endoftext|>\n<|endoftext|>", "x" * 100_000, "日本" * 30_000, None, "", "it's don't\n\n\nY \n \nZ"]
    monkeypatch.setattr(tokens, "MAX_PIECES", 300)
    own = tokens.PieceEncoder(vocabulary())
    for _ in range(3):
        assert [ids(x) for k in range(0, len(texts), 7) for x in own.encode(texts[k : k + 7])] == [whole(t) for t in texts]
    monkeypatch.setattr(tokens, "hashes", lambda eights, starts, *_: np.zeros(len(starts), "u8"))
    assert [ids(x) for x in tokens.PieceEncoder(vocabulary()).encode(texts[:5])] == [whole(t) for t in texts[:5]]


def crc(tokens) -> int:
    return zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_store_round_trip(spark, sampled, sample, whole, tmp_path):
    path = str(tmp_path / "store")
    write_store(sampled, path, vocabulary(), end_id=2)
    expected, start = [], 0
    for row in sorted(sample):
        tokens = [*whole(row[1]), 2]
        expected.append((row[0], start, len(tokens), crc(tokens)))
        start += len(tokens)
    assert sorted(map(tuple, read_store(spark, path).collect())) == expected
    assert fetch(spark, path, sample[5][0]) == [[*whole(sample[5][1]), 2]]
    assert fetch(spark, path, 10**9) == []
    assert blocks(spark, path).select("dictionary_sha256").distinct().count() == 1


def test_store_of_no_rows_and_of_repeated_rows(spark, docs, tmp_path):
    write_store(docs().drop("lang"), str(tmp_path / "a"), vocabulary(), end_id=2)
    assert read_store(spark, str(tmp_path / "a")).count() == 0
    rows = docs((1, "same"), (1, "same"), (None, "x"), (1, None))
    write_store(rows, str(tmp_path / "b"), vocabulary(), end_id=2)
    got = sorted((r.start, r.n_tokens, r.doc_id is None) for r in read_store(spark, str(tmp_path / "b")).collect())
    assert got[0] == (0, 2, True) and sum(n for _, n, _ in got) == 7
    assert [s for s, _, _ in got] == list(np.cumsum([0, *(n for _, n, _ in got)])[:-1])


def check_pieces(rows, tokens: dict[int, list[int]], window: int) -> None:
    seen = {k: np.zeros(len(v), int) for k, v in tokens.items()}
    sequences: dict[int, list] = {}
    for r in rows:
        own = tokens[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == crc(own[r.start : r.start + r.length])
        seen[r.doc_id][r.start : r.start + r.length] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all((s == 1).all() for s in seen.values())
    for k in sorted(sequences):
        pieces = sorted(sequences[k])
        assert [o for o, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)])[:-1])
        if k < max(sequences):
            assert sum(n for _, n in pieces) == window


@pytest.mark.parametrize("window, least", [(2048, 64), (64, 8)])
def test_every_id_lies_in_one_piece(sampled, sample, whole, window, least):
    rows = pack(sampled, vocabulary(), 1, window=window, min_piece=least).collect()
    check_pieces(rows, {r[0]: [*whole(r[1]), 1] for r in sample}, window)


def test_windows_hold_the_target_mixture(sampled):
    rows = pack(sampled, vocabulary(), 1, window=2048, min_piece=16).collect()
    total: dict[str, int] = {}
    for r in rows:
        total[r.queue] = total.get(r.queue, 0) + r.length
    full = sum(total.values()) // 2048
    share = {q: n / sum(total.values()) for q, n in total.items()}
    for k in range(1, full):
        inside: dict[str, int] = {}
        for r in rows:
            if r.sequence_id < k:
                inside[r.queue] = inside.get(r.queue, 0) + r.length
        # deficits carry over, so no queue is ever ahead or behind by more than a round's rest
        assert all(abs(inside.get(q, 0) - s * k * 2048) <= 16 * len(share) + 2048 * s + 16 for q, s in share.items())


def test_packing_of_awkward_rows(docs):
    assert pack(docs(), vocabulary(), 1).count() == 0
    rows = pack(docs((1, "same"), (1, "same"), (2, None), (3, "")), vocabulary(), 1).collect()
    assert sum(r.length for r in rows) == 6 and {r.sequence_id for r in rows} == {0}
    many = pack(docs(*["word"] * 30), vocabulary(), 1, max_queues=2).collect()
    assert sum(r.length for r in many) == 60


@given(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 5000), min_size=1),
    st.dictionaries(st.sampled_from("abcdef"), st.floats(0, 1)),
)
@settings(max_examples=60, deadline=None)
def test_rounds_serve_every_token_once(totals, targets):
    mixture = Mixture(totals, targets, 128, 8)
    served = mixture.served(np.arange(0, mixture.last + 1))
    assert (np.diff(served, axis=0) >= 0).all()
    assert served[-1].tolist() == [totals[n] for n in mixture.names]
    places = []
    for queue, name in enumerate(mixture.names):
        if totals[name]:
            _, starts, lengths, at = mixture.cut(queue, 0, np.array([totals[name]]))
            assert lengths.sum() == totals[name]
            places += [p + k for p, n in zip(at.tolist(), lengths.tolist(), strict=True) for k in range(n)]
    assert sorted(places) == list(range(sum(totals.values())))


def test_targets_hold_with_more_sources_than_queues(spark):
    from tripmill.llm.common import ship

    ship(spark)
    rows = [(k, "some words of text " * 40, s) for k, s in enumerate(["big"] * 60 + ["wanted"] * 60 + [None] * 60 + [f"t{i}" for i in range(30)])]
    many = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pack(many, vocabulary(), end_id=1, targets={"wanted": 3.0, None: 1.0}, window=512, max_queues=8).collect()
    early = [r for r in got if r.sequence_id < 8]
    total = sum(r.length for r in early)
    held = {q: sum(r.length for r in early if r.queue == q) / total for q in ("swanted", "n")}
    assert abs(held["swanted"] - 0.75) < 0.05 and abs(held["n"] - 0.25) < 0.05
    assert "sbig" in {r.queue for r in got} and len({r.queue for r in got}) <= 8
    assert {r.doc_id for r in got} == set(range(210))
    with pytest.raises(ValueError):
        pack(many, vocabulary(), end_id=1, targets={"absent": 1.0})
