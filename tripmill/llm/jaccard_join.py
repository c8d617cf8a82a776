"""N-gram Jaccard join by prefixes of tokens and of token combinations.

A document's set holds the hashes of its distinct five-word shingles. Equal sets are one *class*
(its key is a hash of the set); all else works on classes, and copies are members of theirs.

* Order. Frequent tokens come last. They are found by mergeable heavy-hitter summaries
  (Misra-Gries) over all documents, so their list is bounded by ``MAX_FREQUENT`` at any input
  size; the order only steers the cost, any order gives the same links.
* Prefixes. Two sets of similarity 3/4 share at least two tokens of the prefixes that are extended
  by one token. So they share a rare token there, or two frequent ones.
* Index. Rare prefix tokens are indexed alone, in packed blocks that are grouped by hash range;
  frequent ones by token, and where that is not settled by the next step, by pairs of tokens.
* Settling. Within a list, members are first compared with one pivot, the one with most tokens
  that others share. Lists whose members are then in one component need no more comparisons; only
  members of different components are paired afterwards. So a group of near copies costs a star and
  not its square. Lists with the same largest component are paired as one where that is less work.
* Bounds before verification. Of two sets, the one whose prefix ends first shares only tokens that
  are in both prefixes, or behind its own. So its prefix tokens that no other class has in its prefix
  cannot be shared with the other one; the other's own may be, behind the first one's prefix.
* Common tokens. Members that stay unsettled are looked at once more: a token that no other of them
  (or of their pivots) has cannot be shared, so members with too few of the others have no partner.
* Sketches before verification. Tokens of a set are counted by bucket. The counts of two sets differ by no
  more than the sets do, so pairs whose counts differ too much cannot link. A sketch is a small part
  of its set, and the sets of pairs that it rules out are neither built nor moved.
* Verification compares whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, sized_broadcast, stored
from tripmill.llm.components import components
from tripmill.llm.words import Words

SHINGLE = 5
#: The list of frequent tokens holds at most this many; it is the only thing broadcast unmeasured.
MAX_FREQUENT = 1 << 20
LEAST_FREQUENT = 16
#: Tokens of unsettled frequent lists are combined in pairs where no member has more of them.
MAX_COMBINED = 48
#: Rare postings that one task groups.
RANGE_POSTINGS = 400_000
#: Tokens that a task holds before it sorts them.
BLOCK_TOKENS = 1_000_000
#: 64ths of the hashes by which members are ruled out before all of their tokens are looked up.
FIRST_SHARE = 24

#: Pairs of members that one task looks at, and the most tasks that these are dealt to.
PAIRS_A_TASK = 1_000_000
MAX_PAIR_TASKS = 10_000
#: What is known of a member that is not settled.
MEMBER = ("key", "n", "most", "end", "label", "pivot", "pivot_end", "shared", "common")

#: Where a prefix ends that has frequent tokens; rare ones are placed by their hash.
LAST = (1 << 63) - 1
_SIGN = np.uint64(1 << 63)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], "u8")


def _final(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the words of a shorter one are one shingle."""
    words = Words(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    unique = words.unique.cast(pa.binary()).to_numpy(zero_copy_only=False)
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in unique], "u8")
    n = max(len(words.ids) - SHINGLE + 1, 0)
    hashes = np.zeros(n, "u8")
    for k in range(SHINGLE if n else 0):
        # what a word adds at a place of a shingle is found once a word, not once an occurrence
        hashes += (_final(each + _ODD[k]) * _ODD[k])[words.ids[k : k + n]]
    hashes = _final(hashes)
    ends = np.cumsum(words.counts)
    out = []
    for count, end in zip(words.counts.tolist(), ends.tolist(), strict=True):
        begin = end - count
        if count >= SHINGLE:
            found = np.sort(hashes[begin : end - SHINGLE + 1])
            out.append(found[np.r_[True, found[1:] != found[:-1]]])
        elif count:
            out.append(np.array([xxhash.xxh3_64_intdigest(each[words.ids[begin:end]].tobytes(), seed=count)], "u8"))
        else:
            out.append(np.empty(0, "u8"))
    return out


def _key(tokens: np.ndarray) -> int:
    """Key of a set: one hash of all its tokens."""
    return int(np.array(xxhash.xxh3_64_intdigest(tokens.tobytes()), "u8").astype("i8"))


def _least(n):
    """Tokens that a set of n shares with any partner, at least: 3/4 of its own."""
    return (3 * n + 3) // 4


class Summary:
    """Misra-Gries summary: counts are too low by at most the tokens seen over the limit."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.tokens, self.counts = np.empty(0, "u8"), np.empty(0, "i8")
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, tokens: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            tokens = np.sort(tokens)
            first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, "i8")
            tokens, counts = tokens[first], np.diff(np.r_[first, len(tokens)])
        self.waiting.append((tokens, counts))
        self.held += len(tokens)
        if self.held >= self.limit:
            self.settle()

    def settle(self) -> None:
        tokens = np.concatenate([self.tokens, *(t for t, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, "i8")
        tokens, counts = tokens[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(tokens) > self.limit:
            counts = counts - np.partition(counts, len(counts) - self.limit - 1)[len(counts) - self.limit - 1]
            tokens, counts = tokens[counts > 0], counts[counts > 0]
        self.tokens, self.counts = tokens, counts


def _frequent(blocks: DataFrame, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent tokens and their ranks, from the tasks' summaries."""
    least = max(LEAST_FREQUENT, -(-n_tokens // MAX_FREQUENT))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = Summary(MAX_FREQUENT)
        for t, c in zip(frame["tokens"], frame["counts"], strict=True):
            total.add(_from_planes(t, "u8"), _from_planes(c, "<i4").astype("i8"))
        total.settle()
        keep = total.counts >= least
        return pd.DataFrame({"tokens": [total.tokens[keep].tobytes()], "counts": [total.counts[keep].astype("<i4").tobytes()]})

    rows = blocks.groupBy("range").applyInPandas(merge, "tokens binary, counts binary").collect()
    tokens = np.concatenate([np.frombuffer(bytes(r.tokens), "u8") for r in rows] or [np.empty(0, "u8")])
    counts = np.concatenate([np.frombuffer(bytes(r.counts), "<i4") for r in rows] or [np.empty(0, "i4")])
    ranks = np.empty(len(tokens), "i4")
    ranks[np.lexsort((tokens, counts))] = np.arange(len(tokens))
    order = np.argsort(tokens)
    return tokens[order], ranks[order]


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of numbers by significance: sorted or small numbers then have long runs of equal bytes."""
    return np.ascontiguousarray(numbers.view("u1").reshape(-1, numbers.itemsize).T).tobytes()


def _from_planes(raw: memoryview, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(size, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Keys as a table of the different ones and a place in it for each."""
    table, places = np.unique(keys, return_inverse=True)
    return np.int64(len(table)).tobytes() + _planes(table) + _planes(places.astype("<u4"))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, "i8", 1)[0])
    return _from_planes(memoryview(raw)[8 : 8 + 8 * n], "i8")[_from_planes(memoryview(raw)[8 + 8 * n :], "<u4")]


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """Tokens by bucket, two to four a bucket on average; a count of 255 stands for any above it."""
    buckets = _buckets(len(tokens))
    return np.minimum(np.bincount((tokens & np.uint64(buckets - 1)).astype("i8"), minlength=buckets), 255).astype("u1")


def _buckets(n: int) -> int:
    return max(16, 1 << (max(n // 2, 1).bit_length() - 1))


def _differ(a: np.ndarray, b: np.ndarray) -> int:
    """How many tokens are in one of two sets only, at least."""
    if len(a) > len(b):
        a, b = b, a
    folded = np.minimum(b.reshape(-1, len(a)).sum(axis=0, dtype="i8"), 255)
    return int(np.abs(folded - a).sum())


_SETS_DDL = "doc_id long, n long, key long, range int, tokens binary, counts binary"
_POSTINGS_DDL = "kind int, range int, tokens binary, keys binary, n long, frequent int"


def _sets(docs: DataFrame) -> DataFrame:
    """Rows of documents (range null) and of token summaries (doc_id null), in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, seen = Summary(MAX_FREQUENT), set()
        none = lambda n, kind: pa.nulls(n, kind)
        for batch in in_slices(batches):
            sets = shingle_sets(batch.column("text"))
            keys = [_key(s) for s in sets]
            fresh = []
            for key, tokens in zip(keys, sets, strict=True):
                if key not in seen:
                    seen.add(key)
                    fresh.append(tokens)
            if fresh:
                summary.add(np.concatenate(fresh))
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                 none(n, pa.int32()), none(n, pa.binary()), none(n, pa.binary())],
                names=["doc_id", "n", "key", "range", "tokens", "counts"],
            )
        summary.settle()
        at = np.searchsorted(summary.tokens, np.arange(1, 16, dtype="u8") << np.uint64(60))
        parts = list(zip(np.split(summary.tokens, at), np.split(summary.counts, at), strict=True))
        yield pa.RecordBatch.from_arrays(
            [none(16, pa.int64()), none(16, pa.int64()), none(16, pa.int64()), pa.array(range(16), pa.int32()),
             pa.array([_planes(t) for t, _ in parts], pa.binary()), pa.array([_planes(c.astype("<i4")) for _, c in parts], pa.binary())],
            names=["doc_id", "n", "key", "range", "tokens", "counts"],
        )

    return docs.mapInArrow(run, _SETS_DDL)


def _postings(docs: DataFrame, frequent: np.ndarray, ranks: np.ndarray, bits: int) -> DataFrame:
    """Packed postings of extended prefixes: kind 0 rare by hash range, 1 frequent, 2 sizes, 3 sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        rare: list[tuple[np.ndarray, int]] = []
        often: list[tuple[np.ndarray, int]] = []
        sizes: list[tuple[int, int, int, int]] = []
        sketches: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for kind, lists in ((0, rare), (1, often)):
                if not lists:
                    continue
                tokens = np.concatenate([t for t, _ in lists])
                keys = np.repeat(np.array([k for _, k in lists], "i8"), [len(t) for t, _ in lists])
                if kind:
                    # each token with its place among the key's frequent ones
                    places = np.concatenate([np.arange(1, len(t) + 1) for t, _ in lists])
                    rows.append((1, 0, np.stack([tokens.view("i8"), places], 1).tobytes(), keys.tobytes()))
                    continue
                order = np.argsort(tokens)
                tokens, keys = tokens[order], keys[order]
                at = np.searchsorted(tokens, np.arange(1, 1 << bits, dtype="u8") << np.uint64(64 - bits)) if bits else []
                for r, (t, k) in enumerate(zip(np.split(tokens, at), np.split(keys, at), strict=True)):
                    if len(t):
                        rows.append((0, r, _planes(t), _packed_keys(k)))
            if sizes:
                # sizes beside keys, as in the other kinds
                columns = np.array(sizes, "i8")
                rows.append((2, 0, columns[:, 1:].astype("<i8").tobytes(), columns[:, 0].tobytes()))
                rows.append((3, 0, columns[:, 1].astype("<i8").tobytes() + np.concatenate(sketches).tobytes(), columns[:, 0].tobytes()))
            for part in (rare, often, sizes, sketches):
                part.clear()
            if rows:
                kinds, ranges, tokens, keys = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array(ranges, pa.int32()), pa.array(tokens, pa.binary()), pa.array(keys, pa.binary())],
                    names=["kind", "range", "tokens", "keys"],
                )

        for batch in in_slices(batches):
            for tokens in shingle_sets(batch.column("text")):
                n = len(tokens)
                key = _key(tokens)
                # a set of one token has no partner but its copies
                if n < 2 or key in seen:
                    continue
                seen.add(key)
                length = n - _least(n) + 2
                place = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
                is_often = frequent[place] == tokens if len(frequent) else np.zeros(n, bool)
                alone = tokens[~is_often][:length]
                last = tokens[is_often][np.argsort(ranks[place[is_often]])][: length - len(alone)] if len(alone) < length else tokens[:0]
                rare.append((alone, key))
                if len(last):
                    often.append((last, key))
                # a prefix with frequent tokens holds all rare ones of its set
                end = LAST if len(last) else int((alone[-1] ^ _SIGN).astype("i8"))
                sizes.append((key, n, len(last), end))
                sketches.append(_sketch(tokens))
                held += length
            if held >= BLOCK_TOKENS:
                yield from flush()
                held = 0
        yield from flush()

    return docs.mapInArrow(run, "kind int, range int, tokens binary, keys binary")


def _rare_lists(frame: pd.DataFrame) -> pd.DataFrame:
    """Lists of at least two classes, each once with the number of tokens that have it."""
    tokens = np.concatenate([_from_planes(t, "u8") for t in frame["tokens"]])
    keys = np.concatenate([_unpacked_keys(k) for k in frame["keys"]])
    order = np.lexsort((keys, tokens))
    tokens, keys = tokens[order], keys[order]
    fresh = np.r_[True, (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])]
    tokens, keys = tokens[fresh], keys[fresh]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    size = np.diff(np.r_[first, len(tokens)])
    lists: dict[bytes, int] = {}
    for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        raw = keys[at : at + n].tobytes()
        lists[raw] = lists.get(raw, 0) + 1
    found = pd.Series([np.frombuffer(k, "i8") for k in lists], dtype=object)
    return pd.DataFrame({"keys": found, "m": np.array(list(lists.values()), "i8")})


def _unpacked(blocks: DataFrame, ddl: str, values: int) -> DataFrame:
    """Rows of packed blocks: the key and its ``values`` numbers."""
    names = [part.split()[0] for part in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, k in zip(batch.column("tokens").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                columns = np.frombuffer(t, "i8").reshape(-1, values).T
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k, "i8")), *(pa.array(np.ascontiguousarray(c)) for c in columns)], names=names)

    return blocks.select("tokens", "keys").mapInArrow(run, ddl)


def _sketches(blocks: DataFrame) -> DataFrame:
    """Each key with its set's size and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, k in zip(batch.column("tokens").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                keys = np.frombuffer(k, "i8")
                sizes = np.frombuffer(t, "<i8", len(keys))
                ends = 8 * len(keys) + np.cumsum([_buckets(n) for n in sizes.tolist()])
                parts = [t[a:b] for a, b in zip([8 * len(keys), *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(sizes), pa.array(parts, pa.binary())], names=["key", "n", "sketch"]
                )

    return blocks.select("tokens", "keys").mapInArrow(run, "key long, n long, sketch binary")


def _may_link(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) without those whose sketches show that they differ too much."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    own = stored(sketches.join(wanted, "key", "left_semi").dropDuplicates(["key"]), "jaccard-sketches")
    sides = [own.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in ("a", "b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("na", "nb", "sa", "sb")}
            keep = []
            for na, nb, sa, sb in zip(*columns.values(), strict=True):
                both = (na + nb - _differ(np.frombuffer(sa, "u1"), np.frombuffer(sb, "u1"))) // 2
                keep.append(100 * both >= 75 * (na + nb - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, "a long, b long")


def _common_tokens(keys: DataFrame, docs: DataFrame, classes: DataFrame, share: int = 64) -> DataFrame:
    """How many tokens of each class (key, common) some other of these classes has, at most.

    Only tokens of the lowest ``share`` 64ths of hashes are looked up, the others count as common. Tokens are
    cut to 40 bits here; equal ones, and rows that repeat a doc_id and its text, make counts greater, never
    smaller. A token of many classes is one posting for each block of sets that holds it. Postings name
    classes by their places in the block, whose table of keys travels once.
    """
    wanted = stored(keys.distinct().join(classes, "key").select(F.col("rep").alias("doc_id"), "key", "n"), "jaccard-unsettled")
    rows, n_tokens = wanted.agg(F.count(F.lit(1)), F.sum("n")).first()
    bits = max(3, int(np.ceil(np.log2(max((n_tokens or 0) * share / 64 / (3 * RANGE_POSTINGS), 1)))))
    texts = docs.join(sized_broadcast(wanted.drop("n"), 32, rows), "doc_id").select("key", "text")
    top = np.uint64(share << 34)
    limits = ((np.arange(1, 1 << bits, dtype="u8") * top) >> np.uint64(bits)).astype("u8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate([t for t, _, _ in held])
            of = np.repeat(np.arange(len(held), dtype="<u4"), [len(t) for t, _, _ in held])
            order = np.argsort(tokens, kind="stable")
            tokens, of = tokens[order], of[order]
            first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, "i8")
            size = np.diff(np.r_[first, len(tokens)])
            alone = np.repeat(size == 1, size)
            # those that classes of this block share are counted here, and told to the other blocks
            counted = np.array([rest for _, _, rest in held], "i8") + np.bincount(of[~alone], minlength=len(held))
            table = np.array([k for _, k, _ in held], "i8").tobytes() + counted.astype("i8").tobytes()
            held.clear()
            # named by its content: a task that runs again with its rows in another order makes other blocks
            block = int(np.array(xxhash.xxh3_64_intdigest(table), "u8").astype("i8"))
            single, many = tokens[alone], tokens[first[size > 1]]
            at = np.searchsorted(single, limits)
            parts = zip(np.split(single, at), np.split(of[alone], at), np.split(many, np.searchsorted(many, limits)), strict=True)
            out = [(r, block, _planes(t), _planes(k), _planes(m), None) for r, (t, k, m) in enumerate(parts) if len(t) or len(m)]
            # the table goes by any range
            out.append((block & ((1 << bits) - 1), block, None, None, None, table))
            columns = zip(*out, strict=True)
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["range", "block", "tokens", "places", "many", "table"]
            )

        n = 0
        for batch in in_slices(batches):
            for key, tokens in zip(batch.column("key").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                # rows of one doc_id may differ in text; the class has the text of its key
                if _key(tokens) == key:
                    cut = tokens >> np.uint64(24)
                    cut = cut[: np.searchsorted(cut, top)].copy()
                    held.append((cut, key, len(tokens) - len(cut)))
                    n += len(cut)
                if n >= BLOCK_TOKENS:
                    yield from flush()
                    n = 0
        if held:
            yield from flush()

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        tables = frame[frame["table"].notna()]
        frame = frame[frame["table"].isna()]
        parts = [_from_planes(t, "u8") for t in frame["tokens"]]
        tokens = np.concatenate([*parts, np.empty(0, "u8")])
        many = np.unique(np.concatenate([*(_from_planes(m, "u8") for m in frame["many"]), np.empty(0, "u8")]))
        order = np.argsort(tokens, kind="stable")
        found = tokens[order]
        same = found[1:] == found[:-1]
        shared = np.empty(len(tokens), bool)
        shared[order] = np.r_[False, same][: len(found)] | np.r_[same, False][: len(found)]
        shared |= _isin(tokens, many)
        out, at = [], 0
        for block, t, places in zip(frame["block"], parts, frame["places"], strict=True):
            own, times = np.unique(_from_planes(places, "<u4")[shared[at : at + len(t)]], return_counts=True)
            at += len(t)
            if len(own):
                out.append((block, _planes(own), _planes(times.astype("<u4")), None))
        out += [(block, None, None, table) for block, table in zip(tables["block"], tables["table"], strict=True)]
        return pd.DataFrame(out, columns=["block", "places", "counts", "table"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        tables = frame[frame["table"].notna()]["table"]
        if not len(tables):
            raise RuntimeError("a block of tokens was made again while it was counted")
        # equal tables are blocks of repeated rows: their counts may be too great, which does no harm
        keys, common = np.frombuffer(tables.iloc[0], "i8").reshape(2, -1).copy()
        counts = frame[frame["table"].isna()]
        for places, times in zip(counts["places"], counts["counts"], strict=True):
            np.add.at(common, _from_planes(places, "<u4"), _from_planes(times, "<u4"))
        return pd.DataFrame({"key": keys, "common": common})

    ddl = "range int, block long, tokens binary, places binary, many binary, table binary"
    counts = texts.mapInArrow(run, ddl).groupBy("range").applyInPandas(count, "block long, places binary, counts binary, table binary")
    found = counts.groupBy("block").applyInPandas(total, "key long, common long")
    return stored(found.groupBy("key").agg(F.sum("common").alias("common")), "jaccard-common")


def _isin(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _within(a: str, b: str):
    """Whether all that a shares with b is among what ``most`` counts of a.

    A rare prefix token that b has behind its own prefix need not be.
    """
    return F.col(f"{a}.end") <= F.col(f"{b}.end")


def _fits(a: str, b: str):
    """Whether the sizes and what is shared at most allow the pair to link.

    What both share lies in both prefixes, or behind that prefix which ends first.
    """
    need = F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * 3 / 7)
    least = {x: F.floor((3 * F.col(f"{x}.n") + 3) / 4) for x in (a, b)}
    hits = F.least(*[F.col(f"{x}.most") - least[x] + 2 for x in (a, b)])
    behind = F.greatest(F.when(_within(a, b), least[a]), F.when(_within(b, a), least[b])) - 2
    sides = [F.when(_within(x, y), F.col(f"{x}.most")).otherwise(F.col(f"{x}.n")) for x, y in ((a, b), (b, a))]
    return (need <= F.least(*sides, hits + behind)) & (
        4 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= 3 * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))
    )


def _beyond_pivot(a: str, b: str):
    """Whether two members that were compared with one pivot may link, by what each shares with it.

    What both share lies in the pivot, at most the lesser of their overlaps with it, or
    outside, at most the lesser of what else they have. Of that, tokens that others do not have are
    left out only where ``most`` covers both what is shared with the pivot and with the other.
    """
    need = F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * 3 / 7)
    outside = [
        F.least(
            F.when(_within(x, y) & (F.col(f"{x}.end") <= F.col(f"{x}.pivot_end")), F.col(f"{x}.most")).otherwise(F.col(f"{x}.n")),
            F.col(f"{x}.common"),
        )
        - F.col(f"{x}.shared")
        for x, y in ((a, b), (b, a))
    ]
    at_most = F.least(F.col(f"{a}.shared"), F.col(f"{b}.shared")) + F.greatest(F.least(*outside), F.lit(0))
    apart = ~F.col(f"{a}.pivot").eqNullSafe(F.col(f"{b}.pivot")) | F.col(f"{a}.pivot").isNull()
    return (need <= F.least(F.col(f"{a}.common"), F.col(f"{b}.common"))) & (apart | (need <= at_most))


def _units(frame: DataFrame) -> tuple[DataFrame, int]:
    """Members of mixed groups by unit, with the unit's parts; how many pairs the units have.

    Groups that have the same largest component are one unit where that gives fewer pairs than they
    give one by one: most tokens of a family are held by much the same members. ``parts`` says into how
    many parts a unit's members outside its largest component are cut, so that none has too many pairs.
    """
    largest = frame.groupBy("group").agg(F.max("label").alias("largest"), F.min("label").alias("other")).where("largest <> other")
    mixed = frame.join(largest.drop("other"), "group").withColumn("outside", F.col("label") != F.col("largest"))
    mixed = stored(mixed, "jaccard-mixed")
    n, o = F.count(F.lit(1)), F.count(F.when(F.col("outside"), 1))
    alone = mixed.groupBy("largest", "group").agg((n * o).alias("pairs")).groupBy("largest").agg(F.sum("pairs").alias("alone"))
    together = mixed.select("largest", "key", "outside").distinct().groupBy("largest").agg((n * o).alias("together"))
    merged = stored(alone.join(together, "largest").select("largest", (F.col("together") <= F.col("alone")).alias("merged")), "jaccard-merged")
    # a group's own name and its component's may be equal numbers, and are told apart
    unit = F.when(F.col("merged"), F.struct(F.lit(True).alias("merged"), F.col("largest.id").alias("id"))).otherwise(
        F.struct(F.lit(False).alias("merged"), F.col("group").alias("id"))
    )
    named = stored(mixed.join(merged, "largest").select(unit.alias("unit"), *MEMBER, "outside").distinct(), "jaccard-units")
    parts = F.least(F.ceil(n * o / PAIRS_A_TASK), o)
    sizes = stored(named.groupBy("unit").agg((n * o).alias("pairs"), parts.alias("parts")), "jaccard-unit-sizes")
    return named.join(sizes.select("unit", "parts"), "unit"), sizes.agg(F.sum("pairs")).first()[0] or 0


def _apart(frame: DataFrame) -> DataFrame:
    """Pairs of members (of ``MEMBER``) of a ``group`` that are in different components and may link.

    One of them is outside the group's largest component, so its members are not paired among
    themselves. Tasks get pairs in equal numbers, not rows: few rows may have very many pairs.
    """
    members, n_pairs = _units(frame)
    tasks = max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n_pairs // PAIRS_A_TASK, MAX_PAIR_TASKS))
    member = F.struct(*MEMBER, "outside")
    a = members.where("outside").select("unit", F.pmod(F.xxhash64("key"), "parts").alias("part"), member.alias("a"))
    b = members.select("unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), member.alias("b"))
    once = ~F.col("b.outside") | (F.col("a.key") < F.col("b.key"))
    return (
        a.repartition(tasks, "unit", "part").join(b.repartition(tasks, "unit", "part"), ["unit", "part"])
        .where((F.col("a.label.id") != F.col("b.label.id")) & once & _fits("a", "b") & _beyond_pivot("a", "b"))
        .select(F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b"))
    )


def _compared(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes with the sizes of intersection and union of their whole sets."""
    # each class with those that it is sent to, and whether others are sent to it
    sides = pairs.select(F.col("b").alias("key"), F.col("a").alias("to")).unionByName(pairs.select(F.col("a").alias("key"), F.lit(None).cast("long").alias("to")))
    ends = sides.groupBy("key").agg(F.collect_set("to").alias("to"), F.max(F.col("to").isNull()).alias("pivot"))
    ends = stored(ends.join(classes, "key").select(F.col("rep").alias("doc_id"), "key", "to", "pivot"), "jaccard-ends")
    n_ends, n_pairs = ends.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("to")), F.lit(0))).first()
    texts = docs.join(sized_broadcast(ends, 48, n_ends + n_pairs), "doc_id").select("key", "to", "pivot", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            keys, sets = batch.column("key").to_pylist(), shingle_sets(batch.column("text"))
            # rows of one doc_id may differ in text; the class has the text of its key
            own = [i for i, (k, s) in enumerate(zip(keys, sets, strict=True)) if _key(s) == k]
            if own:
                tokens = pa.array([sets[i].view("i8") for i in own], pa.list_(pa.int64()))
                kept = batch.select(["key", "to", "pivot"]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*kept.columns, tokens], names=["key", "to", "pivot", "tokens"])

    sets = stored(texts.mapInArrow(run, "key long, to array<long>, pivot boolean, tokens array<long>"), "jaccard-sets")
    if sets.count() > n_ends:
        # rows that repeat both doc_id and text
        sets = stored(sets.dropDuplicates(["key"]), "jaccard-distinct-sets")
    # few classes are pivots: only their sets are needed on that side
    left = sets.where("pivot").select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.explode("to").alias("a"), F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return right.join(left, "a").select("a", "b", both.alias("both"), (F.size("ta") + F.size("tb") - both).alias("union"))


def _linked(compared: DataFrame) -> DataFrame:
    return compared.where(100 * F.col("both") >= 75 * F.col("union")).select("a", "b")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, class_key.

    Words are runs without ASCII white space, A-Z in lower case. Rows link when their sets'
    similarity is at least 3/4; ``component_id`` is the smallest doc_id that links reach. Equal
    sets are linked; empty sets (null, empty or blank text) with nothing, not even each other.
    Rows of equal doc_id count as linked rows of their own; a null doc_id is never the smallest
    unless there is no other. An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pass1 = stored(_sets(docs), "jaccard-sizes")
    rows = pass1.where("range is null").select("doc_id", "n", "key")
    n_tokens = rows.agg(F.sum("n")).first()[0] or 0
    frequent, ranks = _frequent(pass1.where("range is not null"), n_tokens)
    classes = stored(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "jaccard-classes")

    bits = max(3, int(np.ceil(np.log2(max(n_tokens * 0.27 / RANGE_POSTINGS, 1)))))
    postings = stored(_postings(docs, frequent, ranks, bits), "jaccard-postings")
    lists = (
        postings.where("kind = 0").groupBy("range").applyInPandas(_rare_lists, "keys array<long>, m long")
        .groupBy("keys").agg(F.sum("m").alias("m"))
    )
    lists = stored(lists.withColumn("list", F.xxhash64("keys")), "jaccard-lists")
    often = stored(_unpacked(postings.where("kind = 1"), "key long, token long, place long", 2).distinct(), "jaccard-frequent")
    sizes = _unpacked(postings.where("kind = 2"), "key long, n long, frequent long, end long", 3).distinct()
    # tokens shared with classes whose prefixes end no earlier, at most: those seen in the prefix and all behind it
    seen = lists.select(F.explode("keys").alias("key"), "m").groupBy("key").agg(F.sum("m").alias("live"))
    n = F.col("n")
    least = F.floor((3 * n + 3) / 4)
    info = stored(
        sizes.join(seen, "key", "left")
        .select("key", "n", (least - 2 + F.coalesce("live", F.lit(0)) + F.col("frequent")).alias("most"), F.coalesce("live", F.lit(0)).alias("live"), "end")
        .where(F.col("most") >= least),
        "jaccard-info",
    )
    # members of lists, without those that can have no partner
    members = stored(lists.select("list", F.explode("keys").alias("key")).join(info, "key"), "jaccard-members")
    often = stored(often.join(info, "key"), "jaccard-frequent-members")

    # stars: the member with most shared tokens against the others
    pivot = F.max_by(F.struct("key", "n", "most", "end"), F.struct((F.col("most") / F.col("n")).alias("r"), "n", "key"))

    def star(frame: DataFrame, group: str) -> DataFrame:
        return (
            frame.groupBy(group).agg(pivot.alias("a")).join(
                frame.select(group, F.struct("key", "n", "most", "end").alias("b")), group
            )
            .where((F.col("a.key") != F.col("b.key")) & _fits("a", "b"))
            .select(F.col("a.key").alias("a"), F.col("b.key").alias("b"))
            .distinct()
        )

    stars = stored(star(members, "list").unionByName(star(often, "token")).distinct(), "jaccard-stars")
    sketches = _sketches(postings.where("kind = 3"))
    able = stored(_may_link(stars, sketches), "jaccard-able-stars")
    compared = stored(_compared(able, docs, classes), "jaccard-stars-compared")
    links = _linked(compared)
    labels = components(links)
    labels = stored(labels.join(labels.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component"), "jaccard-star-labels")

    # each member's most common pivot, and what it shares with that one
    sides = compared.select(F.col("b").alias("key"), F.col("a").alias("pivot"), F.col("both").alias("shared"))
    own = compared.select("a").distinct().join(info, F.col("a") == F.col("key")).select("key", F.col("a").alias("pivot"), F.col("n").alias("shared"))
    popular = sides.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    pivots = stored(
        sides.unionByName(own).join(popular, "pivot").groupBy("key")
        .agg(F.max_by(F.struct("pivot", "shared"), F.struct("members", "pivot")).alias("p"))
        .select("key", "p.pivot", F.col("p.shared").cast("long").alias("shared"))
        .join(info.select(F.col("key").alias("pivot"), F.col("end").alias("pivot_end")), "pivot"),
        "jaccard-pivots",
    )

    def unsettled(frame: DataFrame, group: str) -> DataFrame:
        """Members of the groups whose members are in different components."""
        labelled = frame.join(labels, frame["key"] == labels["node"], "left").select(
            frame["*"], F.struct(F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("component", "key").alias("id")).alias("label")
        )
        mixed = labelled.groupBy(group).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(group)
        return labelled.join(mixed, group)

    rest = stored(unsettled(members, "list"), "jaccard-rest")
    rest_often = stored(unsettled(often, "token"), "jaccard-rest-frequent")
    who = reduce(DataFrame.unionByName, [f.select("key", "n") for f in (rest, rest_often)]).distinct()
    who = stored(who.join(pivots, "key", "left"), "jaccard-unsettled-members")
    # A part of the tokens rules out most members. The others are counted again, among themselves and with
    # all tokens; pivots stay, as what is shared with them is taken off what is common.
    for share in (FIRST_SHARE, 64):
        keys = who.select("key").unionByName(who.where("pivot is not null").select(F.col("pivot").alias("key")))
        common = _common_tokens(keys, docs, classes, share)
        who = stored(who.drop("common").join(common, "key").where(F.col("common") >= least), "jaccard-able-members")
    rest, rest_often = (f.join(who.drop("n"), "key") for f in (rest, rest_often))
    rest, rest_often = stored(rest, "jaccard-rest-able"), stored(rest_often, "jaccard-rest-frequent-able")
    # Pairs without a common rare token have frequent ones in both prefixes, so most bounds both.
    # The smallest partner in a member's lists bounds how much it must share. What it may then
    # miss of its tokens that others have bounds how early it shares two of them.
    smallest = rest_often.groupBy("token").agg(F.min("n").alias("least_n"))
    room = (
        rest_often.join(smallest, "token")
        .groupBy("key")
        .agg(F.min("least_n").alias("least_n"), F.first("n").alias("n"), F.first("most").alias("most"), F.first("live").alias("live"))
        .select("key", (F.col("most") - F.ceil((n + F.greatest(F.col("least_n"), least)) * 3 / 7) + 2 - F.col("live")).alias("early"))
        .where("early > 0")
    )
    rest_often = rest_often.join(room, "key").where("place <= early")
    mine = rest_often.groupBy("key").agg(F.count(F.lit(1)).alias("mine"))
    widest = rest_often.join(mine, "key").groupBy("token").agg(F.max("mine").alias("most_mine"))
    rest_often = stored(rest_often.join(widest, "token"), "jaccard-rest-early")
    single = rest_often.where(F.col("most_mine") > MAX_COMBINED)
    tokens = F.array_sort(F.collect_set("token"))
    sets = rest_often.where(F.col("most_mine") <= MAX_COMBINED).groupBy(*MEMBER).agg(tokens.alias("t"))
    # each two once, as a hash: a pair of tokens that shares it with another only adds candidates
    both = F.flatten(F.transform("t", lambda x: F.transform(F.filter("t", lambda y: y > x), lambda y: F.xxhash64(x, y))))
    combined = stored(sets.select(*MEMBER, F.explode(both).alias("two")), "jaccard-combined")
    groups = ((rest, "list"), (single, "token"), (combined, "two"))
    pairs = _apart(reduce(DataFrame.unionByName, [f.select(F.col(on).alias("group"), *MEMBER) for f, on in groups]))
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.distinct().join(known, ["a", "b"], "left_anti"), "jaccard-pairs")
    pairs = stored(_may_link(pairs, sketches), "jaccard-able-pairs")
    more = _linked(_compared(pairs, docs, classes))
    final = stored(components(stored(links.unionByName(more), "jaccard-links")), "jaccard-labels")

    labelled = classes.join(final, classes["key"] == final["node"], "left").select(
        classes["key"], "rep", F.coalesce("component", "key").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = labelled.join(smallest, "component").select("key", "component_id")
    empty = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class_key"))
    return rows.where("n > 0").join(named, "key").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("key").alias("class_key")
    ).unionByName(empty)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked documents: that of the smallest doc_id.

    Rows that share a doc_id are one document here and one of them stays (the one of the
    smallest text); rows without a doc_id cannot be told apart and all stay.
    """
    verdicts = jaccard_components(docs).where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.col("component_id") == F.col("doc_id")).alias("_first")
    )
    others = [c for c in docs.columns if c != "doc_id"]
    row = F.min(F.struct("text", *[F.col(f"`{c}`") for c in others if c != "text"])).alias("_row")
    named = docs.where("doc_id is not null").groupBy("doc_id").agg(row).join(verdicts.where("_first"), "doc_id", "left_semi")
    return named.select("doc_id", *[F.col("_row")[c].alias(c) for c in others]).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(
        docs.where("doc_id is null")
    )
