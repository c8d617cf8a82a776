"""Removal of repeated byte strings by suffix arrays over shards of what may repeat.

A string of ``LENGTH`` bytes that occurs twice must meet itself in one shard, whatever stands
around it. So every start of such a string belongs to an *anchor*: the place of the least hash of
``GRAM`` bytes within the string. Equal strings have their anchors at equal distances. Starts that
share an anchor and a class of distance form a block, and all strings of a block hold a common core
of bytes, whose hash is the block's key:

1. *Blocks.* Anchors, blocks and core hashes of all texts; keys that occur once drop out, and with
   them all bytes that cannot repeat. Only hashes and places are shuffled.
2. *Segments.* The bytes that a repeated key's strings cover. Equal segments are one with a count.
   A key with one segment needs no sorting: all its strings repeat. A key of more than
   ``MAX_SEGMENTS`` different ones is split further, by the hash of each single string.
3. *Sorting.* Segments are dealt to shards by key. A shard's suffix array is induced, and its
   permuted common prefixes tell which strings occur at another place.
4. *Removal.* Repeated strings' bytes are merged into runs and cut out of their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, sized_broadcast, skewed_join, stored
from tripmill.llm.induced_sort import permuted_common_prefixes, suffix_array

LENGTH = 400
GRAM = 32
#: Distances from a start to its anchor that share a block.
CLASS = 128
SHARD_BYTES = 1 << 19
MAX_SEGMENTS = 4096

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_TABLE = np.random.default_rng(1).integers(0, 1 << 63, 256, dtype="u8")

_ROWS_DDL = "k string, t long, n_bytes long, sha string, blocks array<struct<key:long,s:int,n:int>>"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, "u8")
    out[1:] = base
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def blocks_of(raw: bytes, length: int = LENGTH, gram: int = GRAM, wide: int = CLASS) -> tuple[np.ndarray, ...]:
    """(key, first start, number of starts) of each block of one text."""
    n = len(raw)
    starts = n - length + 1
    if starts <= 0:
        return (np.empty(0, "i8"),) * 3
    data = np.frombuffer(raw, "u1")
    sums = np.zeros(n + 1, "u8")
    np.cumsum(_TABLE[data] * _powers(_MULTIPLIER, n), out=sums[1:])
    inverse = _powers(_INVERSE, n)
    least = (_mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]) & np.uint64(0xFFFFFFFF00000000)) | np.arange(
        n - gram + 1, dtype="u8"
    )
    # least over windows: doubling, then two that overlap
    window, size = length - gram + 1, 1
    while 2 * size <= window:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < window:
        shift = window - size
        least = np.minimum(least[: len(least) - shift], least[shift:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype("i8")
    kind = (anchor - np.arange(starts)) // wide
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1])])
    core = anchor[first] - kind[first] * wide
    size = length - wide + 1
    key = _mix((sums[core + size] - sums[core]) * inverse[core] + kind[first].astype("u8"))
    return key.view("i8"), first, np.diff(np.r_[first, starts])


def _blocks(docs: DataFrame, length: int) -> DataFrame:
    """A row for each document: its size, hash and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("key", pa.int64()), ("s", pa.int32()), ("n", pa.int32())]))
        for batch in in_slices(batches, 256):
            raws = [(t or "").encode() for t in batch.column("text").to_pylist()]
            found = [blocks_of(raw, length) for raw in raws]
            sizes = [len(f[0]) for f in found]
            flat = [np.concatenate([f[i] for f in found]) for i in range(3)]
            entries = pa.StructArray.from_arrays(
                [pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int32()), pa.array(flat[2], pa.int32())], names=["key", "s", "n"]
            )
            offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("t"), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([hashlib.sha256(r).hexdigest() for r in raws]), pa.ListArray.from_arrays(offsets, entries).cast(kind)],
                names=["k", "t", "n_bytes", "sha", "blocks"],
            )

    return docs.select("k", "t", "text").mapInArrow(run, _ROWS_DDL)


def _segment_rows(candidates: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """Segments of the repeated blocks: occurrences, or each task's different ones with counts."""
    if with_bytes:
        ddl = "key long, seg binary, n int, count long, body binary"
    else:
        ddl = "key long, seg binary, k string, t long, s int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, bytes], list] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if counts:
                keys, segs = zip(*counts, strict=True)
                n, count, body = zip(*counts.values(), strict=True)
                counts.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(segs, pa.binary()), pa.array(n, pa.int32()), pa.array(count, pa.int64()), pa.array(body, pa.binary())],
                    names=["key", "seg", "n", "count", "body"],
                )

        for batch in in_slices(batches, 128):
            rows = []
            for k, t, text, blocks in zip(*(batch.column(c).to_pylist() for c in ("k", "t", "text", "blocks")), strict=True):
                raw = (text or "").encode()
                for block in blocks:
                    key, s, n = block["key"], block["s"], block["n"]
                    body = raw[s : s + n + length - 1]
                    seg = xxhash.xxh3_128_digest(body)
                    if not with_bytes:
                        rows.append((key, seg, k, t, s, n))
                    elif (key, seg) in counts:
                        counts[key, seg][1] += 1
                    else:
                        counts[key, seg] = [n, 1, body]
                        held += len(body)
                if held > 16 << 20:
                    yield from flush()
                    held = 0
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["key", "seg", "k", "t", "s", "n"]
                )
        yield from flush()

    return candidates.select("k", "t", "text", "blocks").mapInArrow(run, ddl)


def repeated_starts(bodies: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each different segment, which of its strings occur at another place of the shard."""
    sizes = np.array([len(b) + 1 for b in bodies])
    # bytes from 2, a mark of 1 behind each segment, and the end
    text = np.concatenate([np.frombuffer(b"\x00".join(bodies) + b"\x00\x00", "u1").astype("u2") + 2])
    ends = np.cumsum(sizes) - 1
    text[ends] = 1
    text[-1] = 0
    sa = suffix_array(text)
    plcp, phi = permuted_common_prefixes(text, sa, length)
    twice = np.flatnonzero(plcp >= length)
    found = np.zeros(len(text), bool)
    found[twice] = True
    found[phi[twice]] = True
    begins = ends - sizes + 1
    return [
        found[b : e - length + 1] | (count > 1)
        for b, e, count in zip(begins.tolist(), ends.tolist(), counts, strict=True)
    ]


def _runs(flags: np.ndarray) -> np.ndarray:
    """Flat [from, to) pairs of the true runs."""
    return np.flatnonzero(np.diff(np.r_[False, flags, False].astype("i1"))).astype("i4")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes, null the empty text. A byte goes if a string of ``length`` bytes over
    it also starts at any other place, in the same or another row; repeated rows therefore go
    whole, if they are long enough. ``spans`` are the removed runs, as flat [start, end) pairs.
    Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("k"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t"),
        F.col("text").cast("string").alias("text"),
    )
    rows = stored(_blocks(docs, length), "suffix-blocks")
    each = rows.select("k", "t", F.inline("blocks"))
    counted = each.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = stored(counted, "suffix-repeated")
    n_repeated = repeated.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # a passage that a third of all documents share is one hot key
    kept_blocks = skewed_join(each, repeated, ["key"], "_n", n_repeated).groupBy("k", "t").agg(F.collect_set(F.struct("key", "s", "n")).alias("blocks"))
    candidates = stored(docs.join(kept_blocks, ["k", "t"]), "suffix-candidates")

    occurrences = stored(_segment_rows(candidates, length, False), "suffix-occurrences")
    segments = stored(occurrences.groupBy("key", "seg").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")), "suffix-segments")
    every = stored(
        segments.groupBy("key").agg(
            F.count(F.lit(1)).alias("different"), F.sum(F.col("n") + (length - 1)).alias("bytes"), F.sum("rows").alias("rows")
        ),
        "suffix-keys",
    )
    keys = every.where("different > 1")
    n_keys, total = keys.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    shards = max(1, -(-(total or 0) // SHARD_BYTES))
    bodies = _segment_rows(candidates, length, True).join(sized_broadcast(keys.select("key", "different"), 24, n_keys), "key")

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        merged = frame.groupby(["key", "seg"], sort=True).agg({"body": "first", "count": "sum"})
        found = repeated_starts(merged["body"].tolist(), merged["count"].tolist(), length)
        hit = [i for i, flags in enumerate(found) if flags.any()]
        return pd.DataFrame(
            {
                "key": np.array([merged.index[i][0] for i in hit], "i8"),
                "seg": pd.Series([merged.index[i][1] for i in hit], dtype=object),
                "runs": pd.Series([_runs(found[i]) for i in hit], dtype=object),
            }
        )

    sorted_ = (
        bodies.where(F.col("different") <= max_segments)
        .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(sort, "key long, seg binary, runs array<int>")
    )
    # keys of too many different segments: their strings meet one by one
    strings = bodies.where(F.col("different") > max_segments).select(
        "key", "seg", "count", "body", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at")
    ).select("key", "seg", "at", "count", F.expr(f"sha2(substring(body, at + 1, {length}), 256)").alias("string"))
    common = strings.groupBy("string").agg(F.sum("count").alias("times")).where("times > 1").select("string")
    split = (
        strings.join(common, "string")
        .groupBy("key", "seg")
        .agg(F.collect_set("at").alias("at"))
        .select("key", "seg", F.flatten(F.transform("at", lambda a: F.array(a, a + 1))).alias("runs"))
    )
    found = sorted_.unionByName(split)
    # a key with one segment: every string of it occurs as often as the key
    single = segments.join(every.where("different = 1").select("key"), "key")
    found = found.join(segments.select("key", "seg", "rows"), ["key", "seg"]).unionByName(
        single.select("key", "seg", F.array(F.lit(0), F.col("n")).alias("runs"), "rows")
    )
    n_rows = every.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    spans = (
        skewed_join(occurrences, stored(found, "suffix-found"), ["key", "seg"], "rows", n_rows)
        .select("k", "t", "s", "runs")
        .groupBy("k", "t")
        .agg(F.collect_list(F.struct("s", "runs")).alias("found"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            out = []
            for k, t, text, found in zip(*(batch.column(c).to_pylist() for c in ("k", "t", "text", "found")), strict=True):
                raw = (text or "").encode()
                edge = np.zeros(len(raw) + 1, "i4")
                for one in found:
                    pairs = np.array(one["runs"]).reshape(-1, 2) + one["s"]
                    np.add.at(edge, pairs[:, 0], 1)
                    # the last string of a run begins one before its end
                    np.add.at(edge, pairs[:, 1] + length - 1, -1)
                runs = _runs(np.cumsum(edge[:-1]) > 0).reshape(-1, 2).tolist()
                digest, at = hashlib.sha256(), 0
                for begin, end in runs:
                    digest.update(raw[at:begin])
                    at = end
                digest.update(raw[at:])
                out.append((k, t, sum(e - b for b, e in runs), len(runs), digest.hexdigest(), [x for run in runs for x in run]))
            if out:
                columns = zip(*out, strict=True)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=["k", "t", "n_removed", "n_spans", "kept", "spans"],
                )

    changed = (
        candidates.select("k", "t", "text").dropDuplicates(["k", "t"]).join(spans, ["k", "t"])
        .mapInArrow(cut, "k string, t long, n_removed long, n_spans long, kept string, spans array<int>")
    )
    none = F.expr("cast(array() as array<int>)")
    ids = docs.select("doc_id", "k", "t").distinct()
    return (
        rows.select("k", "t", "n_bytes", "sha")
        .join(changed, ["k", "t"], "left")
        .join(ids, ["k", "t"])
        .select(
            "doc_id", "n_bytes",
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.coalesce("kept", "sha").alias("kept_sha256"),
            F.coalesce("spans", none).alias("spans"),
        )
    )
