"""Mixture-controlled packing by deficit round-robin over source queues.

Every source has a queue: its documents' tokens in doc_id order. A round gives each queue its
quantum, ``window`` times its target share, of tokens; a queue that is owed less than
``min_piece`` waits and carries its deficit on, so that small sources are not cut into crumbs.
Rounds follow each other without a gap and are cut into windows, so there is no padding before
the last one.

The queues' state is a closed form of the round: after round r queue s has served
``min_piece * floor(r * quantum_s / min_piece + phase_s)`` tokens. What carries over between
windows, batches, tasks and partitions is therefore this number and no message; every task
can compute the place of any token from the queues' totals.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, stored
from tripmill.llm.tokens import encoder

WINDOW = 2048
MIN_PIECE = 64
#: Queues that each task keeps the state of, unless there are more targets. Of more sources, those with a
#: target and the largest have queues of their own, and the others share queues by hash.
MAX_QUEUES = 1024
_ROUNDS_AT_ONCE = 4096

_IDS_DDL = "part int, queue string, doc_id long, local_start long, n_tokens long, ids binary"
PIECE_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, queue string"
)


class Mixture:
    """Closed form of the round-robin. ``totals``: tokens a queue, ``targets``: its wanted share."""

    def __init__(self, totals: Mapping[str, int], targets: Mapping[str, float], window: int, min_piece: int):
        self.names = sorted(totals)
        self.at = {name: i for i, name in enumerate(self.names)}
        self.totals = np.array([totals[n] for n in self.names], "i8")
        share = np.array([max(float(targets.get(n, 0.0)), 0.0) for n in self.names])
        if not share.sum():
            share = self.totals.astype(float)
        share = np.maximum(share / max(share.sum(), 1e-300), 1e-12)
        self.window, self.min_piece = window, min_piece
        self.at_once = max(1, _ROUNDS_AT_ONCE * MAX_QUEUES // max(len(self.names), MAX_QUEUES))
        self.per_round = window * share / min_piece
        # phases keep small queues from all being served in the same round
        self.phase = (np.arange(len(share)) * 0.6180339887498949) % 1.0
        # the round that serves what is left of every queue
        self.last = max(1, math.ceil(int(self.totals.sum()) / window))
        if targets:
            self.last = max(
                self.last,
                max((math.ceil(t / (window * s)) for t, s in zip(self.totals, share, strict=True) if s > 1e-6), default=1),
            )

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens served after each round (rows) by each queue (columns)."""
        units = np.floor(rounds[:, None] * self.per_round + self.phase)
        got = np.minimum(units * self.min_piece, self.totals).astype("i8")
        got[rounds <= 0] = 0
        got[rounds >= self.last] = self.totals
        return got

    def round_of(self, queue: int, token: int) -> int:
        """The round that serves a queue's token (counted from 0)."""
        need = token // self.min_piece + 1
        r = math.ceil((need - self.phase[queue]) / self.per_round[queue])
        r = min(max(r, 1), self.last)
        while r > 1 and self._one(queue, r - 1) > token:
            r -= 1
        while r < self.last and self._one(queue, r) <= token:
            r += 1
        return r

    def _one(self, queue: int, r: int) -> int:
        if r >= self.last:
            return int(self.totals[queue])
        if r <= 0:
            return 0
        units = np.floor(r * self.per_round[queue] + self.phase[queue])
        return int(min(units * self.min_piece, self.totals[queue]))

    def cut(self, queue: int, begin: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of adjacent documents of one queue; the first begins at token ``begin``.

        ``ends`` is where each document ends. Returns, for each piece: its document's
        position in ``ends``, its first token in the queue, its length and its place in
        the stream of all queues.
        """
        end = int(ends[-1])
        first, last = self.round_of(queue, begin), self.round_of(queue, end - 1)
        afters, befores, bases = [], [], []
        for low in range(first, last + 1, self.at_once):
            rounds = np.arange(low, min(low + self.at_once, last + 1))
            after, before = self.served(rounds), self.served(rounds - 1)
            afters.append(after[:, queue])
            befores.append(before[:, queue])
            bases.append(before.sum(1) + (after[:, :queue] - before[:, :queue]).sum(1))
        after, before, base = map(np.concatenate, (afters, befores, bases))
        inside = base % self.window
        crossed = (inside + np.maximum(after - before, 1) - 1) // self.window
        cuts = [after, ends, np.array([begin])]
        for k in range(1, int(crossed.max()) + 1):
            cuts.append((before + k * self.window - inside)[crossed >= k])
        at = np.unique(np.concatenate(cuts))
        at = at[(at >= begin) & (at <= end)]
        starts, lengths = at[:-1], np.diff(at)
        served_in = np.searchsorted(after, starts, side="right")
        place = base[served_in] + starts - before[served_in]
        return np.searchsorted(ends, starts, side="right"), starts, lengths, place


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    targets: Mapping[str, float] | None = None,
    window: int = WINDOW,
    min_piece: int = MIN_PIECE,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pack whole documents into windows; one row a piece (see ``PIECE_DDL``).

    ``targets`` maps sources (None for null) to wanted shares, and it is an error if none of them has a
    document. Sources with a target have queues of their own however many sources there are. Without it a source's share is its share of all
    tokens, and then every window holds the corpus' mixture to the last. A queue that runs dry
    leaves its place to the others. Null or empty texts are the end id alone; a null source is
    a queue of its own; equal rows are packed as often as they occur; an empty table gives no
    pieces; further columns are ignored.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("queue"),
    )
    wanted = {"n" if k is None else f"s{k}": v for k, v in (targets or {}).items()}
    if docs.select("queue").distinct().limit(max_queues + 1).count() > max_queues:
        named = [queue for queue, share in wanted.items() if share > 0]
        sizes = docs.groupBy("queue").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
        largest = sizes.where(~F.col("queue").isin(named)).orderBy(F.desc("size"), "queue").limit(max(max_queues - len(named), 0) // 2)
        named += [row.queue for row in largest.collect()]
        shared = F.concat(F.lit("h"), F.pmod(F.xxhash64("queue"), F.lit(max(max_queues - len(named), 1))).cast("string"))
        docs = docs.withColumn("queue", F.when(F.col("queue").isin(named), F.col("queue")).otherwise(shared))
    end = int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, queue_now, start = TaskContext.get().partitionId(), None, 0
        press = zstandard.ZstdCompressor(level=3)
        for batch in in_slices(batches):
            queues, starts, counts, ids = batch.column("queue").to_pylist(), [], [], []
            encoded = encoder(tokenizer_path).encode(batch.column("text"))
            for queue, got in zip(queues, encoded, strict=True):
                got += end
                if queue != queue_now:
                    queue_now, start = queue, 0
                starts.append(start)
                counts.append(len(got) // 4)
                start += len(got) // 4
                ids.append(press.compress(got))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part] * len(ids), pa.int32()),
                    "queue": queues,
                    "doc_id": batch.column("doc_id"),
                    "local_start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    keys = ["queue", "doc_id", F.xxhash64("text")]
    coded = stored(docs.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(encode, _IDS_DDL), "pack")

    # a row for each part and queue that meet: fewer than parts plus queues, as parts are ranges
    sums = coded.groupBy("part", "queue").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = sums.select("part", "queue", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).collect()
    totals: dict[str, int] = {}
    for row in rows:
        totals[row.queue] = totals.get(row.queue, 0) + row.n
    base = {(row.part, row.queue): row.base for row in rows}
    if wanted and totals and not any(wanted.get(queue, 0) > 0 for queue in totals):
        raise ValueError("no source of the corpus has a positive target")
    mixture = Mixture(totals, wanted, window, min_piece)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        names = [field.split()[0] for field in PIECE_DDL.split(", ")]
        for batch in in_slices(batches):
            part, queue, doc_id, local, n, frames = (batch.column(i).to_pylist() for i in range(6))
            begins = [base[k] + at for k, at in zip(zip(part, queue, strict=True), local, strict=True)]
            # runs of documents that follow each other in one queue
            heads = [i for i in range(len(n)) if not i or queue[i] != queue[i - 1] or begins[i] != begins[i - 1] + n[i - 1]]
            for lo, hi in zip(heads, [*heads[1:], len(n)], strict=True):
                begin = np.array(begins[lo:hi], "i8")
                which, starts, lengths, at = mixture.cut(
                    mixture.at[queue[lo]], int(begin[0]), begin + np.array(n[lo:hi], "i8")
                )
                starts = starts - begin[which]
                texts = [memoryview(press.decompress(f)) for f in frames[lo:hi]]
                crcs = [
                    zlib.crc32(texts[d][4 * a : 4 * (a + k)])
                    for d, a, k in zip(which.tolist(), starts.tolist(), lengths.tolist(), strict=True)
                ]
                columns = [
                    np.array(doc_id[lo:hi], object)[which], starts, lengths, crcs,
                    np.array(n[lo:hi])[which], at // window, at % window,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns] + [pa.array([queue[lo]] * len(which))], names=names
                )

    return coded.mapInArrow(place, PIECE_DDL)
