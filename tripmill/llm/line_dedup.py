"""Line deduplication by overlapping windows of three consecutive lines.

Every window of three lines is hashed; windows that occur again anywhere are found by one
aggregation over hashes; the first occurrence (smallest doc_id, then the text's hash, then the
position) stays, and lines that any later occurrence covers go. Overlapping windows merge, so a
long repeated passage goes from end to end while its neighbours stay. Only hashes, ids and
positions are shuffled to find repeats; a hash has 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, stored

WINDOW_LINES = 3

_PLACES_DDL = "_d {kind}, _k string, _t long, h1 long, h2 long, pos int"


def _places(docs: DataFrame, size: int) -> DataFrame:
    """A row for each window: its document, hash and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows, hashes, places = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                if text is None or text.count("\n") < size - 1:
                    continue
                each = [xxhash.xxh3_128_digest(line) for line in text.split("\n")]
                count = len(each) - size + 1
                hashes += [xxhash.xxh3_128_digest(b"".join(each[i : i + size])) for i in range(count)]
                rows += [row] * count
                places += range(count)
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(rows), [None, pa.py_buffer(b"".join(hashes))])
            of = pa.array(rows, pa.int64())
            even = pa.array(range(0, 2 * len(rows), 2), pa.int64())
            odd = pa.array(range(1, 2 * len(rows), 2), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(of) for c in ("_d", "_k", "_t")]
                + [halves.take(even), halves.take(odd), pa.array(places, pa.int32())],
                names=["_d", "_k", "_t", "h1", "h2", "pos"],
            )

    kind = docs.schema["_d"].dataType.simpleString()
    return docs.select("_d", "_k", "_t", "text").mapInArrow(run, _PLACES_DDL.format(kind=kind))


def line_dedup(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with ``text`` less its later repeats, and ``n_lines`` and ``n_removed``.

    Lines are split at \\n and compared as they are, empty ones too. A text of fewer than
    ``size`` lines has no window and stays. A null text stays null with 0 lines. Rows equal in
    doc_id and text are one document and share its verdict; rows equal in doc_id alone are
    documents of their own. If all lines go, the text is empty. Other columns pass through;
    input columns named n_lines or n_removed are replaced.
    """
    base = docs.drop("n_lines", "n_removed").withColumn("text", F.col("text").cast("string"))
    keyed = base.withColumns(
        {"_d": F.col("doc_id"), "_k": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "_t": F.xxhash64("text")}
    )
    places = stored(_places(keyed, size), "line-windows")
    place = F.struct("_d", "_k", "_t", "pos")
    first = (
        places.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("h1", "h2", "first")
    )
    later = (
        places.join(first, ["h1", "h2"])
        .where(place != F.col("first"))
        .groupBy("_k", "_t")
        .agg(F.collect_set("pos").alias("_later"))
    )
    names = base.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts, n_lines, n_removed = [], [], []
            for text, later in zip(batch.column("text").to_pylist(), batch.column("_later").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                gone = {at + k for at in later or () for k in range(size)}
                texts.append("\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else text)
                n_lines.append(len(lines))
                n_removed.append(len(gone))
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                names=[*names, "n_lines", "n_removed"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return (
        keyed.drop("_d").join(later, ["_k", "_t"], "left").select(*[F.col(f"`{c}`") for c in names], "_later")
        .mapInArrow(cut, f"{schema}, n_lines long, n_removed long")
    )
