"""Token files: one zstandard frame a document, a shared dictionary and an offset index.

A store is a folder of Parquet files that Spark's committer writes, so that lost executors
leave no half files and any file system that Spark knows will do:

* ``dictionary``: one row, the dictionary's bytes and their SHA-256;
* ``blocks``: about ``BLOCK_BYTES`` of frames a row in ``payload``, and beside it the index
  of the block: for each document its id, the frame's place and size, and its token count.
  A reader of a few documents prunes row groups by ``first_id`` and ``last_id``, reads the
  index columns alone, and decompresses one frame.

Blocks lie in ascending doc_id order (null first; equal ids by a hash of the text).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices
from tripmill.llm.tokens import encoder

BLOCK_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
#: Documents that the dictionary is trained on, and ids taken of each. It only affects size.
SAMPLE_DOCUMENTS = 512
SAMPLE_IDS = 2048
LEVEL = 3

_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("dictionary_sha256", pa.string()),
        ("total", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int32())),
        ("sizes", pa.list_(pa.int32())),
        ("n_tokens", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "part int, block int, first_id long, last_id long, dictionary_sha256 string, total long, "
    "doc_ids array<long>, offsets array<int>, sizes array<int>, n_tokens array<long>, payload binary"
)


def _narrow(ids: bytes) -> bytes:
    """Ids as they are serialized: 16 bits each where all fit, marked by the first byte."""
    wide = np.frombuffer(ids, "<u4")
    return b"\x02" + wide.astype("<u2").tobytes() if not wide.size or wide.max() < 1 << 16 else b"\x04" + ids


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype("<u4")


def train_dictionary(docs: DataFrame, tokenizer_path: str) -> bytes:
    """Dictionary from the ids of a bounded sample of documents (those of smallest id hash).

    Empty when the sample is too small to train on; frames then stand alone.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in b.column("text").to_pylist() if t]
        samples = [_narrow(ids[: 4 * SAMPLE_IDS]) for ids in encoder(tokenizer_path).encode(texts)]
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    # a bound on the hash from the number of rows lets about twice the sample reach the sort
    share = min(1.0, 2 * SAMPLE_DOCUMENTS / max(docs.count(), 1))
    sample = (
        docs.select("text", F.xxhash64(F.col("doc_id"), F.col("text")).alias("_h"))
        .where(F.pmod("_h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
        .orderBy("_h")
        .limit(SAMPLE_DOCUMENTS)
        .select("text")
        .coalesce(1)
    )
    rows = sample.mapInArrow(train, "dictionary binary").collect()
    return bytes(rows[0][0]) if rows else b""


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode whole texts, append ``end_id`` to each document, and write the files.

    Null and empty texts hold the end id alone. Repeated rows are kept as rows of their own,
    columns other than doc_id and text are ignored, an empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trained = train_dictionary(docs, tokenizer_path)
    sha = hashlib.sha256(trained).hexdigest()
    end = int(end_id).to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
        part, block = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(f) for f in frames], "i4")
            return pa.RecordBatch.from_pydict(
                {
                    "part": [part],
                    "block": [block],
                    "first_id": [ids[0]],
                    "last_id": [ids[-1]],
                    "dictionary_sha256": [sha],
                    "total": [sum(counts)],
                    "doc_ids": [ids],
                    "offsets": [(np.cumsum(sizes) - sizes).tolist()],
                    "sizes": [sizes.tolist()],
                    "n_tokens": [counts],
                    "payload": [b"".join(frames)],
                },
                schema=_BLOCK_SCHEMA,
            )

        for batch in in_slices(batches):
            # slices share the encoder's calls; only frames are kept
            for doc_id, got in zip(
                batch.column("doc_id").to_pylist(),
                encoder(tokenizer_path).encode(batch.column("text")),
                strict=True,
            ):
                got += end
                frame = press.compress(_narrow(got))
                ids.append(doc_id)
                frames.append(frame)
                counts.append(len(got) // 4)
                held += len(frame)
                if held >= BLOCK_BYTES:
                    yield flush()
                    ids, frames, counts, held, block = [], [], [], 0, block + 1
        if ids:
            yield flush()

    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    spark.createDataFrame([(sha, bytearray(trained))], "sha256 string, dictionary binary").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")
    ordered.mapInArrow(write, _BLOCK_DDL).write.parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.schema("sha256 string, dictionary binary").parquet(f"{path}/dictionary").first()
    return row[0], bytes(row[1])


def _opener(sha: str, trained: bytes):
    """Function from a block's dictionary hash to a decompressor; a wrong hash is an error."""
    if hashlib.sha256(trained).hexdigest() != sha:
        raise ValueError("the store's dictionary is damaged")

    def open_(block_sha: str) -> zstandard.ZstdDecompressor:
        if block_sha != sha:
            raise ValueError("a block was written with another dictionary")
        return zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(trained) if trained else None
        )

    return open_


def blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """Tokens before each block, from the index columns alone.

    Totals are summed to one row a file first, so the one unpartitioned window reads as many
    rows as there are files, and the window over blocks works within a file.
    """
    index = blocks(spark, path).select("part", "block", "total")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("total").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_part_start")
    )
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(parts, "part").select(
        "part",
        "block",
        (F.col("_part_start") + F.coalesce(F.sum("total").over(within), F.lit(0))).alias("block_start"),
    )


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32."""
    open_ = _opener(*_dictionary(spark, path))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                press = open_(one["dictionary_sha256"].as_py())
                payload = memoryview(one["payload"].as_buffer())
                counts = np.array(one["n_tokens"].as_py(), "i8")
                crcs = []
                for at, size, n in zip(one["offsets"].as_py(), one["sizes"].as_py(), counts, strict=True):
                    ids = _wide(press.decompress(payload[at : at + size]))
                    if len(ids) != n:
                        raise ValueError("a frame and its index differ")
                    crcs.append(zlib.crc32(ids.tobytes()))
                k = len(counts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([one["part"].as_py()] * k, pa.int32()),
                        "block": pa.array([one["block"].as_py()] * k, pa.int32()),
                        "doc_id": pa.array(one["doc_ids"].as_py(), pa.int64()),
                        "local_start": pa.array(np.cumsum(counts) - counts, pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    decoded = blocks(spark, path).drop("first_id", "last_id", "total").mapInArrow(
        read, "part int, block int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(block_starts(spark, path), ["part", "block"]).select(
        "doc_id",
        (F.col("block_start") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def fetch(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of one document (of each row that has this id), by the offset index."""
    open_ = _opener(*_dictionary(spark, path))
    found = blocks(spark, path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    place = F.explode(F.arrays_zip("doc_ids", "offsets", "sizes")).alias("at")
    rows = (
        found.select("part", "block", "dictionary_sha256", place, "payload")
        .where(F.col("at.doc_ids") == doc_id)
        .select(
            "part", "block", "at.offsets", "dictionary_sha256",
            F.expr("substring(payload, at.offsets + 1, at.sizes)").alias("frame"),
        )
        .orderBy("part", "block", "offsets")
        .collect()
    )
    return [_wide(open_(r.dictionary_sha256).decompress(bytes(r.frame))).tolist() for r in rows]
