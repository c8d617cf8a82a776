"""Quality rules: counts of a text, and a hashed n-gram classifier with calibrated odds.

The classifier is a logistic regression over hashed features of whole texts: words, pairs of
adjacent words, and character n-grams within words, each counted per word of the text. It is
fitted in one Spark task on a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` a class,
those of smallest id hash); a fifth of the sample is held out to turn scores into
probabilities (Platt's method, weighted to the class shares of all labels). Scoring runs in
Arrow batches against the fixed threshold ``KEEP_FROM``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices
from tripmill.llm.words import SPACE, Words, grams

BUCKETS = 1 << 18
SAMPLE_PER_CLASS = 600
CHAR_GRAMS = (2, 3, 4)
KEEP_FROM = 0.5
EPOCHS = 60
L2 = 1e-4

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

COUNTS_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, p_good double"
)


def base_counts(texts: pa.Array, words: Words) -> dict[str, np.ndarray]:
    """Counts of the base rules for each text; null is the empty text."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype("i8")

    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    row = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    worded = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    line = coded.indices.to_numpy(zero_copy_only=False)[worded].astype("i8")
    row = row[worded]
    first = np.unique(row * max(len(coded.dictionary), 1) + line) // max(len(coded.dictionary), 1)

    code, places = grams(words.ids, words.row, 3, len(words.unique))
    gram = np.unique(code, return_inverse=True)[1]
    _, back, times = np.unique(
        words.row[places] * (gram.max(initial=0) + 1) + gram, return_inverse=True, return_counts=True
    )
    repeated = places[times[back] > 1]
    covered = np.zeros(len(words.ids), bool)
    for k in range(3):
        covered[repeated + k] = True
    return {
        "n_words": words.counts.astype("i8"),
        "word_chars": pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype("i8") - count(SPACE),
        "n_symbols": count(SYMBOLS),
        "n_dup_lines": np.bincount(row, minlength=n) - np.bincount(first, minlength=n),
        "n_repeat_words": np.bincount(words.row[covered], minlength=n),
    }


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype("i8")


def word_features(unique: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, and (word, bucket) pairs of its own and its character n-grams' features."""
    words = unique.cast(pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.array([zlib.crc32(w) | zlib.crc32(w, 0x5BD1E995) << 32 for w in words], "u8")
    owner, bucket = [np.arange(len(words))], [_mix(hashes)]
    # words between markers, one after another in one buffer
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), "u1").astype("u8")
    of = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    code = raw.copy()
    for n in range(2, max(CHAR_GRAMS) + 1):
        code = code[:-1] * np.uint64(257) + raw[n - 1 :]
        if n in CHAR_GRAMS and len(code):
            inside = of[: len(code)] == of[n - 1 :]
            owner.append(of[: len(code)][inside])
            bucket.append(_mix(code[inside] * np.uint64(131) + np.uint64(n)))
    return hashes, np.concatenate(owner), np.concatenate(bucket)


def _pair_buckets(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each pair of adjacent words."""
    at = np.flatnonzero(words.row[:-1] == words.row[1:])
    a, b = hashes[words.ids[at]], hashes[words.ids[at + 1]]
    return words.row[at], _mix(a * np.uint64(0xC2B2AE3D27D4EB4F) + b)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    slope: float
    shift: float

    def score(self, words: Words) -> np.ndarray:
        """Raw score of each text: the mean over its words of what their features weigh."""
        if not len(words.ids):
            return np.zeros(len(words.counts))
        hashes, owner, bucket = word_features(words.unique)
        each = np.bincount(owner, self.weights[bucket], len(words.unique))
        total = np.bincount(words.row, each[words.ids], len(words.counts))
        row, pair = _pair_buckets(words, hashes)
        total += np.bincount(row, self.weights[pair], len(words.counts))
        return total / np.maximum(words.counts, 1)

    def probability(self, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.score(words) + self.shift, -50, 50)))


def _descend(x_row, x_col, x_val, y, weight, dims) -> np.ndarray:
    """Logistic regression by full-batch Adam steps over a sparse matrix."""
    w, m, v, bias = np.zeros(dims), np.zeros(dims), np.zeros(dims), 0.0
    for step in range(1, EPOCHS + 1):
        z = np.bincount(x_row, x_val * w[x_col], len(y)) + bias
        off = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g = np.bincount(x_col, x_val * off[x_row], dims) + L2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= off.sum()
    return w


def fit(texts: list[str | None], good: np.ndarray, share_good: float) -> QualityModel:
    """Fit and calibrate. Without rows of both classes every text has the share of good rows."""
    flat = QualityModel(np.zeros(BUCKETS), 0.0, float(np.log(max(share_good, 1e-6) / max(1 - share_good, 1e-6))))
    held = np.arange(len(good)) % 5 == 4
    if len(set(good[~held])) < 2 or len(set(good[held])) < 2:
        return flat
    words = Words(pa.array(texts, pa.string()))
    hashes, owner, bucket = word_features(words.unique)
    # features of a word follow each other, so an occurrence expands to a slice
    order = np.argsort(owner, kind="stable")
    bucket = bucket[order]
    size = np.bincount(owner, minlength=len(words.unique))
    begin = np.cumsum(size) - size
    reps = size[words.ids]
    rows = np.repeat(words.row, reps)
    cols = bucket[np.repeat(begin[words.ids] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())]
    row2, col2 = _pair_buckets(words, hashes)
    cells, times = np.unique(np.concatenate([rows, row2]) * BUCKETS + np.concatenate([cols, col2]), return_counts=True)
    row, col = cells // BUCKETS, cells % BUCKETS
    val = times / np.maximum(words.counts, 1)[row]
    class_weight = np.where(good, 0.5 / max(good[~held].sum(), 1), 0.5 / max((~good[~held]).sum(), 1))
    use = ~held[row]
    w = _descend(row[use], col[use], val[use], good.astype(float), np.where(held, 0, class_weight), BUCKETS)
    model = QualityModel(w, 1.0, 0.0)
    z = model.score(words)[held]
    y = good[held]
    weight = np.where(y, share_good / max(y.sum(), 1), (1 - share_good) / max((~y).sum(), 1))
    # Platt's targets keep the slope finite when the classes are apart
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        off, curve = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[curve @ (z * z), curve @ z], [curve @ z, curve.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, [off @ z, off.sum()])
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return QualityModel(w, float(a), float(b))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit on labelled documents in one task; only the weights come to the driver.

    Rows of ``labels`` without an id or with another quality than 0 or 1 are left out; an id
    with both labels counts as bad. The sample is bounded, so its ids may be broadcast.
    """
    labels = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"))
    )
    count = {row.good: row["count"] for row in labels.groupBy("good").count().collect()}
    share = count.get(1, 0) / max(sum(count.values()), 1) if count else 1.0
    each = [labels.where(F.col("good") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(each[0].unionByName(each[1])), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("good").alias("good"))
        .repartition(1)
        .sortWithinPartitions("good", "doc_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, good = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            good += batch.column("good").to_pylist()
        model = fit(texts, np.array(good, bool), share)
        yield pa.RecordBatch.from_pydict(
            {
                "weights": pa.array([model.weights.astype("<f4").tobytes()], pa.binary()),
                "slope": [model.slope],
                "shift": [model.shift],
            }
        )

    rows = sample.mapInArrow(run, "weights binary, slope double, shift double").collect()
    if not rows:
        return fit([], np.zeros(0, bool), share)
    return QualityModel(np.frombuffer(bytes(rows[0].weights), "<f4").astype("f8"), rows[0].slope, rows[0].shift)


def quality_rules(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns of ``docs`` and those of ``COUNTS_DDL``, one row for each input row.

    Null and empty texts have no words and fail the base rule. Input columns that bear a
    result's name are replaced; equal rows get equal verdicts.
    """
    results = [field.split()[0] for field in COUNTS_DDL.split(", ")]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in results])
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " + COUNTS_DDL
    small = QualityModel(model.weights.astype("f4"), model.slope, model.shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column("text").cast(pa.string())
            words = Words(texts)
            found = base_counts(texts, words)
            failed = (found["n_words"] < MIN_WORDS) | (
                100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"]
            )
            p = small.probability(words)
            columns = [batch.column(name) for name in names]
            columns += [pa.array(found[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            columns += [pa.array(failed), pa.array(~failed & (p >= keep_from)), pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *results])

    return kept.mapInArrow(run, schema)
