"""Secret scan: patterns, and a character convolutional network over every other candidate.

Candidates are runs of 16 or more key characters with a letter and a digit that no pattern
covers. The network reads a candidate in windows with the characters around it; a long candidate
takes as many windows as it needs and its highest window counts. It learns from the labelled
findings of all documents: pattern findings, with their key words blanked in half of the texts so
that values are learned too, keys drawn at random into the places of other runs, and as negatives
all other runs of ``MIN_RUN`` or more key characters. Equal windows count once. A third of them is
held out to calibrate the score (Platt's method) and to set the threshold: the highest that still
finds ``MIN_RECALL`` of the held-out secrets. Blocks of windows are learned from in parallel and
their weights averaged after each epoch; calibration and threshold are aggregations.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, stored

MIN_RECALL = 0.98
#: Runs of key characters that are learned from; candidates are of 16 or more.
MIN_RUN = 14
#: Windows of a block, and blocks, whose weights are averaged; beyond both the blocks grow.
BLOCK_WINDOWS, MAX_BLOCKS = 20_000, 1024
#: Characters of a window: those of the candidate, and those on either side.
BODY, SIDE = 40, 24
WIDTH, FILTERS, EPOCHS = 5, 24, 8

#: Fixed values of the contract: the kinds in their order and their patterns.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: No text without one of these has a base finding.
ANY_BASE = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)

#: Classes of characters that the network tells apart.
_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "=", "_-", ".",
            "\"'`", ":", " \t", "\n\r", "@", "()[]{}<>", ",;!?")
_CODE = np.full(128, len(_CLASSES), "i8")
for _k, _members in enumerate(_CLASSES):
    _CODE[[ord(c) for c in _members]] = _k
# after the classes: other ASCII, beyond ASCII, no character, inside the candidate
_INPUTS = len(_CLASSES) + 4
_LENGTH = BODY + 2 * SIDE

SPANS_DDL = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, place of the kind, end) of the pattern findings, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(found)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Runs of key characters with a letter and a digit that meet no base finding."""
    found = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(s < b and a < e for s, _, e in base):
            found.append((a, b))
    return found


def _write(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def encode(text: str, start: int, end: int) -> list[np.ndarray]:
    """Windows of a candidate, each a row of character classes (negative inside the candidate)."""
    out = []
    for at in range(start, end, BODY):
        stop = min(at + BODY, end)
        lo, hi = max(at - SIDE, 0), min(stop + SIDE, len(text))
        points = np.array([ord(c) for c in text[lo:hi]])
        codes = np.where(points < 128, _CODE[np.minimum(points, 127)], len(_CLASSES) + 1)
        row = np.full(_LENGTH, len(_CLASSES) + 2)
        row[lo - (at - SIDE) : lo - (at - SIDE) + len(codes)] = codes
        inside = slice(SIDE, SIDE + stop - at)
        row[inside] = -1 - row[inside]
        out.append(row)
    return out


def _one_hot(rows: np.ndarray) -> np.ndarray:
    """Windows x positions x inputs."""
    inside = rows < 0
    x = np.zeros((*rows.shape, _INPUTS), "f4")
    np.put_along_axis(x, np.where(inside, -1 - rows, rows)[..., None], 1, axis=2)
    x[..., -1] = inside
    return x


def _patches(x: np.ndarray) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
    return view.transpose(0, 1, 3, 2).reshape(len(x), _LENGTH - WIDTH + 1, WIDTH * _INPUTS)


@dataclass
class SecretModel:
    """Convolution, maximum and mean over positions, logistic output, calibration, threshold."""

    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def raw(self, rows: np.ndarray) -> np.ndarray:
        got = []
        for at in range(0, len(rows), 512):
            h = np.maximum(_patches(_one_hot(rows[at : at + 512])) @ self.kernel + self.bias, 0)
            got.append(np.concatenate([h.max(1), h.mean(1), np.ones((len(h), 1), "f4")], 1) @ self.out)
        return np.concatenate(got) if got else np.zeros(0)

    def scaled(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -50, 50)))

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return self.scaled(self.raw(rows))


_SIZES = (WIDTH * _INPUTS * FILTERS, FILTERS, 2 * FILTERS + 1)


def _model(flat: np.ndarray) -> SecretModel:
    """The model whose parameters are views into ``flat``."""
    kernel, bias, out = np.split(flat, np.cumsum(_SIZES)[:-1])
    return SecretModel(kernel.reshape(-1, FILTERS), bias, out)


def _epoch(state: np.ndarray, epoch: int, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Parameters and their two moments (Adam) after one more pass over a block's windows."""
    state = state.copy()
    params, m, v = state
    model = _model(params)
    picks = np.array_split(np.random.default_rng(7 + epoch).permutation(len(y)), max(1, len(y) // 128))
    for step, pick in enumerate(picks, 1 + epoch * len(picks)):
        x = _patches(_one_hot(rows[pick]))
        z = x @ model.kernel + model.bias
        h = np.maximum(z, 0)
        f = np.concatenate([h.max(1), h.mean(1), np.ones((len(h), 1), "f4")], 1)
        off = ((1 / (1 + np.exp(-np.clip(f @ model.out, -50, 50))) - y[pick]) / len(pick)).astype("f4")
        df = off[:, None] * model.out[None, :-1]
        dh = np.repeat(df[:, None, FILTERS:] / h.shape[1], h.shape[1], 1)
        best = h.argmax(1)
        np.add.at(dh, (np.arange(len(h))[:, None], best, np.arange(FILTERS)[None]), df[:, :FILTERS])
        dz = dh * (z > 0)
        g = np.concatenate([np.tensordot(x, dz, ((0, 1), (0, 1))).ravel(), dz.sum((0, 1)), f.T @ off])
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        params -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return state


def labelled_findings(text: str, base: list[Span]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Windows of a text's secrets, drawn keys among them, and of its other long runs."""
    others = [(a, b) for a, b in (m.span() for m in RUN.finditer(text)) if not any(s < b and a < e for s, _, e in base)]
    good: list[np.ndarray] = []
    bad: list[np.ndarray] = []
    if not base and not others:
        return good, bad
    # equal texts draw alike, whichever task reads them
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))

    def placed(before: str, key: str, after: int) -> list[np.ndarray]:
        left = before[-SIDE:]
        return encode(left + key + text[after : after + SIDE], len(left), len(left) + len(key))

    for start, kind, end in base:
        at = start
        before = text[max(start - SIDE, 0) : start]
        if kind == 0:
            at = ASSIGN.match(text, start).start(2)
            blank = rng.random() < 0.5
            before += re.sub(r"[A-Za-z]+", "", text[start:at]) if blank else text[start:at]
        good += placed(before, text[at:end], end)
    for a, b in others:
        bad += encode(text, a, b)
        if rng.random() < 0.3:
            letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
            key = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(18, 48)))
            if re.search("[0-9]", key):
                good += placed(text[max(a - SIDE, 0) : a], key, b)
    return good, bad


_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")


def _findings(docs: DataFrame) -> DataFrame:
    """Each different window of all documents' labelled findings, its label, and whether it is held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column("text").cast(pa.string())
            maybe = pc.match_substring_regex(pc.fill_null(texts, ""), ANY_BASE).to_pylist()
            good: list[np.ndarray] = []
            bad: list[np.ndarray] = []
            for text, may in zip(texts.to_pylist(), maybe, strict=True):
                if text:
                    for kept, found in zip((good, bad), labelled_findings(text, base_spans(text) if may else []), strict=True):
                        kept += found
            windows = [row.astype("i1").tobytes() for row in good + bad]
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array([k < len(good) for k in range(len(windows))], pa.bool_())], names=["window", "y"]
            )

    found = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''").mapInArrow(run, "window binary, y boolean")
    different = found.groupBy("window").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("window"))
    return different.withColumn("held", F.pmod("h", F.lit(3)) == 2)


def _blocks(findings: DataFrame, windows: int) -> DataFrame:
    """The windows in blocks of some ``BLOCK_WINDOWS``, which do not depend on how rows are spread over tasks."""
    blocks = min(-(-windows // BLOCK_WINDOWS), MAX_BLOCKS)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "window"])
        packed = {"windows": [b"".join(frame["window"])], "labels": [frame["y"].to_numpy("u1").tobytes()]}
        return pd.DataFrame({"held": frame["held"].iloc[:1].to_list(), "block": frame["block"].iloc[:1].to_list(), **packed})

    placed = findings.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int"))
    return placed.groupBy("held", "block").applyInPandas(pack, "held boolean, block int, windows binary, labels binary")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, windows and labels of each block."""
    for block, windows, labels in zip(*(batch.column(c).to_pylist() for c in ("block", "windows", "labels")), strict=True):
        yield block, np.frombuffer(windows, "i1").reshape(-1, _LENGTH).astype("i8"), np.frombuffer(labels, "u1").astype(bool)


def _calibrated(model: SecretModel, scores: DataFrame, secrets: int, others: int) -> SecretModel:
    """Platt's method by Newton steps, each one aggregation, and the threshold by its rank."""
    z = F.col("z").cast("double")
    target = F.when(F.col("y"), (secrets + 1) / (secrets + 2)).otherwise(1 / (others + 2))
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), z * model.slope + model.shift))))
        off, curve = p - target, F.greatest(p * (1 - p), F.lit(1e-9))
        zz, z1, one, oz, o1 = scores.agg(
            F.sum(curve * z * z), F.sum(curve * z), F.sum(curve), F.sum(off * z), F.sum(off)
        ).first()
        step = np.clip(np.linalg.solve(np.array([[zz, z1], [z1, one]]) + 1e-6 * np.eye(2), [oz, o1]), -2, 2)
        model.slope, model.shift = float(model.slope - step[0]), float(model.shift - step[1])
        if np.abs(step).max() < 1e-6:
            break
    upwards = z if model.slope >= 0 else -z
    lowest = scores.where("y").select(upwards.alias("s")).orderBy("s").limit(int((1 - MIN_RECALL) * secrets) + 1)
    least = lowest.agg(F.max("s")).first()[0]
    model.threshold = float(model.scaled(np.array([least if model.slope >= 0 else -least], "f4"))[0])
    return model


def train(docs: DataFrame) -> SecretModel:
    """Fit on the labelled findings of all documents, block by block in parallel.

    Without secrets or without other runs to tell them from, no candidate is reported.
    """
    findings = stored(_findings(docs), "secrets-findings")
    counts = {(r.held, r.y): r["count"] for r in findings.groupBy("held", "y").count().collect()}
    if len(counts) < 4:
        return _model(np.zeros(sum(_SIZES), "f4"))
    blocks = stored(_blocks(findings, sum(n for (held, _), n in counts.items() if not held)), "secrets-blocks")
    state = np.zeros((3, sum(_SIZES)), "f4")
    state[0, : _SIZES[0]] = np.random.default_rng(7).normal(0, 0.15, _SIZES[0])
    for epoch in range(EPOCHS):

        def run(batches: Iterator[pa.RecordBatch], state: np.ndarray = state, epoch: int = epoch) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, rows, y in _rows(batch):
                    after = _epoch(state, epoch, rows, y).tobytes()
                    yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "n": [len(y)], "state": [after]})

        after = sorted(blocks.where("not held").mapInArrow(run, "block int, n long, state binary").collect())
        parts = np.array([np.frombuffer(bytes(r.state), "f4") for r in after])
        state = np.average(parts, axis=0, weights=[r.n for r in after]).astype("f4").reshape(3, -1)
    model = _model(state[0])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, y in _rows(batch):
                yield pa.RecordBatch.from_pydict({"z": pa.array(model.raw(rows).astype("f4")), "y": pa.array(y)})

    scores = stored(blocks.where("held").mapInArrow(score, "z float, y boolean"), "secrets-scores")
    return _calibrated(model, scores, counts[True, True], counts[True, False])


def scan_texts(texts: list[str | None], maybe: list[bool], model: SecretModel) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; ``maybe``: whether it can have base findings."""
    bases = [base_spans(t) if t and m else [] for t, m in zip(texts, maybe, strict=True)]
    found = [candidates(t, b) if t else [] for t, b in zip(texts, bases, strict=True)]
    windows: list[np.ndarray] = []
    of: list[tuple[int, int, int]] = []
    extra: dict[int, set[tuple[int, int]]] = {}

    def score() -> None:
        if windows:
            for (i, a, b), p in zip(of, model.probability(np.array(windows)), strict=True):
                if p >= model.threshold:
                    extra.setdefault(i, set()).add((a, b))
        windows.clear()
        of.clear()

    for i, (text, spans) in enumerate(zip(texts, found, strict=True)):
        for a, b in spans:
            # windows of one candidate at a time, however long it is
            for row in encode(text, a, b):
                windows.append(row)
                of.append((i, a, b))
                if len(windows) >= 4096:
                    score()
    score()
    return [(base, sorted([*base, *((a, 3, b) for a, b in extra.get(i, ()))])) for i, base in enumerate(bases)]


def secret_scan(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``docs`` with the columns of ``SPANS_DDL``, one row for each input row.

    Places are code points, ends exclusive. Null and empty texts have none; equal texts get equal
    results; input columns with a result's name are replaced, others pass through.
    """
    results = [field.split()[0] for field in SPANS_DDL.split(", ")]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in results])
    names = kept.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " + SPANS_DDL

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column("text").cast(pa.string())
            maybe = pc.match_substring_regex(pc.fill_null(texts, ""), ANY_BASE).to_pylist()
            got = scan_texts(texts.to_pylist(), maybe, model)
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in got], pa.int64()) for k in range(3)]
            sha = pa.array([hashlib.sha256(_write(base).encode()).hexdigest() for base, _ in got], pa.string())
            spans = pa.array([_write(every) for _, every in got], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [*counts, sha, spans], names=[*names, *results])

    return kept.mapInArrow(run, schema)
