"""Audit of quality filters that overlap: what each removes, alone, in any order, and on average.

Texts are read once, by a table-driven transducer over their UTF-8 bytes. A byte belongs to one of
a few classes; the transducer is between words or inside one, and its state and class together
give what is emitted: a code point, a capital, a symbol, the start or the end of a word. Its state
after a byte depends on that byte alone, so the tables are applied to a whole batch of texts at
once. The word spans go into an open-addressing hash table, where a span counts as seen only if its
bytes equal those of the span that owns the place.

Each document becomes a set of failed filters. All that follows is counts of such sets for each
part, so the 120 orders cost nothing that grows with the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, skewed_join, stored
from tripmill.llm.spans import firsts, hashes, in_eights, utf8

#: Fixed values of the contract: white space, symbols, the filters and their limits.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2

PLAIN, CONTINUED, SPACED, CAPITAL, SYMBOL = range(5)
BETWEEN, INSIDE = range(2)
EMIT_POINT, EMIT_CAPITAL, EMIT_SYMBOL, EMIT_START, EMIT_END = (1 << k for k in range(5))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte, state after each class, and what each state and class emit."""
    classes = np.full(256, PLAIN, "u1")
    classes[0x80:0xC0] = CONTINUED
    classes[list(SPACE)] = SPACED
    classes[ord("A") : ord("Z") + 1] = CAPITAL
    classes[list(SYMBOLS)] = SYMBOL
    after = np.full(5, INSIDE, "u1")
    after[SPACED] = BETWEEN
    emits = np.zeros((2, 5), "u1")
    emits[:, [PLAIN, SPACED, CAPITAL, SYMBOL]] |= EMIT_POINT
    emits[:, CAPITAL] |= EMIT_CAPITAL
    emits[:, SYMBOL] |= EMIT_SYMBOL
    emits[BETWEEN, [PLAIN, CONTINUED, CAPITAL, SYMBOL]] |= EMIT_START
    emits[INSIDE, SPACED] |= EMIT_END
    return classes, after, emits


CLASSES, AFTER, EMITS = _tables()


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each text; null is empty."""
    data, limits = utf8(texts)
    begin, end = limits[:-1], limits[1:]
    filled = end > begin
    classes = CLASSES[data]
    after = AFTER[classes]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[begin[filled]] = BETWEEN
    emitted = EMITS[before, classes]

    def count(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, limits))

    def where(bit: int) -> np.ndarray:
        return np.flatnonzero(emitted & bit)

    starts = where(EMIT_START)
    last = end[filled]
    ends = np.sort(np.concatenate([where(EMIT_END), last[after[last - 1] == INSIDE]]))
    n_words = count(starts)
    rows = np.repeat(np.arange(len(texts)), n_words)
    eights, lengths = in_eights(data), ends - starts
    own = firsts(eights, starts, lengths, hashes(eights, starts, lengths, rows), rows)
    return {
        "n_words": n_words,
        "n_distinct": np.bincount(rows[own], minlength=len(texts)),
        "n_capitals": count(where(EMIT_CAPITAL)),
        "n_chars": count(where(EMIT_POINT)),
        "n_symbols": count(where(EMIT_SYMBOL)),
    }


def failed(found: dict[str, np.ndarray]) -> np.ndarray:
    """Failed filters A to D of each text as bits 0 to 3."""
    bits = [
        found["n_words"] < MIN_WORDS,
        100 * found["n_distinct"] < MIN_DISTINCT_PERCENT * found["n_words"],
        100 * found["n_capitals"] > MAX_CAPITAL_PERCENT * found["n_chars"],
        found["n_symbols"] > 0,
    ]
    return sum(bit.astype("i4") << k for k, bit in enumerate(bits))


_FACTS = "doc_id long, part string, n_words long, n_distinct long, n_capitals long, n_chars long, n_symbols long, fails int, digest binary"


def facts(docs: DataFrame) -> DataFrame:
    """A row for each document: its measures, its failed filters but E, and the SHA-256 of its text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.string())]
        + [(n, pa.int64()) for n in ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")]
        + [("fails", pa.int32()), ("digest", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column("text")
            found = measure(texts)
            digests = [hashlib.sha256((t or "").encode()).digest() for t in texts.to_pylist()]
            columns = [batch.column("doc_id"), batch.column("part"), *found.values(), failed(found), digests]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(run, _FACTS)


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, n_good, n_toxic): how many documents fail exactly the filters of ``fails``.

    Filter E compares texts by SHA-256 over the whole table. Copies are counted by text and part
    before they meet, so a text that a third of all documents share is a few rows by then.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    each = facts(docs).select("doc_id", "part", "fails", "digest").join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    kind = ["digest", "fails", "part", "good", "toxic"]
    copies = stored(
        each.groupBy(*kind, "doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*kind)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("n_named"),
            F.min("doc_id").alias("least"),
            F.min_by("n", "doc_id").alias("n_least"),
        ),
        "audit-copies",
    )
    firsts = stored(copies.groupBy("digest").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("rows")), "audit-firsts")
    told = skewed_join(copies, firsts, ["digest"], "rows", copies.count())
    # a document without an id is neither before nor behind another
    behind = F.col("n_named") - F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    e = 1 << FILTERS.index("E")
    split = told.withColumn("behind", behind).select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct((F.col("n") - F.col("behind")).alias("n"), F.col("fails").alias("fails")),
                F.struct(F.col("behind").alias("n"), (F.col("fails") + e).alias("fails")),
            )
        ),
    )
    return split.groupBy("part", "fails").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, filter order and step; see the columns below.

    ``docs`` has doc_id, source and text, ``labels`` doc_id, quality and toxic; other columns are not
    read. part: the source, null as the empty string. filter_order: one of the 120 orders of A to E;
    step: 1 to 5, its filter is that letter. Long counts within the part: kept (after the step),
    removed (by it), redundant (fail the filter but were removed before), unique_fails (fail this filter
    only), good_lost and toxic_lost (removed here and labelled so), shapley (documents that the filter
    removes, summed over all orders). Null texts are empty; an empty text fails A, and E if a smaller id
    has one. Repeated rows of one id are not copies of each other; a null id is never a copy and makes
    none. A document with several labels is good or toxic if one of them says so. Empty documents give
    no rows.
    """
    sets = failure_sets(docs, labels)
    measures = ("n", "n_good", "n_toxic")
    by_part = sets.groupBy("part").agg(
        F.collect_list(F.struct("fails", *measures)).alias("sets")  # 32 at most
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = by_part.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        """Filters of a string of letters as one number."""
        return F.aggregate(
            F.filter(F.split(letters, ""), lambda x: x != ""),
            F.lit(0),
            lambda sum_, x: sum_ + F.element_at(F.create_map(*[F.lit(v) for k, f in enumerate(FILTERS) for v in (f, 1 << k)]), x),
        )

    steps = steps.select(
        "*",
        F.inline(
            F.array(
                F.struct(
                    bits(F.expr("substring(filter_order, 1, step - 1)")).alias("earlier"),
                    bits(F.expr("substring(filter_order, step, 1)")).alias("own"),
                )
            )
        ),
    )

    def total(condition, value=lambda s: s["n"]) -> Column:
        return F.aggregate(
            F.filter("sets", condition), F.lit(0).cast("long"), lambda sum_, s: sum_ + value(s)
        )

    own, earlier = F.col("own"), F.col("earlier")

    def removed(s: Column) -> Column:
        return (s["fails"].bitwiseAND(own) != 0) & (s["fails"].bitwiseAND(earlier) == 0)

    # of the 120 orders a given one of k filters comes before the other k - 1 in one of k
    shares = F.array(*[F.lit(120 // k) for k in range(1, len(FILTERS) + 1)])
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total(lambda s: s["fails"].bitwiseAND(own + earlier) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda s: (s["fails"].bitwiseAND(own) != 0) & (s["fails"].bitwiseAND(earlier) != 0)).alias("redundant"),
        total(lambda s: s["fails"] == own).alias("unique_fails"),
        total(removed, lambda s: s["n_good"]).alias("good_lost"),
        total(removed, lambda s: s["n_toxic"]).alias("toxic_lost"),
        total(
            lambda s: s["fails"].bitwiseAND(own) != 0,
            lambda s: s["n"] * F.element_at(shares, F.bit_count(s["fails"])),
        ).alias("shapley"),
    )
