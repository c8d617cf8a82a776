from __future__ import annotations

import re
from collections import Counter

import pytest

from support import SF_DIR, docs, sample, sampled  # noqa: F401
from tripmill.llm.quality import quality_rules, train


def brute(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))


def test_counts_equal_brute_force(sampled, sample, model):
    texts = {r[0]: r[1] for r in sample}
    for row in quality_rules(sampled, model).collect():
        got = row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed
        assert got == brute(texts[row.doc_id]), row.doc_id
        assert not (row.kept and row.base_failed)


def test_held_out_accuracy(spark):
    """Fitted on the small table's labels, right on those of a larger one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.where("doc_id % 2 = 0")
    verdicts = quality_rules(docs, train(docs, known)).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    rows = [(r.kept, r.quality == 1) for r in verdicts.select("kept", "quality").collect()]
    assert sum(a == b for a, b in rows) / len(rows) > 0.97


def test_awkward_inputs(spark, docs, model):
    assert quality_rules(docs(), model).count() == 0
    clash = docs("a b c", None).withColumnRenamed("n_chars", "kept")
    assert quality_rules(clash, model).columns.count("kept") == 1
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    fine = " ".join(f"word{k}" for k in range(60))
    untrained = train(docs(fine), empty)
    assert [r.kept for r in quality_rules(docs(fine), untrained).collect()] == [True]
    odd = spark.createDataFrame([(None, 1, 0), (0, None, 0), (0, 7, 0)], "doc_id long, quality int, toxic int")
    assert train(docs(fine), odd).slope == untrained.slope
