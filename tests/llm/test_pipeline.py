from __future__ import annotations

import pytest

from support import SF_DIR  # noqa: F401
import __spark_entry__ as contract
import corpus_pipeline
from test_jaccard import brute as brute_groups
from tripmill.llm.oracles import ORACLES
from tripmill.llm.queries import REGISTRY


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert set(REGISTRY) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY if n.startswith("op")) == list(range(1, 14))
    assert set(ORACLES) <= names


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF_DIR).write.parquet(path)
        made = spark.read.parquet(path)
        out[name] = docs, made
        docs = made
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.dtypes == before.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)


def test_quality_keeps_good_documents(spark, stages):
    before, after = stages["quality rules"]
    kept = texts(after)
    assert kept.items() <= texts(before).items()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    long_enough = [i for i, t in texts(before).items() if len((t or "").split()) >= 50 and labels.get(i) == 1]
    assert sum(i in kept for i in long_enough) >= 0.95 * len(long_enough)
    assert not any(labels.get(i) == 0 for i in kept)


def test_one_of_each_group_stays(stages):
    before, after = stages["n-gram Jaccard join"]
    groups = brute_groups(list(texts(before).items()))
    assert set(texts(after)) == {i for i, (_, least) in groups.items() if i == least}


def test_line_dedup_keeps_all_documents(stages):
    before, after = stages["line dedup"]
    assert set(texts(after)) == set(texts(before))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_contaminated_documents_go(spark, stages):
    before, after = stages["benchmark decontamination"]
    assert texts(after).items() <= texts(before).items()
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    fresh = before.limit(0).unionByName(spark.createDataFrame([(1, item, None, None, 0), (2, "clean text", None, None, 0)], before.schema))
    assert set(texts(corpus_pipeline.decontamination(spark, fresh, SF_DIR))) == {2}


def test_packing_holds_every_document(stages):
    before, after = stages["packing"]
    pieces = after.collect()
    assert {r.doc_id for r in pieces} == set(texts(before))
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
