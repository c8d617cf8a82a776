"""Small documents with every awkward case, and fixtures over the session of the other tests."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

import pytest
from pyspark.sql import DataFrame

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

from tripmill.llm.common import ship  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark) -> Callable[..., DataFrame]:
    """Documents 0, 1, ... of the given texts, or of (doc_id, text) pairs."""

    ship(spark)

    def build(*texts) -> DataFrame:
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, None, f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def sample(spark) -> list[tuple]:
    """The smallest test documents, whole, with awkward rows added."""
    ship(spark)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    texts = [
        None, "", " ", "\n\n\n", "a", "one two three four", "x" * 5000, "=é中\U0001f600 b c " * 30,
        "row of words\n" * 40, rows[3][1], rows[3][1] + " and a little more", "  two  spaces \t\r\n tab ",
    ]
    last = max(r[0] for r in rows)
    rows += [(last + 1 + k, t, None, None, None) for k, t in enumerate(texts)]
    return rows


@pytest.fixture
def sampled(spark, sample) -> DataFrame:
    return spark.createDataFrame(sample, SCHEMA).repartition(3)
