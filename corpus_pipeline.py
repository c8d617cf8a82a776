"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

All stages but the last return the columns of ``documents``. Documents are told apart by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import ship
from tripmill.llm.decontaminate import decontaminate
from tripmill.llm.jaccard_join import one_of_each
from tripmill.llm.line_dedup import line_dedup
from tripmill.llm.packing import pack
from tripmill.llm.quality import quality_rules, train
from tripmill.llm.queries import vocabulary
from tripmill.session import scratch_path


def _as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{name}`") for name in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier; the others go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _as_documents(quality_rules(docs, model).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of three-line windows; n_chars follows the text."""
    found = line_dedup(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return _as_documents(found, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _as_documents(found.where(~F.col("contaminated")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens that hold the sources in their shares of the kept corpus."""
    return pack(docs, vocabulary(), end_id=1)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Tokens and a trained classifier cannot be had in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
