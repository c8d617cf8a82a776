"""Queries of this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmill.llm.common import documents, ship
from tripmill.session import scratch_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    REGISTRY[query.__name__] = run
    return query


def vocabulary() -> str:
    """Path of the public vocabulary; the file is installed with the library that names it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.token_store import read_store, write_store

    path = scratch_path(spark, "llm-token-store")
    write_store(documents(spark, sf_dir), path, vocabulary(), end_id=2)
    return read_store(spark, path)


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.packing import pack

    return pack(documents(spark, sf_dir), vocabulary(), end_id=1)


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.quality import quality_rules, train

    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules(docs.select("doc_id", "text"), model).drop("text")


@register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.line_dedup import line_dedup

    return line_dedup(documents(spark, sf_dir).select("doc_id", "text"))


@register
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.decontaminate import decontaminate

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text", "spans", "near_spans", "near_items")


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.license_scan import license_scan

    return license_scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text", "passages")


@register
def license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of the licence scan: notices and complete texts inside documents, a row each."""
    from pyspark.sql import functions as F

    from tripmill.llm.license_scan import license_scan

    found = license_scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.inline("passages"))


@register
def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of decontamination: items near which a document comes, and the words of the matches."""
    from pyspark.sql import functions as F

    from tripmill.llm.decontaminate import decontaminate

    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where(F.size("near_items") > 0)
    return found.select("doc_id", "contaminated", F.array_join("near_items", ",").alias("items"), F.inline("near_spans"))


@register
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.html_extract import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


@register
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.secrets_scan import secret_scan, train

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return secret_scan(docs, train(docs)).drop("text")


@register
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.jaccard_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


@register
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(documents(spark, sf_dir).select("doc_id", "text")).drop("spans")


@register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.filter_audit import filter_audit

    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.conversation_trie import conversation_trie

    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@register
def op11_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmill.llm.warc_archive import archived

    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "llm-web-archives"))
