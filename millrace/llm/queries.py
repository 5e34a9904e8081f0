"""Registered queries of the corpus operators, with DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, clusters, exact, licences, lines, lm, mixing, near, pii, quality, resample, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_licence_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir)).drop("spans")


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op3_mix_sources", mixing.ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256 FROM documents""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir))


@query("op7_pii_pseudonyms")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise_documents(table(spark, sf_dir), pii.session_key(spark))


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir)).drop("text_key")


@query("op9_line_rules", lines.ORACLE_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_rules(table(spark, sf_dir)).drop("clean_text")


@query("op10_lm_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lm.score_texts(table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op11_url_filter", urls.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), urls.default_rules(spark))
    by_address = F.col("rank") > 0
    return judged.select("page_id", "host", "path", F.when(by_address, F.col("rule")).alias("rule"), "verdict", F.when(~by_address, F.col("rule")).alias("pattern"))


@query("op12_importance_resampling", resample.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_scores(table(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("row")


@query("op13_centroid_clusters", clusters.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))
