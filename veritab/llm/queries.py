"""The registered queries of the subpackage: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import (
    compression_quality, decontamination, exact_dedup, html_text, line_dedup, packing, quality_rules, simhash,
    token_output, toxicity, url_reputation, vector_codes, whitening,
)


def vocabulary() -> str:
    """The public vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url``, ``good`` of the pages whose document is labelled: a page's path
    ends in the number of the document it shows."""
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), r"/(\d{1,18})(?:\.html|/)?\z", 1)
    shown = pages.select("url", F.nullif(number, F.lit("")).cast("bigint").alias("doc_id"))
    good = labels.groupBy("doc_id").agg((F.min("quality") * (1 - F.max("toxic"))).cast("int").alias("good"))
    return shown.join(good, "doc_id").select("url", "good")


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_reputation.judge(pages, page_outcomes(pages, _table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=("n_lines", "n_deleted"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(_table(spark, sf_dir, "documents"), vocabulary())


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_best_fit_packing, op3_compression_quality, op4_decontamination, op5_simhash, op6_quality_rules,
    op7_url_reputation, op8_line_dedup, op9_html_text, op10_token_output, op11_exact_dedup, op12_whitening,
    op13_vector_codes,
)}
