"""Corpus pipeline: quality, repeated lines, near duplicates, benchmark leaks, packing.

``STAGES`` lists the stages in order.  A stage takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``; all but the last return the columns of ``documents``.
``run(spark, sf_dir)`` applies them to the table ``documents``.

Texts of any length are taken whole in every stage; columns beside those of
``documents`` pass through all stages but the last.

SQL cannot express the first stage (a compression model) and the last (token
ids); the stages are tested against plain versions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import compression_quality, decontamination, line_dedup, packing, simhash
from veritab.llm.common import written
from veritab.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject.

    A null or empty text is scored like any other, repeated rows alike; without labels
    of both classes all rows have one score; an empty table stays empty.
    """
    return compression_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a text may become empty.

    A null text stays null with its ``n_chars``; rows of equal id and text keep the same
    lines; an empty table stays empty.
    """
    shorter = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return shorter
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return shorter.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id, then the smallest text hash.

    Texts without a word have one fingerprint and are one group; of fully equal rows one
    stays; a null id comes last; an empty table stays empty.
    """
    return simhash.one_of_each_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go.

    A null or empty text has none and stays, as do all rows without benchmark items; an empty table stays empty.
    """
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences.

    A null or empty text is one piece of one id; repeated rows are placed each; an empty table gives no rows.
    """
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("line_repeats", line_repeats),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL for run()'s rows: none, see above
ORACLE_SQL = None
