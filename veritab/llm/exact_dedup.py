"""Exact deduplication against a persistent digest index (operator 11).

The index is a table of the SHA-256 digests of all texts that were kept so
far, bucketed and sorted by digest, with the id of the row that was kept.  A
batch of new documents is reduced to its distinct digests, which meet the
index in a sort-merge anti-join by bucket (the index itself never moves), and
the digests that are new are appended.  Texts are equal when they are
identical after every run of white space became one space; equality is decided
by the SHA-256 digest of that text.

Within a batch the smallest id of equal texts stays; a text that the index
knows already stays with the row that brought it.  So batches in ascending
order of ids keep the smallest id of all.  A batch that is added again (a run
that was cut off) appends only what is missing and gives the same answer.

Copies are merged before anything is compared: a digest that a third of the
rows share is one row per task.  Totals go back to the rows by a broadcast for
the groups above a size of which there can only be ``HOT_GROUPS``, and by a
join on the digest for the others.

Defined results: null text counts as empty; texts of any length are read
whole; a null id counts as larger than all others; of repeated rows (equal id
and text) one stays, and each counts in the group's size; an empty table gives
no rows and leaves the index as it is; columns beside id and text are not read
by the report, and :func:`new_documents` passes them on under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritab.llm.common import attach_totals, scratch_path, text_or_empty, written
from veritab.session import ANTI_JOIN_RULE, EXCLUDED_RULES

#: digests in one bucket, about (40 bytes each); sets the number of buckets of a new index
BUCKET_ROWS = 1_000_000
#: a small index still spreads over this many tasks
FEWEST_BUCKETS = 16


def normalised(text_col: str = "text") -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")


@contextmanager
def merged_first(spark: SparkSession) -> Iterator[None]:
    """Jobs inside merge a batch's digests before these meet the index, however small it is, in any session."""
    before = spark.conf.get(EXCLUDED_RULES, None)
    if ANTI_JOIN_RULE in (before or ""):
        yield
        return
    spark.conf.set(EXCLUDED_RULES, f"{before},{ANTI_JOIN_RULE}" if before else ANTI_JOIN_RULE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(EXCLUDED_RULES)
        else:
            spark.conf.set(EXCLUDED_RULES, before)


class DigestIndex:
    """A folder with two tables: ``digests`` (``digest binary, keep_id``), bucketed
    and sorted by digest, and ``settings`` (its number of buckets)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str) -> None:
        self.spark, self.path, self.buckets, self.id_type = spark, path, buckets, id_type
        self.name = "veritab_digests_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/digests'")
        spark.catalog.refreshTable(self.name)  # files that another session appended

    @classmethod
    def create(cls, spark: SparkSession, path: str, expected_rows: int, id_type: str = "bigint") -> DigestIndex:
        """A new, empty index with buckets for about ``expected_rows`` digests."""
        buckets = max(FEWEST_BUCKETS, -(-expected_rows // BUCKET_ROWS))
        index = cls(spark, path, buckets, id_type)
        spark.createDataFrame([(buckets, id_type)], "buckets int, id_type string").coalesce(1) \
            .write.parquet(f"{path}/settings")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """An index that an earlier run wrote."""
        settings = spark.read.parquet(f"{path}/settings").first()
        return cls(spark, path, settings["buckets"], settings["id_type"])

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the digests that are new and return the batch's documents:
        ``digest``, ``doc_id``, ``copies`` (repeated rows), as a written table."""
        one = docs.select(F.col(id_col).cast(self.id_type).alias("doc_id"),
                          F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"))
        # by digest and id: rows of a frequent text spread by their ids
        rows = written(one.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies")), "digests")
        with merged_first(self.spark):
            self.new_digests(rows).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return rows

    def new_digests(self, rows: DataFrame) -> DataFrame:
        """The digests of ``rows`` that the index lacks, with the smallest id of each."""
        firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        return (firsts.repartition(self.buckets, "digest")
                .join(self.table().select("digest").hint("merge"), "digest", "left_anti").select("digest", "keep_id"))

    def groups(self, rows: DataFrame) -> DataFrame:
        """One row per distinct text of ``rows``: ``digest``, ``keep_id``, ``group_size``."""
        sizes = rows.groupBy("digest").agg(F.sum("copies").alias("group_size"))
        return sizes.repartition(self.buckets, "digest").join(self.table().hint("merge"), "digest")

    def report(self, rows: DataFrame) -> DataFrame:
        """One row per document of ``rows`` (of one or more batches): ``doc_id``,
        ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
        found = attach_totals(rows, written(self.groups(rows), "groups"), "digest", "group_size")
        stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
        return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
                .select("doc_id", "keep_id", "group_size", stays.alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256")))


def new_documents(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add a batch to the index and return its documents that stay, with all their columns."""
    kept = index.report(index.add(docs, id_col, text_col)).where("kept")
    kept = kept.select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"))
    keyed = docs.withColumn("__own", F.unhex(F.sha2(normalised(text_col), 256)))
    same = F.col("__own") == F.col("__digest")
    same &= keyed[id_col].cast(index.id_type).eqNullSafe(F.col("__id"))
    # repeated rows of a document that stays: one of them
    one = Window.partitionBy("__digest", "__id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    chosen = keyed.join(kept, same).withColumn("__n", F.row_number().over(one)).where("__n = 1")
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])


def batches_by_id(docs: DataFrame, id_col: str = "doc_id") -> list[DataFrame]:
    """The table in two batches of ascending ids (null ids come last)."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    if low is None or low == high:
        return [docs]
    middle = low + (high - low) // 2
    return [docs.where(F.col(id_col) <= middle), docs.where((F.col(id_col) > middle) | F.col(id_col).isNull())]


def deduplicate(docs: DataFrame, index: DigestIndex | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add all documents (ids are whole numbers), smaller ids first, and report on each of them.
    Without an index a new one is made."""
    spark = docs.sparkSession
    if index is None:
        index = DigestIndex.create(spark, scratch_path(spark, "digest-index"), docs.count())
    rows = [index.add(batch, id_col, text_col) for batch in batches_by_id(docs, id_col)]
    return index.report(reduce(DataFrame.unionAll, rows))
