"""All checks of a table from one read of it.

A source without column pruning (CSV, JSON, JDBC) is read again by every
pass over it.  Here each row is expanded into what the checks want counted: an item
(tag, key) per broken rule, per key, per tested value, per group.  One grouped
count of the items, merged per task before its only exchange, holds the answer of
every check; it is written once (``checkpoint``), and the verdicts are read from it.
A count by exchange is exact when tasks are repeated after a lost executor,
which metrics observed on the side are not.

Cell bounds need the number of rows, which only the end of the scan knows: the row
numbers of cells are counted per value, and compared afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DoubleType, FloatType

from veritab.functions.names import col
from veritab.session import ensure_checkpoint_dir

ROWS, KEY, CELL, CELL_ROW, GROUP, GROUP_PREFIX = "rows", "key", "cell", "cell_row", "group", "group_prefix"


def _text(value: Column, kind: DataType) -> Column:
    """Text that is equal exactly for values that a grouping holds equal."""
    if isinstance(kind, (FloatType, DoubleType)):
        value = value + F.lit(0.0).cast(kind)  # -0.0 is 0.0
    return F.hex(value) if isinstance(kind, BinaryType) else value.cast("string")


def joint_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """One text for the values of several columns, nulls told apart from texts."""
    kinds = df.select(*[col(c) for c in columns]).schema
    parts = []
    for c, field in zip(columns, kinds):
        value = _text(col(c), field.dataType)
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(F.lit(""), *parts)


class Items:
    """What is counted of each row."""

    def __init__(self) -> None:
        self.entries: list[Column] = []

    def add(self, tag: str, key: Column | None = None, when: Column | None = None) -> None:
        item = F.struct(F.lit(tag).alias("tag"), (F.lit(None) if key is None else key).cast("string").alias("key"))
        self.entries.append(item if when is None else F.when(when, item))

    def exploded(self, df: DataFrame, *others: str) -> DataFrame:
        """The items of all rows: ``tag``, ``key``, and the columns named."""
        items = df.select(*others, F.explode(F.array(*self.entries)).alias("item")).where("item is not null")
        return items.select(*others, "item.tag", "item.key")

    def counted(self, df: DataFrame) -> Counts:
        """Count the items in one scan."""
        return self.kept(self.exploded(df).groupBy("tag", "key").agg(F.count(F.lit(1)).alias("n")))

    @staticmethod
    def kept(counts: DataFrame) -> Counts:
        """Counted items, written once.  Keys that occur once answer no check and are not kept."""
        ensure_checkpoint_dir(counts.sparkSession)
        return Counts(counts.where((F.col("tag") != KEY) | (F.col("n") > 1)).checkpoint())


class Counts:
    """The counted items: ``tag``, ``key``, ``n``."""

    def __init__(self, frame: DataFrame) -> None:
        self.frame = frame

    def of(self, tag: str) -> DataFrame:
        return self.frame.where(F.col("tag") == tag).select("key", "n")

    def total(self, tag: str) -> Column:
        """Number of a tag's items, as an aggregate over ``frame``."""
        return F.coalesce(F.sum(F.when(F.col("tag") == tag, F.col("n"))), F.lit(0)).cast("bigint")

    def cells_outside(self, inclusive: bool) -> Column:
        """Cells outside the table: those told by their column, and those whose row number the table has not."""
        rows = F.coalesce(self.frame.where(F.col("tag") == ROWS).select("n").scalar(), F.lit(0))
        row = F.col("key").try_cast("bigint")
        outside = F.when(F.col("tag") == CELL_ROW, (row > rows) if inclusive else (row >= rows)) \
            .otherwise(F.col("tag") == CELL)
        return F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).cast("bigint")

    def duplicated_keys(self) -> DataFrame:
        return self.frame.agg(F.count_if((F.col("tag") == KEY) & (F.col("n") > 1)).cast("bigint").alias("duplicated_keys"))

    def missing(self, tag: str, allowed: DataFrame) -> DataFrame:
        """R2: rows whose value is not among the texts of the one column of ``allowed``."""
        left = self.of(tag).join(allowed.toDF("__ref"), F.col("key") == F.col("__ref"), "left_anti")
        return left.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations"))

    def required(self, tags: Sequence[str]) -> DataFrame:
        """F1b/F1c per group: ``__present`` required values, ``__excess`` of them not exactly once."""
        is_value = F.col("tag").isin(list(tags))
        return self.frame.where(is_value | (F.col("tag") == GROUP)).groupBy("key").agg(
            F.count_if(is_value).alias("__present"), F.count_if(is_value & (F.col("n") != 1)).alias("__excess"))

    def prefix_incidences(self) -> DataFrame:
        """groups without a value of the prefix."""
        mine = self.frame.where(F.col("tag").isin(GROUP_PREFIX, GROUP_PREFIX + "+"))
        lacking = mine.groupBy("key").agg(F.bool_or(F.col("tag") != GROUP_PREFIX).alias("has"))
        return lacking.agg(F.count_if(~F.col("has")).cast("bigint").alias("incidences")) \
            .withColumn("passed", F.col("incidences") == 0)
