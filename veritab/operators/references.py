"""Referential integrity (R1-R3): values must appear in a reference column.

The reference side is the distinct non-null values of the reference column
(a null in an allowed list would otherwise make NOT IN never true).  Values of
two types are compared by a key of their exact value (``normal_form``), so
that equal values are equal whatever types hold them.

Tested values are first counted per distinct value, so a value that most rows
share is one row per task before anything moves, and keys are made of distinct
values only.  Offending rows are found by a semi-join with the missing values
behind a Bloom filter of them: rows whose value is not missing stay where they
are, whatever the size of the table.  Null tested values pass.  Nothing runs
while a check is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.bloom import bloom_filter, perhaps_contains
from veritab.functions.names import col
from veritab.functions.normal_form import comparable

_REF = "__ref_value"
_VALUE = "__value"
_KEY = "__key"


def comparable_keys(df: DataFrame, column: str, ref: DataFrame, ref_column: str):
    """Functions from the tested and from the allowed value to comparable expressions."""
    types = [frame.select(col(name)).schema[0].dataType for frame, name in ((df, column), (ref, ref_column))]
    return comparable(*types) or (lambda v: v, lambda v: v)


def allowed_values(ref: DataFrame, ref_column: str, key=lambda v: v) -> DataFrame:
    """Distinct non-null allowed values (or keys of them) as one column ``__ref_value``."""
    return ref.where(col(ref_column).isNotNull()).select(key(col(ref_column)).alias(_REF)).distinct()


def missing_values(df: DataFrame, column: str, ref: DataFrame, ref_column: str,
                   large_reference: bool = False) -> DataFrame:
    """Distinct non-null tested values that are not allowed: ``__value`` and
    ``__n``, the number of their rows.

    With ``large_reference`` a Bloom filter of the allowed values finds the values
    that are surely missing; only the others are shuffled to the anti-join.
    """
    tested_key, allowed_key = comparable_keys(df, column, ref, ref_column)
    tested = col(column)
    per_value = (df.where(tested.isNotNull()).groupBy(tested.alias(_VALUE)).agg(F.count(F.lit(1)).alias("__n"))
                 .withColumn(_KEY, tested_key(F.col(_VALUE))))
    side = allowed_values(ref, ref_column, allowed_key)

    def not_among(rows: DataFrame) -> DataFrame:
        return rows.join(side, F.col(_KEY) == F.col(_REF), "left_anti").select(_VALUE, "__n")

    if not large_reference:
        return not_among(per_value)
    # the filter hashes text: keys of one type on both sides, however Spark would widen them for a join
    as_text: Column = F.col(_KEY).cast("string")
    perhaps = perhaps_contains(bloom_filter(side, F.col(_REF).cast("string")), as_text)
    surely = per_value.where(~perhaps).select(_VALUE, "__n")
    return surely.unionByName(not_among(per_value.where(perhaps)))


def reference_violations(df: DataFrame, column: str, ref: DataFrame, ref_column: str,
                         large_reference: bool = False) -> DataFrame:
    """R2: rows whose non-null ``column`` value is not an allowed value."""
    missing = missing_values(df, column, ref, ref_column, large_reference).select(_VALUE)
    suspect = df.where(col(column).isNotNull() & perhaps_contains(bloom_filter(missing, F.col(_VALUE)), col(column)))
    return suspect.join(missing, col(column) == F.col(_VALUE), "left_semi")


def reference_violation_count(df: DataFrame, column: str, ref: DataFrame, ref_column: str,
                              large_reference: bool = False) -> DataFrame:
    """R2 verdict: one row ``violations`` (BIGINT, 0 when clean)."""
    missing = missing_values(df, column, ref, ref_column, large_reference)
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("violations"))


def failing_columns_summary(per_column: DataFrame, group_cols: Sequence[str] = ("table_name",)) -> DataFrame:
    """Per table, the number of failing reference columns (incidences)
    and their names in position order, comma separated.

    ``per_column`` has ``group_cols``, ``field_position``, ``column_name``,
    ``violations``."""
    failing = F.col("violations") > 0
    return per_column.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("checked_columns"),
        F.count_if(failing).cast("bigint").alias("incidences"),
        F.concat_ws(", ", F.transform(
            F.array_sort(F.collect_list(F.when(failing, F.struct("field_position", "column_name")))),
            lambda s: s["column_name"])).alias("field_name"),
        F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("violations"),
    ).withColumn("passed", F.col("incidences") == 0)
