"""Functional rules (F1-F4).  Every column, value and prefix is a parameter.

F1  required values per group: at least one row carries one (F1a), each
    (group, value) occurs exactly once (F1b), each group holds the full set
    (F1c).  A group has one counter per required value, counted per task before
    the one exchange by group: a hot group is one row of counters per task, and
    no group's values are ever collected.
F2  every group has a value with a given prefix.
F3  every value matches a naming pattern.
F4  spreadsheet cell references fall inside the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.cells import out_of_bounds, parse_cell
from veritab.functions.names import col, cols


# --------------------------------------------------------------------------
# F1 required values
# --------------------------------------------------------------------------

def required_counts(df: DataFrame, group_cols: Sequence[str], value_col: str, values: Sequence,
                    all_groups: bool = False) -> DataFrame:
    """Per group ``counts``: an array of (value, n), one per different required value in
    the order given.  Groups without any required value only with ``all_groups``."""
    kind = df.select(col(value_col)).schema[0].dataType
    wanted = [F.lit(v).try_cast(kind) for v in required_set(values)]
    rows = df if all_groups else df.where(col(value_col).isin(wanted))
    counters = [F.count_if(col(value_col) == v).alias(f"__n{i}") for i, v in enumerate(wanted)]
    pairs = F.array(*[F.struct(v.alias("value"), F.col(f"__n{i}").alias("n")) for i, v in enumerate(wanted)])
    shape = f"array<struct<value:{kind.simpleString()},n:bigint>>"
    return rows.groupBy(*cols(group_cols)).agg(F.count(F.lit(1)).alias("__rows"), *counters) \
        .select(*cols(group_cols), pairs.cast(shape).alias("counts"))


def required_set(values: Sequence) -> list:
    """The different required values in the order given; a null is none."""
    return [v for v in dict.fromkeys(values) if v is not None]


def required_any(df: DataFrame, value_col: str, values: Sequence[str]) -> DataFrame:
    """One row ``rows_with_required, passed`` (passed = at least one)."""
    return df.agg(F.count_if(col(value_col).isin(list(values))).cast("bigint")
                  .alias("rows_with_required")).withColumn("passed", F.col("rows_with_required") > 0)


def required_excess(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    values: Sequence[str]) -> DataFrame:
    """(group, value, n) of required values that a group has more than once."""
    found = required_counts(df, group_cols, value_col, values)
    return found.select(*cols(group_cols), F.inline("counts").alias(value_col, "n")).where(F.col("n") > 1)


def required_missing(df: DataFrame, group_cols: Sequence[str], value_col: str,
                     values: Sequence[str], all_groups: bool = False) -> DataFrame:
    """Groups missing part of the required set, with ``n_present``.

    By default only groups with at least one required value are seen;
    ``all_groups=True`` also reports groups with none (n_present = 0).
    """
    found = required_counts(df, group_cols, value_col, values, all_groups)
    n_present = F.size(F.filter("counts", lambda c: c["n"] > 0)).cast("bigint")
    return found.select(*cols(group_cols), n_present.alias("n_present")).where(F.col("n_present") != F.size("counts"))


# --------------------------------------------------------------------------
# F2 prefix per group
# --------------------------------------------------------------------------

def group_has_prefix(df: DataFrame, group_cols: Sequence[str], value_col: str,
                     prefix: str) -> DataFrame:
    """Per group: ``has_prefix`` true when any value starts with ``prefix``."""
    hit = F.coalesce(col(value_col).startswith(prefix), F.lit(False))
    return df.groupBy(*cols(group_cols)).agg(F.bool_or(hit).alias("has_prefix"))


def group_prefix_missing(df: DataFrame, group_cols: Sequence[str], value_col: str,
                         prefix: str) -> DataFrame:
    """F2 detail: groups with no value starting with ``prefix``."""
    return group_has_prefix(df, group_cols, value_col, prefix) \
        .where(~F.col("has_prefix")).select(*cols(group_cols))


def group_prefix_incidences(df: DataFrame, group_cols: Sequence[str], value_col: str,
                            prefix: str) -> DataFrame:
    """F2 verdict: ``groups, groups_with_prefix, incidences, passed``."""
    return group_has_prefix(df, group_cols, value_col, prefix).agg(
        F.count(F.lit(1)).cast("bigint").alias("groups"),
        F.count_if("has_prefix").cast("bigint").alias("groups_with_prefix"),
    ).withColumn("incidences", F.col("groups") - F.col("groups_with_prefix")) \
     .withColumn("passed", F.col("incidences") == 0)


# --------------------------------------------------------------------------
# F3 naming pattern
# --------------------------------------------------------------------------

def pattern_predicate(column: str, pattern: str, mode: str = "literal") -> Column:
    """TRUE when the value does not match.

    ``literal``: must start with ``pattern`` as written.  ``like``: SQL LIKE
    ``pattern%``, where ``_`` and ``%`` are wildcards (so ``ac1`` passes
    ``_c``).  Null values pass."""
    c = col(column)
    if mode == "literal":
        return ~c.startswith(pattern)
    if mode == "like":
        return ~c.like(pattern + "%")
    raise ValueError(f"unknown pattern mode {mode!r}")


def pattern_violations(df: DataFrame, column: str, pattern: str, mode: str = "literal") -> DataFrame:
    """rows whose value does not match the pattern."""
    return df.where(pattern_predicate(column, pattern, mode))


# --------------------------------------------------------------------------
# F4 cell bounds
# --------------------------------------------------------------------------

def with_cell_parts(df: DataFrame, cell_col: str, keep_empty: bool = False) -> DataFrame:
    """Adds ``col_letters, row_num, col_num`` parsed from ``cell_col``."""
    letters, row_num, col_num = parse_cell(col(cell_col), keep_empty)
    return df.withColumn("col_letters", letters).withColumn("row_num", row_num) \
             .withColumn("col_num", col_num)


def cell_out_of_bounds(df: DataFrame, cell_col: str, row_count: Column | int | None = None,
                       column_count: Column | int | None = None, inclusive: bool = False,
                       flag_unparsable: bool = False) -> DataFrame:
    """rows whose cell lies outside ``row_count x column_count``.

    ``row_count`` defaults to the table's own row count as a scalar subquery
    (computed once, inlined as a literal; no join).  ``column_count``
    defaults to the frame's column count.  With ``flag_unparsable`` a
    non-null cell without a ``letters+digits`` reference also violates.
    """
    if row_count is None:
        row_count = df.select(F.count(F.lit(1)).cast("bigint")).scalar()
    if column_count is None:
        column_count = len(df.columns)
    parts = with_cell_parts(df, cell_col)
    bad = out_of_bounds(F.col("row_num"), F.col("col_num"), row_count, column_count, inclusive)
    if flag_unparsable:
        bad = bad | (col(cell_col).isNotNull() & (F.col("row_num").isNull() | F.col("col_num").isNull()))
    return parts.where(bad)
