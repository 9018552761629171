"""Technical stage: type / length / null checks (T1-T7) and key uniqueness.

Every column rule of a table is evaluated in ONE aggregate over the table:
``count_if(pred_i)`` per column plus ``count(*)``.  The scan reads only the
tested columns, the aggregate is partial per task (a handful of longs of
state), and the final merge moves one row per task; nothing grows with the
data except the scan itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, FloatType, IntegralType, TimestampNTZType, TimestampType,
)

from veritab.functions.bloom import bloom_filter, perhaps_contains
from veritab.functions.predicates import any_violation, fast_predicate, violation_predicate, violation_sql
from veritab.functions.rules import Rule
from veritab.functions.names import cols
from veritab.functions.sqltext import sql_str


def _predicates(rules: Sequence[Rule], compat: bool) -> list[tuple[Rule, Column]]:
    return [(r, fast_predicate(r, compat)) for r in rules]


def count_if_exprs(rules: Sequence[Rule], compat: bool = False, prefix: str = "__v") -> list[Column]:
    """``count_if(<rule predicate>) AS <prefix><i>`` per rule, one JVM call each
    (the predicate is SQL text when it can be; see ``fast_predicate``)."""
    out = []
    for i, r in enumerate(rules):
        text = violation_sql(r, compat)
        if text is not None:
            out.append(F.expr(f"count_if({text}) AS `{prefix}{i}`"))
        else:
            out.append(F.count_if(violation_predicate(r, compat)).alias(f"{prefix}{i}"))
    return out


def column_violation_counts(df: DataFrame, rules: Sequence[Rule], compat: bool = False,
                            with_row_count: bool = False) -> DataFrame:
    """Per-column violation counts in one pass.

    Returns ``column_name, field_position, violations`` (one row per rule);
    with ``with_row_count`` also ``row_count`` on every row.  The aggregate
    and the unpivot are built as SQL text: a table with hundreds of rule
    columns plans in well under a second.
    """
    one_row = df.agg(F.count(F.lit(1)).alias("__rows"), *count_if_exprs(rules, compat))
    entries = ", ".join(
        f"named_struct('column_name', {sql_str(r.field_name)}, "
        f"'field_position', CAST({sql_str(r.field_position)} AS INT), "
        f"'violations', CAST(`__v{i}` AS BIGINT))"
        for i, r in enumerate(rules))
    out = one_row.selectExpr("CAST(__rows AS BIGINT) AS row_count", f"inline(array({entries}))")
    cols = ["column_name", "field_position", "violations"]
    return out.select(*(cols + (["row_count"] if with_row_count else [])))


def row_violations(df: DataFrame, rules: Sequence[Rule], compat: bool = False,
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Offending rows: any column rule broken (OR of all predicates).

    Adds ``failed_columns``: comma-separated names of the broken columns.
    """
    preds = _predicates(rules, compat)
    failed = F.concat_ws(",", *[F.when(p, F.lit(r.field_name)) for r, p in preds])
    out = df.where(any_violation([p for _, p in preds]))
    if keep is not None:
        out = out.select(*cols(keep), failed.alias("failed_columns"))
    else:
        out = out.withColumn("failed_columns", failed)
    return out


def has_violation(df: DataFrame, rules: Sequence[Rule], compat: bool = False) -> bool:
    """Fail-fast verdict: stops at the first bad row."""
    preds = [p for _, p in _predicates(rules, compat)]
    return not df.where(any_violation(preds)).isEmpty()


def key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key value.  ``groupBy`` treats nulls as equal values, so a
    composite key with nulls counts like any other (unlike COUNT(DISTINCT))."""
    return df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _is_narrow(df: DataFrame, keys: Sequence[str]) -> bool:
    """One column of a fixed width: its hash would be no shorter."""
    kinds = [f.dataType for f in df.select(*cols(keys)).schema]
    fixed = (IntegralType, DateType, TimestampType, TimestampNTZType, BooleanType, FloatType, DoubleType)
    return len(kinds) == 1 and isinstance(kinds[0], fixed)


class _ByHash:
    """Keys counted by a 64-bit hash first (16 bytes a row in the exchange, however wide
    the key), and only rows of hashes that occur twice by their key.

    The repeated hashes are a Bloom filter, so the table is read a second time
    but does not move; a hash outside the filter occurs once and is one key.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], hashed: Callable[..., Column]) -> None:
        key_hash = hashed(*cols(keys))
        self.hashes = df.groupBy(key_hash.alias("h")).agg(F.count(F.lit(1)).alias("n"))
        repeated = bloom_filter(self.hashes.where("n > 1"), F.col("h"))
        self.outside = ~perhaps_contains(repeated, F.col("h"))
        self.exact = key_groups(df.where(perhaps_contains(repeated, key_hash)), keys)


def key_summary(df: DataFrame, keys: Sequence[str], hashed: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """One row ``row_count, distinct_keys, duplicated_keys, passed``.

    Wide keys are counted by their hash and compared exactly only where a hash repeats.
    The group-by is partial per task first, so a hot key is collapsed before the shuffle.
    """
    counted = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    of_keys = [F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
               F.count_if(F.col("n") > 1).cast("bigint").alias("duplicated_keys")]
    if _is_narrow(df, keys):
        found = key_groups(df, keys).agg(counted.alias("row_count"), *of_keys)
    else:
        by_hash = _ByHash(df, keys, hashed)
        rows = by_hash.hashes.agg(counted.alias("row_count"), F.count_if(by_hash.outside).alias("once"))
        both = rows.crossJoin(by_hash.exact.agg(*of_keys))  # one row each
        found = both.select("row_count", (F.col("distinct_keys") + F.col("once")).cast("bigint").alias("distinct_keys"),
                            "duplicated_keys")
    return found.withColumn("passed", F.col("duplicated_keys") == 0)


def key_duplicates(df: DataFrame, keys: Sequence[str], hashed: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """T8 detail: key values that occur more than once, with their count."""
    groups = key_groups(df, keys) if _is_narrow(df, keys) else _ByHash(df, keys, hashed).exact
    return groups.where(F.col("n") > 1)
