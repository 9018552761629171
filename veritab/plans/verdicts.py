"""Verdict frames: every check reports rows of ``VERDICT_COLUMNS``.

table_seq, table_id, table_name, stage, check_no, rule, column_name,
violations, incidences, passed, message, row_count
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from veritab.functions.sqltext import sql_str

VERDICT = StructType([
    StructField("table_seq", IntegerType(), False),
    StructField("table_id", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("stage", IntegerType(), False),
    StructField("check_no", IntegerType(), False),
    StructField("rule", StringType(), False),
    StructField("column_name", StringType(), True),
    StructField("violations", LongType(), True),
    StructField("incidences", LongType(), False),
    StructField("passed", BooleanType(), False),
    StructField("message", StringType(), True),
    StructField("row_count", LongType(), True),
])
VERDICT_COLUMNS = [f.name for f in VERDICT.fields]

__all__ = ["VERDICT", "VERDICT_COLUMNS", "counted", "entry", "explode_entries",
           "literal_verdicts", "sql_str", "union_all"]


def entry(table_seq: int, table_id: str, table_name: str, stage: int, check_no: int, rule: str,
          column_name: str | None, violations: str, incidences: str, passed: str,
          message: str | None, row_count: str | None = None) -> str:
    """One verdict as a SQL struct expression over the columns of a one-row
    aggregate (``violations``, ``incidences``, ``passed``, ``row_count`` are
    SQL expressions).  Many of them are exploded from one row with a single
    ``inline`` - one plan node, one call into the JVM."""
    return (
        "named_struct("
        f"'table_seq', CAST({table_seq} AS INT), "
        f"'table_id', {sql_str(table_id)}, "
        f"'table_name', {sql_str(table_name)}, "
        f"'stage', CAST({stage} AS INT), "
        f"'check_no', CAST({check_no} AS INT), "
        f"'rule', {sql_str(rule)}, "
        f"'column_name', CAST({sql_str(column_name)} AS STRING), "
        f"'violations', CAST({violations} AS BIGINT), "
        f"'incidences', CAST({incidences} AS BIGINT), "
        f"'passed', ({passed}), "
        f"'message', CASE WHEN ({passed}) THEN CAST(NULL AS STRING) ELSE {sql_str(message)} END, "
        f"'row_count', CAST({row_count if row_count is not None else 'NULL'} AS BIGINT))"
    )


def explode_entries(one_row: DataFrame, entries: list[str]) -> DataFrame:
    """Turn a one-row aggregate into verdict rows."""
    return one_row.selectExpr(f"inline(array({', '.join(entries)}))")


def literal_verdicts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, VERDICT)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def counted(violations: str) -> tuple[str, str]:
    """(incidences, passed) SQL of a check counted in units (rows, columns...)."""
    return f"CASE WHEN {violations} > 0 THEN 1 ELSE 0 END", f"coalesce({violations}, 0) = 0"
