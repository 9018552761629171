"""Sinks (S3, S7): append rows to a table, drop and recreate a table.

Appends go through Spark's file commit protocol: a lost executor's task is
re-run and only committed task output becomes visible, so a retried job
never writes a row twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_rows(df: DataFrame, target: str, fmt: str = "parquet", *, as_table: bool = False,
                jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None) -> None:
    """S3: append ``df`` to a path, a catalog table or a JDBC table."""
    writer = df.write.mode("append")
    if jdbc_url is not None:
        writer.jdbc(jdbc_url, target, properties=jdbc_properties or {})
    elif as_table:
        writer.format(fmt).saveAsTable(target)
    else:
        writer.format(fmt).save(target)


def recreate_table(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Drop a catalog table if present and create it from ``df``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def insert_into(df: DataFrame, name: str) -> None:
    """Insert rows into an existing catalog table by position."""
    df.write.insertInto(name)
