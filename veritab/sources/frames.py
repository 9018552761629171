"""Literal frames (S4), schema clones (S5), empty results (S8), caching."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A small frame from literal rows with a fixed schema."""
    return spark.createDataFrame(list(rows), schema)


def schema_clone(df: DataFrame) -> DataFrame:
    """Same columns and types, no rows (Catalyst prunes the scan away)."""
    return df.limit(0)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Typed empty result."""
    return spark.createDataFrame([], schema)


def cache_for_passes(df: DataFrame) -> DataFrame:
    """Keep a table for several passes; spills to disk instead of failing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(df: DataFrame) -> None:
    df.unpersist()
