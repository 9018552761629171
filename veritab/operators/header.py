"""Header stage (H1-H4).

Column names are metadata: the comparison runs on small position frames
(one row per column), never on data rows.  H1 compares all tables at once
with a full outer join on (table, position); of a CSV table the header of
every file is compared.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from veritab.sources.readers import UNPARSED, UnsupportedFormat

#: errors that Spark itself reports; errors of a caller's Python code are not among them
SPARK_ERRORS = (CapturedException, Py4JJavaError)
#: what makes a table unreadable
READ_ERRORS = (*SPARK_ERRORS, UnsupportedFormat, OSError)

ACTUAL_COLUMNS = StructType([
    StructField("table_id", StringType(), False),
    StructField("position", IntegerType(), False),
    StructField("actual_name", StringType(), False),
])


def actual_columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """(table_id, position, actual_name) from the frames' schemas, 1-based."""
    rows = [(tid, i + 1, name) for tid, df in frames.items() for i, name in enumerate(df.columns)]
    return spark.createDataFrame(rows, ACTUAL_COLUMNS)


def header_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """H1: positions where names differ (exact, case-sensitive) or exist on
    one side only.

    ``expected``: (id_type_file, field_position, field_name) - a rules frame.
    ``actual``:   (table_id, position, actual_name).
    """
    e = expected.select(F.col("id_type_file").alias("table_id"),
                        F.col("field_position").cast("int").alias("position"),
                        F.col("field_name").alias("expected_name"))
    joined = e.join(actual, ["table_id", "position"], "full_outer")
    return joined.where(~F.col("actual_name").eqNullSafe(F.col("expected_name"))) \
        .select("table_id", "position", "expected_name", "actual_name")


def header_matches(actual_names: Sequence[str], expected_names: Sequence[str]) -> bool:
    """H1 for one table on the driver: same names, same order, same count."""
    return list(actual_names) == list(expected_names)


def rename_by_position(df: DataFrame, expected_names: Sequence[str]) -> DataFrame:
    """H2: a table without a header row takes its names from the rules."""
    return df.toDF(*expected_names)


def arity_matches(df: DataFrame, expected_names: Sequence[str]) -> bool:
    """H3: the column count is checked explicitly before renaming."""
    return len(_data_columns(df)) == len(expected_names)


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != UNPARSED]


def differing_files(df: DataFrame, expected_names: Sequence[str]) -> str | None:
    """H1 per file: what to say of the files whose header differs from the rules.

    The reader leaves the headers that it found in the schema; a frame without
    them (no CSV table with headers) has no files of its own names."""
    found = df.schema[UNPARSED].metadata.get("file_headers", []) if UNPARSED in df.columns else []
    wrong = [h for h in found if list(h["columns"]) != list(expected_names)]
    if not wrong:
        return None
    named = [f"{os.path.basename(file)} ({', '.join(h['columns'])})" for h in wrong for file in h["examples"]]
    n, total = sum(h["files"] for h in wrong), sum(h["files"] for h in found)
    return f"{n} of {total} files: " + "; ".join(named) + ("; ..." if n > len(named) else "")


@dataclass
class HeaderResult:
    frame: DataFrame | None   # renamed / checked frame when passed
    passed: bool
    rule: str                 # read | header | arity
    message: str | None
    raw: DataFrame | None = None  # the frame as read (None when unreadable)


def validate_header(load: Callable[[], DataFrame], has_header: bool,
                    expected_names: Sequence[str]) -> HeaderResult:
    """H0: load (H4), then compare names (H1) or rename by position (H2/H3).

    Only load and schema resolution are guarded; anything after that is a
    real error and propagates."""
    try:
        df = load()
        # resolves the schema: a missing table fails here
        columns = _data_columns(df)
    except READ_ERRORS:
        # missing path, unknown or unreadable format, JDBC failure; programming errors propagate
        return HeaderResult(None, False, "read", "table could not be read")
    if has_header:
        differing = differing_files(df, expected_names)
        if differing is None and header_matches(columns, expected_names):
            return HeaderResult(df, True, "header", None, df)
        return HeaderResult(None, False, "header", "header present but column names differ from the rules"
                            + (f" in {differing}" if differing else ""), df)
    unparsed = [UNPARSED] if len(columns) < len(df.columns) else []
    if not arity_matches(df, expected_names):
        return HeaderResult(None, False, "arity",
                            "column count differs from the rules", df)
    return HeaderResult(rename_by_position(df, [*expected_names, *unparsed]), True, "header", None, df)
