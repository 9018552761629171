"""Validate files as they land: the technical checks on each micro-batch.

The validated system is batch only; this adapter adds no check of its own.
It runs the one-pass column counts (T1-T7) on every micro-batch of a file
stream and writes one verdict row per (batch, column).  Each batch is written
to its own ``batch_id=<n>`` folder with overwrite, so a batch retried after a
failure replaces its earlier output instead of duplicating it; the stream's
progress lives under ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritab.functions.rules import Rule
from veritab.operators.technical import column_violation_counts
from veritab.session import ensure_checkpoint_dir


def batch_verdicts(batch: DataFrame, batch_id: int, table_id: str, rules: Sequence[Rule],
                   compat: bool = False) -> DataFrame:
    """Verdict rows of one micro-batch."""
    counts = column_violation_counts(batch, rules, compat, with_row_count=True)
    return counts.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(table_id).alias("table_id"),
        "column_name", "field_position", "violations", "row_count",
        (F.col("violations") == 0).alias("passed"))


def validate_stream(stream: DataFrame, table_id: str, rules: Sequence[Rule], sink_path: str,
                    checkpoint_location: str | None = None, compat: bool = False,
                    available_now: bool = True) -> StreamingQuery:
    """Start a stream that writes per-batch verdicts under ``sink_path``."""
    spark = stream.sparkSession
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "streams", table_id)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = batch_verdicts(batch, batch_id, table_id, rules, compat)
        out.write.mode("overwrite").parquet(os.path.join(sink_path, f"batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
