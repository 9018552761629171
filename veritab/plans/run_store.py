"""Finished tables of a run, so that a restarted driver goes on where it stopped (O1).

A table's verdict rows are one file below ``run_id=<id>/attempt=<n>/table=<id>``, which
appears by one rename when they are complete.  Each row carries a fingerprint of what
was checked: a table whose rules changed in between is validated again.
"""

from __future__ import annotations

import hashlib
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veritab.plans.verdicts import VERDICT, VERDICT_COLUMNS

_STORED = StructType([*VERDICT.fields, StructField("fingerprint", StringType(), False)])


def fingerprint(*parts) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


class RunStore:
    """Verdict rows by table of one attempt of a run."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, attempt: int = 0) -> None:
        self.spark = spark
        self.path = f"{root.rstrip('/')}/run_id={quote(run_id, safe='')}/attempt={attempt}"

    def finished(self) -> dict[tuple[str, str], list[tuple]]:
        """(table id, fingerprint) -> verdict rows of the tables that were completed."""
        try:
            rows = self.spark.read.schema(_STORED).parquet(f"{self.path}/*").collect()  # a few rows per table
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        out: dict[tuple[str, str], list[tuple]] = {}
        for r in rows:
            out.setdefault((r["table_id"], r["fingerprint"]), []).append(tuple(r[c] for c in VERDICT_COLUMNS))
        return out

    def put(self, table_id: str, mark: str, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame(rows, VERDICT).withColumn("fingerprint", F.lit(mark))
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/table={quote(table_id, safe='')}")
