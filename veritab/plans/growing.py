"""Tables that grow by files: a run reads new files only.

The counts that answer a table's checks (``single_scan``) are kept per file, as a table
(``file``, ``tag``, ``key``, ``n``) with a list of the files that are in it (path, length,
time of change).  Counts add up, so the state of files A merged with that of files B
answers for A and B together, key duplicates across files included.  A run lists the
table's files, counts those that the state lacks, and reads its verdicts from
the sum over the files that are there now: a file that changed is counted anew, one
that is gone does not count.

A part of the state is complete when its list of files is written, which is the
last thing and one file; counts without a list are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.operators.single_scan import Counts, Items
from veritab.session import ensure_checkpoint_dir
from veritab.sources.csv_headers import plain_path

_FILES = "file string, length bigint, changed timestamp, part string"
_COUNTS = "file string, tag string, key string, n bigint"


def _normal(path: Column) -> Column:
    """One spelling of a local path (``file:/x`` and ``file:///x``)."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _of_row() -> Column:
    """The file that a row was read from, as a listing spells it."""
    return _normal(plain_path(F.input_file_name()))


class GrowingTable:
    """A table in files below ``path`` and the state of its checks below ``state_path``.

    ``load(files)`` reads some of the files as the table's frame is read.
    """

    def __init__(self, spark: SparkSession, path: str, state_path: str, load: Callable[[list[str]], DataFrame]) -> None:
        self.spark, self.path, self.state, self.load = spark, path, state_path.rstrip("/"), load

    def files(self) -> DataFrame:
        """The files that are there now; their content is not read."""
        found = self.spark.read.format("binaryFile").load(self.path)
        return found.select(_normal(F.col("path")).alias("file"), "length", F.col("modificationTime").alias("changed"))

    def _known(self, mark: str) -> DataFrame:
        try:
            return self.spark.read.schema(_FILES).parquet(f"{self.state}/{mark}/files")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _FILES)

    def counts(self, items: Items, mark: str, names: list[str] | None = None) -> Counts:
        """The table's counts; ``mark`` tells one set of checks from another, ``names`` are the
        columns of files without a header."""
        ensure_checkpoint_dir(self.spark)
        now, known = self.files(), self._known(mark)
        same = ["file", "length", "changed"]
        new = now.join(known, same, "left_anti").orderBy("file").collect()  # a listing, as the driver holds for a scan
        if new:
            part = uuid.uuid4().hex
            rows = self.load([r["file"] for r in new])
            rows = rows.toDF(*names) if names else rows
            counted = items.exploded(rows.withColumn("__file", _of_row()), "__file")
            counted.groupBy(F.col("__file").alias("file"), "tag", "key").agg(F.count(F.lit(1)).alias("n")) \
                .write.parquet(f"{self.state}/{mark}/counts/part={part}")
            listed = self.spark.createDataFrame([(*r, part) for r in new], _FILES)
            listed.coalesce(1).write.mode("append").parquet(f"{self.state}/{mark}/files")
        current = self._known(mark).join(now, same, "left_semi").select("file", "part").collect()
        if not current:
            return Counts(self.spark.createDataFrame([], "tag string, key string, n bigint"))
        parts = sorted({r["part"] for r in current})
        stored = self.spark.read.schema(_COUNTS).option("basePath", f"{self.state}/{mark}/counts") \
            .parquet(*[f"{self.state}/{mark}/counts/part={p}" for p in parts])
        wanted = self.spark.createDataFrame([tuple(r) for r in current], "file string, part string")
        held = stored.join(wanted, ["file", "part"], "left_semi")
        return Items.kept(held.groupBy("tag", "key").agg(F.sum("n").alias("n")))
