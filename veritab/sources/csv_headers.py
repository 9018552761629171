"""The header record of every file of a CSV table.

Spark takes the names of a folder of CSV files from one of them and skips the
first record of the others, so a file with its columns in another order would be
read by position.  Here the first record of each file is found through the file
metadata columns: every split of every file is a task of its own that hands on one
line and stops, and the line of the split that starts at byte 0 is the header.
So a table of any size costs the heads of its splits, not a scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: lines that a task reads at a time while it looks for the first record
LINES = 16
#: files named per header in messages
EXAMPLES = 5


def _heads_only(spark: SparkSession) -> SparkSession:
    """A session of the same application in which a split is never put together with another
    one, and where Python gets a few lines at a time."""
    heads = spark.newSession()
    heads.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    heads.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(LINES))
    return heads


def plain_path(uri: Column) -> Column:
    """A path as it is given to a reader, from the escaped form that rows tell of their file."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def first_records(spark: SparkSession, path: str | list[str], comment: str | None = None) -> DataFrame:
    """``file``, ``line``: the first line of each file that is neither blank nor a comment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line, file, start in zip(*(c.to_pylist() for c in batch.columns)):
                if start != 0:
                    return
                if line.strip() and not (comment and line.startswith(comment)):
                    yield pa.record_batch([pa.array([file]), pa.array([line])], names=["file", "line"])
                    return

    lines = _heads_only(spark).read.text(path)
    return lines.select("value", plain_path(F.col("_metadata.file_path")).alias("file"),
                        "_metadata.file_block_start").mapInArrow(
        run, "file string, line string")


@dataclass(frozen=True)
class FileHeader:
    """A header and the files that have it."""

    columns: tuple[str, ...]   # as written
    files: tuple[str, ...]     # in order of their paths


def file_headers(spark: SparkSession, path: str | list[str], separator: str = ",",
                 options: dict[str, str] | None = None) -> list[FileHeader]:
    """The different headers of a table's files, the one of most files first.

    Only metadata reaches the driver: a line per different header, and the
    names of files, which the driver lists for every scan anyway.
    """
    given = {k.lower(): v for k, v in (options or {}).items()}
    lines = first_records(spark, path, given.get("comment"))
    rows = lines.groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files"))
    # as many fields as the line can have, and one that stays empty
    fields = F.size(F.split("line", r"\Q" + separator + r"\E")) + 1
    found = rows.withColumn("fields", fields).collect()
    parse = {k: v for k, v in given.items() if k in ("quote", "escape", "chartoescapequoteescaping")}
    headers = []
    for n in sorted({r["fields"] for r in found}):
        schema = ", ".join(f"f{i} string" for i in range(n))
        some = spark.createDataFrame([(r["line"], r["files"]) for r in found if r["fields"] == n],
                                     "line string, files array<string>")
        names = F.from_csv("line", schema, {**parse, "sep": separator, "mode": "PERMISSIVE"})
        for r in some.select(F.array([names[f"f{i}"] for i in range(n)]).alias("names"), "files").collect():
            columns = list(r["names"])
            while columns and columns[-1] is None:
                columns.pop()
            headers.append(FileHeader(tuple(c or "" for c in columns), tuple(r["files"])))
    return sorted(headers, key=lambda h: (-len(h.files), h.files))


def safe_names(columns: tuple[str, ...]) -> list[str]:
    """Column names of a header: a missing one is ``_c<place>``, of repeated ones each gets its place."""
    lower = [c.lower() for c in columns]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(columns)]


def as_metadata(headers: list[FileHeader]) -> dict:
    """What a frame's schema says about the files that it was read from."""
    return {"file_headers": [{"columns": list(h.columns), "files": len(h.files), "examples": list(h.files[:EXAMPLES])}
                             for h in headers]}


def header_verdicts(spark: SparkSession, path: str, expected: list[str], separator: str = ",",
                    options: dict[str, str] | None = None) -> DataFrame:
    """One verdict per file: ``file``, ``header``, ``passed`` (names, order and number as expected)."""
    rows = [(file, list(h.columns), list(h.columns) == list(expected))
            for h in file_headers(spark, path, separator, options) for file in h.files]
    return spark.createDataFrame(rows, "file string, header array<string>, passed boolean")
