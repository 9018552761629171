"""Table scans (S1) and exact row counts.

Parquet is the default; CSV honours the catalog's separator and header
flags, and maps each file by the names of its own header; JSON values stay text
as they are written; JDBC reads are partitioned on a numeric column when bounds are given
(a single-partition JDBC scan does not scale past one task).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veritab.functions.names import cols
from veritab.sources.jdbc_ranges import equi_depth_predicates
from veritab.sources.csv_headers import as_metadata, file_headers, safe_names


class UnsupportedFormat(ValueError):
    """A catalog row names a format that has no reader."""


def read_table(spark: SparkSession, path: str | list[str], fmt: str = "parquet", *,
               header: bool | None = None, separator: str | None = None,
               schema: StructType | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Read one table.  ``fmt`` is parquet, csv, json, orc or jdbc.

    CSV columns stay text (no schema inference): every check works on the
    text as written, and inference would cost a second pass over the data.
    """
    fmt = (fmt or "parquet").lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        given = {k.lower(): v for k, v in (options or {}).items()}
        if header and schema is None and given.get("encoding", "utf-8").lower() in ("utf-8", "utf8"):
            return _read_by_headers(spark, path, separator or ",", options or {})
        return _read_csv(reader, path, header=bool(header), sep=separator or ",", schema=schema)
    if fmt == "json":
        return reader.option("primitivesAsString", True).json(path)
    if fmt == "orc":
        return reader.orc(path)
    if fmt == "jdbc":
        return reader.format("jdbc").option("dbtable", path).load()
    raise UnsupportedFormat(f"unsupported format {fmt!r}")


#: column of a CSV frame that holds a record with too many or too few fields as
#: it was written (null for all others)
UNPARSED = "__unparsed_record"


def _read_csv(reader, path: str, header: bool, sep: str, schema: StructType | None) -> DataFrame:
    """Text columns named by the header (or ``_c0`` ...), and ``UNPARSED``: a
    surplus field is kept there instead of being cut off without a word."""
    options = dict(header=header, sep=sep, inferSchema=False)
    columns = schema or reader.csv(path, **options).schema
    if not columns.fields or any(f.name == UNPARSED for f in columns.fields):
        return reader.csv(path, **options)
    whole = StructType([*columns.fields, StructField(UNPARSED, StringType(), True)])
    return reader.schema(whole).option("columnNameOfCorruptRecord", UNPARSED).csv(path, **options)


def _read_by_headers(spark: SparkSession, path: str, sep: str, options: dict[str, str]) -> DataFrame:
    """A CSV table whose files name their columns themselves.

    Files with the same header are one scan; scans of different headers are
    put together by column name (a column that a file lacks is null), the columns of
    the most frequent header first.  Every file is read once.  The metadata of
    the column ``UNPARSED`` holds the headers that were found.
    """
    headers = file_headers(spark, path, sep, options)
    frames = []
    for found in headers:
        schema = StructType([StructField(c, StringType(), True) for c in safe_names(found.columns)])
        reader = spark.read.options(**options) if options else spark.read
        frames.append(_read_csv(reader, path if len(headers) == 1 else list(found.files), True, sep, schema))
    if not frames:  # no file has a record
        return _read_csv(spark.read.options(**options) if options else spark.read, path, True, sep, None)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    names = [c for c in whole.columns if c != UNPARSED]
    return whole.select(*cols(names), F.col(UNPARSED).alias(UNPARSED, metadata=as_metadata(headers)))


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 50000) -> DataFrame:
    """JDBC scan, split into ``num_partitions`` range reads on a numeric
    partition column.  With explicit bounds the ranges are equal steps between
    them; without, they are ranges of about equal numbers of rows, from
    histograms of bounded size that the database counts (see ``jdbc_ranges``), so a
    large table never arrives through one task, skewed or not."""
    def base():
        reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
        for key, value in (properties or {}).items():
            reader = reader.option(key, value)
        return reader

    def ask(sql: str) -> list[tuple]:
        return [tuple(r) for r in base().option("query", sql).load().collect()]

    parts = int(num_partitions or spark.sparkContext.defaultParallelism)
    if partition_column is not None and (lower_bound is None or upper_bound is None):
        predicates = equi_depth_predicates(ask, table, partition_column, parts)
        if len(predicates) > 1:
            given = {**(properties or {}), "fetchsize": str(fetch_size)}
            return spark.read.jdbc(url, table, predicates=predicates, properties=given)
        partition_column = None            # an empty table, or one value: one read is enough
    reader = base().option("dbtable", table)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(parts)))
    return reader.load()


def read_with_options(spark: SparkSession, path: str, fmt: str, options: dict[str, str], **kwargs) -> DataFrame:
    """A table with its own reader options; jdbc with a partitionColumn is read
    in ranges, whose bounds are asked of the database if none are given."""
    given = {k.lower(): v for k, v in options.items()}
    if (fmt or "").lower() != "jdbc" or not (given.get("url") and given.get("partitioncolumn")):
        return read_table(spark, path, fmt, options=options, **kwargs)
    own = {"url", "partitioncolumn", "lowerbound", "upperbound", "numpartitions", "fetchsize", "dbtable"}
    return read_jdbc(
        spark, given["url"], path, properties={k: v for k, v in options.items() if k.lower() not in own},
        partition_column=given["partitioncolumn"], lower_bound=given.get("lowerbound"),
        upper_bound=given.get("upperbound"), num_partitions=given.get("numpartitions"),
        fetch_size=given.get("fetchsize", 50000))


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the benchmark tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def row_count(df: DataFrame) -> DataFrame:
    """Exact row count as a one-row BIGINT frame (no 32-bit overflow)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
