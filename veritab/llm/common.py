"""Helpers shared by the operators: scratch tables, row keys, training split."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.session import ensure_checkpoint_dir

#: rows of a corpus whose crc32(id as text) leaves this remainder are held out
HELD_OUT_MODULUS = 5


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/veritab-llm/{uuid.uuid4().hex}/{name}"


#: rows that a worker gets at a time while a table is written
ARROW_ROWS = 2000
_ARROW_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


_lock = threading.Lock()
#: sessions with jobs under the short setting: how many, and the setting before
_shortened: dict[int, tuple[int, str]] = {}


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside hand texts to Python in batches of at most ``ARROW_ROWS`` rows:
    Spark keeps the buffers of the largest batch for the life of an executor.
    Jobs of several threads may overlap; the last one restores the setting."""
    key = id(spark)
    with _lock:
        jobs, before = _shortened.get(key, (0, spark.conf.get(_ARROW_ROWS_SETTING)))
        _shortened[key] = (jobs + 1, before)
        if not 0 < int(before) <= ARROW_ROWS:
            spark.conf.set(_ARROW_ROWS_SETTING, str(ARROW_ROWS))
    try:
        yield
    finally:
        with _lock:
            jobs, before = _shortened.pop(key)
            if jobs > 1:
                _shortened[key] = (jobs - 1, before)
            else:
                spark.conf.set(_ARROW_ROWS_SETTING, before)


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Cuts the lineage with a table that every executor can read again, so a
    lost executor does not repeat the work above it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with short_batches(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the ids that no model may learn from (null: false)."""
    remainder = F.crc32(F.col(id_col).cast("string")) % HELD_OUT_MODULUS
    return F.coalesce(remainder == 0, F.lit(False))


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled texts to learn from: columns ``text``, ``label`` (0 or 1).

    Takes the labels outside the held-out fifth, at most ``max_rows`` of each
    class in the order of a hash of the id, so that the sample is the same in
    every run and does not follow the order of the table.  Only the selected
    ids (a bounded number) are joined to the texts.
    """
    usable = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("_id"))
              .agg(F.max(label).cast("int").alias("label")))
    order = F.xxhash64(F.lit("train"), F.col("_id"))
    ids = [usable.where(F.col("label") == k).orderBy(order, "_id").limit(max_rows) for k in (0, 1)]
    picked = F.broadcast(ids[0].unionByName(ids[1]))  # at most 2 * max_rows ids
    texts = docs.select(F.col(id_col).alias("_doc"), text_or_empty(text_col).alias("text"))
    return texts.join(picked, F.col("_doc") == F.col("_id")).select("text", "label")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    An array that a lambda reads for each of its items must be bound first: the
    optimizer may put the array's own expression in place of a column (also
    when a later filter moves below a projection), and it would then be built
    anew for every item.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: groups whose totals are broadcast, at most
HOT_GROUPS = 50_000
#: groups up to this size (or the size that fewer than ``HOT_GROUPS`` groups can exceed) go through a shuffle
HOT_ROWS = 64


def attach_totals(rows: DataFrame, totals: DataFrame, key: str, size: str) -> DataFrame:
    """Rows with the columns of their group's row in ``totals`` (unique, non-null ``key``).

    ``size`` is a group's number of rows.  Groups above a bound are broadcast:
    with n rows fewer than ``HOT_GROUPS`` groups can have more than
    n / ``HOT_GROUPS`` of them.  The others are joined by a shuffle, where no
    key has more rows than that bound.  ``totals`` is read several times and
    should be a written table.
    """
    n = totals.agg(F.sum(size)).first()[0] or 0
    hot = totals.where(F.col(size) > max(HOT_ROWS, -(-n // HOT_GROUPS)))
    cold = totals.where(F.col(size) <= max(HOT_ROWS, -(-n // HOT_GROUPS)))
    by_broadcast = rows.join(F.broadcast(hot), key)
    by_shuffle = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return by_broadcast.unionByName(by_shuffle)
