"""Vectors in Arrow batches, and sums over partitions in a tree of small tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import written

#: states of partitions that one task puts together
FAN_IN = 32


def width_of(table: DataFrame, vector_col: str) -> int:
    """The most frequent length of a vector that is not empty (of equally frequent ones
    the longest); 0 if there is none.  Vectors of other lengths are not read."""
    length = F.size(vector_col)
    top = (table.where(length > 0).groupBy(length.alias("width")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("width")).first())
    return top["width"] if top else 0


def matrix_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows that have ``width`` entries, all finite; their entries as doubles)."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    place = np.flatnonzero(length == width)
    if len(place) < len(column):
        column = column.take(pa.array(place))
    flat = column.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, width)  # a null entry reads as nan
    finite = np.isfinite(values).all(axis=1)
    return place[finite], values[finite]


def integers_of(values: np.ndarray, scale: int, bound: int) -> np.ndarray:
    """floor(scale * value) within +-bound."""
    return np.clip(np.floor(values * float(scale)), -bound, bound).astype(np.int64)


def partition_states(table: DataFrame, state: Callable[[Iterator[pa.RecordBatch]], dict | None],
                     schema: str) -> DataFrame:
    """One row of ``schema`` per partition that has vectors: ``state`` maps its batches to a dict of its columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = state(batches)
        if found is not None:
            columns = [TaskContext.get().partitionId(), *found.values()]
            yield pa.record_batch([pa.array([c]) for c in columns], names=["part", *found])

    return written(table.mapInArrow(run, f"part bigint, {schema}"), "states")


def combined(states: DataFrame, merge: Callable[[dict, dict], dict], schema: str) -> dict | None:
    """All states as one: ``FAN_IN`` neighbours in each task, level by level.

    A level is a written table, so a lost executor repeats one level's tasks.
    The driver gets the one state of the last level.
    """
    last = states.agg(F.max("part")).first()[0]
    if last is None:
        return None

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found: dict | None = None
        for row in rows.sort_values("part").drop(columns="part").to_dict("records"):
            found = row if found is None else merge(found, row)
        return pd.DataFrame([{"part": key[0], **found}])

    while True:
        group = F.floor(F.col("part") / FAN_IN)
        states = written(states.groupBy(group.alias("grp")).applyInPandas(run, f"part bigint, {schema}"), "states")
        last //= FAN_IN
        if last == 0:
            return {k: v for k, v in states.first().asDict().items() if k != "part"}
