"""Column references from metadata names.

Field names come from metadata (spreadsheet headers, database columns) and
may contain dots; ``F.col("a.b")`` would read that as a nested field.  The
name is quoted so it always means the top-level column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(names: Sequence[str]) -> list[Column]:
    return [col(n) for n in names]
