"""Flag assignment (L4) as column expressions over stage verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.constants import (
    FLAG_ALL_OK, FLAG_FUNCTIONAL_FAIL, FLAG_HEADER_FAIL, FLAG_REFERENCE_FAIL,
    FLAG_TECHNICAL_FAIL, FLAG_UNREADABLE,
)


def final_flag(failed_stage: Column, unreadable: Column) -> Column:
    """Final status flag of a table from its first failed stage (NULL = none)."""
    return (
        F.when(unreadable, F.lit(FLAG_UNREADABLE))
        .when(failed_stage == 1, F.lit(FLAG_HEADER_FAIL))
        .when(failed_stage == 2, F.lit(FLAG_TECHNICAL_FAIL))
        .when(failed_stage == 3, F.lit(FLAG_REFERENCE_FAIL))
        .when(failed_stage == 4, F.lit(FLAG_FUNCTIONAL_FAIL))
        .otherwise(F.lit(FLAG_ALL_OK))
        .cast("double")
    )


def stages_passed(failed_stage: Column) -> Column:
    """O2: number of stages passed before the first failure (4 when none)."""
    return F.coalesce(failed_stage - 1, F.lit(4)).cast("int")
