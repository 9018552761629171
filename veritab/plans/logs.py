"""Status flags, summaries and log frames derived from a verdict frame.

O1  table_status:     first failed stage and final flag per table
O2  progress:         stages passed per table
L1  trigger_rows:     the status rows a staged run writes, in order
L2  validation_logs:  one error row per failed table, linked to its last status row
L3  latest_trigger:   newest status row per table
L4  stage_flags:      flag each stage writes (pass or fail flag)
L5  stage_summary:    per (table, stage): combined message, failing fields, incidences

All of them group verdict rows (a few per table) by table; the sinks
append them with ``veritab.sources.append_rows``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.constants import (
    DEFAULT_ENVIRONMENT, DEFAULT_SOURCE, FAIL_FLAG, FLAG_ALL_OK, FLAG_FUNCTIONAL_OK, FLAG_HEADER_FAIL,
    FLAG_HEADER_OK, FLAG_READ, FLAG_REFERENCE_FAIL, FLAG_REFERENCE_OK, FLAG_TECHNICAL_FAIL,
    FLAG_TECHNICAL_OK, FLAG_FUNCTIONAL_FAIL, FLAG_UNREADABLE, PASS_FLAG, STAGE_NAMES,
)
from veritab.functions.flags import final_flag, stages_passed

TABLE_KEYS = ["table_seq", "table_id", "table_name"]


def run_clock(run_ts: str | _dt.datetime | None = None) -> tuple[Column, Column, Column]:
    """(timestamp, date, yyyyMMddHHmmss as BIGINT) of a run.

    A fixed ``run_ts`` (text or datetime) makes the log frames reproducible;
    None uses the query's current time."""
    if run_ts is None:
        ts = F.localtimestamp()
    else:
        text = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y-%m-%d %H:%M:%S")
        ts = F.to_timestamp_ntz(F.lit(text))
    return ts, F.to_date(ts), F.date_format(ts, "yyyyMMddHHmmss").cast("bigint")


def _stage_name(stage: Column) -> Column:
    expr = None
    for sid, name in STAGE_NAMES.items():
        expr = (F.when(stage == sid, F.lit(name)) if expr is None
                else expr.when(stage == sid, F.lit(name)))
    return expr


def table_status(verdicts: DataFrame) -> DataFrame:
    """O1: per table the first failed stage (NULL when none) and the final flag."""
    return _status_from_summary(stage_summary(verdicts))


def _status_from_summary(summary: DataFrame) -> DataFrame:
    """Table status from the per-(table, stage) summary: verdict rows are
    aggregated once, whichever log frames are derived."""
    failed = ~F.col("passed")
    return summary.groupBy(*TABLE_KEYS).agg(
        F.min(F.when(failed, F.col("stage"))).alias("failed_stage"),
        F.bool_or("unreadable").alias("unreadable"),
        F.bool_or("arity_failed").alias("arity_failed"),
        F.bool_or(F.col("stage") == 3).alias("has_reference"),
        F.max("row_count").alias("row_count"),
    ).select(
        *TABLE_KEYS, "failed_stage", "unreadable", "arity_failed", "has_reference",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        final_flag(F.col("failed_stage"), F.col("unreadable")).alias("flag"),
        stages_passed(F.col("failed_stage")).alias("stages_passed"),
    )


def progress(verdicts: DataFrame) -> DataFrame:
    """O2: stages passed per table."""
    return table_status(verdicts).select("table_id", "table_name", "stages_passed")


def stage_summary(verdicts: DataFrame) -> DataFrame:
    """Per (table, stage) verdict with the combined message (failing
    checks in check order), the distinct failing fields (in check order) and
    the incidence sum."""
    failed = ~F.col("passed")
    msgs = F.array_sort(F.collect_list(F.when(failed, F.struct("check_no", "message"))))
    named = F.array_sort(F.collect_list(F.when(
        failed & F.col("column_name").isNotNull(),
        F.struct("check_no", F.split("column_name", ", ").alias("names")))))
    fields = F.array_distinct(F.flatten(F.transform(named, lambda s: s["names"])))
    return verdicts.groupBy(*TABLE_KEYS, "stage").agg(
        F.bool_and("passed").alias("passed"),
        F.sum("incidences").cast("bigint").alias("incidences"),
        F.concat_ws(" ", F.transform(msgs, lambda s: s["message"])).alias("validation_msg"),
        F.concat_ws(", ", fields).alias("field_name"),
        F.bool_or((F.col("rule") == "read") & failed).alias("unreadable"),
        F.bool_or((F.col("rule") == "arity") & failed).alias("arity_failed"),
        F.max("row_count").alias("row_count"),
    ).withColumn("type_validation", _stage_name(F.col("stage")))


def stage_flags(verdicts: DataFrame) -> DataFrame:
    """L4: the flag of each stage a table reaches: its pass flag or its fail flag.

    A table stops at its first failed stage, so later stages have no flag.
    Without reference rules there is no stage 3; a table that passes its
    reference checks (or has none) passes stage 4 when it has no functional
    rule.  An unreadable table has the one flag 30."""
    per = stage_summary(verdicts).groupBy(*TABLE_KEYS).agg(
        F.collect_set("stage").alias("seen"), F.min(F.when(~F.col("passed"), F.col("stage"))).alias("failed_stage"),
        F.bool_or("unreadable").alias("unreadable"))
    stages = F.array(*[F.lit(k) for k in sorted(PASS_FLAG)])
    reached = F.filter(stages, lambda k: (F.array_contains("seen", k) | (k == 4) | (k == 2))
                       & (F.col("failed_stage").isNull() | (k <= F.col("failed_stage"))))
    rows = per.select(*TABLE_KEYS, "failed_stage", "unreadable", F.explode(reached).alias("stage"))
    passed = F.col("failed_stage").isNull() | (F.col("stage") < F.col("failed_stage"))
    flag = F.when(F.col("unreadable"), F.lit(FLAG_UNREADABLE))
    for k in sorted(PASS_FLAG):
        flag = flag.when((F.col("stage") == k) & passed, F.lit(PASS_FLAG[k])).when(F.col("stage") == k, F.lit(FAIL_FLAG[k]))
    return rows.select("table_id", "table_name", "stage", passed.alias("passed"), flag.cast("double").alias("flag"))


def _status_flags() -> Column:
    """Ordered status flags of a table (NULLs removed afterwards)."""
    fs = F.col("failed_stage")
    ok_after = lambda k: fs.isNull() | (fs > k)
    return F.array(
        F.when(~F.col("unreadable"), F.lit(FLAG_READ)),
        F.when(F.col("unreadable"), F.lit(FLAG_UNREADABLE))
         .when(fs == 1, F.when(~F.col("arity_failed"), F.lit(FLAG_HEADER_FAIL)))
         .otherwise(F.lit(FLAG_HEADER_OK)),
        F.when(fs == 2, F.lit(FLAG_TECHNICAL_FAIL)).when(ok_after(2), F.lit(FLAG_TECHNICAL_OK)),
        F.when(F.col("has_reference"),
               F.when(fs == 3, F.lit(FLAG_REFERENCE_FAIL)).when(ok_after(3), F.lit(FLAG_REFERENCE_OK))),
        F.when(fs == 4, F.lit(FLAG_FUNCTIONAL_FAIL)).when(fs.isNull(), F.lit(FLAG_FUNCTIONAL_OK)),
        F.when(fs.isNull(), F.lit(FLAG_ALL_OK)),
    )


def trigger_rows(verdicts: DataFrame, run_ts=None, environment: str = DEFAULT_ENVIRONMENT,
                 source: str = DEFAULT_SOURCE, id_base: int = 0) -> DataFrame:
    """L1: status rows in write order.

    Read (1), header (1.2 / 31; a column-count mismatch writes no status
    row), technical (1.2 / 32), reference (1.3 / 33, only for tables with
    reference rules), functional (1.4 / 34), all passed (2); an unreadable
    table writes only 30.  ``id_trigger = id_base + table_seq*10 + n``."""
    return _triggers_from_status(table_status(verdicts), run_ts, environment, source, id_base)


def _triggers_from_status(st: DataFrame, run_ts=None, environment: str = DEFAULT_ENVIRONMENT,
                          source: str = DEFAULT_SOURCE, id_base: int = 0) -> DataFrame:
    ts, day, stamp = run_clock(run_ts)
    flags = F.filter(_status_flags(), lambda x: x.isNotNull())
    rows = st.select(*TABLE_KEYS, "row_count", F.posexplode(flags).alias("n", "flag"))
    return rows.select(
        (F.lit(id_base) + F.col("table_seq") * 10 + F.col("n") + 1).cast("bigint").alias("id_trigger"),
        F.col("table_id").alias("id_type_file"),
        F.col("table_name").alias("file_name"),
        F.lit(environment).alias("environment"),
        F.lit(source).alias("source"),
        day.alias("date_load"),
        ts.alias("tst_trigger_control"),
        F.col("flag").cast("double").alias("flag"),
        stamp.alias("timestamp_load"),
        F.col("row_count").cast("bigint").alias("row_count"),
    )


def latest_trigger(triggers: DataFrame) -> DataFrame:
    """L3: newest status row per table (highest id) and its flag."""
    return triggers.groupBy("id_type_file", "file_name").agg(
        F.max("id_trigger").alias("id_trigger"),
        F.max_by("flag", "id_trigger").alias("flag"),
    )


def validation_logs(verdicts: DataFrame, run_ts=None, source: str = DEFAULT_SOURCE,
                    id_base: int = 0) -> DataFrame:
    """L2: one error row per table at its first failed stage, linked to the
    table's newest status row (for a column-count mismatch that is the
    'read' row, since that failure writes no status row).

    One chain, no self-join: a window per table over the per-(table, stage)
    summary (at most four rows per table) gives the table's status, and the
    newest status id is ``id_base + table_seq*10 + number of status rows``."""
    ts, day, stamp = run_clock(run_ts)
    per_table = Window.partitionBy(*TABLE_KEYS)
    s = stage_summary(verdicts).select(
        *TABLE_KEYS, "stage", "type_validation", "validation_msg", "field_name", "incidences",
        F.min(F.when(~F.col("passed"), F.col("stage"))).over(per_table).alias("failed_stage"),
        F.bool_or("unreadable").over(per_table).alias("unreadable"),
        F.bool_or("arity_failed").over(per_table).alias("arity_failed"),
        F.bool_or(F.col("stage") == 3).over(per_table).alias("has_reference"),
    ).where(F.col("stage") == F.col("failed_stage"))
    n_status = F.size(F.filter(_status_flags(), lambda x: x.isNotNull()))
    return s.select(
        (F.lit(id_base) + F.col("table_seq") * 10 + n_status).cast("bigint").alias("id_trigger"),
        F.col("stage").cast("int").alias("validation_id"),
        F.lit(source).alias("source"),
        F.col("type_validation"),
        F.col("table_name").alias("file_name"),
        F.col("validation_msg"),
        F.nullif(F.col("field_name"), F.lit("")).alias("field_name"),
        F.col("incidences").cast("bigint").alias("incidences"),
        final_flag(F.col("failed_stage"), F.col("unreadable")).alias("flag"),
        ts.alias("execution_timestamp"),
        day.alias("date_load"),
        stamp.alias("timestamp_load"),
    )
