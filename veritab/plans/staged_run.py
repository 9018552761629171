"""Staged run (O1): header, technical, referential integrity, functional.

Every table is a job of its own and several run at the same time; only their
verdict rows (a few per rule) reach the driver.  A table that cannot be read
becomes a failed ``read`` verdict, a reference that cannot be read a failed
rule, and the other tables go on.  By default a failing table still gets a
full report (its stopping stage is derived afterwards); ``fail_fast=True``
executes stage by stage and skips the later stages of a failed table (cheaper
for huge tables that fail early).

Per table the work is:
  * one aggregate pass: row count, every type/length/null rule, the
    required-value presence (F1a), the naming pattern (F3) and the cell
    bounds (F4, bounded by a scalar-subquery row count);
  * one grouped pass per key rule (T8), per reference rule (anti-join on
    distinct values), for the required set (F1b/F1c) and the group prefix (F2).
A table whose source cannot prune columns (``TableSpec.single_scan``: CSV, JSON,
JDBC) is read once instead: all of these are counted in one grouped pass
(``single_scan``) and the verdicts are read from its counts.
The driver only handles metadata: catalog rows, rule rows and verdict rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.functions.cells import out_of_bounds, parse_cell
from veritab.functions.names import col, cols
from veritab.functions.rules import Rule, collect_rules, decode_rules
from veritab.operators import single_scan as scan
from veritab.operators.functional import group_prefix_incidences, pattern_predicate, required_counts, required_set
from veritab.operators.header import READ_ERRORS, SPARK_ERRORS, validate_header
from veritab.operators.metadata import select_tables, split_reference
from veritab.operators.references import allowed_values, comparable_keys, reference_violation_count
from veritab.operators.technical import count_if_exprs, key_summary
from veritab.functions.predicates import fast_predicate
from veritab.plans.verdicts import (
    VERDICT_COLUMNS, counted, entry, explode_entries, literal_verdicts, union_all,
)
from veritab.plans.growing import GrowingTable
from veritab.plans.run_store import RunStore, fingerprint
from veritab.session import ensure_checkpoint_dir
from veritab.sources.readers import UNPARSED


@dataclass(frozen=True)
class FunctionalSpec:
    """Functional rules of one table; every column and value is a parameter."""

    group_cols: tuple[str, ...] = ()
    required_column: str | None = None
    required_values: tuple = ()
    all_groups: bool = False
    prefix_column: str | None = None
    prefix: str | None = None
    pattern_column: str | None = None
    pattern: str | None = None
    pattern_mode: str = "literal"
    cell_column: str | None = None
    cell_column_count: int | None = None   # default: the table's column count
    cell_inclusive: bool = False
    cell_flag_unparsable: bool = False      # a non-null cell without letters+digits violates

    def columns_of(self, n_columns: int) -> int:
        return self.cell_column_count if self.cell_column_count is not None else n_columns


@dataclass
class TableSpec:
    table_id: str
    table_name: str
    has_header: bool
    load: Callable[[], DataFrame]
    rules: list[Rule]
    functional: FunctionalSpec | None = None
    #: read the table once for all checks (sources that read whole rows for any column)
    single_scan: bool = False
    #: a table that grows by files: only new files are read
    growing: GrowingTable | None = None


#: formats that read whole rows whichever columns are wanted
ROW_FORMATS = ("csv", "json", "jdbc")


def specs_from_metadata(catalog: DataFrame, rules: DataFrame,
                        loader: Callable[[object], DataFrame],
                        functional: dict[str, FunctionalSpec] | None = None,
                        ids: Sequence[str] | None = None) -> list[TableSpec]:
    """M1 + M3/M6: build table specs from the catalog and rules frames.

    ``loader(catalog_row)`` returns the table's DataFrame (it may raise:
    the header stage reports an unreadable table)."""
    functional = functional or {}
    # metadata rows are few: sorted on the driver, no sort job
    selected = sorted(select_tables(catalog, ids, ordered=False).collect(), key=lambda r: r["id_type_file"])
    decoded = decode_rules(rules)
    if ids is not None:
        decoded = decoded.where(F.col("id_type_file").isin(list(ids)))
    by_table: dict[str, list[Rule]] = {}
    for r in collect_rules(decoded):      # one job for every table's rules
        by_table.setdefault(r.table_id, []).append(r)
    specs = []
    for row in selected:
        tid = row["id_type_file"]
        specs.append(TableSpec(
            table_id=tid, table_name=row["type_file_name"],
            # a null header flag unboxes to false: no header row
            has_header=bool(row["header"]) if row["header"] is not None else False,
            load=(lambda r=row: loader(r)),
            rules=by_table.get(tid, []),
            functional=functional.get(tid),
            single_scan=(row["file_format"] or "").lower() in ROW_FORMATS,
        ))
    return specs


# --------------------------------------------------------------------------
# per-table plan
# --------------------------------------------------------------------------

def _values(values) -> str:
    return ", ".join(str(v) for v in values)


def _msg_type(r: Rule) -> str:
    return f"{r.field_name}: values break the {r.data_type} rule" + (
        f" ({r.rule_error})" if r.rule_error else "")


def _resolve_reference(references: Callable[[str], DataFrame], target: str):
    """(frame, column) of a reference target, or (None, reason) when the
    target table cannot be read or lacks the column: a failed rule, not a
    failed run."""
    try:
        table, column = split_reference(target)
        frame = references(table)
        if frame is None or column not in frame.columns:
            return None, f"reference target {target} not found"
        return frame, column
    except (*READ_ERRORS, ValueError, KeyError):
        return None, f"reference target {target} not found"


class Part(NamedTuple):
    """A verdict frame, its stage and (reference passes) the index of its rule."""
    stage: int
    frame: DataFrame
    rule: int | None = None


def table_parts(spark: SparkSession, spec: TableSpec, seq: int,
                references: Callable[[str], DataFrame], compat: bool = False) -> list[Part]:
    """Verdict frames of one table, lazily planned.

    The first part is the one-pass aggregate (stage 1 and the row-level
    rules of stages 2 and 4); the others are the grouped passes of the
    stage they belong to.

    A functional rule naming a column the table lacks, or a reference
    target that cannot be read, fails that rule (violations NULL) instead
    of the whole run."""
    tid, name = spec.table_id, spec.table_name
    expected = [r.field_name for r in spec.rules]
    hdr = validate_header(spec.load, spec.has_header, expected)

    def e(stage, check_no, rule, column, violations, incidences, passed, message, row_count=None):
        return entry(seq, tid, name, stage, check_no, rule, column, violations, incidences, passed,
                     message, row_count)

    if hdr.raw is None:
        return [Part(1, literal_verdicts(spark, [(seq, tid, name, 1, 1, "read", None, None, 1, False,
                                              hdr.message, None)]))]
    if not hdr.passed:
        one = hdr.raw.agg(F.count(F.lit(1)).cast("bigint").alias("__rows"))
        return [Part(1, explode_entries(one, [e(1, 1, hdr.rule, None, "1", "1", "false",
                                            hdr.message, "__rows")]))]

    df = hdr.frame
    fs = spec.functional
    unparsed = UNPARSED in df.columns
    n_columns = len(df.columns) - unparsed
    present = set(df.columns) - {UNPARSED}
    broken: list[str] = []     # SQL struct entries of rules that cannot run

    def usable(stage, check_no, rule, cols) -> bool:
        lost = [c for c in cols if c not in present]
        if lost:
            broken.append(e(stage, check_no, rule, ", ".join(cols), "CAST(NULL AS BIGINT)", "1", "false",
                            f"column(s) {', '.join(lost)} missing"))
        return not lost

    if fs:
        req_ok = bool(fs.required_column) and usable(4, 1, "required_any",
                                                     fs.group_cols + (fs.required_column,))
        if fs.required_column and not req_ok:
            usable(4, 2, "required_set", fs.group_cols + (fs.required_column,))
        pre_ok = bool(fs.prefix_column) and usable(4, 3, "group_prefix", fs.group_cols + (fs.prefix_column,))
        pat_ok = bool(fs.pattern_column) and usable(4, 4, "pattern", (fs.pattern_column,))
        cell_ok = bool(fs.cell_column) and usable(4, 5, "cell_bounds", (fs.cell_column,))
        fs = FunctionalSpec(
            group_cols=fs.group_cols, all_groups=fs.all_groups,
            required_column=fs.required_column if req_ok else None, required_values=fs.required_values,
            prefix_column=fs.prefix_column if pre_ok else None, prefix=fs.prefix,
            pattern_column=fs.pattern_column if pat_ok else None, pattern=fs.pattern,
            pattern_mode=fs.pattern_mode, cell_column=fs.cell_column if cell_ok else None,
            cell_column_count=fs.cell_column_count, cell_inclusive=fs.cell_inclusive,
            cell_flag_unparsable=fs.cell_flag_unparsable)
    refs = {}
    for i, r in enumerate(spec.rules):
        if r.reference:
            frame, detail = _resolve_reference(references, r.reference)
            if frame is None:
                broken.append(e(3, i + 1, "reference", r.field_name, "CAST(NULL AS BIGINT)", "1", "false",
                                detail))
            else:
                refs[i] = (frame, detail)

    aggs = [F.count(F.lit(1)).cast("bigint").alias("__rows")]
    aggs += count_if_exprs(spec.rules, compat, prefix="__t")
    # counted beside a tested column: a scan of the record text alone is not allowed
    check_records = unparsed and bool(spec.rules)
    if check_records:
        aggs.append(F.count_if(F.col(UNPARSED).isNotNull()).alias("__records"))
    if fs and fs.required_column:
        aggs.append(F.count_if(col(fs.required_column).isin(list(fs.required_values))).alias("__req"))
    if fs and fs.pattern_column:
        aggs.append(F.count_if(pattern_predicate(fs.pattern_column, fs.pattern, fs.pattern_mode))
                    .alias("__pat"))
    counts = None
    if spec.single_scan or spec.growing:
        items = _items(df, spec, fs, refs, compat, n_columns)
        kinds = [ref.select(col(c)).schema[0].dataType for ref, c in refs.values()]
        mark = fingerprint(spec.rules, fs, compat, df.columns, kinds)
        counts = (spec.growing.counts(items, mark, None if spec.has_header else df.columns) if spec.growing
                  else items.counted(df))
        one = counts.frame.agg(*_totals(counts, spec, fs, check_records))
    else:
        if fs and fs.cell_column:
            # row count as a scalar subquery: evaluated once, inlined as a literal
            row_count = df.select(F.count(F.lit(1)).cast("bigint")).scalar()
            _, row_num, col_num = parse_cell(col(fs.cell_column))
            bad_cell = out_of_bounds(row_num, col_num, row_count, fs.columns_of(n_columns), fs.cell_inclusive)
            if fs.cell_flag_unparsable:
                bad_cell = bad_cell | (col(fs.cell_column).isNotNull() & (row_num.isNull() | col_num.isNull()))
            aggs.append(F.count_if(bad_cell).alias("__cell"))
        one = df.agg(*aggs)

    entries = [e(1, 1, "header", None, "0", "0", "true", None, "__rows")]
    for i, r in enumerate(spec.rules):
        v = f"__t{i}"
        inc, ok = counted(v)
        entries.append(e(2, i + 1, f"type:{r.kind}", r.field_name, v, inc, ok, _msg_type(r)))
    if check_records:
        inc, ok = counted("__records")
        entries.append(e(2, 0, "record", None, "__records", inc, ok, "records with too many or too few fields"))
    if fs and fs.required_column:
        missing = "CASE WHEN __req = 0 THEN 1 ELSE 0 END"
        entries.append(e(4, 1, "required_any", ", ".join(fs.group_cols + (fs.required_column,)),
                         missing, missing, "__req > 0",
                         f"no row has {fs.required_column} in ({_values(fs.required_values)})"))
    if fs and fs.pattern_column:
        inc, ok = counted("__pat")
        entries.append(e(4, 4, "pattern", fs.pattern_column, "__pat", inc, ok,
                         f"not every {fs.pattern_column} starts with {fs.pattern}"))
    if fs and fs.cell_column:
        inc, ok = counted("__cell")
        entries.append(e(4, 5, "cell_bounds", fs.cell_column, "__cell", inc, ok,
                         f"{fs.cell_column} points outside the table"))
    entries.extend(broken)
    frames = [Part(1, explode_entries(one, entries))]

    # Key uniqueness, one grouped pass
    keys = [r.field_name for r in spec.rules if r.is_pk]
    if keys:
        ks = counts.duplicated_keys() if counts else key_summary(df, keys)
        inc, ok = counted("duplicated_keys")
        frames.append(Part(2, explode_entries(ks, [e(2, len(spec.rules) + 1, "primary_key", ", ".join(keys),
                                                 "duplicated_keys", inc, ok,
                                                 "primary key values are not unique")])))

    # R: one anti-join on distinct values per reference rule
    for i, r in enumerate(spec.rules):
        if i not in refs:
            continue
        ref_frame, ref_column = refs[i]
        if counts:
            _, allowed_key = comparable_keys(df, r.field_name, ref_frame, ref_column)
            cnt = counts.missing(f"ref{i}", allowed_values(ref_frame, ref_column, lambda v: allowed_key(v).cast("string")))
        else:
            cnt = reference_violation_count(df, r.field_name, ref_frame, ref_column)
        inc, ok = counted("violations")
        frames.append(Part(3, rule=i, frame=explode_entries(cnt, [e(3, i + 1, "reference", r.field_name,
                                                  "violations", inc, ok,
                                                  f"{r.field_name}: values outside {r.reference}")])))

    # Rows per (group, required value), then per group
    if fs and fs.required_column:
        k = len(required_set(fs.required_values))
        if counts:
            per_group = counts.required([f"req{i}" for i in range(k)])
        else:
            found = required_counts(df, list(fs.group_cols), fs.required_column, fs.required_values, fs.all_groups)
            per_group = found.select(
                F.size(F.filter("counts", lambda c: c["n"] > 0)).alias("__present"),
                F.size(F.filter("counts", lambda c: c["n"] > 1)).alias("__excess"))
        one_set = per_group.agg(
            (F.coalesce(F.sum("__excess"), F.lit(0)) + F.count_if(F.col("__present") != k)).alias("__bad"))
        inc, ok = counted("__bad")
        frames.append(Part(4, explode_entries(one_set, [e(
            4, 2, "required_set", ", ".join(fs.group_cols + (fs.required_column,)), "__bad", inc, ok,
            f"each ({', '.join(fs.group_cols)}) needs exactly one row per ({_values(fs.required_values)})")])))

    # prefix per group
    if fs and fs.prefix_column:
        gp = (counts.prefix_incidences() if counts else
              group_prefix_incidences(df, list(fs.group_cols), fs.prefix_column, fs.prefix))
        frames.append(Part(4, explode_entries(gp, [e(
            4, 3, "group_prefix", ", ".join(fs.group_cols + (fs.prefix_column,)), "incidences",
            "incidences", "passed",
            f"some ({', '.join(fs.group_cols)}) have no {fs.prefix_column} starting with {fs.prefix}")])))

    return frames


def _items(df: DataFrame, spec: TableSpec, fs: FunctionalSpec | None, refs: dict, compat: bool,
           n_columns: int) -> scan.Items:
    """Everything that the checks of a table count."""
    items = scan.Items()
    items.add(scan.ROWS)
    for i, r in enumerate(spec.rules):
        items.add(f"type{i}", when=fast_predicate(r, compat))
    if UNPARSED in df.columns:
        items.add("records", when=F.col(UNPARSED).isNotNull())
    keys = [r.field_name for r in spec.rules if r.is_pk]
    if keys:
        items.add(scan.KEY, scan.joint_key(df, keys))
    for i, (ref_frame, ref_column) in refs.items():
        name = spec.rules[i].field_name
        tested_key, _ = comparable_keys(df, name, ref_frame, ref_column)
        items.add(f"ref{i}", tested_key(col(name)), col(name).isNotNull())
    if fs:
        group = scan.joint_key(df, list(fs.group_cols)) if fs.group_cols else F.lit("")
        if fs.required_column:
            kind = df.select(col(fs.required_column)).schema[0].dataType
            for i, v in enumerate(required_set(fs.required_values)):
                items.add(f"req{i}", group, col(fs.required_column) == F.lit(v).try_cast(kind))
            if fs.all_groups:
                items.add(scan.GROUP, group)
        if fs.prefix_column:
            hit = F.coalesce(col(fs.prefix_column).startswith(fs.prefix), F.lit(False))
            items.add(scan.GROUP_PREFIX, group, ~hit)
            items.add(scan.GROUP_PREFIX + "+", group, hit)
        if fs.pattern_column:
            items.add("pattern", when=pattern_predicate(fs.pattern_column, fs.pattern, fs.pattern_mode))
        if fs.cell_column:
            _, row_num, col_num = parse_cell(col(fs.cell_column))
            bad = F.coalesce(out_of_bounds(F.lit(-1), col_num, 0, fs.columns_of(n_columns), fs.cell_inclusive), F.lit(False))
            if fs.cell_flag_unparsable:
                bad = bad | (col(fs.cell_column).isNotNull() & (row_num.isNull() | col_num.isNull()))
            items.add(scan.CELL, when=bad)
            items.add(scan.CELL_ROW, row_num, ~bad & row_num.isNotNull())
    return items


def _totals(counts: scan.Counts, spec: TableSpec, fs: FunctionalSpec | None, check_records: bool) -> list:
    """The one-row aggregate of the row rules, from the counts."""
    aggs = [counts.total(scan.ROWS).alias("__rows")]
    aggs += [counts.total(f"type{i}").alias(f"__t{i}") for i in range(len(spec.rules))]
    if check_records:
        aggs.append(counts.total("records").alias("__records"))
    if fs and fs.required_column:
        n = sum((counts.total(f"req{i}") for i in range(len(required_set(fs.required_values)))), F.lit(0))
        aggs.append(n.alias("__req"))
    if fs and fs.pattern_column:
        aggs.append(counts.total("pattern").alias("__pat"))
    if fs and fs.cell_column:
        aggs.append(counts.cells_outside(fs.cell_inclusive).alias("__cell"))
    return aggs


def table_verdicts(spark: SparkSession, spec: TableSpec, seq: int,
                   references: Callable[[str], DataFrame], compat: bool = False) -> DataFrame:
    """Verdict rows of one table, all stages, as one lazy frame."""
    parts = table_parts(spark, spec, seq, references, compat)
    return union_all([p.frame for p in parts]).select(*VERDICT_COLUMNS)


#: tables validated at the same time (each is a Spark job of its own)
TABLES_AT_ONCE = 8


def run_verdicts(spark: SparkSession, specs: Sequence[TableSpec],
                 references: Callable[[str], DataFrame], compat: bool = False,
                 fail_fast: bool = False, tables_at_once: int = TABLES_AT_ONCE,
                 store: RunStore | None = None) -> DataFrame:
    """Verdict frame of all tables, in the order of ``specs``.

    With a ``store`` each finished table is kept there, and a table that an
    interrupted run of the same id finished is not validated again.

    Runs one job per table, ``tables_at_once`` at the same time.  The frame
    holds the finished verdict rows, so nothing that derives from it repeats
    a check.  With ``fail_fast`` the grouped passes of the stages after a
    table's first failure are never executed."""
    from pyspark import InheritableThread

    rows: dict[int, list[tuple]] = {}
    errors: list[BaseException] = []
    marks = {spec.table_id: fingerprint(spec.table_name, spec.has_header, spec.rules, spec.functional, compat, fail_fast)
             for spec in specs}
    done = store.finished() if store else {}
    todo = []
    for seq, spec in enumerate(specs, start=1):
        kept = done.get((spec.table_id, marks[spec.table_id]))
        if kept is None:
            todo.insert(0, (seq, spec))
        else:
            rows[seq] = [(seq, *r[1:]) for r in kept]

    def work() -> None:
        while todo and not errors:
            try:
                seq, spec = todo.pop()
            except IndexError:
                return
            try:
                found = _table_rows(spark, spec, seq, references, compat, fail_fast)
                if store:
                    store.put(spec.table_id, marks[spec.table_id], found)
                rows[seq] = found
            except BaseException as exc:  # raised again below, in the caller's thread
                errors.append(exc)

    threads = [InheritableThread(work) for _ in range(max(1, min(tables_at_once, len(todo))))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return literal_verdicts(spark, [r for seq in sorted(rows) for r in rows[seq]])


def _table_rows(spark: SparkSession, spec: TableSpec, seq: int, references: Callable[[str], DataFrame],
                compat: bool, fail_fast: bool) -> list[tuple]:
    """Verdict rows of one table; read failures become verdicts."""
    unreadable = [(seq, spec.table_id, spec.table_name, 1, 1, "read", None, None, 1, False,
                   "table could not be read", None)]
    try:
        parts = table_parts(spark, spec, seq, references, compat)
    except SPARK_ERRORS:
        return unreadable
    if not fail_fast:
        try:
            return [tuple(r) for r in union_all([p.frame for p in parts]).select(*VERDICT_COLUMNS).collect()]
        except SPARK_ERRORS:
            pass  # one of the parts fails: run them one by one to see which
    rows: list[tuple] = []
    for stage in (1, 2, 3, 4):
        if fail_fast and any(not r[_PASSED] for r in rows):
            break
        for part in (p for p in parts if p.stage == stage):
            try:
                rows += [tuple(r) for r in part.frame.select(*VERDICT_COLUMNS).collect()]
            except SPARK_ERRORS:
                if part.rule is None:
                    return unreadable  # the table itself cannot be scanned
                # the tested table was read in stage 1: the reference fails
                rule = spec.rules[part.rule]
                rows.append((seq, spec.table_id, spec.table_name, 3, part.rule + 1, "reference", rule.field_name,
                             None, 1, False, f"reference target {rule.reference} could not be read", None))
    if fail_fast:
        stop = min((r[_STAGE] for r in rows if not r[_PASSED]), default=4)
        rows = [r for r in rows if r[_STAGE] <= stop]
    return rows


_STAGE, _PASSED = VERDICT_COLUMNS.index("stage"), VERDICT_COLUMNS.index("passed")


def validate_and_log(spark: SparkSession, specs: Sequence[TableSpec],
                     references: Callable[[str], DataFrame], trigger_path: str, log_path: str,
                     run_ts=None, environment: str | None = None, source: str | None = None,
                     compat: bool = False, fail_fast: bool = False, run_id: str | None = None,
                     tables_at_once: int = TABLES_AT_ONCE, store_path: str | None = None,
                     catalog: DataFrame | None = None,
                     sink: Callable[[DataFrame, DataFrame], None] | None = None) -> DataFrame:
    """The whole run (O1 + L1/L2): validate every table and publish the status
    rows below ``trigger_path`` and the error rows below ``log_path`` together.

    Finished tables are kept below ``store_path`` (default: the checkpoint
    folder), so a run that is started again under its ``run_id`` after it was cut
    off validates the others only; after a run was published, the same id starts anew and
    replaces its rows.  With the ``catalog`` the declared constraints of the log
    tables are checked before anything becomes visible.  ``sink`` gets the
    published status and error rows, for example to append them to catalog or
    JDBC tables with ``append_rows``.
    Returns the per-table status (flag, stages passed, row count)."""
    import uuid

    from veritab.functions.constants import DEFAULT_ENVIRONMENT, DEFAULT_SOURCE
    from veritab.operators.metadata import log_constraint_violations
    from veritab.plans import logs, publication

    run_id = run_id or uuid.uuid4().hex
    published = publication.commits(spark, trigger_path).where(F.col("run_id") == run_id).count()
    root = store_path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/veritab-runs"
    store = RunStore(spark, root, run_id, published)
    verdicts = run_verdicts(spark, specs, references, compat, fail_fast, tables_at_once, store)
    env = environment or DEFAULT_ENVIRONMENT
    src = source or DEFAULT_SOURCE

    def make_logs(id_base: int) -> tuple[DataFrame, DataFrame]:
        return (logs.trigger_rows(verdicts, run_ts, env, src, id_base),
                logs.validation_logs(verdicts, run_ts, src, id_base))

    def check(triggers: DataFrame, errors: DataFrame) -> None:
        if catalog is not None:
            broken = log_constraint_violations(catalog, triggers, errors).where("not passed").collect()
            if broken:
                raise publication.LogConstraintError("; ".join(
                    f"{r['table_name']}.{r['column_name']}: {r['violations']} violations of {r['kind']}" for r in broken))
        if sink is not None:
            accepted.append((triggers, errors))

    accepted: list[tuple[DataFrame, DataFrame]] = []
    publication.publish(spark, run_id, make_logs, trigger_path, log_path, run_ts, check)
    for triggers, errors in accepted:
        sink(triggers, errors)
    return logs.table_status(verdicts)
