"""Staged run over CSV fixtures written by the tests: every flag (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from template_fixtures import NAMES, TEMPLATE_CODES, TEMPLATE_COLUMNS, passing_rows, write_csv
from veritab.functions.constants import (
    TEMPLATE_CELL_COLUMN, TEMPLATE_GROUP_COLUMNS, TEMPLATE_GROUP_PREFIX, TEMPLATE_PATTERN,
    TEMPLATE_PATTERN_COLUMN, TEMPLATE_REQUIRED_COLUMN, TEMPLATE_REQUIRED_VALUES,
)
from veritab.plans import logs
from veritab.plans.staged_run import FunctionalSpec, run_verdicts, specs_from_metadata
from veritab.schemas import FILE_CONFIGURATION, SEMANTIC_LAYER, TD_TEMPLATES
from veritab.plans import publication
from veritab.sources import read_table

TEMPLATE_RULES = FunctionalSpec(
    group_cols=TEMPLATE_GROUP_COLUMNS, required_column=TEMPLATE_REQUIRED_COLUMN,
    required_values=TEMPLATE_REQUIRED_VALUES, prefix_column=TEMPLATE_REQUIRED_COLUMN,
    prefix=TEMPLATE_GROUP_PREFIX, pattern_column=TEMPLATE_PATTERN_COLUMN, pattern=TEMPLATE_PATTERN,
    cell_column=TEMPLATE_CELL_COLUMN)


def mutate(rows, i, **kw):
    rows = [dict(r) for r in rows]
    rows[i].update(kw)
    return rows


# id -> (name, rows, header, expected flag, failing column or None)
def fixtures():
    ok = passing_rows()
    return {
        "00001": ("pass_all", ok, True, 2.0, None),
        "00002": ("bad_int", mutate(ok, 3, status="x1"), True, 32.0, "status"),
        "00003": ("bad_decimal", mutate(ok, 3, row_y="12345.1234"), True, 32.0, "row_y"),
        "00004": ("bad_date", mutate(ok, 3, date_data="2025-02-44 +01"), True, 32.0, "date_data"),
        "00005": ("bad_null", mutate(ok, 3, column_x=None), True, 32.0, "column_x"),
        "00006": ("bad_length", mutate(ok, 3, excel_cell="abcde"), True, 32.0, "excel_cell"),
        "00007": ("date_null", mutate(ok, 3, date_data=None), True, 2.0, None),
        "00008": ("bad_reference", mutate(ok, 3, template_code="Z"), True, 33.0, "template_code"),
        "00009": ("null_reference", ok, True, 2.0, None),
        "00010": ("missing_required", [r for r in ok if r["data_name"] != "excel_title" or r["sheet"] != "S2"],
                  True, 34.0, "data_name"),
        "00011": ("excess_required", ok + [dict(ok[0], excel_cell="a2")], True, 34.0, "data_name"),
        "00012": ("no_required", [dict(r, data_name="ccy_" + str(i)) for i, r in enumerate(ok)], True, 34.0,
                  "data_name"),
        "00013": ("no_prefix_group", [r for r in ok if not (r["data_name"] == "ccy_amount" and r["sheet"] == "S1")],
                  True, 34.0, "data_name"),
        "00014": ("bad_pattern", mutate(ok, 2, column_x="ac1"), True, 34.0, "column_x"),
        "00015": ("cell_bounds", mutate(ok, 2, excel_cell="a10"), True, 34.0, "excel_cell"),
        "00021": ("cell_last_column", mutate(ok, 2, excel_cell="AH1"), True, 34.0, "excel_cell"),
        "00016": ("header_case", ok, "case", 31.0, None),
        "00017": ("no_header", ok, False, 2.0, None),
        "00018": ("no_header_arity", ok, "arity", 31.0, None),
        "00019": ("unreadable", None, True, 30.0, None),
        "00020": ("empty", [], True, 34.0, "data_name"),
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("fixtures")
    fx = fixtures()
    cat_rows, rule_rows = [], []
    for tid, (name, rows, header, _, _) in fx.items():
        path = str(base / f"{name}.csv")
        if rows is not None:
            if header == "case":
                write_csv(path, rows, names=[n.upper() if n == "sheet" else n for n in NAMES])
            elif header == "arity":
                write_csv(path, rows, header=False, names=NAMES + ["extra"])
            else:
                write_csv(path, rows, header=bool(header))
        has_header = header is not False and header != "arity"
        if header == "case":
            has_header = True
        cat_rows.append((tid, name, "csv", "fixtures", path, None, ",", has_header, True, "tester"))
        for pos, (col, dt, length, nullable) in enumerate(TEMPLATE_COLUMNS, 1):
            ref = "td_templates.template_code" if col == "template_code" else None
            rule_rows.append((tid, pos, col, None, False, dt, length, nullable, None, None, ref, None))
    catalog = spark.createDataFrame(cat_rows, FILE_CONFIGURATION)
    rules = spark.createDataFrame(rule_rows, SEMANTIC_LAYER)
    td = spark.createDataFrame([("s", c, "t") for c in TEMPLATE_CODES] + [("s", None, "null code")], TD_TEMPLATES)

    def load(row):
        return read_table(spark, row["origin_path"], row["file_format"], header=row["header"],
                          separator=row["separator"])

    specs = specs_from_metadata(catalog, rules, load, {tid: TEMPLATE_RULES for tid in fx})
    refs = lambda name: {"td_templates": td}[name]
    verdicts = run_verdicts(spark, specs, refs).cache()
    return fx, verdicts, specs, refs


def test_flags(run):
    fx, verdicts, _, _ = run
    got = {r["table_id"]: r["flag"] for r in logs.table_status(verdicts).collect()}
    assert got == {tid: f[3] for tid, f in fx.items()}


def test_failing_columns(run):
    fx, verdicts, _, _ = run
    failing = {}
    for r in verdicts.where(~F.col("passed")).collect():
        failing.setdefault(r["table_id"], set()).update((r["column_name"] or "").split(", "))
    for tid, (name, _, _, flag, col) in fx.items():
        if col is not None:
            assert col in failing[tid], name
        if flag == 32.0:   # one fault, one column
            assert failing[tid] == {col}, name


def test_progress(run):
    fx, verdicts, _, _ = run
    got = {r["table_id"]: r["stages_passed"] for r in logs.progress(verdicts).collect()}
    expect = {2.0: 4, 30.0: 0, 31.0: 0, 32.0: 1, 33.0: 2, 34.0: 3}
    assert got == {tid: expect[f[3]] for tid, f in fx.items()}


def test_trigger_rows_sequences(run):
    fx, verdicts, _, _ = run
    seqs = {}
    for r in logs.trigger_rows(verdicts, "2025-01-01 00:00:00").orderBy("id_trigger").collect():
        seqs.setdefault(r["id_type_file"], []).append(r["flag"])
    assert seqs["00001"] == [1.0, 1.2, 1.2, 1.3, 1.4, 2.0]
    assert seqs["00002"] == [1.0, 1.2, 32.0]
    assert seqs["00008"] == [1.0, 1.2, 1.2, 33.0]
    assert seqs["00014"] == [1.0, 1.2, 1.2, 1.3, 34.0]
    assert seqs["00016"] == [1.0, 31.0]
    assert seqs["00018"] == [1.0]                    # column-count mismatch: error row only
    assert seqs["00019"] == [30.0]


def test_validation_logs(run):
    fx, verdicts, _, _ = run
    rows = {r["file_name"]: r for r in logs.validation_logs(verdicts, "2025-01-01 00:00:00").collect()}
    assert set(rows) == {f[0] for f in fx.values() if f[3] != 2.0}
    assert rows["bad_int"]["field_name"] == "status" and rows["bad_int"]["flag"] == 32.0
    assert rows["no_prefix_group"]["incidences"] == 1
    assert rows["no_header_arity"]["flag"] == 31.0
    trig = {r["id_type_file"]: r["id_trigger"] for r in
            logs.latest_trigger(logs.trigger_rows(verdicts, "2025-01-01 00:00:00")).collect()}
    assert rows["no_header_arity"]["id_trigger"] == trig["00018"]


def test_empty_table_passes_technical(run):
    fx, verdicts, _, _ = run
    s = {(r["stage"], r["passed"]) for r in logs.stage_summary(verdicts).where("table_id = '00020'").collect()}
    assert (2, True) in s and (4, False) in s        # E9, then F1a fails on no rows


def test_fail_fast_gives_same_flags(spark, run):
    fx, verdicts, specs, refs = run
    chosen = [sp for sp in specs if sp.table_id in ("00001", "00002", "00008", "00014", "00019")]
    fast = run_verdicts(spark, chosen, refs, fail_fast=True)
    flags = {r["table_id"]: r["flag"] for r in logs.table_status(fast).collect()}
    assert flags == {sp.table_id: fx[sp.table_id][3] for sp in chosen}
    # stages after the first failure are not reported
    stages = {(r["table_id"], r["stage"]) for r in fast.collect()}
    assert ("00002", 3) not in stages and ("00002", 4) not in stages
    assert ("00008", 4) not in stages


def test_tables_at_once_does_not_matter(spark, run):
    fx, verdicts, specs, refs = run
    chosen = [sp for sp in specs if sp.table_id in ("00001", "00002", "00016", "00019")]
    one = run_verdicts(spark, chosen, refs, tables_at_once=1)
    many = run_verdicts(spark, chosen, refs, tables_at_once=4)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


@pytest.mark.parametrize("fail_fast", [False, True])
def test_read_failures_stay_with_their_table(spark, tmp_path, fail_fast):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec
    from veritab.sources import read_table

    # the schema resolves (explicit schema) but the scan fails
    bad = tmp_path / "corrupt.parquet"
    bad.write_bytes(b"PAR1 this is not parquet PAR1")
    corrupt = spark.read.schema("a string").parquet(str(bad))
    good = spark.createDataFrame([("1",)], "a string")
    rules = [make_rule("a", "INT", 3, position=1)]
    to_corrupt = [make_rule("a", "INT", 3, position=1, reference="broken.a")]
    to_good = [make_rule("a", "INT", 3, position=1, reference="good.a")]
    specs = [
        TableSpec("t1", "corrupt", True, lambda: corrupt, rules),
        TableSpec("t2", "fine", True, lambda: good, rules),
        TableSpec("t3", "odd_format", True, lambda: read_table(spark, "x", "xlsx"), rules),
        TableSpec("t4", "bad_reference", True, lambda: good, to_corrupt),
        TableSpec("t5", "lost", True, lambda: spark.read.parquet(str(tmp_path / "nowhere")), rules),
        TableSpec("t6", "fine_too", True, lambda: good, to_good),
    ]
    v = run_verdicts(spark, specs, {"broken": corrupt, "good": good}.get, fail_fast=fail_fast)
    flags = {r["table_id"]: r["flag"] for r in logs.table_status(v).collect()}
    assert flags == {"t1": 30.0, "t2": 2.0, "t3": 30.0, "t4": 33.0, "t5": 30.0, "t6": 2.0}
    assigned = {}
    for r in logs.stage_flags(v).orderBy("stage").collect():
        assigned.setdefault(r["table_id"], []).append(r["flag"])
    assert assigned["t1"] == [30.0] and assigned["t2"] == [1.2, 1.2, 1.4]
    assert assigned["t4"] == [1.2, 1.2, 33.0] and assigned["t6"] == [1.2, 1.2, 1.3, 1.4]


def test_errors_of_the_caller_are_not_read_failures(spark):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec

    def broken_loader():
        raise TypeError("a bug in the loader")

    with pytest.raises(TypeError):
        run_verdicts(spark, [TableSpec("t1", "t", True, broken_loader, [make_rule("a", "INT", 3)])], lambda name: None)


def test_no_flag_after_the_stop(run):
    fx, verdicts, _, _ = run
    flags = {}
    for r in logs.stage_flags(verdicts).orderBy("stage").collect():
        flags.setdefault(r["table_id"], []).append(r["flag"])
    assert flags["00001"] == [1.2, 1.2, 1.3, 1.4]
    assert flags["00002"] == [1.2, 32.0]
    assert flags["00008"] == [1.2, 1.2, 33.0]
    assert flags["00019"] == [30.0]


def test_missing_columns_and_reference_fail_the_rule_only(spark):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec

    df = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    spec = TableSpec("t1", "t", True, lambda: df,
                     [make_rule("a", "INT", 3, position=1, reference="nowhere.code"),
                      make_rule("b", "STRING", 3, position=2)],
                     FunctionalSpec(pattern_column="missing_col", pattern="_c", cell_column="b"))
    v = {(r["stage"], r["rule"]): r for r in run_verdicts(spark, [spec], lambda name: None).collect()}
    assert v[(3, "reference")]["passed"] is False and v[(3, "reference")]["violations"] is None
    assert v[(4, "pattern")]["message"] == "column(s) missing_col missing"
    assert v[(2, "type:INT")]["passed"] and v[(4, "cell_bounds")]["violations"] == 0


def test_validate_and_log_appends_both_logs(spark, run, tmp_path):
    from veritab.plans.staged_run import validate_and_log

    fx, verdicts, specs, refs = run
    chosen = [sp for sp in specs if sp.table_id in ("00001", "00002", "00019")]
    trig, log = str(tmp_path / "trigger_control"), str(tmp_path / "process_validation_logs")
    st = {r["table_id"]: r["flag"] for r in
          validate_and_log(spark, chosen, refs, trig, log, "2025-01-01 00:00:00").collect()}
    assert st == {"00001": 2.0, "00002": 32.0, "00019": 30.0}
    first = spark.read.parquet(trig)
    assert first.count() == 6 + 3 + 1
    validate_and_log(spark, chosen, refs, trig, log, "2025-01-02 00:00:00")       # second run appends
    ids = [r[0] for r in spark.read.parquet(trig).select("id_trigger").collect()]
    assert len(ids) == 20 and len(set(ids)) == 20                                # ids never collide
    # a repeated run replaces its own rows
    for _ in range(2):
        validate_and_log(spark, chosen, refs, trig, log, "2025-01-03 00:00:00", run_id="third")
    assert spark.read.parquet(trig).count() == 30 and spark.read.parquet(log).count() == 6
    assert publication.read_log(spark, trig, trig).count() == 30 and publication.read_log(spark, log, trig).count() == 6
    errors = spark.read.parquet(log)
    # every error row points at an existing status row
    assert errors.join(spark.read.parquet(trig), "id_trigger", "left_anti").count() == 0


def small_specs(spark, n, before=lambda k: None):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec

    def load(k):
        before(k)
        return spark.range(k + 1).selectExpr("cast(id as string) a")

    return [TableSpec(f"{k:05d}", f"t{k}", True, lambda k=k: load(k), [make_rule("a", "INT", 1, nullable=k != 2)]) for k in range(n)]


def test_a_restarted_run_validates_unfinished_tables_only(spark, tmp_path):
    from veritab.plans.staged_run import validate_and_log

    trig, log, store = (str(tmp_path / n) for n in ("t", "l", "s"))
    loaded = []

    def dies_at_four(k):
        loaded.append(k)
        if k == 3 and len(loaded) == 4:
            raise RuntimeError("driver lost")

    def run():
        return validate_and_log(spark, small_specs(spark, 6, dies_at_four), None, trig, log, "2025-01-01 00:00:00",
                                run_id="r", tables_at_once=1, store_path=store)

    with pytest.raises(RuntimeError):
        run()
    assert loaded == [0, 1, 2, 3] and not (tmp_path / "t").exists()
    status = {r["table_id"]: r["row_count"] for r in run().collect()}
    assert loaded[4:] == [3, 4, 5]
    assert status == {f"{k:05d}": k + 1 for k in range(6)}
    run()   # published: the same id starts anew
    assert loaded[7:] == [0, 1, 2, 3, 4, 5]
    assert publication.read_log(spark, trig, trig).count() == spark.read.parquet(trig).count()


def test_both_logs_become_visible_together(spark, tmp_path, monkeypatch):
    from veritab.plans.staged_run import validate_and_log

    trig, log = str(tmp_path / "t"), str(tmp_path / "l")
    run = lambda **k: validate_and_log(spark, small_specs(spark, 3), None, trig, log, "2025-01-01 00:00:00", **k)
    run(run_id="a")
    seen = publication.read_log(spark, trig, trig).count(), publication.read_log(spark, log, trig)
    # the status rows are written, their constraints fail: neither log shows the run
    catalog = spark.createDataFrame([], FILE_CONFIGURATION)
    with pytest.raises(publication.LogConstraintError, match="foreign_key"):
        run(run_id="b", catalog=catalog)
    real = publication.commits
    monkeypatch.setattr(logs, "validation_logs", lambda *a, **k: spark.range(1).selectExpr("raise_error('lost') as x"))
    with pytest.raises(Exception, match="lost"):
        run(run_id="c")
    assert {r["run_id"] for r in real(spark, trig).collect()} == {"a"}
    assert publication.read_log(spark, trig, trig).count() == seen[0]
    assert {r["run_id"] for r in publication.read_log(spark, log, trig).select("run_id").collect()} <= {"a"}


def test_ids_without_a_look_at_other_runs(spark, tmp_path):
    from veritab.plans.staged_run import validate_and_log

    base = publication.id_base
    assert base("x", "2025-01-01 00:00:00") < base("y", "2025-01-01 00:00:01") < base("x") < 1 << 63
    same = {base(f"run {i}", "2025-01-01 00:00:00") for i in range(40)}
    assert len(same) == 40 and all(b % (1 << 18) == 0 for b in same)
    trig, log = str(tmp_path / "t"), str(tmp_path / "l")
    # two runs of one second whose hashes collide
    publication_base = {0: 5 << 18, 1: 9 << 18}
    import unittest.mock as mock

    with mock.patch.object(publication, "id_base", lambda run, ts=None, turn=0: publication_base[turn]):
        for run in ("a", "b"):
            validate_and_log(spark, small_specs(spark, 2), None, trig, log, "2025-01-01 00:00:00", run_id=run)
    ids = [r[0] for r in publication.read_log(spark, trig, trig).select("id_trigger").collect()]
    assert len(ids) == len(set(ids)) and {i >> 18 for i in ids} == {5, 9}


def test_a_sink_gets_the_published_rows(spark, run, tmp_path):
    from veritab.plans.staged_run import validate_and_log
    from veritab.sources import append_rows

    _, _, specs, refs = run
    names = {"t": f"trig_{tmp_path.name}", "l": f"log_{tmp_path.name}"}
    names = {k: "".join(c if c.isalnum() else "_" for c in v) for k, v in names.items()}
    validate_and_log(spark, specs[:3], refs, str(tmp_path / "t"), str(tmp_path / "l"), run_id="a",
                     sink=lambda t, e: (append_rows(t, names["t"], as_table=True), append_rows(e, names["l"], as_table=True)))
    assert spark.table(names["t"]).count() == publication.read_log(spark, str(tmp_path / "t"), str(tmp_path / "t")).count()
    assert spark.table(names["l"]).count() == 2
    for n in names.values():
        spark.sql(f"DROP TABLE {n}")


def test_command_line_run(spark, tmp_path, capsys):
    """python -m veritab over CSV metadata and CSV tables."""
    import csv as _csv

    from veritab.__main__ import main

    ok = passing_rows()
    good = write_csv(str(tmp_path / "good.csv"), ok)
    bad = write_csv(str(tmp_path / "bad.csv"), mutate(ok, 1, row_y="1.2"))
    cat = tmp_path / "catalog.csv"
    with open(cat, "w", newline="") as fh:
        w = _csv.writer(fh)
        w.writerow([f.name for f in FILE_CONFIGURATION.fields])
        w.writerow(["00018", "good", "csv", "src", good, "", ",", "true", "true", "u"])
        w.writerow(["00013", "bad", "csv", "src", bad, "", ",", "true", "true", "u"])
    rules = tmp_path / "rules.csv"
    with open(rules, "w", newline="") as fh:
        w = _csv.writer(fh)
        w.writerow([f.name for f in SEMANTIC_LAYER.fields])
        for tid in ("00018", "00013"):
            for pos, (col, dt, length, nullable) in enumerate(TEMPLATE_COLUMNS, 1):
                ref = "td_templates.template_code" if col == "template_code" else ""
                w.writerow([tid, pos, col, "", "false", dt, length, str(nullable).lower(), "", "", ref, ""])
    td = tmp_path / "td.csv"
    td.write_text("source,template_code,template_text\n" + "".join(f"s,{c},t\n" for c in TEMPLATE_CODES))
    code = main(["--catalog", str(cat), "--rules", str(rules), "--reference", f"td_templates={td}",
                 "--trigger-log", str(tmp_path / "trig"), "--error-log", str(tmp_path / "err"),
                 "--template-rules"])
    out = capsys.readouterr().out
    assert code == 0
    assert "00013 bad: 1 of 4 stages passed, flag 32.0" in out
    assert "00018 good: 4 of 4 stages passed, flag 2.0" in out
    assert spark.read.parquet(str(tmp_path / "err")).count() == 1


def _func_fixture():
    """Like the validated system's functional fault table: no required data_name at all
    (F1a), one group without a ccy value (F2: 1 group), one column_x not starting
    with _c (F3), six cells out of bounds (F4) -> incidences 4, flag 34."""
    rows = []
    for g, (code, sheet) in enumerate([("1", "S1"), ("2", "S2")]):
        for k in range(5):
            i = g * 5 + k
            rows.append({"template_code": code, "sheet": sheet, "excel_cell": f"a{i % 3 + 1}",
                         "column_x": f"_c{i}", "row_y": "1.1234",
                         "data_name": "ccy_rate" if (g == 0 and k == 0) else "my_ccy_field"})
    rows[3]["column_x"] = "Zq_c7"
    for i in (4, 5, 6, 7, 8, 9):
        rows[i]["excel_cell"] = f"b{20 + i}"
    return rows


def _test_fixture():
    """Like the near-clean table: no required data_name (F1a) and three cells at the
    last row (row == row count, rejected by the >= bound) -> incidences 2, flag 34."""
    rows = []
    for i in range(10):
        rows.append({"template_code": "1", "sheet": "S1", "excel_cell": "a10" if i < 3 else "a1",
                     "column_x": f"_c{i}", "row_y": "1.1234", "data_name": "ccy_value"})
    return rows


def test_functional_fixtures_match_derived_outcomes(spark, tmp_path):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec

    rules = [make_rule(n, dt, length, nullable=nul, position=p)
             for p, (n, dt, length, nul) in enumerate(TEMPLATE_COLUMNS, 1)]
    specs = []
    for tid, rows in (("00017", _func_fixture()), ("00018", _test_fixture())):
        path = write_csv(str(tmp_path / f"{tid}.csv"), rows)
        specs.append(TableSpec(tid, f"t{tid}", True,
                               lambda p=path: read_table(spark, p, "csv", header=True), rules, TEMPLATE_RULES))
    v = run_verdicts(spark, specs, lambda name: None)
    got = {r["file_name"]: (r["incidences"], r["flag"], r["field_name"])
           for r in logs.validation_logs(v, "2025-01-01 00:00:00").collect()}
    assert got["t00017"] == (4, 34.0, "template_code, sheet, data_name, column_x, excel_cell")
    assert got["t00018"] == (2, 34.0, "template_code, sheet, data_name, excel_cell")
