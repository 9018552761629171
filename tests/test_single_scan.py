"""T7, T8, R2, F1, F2 and F4c from one read of a CSV table."""

import dataclasses
import os
import random

import pytest

from veritab.functions.rules import make_rule
from veritab.operators import functional
from veritab.plans.staged_run import FunctionalSpec, TableSpec, run_verdicts, table_parts
from veritab.plans.verdicts import VERDICT_COLUMNS
from veritab.sources import read_table

RULES = [make_rule("k1", "INT", 4, nullable=True, position=1, pk=True), make_rule("k2", "STRING", 3, nullable=True, position=2, pk=True),
         make_rule("code", "STRING", 9, nullable=True, position=3, reference="td.code"),
         make_rule("num", "INT", 3, nullable=False, position=4, reference="td.num"),
         make_rule("grp", "STRING", 9, nullable=True, position=5), make_rule("cell", "STRING", 9, nullable=True, position=6)]
NAMES = [r.field_name for r in RULES]
SPEC = FunctionalSpec(group_cols=("grp",), required_column="code", required_values=("a", "b", "b"), prefix_column="code",
                      prefix="c", pattern_column="cell", pattern="b", cell_column="cell")


def csv_of(path, rows):
    path.write_text("\n".join([",".join(NAMES), *(",".join("" if v is None else str(v) for v in r) for r in rows)]) + "\n")
    return str(path)


def some_rows(n):
    rng = random.Random(n)
    pick = rng.choice
    return [(pick([1, 2, 3, "x", None]), pick(["u", "v", "1:u", None]), pick(["a", "b", "c1", "zz", None]), pick([7, "07", 8, None]),
             pick(["g1", "g2", None]), pick(["b2", "B3", "z1", "b9999", "aa1", "b", None, "b99999999999999999999"])) for _ in range(n)]


@pytest.mark.parametrize("rows", [0, 1, 3, 40])
@pytest.mark.parametrize("change", [{}, {"all_groups": True, "cell_inclusive": True, "cell_flag_unparsable": True}])
def test_one_read_gives_the_same_verdicts(spark, tmp_path, rows, change):
    path = csv_of(tmp_path / "t.csv", some_rows(rows))
    td = spark.createDataFrame([("a", 7), ("b", None)], "code string, num int")
    load = lambda: read_table(spark, path, "csv", header=True)
    functional_spec = dataclasses.replace(SPEC, **change)
    both = [sorted(tuple(r) for r in run_verdicts(
        spark, [TableSpec("t", "t", True, load, RULES, functional_spec, single_scan=one)], lambda name: td).collect())
        for one in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 16


def test_the_table_is_read_once(spark, tmp_path):
    """After the one counting job the file is not needed any more."""
    path = csv_of(tmp_path / "t.csv", some_rows(30))
    td = spark.createDataFrame([("a", 7)], "code string, num int")
    spec = TableSpec("t", "t", True, lambda: read_table(spark, path, "csv", header=True), RULES, SPEC, single_scan=True)
    parts = table_parts(spark, spec, 1, lambda name: td)
    os.remove(path)
    rows = [r for p in parts for r in p.frame.select(*VERDICT_COLUMNS).collect()]
    assert {r["rule"] for r in rows} >= {"primary_key", "reference", "required_set", "group_prefix", "cell_bounds", "pattern"}


def test_required_values_in_one_exchange_by_group(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "a"), ("g", "b"), ("h", "a"), (None, "b"), ("i", "zz")], "g string, v string")
    for query in (functional.required_missing(df, ["g"], "v", ["a", "b", "a", None]), functional.required_excess(df, ["g"], "v", ["a", "b"])):
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(g#") == plan.count("Exchange") == 1
        assert "partial_count" in plan
    assert sorted(map(tuple, functional.required_missing(df, ["g"], "v", ["a", "b", "a", None]).collect()), key=str) == [
        ("h", 1), (None, 1)]
    assert sorted(map(tuple, functional.required_missing(df, ["g"], "v", ["a", "b"], all_groups=True).collect()), key=str) == [
        ("h", 1), ("i", 0), (None, 1)]
    assert [tuple(r) for r in functional.required_excess(df, ["g"], "v", ["a", "b"]).collect()] == [("g", "a", 2)]
    assert functional.required_missing(df, ["g"], "v", []).count() == 0


@pytest.mark.parametrize("header", [True, False])
def test_a_growing_table_reads_new_files_only(spark, tmp_path, header):
    """The merged state of A and B equals the run over A and B, also after a file changed and one went."""
    from veritab.plans.growing import GrowingTable

    folder, state = tmp_path / "t t+", str(tmp_path / "state")
    folder.mkdir()
    td = spark.createDataFrame([("a", 7)], "code string, num int")
    loaded = []

    def verdicts(growing):
        load = lambda files=str(folder): read_table(spark, files, "csv", header=header)

        def some(files):
            loaded.append(sorted(os.path.basename(f) for f in files))
            return load(files)

        spec = TableSpec("t", "t", header, load, RULES, SPEC, single_scan=True,
                         growing=GrowingTable(spark, str(folder), state, some) if growing else None)
        return sorted(tuple(r) for r in run_verdicts(spark, [spec], lambda name: td).collect())

    csv_of(folder / "a.csv", some_rows(25))
    csv_of(folder / "b b.csv", some_rows(9))
    assert verdicts(True) == verdicts(False) and loaded == [["a.csv", "b b.csv"]]
    csv_of(folder / "c.csv", some_rows(31))
    assert verdicts(True) == verdicts(False) and loaded[1:] == [["c.csv"]]
    assert verdicts(True) == verdicts(False) and len(loaded) == 2          # nothing new: nothing read
    csv_of(folder / "a.csv", some_rows(4))                                 # changed
    os.remove(folder / "b b.csv")
    assert verdicts(True) == verdicts(False) and loaded[2:] == [["a.csv"]]
