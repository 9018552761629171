"""F1-F4 functional rules."""

from pyspark.sql import functions as F

from veritab.functions.cells import letters_to_number
from veritab.operators import functional as FN

REQ = ("data_as_of", "cristine_unit", "excel_title")


def groups(spark):
    return spark.createDataFrame([
        ("1", "S1", "data_as_of"), ("1", "S1", "cristine_unit"), ("1", "S1", "excel_title"), ("1", "S1", "ccy_x"),
        ("2", "S2", "data_as_of"), ("2", "S2", "data_as_of"), ("2", "S2", "other"),
        ("3", "S3", "other"), ("3", "S3", None),
    ], "template_code string, sheet string, data_name string")


def test_required_any(spark):
    df = groups(spark)
    assert FN.required_any(df, "data_name", REQ).first()["passed"]
    assert not FN.required_any(df.where("template_code = '3'"), "data_name", REQ).first()["passed"]


def test_required_excess_and_missing(spark):
    df = groups(spark)
    g = ["template_code", "sheet"]
    ex = [(r["template_code"], r["data_name"], r["n"]) for r in FN.required_excess(df, g, "data_name", REQ).collect()]
    assert ex == [("2", "data_as_of", 2)]
    miss = sorted((r["template_code"], r["n_present"]) for r in FN.required_missing(df, g, "data_name", REQ).collect())
    assert miss == [("2", 1)]                       # E16: group 3 unseen by default
    miss_all = sorted((r["template_code"], r["n_present"])
                      for r in FN.required_missing(df, g, "data_name", REQ, all_groups=True).collect())
    assert miss_all == [("2", 1), ("3", 0)]


def test_group_prefix(spark):
    df = groups(spark)
    g = ["template_code", "sheet"]
    missing = sorted(r["template_code"] for r in FN.group_prefix_missing(df, g, "data_name", "ccy").collect())
    assert missing == ["2", "3"]
    v = FN.group_prefix_incidences(df, g, "data_name", "ccy").first()
    assert (v["groups"], v["groups_with_prefix"], v["incidences"]) == (3, 1, 2)   # E15: groups


def test_pattern_literal_vs_like(spark):
    df = spark.createDataFrame([("_c1",), ("ac1",), ("Zq_c7",), (None,)], "column_x string")
    lit = sorted(r[0] for r in FN.pattern_violations(df, "column_x", "_c").collect())
    like = sorted(r[0] for r in FN.pattern_violations(df, "column_x", "_c", mode="like").collect())
    assert lit == ["Zq_c7", "ac1"]                  # E18: literal prefix
    assert like == ["Zq_c7"]                        # "_" is a wildcard, "ac1" passes


def test_letters_to_number(spark):
    df = spark.createDataFrame([("A",), ("Z",), ("AA",), ("AZ",), ("BA",), ("ZZ",), ("AAA",)], "l string")
    assert [r[0] for r in df.select(letters_to_number(F.col("l"))).collect()] == [1, 26, 27, 52, 53, 702, 703]


def test_cell_parse_and_bounds(spark):
    df = spark.createDataFrame([("a1",), ("AA27",), ("b10",), ("c3",), ("1B",), ("zz",), (None,)], "excel_cell string")
    parts = {r["excel_cell"]: (r["col_letters"], r["row_num"], r["col_num"])
             for r in FN.with_cell_parts(df, "excel_cell").collect()}
    assert parts["a1"] == ("A", 1, 1)
    assert parts["AA27"] == ("AA", 27, 27)
    assert parts["1B"] == (None, None, None)        # E20: unparsable gives NULLs
    assert parts["zz"] == (None, None, None)
    # bounds 10 rows x 3 columns; default rejects row >= 10 or col >= 3
    out = sorted(r["excel_cell"] for r in FN.cell_out_of_bounds(df, "excel_cell", 10, 3).collect())
    assert out == ["AA27", "b10", "c3"]
    inc = sorted(r["excel_cell"] for r in FN.cell_out_of_bounds(df, "excel_cell", 10, 3, inclusive=True).collect())
    assert inc == ["AA27"]
    flagged = sorted(r["excel_cell"] for r in
                     FN.cell_out_of_bounds(df, "excel_cell", 10, 3, flag_unparsable=True).collect())
    assert flagged == ["1B", "AA27", "b10", "c3", "zz"]


def test_cell_bounds_default_row_count(spark):
    df = spark.createDataFrame([("a1",), ("a2",), ("a3",)], "excel_cell string")
    # row count 3, column count 1 (one column): a3 (row 3 >= 3) and every col 1 >= 1
    assert FN.cell_out_of_bounds(df, "excel_cell").count() == 3


def test_dotted_column_names(spark):
    """Field names from metadata may contain dots; they are top-level columns."""
    from veritab.functions.rules import make_rule
    from veritab.operators import references as R
    from veritab.operators import technical as T
    from veritab.plans.staged_run import FunctionalSpec, TableSpec, run_verdicts

    df = spark.createDataFrame(
        [("1", "S.1", "data_as_of", "_c1", "a1"), ("1", "S.1", "data_as_of", "x", "z99"), ("2", "S.2", "ccy.x", "_c2", "a2")],
        "`t.code` string, `sheet.name` string, `data.name` string, `col.x` string, `excel.cell` string")
    assert T.key_summary(df, ["t.code", "sheet.name"]).first()["duplicated_keys"] == 1
    ref = spark.createDataFrame([("1",)], "`code.v` string")
    assert R.reference_violation_count(df, "t.code", ref, "code.v").first()["violations"] == 1
    assert FN.pattern_violations(df, "col.x", "_c").count() == 1
    assert FN.required_missing(df, ["t.code", "sheet.name"], "data.name", REQ, all_groups=True).count() == 2
    assert FN.group_prefix_missing(df, ["t.code"], "data.name", "ccy").count() == 1
    assert FN.cell_out_of_bounds(df, "excel.cell", 3, 5).count() == 1
    rules = [make_rule(n, "STRING", 10, position=i + 1) for i, n in enumerate(df.columns)]
    spec = TableSpec("d", "dotted", True, lambda: df, rules,
                     FunctionalSpec(group_cols=("t.code",), required_column="data.name", required_values=REQ,
                                    prefix_column="data.name", prefix="ccy", pattern_column="col.x",
                                    pattern="_c", cell_column="excel.cell"))
    v = {r["rule"]: r["violations"] for r in run_verdicts(spark, [spec], lambda n: None).collect()}
    assert v["pattern"] == 1 and v["group_prefix"] == 1
    assert T.row_violations(df, [make_rule("col.x", "INT", 1)], keep=["t.code"]).count() == 3


def test_staged_cell_options(spark):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import FunctionalSpec, TableSpec, run_verdicts

    df = spark.createDataFrame([("a1",), ("b3",), ("1B",), ("c2",)], "excel_cell string")   # 4 rows, 1 column
    rules = [make_rule("excel_cell", "STRING", 4, position=1)]

    def cells(**kw):
        spec = TableSpec("c", "cells", True, lambda: df, rules,
                         FunctionalSpec(cell_column="excel_cell", cell_column_count=3, **kw))
        return {r["rule"]: r["violations"] for r in run_verdicts(spark, [spec], lambda n: None).collect()}

    assert cells()["cell_bounds"] == 1                                   # c2: column 3 >= 3
    assert cells(cell_inclusive=True)["cell_bounds"] == 0
    assert cells(cell_flag_unparsable=True)["cell_bounds"] == 2          # plus "1B"
