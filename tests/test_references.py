"""Anti-join reference checks."""

import pytest

from veritab.operators import references as R


@pytest.fixture
def frames(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None), (5, "z")], "id int, code string")
    ref = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "template_code string")
    return df, ref


@pytest.mark.parametrize("large", [False, True])
def test_violations_and_their_count(spark, frames, large):
    df, ref = frames
    found = R.reference_violations(df, "code", ref, "template_code", large).collect()
    assert sorted(r["id"] for r in found) == [3, 5]          # null value passes
    assert R.reference_violation_count(df, "code", ref, "template_code", large).first()["violations"] == 2


def test_null_in_allowed_list_is_ignored(spark, frames):
    # NOT IN with a null in the list would pass everything; nulls are dropped
    df, ref = frames
    assert R.allowed_values(ref, "template_code").count() == 2


def test_reference_side_cast_to_tested_type(spark):
    df = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    ref = spark.createDataFrame([("1",), ("2",), ("x",)], "k string")
    assert R.reference_violation_count(df, "k", ref, "k").first()["violations"] == 1


@pytest.mark.parametrize("tested, kind, allowed, ref_kind, violations", [
    ([1, 2], "int", ["1.9", "2.0"], "decimal(3,1)", 1),          # 1 is not 1.9, 2 is 2.0
    (["1.23"], "decimal(5,2)", ["1.2345"], "decimal(6,4)", 1),
    (["1.20"], "decimal(5,2)", ["1.2000"], "decimal(6,4)", 0),
    ([1, 9], "int", ["1", "x", "1.9"], "string", 1),             # an allowed text that is no number stays
    (["x", "1"], "string", [1, 2], "int", 1),
    ([9007199254740993], "bigint", [9007199254740992.0], "double", 1),
    ([1.5, 2.0], "double", [2], "int", 1),
])
def test_comparison_loses_nothing(spark, tested, kind, allowed, ref_kind, violations):
    df = spark.createDataFrame([(str(x),) for x in tested], "k string").selectExpr(f"cast(k as {kind}) k")
    ref = spark.createDataFrame([(str(x),) for x in allowed], "k string").selectExpr(f"cast(k as {ref_kind}) k")
    assert R.reference_violation_count(df, "k", ref, "k").first()["violations"] == violations
    assert R.reference_violations(df, "k", ref, "k").count() == violations


#: one value per type and number that the type can hold: (type, SQL of the value)
NUMBERS = {
    "0": ["tinyint", "bigint", "float", "double", "decimal(5,2)", "decimal(38,38)", "decimal(38,0)", "string"],
    "-7": ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(38,10)", "string"],
    "2.5": ["float", "double", "decimal(5,2)", "decimal(38,30)", "decimal(2,1)", "string"],
    "0.0000000000582076609134674072265625": ["double", "float", "decimal(38,38)"],       # 2^-34
    "-1125899906842624.25": ["double", "decimal(38,3)", "decimal(18,2)", "string"],
    "9007199254740993": ["bigint", "decimal(16,0)", "decimal(38,20)", "string"],            # 2^53 + 1: no double
    "9007199254740992": ["bigint", "double", "float", "decimal(38,0)", "string"],
    "1152921504606846976": ["bigint", "double", "float", "decimal(38,5)", "decimal(38,0)"],  # 2^60
    "-85070591730234615865843651857942052864": ["double", "float", "decimal(38,0)"],         # -2^126
    "12345678901234567890123456789012345678": ["decimal(38,0)", "string"],
    "0.1": ["decimal(2,1)", "decimal(38,37)", "string"],
}


def number_frames(spark):
    frames = {}
    for number, kinds in NUMBERS.items():
        for kind in kinds:
            text = number if "." not in number or kind != "string" else number + "00"
            frames.setdefault(kind, []).append((number, text))
    out = {}
    for kind, values in frames.items():
        out[kind] = ({n for n, _ in values},
                     spark.createDataFrame(values, "number string, k string").selectExpr("number", f"cast(k as {kind}) k"))
    return out


def test_equal_numbers_have_equal_keys_over_all_type_pairs(spark):
    """Each type against each other: keys are equal exactly when the numbers are."""
    from pyspark.sql import functions as F

    from veritab.functions.normal_form import comparable

    frames = number_frames(spark)
    kinds = {kind: df.schema["k"].dataType for kind, (_, df) in frames.items()}
    same = (lambda v: v, lambda v: v)
    keys = {}
    for a, (_, df) in frames.items():  # one job per type: its keys against every other type, on either side
        columns = []
        for b in frames:
            columns += [(comparable(kinds[a], kinds[b]) or same)[0](F.col("k")).alias(f"tested_{b}"),
                        (comparable(kinds[b], kinds[a]) or same)[1](F.col("k")).alias(f"allowed_{b}")]
        keys[a] = df.select("number", *columns).toArrow().to_pylist()
    for a in frames:
        for b in frames:
            for x in keys[a]:
                for y in keys[b]:
                    equal = x["number"] == y["number"]
                    if {a, b} == {"string", "float"} or {a, b} == {"string", "double"}:
                        equal = reads_alike(x["number"], y["number"], a if b == "string" else b)
                    assert (x[f"tested_{b}"] == y[f"allowed_{a}"]) == equal, (a, b, x["number"], y["number"])


def reads_alike(one, other, kind):
    """A text names the double (or float) nearest to it."""
    import numpy as np

    read = {"float": np.float32, "double": np.float64}[kind]
    return read(one) == read(other)


@pytest.mark.parametrize("tested, kind, allowed, ref_kind, violations", [
    (["2024-02-03"], "date", ["2024-02-03 00:00:00"], "timestamp", 0),
    (["2024-02-03"], "date", ["2024-02-03 00:00:01"], "timestamp_ntz", 1),
    (["2024-02-03 04:05:06.7"], "timestamp", ["2024-02-03 04:05:06.700"], "timestamp_ntz", 0),
    (["2024-02-03", "2024-2-4 00:00", "20240205", " 2024-02-06"], "string", ["2024-02-03", "2024-02-04", "2024-02-06"], "date", 1),
    (["2024-02-03 00:00:00"], "timestamp_ntz", ["2024-02-03"], "string", 0),
    (["true", "TRUE", "yes", "1"], "string", ["true"], "boolean", 2),
    (["true"], "boolean", ["1"], "int", 1),
    (["2024-02-03"], "date", ["20240203"], "int", 1),
    (["0.1", "1e-1", ".10", "0.2"], "string", ["0.1"], "double", 1),
    (["0.1"], "float", ["0.1"], "double", 1),                      # two different numbers
    (["0.1"], "double", ["0.1"], "decimal(3,1)", 1),               # by the exact expansion
    (["NaN", "Infinity", "1e300", "5e-324"], "double", ["1"], "decimal(3,1)", 4),
    (["NaN", "-Infinity", "nan"], "string", ["NaN", "-Infinity"], "double", 1),
    (["-0.0", "0.0"], "double", ["0"], "decimal(3,1)", 0),
    (["007", "+7", "7.", "7e0", "70e-1", "0x7", "7 "], "string", ["7"], "bigint", 1),
    (["1E+3", "1000.0"], "string", ["1000"], "decimal(8,2)", 0),
    (["abc"], "binary", ["abc"], "string", 0),
    (["abc", "7"], "string", ["abc"], "binary", 1),
    (["0.0000000001", "0"], "decimal(12,10)", ["1e-10", "0e-5"], "string", 0),
])
def test_values_of_other_families(spark, tested, kind, allowed, ref_kind, violations):
    df = spark.createDataFrame([(str(x),) for x in tested], "k string").selectExpr(f"cast(k as {kind}) k")
    ref = spark.createDataFrame([(str(x),) for x in allowed], "k string").selectExpr(f"cast(k as {ref_kind}) k")
    assert R.reference_violation_count(df, "k", ref, "k").first()["violations"] == violations
    assert R.reference_violations(df, "k", ref, "k", large_reference=True).count() == violations


def test_no_job_runs_while_a_check_is_built(spark, frames):
    df, ref = frames
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        for large in (False, True):
            R.reference_violations(df, "code", ref, "template_code", large)
            R.reference_violation_count(df, "code", ref, "template_code", large)
        assert jobs() == 0
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def test_a_large_reference_by_bloom_filter(spark):
    """Both outcomes equal the plain anti-join; surely missing values bypass it."""
    df = spark.range(3000).selectExpr("id % 1500 AS k")
    ref = spark.range(0, 1500, 2).selectExpr("cast(id as decimal(20,0)) AS k")
    plain = {tuple(r) for r in R.missing_values(df, "k", ref, "k").collect()}
    assert plain == {tuple(r) for r in R.missing_values(df, "k", ref, "k", large_reference=True).collect()}
    assert len(plain) == 750
    from veritab.functions import bloom

    side = R.allowed_values(ref, "k")
    kept = bloom.perhaps_contains(bloom.bloom_filter(side, R.F.col("__ref_value")), R.F.col("k").cast("decimal(20,0)"))
    hits = df.distinct().select((R.F.col("k") % 2 == 0).alias("in"), kept.alias("kept")).groupBy("in", "kept").count()
    counts = {(r["in"], r["kept"]): r["count"] for r in hits.collect()}
    assert counts[True, True] == 750 and counts[False, False] >= 740   # no false negative, few false positives
    plan = R.missing_values(df, "k", ref, "k", large_reference=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("LeftAnti") == 1


def test_failing_columns_summary(spark):
    per = spark.createDataFrame(
        [("t", 3, "c3", 5), ("t", 1, "c1", 2), ("t", 2, "c2", 0), ("u", 1, "x", 0)],
        "table_name string, field_position int, column_name string, violations bigint")
    got = {r["table_name"]: (r["incidences"], r["field_name"], r["passed"])
           for r in R.failing_columns_summary(per).collect()}
    assert got == {"t": (2, "c1, c3", False), "u": (0, "", True)}


def test_allowed_priorities_are_not_read_from_orders(spark, sf):
    from veritab.queries import allowed_priorities

    allowed = allowed_priorities(spark, sf)
    assert not allowed.inputFiles()
    assert {r[0] for r in allowed.collect()} == {"1-URGENT", "2-HIGH", "3-MEDIUM"}
