"""T7 one-pass counts and row filter, T8 keys."""

from pyspark.sql import functions as F

from veritab.functions.rules import make_rule
from veritab.operators import technical

RULES = [make_rule("a", "INT", 2, nullable=False, position=1),
         make_rule("b", "DECIMAL(4,2)", 5, position=2),
         make_rule("c", "STRING", 3, position=3)]


def frame(spark):
    return spark.createDataFrame(
        [("1", "1.00", "x"), ("100", "1.00", "x"), (None, "1.0", "long"), ("7", None, None)],
        "a string, b string, c string")


def test_column_counts_one_pass(spark):
    got = {r["column_name"]: (r["violations"], r["row_count"])
           for r in technical.column_violation_counts(frame(spark), RULES, with_row_count=True).collect()}
    assert got == {"a": (2, 4), "b": (1, 4), "c": (1, 4)}


def test_row_violations_names_columns(spark):
    rows = technical.row_violations(frame(spark), RULES, keep=["a"]).collect()
    assert sorted((r["a"] or "", r["failed_columns"]) for r in rows) == [("", "a,b,c"), ("100", "a")]


def test_fail_fast_verdict(spark):
    assert technical.has_violation(frame(spark), RULES)
    assert not technical.has_violation(frame(spark).where("a = '1'"), RULES)


def test_keys_nulls_are_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 4)], "k1 int, k2 int")
    s = technical.key_summary(df, ["k1", "k2"]).first()
    assert (s["row_count"], s["distinct_keys"], s["duplicated_keys"], s["passed"]) == (4, 3, 1, False)
    dups = technical.key_duplicates(df, ["k1", "k2"]).collect()
    assert [(r["k1"], r["k2"], r["n"]) for r in dups] == [(1, None, 2)]


def test_key_summary_empty(spark):
    s = technical.key_summary(spark.createDataFrame([], "k int"), ["k"]).first()
    assert (s["row_count"], s["distinct_keys"], s["passed"]) == (0, 0, True)


def summary(df, keys, **how):
    s = technical.key_summary(df, keys, **how).first()
    return s["row_count"], s["distinct_keys"], s["duplicated_keys"], s["passed"]


def test_wide_keys_by_hash_are_exact_under_collisions(spark):
    df = spark.range(500).selectExpr("cast(id % 480 as string) a", "if(id % 7 = 0, null, id % 480) b")
    want = (500, *(len(x) for x in keys_of(df)), False)
    few = lambda *c: F.pmod(F.xxhash64(*c), F.lit(11))
    for how in ({}, {"hashed": few}, {"hashed": lambda *c: F.lit(1).cast("bigint")}):
        assert summary(df, ["a", "b"], **how) == want
        dups = technical.key_duplicates(df, ["a", "b"], **how)
        assert {(r["a"], r["b"], r["n"]) for r in dups.collect()} == keys_of(df)[1]
    unique = spark.range(300).selectExpr("cast(id as string) a", "id b")
    for how in ({}, {"hashed": few}):
        assert summary(unique, ["a", "b"], **how) == (300, 300, 0, True)
    assert summary(unique.limit(0), ["a", "b"]) == (0, 0, 0, True)


def keys_of(df):
    from collections import Counter

    n = Counter((r["a"], r["b"]) for r in df.collect())
    return set(n), {(*k, c) for k, c in n.items() if c > 1}


def test_wide_keys_move_by_their_hash(spark):
    """Exchanges hold hashes and counts; whole keys move only behind the filter of repeated hashes."""
    df = spark.range(100).selectExpr("cast(id as string) a", "cast(id as string) b")
    plan = technical.key_summary(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_groupingexpression#" in plan
    narrow = technical.key_summary(df.selectExpr("cast(a as int) a"), ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_groupingexpression#" not in narrow
