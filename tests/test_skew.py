"""A key holding a third of all rows: grouped checks and anti-joins stay exact."""

from pyspark.sql import functions as F

from veritab.operators import functional as FN
from veritab.operators import references as R
from veritab.operators import technical as T


def skewed(spark, n=30000):
    # key 0 holds a third of the rows, the rest are unique
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 5 == 0, F.lit("bad")).otherwise(F.lit("ok")).alias("code"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("v"))


def test_key_summary_hot_key(spark):
    s = T.key_summary(skewed(spark), ["k"]).first()
    assert (s["row_count"], s["distinct_keys"], s["duplicated_keys"]) == (30000, 20001, 1)


def test_required_pairs_hot_group(spark):
    df = skewed(spark)
    # group 0 holds 10000 rows of value "a" only (id % 3 == 0 -> v = "a")
    ex = {(r["k"], r["v"]): r["n"] for r in FN.required_excess(df, ["k"], "v", ["a", "b", "c"]).collect()}
    assert ex == {(0, "a"): 10000}
    assert FN.required_missing(df, ["k"], "v", ["a", "b", "c"]).count() == 20001


def test_anti_join_hot_value_both_paths(spark):
    df = skewed(spark)
    ref = spark.createDataFrame([("ok",)], "code string")
    for bound in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            assert R.reference_violation_count(df, "code", ref, "code").first()["violations"] == 6000
            assert R.reference_violations(df, "code", ref, "code").count() == 6000
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
