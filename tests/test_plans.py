"""Scale properties of the physical plans (read from the public explain output)."""

import contextlib
import io

from veritab import queries as Q
from veritab.operators import functional as FN
from veritab.operators import references as R
from veritab.operators import technical as T


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_one_pass_aggregate_no_join_pruned_scan(spark, sf):
    p = plan(Q.q_column_violation_counts(spark, sf))
    assert "Join" not in p
    assert p.count("HashAggregate(") == 2                 # one partial + final aggregate for all rules
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int," in p
    assert "l_quantity" not in p.split("ReadSchema")[1]    # untested columns are not read


def test_reference_rows_are_found_through_distinct_missing_values(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k")
    ref = spark.range(5).selectExpr("id AS k")

    def rows_side(p):
        """The plan down to the filter of the tested rows."""
        return p.split("ubquery")[0]

    small = rows_side(plan(R.reference_violations(df, "k", ref, "k")))
    assert "BroadcastHashJoin" in small and "LeftSemi" in small
    assert "Exchange" not in small and "Filter (isnotnull" in small  # tested rows stay where they are, behind the Bloom filter
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = rows_side(plan(R.reference_violations(df, "k", ref, "k")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # only rows that pass the Bloom filter of the missing values are exchanged
    assert "BroadcastHashJoin" not in big and "LeftSemi" in big and big.index("Exchange") < big.rindex("Filter (isnotnull")
    count = plan(R.reference_violation_count(df, "k", ref, "k"))
    assert count.count("partial_count(1)") == 1 and "LeftAnti" in count  # values are counted before they move


def test_grouped_checks_combine_before_shuffle(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    p = plan(FN.required_missing(li, ["l_orderkey"], "l_linenumber", [1, 2, 3]))
    # the (group, value) aggregate runs map-side before the first exchange
    first_exchange = p.rindex("Exchange hashpartitioning(l_orderkey")
    assert "HashAggregate(keys=[l_orderkey" in p[first_exchange:]
    assert "PushedFilters: [In(l_linenumber" in p
    assert "collect_set" not in p and "collect_list" not in p
    k = plan(T.key_summary(li, ["l_orderkey", "l_linenumber"]))
    assert "partial_count" in k or "HashAggregate(keys=[l_orderkey, l_linenumber], functions=[partial" in k


def test_row_count_is_a_scalar_subquery(spark, sf):
    p = plan(Q.q_cell_out_of_bounds(spark, sf))
    assert "Subquery" in p and "Join" not in p
    assert "ReadSchema: struct<>" in p                     # the count reads no column


def test_prefix_filter_pushed_to_scan(spark, sf):
    p = plan(Q.q_prefix_violations(spark, sf))
    assert "Not(StringStartsWith(url,https))" in p


def test_wide_tables_stay_compiled(spark):
    from veritab.functions.rules import make_rule

    kinds = ["INT", "DECIMAL(6,2)", "STRING"]
    df = spark.range(100).selectExpr(*[f"cast(id + {i} as string) c{i}" for i in range(150)])
    d = T.column_violation_counts(df, [make_rule(f"c{i}", kinds[i % 3], 5, position=i) for i in range(150)])
    assert d.count() == 150
    d.collect()
    final = d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    aggregates = [line for line in final.splitlines() if "HashAggregate" in line]
    assert len(aggregates) == 2 and all("*(" in line for line in aggregates)
