"""T1-T6 predicates and rule decoding, edge cases E1-E9."""

from pyspark.sql import functions as F

from veritab.functions.predicates import decimal_regex, violation_predicate
from veritab.functions.rules import collect_rules, decode_rules, make_rule
from veritab.schemas import SEMANTIC_LAYER


def bad(spark, values, rule, compat=False):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(violation_predicate(rule, compat).alias("b")).collect()]


def test_string_length_and_null(spark):
    assert bad(spark, ["abc", "abcd", None], make_rule("v", "STRING", 3)) == [False, True, None]
    assert bad(spark, ["abc", None], make_rule("v", "STRING", 3, nullable=False)) == [False, True]


def test_int(spark):
    r = make_rule("v", "INT", 3)
    assert bad(spark, ["12", "-123", "1234", "1a", "", None], r) == [False, True, True, True, True, None]


def test_int_trailing_newline_rejected(spark):
    # E3: "\z" rejects a trailing newline that "$" would accept
    assert bad(spark, ["1\n", "1"], make_rule("v", "INT", 3)) == [True, False]


def test_decimal_exact_scale_and_digits(spark):
    r = make_rule("v", "DECIMAL(8,4)", 10)
    assert bad(spark, ["1.2345", "-1234.5678", "12345.1234", "1.234", "1.23456", "1,2345"], r) == [
        False, False, True, True, True, True]


def test_decimal_symbol_is_literal(spark):
    # The symbol is quoted, "." does not match any character
    dot = make_rule("v", "DECIMAL(6,2)", 10)
    comma = make_rule("v", "DECIMAL(6,2)", 10, decimal_symbol=",")
    assert bad(spark, ["12,45", "12.45"], dot) == [True, False]
    assert bad(spark, ["12,45", "12.45"], comma) == [False, True]
    assert decimal_regex(6, 2, ".") == r"^-?\d{1,4}\Q.\E\d{2}\z"


def test_decimal_precision_equals_scale(spark):
    # E5: p == s is a valid pattern (optional leading zero), not a crash
    r = make_rule("v", "DECIMAL(2,2)", 10)
    assert bad(spark, ["0.12", ".12", "1.12"], r) == [False, False, True]


def test_date_offset(spark):
    r = make_rule("v", "DATE", 14)
    assert bad(spark, ["2025-02-24 +01", "2025-02-44 +01", "2025-13-01 +01", "2025-02-24", "2025-02-24 +15"],
               r) == [False, True, True, True, True]


def test_nullable_date_null(spark):
    # A null in a nullable DATE column passes by default, fails in compat mode
    r = make_rule("v", "DATE", 14, nullable=True)
    assert bad(spark, [None], r) == [False]
    assert bad(spark, [None], r, compat=True) == [True]


def test_unknown_and_malformed_types_fail_every_row(spark):
    for dt in ("BLOB", "DECIMAL(8)", None):
        assert bad(spark, ["x", None], make_rule("v", dt, 5)) == [True, True]


def test_rule_errors(spark):
    assert make_rule("v", "INT", "0").rule_error == "int length below 1"        # E5
    assert make_rule("v", "STRING", "abc").rule_error is not None               # E6
    assert make_rule("v", "STRING", None).rule_error is not None                # E6
    assert make_rule("v", "DATETIME", "10").kind == "DATE"                      # E8 prefix rule
    assert make_rule("v", "STRING", "5", nullable=None).is_nullable is False     # E7


def test_empty_table_passes_even_unknown_type(spark):
    # E9
    df = spark.createDataFrame([], "v string")
    assert df.agg(F.count_if(violation_predicate(make_rule("v", "BLOB", 5)))).first()[0] == 0


def test_decode_rules_matches_driver_decoding(spark):
    rows = [
        ("t", 1, "a", None, True, "INT", "5", False, None, None, None, None),
        ("t", 2, "b", None, None, "DECIMAL(8,4)", "10", None, ",", None, None, None),
        ("t", 3, "c", None, False, "DECIMAL(8)", "10", True, None, None, None, None),
        ("t", 4, "d", None, False, "DATETIME", "x", True, None, None, None, None),
        ("t", 5, "e", None, False, None, "3", True, None, None, None, None),
        ("t", 6, "f", None, False, "DECIMAL(2,4)", "3", True, None, None, None, None),
    ]
    got = collect_rules(decode_rules(spark.createDataFrame(rows, SEMANTIC_LAYER)), "t")
    for r, g in zip(rows, got):
        want = make_rule(r[2], r[5], r[6], nullable=r[7], decimal_symbol=r[8], pk=r[4], position=r[1])
        for f in ("kind", "max_length", "precision", "scale", "symbol", "is_nullable", "is_pk", "rule_error"):
            assert getattr(g, f) == getattr(want, f), (r, f)


def test_sql_predicates_equal_column_predicates(spark):
    from veritab.functions.predicates import fast_predicate
    rules = [make_rule("v", "INT", 3), make_rule("v", "INT", 3, nullable=False), make_rule("v", "STRING", 2),
             make_rule("v", "DECIMAL(4,2)", 6), make_rule("v", "DECIMAL(4,2)", 6, decimal_symbol=","),
             make_rule("v", "DECIMAL(2,2)", 6), make_rule("v", "DATE", 14),
             make_rule("v", "DATE", 14, nullable=False), make_rule("v", "BLOB", 3),
             make_rule("v", "DECIMAL(4,2)", 6, decimal_symbol="'")]
    vals = ["1", "-12", "123", "1234", "1.5", "12.34", "12,34", "0.12", ".12", "2025-02-24 +01",
            "2025-02-44 +01", "1\n", "", None, "ab", "12'34"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for compat in (False, True):
        for r in rules:
            a = [x[0] for x in df.select(violation_predicate(r, compat)).collect()]
            b = [x[0] for x in df.select(fast_predicate(r, compat)).collect()]
            assert a == b, (r, compat)
