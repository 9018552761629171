"""Cell references and rule decoding beyond the range of their numbers."""

import pytest
from pyspark.sql import functions as F

from veritab.functions.cells import out_of_bounds, parse_cell
from veritab.functions.predicates import fast_predicate
from veritab.functions.rules import decode_rules, make_rule
from veritab.schemas import SEMANTIC_LAYER


@pytest.mark.parametrize("cell, row, col", [
    ("m82", 82, 13), ("AZ3", 3, 52), ("z" * 13 + "1", 1, sum(26 ** i * 26 for i in range(13))),
    ("z" * 14 + "1", 1, (1 << 63) - 1), ("internationalization1", 1, (1 << 63) - 1), ("a" * 200 + "7", 7, (1 << 63) - 1),
    ("b" + "9" * 30, (1 << 63) - 1, 2), ("none", None, None),
])
def test_long_cells_are_out_of_bounds(spark, cell, row, col):
    df = spark.createDataFrame([(cell,)], "cell string")
    _, r, c = parse_cell(F.col("cell"))
    got = df.select(r.alias("r"), c.alias("c"), out_of_bounds(r, c, 100, 60).alias("out")).first()
    assert (got["r"], got["c"]) == (row, col)
    assert bool(got["out"]) is (row is not None and (row >= 100 or col >= 60))


@pytest.mark.parametrize("data_type, length, error", [
    ("DECIMAL(99999999999,2)", 5, "decimal digits beyond an integer"), ("DECIMAL(5,99999999999)", 5, "decimal digits beyond an integer"),
    ("DECIMAL(5,2)", "1_000", "length missing or not a number"), ("INT", "99999999999999999999", "length missing or not a number"),
    ("DECIMAL(5,2)", "7", None),
])
def test_both_decoders_agree_on_odd_numbers(spark, data_type, length, error):
    rule = make_rule("a", data_type, length)
    assert rule.rule_error == error
    row = {f.name: None for f in SEMANTIC_LAYER.fields} | {
        "id_type_file": "1", "field_position": 1, "field_name": "a", "data_type": data_type, "length": str(length)}
    df = spark.createDataFrame([tuple(row[f.name] for f in SEMANTIC_LAYER.fields)], SEMANTIC_LAYER)
    assert decode_rules(df).first()["rule_error"] == error
    if error:
        fast_predicate(rule)  # a broken rule still has a predicate
