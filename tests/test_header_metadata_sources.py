"""H1-H4, M1-M7, S1-S9."""

import os
import re
from collections import Counter
from decimal import Decimal

import pytest

from veritab.operators import header as H
from veritab.operators import metadata as M
from veritab.functions.rules import make_rule
from veritab.plans.staged_run import TableSpec, run_verdicts
from veritab.schemas import FILE_CONFIGURATION, PROCESS_VALIDATION_LOGS, SEMANTIC_LAYER, TRIGGER_CONTROL
from veritab.sources.readers import UNPARSED
from veritab.sources import (
    append_rows, empty_frame, literal_frame, read_table, row_count, schema_clone,
)


def rules(spark, rows):
    return spark.createDataFrame(
        [(t, p, n, None, pk, "STRING", "10", True, None, None, ref, None) for t, p, n, pk, ref in rows],
        SEMANTIC_LAYER)


def test_header_mismatches_all_tables_at_once(spark):
    exp = rules(spark, [("a", 1, "x", False, None), ("a", 2, "Y", False, None),
                        ("b", 1, "p", False, None), ("b", 2, "q", False, None), ("b", 3, "r", False, None)])
    act = H.actual_columns(spark, {"a": spark.createDataFrame([], "x int, y int"),
                                   "b": spark.createDataFrame([], "p int, q int")})
    got = sorted(tuple(r) for r in H.header_mismatches(exp, act).collect())
    assert got == [("a", 2, "Y", "y"), ("b", 3, "r", None)]


def test_validate_header_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert H.validate_header(lambda: df, True, ["a", "b"]).passed
    r = H.validate_header(lambda: df, True, ["a", "B"])                 # case matters
    assert (r.passed, r.rule) == (False, "header")
    r = H.validate_header(lambda: df, False, ["x", "y"])                # H2 rename
    assert r.passed and r.frame.columns == ["x", "y"]
    r = H.validate_header(lambda: df, False, ["x"])                     # H3 arity
    assert (r.passed, r.rule) == (False, "arity")
    missing = str(tmp_path / "nope.parquet")
    r = H.validate_header(lambda: spark.read.parquet(missing), True, ["a"])  # H4
    assert (r.passed, r.rule, r.raw) == (False, "read", None)


def catalog(spark, rows):
    return spark.createDataFrame(
        [(i, n, "csv", "src", p, None, ",", h, False, "u") for i, n, p, h in rows], FILE_CONFIGURATION)


def test_select_tables_text_ids(spark):
    cat = catalog(spark, [("00018", "t18", "p", True), ("00002", "t2", "p", False), ("00013", "t13", "p", True)])
    assert [r[0] for r in M.select_tables(cat).collect()] == ["00002", "00013", "00018"]
    assert [r[0] for r in M.select_tables(cat, ["00018"]).collect()] == ["00018"]
    assert M.catalog_row(cat, "00002")["header"] is False


def test_rule_listings(spark):
    r = rules(spark, [("a", 2, "y", None, "td.y"), ("a", 1, "x", True, None), ("b", 1, "z", False, None)])
    assert [x["field_name"] for x in M.expected_columns(r, "a").collect()] == ["x", "y"]
    assert [x["field_name"] for x in M.reference_rule_columns(r).collect()] == ["y"]
    assert [x["field_name"] for x in M.key_columns(r, "a").collect()] == ["x"]
    assert M.split_reference("myschema.td_templates.template_code") == ("myschema.td_templates", "template_code")
    with pytest.raises(ValueError):
        M.split_reference("nodot")


def test_metadata_constraints(spark):
    cat = catalog(spark, [("1", "a", "p", True), ("1", "b", "p", True)])
    r = rules(spark, [("1", 1, "x", False, None), ("1", 1, "y", False, None), ("9", 1, "z", False, None)])
    got = {(x["kind"], x["table_name"], x["column_name"]): x["violations"]
           for x in M.metadata_constraint_violations(cat, r).collect()}
    assert got[("unique", "file_configuration", "id_type_file")] == 1
    assert got[("foreign_key", "semantic_layer", "id_type_file")] == 1
    assert got[("not_null", "file_configuration", "id_type_file")] == 0
    assert got[("max_length", "file_configuration", "id_type_file")] == 0
    long = catalog(spark, [("123456", "a" * 256, "p", True)])
    got = {(x["kind"], x["column_name"]): x["violations"] for x in M.metadata_constraint_violations(long, r).collect()
           if x["table_name"] == "file_configuration"}
    assert got[("max_length", "id_type_file")] == got[("max_length", "type_file_name")] == 1


def test_log_constraints(spark):
    import datetime as dt

    cat = catalog(spark, [("1", "a", "p", True)])
    now, day = dt.datetime(2025, 1, 1), dt.date(2025, 1, 1)
    triggers = literal_frame(spark, [(11, "1", "a", "PRE", "s", day, now, 1.0, 1, 5), (11, "9", "a", "PRE", "s", day, now, 2.0, 1, 5)],
                             TRIGGER_CONTROL)
    errors = literal_frame(spark, [(12, 2, "s", "Technical", "a", None, None, 1, 32.0, now, day, 1)], PROCESS_VALIDATION_LOGS)
    broken = {(x["kind"], x["table_name"], x["column_name"])
              for x in M.log_constraint_violations(cat, triggers, errors).where("not passed").collect()}
    assert broken == {("unique", "trigger_control", "id_trigger"), ("foreign_key", "trigger_control", "id_type_file"),
                      ("foreign_key", "process_validation_logs", "id_trigger")}


def test_csv_header_and_separator(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a;b\n1;x\n2;\n")
    df = read_table(spark, str(p), "csv", header=True, separator=";")
    assert df.columns == ["a", "b", UNPARSED]
    assert [tuple(r) for r in df.collect()] == [("1", "x", None), ("2", None, None)]   # text kept, empty is null
    df = read_table(spark, str(p), "csv", header=False, separator=";")
    assert df.count() == 3


def folder(path, **files):
    path.mkdir()
    for name, text in files.items():
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_every_file_of_a_csv_table_is_read_by_its_own_header(spark, tmp_path):
    path = folder(tmp_path / "t", a="a,b\n1,x\n", b="b,a\ny,2\nz,3\n", c="a,b\n4,w\n", d="", e="\n\na,b\n")
    df = read_table(spark, path, "csv", header=True)
    assert df.columns == ["a", "b", UNPARSED]
    assert sorted(tuple(r)[:2] for r in df.collect()) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")]
    # a partition of the plan per group of files, and no file read twice
    assert len(df.inputFiles()) == len(set(df.inputFiles())) == 4
    got = H.validate_header(lambda: df, True, ["a", "b"])
    assert (got.passed, got.rule) == (False, "header")
    assert got.message.endswith("in 1 of 4 files: b.csv (b, a)")
    from veritab.sources.csv_headers import header_verdicts

    verdicts = {os.path.basename(r["file"]): r["passed"] for r in header_verdicts(spark, path, ["a", "b"]).collect()}
    assert verdicts == {"a.csv": True, "b.csv": False, "c.csv": True, "e.csv": True}
    verdict = run_verdicts(spark, [TableSpec("t", "t", True, lambda: df, [make_rule("a", "INT", 3), make_rule("b", "STRING", 3)])],
                           lambda name: None).first()
    assert (verdict["rule"], verdict["passed"], verdict["row_count"]) == ("header", False, 4) and "b.csv" in verdict["message"]


def test_odd_file_names(spark, tmp_path):
    path = folder(tmp_path / "a b+c%20", **{"x 1": "a,b\n1,2\n", "y+%2": "b,a\n4,3\n"})
    df = read_table(spark, path, "csv", header=True)
    assert sorted(tuple(r)[:2] for r in df.collect()) == [("1", "2"), ("3", "4")]


def test_file_headers_of_odd_files(spark, tmp_path):
    path = folder(tmp_path / "t", a='#note\n"x;1";y;y;\n1;2;3;4\n', b="x;1\n5;6\n", c="lone\n")
    df = read_table(spark, path, "csv", header=True, separator=";", options={"comment": "#"})
    headers = df.schema[UNPARSED].metadata["file_headers"]
    assert sorted(h["columns"] for h in headers) == [["lone"], ["x", "1"], ["x;1", "y", "y"]]
    assert {"x;1", "y1", "y2", "x", "1", "lone"} <= set(df.columns)
    good = folder(tmp_path / "good", a="a,b\n1,2\n")
    assert H.validate_header(lambda: read_table(spark, good, "csv", header=True), True, ["a", "b"]).passed
    empty = folder(tmp_path / "empty", a="")
    assert H.validate_header(lambda: read_table(spark, empty, "csv", header=True), True, ["a"]).rule == "header"
    assert H.validate_header(lambda: read_table(spark, str(tmp_path / "none"), "csv", header=True), True, ["a"]).rule == "read"


def test_heads_of_large_files_are_found_without_a_scan(spark, tmp_path):
    """Each split hands on one line; the header is the one of the split that starts the file."""
    from veritab.sources import csv_headers

    big = "a,b\n" + "".join(f"{i},{'v' * 50}\n" for i in range(40_000))
    path = folder(tmp_path / "big", x=big, y=big.replace("a,b", "b,a", 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        lines = csv_headers.first_records(spark, path)
        assert sorted(r["line"] for r in lines.collect()) == ["a,b", "b,a"]
        df = read_table(spark, path, "csv", header=True)
        assert df.where("a like 'v%' and b not like 'v%'").count() == df.where("b like 'v%' and a not like 'v%'").count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_values_stay_as_written(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": 1.50, "b": "007", "c": true}\n{"a": 2, "b": null}\n')
    df = read_table(spark, str(tmp_path / "t.json"), "json")
    assert sorted((tuple(r) for r in df.collect()), key=str) == [("1.50", "007", "true"), ("2", None, None)]


def test_csv_surplus_fields_are_violations(spark, tmp_path):
    from veritab.functions.rules import make_rule
    from veritab.plans.staged_run import TableSpec, run_verdicts

    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,x\n3,4,SURPLUS\n5\n")
    rules = [make_rule("a", "INT", 3, position=1), make_rule("b", "STRING", 3, position=2)]
    for header in (True, False):
        if not header:
            p.write_text("1,x\n3,4,SURPLUS\n5\n")
        df = read_table(spark, str(p), "csv", header=header)
        assert [r[UNPARSED] for r in df.collect()] == [None, "3,4,SURPLUS", "5"]
        v = {r["rule"]: r for r in run_verdicts(
            spark, [TableSpec("t", "t", header, lambda d=df: d, rules)], lambda name: None).collect()}
        assert v["header"]["passed"] and v["type:INT"]["passed"]
        assert (v["record"]["violations"], v["record"]["passed"], v["record"]["stage"]) == (2, False, 2)


def test_row_count_schema_clone_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert row_count(df).first()["row_count"] == 2
    clone = schema_clone(df)
    assert clone.schema == df.schema and clone.count() == 0
    assert empty_frame(spark, df.schema).count() == 0


def test_append_sink_round_trip(spark, tmp_path):
    from veritab.schemas import TRIGGER_CONTROL
    import datetime as dt
    target = str(tmp_path / "trigger_control")
    row = (1, "00001", "t", "PRE", "src", dt.date(2025, 1, 1), dt.datetime(2025, 1, 1), 1.2, 20250101000000, 5)
    append_rows(literal_frame(spark, [row], TRIGGER_CONTROL), target)
    append_rows(literal_frame(spark, [row], TRIGGER_CONTROL), target)
    assert spark.read.parquet(target).count() == 2


def test_recreate_and_insert_into_catalog_table(spark, tmp_path):
    from veritab.sources import insert_into, recreate_table
    from veritab.schemas import TD_TEMPLATES

    name = f"td_templates_{os.getpid()}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = literal_frame(spark, [("s", "1", "one")], TD_TEMPLATES)
    spark.sql(f"CREATE TABLE {name} (source STRING, template_code STRING, template_text STRING) "
              f"USING parquet LOCATION '{tmp_path / 't'}'")
    insert_into(first, name)                                            # S6
    assert spark.table(name).count() == 1
    recreate_table(spark, literal_frame(spark, [("s", "2", "two"), ("s", "3", "three")], TD_TEMPLATES),
                   name)                                                # S7
    assert sorted(r[0] for r in spark.table(name).select("template_code").collect()) == ["2", "3"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("fmt", ["json", "orc", "parquet"])
def test_other_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    path = str(tmp_path / fmt)
    df.write.format(fmt).save(path)
    back = read_table(spark, path, fmt)
    # json values are text as written
    want = [("a", "1"), ("b", "2")] if fmt == "json" else [("a", 1), ("b", 2)]
    assert sorted(tuple(r) for r in back.select("x", "y").collect()) == want


def test_cache_for_several_passes(spark):
    from veritab.sources import cache_for_passes, release

    df = cache_for_passes(spark.range(100))
    assert df.count() == 100 and df.is_cached
    release(df)
    assert not df.is_cached


class _Recorder:
    """Stands for a session and its reader: keeps the options, asks no database."""

    def __init__(self):
        self.options, self.loads = {}, []
        self.read = self
        self.sparkContext = type("Context", (), {"defaultParallelism": 8})

    def format(self, name):
        self.options = {"format": name}
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        self.loads.append(dict(self.options))
        return self

    def collect(self):
        return answer(self.options["query"], list(range(3, 901)))

    def jdbc(self, url, table, predicates, properties):
        self.loads.append({"url": url, "table": table, "predicates": predicates, **properties})
        return self


def answer(sql, values):
    """What a database with these values of column id answers to the two kinds of questions."""
    present = [v for v in values if v is not None]
    if sql.startswith("SELECT MIN(id)"):
        return [(min(present, default=None), max(present, default=None), len(present))]
    low, step, high = map(Decimal, re.fullmatch(
        r"SELECT FLOOR\(\(id - \((\S+)\)\) / (\S+)\) AS bucket, COUNT\(\*\) AS n FROM s\.t "
        r"WHERE id >= \S+ AND id <= (\S+) GROUP BY .*", sql).groups())
    return list(Counter((Decimal(str(v)) - low) // step for v in present if low <= Decimal(str(v)) <= high).items())


def test_partitioned_jdbc_options_of_a_table():
    from veritab.sources.readers import read_with_options

    seen = _Recorder()
    read_with_options(seen, "s.t", "jdbc", {"url": "jdbc:x", "user": "u", "partitionColumn": "id", "numPartitions": "40"})
    *asked, table = seen.loads
    assert "MIN(id)" in asked[0]["query"] and all(q["user"] == "u" for q in asked)
    assert (table["url"], table["table"], table["user"], table["fetchsize"]) == ("jdbc:x", "s.t", "u", "50000")
    assert len(table["predicates"]) == 40
    seen = _Recorder()
    read_with_options(seen, "s.t", "JDBC", {"url": "jdbc:x", "partitionColumn": "id", "lowerBound": "1", "upperBound": "9"})
    assert len(seen.loads) == 1 and (seen.loads[0]["lowerBound"], seen.loads[0]["numPartitions"]) == ("1", "8")


def held(predicate, v):
    """Rows of a predicate of the forms that the reader writes."""
    null, text = v is None, predicate.replace(" OR id IS NULL", "")
    if null:
        return "IS NULL" in predicate or predicate == "1 = 1"
    return predicate == "1 = 1" or all(
        {"<": Decimal(str(v)) < Decimal(b), ">=": Decimal(str(v)) >= Decimal(b)}[op]
        for op, b in re.findall(r"id (<|>=) (\S+)", text))


@pytest.mark.parametrize("values, parts, largest", [
    (list(range(1000)), 8, 150),
    ([int(1.01 ** i) for i in range(3000)], 16, 320),                          # most rows near 0, range 10^12
    ([5] * 700 + list(range(300)), 10, 760),                                   # one value cannot be divided
    ([10 ** 15] + list(range(500)) + [None] * 40, 5, 190),
    ([i / 1000 for i in range(900)] + [10 ** 6], 6, 220),
    ([-7] * 10, 4, 10), ([], 4, 0), ([None, None], 4, 2), ([1, 2], 8, 1),
])
def test_jdbc_ranges_hold_equal_numbers_of_rows(values, parts, largest):
    from veritab.sources.jdbc_ranges import BUCKETS, ROUNDS, equi_depth_predicates

    asked = []

    def ask(sql):
        asked.append(sql)
        rows = answer(sql, values)
        assert len(rows) <= BUCKETS + 1
        return rows

    predicates = equi_depth_predicates(ask, "s.t", "id", parts)
    counts = [sum(held(p, v) for v in values) for p in predicates]
    assert sum(counts) == len(values) and len(predicates) <= parts             # every row once
    assert all(sum(held(p, v) for p in predicates) == 1 for v in values)
    assert max(counts, default=0) <= largest
    assert len(asked) <= 1 + 2 * parts * ROUNDS
