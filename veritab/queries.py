"""Registered queries over the benchmark tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
The benchmark tables are typed and clean, so faults are derived in views
with expressions that DuckDB evaluates alike (see ``veritab.oracle``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab import benchmark_catalog as C
from veritab.functions import predicates as P
from veritab.functions.rules import collect_rules, decode_rules, make_rule
from veritab.operators import functional, references, technical
from veritab.operators.header import (
    actual_columns, arity_matches, header_mismatches, rename_by_position,
)
from veritab.operators.metadata import Constraint as K
from veritab.operators.metadata import (
    constraint_violations, expected_columns, reference_rule_columns, select_tables, split_reference,
)
from veritab.plans import logs
from veritab.plans.staged_run import run_verdicts, specs_from_metadata
from veritab.schemas import SEMANTIC_LAYER
from veritab.sources.readers import read_driver_table as _read
from veritab.sources.readers import row_count


# --------------------------------------------------------------------------
# views
# --------------------------------------------------------------------------

def li_view(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with three text columns carrying derived faults.

    pk_txt:    NULL when l_linenumber = 7, 'x'||l_partkey when 6, else l_partkey
    price_txt: l_extendedprice as DECIMAL(12,2) text
    ship_txt:  yyyy-MM- + two-digit day (+40 when l_linenumber = 5) + ' +01'
    """
    li = _read(spark, sf, "lineitem")
    key_txt = F.col("l_partkey").cast("string")
    pk_txt = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
              .when(F.col("l_linenumber") == 6, F.concat(F.lit("x"), key_txt))
              .otherwise(key_txt))
    day = F.dayofmonth("l_shipdate") + F.when(F.col("l_linenumber") == 5, 40).otherwise(0)
    ship_txt = F.concat(F.date_format("l_shipdate", "yyyy-MM-"),
                        F.lpad(day.cast("string"), 2, "0"), F.lit(" +01"))
    return li.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        pk_txt.alias("pk_txt"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price_txt"),
        ship_txt.alias("ship_txt"),
    )


# rules of the lineitem text view
LI_RULES = [
    make_rule("pk_txt", "INT", 4, nullable=False, position=1),
    make_rule("price_txt", "DECIMAL(6,2)", 10, nullable=True, position=2),
    make_rule("ship_txt", "DATE", 14, nullable=True, position=3),
]


# --------------------------------------------------------------------------
# technical stage
# --------------------------------------------------------------------------

def q_column_violation_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Violations per column of the lineitem text view, one pass."""
    counts = technical.column_violation_counts(li_view(spark, sf), LI_RULES, with_row_count=True)
    return counts.select(
        F.lit("lineitem").alias("table_name"), "column_name", "field_position",
        "violations", "row_count", (F.col("violations") == 0).alias("passed"),
    )




def _verdict(df: DataFrame, table: str, column: str, rule: str, pred) -> DataFrame:
    """One verdict row: table_name, column_name, rule, violations, passed."""
    return df.agg(F.count_if(pred).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(rule).alias("rule"), "violations", (F.col("violations") == 0).alias("passed"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def q_check_not_null(spark, sf):
    """pk_txt must not be null."""
    return _verdict(li_view(spark, sf), "lineitem", "pk_txt", "not_null", P.is_null(F.col("pk_txt")))


def q_check_max_length(spark, sf):
    """Documents.text <= 2000 characters; part.p_type <= 6."""
    docs = _read(spark, sf, "documents")
    part = _read(spark, sf, "part")
    return _union([
        _verdict(docs, "documents", "text", "max_length(2000)", P.too_long(F.col("text"), 2000)),
        _verdict(part, "part", "p_type", "max_length(6)", P.too_long(F.col("p_type"), 6)),
    ])


def q_check_int(spark, sf):
    """pk_txt as a nullable INT of length 4, and of length 3."""
    li = li_view(spark, sf)
    return _union([
        _verdict(li, "lineitem", "pk_txt", f"INT({n})",
                 P.violation_predicate(make_rule("pk_txt", "INT", n, nullable=True)))
        for n in (4, 3)
    ])


def q_check_decimal(spark, sf):
    """T4: price_txt as DECIMAL(6,2), length 10."""
    rule = make_rule("price_txt", "DECIMAL(6,2)", 10, nullable=True)
    return _verdict(li_view(spark, sf), "lineitem", "price_txt", "DECIMAL(6,2)", P.violation_predicate(rule))


def q_check_decimal_comma(spark, sf):
    """T4 with a declared decimal symbol: price text written with a comma."""
    li = li_view(spark, sf).withColumn("price_comma", F.translate("price_txt", ".", ","))
    rule = make_rule("price_comma", "DECIMAL(6,2)", 10, nullable=True, decimal_symbol=",")
    return _verdict(li, "lineitem", "price_comma", "DECIMAL(6,2) comma", P.violation_predicate(rule))


def q_check_date_offset(spark, sf):
    """T5: ship_txt as a date with hour offset, length 14."""
    rule = make_rule("ship_txt", "DATE", 14, nullable=True)
    return _verdict(li_view(spark, sf), "lineitem", "ship_txt", "DATE", P.violation_predicate(rule))


def q_check_unknown_type(spark, sf):
    """An unknown type and a malformed decimal type fail every row."""
    part = _read(spark, sf, "part")
    return _union([
        _verdict(part, "part", "p_name", dt, P.violation_predicate(make_rule("p_name", dt, 55)))
        for dt in ("BLOB", "DECIMAL(8)")
    ])


def q_row_violations(spark, sf):
    """Lineitem rows breaking any rule of the text view."""
    return technical.row_violations(li_view(spark, sf), LI_RULES,
                                    keep=["l_orderkey", "l_linenumber", "l_partkey"])


LI_KEY = ["l_orderkey", "l_linenumber"]


def q_pk_summary(spark, sf):
    """Key uniqueness of lineitem (l_orderkey, l_linenumber) and orders (o_orderkey)."""
    def one(table, keys):
        return technical.key_summary(_read(spark, sf, table), keys).select(
            F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"),
            "row_count", "distinct_keys", "duplicated_keys", "passed")
    return one("lineitem", LI_KEY).unionByName(one("orders", ["o_orderkey"]))


def q_pk_duplicates(spark, sf):
    """T8 detail: duplicated (l_orderkey, l_linenumber) keys with their count."""
    return technical.key_duplicates(_read(spark, sf, "lineitem"), LI_KEY)


# --------------------------------------------------------------------------
# referential integrity
# --------------------------------------------------------------------------

def allowed_nations(spark, sf):
    """Reference set: nations outside region 4."""
    return _read(spark, sf, "nation").where(F.col("n_regionkey") != 4)


def allowed_priorities(spark, sf):
    """Reference set: order priorities with code 1, 2 or 3, given, not read from the tested table."""
    return spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "o_orderpriority string")


def reference_rules(spark, sf):
    """(table, position, column, tested frame, reference frame, reference column)."""
    customer = _read(spark, sf, "customer")
    orders = _read(spark, sf, "orders")
    documents = _read(spark, sf, "documents")
    lineitem = _read(spark, sf, "lineitem")
    return [
        ("customer", 3, "c_nationkey", customer, allowed_nations(spark, sf), "n_nationkey"),
        ("orders", 2, "o_custkey", orders, _read(spark, sf, "customer"), "c_custkey"),
        ("orders", 6, "o_orderpriority", orders, allowed_priorities(spark, sf), "o_orderpriority"),
        ("documents", 1, "doc_id", documents, _read(spark, sf, "labels"), "doc_id"),
        ("lineitem", 2, "l_partkey", lineitem, _read(spark, sf, "part"), "p_partkey"),
        ("lineitem", 3, "l_suppkey", lineitem, _read(spark, sf, "supplier"), "s_suppkey"),
    ]


def q_ri_clean(spark, sf):
    """R2 on a clean reference: lineitem.l_partkey -> part.p_partkey (count row)."""
    v = references.reference_violation_count(_read(spark, sf, "lineitem"), "l_partkey",
                                             _read(spark, sf, "part"), "p_partkey")
    return v.select(F.lit("lineitem").alias("table_name"), F.lit("l_partkey").alias("column_name"),
                    F.lit("part.p_partkey").alias("reference"), "violations",
                    (F.col("violations") == 0).alias("passed"))


def q_ri_violations(spark, sf):
    """R2: offending rows of three reference rules."""
    customer = _read(spark, sf, "customer")
    orders = _read(spark, sf, "orders")
    documents = _read(spark, sf, "documents")
    nations, priorities, labels = allowed_nations(spark, sf), allowed_priorities(spark, sf), \
        _read(spark, sf, "labels")
    parts = [
        references.reference_violations(customer, "c_nationkey", nations, "n_nationkey")
        .select(F.lit("customer").alias("table_name"), F.lit("c_nationkey").alias("column_name"),
                F.col("c_custkey").alias("row_key"), F.col("c_nationkey").cast("string").alias("value")),
        references.reference_violations(orders, "o_orderpriority", priorities, "o_orderpriority")
        .select(F.lit("orders").alias("table_name"), F.lit("o_orderpriority").alias("column_name"),
                F.col("o_orderkey").alias("row_key"), F.col("o_orderpriority").alias("value")),
        references.reference_violations(documents, "doc_id", labels, "doc_id")
        .select(F.lit("documents").alias("table_name"), F.lit("doc_id").alias("column_name"),
                F.col("doc_id").alias("row_key"), F.col("doc_id").cast("string").alias("value")),
    ]
    return _union(parts)


def q_ri_columns(spark, sf):
    """Per table, failing reference columns (incidences) and their names."""
    rules = reference_rules(spark, sf)
    per_column = _union([
        references.reference_violation_count(df, col, ref, ref_col).select(
            F.lit(table).alias("table_name"), F.lit(pos).cast("int").alias("field_position"),
            F.lit(col).alias("column_name"), "violations")
        for table, pos, col, df, ref, ref_col in rules
    ])
    return references.failing_columns_summary(per_column)


# --------------------------------------------------------------------------
# functional rules
# --------------------------------------------------------------------------

LINE_REQUIRED = (1, 2, 3)
ROLE_REQUIRED = ("system", "user", "assistant")


def _required_specs(spark, sf):
    return [
        ("lineitem", _read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", LINE_REQUIRED),
        ("conversations", _read(spark, sf, "conversations"), "conv_id", "role", ROLE_REQUIRED),
    ]


def q_required_any(spark, sf):
    """At least one row carries a required value."""
    return _union([
        functional.required_any(df, v, vals).select(F.lit(t).alias("table_name"),
                                                     "rows_with_required", "passed")
        for t, df, g, v, vals in _required_specs(spark, sf)
    ])


def q_required_excess(spark, sf):
    """(group, required value) pairs occurring more than once."""
    return _union([
        functional.required_excess(df, [g], v, vals).select(
            F.lit(t).alias("table_name"), F.col(g).alias("group_key"),
            F.col(v).cast("string").alias("value"), "n")
        for t, df, g, v, vals in _required_specs(spark, sf)
    ])


def q_required_missing(spark, sf):
    """Groups holding only part of the required set."""
    return _union([
        functional.required_missing(df, [g], v, vals).select(
            F.lit(t).alias("table_name"), F.col(g).alias("group_key"), "n_present")
        for t, df, g, v, vals in _required_specs(spark, sf)
    ])


def q_group_prefix_missing(spark, sf):
    """F2 detail: conversations without an assistant-like role (prefix 'ass')."""
    conv = _read(spark, sf, "conversations")
    return functional.group_prefix_missing(conv, ["conv_id"], "role", "ass") \
        .select(F.lit("conversations").alias("table_name"), F.col("conv_id").alias("group_key"))


def q_group_prefix_incidences(spark, sf):
    """F2 verdict: incidences = groups without the prefix."""
    conv = _read(spark, sf, "conversations")
    return functional.group_prefix_incidences(conv, ["conv_id"], "role", "ass") \
        .select(F.lit("conversations").alias("table_name"), "groups", "groups_with_prefix",
                "incidences", "passed")


def q_prefix_violations(spark, sf):
    """pages.url must start with 'https'; part.p_brand with 'Brand#1'."""
    pages = _read(spark, sf, "pages")
    part = _read(spark, sf, "part")
    return _union([
        functional.pattern_violations(pages, "url", "https").select(
            F.lit("pages").alias("table_name"), F.col("page_id").alias("row_key"),
            F.col("url").alias("value")),
        functional.pattern_violations(part, "p_brand", "Brand#1").select(
            F.lit("part").alias("table_name"), F.col("p_partkey").alias("row_key"),
            F.col("p_brand").alias("value")),
    ])


def q_prefix_like_wildcard(spark, sf):
    """F3 compat: SQL LIKE '_rand#1%', where '_' is a wildcard."""
    part = _read(spark, sf, "part")
    return functional.pattern_violations(part, "p_brand", "_rand#1", mode="like").select(
        F.lit("part").alias("table_name"), F.col("p_partkey").alias("row_key"),
        F.col("p_brand").alias("value"))


PART_COLUMN_COUNT = 30


def cell_reference(size, key):
    """A cell reference built from part columns: letters from p_size
    (1-26 -> a-z, 27-50 -> aa-ax), row number p_partkey + 1."""
    letters = F.when(size <= 26, F.char(size + 96)).otherwise(F.concat(F.lit("a"), F.char(size + 70)))
    return F.concat(letters, (key + 1).cast("string"))


def part_cells(spark, sf):
    part = _read(spark, sf, "part")
    return part.select("p_partkey", cell_reference(F.col("p_size"), F.col("p_partkey")).alias("excel_cell"))


def q_cell_parse(spark, sf):
    """Letters, row number and base-26 column number of each cell."""
    return functional.with_cell_parts(part_cells(spark, sf), "excel_cell")


def q_cell_out_of_bounds(spark, sf):
    """Cells at or past row_count (rows of part) or column 30."""
    cells = part_cells(spark, sf)
    return functional.cell_out_of_bounds(cells, "excel_cell", column_count=PART_COLUMN_COUNT) \
        .select("p_partkey", "excel_cell", "row_num", "col_num")


# --------------------------------------------------------------------------
# sources and metadata
# --------------------------------------------------------------------------

ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def q_row_count(spark, sf):
    """Exact BIGINT row count of every benchmark table."""

    return _union([row_count(_read(spark, sf, t)).select(F.lit(t).alias("table_name"), "row_count")
                   for t in ALL_TABLES])


def q_catalog_select(spark, sf):
    """M1 + S2: the selected catalog entries in id order, with their tables' row counts."""

    views = C.views(spark, sf)
    chosen = select_tables(C.catalog_frame(spark), CATALOG_IDS)
    counts = _union([row_count(views[r["origin_path"]]()).select(
        F.lit(r["id_type_file"]).alias("id_type_file"), "row_count")
        for r in chosen.select("id_type_file", "origin_path").collect()])
    return chosen.join(counts, "id_type_file").select("id_type_file", "type_file_name", "header", "row_count")


CATALOG_IDS = ("00002", "00005", "00006", "00008")
SCHEMA_IDS = ("00001", "00002", "00006")


def _checked_frame(views, row, names):
    """A table as the header stage hands it on (renamed when it has no header)."""

    df = views[row["origin_path"]]()
    return df if row["header"] else rename_by_position(df, names)


def q_expected_schema(spark, sf):
    """M3: expected columns in position order, with the non-null count each holds."""

    views = C.views(spark, sf)
    rules = C.rules_frame(spark)
    frames = []
    for row in select_tables(C.catalog_frame(spark), SCHEMA_IDS).collect():
        tid = row["id_type_file"]
        cols = expected_columns(rules, tid).collect()
        names = [c["field_name"] for c in cols]
        df = _checked_frame(views, row, names)
        one = df.agg(*[F.count(F.col(n)).alias(f"__n{i}") for i, n in enumerate(names)])
        frames.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(tid).alias("id_type_file"), F.lit(c["field_position"]).alias("field_position"),
                     F.lit(c["field_name"]).alias("field_name"),
                     F.col(f"__n{i}").cast("bigint").alias("non_null"))
            for i, c in enumerate(cols)]))))
    return _union(frames)


def q_ref_rule_columns(spark, sf):
    """M4 + R1: columns with a reference rule and the number of distinct
    allowed values on their reference side."""

    views = C.views(spark, sf)
    frames = []
    for r in reference_rule_columns(C.rules_frame(spark)).collect():
        table, column = split_reference(r["referential_table_field_name"])
        allowed = references.allowed_values(views[table](), column)
        frames.append(allowed.agg(F.count(F.lit(1)).cast("bigint").alias("allowed_values")).select(
            F.lit(r["id_type_file"]).alias("id_type_file"),
            F.lit(r["field_position"]).cast("int").alias("field_position"),
            F.lit(r["field_name"]).alias("field_name"),
            F.lit(r["referential_table_field_name"]).alias("referential_table_field_name"),
            "allowed_values"))
    return _union(frames)


# rules over part covering every decoding outcome:
# (position, column, data_type, length, nullable, decimal_symbol)
EDGE_RULES = [
    (1, "p_partkey", "INT", "5", False, None),
    (2, "p_name", "BLOB", "55", True, None),
    (3, "p_brand", "DECIMAL(8)", "10", True, None),
    (4, "p_type", "STRING", "abc", True, None),
    (5, "p_size", "INT", "0", True, None),
    (6, "p_retailprice", "DECIMAL(4,6)", "12", True, None),
    (7, "p_size", "DATETIME", "14", True, None),
    (8, "p_name", None, "55", True, None),
    (9, "p_size", "DECIMAL(4,0)", "6", None, ","),
    (10, "p_type", "STRING", " 20 ", True, None),
    (11, "p_partkey", "INT", "3", True, None),
]


def edge_rules_frame(spark):

    rows = [("00011", pos, name, None, False, dt, length, nullable, sym, None, None, None)
            for pos, name, dt, length, nullable, sym in EDGE_RULES]
    return spark.createDataFrame(rows, SEMANTIC_LAYER)


def q_rule_decode(spark, sf):
    """M6: decoded rules (kind, length, digits, symbol, defaults, rule error)
    with each rule's violation count over part, in one pass."""

    decoded = decode_rules(edge_rules_frame(spark))
    rules = collect_rules(decoded)
    counts = technical.column_violation_counts(_read(spark, sf, "part"), rules)
    return decoded.join(counts.select("field_position", "violations"), "field_position").select(
        "field_position", "field_name", "data_type", "kind", "max_length", "precision", "scale", "symbol",
        "is_nullable", "is_pk", "rule_error", "violations")


def q_metadata_fk(spark, sf):
    """M7: declared NOT NULL, UNIQUE and FOREIGN KEY constraints of the
    benchmark schema, checked over whole tables."""

    frames = {t: _read(spark, sf, t) for t in (
        "region", "nation", "supplier", "customer", "part", "orders", "lineitem", "documents", "labels")}
    constraints = [
        K("not_null", "orders", ("o_orderkey", "o_custkey")),
        K("not_null", "lineitem", ("l_orderkey", "l_partkey", "l_suppkey")),
        K("unique", "region", ("r_regionkey",)),
        K("unique", "nation", ("n_nationkey",)),
        K("unique", "supplier", ("s_suppkey",)),
        K("unique", "customer", ("c_custkey",)),
        K("unique", "part", ("p_partkey",)),
        K("unique", "orders", ("o_orderkey",)),
        K("unique", "documents", ("doc_id",)),
        K("foreign_key", "nation", ("n_regionkey",), "region", "r_regionkey"),
        K("foreign_key", "supplier", ("s_nationkey",), "nation", "n_nationkey"),
        K("foreign_key", "customer", ("c_nationkey",), "nation", "n_nationkey"),
        K("foreign_key", "orders", ("o_custkey",), "customer", "c_custkey"),
        K("foreign_key", "lineitem", ("l_orderkey",), "orders", "o_orderkey"),
        K("foreign_key", "lineitem", ("l_partkey",), "part", "p_partkey"),
        K("foreign_key", "lineitem", ("l_suppkey",), "supplier", "s_suppkey"),
        K("foreign_key", "labels", ("doc_id",), "documents", "doc_id"),
    ]
    return constraint_violations(frames, constraints)


# --------------------------------------------------------------------------
# header stage
# --------------------------------------------------------------------------

# expected header per table: region exact, nation with a wrongly cased name,
# supplier with one column more than the table has
HEADER_EXPECTED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "N_NAME", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_comment"],
}
ARITY_EXPECTED = {
    "region": ["regionkey", "name"],
    "nation": ["nationkey", "name"],
    "supplier": ["suppkey", "name", "nationkey", "acctbal"],
}


def _expected_frame(spark, expected):

    rows = [(t, i, n, None, False, "STRING", "255", True, None, None, None, None)
            for t, names in expected.items() for i, n in enumerate(names, 1)]
    return spark.createDataFrame(rows, SEMANTIC_LAYER)


def q_header_mismatch(spark, sf):
    """H1: positions whose actual name differs from the expected one (exact,
    case-sensitive, missing on either side), with the table's row count."""

    frames = {t: _read(spark, sf, t) for t in HEADER_EXPECTED}
    mism = header_mismatches(_expected_frame(spark, HEADER_EXPECTED), actual_columns(spark, frames))
    counts = _union([row_count(df).select(F.lit(t).alias("table_id"), "row_count") for t, df in frames.items()])
    return mism.join(counts, "table_id").select(
        F.col("table_id").alias("table_name"), "position", "expected_name", "actual_name", "row_count")


def q_header_rename(spark, sf):
    """H2: a table without a header takes its names by position."""

    return rename_by_position(_read(spark, sf, "supplier"), ARITY_EXPECTED["supplier"])


def q_header_arity(spark, sf):
    """H3: expected vs actual column count before renaming, with row count."""

    frames = []
    for t, names in ARITY_EXPECTED.items():
        df = _read(spark, sf, t)
        frames.append(row_count(df).select(
            F.lit(t).alias("table_name"), F.lit(len(names)).cast("int").alias("expected_count"),
            F.lit(len(df.columns)).cast("int").alias("actual_count"), "row_count",
            F.lit(arity_matches(df, names)).alias("passed")))
    return _union(frames)


# --------------------------------------------------------------------------
# staged run over the benchmark catalog
# --------------------------------------------------------------------------

RUN_TS = "2025-01-01 00:00:00"


def run_verdict_frame(spark, sf, fail_fast: bool = False):

    views = C.views(spark, sf)
    specs = specs_from_metadata(C.catalog_frame(spark), C.rules_frame(spark),
                                lambda row: views[row["origin_path"]](), C.FUNCTIONAL)
    return run_verdicts(spark, specs, lambda name: views[name](), fail_fast=fail_fast)


def q_stage_verdicts(spark, sf):
    """All verdict rows of the staged run (every check of every table)."""
    return run_verdict_frame(spark, sf)


def q_table_verdict(spark, sf):
    """O1: first failed stage, final flag and row count per table."""

    return logs.table_status(run_verdict_frame(spark, sf)).select(
        "table_id", "table_name", "failed_stage", "flag", "stages_passed", "row_count")


def q_progress_summary(spark, sf):
    """O2: stages passed per table."""

    return logs.progress(run_verdict_frame(spark, sf))


def q_trigger_rows(spark, sf):
    """L1: status rows of the run."""

    return logs.trigger_rows(run_verdict_frame(spark, sf), RUN_TS)


def q_validation_log_rows(spark, sf):
    """L2: error rows of the run."""

    return logs.validation_logs(run_verdict_frame(spark, sf), RUN_TS)


def q_latest_trigger(spark, sf):
    """L3: newest status row per table."""

    return logs.latest_trigger(logs.trigger_rows(run_verdict_frame(spark, sf), RUN_TS))


def q_flag_assign(spark, sf):
    """L4: flag written by each stage of each table."""

    return logs.stage_flags(run_verdict_frame(spark, sf))


def q_stage_error_summary(spark, sf):
    """Failing stages with combined message, fields and incidences."""

    return logs.stage_summary(run_verdict_frame(spark, sf)).where(~F.col("passed")).select(
        "table_id", "table_name", "stage", "type_validation", "validation_msg", "field_name",
        "incidences")


QUERIES = {
    "check_not_null": q_check_not_null,
    "check_max_length": q_check_max_length,
    "check_int": q_check_int,
    "check_decimal": q_check_decimal,
    "check_decimal_comma": q_check_decimal_comma,
    "check_date_offset": q_check_date_offset,
    "check_unknown_type": q_check_unknown_type,
    "row_violations": q_row_violations,
    "column_violation_counts": q_column_violation_counts,
    "pk_summary": q_pk_summary,
    "pk_duplicates": q_pk_duplicates,
    "ri_clean": q_ri_clean,
    "ri_violations": q_ri_violations,
    "ri_columns": q_ri_columns,
    "required_any": q_required_any,
    "required_excess": q_required_excess,
    "required_missing": q_required_missing,
    "group_prefix_missing": q_group_prefix_missing,
    "group_prefix_incidences": q_group_prefix_incidences,
    "prefix_violations": q_prefix_violations,
    "prefix_like_wildcard": q_prefix_like_wildcard,
    "cell_parse": q_cell_parse,
    "cell_out_of_bounds": q_cell_out_of_bounds,
    "row_count": q_row_count,
    "catalog_select": q_catalog_select,
    "expected_schema": q_expected_schema,
    "ref_rule_columns": q_ref_rule_columns,
    "rule_decode": q_rule_decode,
    "metadata_fk": q_metadata_fk,
    "header_mismatch": q_header_mismatch,
    "header_rename": q_header_rename,
    "header_arity": q_header_arity,
    "stage_verdicts": q_stage_verdicts,
    "table_verdict": q_table_verdict,
    "progress_summary": q_progress_summary,
    "trigger_rows": q_trigger_rows,
    "validation_log_rows": q_validation_log_rows,
    "latest_trigger": q_latest_trigger,
    "flag_assign": q_flag_assign,
    "stage_error_summary": q_stage_error_summary,
}
FLAGSHIP = "table_verdict"
