"""DuckDB oracle SQL, one statement per registered query.

Views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are
pre-registered by the caller.  Column names and types match the Spark
queries: counts are BIGINT, flags DOUBLE.
"""

from __future__ import annotations

LI = r"""
li AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN NULL
         WHEN l_linenumber = 6 THEN 'x' || CAST(l_partkey AS VARCHAR)
         ELSE CAST(l_partkey AS VARCHAR) END AS pk_txt,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price_txt,
    strftime(l_shipdate, '%Y-%m-')
      || lpad(CAST(day(l_shipdate) + CASE WHEN l_linenumber = 5 THEN 40 ELSE 0 END AS VARCHAR), 2, '0')
      || ' +01' AS ship_txt
  FROM lineitem
)"""

# per-column predicates of the lineitem text view (same rules as LI_RULES)
LI_PK_BAD = r"(pk_txt IS NULL OR length(pk_txt) > 4 OR NOT regexp_matches(pk_txt, '^-?\d{1,4}\z'))"
LI_PRICE_BAD = r"(length(price_txt) > 10 OR NOT regexp_matches(price_txt, '^-?\d{1,4}\Q.\E\d{2}\z'))"
LI_SHIP_BAD = (r"(ship_txt IS NOT NULL AND (length(ship_txt) > 14"
               r" OR try_cast(substr(ship_txt, 1, 10) AS DATE) IS NULL"
               r" OR NOT regexp_matches(ship_txt, '^\d{4}-(0[0-9]|1[0-2])-\d{2}\s[+-](0[0-9]|1[0-4])\z')))")

SQL: dict[str, str] = {}

SQL["column_violation_counts"] = f"""
WITH {LI},
c AS (
  SELECT count(*) AS row_count,
         count_if({LI_PK_BAD}) AS v1,
         count_if({LI_PRICE_BAD}) AS v2,
         count_if({LI_SHIP_BAD}) AS v3
  FROM li
)
SELECT 'lineitem' AS table_name, 'pk_txt' AS column_name, 1 AS field_position,
       CAST(v1 AS BIGINT) AS violations, CAST(row_count AS BIGINT) AS row_count, v1 = 0 AS passed FROM c
UNION ALL
SELECT 'lineitem', 'price_txt', 2, CAST(v2 AS BIGINT), CAST(row_count AS BIGINT), v2 = 0 FROM c
UNION ALL
SELECT 'lineitem', 'ship_txt', 3, CAST(v3 AS BIGINT), CAST(row_count AS BIGINT), v3 = 0 FROM c
"""


def _verdict(table: str, column: str, rule: str, pred: str, source: str, with_li: bool = False) -> str:
    head = f"WITH {LI} " if with_li else ""
    return (f"{head}SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"CAST(count_if({pred}) AS BIGINT) AS violations, count_if({pred}) = 0 AS passed FROM {source}")


SQL["check_not_null"] = _verdict("lineitem", "pk_txt", "not_null", "pk_txt IS NULL", "li", True)

SQL["check_max_length"] = (
    _verdict("documents", "text", "max_length(2000)", "length(text) > 2000", "documents")
    + "\nUNION ALL\n"
    + _verdict("part", "p_type", "max_length(6)", "length(p_type) > 6", "part"))

SQL["check_int"] = f"WITH {LI}\n" + "\nUNION ALL\n".join(
    _verdict("lineitem", "pk_txt", f"INT({n})",
             rf"(length(pk_txt) > {n} OR NOT regexp_matches(pk_txt, '^-?\d{{1,{n}}}\z'))", "li")
    for n in (4, 3))

SQL["check_decimal"] = _verdict("lineitem", "price_txt", "DECIMAL(6,2)", LI_PRICE_BAD, "li", True)

SQL["check_decimal_comma"] = (
    f"WITH {LI}, lc AS (SELECT replace(price_txt, '.', ',') AS price_comma FROM li)\n"
    + _verdict("lineitem", "price_comma", "DECIMAL(6,2) comma",
               r"(length(price_comma) > 10 OR NOT regexp_matches(price_comma, '^-?\d{1,4}\Q,\E\d{2}\z'))", "lc"))

SQL["check_date_offset"] = _verdict("lineitem", "ship_txt", "DATE", LI_SHIP_BAD, "li", True)

SQL["check_unknown_type"] = (
    _verdict("part", "p_name", "BLOB", "true", "part")
    + "\nUNION ALL\n"
    + _verdict("part", "p_name", "DECIMAL(8)", "true", "part"))

SQL["row_violations"] = f"""
WITH {LI}
SELECT l_orderkey, l_linenumber, l_partkey,
       concat_ws(',', CASE WHEN {LI_PK_BAD} THEN 'pk_txt' END,
                      CASE WHEN {LI_PRICE_BAD} THEN 'price_txt' END,
                      CASE WHEN {LI_SHIP_BAD} THEN 'ship_txt' END) AS failed_columns
FROM li
WHERE {LI_PK_BAD} OR {LI_PRICE_BAD} OR {LI_SHIP_BAD}
"""

SQL["pk_summary"] = """
WITH lk AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
     ok AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY ALL)
SELECT 'lineitem' AS table_name, 'l_orderkey, l_linenumber' AS key_columns,
       CAST(sum(n) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(count_if(n > 1) AS BIGINT) AS duplicated_keys, count_if(n > 1) = 0 AS passed FROM lk
UNION ALL
SELECT 'orders', 'o_orderkey', CAST(sum(n) AS BIGINT), CAST(count(*) AS BIGINT),
       CAST(count_if(n > 1) AS BIGINT), count_if(n > 1) = 0 FROM ok
"""

SQL["pk_duplicates"] = """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

ALLOWED_NATIONS = "(SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)"
ALLOWED_PRIORITIES = ("(SELECT DISTINCT o_orderpriority FROM orders "
                      "WHERE substr(o_orderpriority, 1, 1) IN ('1', '2', '3'))")

SQL["ri_clean"] = """
SELECT 'lineitem' AS table_name, 'l_partkey' AS column_name, 'part.p_partkey' AS reference,
       CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
"""

SQL["ri_violations"] = f"""
SELECT 'customer' AS table_name, 'c_nationkey' AS column_name, c_custkey AS row_key,
       CAST(c_nationkey AS VARCHAR) AS value
FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN {ALLOWED_NATIONS}
UNION ALL
SELECT 'orders', 'o_orderpriority', o_orderkey, o_orderpriority
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN {ALLOWED_PRIORITIES}
UNION ALL
SELECT 'documents', 'doc_id', doc_id, CAST(doc_id AS VARCHAR)
FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels)
"""

SQL["ri_columns"] = f"""
WITH per_column AS (
  SELECT 'customer' AS table_name, 3 AS field_position, 'c_nationkey' AS column_name,
         count_if(c_nationkey NOT IN {ALLOWED_NATIONS}) AS violations FROM customer
  UNION ALL SELECT 'orders', 2, 'o_custkey',
         count_if(o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders
  UNION ALL SELECT 'orders', 6, 'o_orderpriority',
         count_if(o_orderpriority NOT IN {ALLOWED_PRIORITIES}) FROM orders
  UNION ALL SELECT 'documents', 1, 'doc_id',
         count_if(doc_id NOT IN (SELECT doc_id FROM labels)) FROM documents
  UNION ALL SELECT 'lineitem', 2, 'l_partkey',
         count_if(l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
  UNION ALL SELECT 'lineitem', 3, 'l_suppkey',
         count_if(l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) FROM lineitem
)
SELECT table_name, CAST(count(*) AS BIGINT) AS checked_columns,
       CAST(count_if(violations > 0) AS BIGINT) AS incidences,
       coalesce(string_agg(CASE WHEN violations > 0 THEN column_name END, ', ' ORDER BY field_position), '')
         AS field_name,
       CAST(sum(violations) AS BIGINT) AS violations,
       count_if(violations > 0) = 0 AS passed
FROM per_column GROUP BY table_name
"""

LINE_REQ = "(1, 2, 3)"
ROLE_REQ = "('system', 'user', 'assistant')"

SQL["required_any"] = f"""
SELECT 'lineitem' AS table_name, CAST(count_if(l_linenumber IN {LINE_REQ}) AS BIGINT) AS rows_with_required,
       count_if(l_linenumber IN {LINE_REQ}) > 0 AS passed FROM lineitem
UNION ALL
SELECT 'conversations', CAST(count_if(role IN {ROLE_REQ}) AS BIGINT),
       count_if(role IN {ROLE_REQ}) > 0 FROM conversations
"""

SQL["required_excess"] = f"""
SELECT 'lineitem' AS table_name, l_orderkey AS group_key, CAST(l_linenumber AS VARCHAR) AS value,
       CAST(count(*) AS BIGINT) AS n
FROM lineitem WHERE l_linenumber IN {LINE_REQ} GROUP BY l_orderkey, l_linenumber HAVING count(*) <> 1
UNION ALL
SELECT 'conversations', conv_id, role, CAST(count(*) AS BIGINT)
FROM conversations WHERE role IN {ROLE_REQ} GROUP BY conv_id, role HAVING count(*) <> 1
"""

SQL["required_missing"] = f"""
SELECT 'lineitem' AS table_name, l_orderkey AS group_key,
       CAST(count(DISTINCT l_linenumber) AS BIGINT) AS n_present
FROM lineitem WHERE l_linenumber IN {LINE_REQ} GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) <> 3
UNION ALL
SELECT 'conversations', conv_id, CAST(count(DISTINCT role) AS BIGINT)
FROM conversations WHERE role IN {ROLE_REQ} GROUP BY conv_id HAVING count(DISTINCT role) <> 3
"""

SQL["group_prefix_missing"] = """
SELECT 'conversations' AS table_name, conv_id AS group_key
FROM conversations GROUP BY conv_id
HAVING NOT coalesce(bool_or(coalesce(starts_with(role, 'ass'), false)), false)
"""

SQL["group_prefix_incidences"] = """
WITH g AS (SELECT conv_id, bool_or(coalesce(starts_with(role, 'ass'), false)) AS has_prefix
           FROM conversations GROUP BY conv_id)
SELECT 'conversations' AS table_name, CAST(count(*) AS BIGINT) AS groups,
       CAST(count_if(has_prefix) AS BIGINT) AS groups_with_prefix,
       CAST(count(*) - count_if(has_prefix) AS BIGINT) AS incidences,
       count(*) = count_if(has_prefix) AS passed
FROM g
"""

SQL["prefix_violations"] = """
SELECT 'pages' AS table_name, page_id AS row_key, url AS value FROM pages WHERE NOT starts_with(url, 'https')
UNION ALL
SELECT 'part', p_partkey, p_brand FROM part WHERE NOT starts_with(p_brand, 'Brand#1')
"""

SQL["prefix_like_wildcard"] = """
SELECT 'part' AS table_name, p_partkey AS row_key, p_brand AS value FROM part
WHERE NOT (p_brand LIKE '_rand#1%')
"""

PART_CELLS = """
cells AS (
  SELECT p_partkey,
         CASE WHEN p_size <= 26 THEN chr(CAST(p_size + 96 AS INTEGER))
              ELSE 'a' || chr(CAST(p_size + 70 AS INTEGER)) END || CAST(p_partkey + 1 AS VARCHAR) AS excel_cell
  FROM part
),
parsed AS (
  SELECT p_partkey, excel_cell,
         nullif(upper(regexp_extract(excel_cell, '([A-Za-z]+)([0-9]+)', 1)), '') AS col_letters,
         TRY_CAST(nullif(regexp_extract(excel_cell, '([A-Za-z]+)([0-9]+)', 2), '') AS BIGINT) AS row_num
  FROM cells
),
numbered AS (
  SELECT *, CAST(list_reduce(list_transform(string_split(col_letters, ''), lambda x: ascii(x) - 64),
                             lambda a, b: a * 26 + b) AS BIGINT) AS col_num
  FROM parsed
)"""

SQL["cell_parse"] = f"WITH {PART_CELLS}\nSELECT p_partkey, excel_cell, col_letters, row_num, col_num FROM numbered"

SQL["cell_out_of_bounds"] = f"""
WITH {PART_CELLS}
SELECT p_partkey, excel_cell, row_num, col_num FROM numbered
WHERE row_num >= (SELECT count(*) FROM part) OR col_num >= 30
"""


# --------------------------------------------------------------------------
# staged run over the benchmark catalog
# --------------------------------------------------------------------------
# Header conformance comes from DuckDB's information_schema; the checks of
# the later stages only count for tables whose header passed.

def _q(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


# sources as the staged run sees them (after renaming by position)
_DERIVED_COLUMNS = {
    "lineitem_text": ["l_orderkey", "l_partkey", "l_linenumber", "pk_txt", "price_txt", "ship_txt"],
    "part_cells": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "excel_cell"],
}
# column lists of the benchmark tables the run reads (fixed schemas)
_SOURCE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}
_CELL_SQL = ("CASE WHEN p_size <= 26 THEN chr(CAST(p_size + 96 AS INTEGER)) "
             "ELSE 'a' || chr(CAST(p_size + 70 AS INTEGER)) END || CAST(p_partkey + 1 AS VARCHAR)")


def _type_pred(col: str, dt: str, length: int, nullable: bool) -> str:
    c = f"CAST({col} AS VARCHAR)"
    too_long = f"length({c}) > {length}"
    if dt == "STRING":
        bad = too_long
    elif dt == "INT":
        bad = rf"({too_long} OR NOT regexp_matches({c}, '^-?\d{{1,{length}}}\z'))"
    elif dt.startswith("DECIMAL"):
        p, s = (int(x) for x in dt[len("DECIMAL("):-1].split(","))
        bad = rf"({too_long} OR NOT regexp_matches({c}, '^-?\d{{1,{p - s}}}\Q.\E\d{{{s}}}\z'))"
    elif dt == "DATE":
        bad = (rf"({too_long} OR try_cast(substr({c}, 1, 10) AS DATE) IS NULL"
               rf" OR NOT regexp_matches({c}, '^\d{{4}}-(0[0-9]|1[0-2])-\d{{2}}\s[+-](0[0-9]|1[0-4])\z'))")
        if nullable:
            bad = f"({c} IS NOT NULL AND {bad})"
    else:
        bad = "true"
    if not nullable:
        bad = f"({c} IS NULL OR {bad})"
    return bad


def _verdict_row(seq, tid, name, stage, check_no, rule, column, v, inc, passed, msg, rows, src) -> str:
    return (f"SELECT {seq} AS table_seq, {_q(tid)} AS table_id, {_q(name)} AS table_name, "
            f"{stage} AS stage, {check_no} AS check_no, {_q(rule)} AS rule, "
            f"CAST({_q(column)} AS VARCHAR) AS column_name, CAST({v} AS BIGINT) AS violations, "
            f"CAST({inc} AS BIGINT) AS incidences, ({passed}) AS passed, "
            f"CASE WHEN ({passed}) THEN NULL ELSE {_q(msg)} END AS message, "
            f"CAST({rows} AS BIGINT) AS row_count FROM {src}")


def _run_sql() -> str:
    from veritab.benchmark_catalog import FUNCTIONAL, RULES, TABLES

    base = {"region", "nation", "supplier", "customer", "orders", "conversations", "documents",
            "events_archive"}
    rules_by = {}
    for tid, pos, name, pk, dt, length, nullable, ref in RULES:
        rules_by.setdefault(tid, []).append((pos, name, pk, dt, int(length), nullable, ref))
    ctes = [LI.strip(), "lineitem_text AS (SELECT * FROM li)",
            f"part_cells AS (SELECT *, {_CELL_SQL} AS excel_cell FROM part)",
            f"allowed_priorities AS {ALLOWED_PRIORITIES}"]
    exp_rows = ", ".join(f"({_q(tid)}, {pos}, {_q(name)})" for tid, pos, name, *_ in RULES)
    ctes.append(f"expected(table_id, position, name) AS (VALUES {exp_rows})")
    actual = []
    for seq, (tid, name, origin, header) in enumerate(TABLES, 1):
        if origin in base:
            actual.append(f"SELECT {_q(tid)} AS table_id, CAST(ordinal_position AS INTEGER) AS position, "
                          f"column_name AS name FROM information_schema.columns "
                          f"WHERE table_schema = 'main' AND table_name = {_q(origin)}")
        else:
            cols = _DERIVED_COLUMNS[origin]
            actual.append(" UNION ALL ".join(f"SELECT {_q(tid)}, {i}, {_q(c)}"
                                             for i, c in enumerate(cols, 1)))
    ctes.append("actual AS (" + " UNION ALL ".join(actual) + ")")
    cat_rows = ", ".join(f"({seq}, {_q(tid)}, {_q(name)}, {'true' if header else 'false'})"
                         for seq, (tid, name, origin, header) in enumerate(TABLES, 1))
    ctes.append(f"catalog(table_seq, table_id, table_name, has_header) AS (VALUES {cat_rows})")
    ctes.append("""hdr AS (
  SELECT c.table_seq, c.table_id, c.table_name, c.has_header,
         (SELECT count(*) FROM actual a WHERE a.table_id = c.table_id) AS n_actual,
         (SELECT count(*) FROM expected e WHERE e.table_id = c.table_id) AS n_expected,
         (SELECT list(a.name ORDER BY a.position) FROM actual a WHERE a.table_id = c.table_id) AS actual_names,
         (SELECT list(e.name ORDER BY e.position) FROM expected e WHERE e.table_id = c.table_id) AS expected_names
  FROM catalog c),
hdr_status AS (
  SELECT *, CASE WHEN n_actual = 0 THEN 'read'
                 WHEN has_header AND actual_names IS DISTINCT FROM expected_names THEN 'header'
                 WHEN NOT has_header AND n_actual <> n_expected THEN 'arity'
                 ELSE 'ok' END AS outcome
  FROM hdr)""")

    rows = []
    for seq, (tid, name, origin, header) in enumerate(TABLES, 1):
        rules = rules_by[tid]
        ok = f"(SELECT outcome FROM hdr_status WHERE table_id = {_q(tid)}) = 'ok'"
        if origin == "events_archive":
            rows.append(_verdict_row(seq, tid, name, 1, 1, "read", None, "NULL", "1", "false",
                                     "table could not be read", "NULL",
                                     f"hdr_status WHERE table_id = {_q(tid)} AND outcome = 'read'"))
            continue
        src = origin
        names = [r[1] for r in rules]
        actual_cols = _SOURCE_COLUMNS.get(origin) or _DERIVED_COLUMNS[origin]
        if not header and len(actual_cols) == len(names):   # renamed by position
            src = f"(SELECT {', '.join(f'{a} AS {b}' for a, b in zip(actual_cols, names))} FROM {origin})"
        # later stages only reference columns the source really has
        resolvable = (names == actual_cols) if header else (len(names) == len(actual_cols))
        cnt = f"(SELECT count(*) FROM {origin})"
        for rule, msg in (("header", "header present but column names differ from the rules"),
                          ("arity", "column count differs from the rules")):
            rows.append(_verdict_row(seq, tid, name, 1, 1, rule, None, "1", "1", "false", msg, cnt,
                                     f"hdr_status WHERE table_id = {_q(tid)} AND outcome = {_q(rule)}"))
        rows.append(_verdict_row(seq, tid, name, 1, 1, "header", None, "0", "0", "true", None, cnt,
                                 f"hdr_status WHERE table_id = {_q(tid)} AND outcome = 'ok'"))
        if not resolvable:
            continue
        gated = f"(SELECT 1) g WHERE {ok}"
        for i, (pos, col, pk, dt, length, nullable, ref) in enumerate(rules, 1):
            kind = dt if dt in ("STRING", "INT", "DATE") else "DECIMAL"
            v = f"(SELECT count_if({_type_pred(col, dt, length, nullable)}) FROM {src})"
            rows.append(_verdict_row(seq, tid, name, 2, i, f"type:{kind}", col, v,
                                     f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END", f"{v} = 0",
                                     f"{col}: values break the {dt} rule", "NULL", gated))
        keys = [r[1] for r in rules if r[2]]
        if keys:
            v = (f"(SELECT count_if(n > 1) FROM (SELECT count(*) AS n FROM {src} "
                 f"GROUP BY {', '.join(keys)}))")
            rows.append(_verdict_row(seq, tid, name, 2, len(rules) + 1, "primary_key", ", ".join(keys), v,
                                     f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END", f"{v} = 0",
                                     "primary key values are not unique", "NULL", gated))
        for pos, col, pk, dt, length, nullable, ref in rules:
            if not ref:
                continue
            rt, rc = ref.rsplit(".", 1)
            v = (f"(SELECT count(*) FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN "
                 f"(SELECT {rc} FROM {rt} WHERE {rc} IS NOT NULL))")
            rows.append(_verdict_row(seq, tid, name, 3, pos, "reference", col, v,
                                     f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END", f"{v} = 0",
                                     f"{col}: values outside {ref}", "NULL", gated))
        fs = FUNCTIONAL.get(tid)
        if fs is None:
            continue
        if fs.required_column:
            g = ", ".join(fs.group_cols)
            vals = ", ".join(_q(x) for x in fs.required_values)
            gv = ", ".join(fs.group_cols + (fs.required_column,))
            shown = ", ".join(str(x) for x in fs.required_values)
            req = f"(SELECT count_if({fs.required_column} IN ({vals})) FROM {src})"
            rows.append(_verdict_row(seq, tid, name, 4, 1, "required_any", gv,
                                     f"CASE WHEN {req} = 0 THEN 1 ELSE 0 END",
                                     f"CASE WHEN {req} = 0 THEN 1 ELSE 0 END", f"{req} > 0",
                                     f"no row has {fs.required_column} in ({shown})", "NULL", gated))
            k = len(set(fs.required_values))
            bad = (f"((SELECT count(*) FROM (SELECT count(*) AS n FROM {src} WHERE {fs.required_column} "
                   f"IN ({vals}) GROUP BY {gv}) WHERE n <> 1) + (SELECT count(*) FROM (SELECT "
                   f"count(DISTINCT {fs.required_column}) AS d FROM {src} WHERE {fs.required_column} "
                   f"IN ({vals}) GROUP BY {g}) WHERE d <> {k}))")
            rows.append(_verdict_row(seq, tid, name, 4, 2, "required_set", gv, bad,
                                     f"CASE WHEN {bad} > 0 THEN 1 ELSE 0 END", f"{bad} = 0",
                                     f"each ({g}) needs exactly one row per ({shown})", "NULL", gated))
        if fs.prefix_column:
            g = ", ".join(fs.group_cols)
            gv = ", ".join(fs.group_cols + (fs.prefix_column,))
            miss = (f"(SELECT count(*) FROM (SELECT bool_or(coalesce(starts_with({fs.prefix_column}, "
                    f"{_q(fs.prefix)}), false)) AS h FROM {src} GROUP BY {g}) WHERE NOT h)")
            rows.append(_verdict_row(seq, tid, name, 4, 3, "group_prefix", gv, miss, miss, f"{miss} = 0",
                                     f"some ({g}) have no {fs.prefix_column} starting with {fs.prefix}",
                                     "NULL", gated))
        if fs.pattern_column:
            v = f"(SELECT count_if(NOT starts_with({fs.pattern_column}, {_q(fs.pattern)})) FROM {src})"
            rows.append(_verdict_row(seq, tid, name, 4, 4, "pattern", fs.pattern_column, v,
                                     f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END", f"{v} = 0",
                                     f"not every {fs.pattern_column} starts with {fs.pattern}", "NULL", gated))
        if fs.cell_column:
            c = fs.cell_column
            letters = f"nullif(upper(regexp_extract({c}, '([A-Za-z]+)([0-9]+)', 1)), '')"
            rnum = f"TRY_CAST(nullif(regexp_extract({c}, '([A-Za-z]+)([0-9]+)', 2), '') AS BIGINT)"
            cnum = (f"list_reduce(list_transform(string_split({letters}, ''), lambda x: ascii(x) - 64), "
                    f"lambda a, b: a * 26 + b)")
            v = (f"(SELECT count_if({rnum} >= (SELECT count(*) FROM {src}) OR {cnum} >= "
                 f"{fs.cell_column_count}) FROM {src})")
            rows.append(_verdict_row(seq, tid, name, 4, 5, "cell_bounds", c, v,
                                     f"CASE WHEN {v} > 0 THEN 1 ELSE 0 END", f"{v} = 0",
                                     f"{c} points outside the table", "NULL", gated))
    ctes.append("verdicts AS (\n" + "\nUNION ALL\n".join(rows) + "\n)")
    return "WITH " + ",\n".join(ctes) + "\n"


RUN = _run_sql()

RUN_DERIVED = RUN.rstrip() + """,
table_status AS (
  SELECT table_seq, table_id, table_name,
         min(stage) FILTER (WHERE NOT passed) AS failed_stage,
         coalesce(bool_or(rule = 'read' AND NOT passed), false) AS unreadable,
         coalesce(bool_or(rule = 'arity' AND NOT passed), false) AS arity_failed,
         coalesce(bool_or(stage = 3), false) AS has_reference,
         CAST(coalesce(max(row_count), 0) AS BIGINT) AS row_count
  FROM verdicts GROUP BY table_seq, table_id, table_name),
table_flags AS (
  SELECT *, CAST(CASE WHEN unreadable THEN 30 WHEN failed_stage = 1 THEN 31 WHEN failed_stage = 2 THEN 32
                      WHEN failed_stage = 3 THEN 33 WHEN failed_stage = 4 THEN 34 ELSE 2 END AS DOUBLE) AS flag,
            CAST(coalesce(failed_stage - 1, 4) AS INTEGER) AS stages_passed
  FROM table_status),
status_lists AS (
  SELECT *, list_filter([
      CASE WHEN NOT unreadable THEN 1.0 END,
      CASE WHEN unreadable THEN 30.0 WHEN failed_stage = 1 THEN (CASE WHEN NOT arity_failed THEN 31.0 END)
           ELSE 1.2 END,
      CASE WHEN failed_stage = 2 THEN 32.0 WHEN failed_stage IS NULL OR failed_stage > 2 THEN 1.2 END,
      CASE WHEN has_reference THEN (CASE WHEN failed_stage = 3 THEN 33.0
                                         WHEN failed_stage IS NULL OR failed_stage > 3 THEN 1.3 END) END,
      CASE WHEN failed_stage = 4 THEN 34.0 WHEN failed_stage IS NULL THEN 1.4 END,
      CASE WHEN failed_stage IS NULL THEN 2.0 END], lambda x: x IS NOT NULL) AS flags
  FROM table_flags),
triggers AS (
  SELECT CAST(table_seq * 10 + n AS BIGINT) AS id_trigger, table_id AS id_type_file, table_name AS file_name,
         'PRE' AS environment, 'validation_engine' AS source, DATE '2025-01-01' AS date_load,
         TIMESTAMP '2025-01-01 00:00:00' AS tst_trigger_control, CAST(flag AS DOUBLE) AS flag,
         CAST(20250101000000 AS BIGINT) AS timestamp_load, row_count
  FROM (SELECT table_seq, table_id, table_name, row_count, unnest(flags) AS flag,
               generate_subscripts(flags, 1) AS n FROM status_lists)),
stage_summary AS (
  SELECT table_seq, table_id, table_name, stage, passed,
         CAST(incidences AS BIGINT) AS incidences, coalesce(validation_msg, '') AS validation_msg,
         coalesce(array_to_string(list_filter(fields, lambda x, i: list_position(fields, x) = i), ', '), '') AS field_name,
         CASE stage WHEN 1 THEN 'Header' WHEN 2 THEN 'Technical' WHEN 3 THEN 'Referential Integrity'
                    WHEN 4 THEN 'Functional' END AS type_validation
  FROM (SELECT table_seq, table_id, table_name, stage, bool_and(passed) AS passed,
               sum(incidences) AS incidences,
               string_agg(message, ' ' ORDER BY check_no) FILTER (WHERE NOT passed) AS validation_msg,
               flatten(list(string_split(column_name, ', ') ORDER BY check_no)
                   FILTER (WHERE NOT passed AND column_name IS NOT NULL)) AS fields
        FROM verdicts GROUP BY table_seq, table_id, table_name, stage))
"""

SQL["stage_verdicts"] = RUN + "SELECT * FROM verdicts"

SQL["table_verdict"] = RUN_DERIVED + """
SELECT table_id, table_name, failed_stage, flag, stages_passed, row_count FROM table_flags"""

SQL["progress_summary"] = RUN_DERIVED + "SELECT table_id, table_name, stages_passed FROM table_flags"

SQL["trigger_rows"] = RUN_DERIVED + "SELECT * FROM triggers"

SQL["latest_trigger"] = RUN_DERIVED + """
SELECT id_type_file, file_name, max(id_trigger) AS id_trigger, arg_max(flag, id_trigger) AS flag
FROM triggers GROUP BY id_type_file, file_name"""

# a table writes a flag for every stage up to its first failed one; stage 3 only
# with reference rules; the one flag of an unreadable table is 30
SQL["flag_assign"] = RUN_DERIVED + """
SELECT table_id, table_name, CAST(k AS INTEGER) AS stage, coalesce(k < failed_stage, true) AS passed,
       CAST(CASE WHEN unreadable THEN 30
                 WHEN k = failed_stage THEN 30 + k
                 WHEN k <= 2 THEN 1.2 WHEN k = 3 THEN 1.3 ELSE 1.4 END AS DOUBLE) AS flag
FROM table_flags CROSS JOIN (VALUES (1), (2), (3), (4)) stages(k)
WHERE (failed_stage IS NULL OR k <= failed_stage) AND (k <> 3 OR has_reference)"""

SQL["stage_error_summary"] = RUN_DERIVED + """
SELECT table_id, table_name, stage, type_validation, validation_msg, field_name, incidences
FROM stage_summary WHERE NOT passed"""

SQL["validation_log_rows"] = RUN_DERIVED + """
SELECT l.id_trigger, CAST(s.stage AS INTEGER) AS validation_id, 'validation_engine' AS source,
       s.type_validation, s.table_name AS file_name, s.validation_msg, nullif(s.field_name, '') AS field_name,
       s.incidences, f.flag, TIMESTAMP '2025-01-01 00:00:00' AS execution_timestamp,
       DATE '2025-01-01' AS date_load, CAST(20250101000000 AS BIGINT) AS timestamp_load
FROM table_flags f
JOIN stage_summary s ON s.table_id = f.table_id AND s.stage = f.failed_stage
JOIN (SELECT id_type_file, max(id_trigger) AS id_trigger FROM triggers GROUP BY id_type_file) l
  ON l.id_type_file = f.table_id"""


# --------------------------------------------------------------------------
# sources, metadata and header
# --------------------------------------------------------------------------

_ALL = ("region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations").split()

SQL["row_count"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in _ALL)

SQL["catalog_select"] = f"""
WITH {LI}
SELECT '00002' AS id_type_file, 'nation' AS type_file_name, false AS header,
       CAST((SELECT count(*) FROM nation) AS BIGINT) AS row_count
UNION ALL SELECT '00005', 'lineitem_text', true, CAST((SELECT count(*) FROM li) AS BIGINT)
UNION ALL SELECT '00006', 'orders', true, CAST((SELECT count(*) FROM orders) AS BIGINT)
UNION ALL SELECT '00008', 'conversations', true, CAST((SELECT count(*) FROM conversations) AS BIGINT)
"""


def _non_null_rows(tid: str, table: str, cols: list[tuple[int, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{tid}' AS id_type_file, {pos} AS field_position, '{name}' AS field_name, "
        f"CAST(count({src}) AS BIGINT) AS non_null FROM {table}" for pos, name, src in cols)


SQL["expected_schema"] = "\nUNION ALL\n".join([
    _non_null_rows("00001", "region", [(1, "r_regionkey", "r_regionkey"), (2, "r_name", "r_name")]),
    _non_null_rows("00002", "nation", [(1, "nation_id", "n_nationkey"), (2, "nation_name", "n_name"),
                                       (3, "region_id", "n_regionkey")]),
    _non_null_rows("00006", "orders", [(1, "o_orderkey", "o_orderkey"), (2, "o_custkey", "o_custkey"),
                                       (3, "o_orderstatus", "o_orderstatus"),
                                       (4, "o_totalprice", "o_totalprice"),
                                       (5, "o_orderdate", "o_orderdate"),
                                       (6, "o_orderpriority", "o_orderpriority")]),
])

SQL["ref_rule_columns"] = f"""
SELECT '00002' AS id_type_file, 3 AS field_position, 'region_id' AS field_name,
       'region.r_regionkey' AS referential_table_field_name,
       CAST((SELECT count(DISTINCT r_regionkey) FROM region) AS BIGINT) AS allowed_values
UNION ALL SELECT '00006', 2, 'o_custkey', 'customer.c_custkey',
       CAST((SELECT count(DISTINCT c_custkey) FROM customer) AS BIGINT)
UNION ALL SELECT '00006', 6, 'o_orderpriority', 'allowed_priorities.o_orderpriority',
       CAST((SELECT count(*) FROM {ALLOWED_PRIORITIES}) AS BIGINT)
UNION ALL SELECT '00010', 1, 'doc_id', 'labels.doc_id',
       CAST((SELECT count(DISTINCT doc_id) FROM labels) AS BIGINT)
"""

# (position, column, data_type, length, nullable, symbol); same rules as EDGE_RULES
_EDGE = [
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
# violation predicates of the usable rules (the others fail every row)
_EDGE_PRED = {
    1: r"(CAST(p_partkey AS VARCHAR) IS NULL OR length(CAST(p_partkey AS VARCHAR)) > 5"
       r" OR NOT regexp_matches(CAST(p_partkey AS VARCHAR), '^-?\d{1,5}\z'))",
    7: r"(CAST(p_size AS VARCHAR) IS NOT NULL AND (length(CAST(p_size AS VARCHAR)) > 14"
       r" OR try_cast(substr(CAST(p_size AS VARCHAR), 1, 10) AS DATE) IS NULL"
       r" OR NOT regexp_matches(CAST(p_size AS VARCHAR), '^\d{4}-(0[0-9]|1[0-2])-\d{2}\s[+-](0[0-9]|1[0-4])\z')))",
    9: r"(CAST(p_size AS VARCHAR) IS NULL OR length(CAST(p_size AS VARCHAR)) > 6"
       r" OR NOT regexp_matches(CAST(p_size AS VARCHAR), '^-?\d{1,4}\Q,\E\d{0}\z'))",
    10: "(length(p_type) > 20)",
    11: r"(length(CAST(p_partkey AS VARCHAR)) > 3 OR NOT regexp_matches(CAST(p_partkey AS VARCHAR), '^-?\d{1,3}\z'))",
}
_edge_values = ", ".join(
    f"({pos}, '{col}', {_q(dt)}, '{length}', {'NULL' if nul is None else str(nul).lower()}, {_q(sym)})"
    for pos, col, dt, length, nul, sym in _EDGE)
_edge_counts = "\nUNION ALL\n".join(
    f"SELECT {pos} AS field_position, CAST(count_if({_EDGE_PRED.get(pos, 'true')}) AS BIGINT) AS violations FROM part"
    for pos, *_ in _EDGE)

SQL["rule_decode"] = rf"""
WITH rules(field_position, field_name, data_type, length, nullable, decimal_symbol) AS (VALUES {_edge_values}),
k AS (
  SELECT *,
    CASE WHEN data_type IS NULL THEN 'UNKNOWN' WHEN data_type = 'STRING' THEN 'STRING'
         WHEN data_type = 'INT' THEN 'INT'
         WHEN starts_with(data_type, 'DECIMAL') THEN
              CASE WHEN regexp_matches(data_type, '^DECIMAL\((\d+),(\d+)\)$') THEN 'DECIMAL' ELSE 'MALFORMED' END
         WHEN starts_with(data_type, 'DATE') THEN 'DATE' ELSE 'UNKNOWN' END AS kind,
    TRY_CAST(trim(length) AS INTEGER) AS max_length
  FROM rules),
d AS (
  SELECT field_position, field_name, data_type, kind, max_length,
    CASE WHEN kind = 'DECIMAL' THEN TRY_CAST(regexp_extract(data_type, '^DECIMAL\((\d+),(\d+)\)$', 1) AS INTEGER) END
      AS precision,
    CASE WHEN kind = 'DECIMAL' THEN TRY_CAST(regexp_extract(data_type, '^DECIMAL\((\d+),(\d+)\)$', 2) AS INTEGER) END
      AS scale,
    coalesce(decimal_symbol, '.') AS symbol, coalesce(nullable, false) AS is_nullable, false AS is_pk
  FROM k),
e AS (
  SELECT *, CASE WHEN kind = 'UNKNOWN' THEN 'unknown data type'
                 WHEN kind = 'MALFORMED' THEN 'malformed decimal type'
                 WHEN max_length IS NULL THEN 'length missing or not a number'
                 WHEN kind = 'INT' AND max_length < 1 THEN 'int length below 1'
                 WHEN kind = 'DECIMAL' AND scale > precision THEN 'decimal scale above precision' END AS rule_error
  FROM d),
c AS ({_edge_counts})
SELECT e.*, c.violations FROM e JOIN c USING (field_position)
"""


def _fk(child, col, parent, pcol):
    return (f"SELECT 'foreign_key' AS kind, '{child}' AS table_name, '{col}' AS column_name, "
            f"'{parent}.{pcol}' AS reference, CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed "
            f"FROM {child} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {pcol} FROM {parent} "
            f"WHERE {pcol} IS NOT NULL)")


def _uniq(table, col):
    return (f"SELECT 'unique' AS kind, '{table}' AS table_name, '{col}' AS column_name, NULL AS reference, "
            f"CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed "
            f"FROM (SELECT {col} FROM {table} GROUP BY {col} HAVING count(*) > 1)")


def _nn(table, cols):
    pred = " OR ".join(f"{c} IS NULL" for c in cols)
    return (f"SELECT 'not_null' AS kind, '{table}' AS table_name, '{', '.join(cols)}' AS column_name, "
            f"NULL AS reference, CAST(count_if({pred}) AS BIGINT) AS violations, count_if({pred}) = 0 AS passed "
            f"FROM {table}")


SQL["metadata_fk"] = "\nUNION ALL\n".join([
    _nn("orders", ["o_orderkey", "o_custkey"]),
    _nn("lineitem", ["l_orderkey", "l_partkey", "l_suppkey"]),
    _uniq("region", "r_regionkey"), _uniq("nation", "n_nationkey"), _uniq("supplier", "s_suppkey"),
    _uniq("customer", "c_custkey"), _uniq("part", "p_partkey"), _uniq("orders", "o_orderkey"),
    _uniq("documents", "doc_id"),
    _fk("nation", "n_regionkey", "region", "r_regionkey"),
    _fk("supplier", "s_nationkey", "nation", "n_nationkey"),
    _fk("customer", "c_nationkey", "nation", "n_nationkey"),
    _fk("orders", "o_custkey", "customer", "c_custkey"),
    _fk("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _fk("lineitem", "l_partkey", "part", "p_partkey"),
    _fk("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _fk("labels", "doc_id", "documents", "doc_id"),
])

SQL["header_mismatch"] = """
WITH expected(table_name, position, expected_name) AS (VALUES
  ('region', 1, 'r_regionkey'), ('region', 2, 'r_name'),
  ('nation', 1, 'n_nationkey'), ('nation', 2, 'N_NAME'), ('nation', 3, 'n_regionkey'),
  ('supplier', 1, 's_suppkey'), ('supplier', 2, 's_name'), ('supplier', 3, 's_nationkey'),
  ('supplier', 4, 's_acctbal'), ('supplier', 5, 's_comment')),
actual AS (
  SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name AS actual_name
  FROM information_schema.columns
  WHERE table_schema = 'main' AND table_name IN ('region', 'nation', 'supplier')),
counts AS (
  SELECT 'region' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM region
  UNION ALL SELECT 'nation', CAST(count(*) AS BIGINT) FROM nation
  UNION ALL SELECT 'supplier', CAST(count(*) AS BIGINT) FROM supplier),
m AS (
  SELECT coalesce(e.table_name, a.table_name) AS table_name, coalesce(e.position, a.position) AS position,
         e.expected_name, a.actual_name
  FROM expected e FULL OUTER JOIN actual a ON e.table_name = a.table_name AND e.position = a.position
  WHERE a.actual_name IS DISTINCT FROM e.expected_name)
SELECT m.table_name, CAST(m.position AS INTEGER) AS position, m.expected_name, m.actual_name, c.row_count
FROM m JOIN counts c USING (table_name)
"""

SQL["header_rename"] = """
SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
"""

SQL["header_arity"] = """
WITH expected(table_name, expected_count) AS (VALUES ('region', 2), ('nation', 2), ('supplier', 4)),
actual AS (SELECT table_name, CAST(count(*) AS INTEGER) AS actual_count FROM information_schema.columns
           WHERE table_schema = 'main' AND table_name IN ('region', 'nation', 'supplier') GROUP BY table_name),
counts AS (
  SELECT 'region' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM region
  UNION ALL SELECT 'nation', CAST(count(*) AS BIGINT) FROM nation
  UNION ALL SELECT 'supplier', CAST(count(*) AS BIGINT) FROM supplier)
SELECT e.table_name, CAST(e.expected_count AS INTEGER) AS expected_count, a.actual_count, c.row_count,
       e.expected_count = a.actual_count AS passed
FROM expected e JOIN actual a USING (table_name) JOIN counts c USING (table_name)
"""
