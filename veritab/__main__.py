"""Run a validation from the command line (``spark-submit -m veritab`` or
``python -m veritab``): read the catalog and the rules, validate the selected
tables, append status and error rows to the two log tables, print the
stages passed per table.

  python -m veritab --catalog cat.parquet --rules rules.parquet \
      --reference td_templates=/data/td_templates.parquet \
      --trigger-log /logs/trigger_control --error-log /logs/process_validation_logs \
      [--ids 00013,00018] [--template-rules] [--fail-fast] [--tables-at-once 8] [--run-id ID] [--compat]
"""

from __future__ import annotations

import argparse
import sys

from veritab.functions import constants as K
from veritab.operators.metadata import metadata_constraint_violations
from veritab.plans.growing import GrowingTable
from veritab.plans.staged_run import TABLES_AT_ONCE, FunctionalSpec, specs_from_metadata, validate_and_log
from veritab.schemas import FILE_CONFIGURATION, SEMANTIC_LAYER
from veritab.session import get_session
from veritab.sources.readers import read_table, read_with_options

# the functional rules of the 34-column template table
TEMPLATE_FUNCTIONAL = FunctionalSpec(
    group_cols=K.TEMPLATE_GROUP_COLUMNS, required_column=K.TEMPLATE_REQUIRED_COLUMN,
    required_values=K.TEMPLATE_REQUIRED_VALUES, prefix_column=K.TEMPLATE_REQUIRED_COLUMN,
    prefix=K.TEMPLATE_GROUP_PREFIX, pattern_column=K.TEMPLATE_PATTERN_COLUMN, pattern=K.TEMPLATE_PATTERN,
    cell_column=K.TEMPLATE_CELL_COLUMN)


def _read_meta(spark, path: str, schema):
    fmt = "csv" if path.endswith(".csv") else "parquet"
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="veritab", description=__doc__.split("\n\n")[0])
    ap.add_argument("--catalog", required=True, help="file_configuration (parquet or .csv)")
    ap.add_argument("--rules", required=True, help="semantic_layer (parquet or .csv)")
    ap.add_argument("--reference", action="append", default=[],
                    help="NAME=PATH of a reference table (parquet or .csv); other names are read "
                         "as catalog tables")
    ap.add_argument("--trigger-log", required=True, help="status log table path (appended)")
    ap.add_argument("--error-log", required=True, help="error log table path (appended)")
    ap.add_argument("--ids", default=None, help="comma-separated table ids (default: all)")
    ap.add_argument("--template-rules", action="store_true",
                    help="apply the template table's functional rules to every selected table")
    ap.add_argument("--fail-fast", action="store_true", help="stop each table at its first failed stage")
    ap.add_argument("--tables-at-once", type=int, default=TABLES_AT_ONCE,
                    help="tables that are validated at the same time")
    ap.add_argument("--run-id", default=None, help="a run that was cut off goes on under its id; a published one is repeated and "
                                                       "replaces its log rows")
    ap.add_argument("--option", action="append", default=[],
                    help="KEY=VALUE passed to the reader of every table (e.g. the connection of jdbc tables)")
    ap.add_argument("--table-option", action="append", default=[],
                    help="ID:KEY=VALUE passed to the reader of one table (e.g. 00013:partitionColumn=id, and optionally "
                         "lowerBound, upperBound, numPartitions of a jdbc table)")
    ap.add_argument("--growing-state", default=None,
                    help="folder of the state of tables in files: a run reads new and changed files only")
    ap.add_argument("--compat", action="store_true", help="keep the original null-date behaviour")
    ap.add_argument("--environment", default=K.DEFAULT_ENVIRONMENT)
    ap.add_argument("--source", default=K.DEFAULT_SOURCE)
    args = ap.parse_args(argv)

    spark = get_session()
    catalog = _read_meta(spark, args.catalog, FILE_CONFIGURATION)
    rules = _read_meta(spark, args.rules, SEMANTIC_LAYER)
    broken = metadata_constraint_violations(catalog, rules).where("not passed").collect()
    for r in broken:
        print(f"{r['table_name']}.{r['column_name']}: {r['violations']} violations of {r['kind']}", file=sys.stderr)
    if broken:
        return 2
    ref_paths = dict(r.split("=", 1) for r in args.reference)

    options = dict(o.split("=", 1) for o in args.option)

    of_table: dict[str, dict[str, str]] = {}
    for option in args.table_option:
        table, pair = option.split(":", 1)
        of_table.setdefault(table, {}).update([pair.split("=", 1)])

    def load(row, files=None):
        return read_with_options(spark, files or row["origin_path"], row["file_format"],
                                 {**options, **of_table.get(row["id_type_file"], {})},
                                 header=row["header"], separator=row["separator"])

    def references(name):
        # a target may be given with or without the schema that the metadata puts before it
        path = ref_paths.get(name) or ref_paths.get(name.rsplit(".", 1)[-1])
        if path is None:
            return spark.table(name)
        return read_table(spark, path, "csv" if path.endswith(".csv") else "parquet", header=True)

    ids = args.ids.split(",") if args.ids else None
    functional = None
    if args.template_rules:
        chosen = ids or [r["id_type_file"] for r in catalog.select("id_type_file").collect()]
        functional = {tid: TEMPLATE_FUNCTIONAL for tid in chosen}
    specs = specs_from_metadata(catalog, rules, load, functional, ids)
    if args.growing_state:
        rows = {r["id_type_file"]: r for r in catalog.collect()}  # a row per table
        for spec in specs:
            row = rows[spec.table_id]
            if (row["file_format"] or "").lower() != "jdbc":
                spec.growing = GrowingTable(spark, row["origin_path"], f"{args.growing_state}/{spec.table_id}",
                                            lambda files, row=row: load(row, files))
    status = validate_and_log(spark, specs, references, args.trigger_log, args.error_log,
                              environment=args.environment, source=args.source, compat=args.compat,
                              fail_fast=args.fail_fast, run_id=args.run_id, tables_at_once=args.tables_at_once,
                              catalog=catalog)
    for r in status.orderBy("table_seq").collect():
        print(f"{r['table_id']} {r['table_name']}: {r['stages_passed']} of 4 stages passed, flag {r['flag']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
