"""Catalog and rules describing the benchmark tables, for the staged run.

The metadata is literal (as a semantic layer would be); the tables it
describes are read whole.  Faults are chosen so that every outcome occurs:

  00001 region          passes every stage                      -> 2
  00002 nation          no header: renamed by position; ref ok  -> 2
  00003 supplier        header with a wrongly cased name        -> 31
  00004 customer        no header, one column too many          -> 31 (error row only)
  00005 lineitem_text   text view with type faults, dup keys    -> 32
  00006 orders          priority outside the allowed codes      -> 33
  00007 part_cells      brand pattern and cell bounds           -> 34
  00008 conversations   required roles and role prefix          -> 34
  00009 events_archive  path does not exist                     -> 30
  00010 documents       documents without a label               -> 33
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.plans.staged_run import FunctionalSpec
from veritab.schemas import FILE_CONFIGURATION, SEMANTIC_LAYER
from veritab.sources.readers import read_driver_table

# (id, name, origin view, header)
TABLES = [
    ("00001", "region", "region", True),
    ("00002", "nation", "nation", False),
    ("00003", "supplier", "supplier", True),
    ("00004", "customer", "customer", False),
    ("00005", "lineitem_text", "lineitem_text", True),
    ("00006", "orders", "orders", True),
    ("00007", "part_cells", "part_cells", True),
    ("00008", "conversations", "conversations", True),
    ("00009", "events_archive", "events_archive", True),
    ("00010", "documents", "documents", True),
]

BIG = "1000000"

# (id, position, name, pk, data_type, length, nullable, reference)
RULES = [
    ("00001", 1, "r_regionkey", True, "INT", "1", False, None),
    ("00001", 2, "r_name", False, "STRING", "25", False, None),
    ("00002", 1, "nation_id", True, "INT", "2", False, None),
    ("00002", 2, "nation_name", False, "STRING", "25", True, None),
    ("00002", 3, "region_id", False, "INT", "1", True, "region.r_regionkey"),
    ("00003", 1, "s_suppkey", True, "INT", "10", False, None),
    ("00003", 2, "S_NAME", False, "STRING", "25", True, None),
    ("00003", 3, "s_nationkey", False, "INT", "2", True, None),
    ("00003", 4, "s_acctbal", False, "STRING", "30", True, None),
    ("00004", 1, "cust_id", True, "INT", "10", False, None),
    ("00004", 2, "cust_name", False, "STRING", "25", True, None),
    ("00004", 3, "nation_id", False, "INT", "2", True, None),
    ("00004", 4, "balance", False, "STRING", "30", True, None),
    ("00005", 1, "l_orderkey", True, "INT", "10", False, None),
    ("00005", 2, "l_partkey", False, "INT", "10", True, None),
    ("00005", 3, "l_linenumber", True, "INT", "1", False, None),
    ("00005", 4, "pk_txt", False, "INT", "4", False, None),
    ("00005", 5, "price_txt", False, "DECIMAL(6,2)", "10", True, None),
    ("00005", 6, "ship_txt", False, "DATE", "14", True, None),
    ("00006", 1, "o_orderkey", True, "INT", "10", False, None),
    ("00006", 2, "o_custkey", False, "INT", "10", True, "customer.c_custkey"),
    ("00006", 3, "o_orderstatus", False, "STRING", "1", True, None),
    ("00006", 4, "o_totalprice", False, "STRING", "30", True, None),
    ("00006", 5, "o_orderdate", False, "STRING", "30", True, None),
    ("00006", 6, "o_orderpriority", False, "STRING", "15", True, "allowed_priorities.o_orderpriority"),
    ("00007", 1, "p_partkey", True, "INT", "10", False, None),
    ("00007", 2, "p_name", False, "STRING", "55", True, None),
    ("00007", 3, "p_brand", False, "STRING", "10", True, None),
    ("00007", 4, "p_type", False, "STRING", "30", True, None),
    ("00007", 5, "p_size", False, "INT", "2", True, None),
    ("00007", 6, "p_retailprice", False, "STRING", "30", True, None),
    ("00007", 7, "excel_cell", False, "STRING", "10", True, None),
    ("00008", 1, "conv_id", True, "INT", "10", False, None),
    ("00008", 2, "turn", True, "INT", "5", False, None),
    ("00008", 3, "role", False, "STRING", "10", False, None),
    ("00008", 4, "text", False, "STRING", BIG, True, None),
    ("00009", 1, "event_id", True, "INT", "10", False, None),
    ("00010", 1, "doc_id", True, "INT", "10", False, "labels.doc_id"),
    ("00010", 2, "text", False, "STRING", BIG, True, None),
    ("00010", 3, "lang", False, "STRING", "20", True, None),
    ("00010", 4, "source", False, "STRING", "50", True, None),
    ("00010", 5, "n_chars", False, "INT", "10", True, None),
]

FUNCTIONAL = {
    "00007": FunctionalSpec(pattern_column="p_brand", pattern="Brand#1",
                            cell_column="excel_cell", cell_column_count=30),
    "00008": FunctionalSpec(group_cols=("conv_id",), required_column="role",
                            required_values=("system", "user", "assistant"),
                            prefix_column="role", prefix="ass"),
}


def catalog_frame(spark: SparkSession) -> DataFrame:
    rows = [(tid, name, "parquet", "benchmark", origin, None, None, header, False, "validator")
            for tid, name, origin, header in TABLES]
    return spark.createDataFrame(rows, FILE_CONFIGURATION)


def rules_frame(spark: SparkSession) -> DataFrame:
    rows = [(tid, pos, name, None, pk, dt, length, nullable, None, None, ref, None)
            for tid, pos, name, pk, dt, length, nullable, ref in RULES]
    return spark.createDataFrame(rows, SEMANTIC_LAYER)


def views(spark: SparkSession, sf: str) -> dict:
    """Named frames the catalog's origin paths and reference targets point at.

    Each frame is built once per run and reused by every check that reads it."""
    from veritab import queries as Q

    def table(name):
        return lambda: read_driver_table(spark, sf, name)

    out = {name: table(name) for name in (
        "region", "nation", "supplier", "customer", "orders", "conversations", "documents",
        "labels", "part", "lineitem", "events_archive")}
    out["lineitem_text"] = lambda: Q.li_view(spark, sf)
    out["part_cells"] = lambda: _part_cells_full(spark, sf)
    out["allowed_priorities"] = lambda: Q.allowed_priorities(spark, sf)
    return {name: _once(fn) for name, fn in out.items()}


def _once(fn):
    """Build a frame on first use and hand out the same frame afterwards;
    a failed build (missing table) is retried, so every caller sees it fail."""
    cell = []

    def get():
        if not cell:
            cell.append(fn())
        return cell[0]
    return get


def _part_cells_full(spark: SparkSession, sf: str) -> DataFrame:
    from veritab import queries as Q

    part = read_driver_table(spark, sf, "part")
    cells = Q.cell_reference(F.col("p_size"), F.col("p_partkey"))
    return part.withColumn("excel_cell", cells)


def loader(spark: SparkSession, sf: str):
    v = views(spark, sf)
    return lambda row: v[row["origin_path"]]()


def reference_resolver(spark: SparkSession, sf: str):
    v = views(spark, sf)
    return lambda name: v[name]()
