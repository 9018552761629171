"""Metadata operators (M1-M5, M7) over the catalog and rules frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritab.functions.names import col
from veritab.operators.references import reference_violation_count
from veritab.operators.technical import key_duplicates
from veritab.schemas import (
    DECLARED_LENGTHS, FILE_CONFIGURATION, PROCESS_VALIDATION_LOGS, SEMANTIC_LAYER, TRIGGER_CONTROL,
)


def select_tables(catalog: DataFrame, ids: Sequence[str] | None = None, ordered: bool = True) -> DataFrame:
    """M1: (id_type_file, type_file_name) of the tables to validate, by id.

    Ids compare as text, so no cast blocks pushdown; None selects all."""
    out = catalog.select("id_type_file", "type_file_name", "header", "origin_path", "file_format",
                         "separator")
    if ids is not None:
        out = out.where(F.col("id_type_file").isin(list(ids)))
    return out.orderBy("id_type_file") if ordered else out


def catalog_row(catalog: DataFrame, table_id: str):
    """M2: one table's catalog row (header flag, origin path)."""
    return catalog.where(F.col("id_type_file") == F.lit(table_id)).first()


def expected_columns(rules: DataFrame, table_id: str | None = None) -> DataFrame:
    """M3: (id_type_file, field_position, field_name) in position order."""
    out = rules.select("id_type_file", "field_position", "field_name")
    if table_id is not None:
        out = out.where(F.col("id_type_file") == F.lit(table_id))
    return out.orderBy("id_type_file", "field_position")


def reference_rule_columns(rules: DataFrame, table_id: str | None = None) -> DataFrame:
    """M4: columns that carry a reference rule."""
    out = rules.where(F.col("referential_table_field_name").isNotNull())
    if table_id is not None:
        out = out.where(F.col("id_type_file") == F.lit(table_id))
    return out.select("id_type_file", "field_position", "field_name", "referential_table_field_name")


def key_columns(rules: DataFrame, table_id: str) -> DataFrame:
    """M5: primary-key columns (a null pk flag means not a key)."""
    return rules.where((F.col("id_type_file") == F.lit(table_id)) & F.coalesce(F.col("pk"), F.lit(False))) \
        .orderBy("field_position").select("field_name")


def split_reference(target: str) -> tuple[str, str]:
    """``[schema.]table.column`` -> (``[schema.]table``, ``column``)."""
    table, _, column = target.rpartition(".")
    if not table or not column:
        raise ValueError(f"reference target must be table.column, got {target!r}")
    return table, column


@dataclass(frozen=True)
class Constraint:
    """A declared constraint: ``not_null`` / ``unique`` on ``columns`` of
    ``table``, ``max_length`` characters in ``columns[0]``, or ``foreign_key``
    from ``columns[0]`` to ``parent.parent_column``."""

    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_column: str | None = None
    length: int | None = None


def constraint_violations(frames: dict[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """M7: one row per constraint: kind, table_name, column_name, reference,
    violations (null rows, duplicated keys, or orphan rows), passed.

    All NOT NULL and length constraints of a table are counted in ONE aggregate over it,
    UNIQUE groups by the key (partial aggregation first), FOREIGN KEY counts
    orphans with an anti-join on distinct values."""
    def labelled(v: DataFrame, c: Constraint) -> DataFrame:
        ref = f"{c.parent}.{c.parent_column}" if c.parent else None
        return v.select(F.lit(c.kind).alias("kind"), F.lit(c.table).alias("table_name"),
                        F.lit(", ".join(c.columns)).alias("column_name"),
                        F.lit(ref).cast("string").alias("reference"), "violations",
                        (F.col("violations") == 0).alias("passed"))

    rows = []
    row_wise: dict[str, list[Constraint]] = {}
    for c in constraints:
        if c.kind in ("not_null", "max_length"):
            row_wise.setdefault(c.table, []).append(c)
        elif c.kind == "unique":
            v = key_duplicates(frames[c.table], list(c.columns)).agg(
                F.count(F.lit(1)).cast("bigint").alias("violations"))
            rows.append(labelled(v, c))
        elif c.kind == "foreign_key":
            v = reference_violation_count(frames[c.table], c.columns[0], frames[c.parent], c.parent_column)
            rows.append(labelled(v, c))
        else:
            raise ValueError(f"unknown constraint kind {c.kind!r}")
    def broken(c: Constraint) -> Column:
        if c.kind == "max_length":
            return F.char_length(col(c.columns[0]).cast("string")) > c.length
        return reduce(or_, [col(x).isNull() for x in c.columns])

    for table, group in row_wise.items():
        one = frames[table].agg(*[F.count_if(broken(c)).cast("bigint").alias(f"__n{i}") for i, c in enumerate(group)])
        rows.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(c.kind).alias("kind"), F.lit(table).alias("table_name"),
                     F.lit(", ".join(c.columns)).alias("column_name"),
                     F.lit(None).cast("string").alias("reference"), F.col(f"__n{i}").alias("violations"),
                     (F.col(f"__n{i}") == 0).alias("passed"))
            for i, c in enumerate(group)]))))
    return reduce(DataFrame.unionByName, rows)


def _declared(name: str, schema: StructType) -> list[Constraint]:
    """NOT NULL and length constraints of a fixed table."""
    return ([Constraint("not_null", name, (f.name,)) for f in schema.fields if not f.nullable]
            + [Constraint("max_length", name, (c,), length=n) for c, n in DECLARED_LENGTHS.get(name, {}).items()])


# constraints the catalog and rules tables declare
METADATA_CONSTRAINTS = (
    *_declared("file_configuration", FILE_CONFIGURATION),
    Constraint("unique", "file_configuration", ("id_type_file",)),
    *_declared("semantic_layer", SEMANTIC_LAYER),
    Constraint("foreign_key", "semantic_layer", ("id_type_file",), "file_configuration", "id_type_file"),
)

# constraints the two log tables declare
LOG_CONSTRAINTS = (
    *_declared("trigger_control", TRIGGER_CONTROL),
    Constraint("unique", "trigger_control", ("id_trigger",)),
    Constraint("foreign_key", "trigger_control", ("id_type_file",), "file_configuration", "id_type_file"),
    *_declared("process_validation_logs", PROCESS_VALIDATION_LOGS),
    Constraint("foreign_key", "process_validation_logs", ("id_trigger",), "trigger_control", "id_trigger"),
)


def metadata_constraint_violations(catalog: DataFrame, rules: DataFrame) -> DataFrame:
    """M7 on the metadata itself, checked before a run."""
    return constraint_violations({"file_configuration": catalog, "semantic_layer": rules}, METADATA_CONSTRAINTS)


def log_constraint_violations(catalog: DataFrame, triggers: DataFrame, errors: DataFrame) -> DataFrame:
    """M7 on the two log tables."""
    return constraint_violations({"file_configuration": catalog, "trigger_control": triggers,
                                  "process_validation_logs": errors}, LOG_CONSTRAINTS)
