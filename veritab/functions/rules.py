"""Rule decoding (M6): the rules frame gets typed, defaulted columns.

Decoding runs on the rules DataFrame itself; only the decoded rule rows of
one table (metadata, a few dozen rows) reach the driver, to turn them into
column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.constants import DECIMAL_TYPE_REGEX, DEFAULT_DECIMAL_SYMBOL

KINDS = ("STRING", "INT", "DECIMAL", "DATE")


def _kind(dt: Column) -> Column:
    return (
        F.when(dt.isNull(), F.lit("UNKNOWN"))
        .when(dt == "STRING", F.lit("STRING"))
        .when(dt == "INT", F.lit("INT"))
        .when(dt.startswith("DECIMAL"),
              F.when(dt.rlike(DECIMAL_TYPE_REGEX), F.lit("DECIMAL")).otherwise(F.lit("MALFORMED")))
        # any type starting with DATE (DATE, DATETIME, ...) is checked as a date
        .when(dt.startswith("DATE"), F.lit("DATE"))
        .otherwise(F.lit("UNKNOWN"))
    )


def decode_rules(rules: DataFrame) -> DataFrame:
    """Decode a semantic-layer frame.

    Adds: kind, max_length, precision, scale, symbol, is_nullable, is_pk,
    rule_error (null when the rule is usable).
    """
    dt = F.col("data_type")
    kind = _kind(dt)
    max_length = F.col("length").cast("string").try_cast("int")
    precision = F.when(kind == "DECIMAL", F.regexp_extract(dt, DECIMAL_TYPE_REGEX, 1).try_cast("int"))
    scale = F.when(kind == "DECIMAL", F.regexp_extract(dt, DECIMAL_TYPE_REGEX, 2).try_cast("int"))
    out = (
        rules
        .withColumn("kind", kind)
        .withColumn("max_length", max_length)
        .withColumn("precision", precision)
        .withColumn("scale", scale)
        .withColumn("symbol", F.coalesce(F.col("decimal_symbol"), F.lit(DEFAULT_DECIMAL_SYMBOL)))
        # a missing flag unboxes to false: strict not-null, not a key
        .withColumn("is_nullable", F.coalesce(F.col("nullable"), F.lit(False)))
        .withColumn("is_pk", F.coalesce(F.col("pk"), F.lit(False)))
    )
    error = (
        F.when(F.col("kind") == "UNKNOWN", F.lit("unknown data type"))
        .when(F.col("kind") == "MALFORMED", F.lit("malformed decimal type"))
        .when((F.col("kind") == "DECIMAL") & (F.col("precision").isNull() | F.col("scale").isNull()),
              F.lit("decimal digits beyond an integer"))
        .when(F.col("max_length").isNull(), F.lit("length missing or not a number"))
        .when((F.col("kind") == "INT") & (F.col("max_length") < 1), F.lit("int length below 1"))
        .when((F.col("kind") == "DECIMAL") & (F.col("scale") > F.col("precision")),
              F.lit("decimal scale above precision"))
    )
    return out.withColumn("rule_error", error)


@dataclass(frozen=True)
class Rule:
    """One decoded column rule, on the driver."""

    field_name: str
    field_position: int | None = None
    table_id: str | None = None
    data_type: str | None = "STRING"
    kind: str = "STRING"
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    symbol: str = DEFAULT_DECIMAL_SYMBOL
    is_nullable: bool = True
    is_pk: bool = False
    reference: str | None = None
    rule_error: str | None = None


def collect_rules(decoded: DataFrame, table_id: str | None = None) -> list[Rule]:
    """Decoded rules of one table in position order (metadata rows only)."""
    frame = decoded if table_id is None else decoded.where(F.col("id_type_file") == F.lit(table_id))
    # rule rows are metadata (a few per column): sorted on the driver, no sort job
    rows = sorted(frame.collect(), key=lambda r: (r["id_type_file"], r["field_position"] is None,
                                                  r["field_position"] or 0))
    return [
        Rule(
            field_name=r["field_name"], field_position=r["field_position"], table_id=r["id_type_file"],
            data_type=r["data_type"], kind=r["kind"], max_length=r["max_length"],
            precision=r["precision"], scale=r["scale"], symbol=r["symbol"],
            is_nullable=r["is_nullable"], is_pk=r["is_pk"],
            reference=r["referential_table_field_name"], rule_error=r["rule_error"],
        )
        for r in rows
    ]


def _int(text: str) -> int | None:
    """A whole number as Spark casts it to INT: ASCII digits in range, or None."""
    import re

    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    value = int(text) if len(text) < 20 else 1 << 40
    return value if -(1 << 31) <= value < 1 << 31 else None


def make_rule(field_name: str, data_type: str | None, length: int | str | None = None,
              nullable: bool | None = True, decimal_symbol: str | None = None,
              pk: bool | None = False, position: int | None = None,
              reference: str | None = None) -> Rule:
    """Build a decoded rule on the driver, for rules written in code.

    Same decoding as :func:`decode_rules`; used by callers that declare rules
    inline instead of reading a semantic layer.
    """
    import re

    kind = "UNKNOWN"
    precision = scale = None
    if data_type is None:
        kind = "UNKNOWN"
    elif data_type in ("STRING", "INT"):
        kind = data_type
    elif data_type.startswith("DECIMAL"):
        m = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", data_type)
        kind = "DECIMAL" if m else "MALFORMED"
        if m:
            precision, scale = _int(m.group(1)), _int(m.group(2))
    elif data_type.startswith("DATE"):
        kind = "DATE"
    max_length = _int(str(length).strip()) if length is not None else None
    error = None
    if kind == "UNKNOWN":
        error = "unknown data type"
    elif kind == "MALFORMED":
        error = "malformed decimal type"
    elif kind == "DECIMAL" and (precision is None or scale is None):
        error = "decimal digits beyond an integer"
    elif max_length is None:
        error = "length missing or not a number"
    elif kind == "INT" and max_length < 1:
        error = "int length below 1"
    elif kind == "DECIMAL" and scale > precision:
        error = "decimal scale above precision"
    return Rule(
        field_name=field_name, field_position=position, data_type=data_type, kind=kind,
        max_length=max_length, precision=precision, scale=scale,
        symbol=decimal_symbol if decimal_symbol is not None else DEFAULT_DECIMAL_SYMBOL,
        is_nullable=bool(nullable) if nullable is not None else False,
        is_pk=bool(pk) if pk is not None else False, reference=reference, rule_error=error,
    )
