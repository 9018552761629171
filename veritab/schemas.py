"""Fixed schemas (values that have to match): catalog, column rules, allowed
values and the two log tables, with the lengths and keys they declare."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# one row per table to validate
FILE_CONFIGURATION = _s(
    ("id_type_file", StringType(), False),
    ("type_file_name", StringType(), False),
    ("file_format", StringType(), False),
    ("source", StringType(), False),
    ("origin_path", StringType(), True),
    ("periodicity", StringType(), True),
    ("separator", StringType(), True),
    ("header", BooleanType(), True),
    ("reprocessable", BooleanType(), True),
    ("user_id", StringType(), False),
)

# one row per (table, column): the column's rule
SEMANTIC_LAYER = _s(
    ("id_type_file", StringType(), False),
    ("field_position", IntegerType(), True),
    ("field_name", StringType(), False),
    ("field_description", StringType(), True),
    ("pk", BooleanType(), True),
    ("data_type", StringType(), True),
    ("length", StringType(), True),
    ("nullable", BooleanType(), True),
    ("decimal_symbol", StringType(), True),
    ("referential_bbdd", StringType(), True),
    ("referential_table_field_name", StringType(), True),
    ("init_date", TimestampType(), True),
)

# allowed values per reference column
TD_TEMPLATES = _s(
    ("source", StringType(), True),
    ("template_code", StringType(), True),
    ("template_text", StringType(), True),
)

# status history, append-only
TRIGGER_CONTROL = _s(
    ("id_trigger", LongType(), False),
    ("id_type_file", StringType(), False),
    ("file_name", StringType(), False),
    ("environment", StringType(), False),
    ("source", StringType(), False),
    ("date_load", DateType(), False),
    ("tst_trigger_control", TimestampNTZType(), False),
    ("flag", DoubleType(), True),
    ("timestamp_load", LongType(), True),
    ("row_count", LongType(), True),
)

# error history, append-only
PROCESS_VALIDATION_LOGS = _s(
    ("id_trigger", LongType(), False),
    ("validation_id", IntegerType(), False),
    ("source", StringType(), False),
    ("type_validation", StringType(), False),
    ("file_name", StringType(), False),
    ("validation_msg", StringType(), True),
    ("field_name", StringType(), True),
    ("incidences", LongType(), False),
    ("flag", DoubleType(), False),
    ("execution_timestamp", TimestampNTZType(), False),
    ("date_load", DateType(), False),
    ("timestamp_load", LongType(), False),
)

# declared text lengths: table -> column -> characters
DECLARED_LENGTHS = {
    "file_configuration": {
        "id_type_file": 5, "type_file_name": 255, "file_format": 50, "source": 50, "origin_path": 255,
        "periodicity": 50, "separator": 50, "user_id": 50,
    },
    "semantic_layer": {
        "id_type_file": 5, "field_name": 255, "field_description": 255, "data_type": 255, "length": 255,
        "decimal_symbol": 255, "referential_bbdd": 255, "referential_table_field_name": 255,
    },
    "trigger_control": {"id_type_file": 5},
}
