"""SQL literal text for expressions built as strings (one JVM call each)."""

from __future__ import annotations


def sql_str(value) -> str:
    """A Spark SQL literal for a Python str / int / bool / None."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
