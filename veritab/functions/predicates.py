"""Violation predicates for text columns.

Each builder returns a boolean Column that is TRUE when the value breaks the
rule.  Three-valued logic is kept on purpose: a null value in a nullable
column yields NULL, which neither ``count_if`` nor ``where`` counts, so it
passes.  All of them are built-in expressions and stay inside whole-stage
codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.constants import DATE_OFFSET_REGEX
from veritab.functions.rules import Rule


def _text(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return c.cast("string")


def is_null(c: Column) -> Column:
    """A required value is missing."""
    return c.isNull()


def too_long(c: Column, max_length: int) -> Column:
    """Text longer than ``max_length`` characters."""
    return F.length(c) > F.lit(max_length)


def int_regex(max_length: int) -> str:
    return rf"^-?\d{{1,{max_length}}}\z"


def decimal_regex(precision: int, scale: int, symbol: str = ".") -> str:
    """Exactly ``scale`` decimals after the declared symbol, at most
    ``precision - scale`` integer digits.  The symbol is quoted, so ``.``
    means a dot; precision == scale allows an optional leading zero."""
    int_digits = precision - scale
    int_part = rf"\d{{1,{int_digits}}}" if int_digits > 0 else "0?"
    return rf"^-?{int_part}\Q{symbol}\E\d{{{scale}}}\z"


def bad_int(c: Column, max_length: int) -> Column:
    """Not an optionally signed integer of 1..max_length digits."""
    return too_long(c, max_length) | ~c.rlike(int_regex(max_length))


def bad_decimal(c: Column, max_length: int, precision: int, scale: int, symbol: str = ".") -> Column:
    """T4: not a decimal of the declared shape."""
    return too_long(c, max_length) | ~c.rlike(decimal_regex(precision, scale, symbol))


def bad_date_offset(c: Column, max_length: int) -> Column:
    """T5: not a valid date followed by an hour offset, e.g. ``2025-02-24 +01``."""
    return too_long(c, max_length) | c.try_cast("date").isNull() | ~c.rlike(DATE_OFFSET_REGEX)


def always() -> Column:
    """Unknown or malformed type, every row violates."""
    return F.lit(True)


def violation_predicate(rule: Rule, compat: bool = False, column: Column | None = None) -> Column:
    """The combined predicate of one column rule.

    ``compat=True`` keeps the original behaviour for a null in a nullable
    DATE column (a violation, because the cast of null is null); by default
    such a null passes like in every other type.
    """
    if rule.rule_error is not None:
        return always()
    c = _text(column if column is not None else rule.field_name)
    n = rule.max_length
    if rule.kind == "STRING":
        bad = too_long(c, n)
    elif rule.kind == "INT":
        bad = bad_int(c, n)
    elif rule.kind == "DECIMAL":
        bad = bad_decimal(c, n, rule.precision, rule.scale, rule.symbol)
    elif rule.kind == "DATE":
        bad = bad_date_offset(c, n)
        if rule.is_nullable and not compat:
            bad = c.isNotNull() & bad
    else:
        return always()
    if not rule.is_nullable:
        bad = is_null(c) | bad
    return bad


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _raw(text: str) -> str | None:
    """A raw SQL string literal, or None when the text cannot be one."""
    return None if "'" in text else f"r'{text}'"


def violation_sql(rule: Rule, compat: bool = False) -> str | None:
    """The same predicate as :func:`violation_predicate`, as one SQL expression.

    Building a rule's predicate as text costs one call into the JVM instead
    of one per function, which matters for semantic layers with hundreds of
    columns.  Returns None when a pattern cannot be written as a raw literal
    (the Column form is used then)."""
    if rule.rule_error is not None or rule.kind not in ("STRING", "INT", "DECIMAL", "DATE"):
        return "true"
    c = f"CAST({_ident(rule.field_name)} AS STRING)"
    n = rule.max_length
    long_ = f"length({c}) > {n}"
    if rule.kind == "STRING":
        bad = long_
    elif rule.kind == "INT":
        bad = f"({long_} OR NOT {c} RLIKE {_raw(int_regex(n))})"
    elif rule.kind == "DECIMAL":
        pattern = _raw(decimal_regex(rule.precision, rule.scale, rule.symbol))
        if pattern is None:
            return None
        bad = f"({long_} OR NOT {c} RLIKE {pattern})"
    else:
        bad = (f"({long_} OR try_cast({c} AS DATE) IS NULL OR NOT {c} RLIKE {_raw(DATE_OFFSET_REGEX)})")
        if rule.is_nullable and not compat:
            bad = f"({c} IS NOT NULL AND {bad})"
    if not rule.is_nullable:
        bad = f"({c} IS NULL OR {bad})"
    return bad


def fast_predicate(rule: Rule, compat: bool = False) -> Column:
    """:func:`violation_predicate` built from one SQL expression when possible."""
    text = violation_sql(rule, compat)
    return F.expr(text) if text is not None else violation_predicate(rule, compat)


def any_violation(preds: list[Column]) -> Column:
    """OR-reduce per-column predicates into one row filter."""
    return reduce(or_, preds)
