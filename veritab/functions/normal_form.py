"""A common key for values of two types, so that equal values compare equal.

Two values are equal when they denote the same thing exactly: numbers of any
type by their exact value (a decimal of any scale, a double by its exact binary
expansion: 2.5 is 2.50, the double 0.1 is not the decimal 0.1); dates and
timestamps by their place on the session's wall clock (a date is its midnight);
a text against another type by what it says when read as that type (``"1.50"``
is 1.5; against a double it is read as a double), and else as itself.  Values of
different families (a number and a date) are never equal.

Keys are text of one normal form per family, built from built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
    IntegralType, ShortType, StringType, TimestampNTZType, TimestampType,
)

Key = Callable[[Column], Column]

_NUMBER = r"^([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,9}))?\z"
_IS_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,9})?\z"
_IS_FLOAT = r"^(?:[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,9})?|NaN|[+-]?Infinity)\z"
_IS_TIME = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6})?)?)?\z"
#: a decimal has at most this many digits after the point, and before it
_DIGITS = 38


def _bound(value: Column, body: Key) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def number_text_key(text: Column) -> Column:
    """Normal form of a number written in digits: ``<sign><digits>e<exponent>`` for
    sign 0.digits 10^exponent, without zeros at either end; ``0`` for zero."""
    def key(parts: Column) -> Column:
        sign, whole, fraction, shift = (F.get(parts, F.lit(i)) for i in range(4))
        digits = F.ltrim(F.concat(whole, fraction), F.lit("0"))
        # places before the point, less the leading zeros that went
        exponent = F.length(digits) - F.length(fraction) + F.coalesce(shift.try_cast("bigint"), F.lit(0))
        return F.when(digits == "", "0").otherwise(F.concat(
            F.when(sign == "-", "-").otherwise(""), F.rtrim(digits, F.lit("0")), F.lit("e"), exponent.cast("string")))

    return _bound(text, lambda t: _bound(F.array(*[F.regexp_extract(t, _NUMBER, i) for i in range(1, 5)]), key))


def _exact_number(value: Column) -> Column:
    """Integers and decimals: their text says them exactly (with or without an exponent)."""
    return F.concat(F.lit("n"), number_text_key(value.cast("string")))


def _power(base: int, exponent: int) -> Column:
    text = str(base ** exponent)
    return F.lit(text).cast(f"decimal({len(text)},0)")


def _exact_double(value: Column) -> Column:
    return _bound(value.cast("double"), _expansion)


def _expansion(v: Column) -> Column:
    """A double by its exact expansion.

    Only a double below 10^38 with at most 38 binary places after the point can
    equal a decimal; its whole part is put together from limbs of 42 bits, its
    fraction f is f 2^38 times 5^38 in units of 10^-38.  Others get a key of
    their own kind.
    """
    size = F.abs(v)

    def whole_part(x: Column) -> Column:  # exact, as is a quotient by a power of two
        return x - (x % F.lit(1.0))

    whole = whole_part(size)
    scaled = (size - whole) * F.lit(2.0 ** _DIGITS)
    top = whole_part(whole / F.lit(2.0 ** 84))
    rest = whole - top * F.lit(2.0 ** 84)
    middle = whole_part(rest / F.lit(2.0 ** 42))
    low = rest - middle * F.lit(2.0 ** 42)

    def limb(x: Column) -> Column:
        return x.cast("bigint").cast("decimal(13,0)")

    before = ((limb(top) * _power(2, 84)).cast("decimal(38,0)") + (limb(middle) * _power(2, 42)).cast("decimal(37,0)")
              + limb(low)).cast("decimal(38,0)")
    after = (limb(scaled) * _power(5, _DIGITS)).cast("decimal(38,0)")
    text = F.concat(F.when(v < 0, "-").otherwise(""), before.cast("string"), F.lit("."),
                    F.lpad(after.cast("string"), _DIGITS, "0"))
    expands = (size < 1e38) & (scaled == whole_part(scaled))
    return F.when(expands, F.concat(F.lit("n"), number_text_key(text))).otherwise(F.concat(F.lit("f"), v.cast("string")))


def _wall_clock(value: Column) -> Column:
    return F.concat(F.lit("t"), value.cast("timestamp_ntz").cast("string"))


def _same_double(kind: str) -> Key:
    """Doubles (or floats) among themselves: their shortest text names one of them."""
    return lambda v: F.concat(F.lit("f"), (v.cast(kind).cast("double") + F.lit(0.0)).cast("string"))


def _text_as(pattern: str, read: Key, text: Column, as_type: str) -> Column:
    """A text that fits the pattern and can be read as the type by that type's key, else as text."""
    trimmed = F.trim(text)
    value = F.when(trimmed.rlike(pattern), trimmed.try_cast(as_type))
    return F.when(value.isNotNull(), read(value)).otherwise(F.concat(F.lit("s"), text))


def _is(kind: DataType, *types: type) -> bool:
    return isinstance(kind, types)


def _against_text(other: DataType) -> tuple[Key, Key]:
    """(key of a text, key of the other type)."""
    if _is(other, IntegralType, DecimalType):
        def text_number(text: Column) -> Column:
            trimmed = F.trim(text)
            return F.when(trimmed.rlike(_IS_NUMBER), F.concat(F.lit("n"), number_text_key(trimmed))) \
                .otherwise(F.concat(F.lit("s"), text))
        return text_number, _exact_number
    if _is(other, FloatType, DoubleType):
        kind = "float" if _is(other, FloatType) else "double"
        return lambda text: _text_as(_IS_FLOAT, _same_double(kind), text, kind), _same_double(kind)
    if _is(other, DateType, TimestampType, TimestampNTZType):
        return lambda text: _text_as(_IS_TIME, _wall_clock, text, "timestamp_ntz"), _wall_clock
    if _is(other, BooleanType):
        def truth(text: Column) -> Column:
            said = F.lower(F.trim(text))
            return F.when(said.isin("true", "false"), F.concat(F.lit("b"), said)).otherwise(F.concat(F.lit("s"), text))
        return truth, lambda v: F.concat(F.lit("b"), v.cast("string"))
    if _is(other, BinaryType):
        return lambda text: F.hex(F.encode(text, "UTF-8")), F.hex
    return lambda text: text, lambda v: v.cast("string")


def _key_in_family(kind: DataType) -> Key:
    """The key of a type that is no text, among the types of its family."""
    if _is(kind, IntegralType, DecimalType):
        return _exact_number
    if _is(kind, FloatType, DoubleType):
        return _exact_double
    if _is(kind, DateType, TimestampType, TimestampNTZType):
        return _wall_clock
    name = kind.simpleString()
    return lambda v: F.concat(F.lit(name + ":"), v.cast("string"))


def comparable(tested: DataType, allowed: DataType) -> tuple[Key, Key] | None:
    """(key of the tested value, key of the allowed value); None if the values compare as they are."""
    if tested == allowed or _is(tested, IntegralType) and _is(allowed, IntegralType):
        return None
    exact = (IntegralType, DecimalType)
    if _is(tested, *exact) and _is(allowed, *exact):
        digits = [(19, 0) if _is(t, IntegralType) else (t.precision - t.scale, t.scale) for t in (tested, allowed)]
        whole, scale = max(d for d, _ in digits), max(s for _, s in digits)
        if whole + scale <= _DIGITS:  # one decimal type holds both: the same answer without text
            return (lambda v: v.cast(f"decimal({whole + scale},{scale})"),) * 2
        return _exact_number, _exact_number
    in_double = (ByteType, ShortType, IntegerType, FloatType, DoubleType)
    if _is(tested, *in_double) and _is(allowed, *in_double):
        return (lambda v: v.cast("double"),) * 2
    if _is(tested, StringType) or _is(allowed, StringType):
        if _is(tested, StringType):
            return _against_text(allowed)
        text, other = _against_text(tested)
        return other, text
    return _key_in_family(tested), _key_in_family(allowed)
