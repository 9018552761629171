"""Ranges of about equal numbers of rows for a partitioned JDBC read.

Equal steps between the least and the greatest value leave most rows in one
range when the column is skewed.  Here the database counts rows in a bounded number
of equal steps (one GROUP BY, at most ``BUCKETS`` rows back); a step that
holds more than a range should is divided again in the same way, until it is
narrow enough or holds one value.  Range ends are then chosen on the counts.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

#: steps of one histogram, and rounds of division
BUCKETS, ROUNDS = 256, 8

Ask = Callable[[str], list[tuple]]


def histogram_sql(table: str, column: str, low: Decimal, step: Decimal, high: Decimal) -> str:
    """Rows per step: ``bucket`` (0 ...), ``n``, of values from ``low`` to ``high``."""
    bucket = f"FLOOR(({column} - ({low})) / {step})"
    return (f"SELECT {bucket} AS bucket, COUNT(*) AS n FROM {table} "
            f"WHERE {column} >= {low} AND {column} <= {high} GROUP BY {bucket}")


def histogram(ask: Ask, table: str, column: str, low: Decimal, high: Decimal, most: int,
              rounds: int = ROUNDS) -> list[tuple[Decimal, int]]:
    """(start of a step, its rows) in ascending order, steps of more than ``most`` rows divided."""
    step = max((high - low) / BUCKETS, Decimal(0))
    if step == 0:
        return [(low, sum(int(r[1]) for r in ask(histogram_sql(table, column, low, Decimal(1), high))))]
    if step == step.to_integral_value() or high - low >= BUCKETS:
        step = step.to_integral_value(rounding="ROUND_CEILING")  # whole steps for whole numbers
    found = []
    for bucket, n in sorted((int(r[0]), int(r[1])) for r in ask(histogram_sql(table, column, low, step, high))):
        start = low + bucket * step
        last = min(high, start + step - (1 if step >= 1 else 0))
        if n > most and rounds > 1 and last > start:
            found += histogram(ask, table, column, start, last, most, rounds - 1)
        else:
            found.append((start, n))
    return found


def range_starts(counts: list[tuple[Decimal, int]], parts: int) -> list[Decimal]:
    """Starts of the second and later ranges, each range about the same number of rows."""
    total = sum(n for _, n in counts)
    starts, held, done = [], 0, 0
    for start, n in counts:
        # before a step that would carry the range past its share by more than it lacks now
        share = (total - done) / max(1, parts - len(starts))
        if held and held + n / 2 > share and len(starts) < parts - 1:
            starts.append(start)
            done, held = done + held, 0
        held += n
    return starts


def equi_depth_predicates(ask: Ask, table: str, column: str, parts: int) -> list[str]:
    """WHERE conditions of the ranges; together they hold every row once, null values in the first."""
    low, high, n = ask(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n FROM {table}")[0]
    if low is None or parts < 2:
        return ["1 = 1"]
    low, high = Decimal(str(low)), Decimal(str(high))
    counts = histogram(ask, table, column, low, high, max(1, int(n) // (2 * parts)))
    starts = range_starts(counts, parts)
    if not starts:
        return ["1 = 1"]
    first = [f"{column} < {starts[0]} OR {column} IS NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(starts, starts[1:])]
    return [*first, *inner, f"{column} >= {starts[-1]}"]
