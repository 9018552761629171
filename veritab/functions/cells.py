"""Spreadsheet cell notation (F4a, F4b) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.constants import CELL_REGEX


def cell_letters(cell: Column, keep_empty: bool = False) -> Column:
    """Upper-cased column letters of the first ``letters+digits`` match.

    No match gives ``''``; by default that becomes NULL so the column number
    is NULL too (``keep_empty=True`` keeps ``''``).
    """
    letters = F.upper(F.regexp_extract(cell, CELL_REGEX, 1))
    return letters if keep_empty else F.nullif(letters, F.lit(""))


def cell_row(cell: Column) -> Column:
    """Row number of the reference as BIGINT; NULL when there is none, the
    largest BIGINT when it has more digits than that."""
    digits = F.nullif(F.regexp_extract(cell, CELL_REGEX, 2), F.lit(""))
    return F.when(digits.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit((1 << 63) - 1)))


#: letters whose base-26 number always fits a BIGINT
_FITTING_LETTERS = 13


def letters_to_number(letters: Column) -> Column:
    """Base-26 column number: A=1, Z=26, AA=27, AZ=52, BA=53.

    More letters than a BIGINT can hold give the largest BIGINT: such a cell
    is outside every table."""
    positions = F.sequence(F.lit(1), F.length(letters))
    number = F.aggregate(
        positions,
        F.lit(0).cast("bigint"),
        lambda acc, i: acc * 26 + (F.ascii(F.substring(letters, i, 1)) - 64),
    )
    return F.when(F.length(letters) > _FITTING_LETTERS, F.lit((1 << 63) - 1)).otherwise(number)


def parse_cell(cell: Column, keep_empty: bool = False) -> tuple[Column, Column, Column]:
    """(letters, row_num, col_num) of a cell reference such as ``m82``."""
    letters = cell_letters(cell, keep_empty)
    return letters, cell_row(cell), letters_to_number(letters)


def out_of_bounds(row_num: Column, col_num: Column, row_count: Column | int,
                  column_count: Column | int, inclusive: bool = False) -> Column:
    """Cell outside the table.

    Default (``inclusive=False``) rejects ``row >= row_count`` or
    ``col >= column_count``, i.e. the last row and column count as outside;
    ``inclusive=True`` rejects only cells past the last row / column.
    """
    rc = row_count if isinstance(row_count, Column) else F.lit(row_count)
    cc = column_count if isinstance(column_count, Column) else F.lit(column_count)
    if inclusive:
        return (row_num > rc) | (col_num > cc)
    return (row_num >= rc) | (col_num >= cc)
