"""Column expressions: type predicates, cell notation, rule decoding, flags."""

from veritab.functions.cells import letters_to_number, out_of_bounds, parse_cell  # noqa: F401
from veritab.functions.predicates import (  # noqa: F401
    any_violation, bad_date_offset, bad_decimal, bad_int, decimal_regex, int_regex,
    is_null, too_long, violation_predicate,
)
from veritab.functions.rules import Rule, collect_rules, decode_rules, make_rule  # noqa: F401
