"""Column expressions shared by the operators."""

from tidemark.functions.expressions import (  # noqa: F401
    array_fields,
    element_count,
    event_key,
    first_param,
    item_count,
    has_elements,
    item_count,
    param_max,
    parse_day,
    parse_iso_timestamp,
    safe_divide,
    steady_avg,
    steady_sum,
    sunday_of,
    try_parse_day,
)
from tidemark.functions.rows import loose, repeat_rows, round_doubles, unrolled  # noqa: F401
