"""Column expressions used across the operators; all stay inside the JVM.

Expressions repeated for every scenario, class or feature are built as SQL text,
which Spark parses in one call instead of one call per operator.
"""

from offerwise.functions.columns import (
    arithmetic_bucket,
    discount_grid,
    even_grid,
    flag_like,
    hash_bucket,
    is_close,
    keyed_digest,
    month_of,
    nan_to_null,
    number,
    percent_label,
    safe_ratio,
    softmax,
    to_number,
)

__all__ = [
    "arithmetic_bucket",
    "discount_grid",
    "even_grid",
    "flag_like",
    "hash_bucket",
    "is_close",
    "keyed_digest",
    "month_of",
    "nan_to_null",
    "number",
    "percent_label",
    "safe_ratio",
    "softmax",
    "to_number",
]
