"""Reusable Column expressions."""

from emporium.functions.expressions import (
    has_prefix,
    is_close,
    money_round,
    normalized,
    null_count,
    null_safe_equal,
    surrogate_key,
)

__all__ = [
    "has_prefix",
    "is_close",
    "money_round",
    "normalized",
    "null_count",
    "null_safe_equal",
    "surrogate_key",
]
