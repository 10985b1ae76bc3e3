"""Column-level functions (scalar rules, string cleaning, the cutoff clock)."""

from .cutoff import cutoff_literal, repull_cutoff, repull_cutoff_col
from .exprs import (
    contains_any,
    contains_none,
    digits_fixed,
    digits_only,
    first_non_null,
    flag01,
    null_safe_concat,
    ordered_case,
    strip_text,
    task_key,
    truth,
    varchar,
    zip5,
)

__all__ = [
    "contains_any",
    "contains_none",
    "cutoff_literal",
    "digits_fixed",
    "digits_only",
    "first_non_null",
    "flag01",
    "null_safe_concat",
    "ordered_case",
    "repull_cutoff",
    "repull_cutoff_col",
    "strip_text",
    "task_key",
    "truth",
    "varchar",
    "zip5",
]
