"""Column expressions used by the rules.

All of them are built-in Catalyst expressions: no Python runs per row, and
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c: ColumnOrName) -> Column:
    """Keep ASCII digits only; NULL stays NULL (the cleaning scalar function).

    Digits have no case, so the input is compared in binary collation (the
    regular expression functions do not take the trailing-blank collations).
    """
    return F.regexp_replace(F.collate(col(c).cast("string"), "UTF8_BINARY"), "[^0-9]", "")


def digits_fixed(c: ColumnOrName, n: int) -> Column:
    """Digits of ``c`` if exactly ``n`` remain, else NULL (NPI: 10, tax id: 9)."""
    d = digits_only(c)
    return F.when(F.length(d) == n, d)


def varchar(c: ColumnOrName, width: int = 30) -> Column:
    """``CAST(c AS VARCHAR(width))``: the first ``width`` characters; a cast
    that declares no width keeps 30.  NULL stays NULL."""
    if width < 1:
        raise ValueError("width must be positive")
    return F.substring(col(c).cast("string"), 1, width)


def zip5(c: ColumnOrName) -> Column:
    """First five digits of the first 30 characters, NULL unless five exist.

    ``1234-5678`` gives ``12345``: the strip runs before the cut to five, and
    after the cast that keeps 30 characters, as in the source statement.
    """
    d = F.substring(digits_only(varchar(c)), 1, 5)
    return F.when(F.length(d) == 5, d).cast("string")


def null_safe_concat(*parts: ColumnOrName) -> Column:
    """``CONCAT`` of string columns that treats NULL as the empty string
    (never returns NULL).  The inputs keep their collation, so the key still
    compares like the columns it is built from."""
    return F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])


def task_key(left: ColumnOrName, right: ColumnOrName, sep: str = " ") -> Column:
    """The task id / log key: ``left + sep + right`` with NULLs as ''."""
    return null_safe_concat(left, F.lit(sep), right)


def contains_any(c: ColumnOrName, patterns: Iterable[str]) -> Column:
    """``c LIKE '%p1%' OR c LIKE '%p2%' ...`` with SQL three-valued logic."""
    cc = col(c)
    out = None
    for p in patterns:
        term = cc.contains(p)
        out = term if out is None else (out | term)
    if out is None:
        raise ValueError("contains_any needs at least one pattern")
    return out


def contains_none(c: ColumnOrName, patterns: Iterable[str]) -> Column:
    """``c NOT LIKE '%p1%' AND ...``; NULL input stays unknown."""
    cc = col(c)
    out = None
    for p in patterns:
        term = ~cc.contains(p)
        out = term if out is None else (out & term)
    return out


def first_non_null(*cols: ColumnOrName) -> Column:
    """COALESCE: the first non-NULL value, even when it is malformed."""
    return F.coalesce(*[col(c) for c in cols])


def strip_text(c: ColumnOrName, text: str) -> Column:
    """REPLACE(c, text, '') for every occurrence (literal, not a pattern)."""
    return F.replace(col(c), F.lit(text), F.lit(""))


def ordered_case(branches: Sequence[tuple[Column, ColumnOrName]], otherwise=None) -> Column:
    """Searched CASE: the first branch whose condition is TRUE wins.

    A condition that is NULL counts as not true, like SQL's CASE.  With
    ``otherwise=None`` unmatched rows get NULL (a CASE without ELSE).
    """
    if not branches:
        raise ValueError("ordered_case needs at least one branch")
    expr = None
    for cond, value in branches:
        v = F.lit(value) if not isinstance(value, Column) else value
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def truth(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END: unknown becomes false."""
    return F.coalesce(cond, F.lit(False))


def flag01(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END as an int."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
