"""Aggregations: groups holding all required values, flag pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_all(
    df: DataFrame,
    key: str,
    value_col: str,
    required: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """Keys whose rows (after ``where``) include every value in ``required``.

    Relational division as one aggregation: rows are first cut to the
    required values, then ``bool_or`` per value.  The aggregate is
    partial + final, so a key holding a third of all rows is folded map-side
    to one small row per task before the shuffle.
    """
    if not required:
        raise ValueError("has_all needs at least one required value")
    src = df if where is None else df.filter(where)
    src = src.filter(F.col(key).isNotNull() & F.col(value_col).isin(list(required)))
    flags = [F.bool_or(F.col(value_col) == F.lit(v)).alias(f"__has_{i}") for i, v in enumerate(required)]
    agg = src.groupBy(key).agg(*flags)
    cond = None
    for i in range(len(required)):
        c = F.col(f"__has_{i}")
        cond = c if cond is None else (cond & c)
    return agg.filter(cond).select(key)


def flag_pivot(
    df: DataFrame,
    key: str,
    type_col: str,
    status_col: str,
    types: Sequence[str],
    names: Sequence[str],
    active: str = "Active",
    inactive: str = "Inactive",
) -> DataFrame:
    """One status column per type: ``active`` iff ``MAX(status of that type)``
    equals ``active``, else ``inactive`` (the PIVOT rewritten as CASE).

    ``MAX`` is the string maximum, exactly as in the source; a caller that
    filters rows to ``active`` first gets "has an active row of that type".
    """
    if len(types) != len(names):
        raise ValueError("types and names must have the same length")
    aggs = []
    for t, n in zip(types, names):
        m = F.max(F.when(F.col(type_col) == F.lit(t), F.col(status_col)))
        aggs.append(F.when(m == F.lit(active), F.lit(active)).otherwise(F.lit(inactive)).alias(n))
    return df.groupBy(key).agg(*aggs)
