"""Member summary: many ``x IN (subquery)`` tests answered by one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import truth
from .joins import dealt_join


def member_summary(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row per non-NULL ``key`` with ``bool_or(cond)`` per named flag.

    ``flags[name]`` is the WHERE of one membership list over the same
    source; ``key IN (SELECT key FROM df WHERE cond)`` is then
    ``summary[name]`` for that key.  An unknown condition counts as false
    (the row would not be in the list).  NULL keys never match an ``IN``, so
    they are dropped before the shuffle (they are also the usual hot group).
    """
    if not flags:
        raise ValueError("member_summary needs at least one flag")
    src = df.filter(F.col(key).isNotNull())
    return src.groupBy(key).agg(*[F.bool_or(truth(c)).alias(n) for n, c in flags.items()])


def attach_flags(
    df: DataFrame,
    key: Column | str,
    summary: DataFrame,
    summary_key: str,
    names: Sequence[str],
    hint: str | None = None,
) -> DataFrame:
    """LEFT JOIN the summary on ``key``; a key absent from it gets false.  Rows
    with a NULL key are spread."""
    s = summary.select(F.col(summary_key).alias("__sk"), *[F.col(n) for n in names])
    out = dealt_join(df, s, key, "__sk", salts=1, hint=hint).drop("__sk")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in names})
