"""DISTINCT plus a deterministic cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .joins import qcol


def top_distinct(df: DataFrame, n: int | None, order: Sequence[str] = (), along: Sequence[str] = ()) -> DataFrame:
    """``SELECT DISTINCT TOP n`` with a defined choice of rows.

    The source caps without ORDER BY, so which rows come back is undefined
    there.  Here the rows are ordered by ``order`` and then by every other
    column (ascending, NULLs first), so a rerun returns the same rows.
    Spark plans ``orderBy().limit(n)`` as TakeOrderedAndProject: each task
    keeps its own top ``n`` and only ``n x tasks`` rows reach the final
    merge.  ``n=None`` returns the whole distinct result.

    ``along`` names helper columns whose values follow from the others, such as
    the salt of the join just below.  They are grouped by as well and dropped
    at the end, which leaves the distinct rows as they are; where ``df`` is
    already partitioned by a key of the result and these columns, equal rows
    lie in one task and the DISTINCT shuffles nothing.
    """
    d = df.distinct()
    if n is None:
        return d.drop(*along)
    first = list(order)
    rest = [c for c in df.columns if c not in first and c not in along]
    return d.orderBy(*[qcol(c).asc_nulls_first() for c in first + rest]).limit(n).drop(*along)
