"""Window operators: row numbers and the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _desc(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def row_number_desc(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    tiebreak: str | Sequence[str] = (),
    name: str = "r",
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC, tiebreak DESC)``.

    NULL order values sort last.  Ties on ``order`` are undefined in SQL; the
    ``tiebreak`` columns make the numbering deterministic (and so stable
    when a lost task is recomputed).
    """
    w = Window.partitionBy(*_as_list(keys)).orderBy(*[_desc(c) for c in _as_list(order) + _as_list(tiebreak)])
    return df.withColumn(name, F.row_number().over(w))


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    tiebreak: str | Sequence[str] = (),
    keep_rank: bool = False,
    name: str = "r",
) -> DataFrame:
    """The newest row per key.

    The ``r = 1`` filter sits right above the window, so Catalyst inserts a
    partial WindowGroupLimit before the shuffle: each task ships at most one
    row per key, whatever the size of a hot key's group.  Equivalent to
    joining every rank and rejecting ``COALESCE(r, 0) > 1`` afterwards.
    """
    out = row_number_desc(df, keys, order, tiebreak, name).filter(F.col(name) == 1)
    return out if keep_rank else out.drop(name)
