"""The re-pull cutoff: ``as_of`` minus a number of hours that skips weekends.

``as_of - 100h``; if that lands on a Sunday use ``as_of - 148h``, on a
Saturday ``as_of - 124h`` (both land on the Friday before, same clock time).
Times are zone-less wall-clock values (``TimestampNTZ``).

Two forms: a driver-side scalar (the normal case, one value per run, folded
into the plan as a literal) and a Column form for per-row clocks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RULES, Rules
from .exprs import col


def repull_cutoff(as_of: _dt.datetime, cfg: Rules = RULES) -> _dt.datetime:
    base = as_of - _dt.timedelta(hours=cfg.repull_hours)
    # Python weekday(): Monday=0 .. Saturday=5, Sunday=6
    if base.weekday() == 6:
        return as_of - _dt.timedelta(hours=cfg.repull_hours_if_sunday)
    if base.weekday() == 5:
        return as_of - _dt.timedelta(hours=cfg.repull_hours_if_saturday)
    return base


def _minus_hours(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours))


def repull_cutoff_col(as_of, cfg: Rules = RULES) -> Column:
    """Column form; ``dayofweek`` is 1=Sunday .. 7=Saturday."""
    ts = col(as_of)
    base = _minus_hours(ts, cfg.repull_hours)
    dow = F.dayofweek(base)
    return (
        F.when(dow == 1, _minus_hours(ts, cfg.repull_hours_if_sunday))
        .when(dow == 7, _minus_hours(ts, cfg.repull_hours_if_saturday))
        .otherwise(base)
    )


def cutoff_literal(as_of: _dt.datetime, cfg: Rules = RULES) -> Column:
    """The scalar cutoff as a zone-less timestamp literal."""
    c = repull_cutoff(as_of, cfg)
    return F.lit(c.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
