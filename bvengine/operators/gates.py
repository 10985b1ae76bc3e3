"""Exclude-unless-stale: drop work items already submitted, unless the last
submission is older than a cutoff (and an optional condition holds)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col, truth
from .joins import SALTS, salt_of


def log_state(log: DataFrame, log_key: str, ts: str, aggs: Mapping[str, Column] | None = None, live: DataFrame | None = None) -> DataFrame:
    """The state of a log: per non-NULL key (``__log_key``) the largest ``ts``
    (``__max_ts``) and the named ``aggs``.

    One partial + final aggregation, so a key logged a million times costs one
    row per task in the shuffle.  ``live``, a frame of one column of keys, cuts
    the log to these keys below the aggregation, by a LEFT SEMI join that Spark
    broadcasts where the keys are few.  A state with sums only can be kept as
    a table and merged with the rows that came later (``merge_log_state``).
    """
    rows = log.filter(F.col(log_key).isNotNull())
    if live is not None:
        keys = live.select(F.col(live.columns[0]).alias("__live")).filter(F.col("__live").isNotNull()).distinct()
        rows = rows.join(keys, F.col(log_key) == F.col("__live"), "left_semi")
    named = [a.alias(n) for n, a in (aggs or {}).items()]
    return rows.groupBy(F.col(log_key).alias("__log_key")).agg(F.max(F.col(ts)).alias("__max_ts"), *named)


def merge_log_state(state: DataFrame, later: DataFrame) -> DataFrame:
    """The state of two logs taken together: dates by MAX, all other columns by
    SUM.  Both are NULL where no row of either has a value, as over one log, so
    any split of a log gives the state of the whole."""
    sums = [c for c in state.columns if c not in ("__log_key", "__max_ts")]
    both = state.unionByName(later)
    return both.groupBy("__log_key").agg(F.max("__max_ts").alias("__max_ts"), *[F.sum(c).alias(c) for c in sums])


def blocked_keys(
    log: DataFrame,
    log_key: str,
    ts: str,
    cutoff: Column,
    extra_aggs: Mapping[str, Column] | None = None,
    extra_cond: Column | None = None,
    out_key: str = "__blocked_key",
    state: DataFrame | None = None,
    live: DataFrame | None = None,
) -> DataFrame:
    """Log keys that block a new submission.

    Per key: ``MAX(ts)`` plus ``extra_aggs``; the key is free again iff
    ``MAX(ts) < cutoff AND extra_cond`` is TRUE.  Unknown (e.g. every date
    NULL) keeps it blocked, like ``CASE .. THEN 1 ELSE 0``.  With a ``state``
    of earlier rows, ``log`` holds only the later ones and ``extra_aggs`` are
    sums; ``live`` names the keys that matter (``log_state``).
    """
    per_key = log_state(log, log_key, ts, extra_aggs, live)
    if state is not None:
        per_key = merge_log_state(state, per_key)
    free = F.col("__max_ts") < cutoff
    if extra_cond is not None:
        free = free & extra_cond
    return per_key.filter(~truth(free)).select(F.col("__log_key").alias(out_key))


def exclude_unless_stale(
    df: DataFrame,
    key: Column | str,
    log: DataFrame,
    log_key: str,
    ts: str,
    cutoff: Column,
    extra_aggs: Mapping[str, Column] | None = None,
    extra_cond: Column | None = None,
    hot_key: str | None = None,
    salt: str | None = None,
    hint: str | None = None,
    state: DataFrame | None = None,
    live: DataFrame | None = None,
) -> DataFrame:
    """Keep rows of ``df`` whose key was never logged, or whose log is stale.

    Same rows as ``df LEFT JOIN (log aggregated per key) lg ON lg.key = key
    WHERE lg.key IS NULL OR (MAX(ts) < cutoff AND extra_cond)``, written as a
    LEFT ANTI join against the blocked keys (Catalyst does not make this
    rewrite itself).

    ``hot_key`` names one key that many rows may share (an "unnamed" key):
    its rows are dealt over ``SALTS`` tasks, and NULL keys over all, by the
    column ``salt`` (``salt_of``), which several gates may share.  ``state``
    and ``live`` are those of ``blocked_keys``.
    """
    blocked = blocked_keys(log, log_key, ts, cutoff, extra_aggs, extra_cond, state=state, live=live)
    if hot_key is None:
        blocked = blocked.hint(hint) if hint else blocked
        return df.join(blocked, col(key) == F.col("__blocked_key"), "left_anti")
    if salt is None:
        raise ValueError("hot_key needs the salt column")
    shares = F.when(F.col("__blocked_key") == F.lit(hot_key), F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    blocked = blocked.withColumn("__bs", F.explode(shares.otherwise(F.array(F.lit(0).cast("bigint")))))
    blocked = blocked.hint(hint) if hint else blocked
    return df.join(blocked, (col(key) == F.col("__blocked_key")) & (F.col(salt) == F.col("__bs")), "left_anti")


def hot_key_salt(key: Column | str, hot_key: str, by: Sequence[Column | str]) -> Column:
    """The salt column of ``exclude_unless_stale``: 0 but for the hot key and NULLs."""
    k = col(key)
    return F.when(k.isNull() | (k == F.lit(hot_key)), salt_of(k, by, SALTS)).otherwise(F.lit(0).cast("bigint"))
