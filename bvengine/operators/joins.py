"""Join operators: dealt joins, role-playing dimensions, computed keys,
membership flags, ON-clause conditions on the preserved side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col


def qcol(name: str) -> Column:
    """Column by exact name, also for names with blanks or '#'."""
    return F.col(f"`{name}`")


#: Copies of a row of a small right side, over which the rows of one key are dealt.
SALTS = 16
#: Joins in which a broadcast right side leaves the left rows where they are.
UNMOVED = ("left", "inner", "left_semi", "left_anti")


def salt_of(key: Column, by: Sequence[Column | str], salts: int) -> Column:
    """A row's share of its key: NULL keys match nothing, so each row gets a
    share of its own; other keys are dealt over ``salts`` shares.  A hash of
    the row's columns, so a recomputed task deals alike."""
    h = F.xxhash64(*[col(c) for c in by])
    return F.when(key.isNull(), h).otherwise(F.pmod(h, F.lit(salts).cast("bigint")))


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark broadcasts ``df`` of its own accord: its estimate is
    within ``spark.sql.autoBroadcastJoinThreshold``."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def hot_keys(df: DataFrame, key: Column | str) -> DataFrame:
    """Keys of ``df`` that alone hold more rows than an average shuffle
    partition (``__hot``), with the number of such partitions that their rows
    fill (``__shares``, above 1).

    One narrow aggregation with partial sums.  Keys above the average are
    fewer than ``spark.sql.shuffle.partitions``, whatever the input, so the
    result is small enough to be broadcast.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(col(key).alias("__hot")).filter(F.col("__hot").isNotNull()).groupBy("__hot").agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    shares = F.ceil(F.col("__n") * F.lit(partitions).cast("double") / total)
    return counts.withColumn("__shares", shares).filter(F.col("__shares") > 1).select("__hot", "__shares")


def with_shares(df: DataFrame, key: str, hot: DataFrame, by: Sequence[Column | str], hint: str | None = None) -> DataFrame:
    """``df`` with ``__shares``, that of its key in ``hot`` (``hot_keys``) or 1.

    ``hot`` is broadcast, as its size is bounded.  With a join ``hint`` it is
    shuffled instead, and the rows of a key are dealt over ``SALTS`` copies.
    """
    if hint is None:
        out = df.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    else:
        copies = hot.withColumn("__hs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        out = df.withColumn("__ks", salt_of(F.col(key), by, SALTS))
        out = out.join(copies.hint(hint), (F.col(key) == F.col("__hot")) & (F.col("__ks") == F.col("__hs")), "left").drop("__ks", "__hs")
    return out.withColumn("__shares", F.coalesce("__shares", F.lit(1).cast("bigint"))).drop("__hot")


def repeated(df: DataFrame, key: str, hot: DataFrame, name: str, hint: str | None = None) -> DataFrame:
    """Rows of ``df`` once per share of their key, numbered in ``name``; rows
    of keys that are not hot once, as share 0."""
    out = df.join(hot.hint(hint) if hint else F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    shares = F.sequence(F.lit(0).cast("bigint"), F.coalesce("__shares", F.lit(1).cast("bigint")) - 1)
    return out.withColumn(name, F.explode(shares)).drop("__hot", "__shares")


def dealt_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column | str,
    right_key: str,
    how: str = "left",
    by: Sequence[Column | str] | None = None,
    salts: int | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Equi-join in which no key sends all its rows to one task.

    The rows of a hot key (``hot_keys`` of ``left``) are dealt over its shares
    by a hash of the columns ``by`` (default all), and only the rows of
    ``right`` with such a key are repeated, so the result is that of the plain
    join and a row of any other key is shuffled once.  Rows with a NULL key
    are spread over all tasks.

    A ``right`` that Spark broadcasts by itself (``is_broadcast``) is joined as
    it is: no row of ``left`` moves, so no key is hot.  Repeating its rows
    would hide its size from Spark, and ``left`` would be shuffled.

    Otherwise ``left`` is read twice, the first time for its key alone.  Where that
    costs more than copies of a small ``right``, ``salts`` deals every key over
    so many shares and repeats every row of ``right``; with ``salts=1`` only
    NULL keys are spread.  ``hint`` is a join hint for ``right``.
    """
    by = by or [qcol(c) for c in left.columns]
    out = left.withColumn("__lk", col(left_key))
    r = right.filter(qcol(right_key).isNotNull()).withColumn("__rk", qcol(right_key))
    zero = F.lit(0).cast("bigint")
    if salts is None and hint is None and how in UNMOVED and is_broadcast(r):
        return out.join(r, F.col("__lk") == F.col("__rk"), how).drop("__lk", "__rk")
    if salts is None:
        hot = hot_keys(out, "__lk")
        h = F.xxhash64(*[col(c) for c in by])
        out = with_shares(out, "__lk", hot, by, hint)
        out = out.withColumn("__ls", F.when(F.col("__lk").isNull(), h).otherwise(F.pmod(h, F.col("__shares")))).drop("__shares")
        r = repeated(r, "__rk", hot, "__rs", hint)
    else:
        out = out.withColumn("__ls", salt_of(F.col("__lk"), by, salts))
        r = r.withColumn("__rs", F.explode(F.sequence(zero, F.lit(salts - 1).cast("bigint"))) if salts > 1 else zero)
    r = r.hint(hint) if hint else r
    on = (F.col("__lk") == F.col("__rk")) & (F.col("__ls") == F.col("__rs"))
    return out.join(r, on, how).drop("__lk", "__ls", "__rk", "__rs")


def role_join(
    df: DataFrame,
    dim: DataFrame,
    key: Column | str,
    prefix: str,
    dim_key: str = "id",
    columns: Sequence[str] | None = None,
    how: str = "left",
    by: Sequence[Column | str] | None = None,
    salts: int | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join one role of a dimension (the same table under another alias).

    The dimension's columns come back prefixed (``prefix + name``), so the
    same dimension can be joined several times.  Hot and NULL keys are dealt
    (``dealt_join``); Spark broadcasts the dimension where its size allows.
    """
    cols = list(columns) if columns is not None else list(dim.columns)
    if dim_key not in cols:
        cols = [dim_key] + cols
    d = dim.select(*[qcol(c).alias(prefix + c) for c in cols])
    return dealt_join(df, d, key, prefix + dim_key, how, by, salts, hint)


def join_on_first_key(
    left: DataFrame,
    keys: Sequence[Column | str],
    right: DataFrame,
    right_key: str,
    how: str = "left",
    key_name: str = "__first_key",
    keep_key: bool = False,
    salts: int | None = None,
) -> DataFrame:
    """Join on ``COALESCE(keys...)``: the first non-NULL candidate key."""
    out = left.withColumn(key_name, F.coalesce(*[col(k) for k in keys]))
    out = dealt_join(out, right, key_name, right_key, how, salts=salts)
    return out if keep_key else out.drop(key_name)


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    on: Column,
    extra: Column | None = None,
    mode: str = "inert",
) -> DataFrame:
    """LEFT JOIN with extra conditions.

    ``mode="inert"`` puts ``extra`` in the ON clause, as written: it can only
    decide which right rows attach, never drop a left row.  ``mode="filter"``
    applies it after the join (a WHERE), which is what such conditions are
    usually meant to do.
    """
    if extra is None:
        return left.join(right, on, "left")
    if mode == "inert":
        return left.join(right, on & extra, "left")
    if mode == "filter":
        return left.join(right, on, "left").filter(extra)
    raise ValueError(f"mode must be 'inert' or 'filter', got {mode!r}")


def with_member_flag(
    df: DataFrame,
    key: Column | str,
    members: DataFrame,
    member_key: str,
    name: str,
) -> DataFrame:
    """``key IN (SELECT member_key FROM members)`` as a boolean column.

    The list is made distinct first (partial + final aggregation), so the
    LEFT JOIN cannot fan out; NULL list entries can never match and are
    dropped.  NULL ``key`` gives false, which is what ``CASE WHEN key IN
    (..) THEN 1 ELSE 0`` yields; rows with a NULL ``key`` are spread.
    """
    m = members.select(F.col(member_key).alias("__mk")).filter(F.col("__mk").isNotNull()).distinct()
    out = dealt_join(df, m, key, "__mk", salts=1)
    return out.withColumn(name, F.col("__mk").isNotNull()).drop("__mk")
