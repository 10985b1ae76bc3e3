"""Sink: write the work list, and tables that later runs read.

The source statement only returns rows; the caller stores them.  A capped
list comes out of the cap's merge as one partition, so it is one file; an
uncapped list keeps Spark's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import qcol


def write_worklist(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write ``df`` to ``path`` as ``parquet`` or ``csv`` (with a header).  An
    earlier list is only replaced with ``mode="overwrite"``."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"fmt must be 'parquet' or 'csv', got {fmt!r}")
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save ``df`` as catalog table ``table`` in ``buckets`` buckets by the hash
    of ``key``, each sorted by it.  Joins and aggregations on ``key`` then start
    without a shuffle of the table; that needs at least as many buckets as
    ``spark.sql.shuffle.partitions``.  The rows are first brought together by
    bucket, so a bucket is one file, not one a task.

    A bucket is read by one task and Spark does not split it: bucket tables by
    keys that are spread, not where one key holds a large share of the rows.
    """
    whole = df.repartition(buckets, qcol(key))
    whole.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
