"""Shared helpers: reading tables, stored intermediates, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a fresh one only where it is unset on a single machine."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="bvengine-llm-")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends in here go at its end: for stored tables, which nobody shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` stored with a number per row, and the number's column: the same number at every reading."""
    column = free_name(df, "row_number")
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name), column


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column of `df` has that name (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b): one row (node, component) per node that has an
    edge to another node; component is the smallest node reached.

    Alternating large-star and small-star rounds: each is one aggregation with partial sums and one equi-join,
    and the number of edges never grows. They end when every node has one edge, to a node that is the end of all
    of its own; no round only confirms that. Edges that are such stars already cost no round. Only the number of
    nodes that break this reaches the driver.
    """

    def oriented(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def settled(e: DataFrame) -> bool:
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return not seen.where("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0]

    now = stored(oriented(edges), "edges")
    for _ in range(rounds):
        if settled(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = oriented(large)
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        now = stored(oriented(small), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = now.groupBy("u").agg(F.min("v").alias("component"))
    return found.select(F.col("u").alias("node"), "component").unionByName(
        found.select(F.col("component").alias("node"), "component").distinct()
    )
