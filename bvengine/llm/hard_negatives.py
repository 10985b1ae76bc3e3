"""Hard negatives by walking lists shared by clusters of anchors.

Anchors are clustered by direction. For a cluster with centre c whose members lie within the angle t of it, every
candidate x has |x| cos(max(0, angle(x, c) - t)) as an upper bound on its inner product with any member of unit length.
Each cluster sorts the candidates by that bound once, largest first, and cuts the list into bins; all its members
walk it. A member stops before a bin once the bin's largest bound, times the member's length, is below the score that
a candidate still has to reach: from there on nothing can enter its result, which is then exact.

The list is walked twice: for the positives (the best candidates of the anchor's own label), then, their scores known,
for the negatives of each positive: the best candidates of another label with a score from `low` to `high` hundredths of the
positive's. Each walk has two steps, its first bins and then the bins that a member has not stopped before, so that the
second starts with a score to reach. In a step, a bin is cut into groups of bounded size; a group scores its candidates
against a block of the cluster's members by one matrix product and returns the few that can still enter.

Components are floor(scale * x) and scores are exact integers, computed in double precision where all sums stay below
2^53 and in Python's integers elsewhere; a score that is no 64-bit integer is an error.

Rows whose id, label or vector is null, or whose vector holds a null or non-finite component, take no part; vectors of
different length have no score with each other; empty and zero vectors score 0. Each row is a row of its own, also
where ids repeat: ties go to the smaller id, then the row read first. Extra columns are not read. Without anchors or rows
there is no result. The centres are fitted on a sample of at most `SAMPLE` anchors, and there are at most `CLUSTERS` of
them per length of vectors; both only shape the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bvengine.llm.common import numbered, stored

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
#: Anchors aimed at per cluster, clusters at most, anchors that centres are fitted on; candidates a bin, bins at most, and
#: the share of bins in a walk's first step; members and candidates of a group.
CLUSTER, CLUSTERS, SAMPLE = 64, 256, 8192
BIN, BINS, FIRST = 2048, 256, 16
MEMBERS, CANDIDATES = 1024, 4096
#: Slack for rounding in the bounds, in radians and relative to a candidate's length.
ANGLE, SLACK = 1e-6, 1e-9

PLACED = "cluster long, angle double, row long, vec_id long, label long, norm double, vector binary"
LISTED = "cluster long, bound double, row long, vec_id long, label long, vector binary"
FOUND = "anchor long, slot int, row long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    v = vectors.where("vec_id is not null and label is not null and embedding is not null")
    return v.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def floored(v, scale: float) -> np.ndarray:
    return np.floor(scale * np.asarray(v, float))


def matrix(data) -> np.ndarray:
    return np.frombuffer(b"".join(data)).reshape(len(data), -1) if len(data) and len(next(iter(data))) else np.zeros((len(data), 0))


def units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of rows and the rows at unit length; zero rows stay."""
    norm = np.sqrt(np.square(v).sum(axis=1))
    return norm, v / np.where(norm, norm, 1)[:, None]


def centres(anchors: DataFrame, cluster: int) -> dict[int, tuple[int, np.ndarray]]:
    """Length of vectors -> (number of its first cluster, centres), by spherical k-means on a bounded sample."""
    sizes = dict(anchors.groupBy("dim").count().collect())  # a row per length of vectors
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("dim", "vector").collect()
    out, at = {}, 0
    for dim in sorted(sizes):
        x = units(matrix([d for n, d in sample if n == dim] or [np.zeros(dim).tobytes()]))[1]
        c = x[: max(1, min(CLUSTERS, len(x), -(-sizes[dim] // cluster)))]
        for _ in range(12):
            near = (x @ c.T).argmax(axis=1)
            c = np.stack([units(x[near == k].sum(axis=0, keepdims=True))[1][0] if (near == k).any() else c[k] for k in range(len(c))])
        out[dim] = (at, c)
        at += len(c)
    return out


def angles(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of rows, and the angle of each row with each centre (0 for rows without a direction)."""
    norm, unit = units(v)
    return norm, np.where(norm[:, None] > 0, np.arccos(np.clip(unit @ c.T, -1, 1)), 0)


def place(anchors: DataFrame, by: dict) -> DataFrame:
    """Anchors with their cluster (PLACED)."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, g in pdf.groupby("dim"):
                first, c = by[dim]
                norm, angle = angles(matrix(g["vector"]), c)
                near = angle.argmin(axis=1)
                yield g.assign(cluster=first + near, angle=angle[np.arange(len(g)), near], norm=norm)[["cluster", "angle", "row", "vec_id", "label", "norm", "vector"]]

    return anchors.mapInPandas(of, PLACED)


def lists(rows: DataFrame, by: dict, reach: dict[int, float]) -> DataFrame:
    """Every candidate with its bound, once per cluster (LISTED). `reach` is the largest angle of a cluster's members."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, g in pdf.groupby("dim"):
                if dim not in by:
                    continue
                first, c = by[dim]
                norm, angle = angles(matrix(g["vector"]), c)
                for k in range(len(c)):
                    if first + k in reach:
                        bound = norm * (np.cos(np.maximum(0, angle[:, k] - reach[first + k] - ANGLE)) + SLACK)
                        yield g.assign(cluster=first + k, bound=bound)[["cluster", "bound", "row", "vec_id", "label", "vector"]]

    return rows.mapInPandas(of, LISTED)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows that hold integers."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return (whole(a) @ whole(b).T).astype(np.int64)


def best(score: np.ndarray, allowed: np.ndarray, low: int, high: int, n: int) -> np.ndarray:
    """Places of the n best allowed scores from low to high; earlier places first among equals."""
    at = np.flatnonzero(allowed & (score >= low) & (score <= high))
    if len(at) > n:
        least = np.partition(score[at], len(at) - n)[len(at) - n]
        at = at[score[at] >= least]
    return at[np.argsort(-score[at], kind="stable")][:n]


def walked(members: DataFrame, listed: DataFrame, bins: DataFrame, low: int, high: int, same: bool) -> DataFrame:
    """One step of a walk over the bins from `low` up to `high` (not included): FOUND, the candidates that can enter.

    Members have arrays `least` and `most` of scores per slot; a slot takes the best `take` candidates within them. The
    member reads the bins whose bound reaches the smallest `least`."""
    step = bins.where((F.col("bin") >= low) & (F.col("bin") < high))
    open_ = members.where(F.exists(F.arrays_zip("least", "most"), lambda x: x["least"] <= x["most"]))
    need = F.array_min(F.transform(F.filter(F.arrays_zip("least", "most"), lambda x: x["least"] <= x["most"]), lambda x: x["least"]))
    many = open_.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("blocks"))
    open_ = open_.join(many, "cluster").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))).withColumn("need", need.cast("double"))
    reads = open_.join(step, "cluster").where(F.col("norm") * F.col("bound") >= F.col("need") - F.abs("need") * SLACK)
    groups = reads.select("cluster", "block", "bin", "parts").distinct()
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    left = reads.withColumn("part", parts)
    right = listed.join(groups, ["cluster", "bin"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    columns = ["row", "vec_id", "label", "vector"]
    none = F.lit(None).cast("array<long>")
    both = left.select("cluster", "block", "bin", "part", F.lit(True).alias("member"), *columns, "least", "most", "take").unionByName(
        right.select("cluster", "block", "bin", "part", F.lit(False).alias("member"), *columns, none.alias("least"), none.alias("most"), F.lit(0).alias("take"))
    )

    def of(group: pd.DataFrame) -> pd.DataFrame:
        members = group[group["member"]]
        others = group[~group["member"]].sort_values(["vec_id", "row"])
        out: list[tuple] = []
        if len(members) and len(others):
            label, row, ids = (others[c].to_numpy(np.int64) for c in ("label", "row", "vec_id"))
            b = matrix(others["vector"])
            for i in range(0, len(members), 64):
                part = members.iloc[i : i + 64]
                s = scores(matrix(part["vector"]), b)
                for x, (anchor, own, least, most, take) in zip(s, part[["row", "label", "least", "most", "take"]].itertuples(index=False, name=None), strict=True):
                    allowed = (label == own) & (row != anchor) if same else label != own
                    for slot, (lo, hi) in enumerate(zip(least, most, strict=True)):
                        out += [(anchor, slot, row[k], ids[k], x[k]) for k in (best(x, allowed, lo, hi, take) if lo <= hi else ())]
        return pd.DataFrame(out, columns=["anchor", "slot", "row", "vec_id", "score"])

    return both.groupBy("cluster", "block", "bin", "part").applyInPandas(of, FOUND)


def top(found: DataFrame, n: int) -> DataFrame:
    """The n best per anchor and slot, numbered from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def walk(members: DataFrame, listed: DataFrame, bins: DataFrame, n: int, same: bool, name: str) -> DataFrame:
    """The n best per anchor and slot over the whole list, numbered from 1."""
    count = bins.agg(F.max("bin")).first()[0] + 1
    first = -(-count // FIRST)
    members = members.withColumn("take", F.lit(n))
    found = stored(top(walked(members, listed, bins, 0, first, same), n), f"{name}-first")
    if first == count:
        return found
    # a slot with n candidates takes no worse score any more
    reached = found.where(F.col("rank") == n).groupBy(F.col("anchor").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reached"))
    later = members.join(reached, "row", "left").withColumn(
        "least", F.transform("least", lambda x, i: F.greatest(x, F.coalesce(F.element_at("reached", i), x)))
    )
    more = walked(later.drop("reached"), listed, bins, first, count, same)
    return stored(top(found.drop("rank").unionByName(more), n), name)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: float = SCALE, cluster: int = CLUSTER, size: int = BIN,
) -> DataFrame:
    """Per anchor (rows of (vec_id, embedding, label) for which `anchors` holds), positive and negative: anchor_id,
    positive_id, rank, negative_id, positive_score and negative_score."""
    if min(positives, negatives, cluster, size) < 1:
        raise ValueError("positives, negatives, cluster and size must be positive")
    chosen = usable(vectors).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = [floored(v, scale).tobytes() for v in pdf.pop("vec")]
            yield pdf.assign(dim=[len(x) // 8 for x in data], vector=data)

    made = chosen.mapInPandas(whole, "vec_id long, label long, anchor boolean, dim int, vector binary")
    rows, number = numbered(made, "vectors")
    rows = rows.withColumnRenamed(number, "row")
    picked = rows.where("anchor")
    by = centres(picked, cluster)
    members = stored(place(picked, by), "anchors")
    reach = dict(members.groupBy("cluster").agg(F.max("angle")).collect())  # a row per cluster
    entries = lists(rows, by, reach)
    # every cluster's list is cut at quantiles of its bounds, as many as its length calls for
    count = max(1, min(BINS, -(-rows.count() // size)))
    cuts = entries.groupBy("cluster").agg(F.percentile_approx("bound", [i / count for i in range(count - 1, 0, -1)] or [0.0], 10 * BINS).alias("cuts"))
    cuts = {c: np.array(x[: count - 1], float) for c, x in cuts.collect()}  # a bounded row per cluster

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, g in pdf.groupby("cluster"):
                yield g.assign(bin=len(cuts[c]) - np.searchsorted(cuts[c][::-1], g["bound"].to_numpy(), "right"))

    binned = entries.mapInPandas(cut, LISTED + ", bin int")
    listed = stored(binned.repartition("cluster", "bin").sortWithinPartitions("cluster", "bin", F.desc("bound")), "lists")
    bins = stored(listed.groupBy("cluster", "bin").agg(F.max("bound").alias("bound"), F.ceil(F.count(F.lit(1)) / CANDIDATES).alias("parts")), "bins")
    if not bins.head(1):
        return rows.sparkSession.createDataFrame([], OUT)
    every = F.array(F.lit(-(1 << 63)).cast("long")), F.array(F.lit((1 << 63) - 1).cast("long"))
    near = walk(members.withColumns({"least": every[0], "most": every[1]}), listed, bins, positives, True, "positives")
    # the scores asked of the negatives of each positive; whole numbers, so the bounds are rounded inwards
    ps = F.col("score").cast("decimal(38,0)")
    slots = near.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", F.ceil(ps * low / 100).cast("long").alias("least"), F.floor(ps * high / 100).cast("long").alias("most")))).alias("w")
    )
    asked = members.join(slots, "row").select(*members.columns, F.col("w.least").alias("least"), F.col("w.most").alias("most"))
    far = walk(asked, listed, bins, negatives, False, "negatives")
    near = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = members.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    far = far.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["anchor", "slot"]).join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
