"""Near-duplicate embeddings by an exact metric range join.

Cosine >= t between unit vectors is Euclidean distance <= r = sqrt(2 - 2t). Per label, sampled vectors serve as
pivots; each vector's home is the cell of its nearest pivot. A vector is also sent to every cell in which a vector
within r of it could have its home: by the triangle inequality a neighbour u of v with home q has
d(u, q) <= d(u, p) for v's home p, so d(v, q) <= d(v, p) + 2r, and likewise v lies within r of the bisector of p and q,
(d(v, q)^2 - d(v, p)^2) / (2 d(p, q)) <= r. Every link of a vector is then seen in its home cell, exactly once, and
cells join independently of each other. Cells are cut into blocks, and each pair of blocks is one group of bounded
size, compared by one matrix product in double precision. A group returns counts per vector and a star forest of
its links, never the pairs, so a dense cell gives output in proportion to its vectors.

Equal vectors with equal labels are collapsed first and counted with their numbers, so copies cost nothing.

Vectors that are null, empty or zero, or hold null or non-finite components, and vectors without a label, link with
nothing; vectors of different length do not link. Each row is a vector of its own, also where ids repeat or are
null; a component is named by its smallest id that is not null. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bvengine.llm.common import components, stored

#: Vectors per cell aimed at; pivots in all, whatever the input (a bounded sample, sent to all tasks); rows of a block.
CELL, MAX_PIVOTS, BLOCK = 2000, 4096, 1024
#: Slack for rounding in the bounds; links themselves are decided on the exact cosine.
SLACK = 1e-9

CELLS = "label long, cell long, home boolean, node long, size long, vector binary"


def valid(vectors: DataFrame) -> DataFrame:
    """Distinct vectors that can link: node, label, vector, size (rows that hold it)."""
    v = vectors.where("label is not null and vec is not null")
    v = v.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    v = v.where(F.exists("vec", lambda x: x != 0))
    return v.groupBy("label", "vec").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("size"))


def pivots_of(distinct: DataFrame, total: int, cell: int, most: int) -> dict:
    """Label -> matrix of unit pivots, from a sample by hash of bounded expected and certain size."""
    rate = min(1.0 / cell, most / max(total, 1))
    u = F.xxhash64("label", "vec", F.lit(7)).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / float(1 << 52)
    rows = distinct.withColumn("u", u).where(F.col("u") < rate).orderBy("u").limit(most).select("label", "vec").collect()
    by: dict = {}
    for label, vec in rows:
        by.setdefault((label, len(vec)), []).append(np.asarray(vec, float))
    return {k: (m := scale(np.array(vs))) / np.linalg.norm(m, axis=1, keepdims=True) for k, vs in by.items()}


def assign(distinct: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """One row (CELLS) per vector and cell: home, and the replicas that the bounds call for."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            for (label, dim), g in pdf.groupby(["label", pdf["vec"].map(len)], sort=False):
                raw = np.vstack([np.asarray(v, float) for v in g["vec"]])
                data = [v.tobytes() for v in raw]
                p = pivots.get((label, dim))
                if p is None or len(p) == 1:
                    yield pd.DataFrame({"label": label, "cell": dim, "home": True, "node": g["node"].values, "size": g["size"].values, "vector": data})
                    continue
                scaled = scale(raw)
                unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                d2 = np.maximum(2 - 2 * unit @ p.T, 0)
                near = d2.argmin(axis=1)
                own = d2[np.arange(len(raw)), near]
                apart = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[near]
                gap = np.sqrt(d2) <= np.sqrt(own)[:, None] + 2 * radius + SLACK
                side = d2 - own[:, None] <= 2 * apart * radius + SLACK
                side |= apart < 1e-6  # equal pivots have no bisector
                hit = gap & side
                hit[np.arange(len(raw)), near] = True
                i, j = np.nonzero(hit)
                # cells of one label and length are numbered apart from those of other lengths
                yield pd.DataFrame({
                    "label": label, "cell": dim + (1 + j) * (1 << 24), "home": j == near[i], "node": g["node"].values[i],
                    "size": g["size"].values[i], "vector": [data[k] for k in i],
                })

    return distinct.mapInPandas(cells, CELLS)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the edges (a[i], b[i])."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = np.minimum(new, new[new])
        if np.array_equal(new, low):
            return low
        low = new


def scale(a: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; cosines are unchanged."""
    return np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, keepdims=True))[1])


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold. Cosines within rounding of it are computed again with exact sums, so that
    both orders of a pair agree."""
    c = (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])
    out = c >= threshold
    for i, j in zip(*np.nonzero(np.abs(c - threshold) < 1e-13), strict=True):
        x, y = a[i], b[j]
        out[i, j] = math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= threshold
    return out


def compare(threshold: float):
    def of(group: pd.DataFrame) -> pd.DataFrame:
        """Per home vector its linked rows (n) in this pair of blocks, and links of a spanning star forest."""
        home, other = group[group["left"]], group[~group["left"]]
        out = pd.DataFrame({"node": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        if home.empty or other.empty:
            return out
        a = np.vstack([np.frombuffer(x) for x in home["vector"]])
        b = np.vstack([np.frombuffer(x) for x in other["vector"]])
        u, v = home["node"].to_numpy(), other["node"].to_numpy()
        link = linked(scale(a), scale(b), threshold) & (u[:, None] != v[None, :])
        n = link @ other["size"].to_numpy()
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        i, j = np.nonzero(link)
        low = roots(len(nodes), index[i], index[len(u) + j])
        counts = pd.DataFrame({"node": u, "n": n, "root": u})
        stars = pd.DataFrame({"node": nodes, "n": 0, "root": nodes[low]})
        both = pd.concat([counts[counts["n"] > 0], stars[stars["node"] != stars["root"]]])
        return both if len(both) else out

    return of


def link(vectors: DataFrame, threshold: float = 0.98, cell: int = CELL, most: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """Per row of (vec_id, embedding, label): n_links, component_id and kept."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    radius = math.sqrt(2 - 2 * threshold)
    rows = stored(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("vec"),
        ),
        "vectors",
    )
    distinct = stored(valid(rows), "distinct")
    placed = stored(assign(distinct, pivots_of(distinct, distinct.count(), cell, most), radius), "cells")
    group = ["label", "cell"]
    # rows of a cell are dealt to blocks by hash; the table of block numbers has a row per pivot, and one per label without
    blocks = placed.groupBy(*group).agg(F.ceil(F.count_if("home") / block).alias("hb"), F.ceil(F.count(F.lit(1)) / block).alias("mb"))
    placed = placed.join(blocks, group).where("hb > 0")
    deal = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    homes = placed.where("home").withColumn("h", deal("hb", 1)).withColumn("m", every("mb")).withColumn("left", F.lit(True))
    members = placed.withColumn("m", deal("mb", 2)).withColumn("h", every("hb")).withColumn("left", F.lit(False))
    pairs = homes.unionByName(members).select(*group, "h", "m", "left", "node", "size", "vector")
    found = stored(pairs.groupBy(*group, "h", "m").applyInPandas(compare(threshold), "node long, n long, root long"), "links")
    reached = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    per_node = distinct.join(counts, "node", "left").join(reached, "node", "left").select(
        "label", "vec", "size", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component")
    )
    joined = rows.join(per_node, ["label", "vec"], "left").select(
        "row", "vec_id", F.coalesce(F.col("n") + F.col("size") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "row").alias("component"),
    )
    joined = stored(joined, "linked")
    least = joined.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return joined.join(least, "component").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    )
