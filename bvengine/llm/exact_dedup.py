"""Exact duplicates by content-defined chunk recipes.

Every text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space) and cut where a hash of the last
eight bytes falls below a bound, so equal passages are cut alike wherever they stand. A document's recipe is the
ordered list of its chunks' 64-bit fingerprints with their SHA-256 digests; texts are read once and never moved.

Chunks are then deduplicated to verified identifiers: an identifier is (fingerprint, ordinal), where the ordinal
counts the different digests that share a fingerprint (0 unless fingerprints collide). Documents are equal when
their ordered identifier lists are equal; the lists, not hashes of them, are compared.

Null text counts as empty; empty texts equal each other and texts of no chunk at all. Of equal rows the one with
the smallest doc_id stays (null ids come last); rows with the same doc_id and text are all marked alike. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bvengine.llm.common import numbered, stored

#: A lone space is left alone by the pattern, since it would be replaced by itself.
BLANKS = re.compile(r"[\t-\r][ \t-\r]*| [ \t-\r]+")
MEAN, LEAST, MOST = 4096, 1024, 16384


def normalise(text: str | None) -> str:
    return BLANKS.sub(" ", text) if text else ""


def cuts(data: bytes, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of `data`: content-defined, from `least` to `most` bytes apart (the last may be shorter)."""
    import numpy as np

    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    places = []
    block = 1 << 20
    for start in range(0, n - 8, block):  # blocks overlap by the window, so that memory stays bounded
        part = np.ascontiguousarray(raw[start : start + block + 7])
        words = np.lib.stride_tricks.sliding_window_view(part, 8).copy().view("<u8").ravel()
        hits = np.flatnonzero(words * np.uint64(0x9E3779B97F4A7C15) < np.uint64((1 << 64) // mean))
        places.append(hits[hits < block] + start + 8)
    out, last = [], 0
    for p in map(int, np.concatenate(places)):
        while p - last > most:
            last += most
            out.append(last)
        if p - last >= least:
            out.append(last := p)
    while n - last > most:
        out.append(last := last + most)
    return [*out, n] if n > last else out


def recipes(docs: DataFrame, number: str | None = None) -> DataFrame:
    """Per row of (doc_id, text): text_sha256 of the normalised text, and the recipe as array of (fp, digest); with
    `number`, a column of stored row numbers, also that as row."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for pdf in batches:
            out = []
            for doc_id, text, *row in pdf.itertuples(index=False, name=None):
                data = normalise(text).encode()
                recipe, start = [], 0
                for end in cuts(data):
                    chunk = data[start:end]
                    fp = xxhash.xxh3_64_intdigest(chunk)
                    recipe.append({"fp": fp - (1 << 64 if fp >> 63 else 0), "digest": hashlib.sha256(chunk).digest()})
                    start = end
                out.append((doc_id, hashlib.sha256(data).hexdigest(), recipe, *row))
            yield pd.DataFrame(out, columns=["doc_id", "text_sha256", "recipe"] + ["row"] * bool(number))

    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text"), *([F.col(number).alias("row")] if number else []))
    made = rows.mapInPandas(
        cut, "doc_id string, text_sha256 string, recipe array<struct<fp:long,digest:binary>>" + (", row long" if number else "")
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def clashes(made: DataFrame) -> DataFrame:
    """(fp, digest, ordinal) of the digests that share their fingerprint with a smaller one; none as a rule."""
    chunks = made.select(F.explode("recipe").alias("c")).select("c.fp", "c.digest").distinct()
    digests = chunks.groupBy("fp").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    several = chunks.join(digests.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.array_sort(F.collect_set("digest")).alias("d"))
    return several.select("fp", F.posexplode("d").alias("ordinal", "digest")).where("ordinal > 0")


def identify(made: DataFrame) -> DataFrame:
    """`made` with its row and the recipe as `ids`: array of (fp, ordinal), equal only for equal chunks."""
    if "row" not in made.columns:
        made = made.withColumn("row", F.monotonically_increasing_id())
    plain = F.transform("recipe", lambda c: F.struct(c["fp"].alias("fp"), F.lit(0).alias("ordinal")))
    hit = made.select("row", F.posexplode("recipe").alias("pos", "c")).select("row", "pos", "c.fp", "c.digest")
    fixes = (
        hit.join(clashes(made), ["fp", "digest"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "ordinal"))).alias("fix"))
    )
    mended = F.transform(
        plain, lambda c, i: F.struct(c["fp"].alias("fp"), F.coalesce(F.try_element_at("fix", i), F.lit(0)).alias("ordinal"))
    )
    return made.join(fixes, "row", "left").select("row", "doc_id", "text_sha256", F.when(F.col("fix").isNull(), plain).otherwise(mended).alias("ids"))


def groups(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): keep_id, group_size, kept and text_sha256.

    The recipes are written once; equal lists meet by a partial aggregation and come back by an equi-join, whose
    large partitions Spark splits, so a group may hold any share of the rows.
    """
    made = stored(recipes(docs), "recipes")
    rows = identify(made)
    same = rows.groupBy("ids").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(same, "ids").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, keep_null_ids: bool = True) -> DataFrame:
    """`docs` without the rows whose text equals that of a row with a smaller doc_id, or of an earlier row with the
    same one. Rows are told apart by a stored number, not by id. Rows with a null id all stay, or, without
    `keep_null_ids`, come last: the first of them stays where no copy has an id."""
    docs, number = numbered(docs, "numbered")
    rows = identify(stored(recipes(docs, number), "recipes"))
    first = rows.groupBy("ids").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row").alias(number)).select(number)
    if keep_null_ids:
        first = first.unionByName(docs.where("doc_id is null").select(number))
    return docs.join(first.hint("merge"), number, "left_semi").drop(number)  # alike at every size: never a broadcast
