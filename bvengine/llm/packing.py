"""Sequence packing along a space-filling curve.

Each document's token ids are hashed into a vector of `FEATURES` buckets (log counts, signs by hash, unit length),
projected onto `DIMS` fixed random directions and quantised to `BITS` bits each; the Hilbert curve through that
grid turns the point into one key, so documents near each other on the curve have similar vectors. Documents are
range-sorted by the key, and the ids, each document's followed by the end id, form one stream in that order, cut
every `length` ids: a document's place in the stream gives sequences and offsets of its pieces. Only the last
sequence is not full; it is padded up to the next power of two.

The stream is never gathered. Ids are written once; keys and counts alone are range-sorted; each sorted partition
gives running counts, and one count per partition, summed by the driver (as many numbers as partitions), places
the partitions. Places are joined back to the ids by row.

Null text counts as empty: such a document is the end id alone. Very long documents give as many pieces as they
need. Repeated rows are packed each. Extra columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bvengine.llm.common import stored

LENGTH, END = 1024, 0
FEATURES, DIMS, BITS = 256, 4, 12
OTHER_SPACE = re.compile(r"[^\S \n]")
#: The same characters one by one: looking for each is faster than the pattern.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
ASCII_SPACES = [c for c in OTHER_SPACES if c.isascii()]
#: The merging library's pattern fails on runs of a million blanks or line ends.
LONG_SPACE = 100_000
LONG_RUN = re.compile(r"[ \n]{%d}" % LONG_SPACE)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def added(path: str) -> tuple[str, ...]:
    return tuple(x.content for x in tokenizer(path).get_added_tokens_decoder().values())


@lru_cache(maxsize=1)
def directions() -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((FEATURES, DIMS))


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the other
    bytes, in order, for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of the tokenizer's file as bytes. Its special tokens, which have no merges, are left out."""
    to_byte, special = byte_of(), added(path)
    return {bytes(map(to_byte.__getitem__, word)): i for word, i in tokenizer(path).get_vocab().items() if word not in special}


@lru_cache(maxsize=2)
def merger(path: str):
    """The vocabulary of the tokenizer's file for the faster merging library; ids are the file's."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def encode(path: str, texts: list[str], kind: str) -> list[bytes]:
    """Ids of each text as the tokenizer gives them. Letters, digits, punctuation and plain white space are classed
    alike by both libraries; a text with other white space, a long run of it, or the string of an added token goes through the tokenizer itself."""
    fast, special = merger(path), added(path)
    return [
        np.array(tokenizer(path).encode(t, add_special_tokens=False).ids, kind).tobytes()
        if has_other_space(t) or any(x in t for x in special) or len(t) >= LONG_SPACE and LONG_RUN.search(t)
        else np.array(fast.encode_ordinary(t), kind).tobytes()
        for t in texts
    ]


def has_other_space(text: str) -> bool:
    """Whether the text holds white space other than blanks and line ends."""
    return any(c in text for c in (ASCII_SPACES if text.isascii() else OTHER_SPACES))


def vectors(ids: list[np.ndarray]) -> np.ndarray:
    """A point in DIMS dimensions per document."""
    every = np.concatenate([*ids, np.zeros(0, np.uint16)]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row = np.repeat(np.arange(len(ids)) * FEATURES, [len(i) for i in ids])
    place = row + (every >> np.uint64(56)).astype(np.intp)
    sign = 1.0 - 2.0 * (((every >> np.uint64(55)) & np.uint64(1)) == 0)
    v = np.bincount(place, sign, len(ids) * FEATURES).reshape(len(ids), FEATURES)
    v = np.sign(v) * np.log1p(np.abs(v))
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm, norm, 1) @ directions()


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with `bits`-bit unsigned coordinates, one row a point.

    The coordinates are turned into the transposed form of the index by undoing, from the top bit down, the
    exchanges and inversions that the curve makes in each sub-cube, then Gray-decoded and interleaved."""
    x = points.astype(np.uint64).copy()
    n = x.shape[1]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(n):
            on = (x[:, i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        turn ^= np.where((x[:, n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= turn[:, None]
    key = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[:, i] >> np.uint64(b)) & one)
    return key


def keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key per document; coordinates are squeezed into (0, 1) before they are quantised."""
    z = 1 / (1 + np.exp(-4 * vectors(ids)))
    return hilbert(np.minimum(z * (1 << BITS), (1 << BITS) - 1).astype(np.uint64))


def tokens(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Per row of (doc_id, text): its ids with the end id (16 bits each where the vocabulary allows), n and key."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"
        last = np.array([end], kind).tobytes()
        for pdf in batches:
            for start in range(0, len(pdf), 64):
                part = pdf.iloc[start : start + 64]
                data = encode(path, [x if isinstance(x, str) else "" for x in part["text"]], kind)
                ids = [np.frombuffer(x, kind) for x in data]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].values, "n": [len(i) + 1 for i in ids], "key": keys(ids).astype(np.int64),
                    "width": int(kind[2]), "ids": [x + last for x in data],
                })

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(of, "doc_id string, n long, key long, width int, ids binary").withColumn("row", F.monotonically_increasing_id())


def places(rows: DataFrame) -> DataFrame:
    """Per row (row, n, key): start, its place in the stream. Narrow rows are range-sorted and written with their
    running count inside the partition; the partitions' totals give the rest."""

    def running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = 0
        for pdf in batches:
            ends = at + pdf["n"].cumsum()
            yield pd.DataFrame({"row": pdf["row"], "part": pdf["part"], "inside": ends - pdf["n"], "n": pdf["n"]})
            at = int(ends.iloc[-1]) if len(ends) else at

    ordered = rows.select("row", "n", "key").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    inside = stored(
        ordered.withColumn("part", F.spark_partition_id()).mapInPandas(running, "row long, part int, inside long, n long"), "places"
    )
    totals = inside.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row a partition
    base, at = [], 0
    for part, n in totals:
        base.append((part, at))
        at += n
    bases = rows.sparkSession.createDataFrame(base, "part int, base long")
    return inside.join(F.broadcast(bases), "part").select("row", (F.col("base") + F.col("inside")).alias("start"), F.lit(at).cast("long").alias("total"))


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece of a row of (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    padded, the size its sequence is padded to. `path` names the tokenizer's file."""
    if length < 1:
        raise ValueError("length must be positive")
    rows = stored(tokens(docs, path, end), "tokens")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"]
        for pdf in batches:
            out = []
            for doc_id, n, width, data, place, total in pdf.itertuples(index=False, name=None):
                ids = np.frombuffer(data, f"<u{width}").astype("<u4")
                last, rest = divmod(total, length)
                at = 0
                while at < n:
                    sequence, offset = divmod(place + at, length)
                    size = min(n - at, length - offset)
                    full = length if sequence < last else min(length, 1 << math.ceil(math.log2(rest)))
                    out.append((doc_id, at, size, zlib.crc32(ids[at : at + size].tobytes()), n, sequence, offset, full))
                    at += size
            yield pd.DataFrame(out, columns=columns)

    joined = rows.join(places(rows), "row").select("doc_id", "n", "width", "ids", "start", "total")
    made = joined.mapInPandas(
        cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded int"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
