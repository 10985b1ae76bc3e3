"""Passages repeated across documents, by relative Lempel-Ziv parsing.

A passage is a window of `WINDOW` consecutive words; every word covered by a window whose words also stand in a row with
a smaller doc_id is removed. Windows are judged on the input, whatever else is removed.

Index. Of the `GRAM`-word hashes inside a window, the least is its anchor: equal windows have equal anchors, and
neighbouring windows mostly share one, so anchors are about a fifth as many as words. Rows are numbered and taken
in blocks of `ROWS`; a block sends each of its anchors once, whatever the number of its rows that hold it. An anchor that
rows of several ids hold is shared; its home is the block of the row with the smallest id.

Factors. A home's reference is its own rows' text under the anchors that it is home to, as a suffix array. Every other
row's text under those anchors is factored greedily against it: the longest match from a place on is a factor, and
the next starts where it ends. Windows inside a factor of at least `WINDOW` words repeat; a window across a factor's end
is looked up by itself, and no other window can be in the reference, since a factor is as long as it can be. A home
with many texts to factor is repeated, and its texts are dealt over the copies.

Remainder. A window whose anchor has its home in a row that does not hold the window (a chance hit of `GRAM` words) is
not found there, in any row that holds it: such windows, a few in a hundred, are grouped by a hash of 128 bits.

Words are compared by 64-bit hashes, a window by all of its words.

Null and empty texts have no words, texts of fewer than `WINDOW` words no window; nothing of them is removed. A long text
is read as a whole by one task. Rows of one doc_id are no repeats of each other; rows without a doc_id come after all
others and are no repeats of each other. Each row gives one row, also where rows repeat; extra columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bvengine.llm.common import lean, numbered, stored

WINDOW, GRAM = 13, 5
#: Rows of a block are 1 << ROWS; words that one copy of a reference is to factor.
ROWS, DEALT = 8, 1 << 18
REFERENCE, TARGET, ALONE = 1, 2, 3

RUNS = "home long, kind int, row long, order long, start long, words binary"
FACTORS = "row long, order long, start long, n long, words binary"
KEPT = "doc_id string, n_words long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept string"


@lru_cache(maxsize=1)
def places(n: int) -> np.ndarray:
    """A random odd number per place in a word."""
    return np.random.default_rng(17).integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hashed(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, one after the other, and the number of words of each text."""
    data = [t.encode() if isinstance(t, str) else b"" for t in texts]
    text = np.frombuffer(b" ".join([*data, b""]), np.uint8)
    blank = (text == 32) | ((text >= 9) & (text <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1 if len(text) else np.zeros(0, int)
    edge = edge if not len(text) or blank[0] else np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]  # the last byte is blank, so every word ends
    size = end - start
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    table = places(1 << max(10, int(size.max(initial=0)).bit_length()))
    value = (text[~blank].astype(np.uint64) + np.uint64(1)) * table[place]
    h = np.add.reduceat(value, np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    ends = np.cumsum([len(x) + 1 for x in data])
    return h.view(np.int64), np.diff(np.searchsorted(start, ends), prepend=0)


@lru_cache
def factors(k: int, seed: int) -> np.ndarray:
    """k random odd numbers."""
    return np.random.default_rng(seed).integers(1, 1 << 62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive words."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for j, c in enumerate(factors(k, seed)):
        h += words.view(np.uint64)[j : j + n] * c
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h.view(np.int64)


def anchors(words: np.ndarray, counts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows inside one text each: the first word's place, the text's number, and the least hash of its grams."""
    size = np.maximum(0, counts - window + 1)
    text = np.repeat(np.arange(len(counts)), size)
    first = np.repeat(np.cumsum(counts) - counts, size) + np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    g = grams(words, gram, 3)
    n = max(0, len(words) - window + 1)
    least = g[:n].copy()
    for j in range(1, window - gram + 1):
        np.minimum(least, g[j : j + n], out=least)
    return first, text, least[first]


def pieces(change: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges between the places where `change` (one value between neighbours) is true."""
    edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(change) + 1]])
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def shared(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Per block and anchor that rows of several ids hold: `least`, the smallest id, and the home's block."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            block = pdf["row"].to_numpy() >> ROWS
            for a, b in pieces(np.diff(block) != 0):
                _, text, found = anchors(*hashed(pdf["text"].iloc[a:b].tolist()), window, gram)
                ids = pdf["order"].to_numpy()[a:b][text]
                by = np.lexsort((ids, found))
                found, ids = found[by], ids[by]
                first = np.flatnonzero(np.diff(found, prepend=found[:1] - 1))
                last = np.append(first[1:], len(found))[: len(first)] - 1
                yield pd.DataFrame({"block": int(block[a]), "anchor": found[first], "low": ids[first], "high": ids[last]})

    found = rows.select("row", "order", "text").mapInPandas(of, "block long, anchor long, low long, high long")
    every = Window.partitionBy("anchor")
    found = found.withColumn("first", F.min(F.struct("low", "block")).over(every)).withColumn("high", F.max("high").over(every))
    return found.where("first.low < high").select("block", "anchor", F.col("first.low").alias("least"), F.col("first.block").alias("home"))


def runs(rows: DataFrame, index: DataFrame, window: int, gram: int) -> DataFrame:
    """Stretches of text (RUNS) under shared anchors: of the home itself (REFERENCE), of rows with larger ids (TARGET),
    and of rows with the home's id in another block (ALONE). Rows and anchors of a block meet by a shuffle."""
    none = F.lit(0).cast("long")  # not null: pandas reads a column of numbers with nulls as floating point
    texts = rows.select(F.shiftright("row", ROWS).alias("block"), F.lit(1).alias("side"), "row", "order", "text", *[none.alias(c) for c in ("anchor", "least", "home")])
    marks = index.select("block", F.lit(0).alias("side"), *[none.alias(c) for c in ("row", "order")], F.lit(None).cast("string").alias("text"), "anchor", "least", "home")
    met = texts.unionByName(marks).repartition("block").sortWithinPartitions("block", "side", "anchor", "row")

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, parts, table = None, [], None
        for pdf in batches:
            if pdf.empty:
                continue
            out = []
            blocks, side = pdf["block"].to_numpy(), pdf["side"].to_numpy()
            for a, b in pieces((np.diff(blocks) != 0) | (np.diff(side) != 0)):
                if blocks[a] != block:
                    block, parts, table = blocks[a], [], None
                if side[a] == 0:
                    parts.append(pdf[["anchor", "least", "home"]].iloc[a:b].to_numpy(np.int64))
                    continue
                if table is None:
                    table = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
                if len(table):
                    out += stretches(int(block), pdf.iloc[a:b], table, window, gram)
            yield pd.DataFrame(out, columns=["home", "kind", "row", "order", "start", "words"])

    return met.mapInPandas(of, RUNS)


def stretches(block: int, texts: pd.DataFrame, table: np.ndarray, window: int, gram: int) -> list[tuple]:
    words, counts = hashed(texts["text"].tolist())
    row, order, offset = texts["row"].to_numpy(), texts["order"].to_numpy(), np.cumsum(counts) - counts
    first, text, least = anchors(words, counts, window, gram)
    if not len(first):
        return []
    at = np.minimum(np.searchsorted(table[:, 0], least), len(table) - 1)
    hit, lowest, home = table[at, 0] == least, table[at, 1], table[at, 2]
    kind = np.where(lowest < order[text], TARGET, np.where(home == block, REFERENCE, ALONE)) * hit
    home = home * hit
    out = []
    for a, b in pieces((np.diff(kind) != 0) | (np.diff(home) != 0) | (np.diff(text) != 0)):
        if kind[a]:
            k = text[a]
            run = words[first[a] : first[b - 1] + window].tobytes()
            out.append((int(home[a]), int(kind[a]), int(row[k]), int(order[k]), int(first[a] - offset[k]), run))
    return out


class Reference:
    """The texts of one home: codes of their words with a 0 between texts, their suffix array and windows."""

    def __init__(self, texts: list[np.ndarray], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate(texts))
        gap = np.zeros(1, np.int64)
        self.codes = np.concatenate([x for t in texts for x in (np.searchsorted(self.vocabulary, t) + 1, gap)])
        self.bytes = self.codes.astype(">u4").tobytes()  # big-endian, so that bytes order as words do
        self.suffixes = suffix_array(self.codes)
        self.order = self.suffixes.tolist()
        of_windows = grams(self.codes, window, 5)
        self.by = np.argsort(of_windows, kind="stable")
        self.hashed = of_windows[self.by]

    def code(self, words: np.ndarray) -> np.ndarray:
        """Codes of a text; words that the reference does not hold have the one past its last."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, len(self.vocabulary) + 1)

    def longest(self, text: bytes, codes: np.ndarray, at: int) -> int:
        """Words of the longest match of the text from `at` on: one of the two suffixes next to it in order has it."""
        rest = text[4 * at :]
        size, ref = len(rest), self.bytes
        i = bisect_left(self.order, rest, key=lambda s: ref[4 * s : 4 * s + size])
        best = 0
        for s in self.order[max(0, i - 1) : i + 1]:
            n = min(len(codes) - at, len(self.codes) - s)
            same = codes[at : at + n] == self.codes[s : s + n]
            first = int(same.argmin()) if n else 0
            best = max(best, n if n and same[first] else first)
        return best

    def held(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which of the windows at `starts` the reference holds, by their words."""
        h = grams(codes, self.window, 5)[starts]
        low, high = np.searchsorted(self.hashed, h), np.searchsorted(self.hashed, h, "right")
        maybe = np.flatnonzero(low < high)
        there = self.by[low[maybe]]
        equal = np.ones(len(maybe), bool)
        for j in range(self.window):
            equal &= codes[starts[maybe] + j] == self.codes[there + j]
        for k in np.flatnonzero(~equal & (high[maybe] - low[maybe] > 1)):  # another window of the same hash
            window = codes[starts[maybe[k]] : starts[maybe[k]] + self.window]
            others = self.by[low[maybe[k]] + 1 : high[maybe[k]]]
            equal[k] = any(np.array_equal(window, self.codes[s : s + self.window]) for s in others)
        out = np.zeros(len(starts), bool)
        out[maybe] = equal
        return out

    def parse(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Per text and window: whether the reference holds it, from the greedy factors."""
        counts = np.array([len(t) for t in texts])
        every = self.code(np.concatenate(texts))
        found, known = np.zeros(len(every), bool), len(self.vocabulary)
        across: list[tuple[int, int]] = []  # starts of windows that a factor's end cuts
        offsets = np.cumsum(counts) - counts
        for offset, count in zip(offsets.tolist(), counts.tolist(), strict=True):
            codes, n = every[offset : offset + count], count - self.window + 1
            text = codes.astype(">u4").tobytes()
            at = 0
            while at < n:
                size = self.longest(text, codes, at) if codes[at] <= known else 0
                inside = max(0, size - self.window + 1)
                found[offset + at : offset + at + inside] = True
                across.append((offset + at + max(1, inside), offset + min(n, at + max(1, size))))
                at += max(1, size)
        low, high = np.array(across).T
        size = np.maximum(0, high - low)
        starts = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        found[starts] = self.held(every, starts)
        return [found[a : a + c - self.window + 1] for a, c in zip(offsets, counts, strict=True)]


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places in order of the text from there on, by doubling the length that is sorted."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    size, n = 1, len(codes)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - size)] = rank[size:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        if not n or steps[-1] == n - 1 or size >= n:
            return order
        size *= 2


def factored(stretch: DataFrame, window: int, dealt: int) -> DataFrame:
    """Rows of FACTORS: per text under a home's anchors, its ranges that repeat (words null), and the words of the
    windows that are not in the reference."""

    def of(group: pd.DataFrame) -> pd.DataFrame:
        columns = ["row", "order", "start", "n", "words"]
        texts = [np.frombuffer(w, np.int64) for w in group.loc[group["kind"] == REFERENCE, "words"]]
        targets = group[group["kind"] == TARGET]
        if not len(targets) or not texts:
            return pd.DataFrame(columns=columns)
        different = list(dict.fromkeys(targets["words"]))  # copies have equal stretches
        parsed = Reference(texts, window).parse([np.frombuffer(w, np.int64) for w in different])
        known, out = dict(zip(different, parsed, strict=True)), []
        for row, order, start, data in targets[["row", "order", "start", "words"]].itertuples(index=False, name=None):
            words, found = np.frombuffer(data, np.int64), known[data]
            for a, b in pieces(np.diff(found) != 0):
                out.append((row, order, start + a, b - a + window - 1, None if found[a] else words[a : b + window - 1].tobytes()))
        return pd.DataFrame(out, columns=columns)

    copies = F.ceil(F.sum(F.length("words")) / (8 * dealt))
    many = stretch.where(F.col("kind") == TARGET).groupBy("home").agg(copies.alias("copies")).where("copies > 1")
    known = stretch.where(F.col("kind") != ALONE).join(many, "home", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("row", "start"), F.col("copies")))
    copy = F.when(F.col("kind") == TARGET, own).otherwise(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    # dealt by both: rows that the join leaves dealt by home alone would serve the groups too, all copies in one task
    return known.withColumn("copy", F.explode(copy)).repartition("home", "copy").groupBy("home", "copy").applyInPandas(of, FACTORS)


def remainder(left: DataFrame, window: int) -> DataFrame:
    """Ranges of the windows (of texts that no reference settles) that a row with a smaller id among them also holds."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = np.frombuffer(b"".join(pdf["words"]), np.int64)
            counts = pdf["words"].map(len).to_numpy(int) // 8
            first, text, _ = anchors(words, counts, window, window)
            yield pd.DataFrame({
                "row": pdf["row"].to_numpy()[text], "order": pdf["order"].to_numpy()[text],
                "start": pdf["start"].to_numpy()[text] + first - (np.cumsum(counts) - counts)[text],
                "h1": grams(words, window, 7)[first], "h2": grams(words, window, 11)[first],
            })

    each = left.select("row", "order", "start", "words").mapInPandas(of, "row long, order long, start long, h1 long, h2 long")
    firsts = each.groupBy("h1", "h2").agg(F.min("order").alias("least"), F.max("order").alias("most")).where("least < most")
    return each.join(firsts, ["h1", "h2"]).where("order > least").select("row", "start", F.lit(window).cast("long").alias("n"))


def spans(ranges: DataFrame) -> DataFrame:
    """Per row: its ranges (row, start, n), those that overlap or touch made one, as an ordered array (start, end)."""
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    r = ranges.select("row", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    r = r.withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    r = r.withColumn("span", F.sum("new").over(Window.partitionBy("row").orderBy("start", "end")))
    r = r.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return r.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, dealt: int = DEALT) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_words, n_removed, spans (ranges of removed words, end exclusive) and kept, the
    words that stay joined by one space."""
    if not 0 < gram <= window:
        raise ValueError("gram must be positive and at most window")
    last = F.lit((1 << 63) - 1)
    rows, number = numbered(docs.select("doc_id", F.col("text").cast("string").alias("text")), "rows")
    rows = rows.withColumnRenamed(number, "row").withColumn("order", F.coalesce(F.col("doc_id").cast("long"), last))
    with lean(docs.sparkSession):
        stretch = stored(runs(rows, shared(rows, window, gram), window, gram), "runs")
        parsed = stored(factored(stretch, window, dealt), "factors")
    left = parsed.where("words is not null").unionByName(
        stretch.where(F.col("kind") == ALONE).select("row", "order", "start", F.lit(0).cast("long").alias("n"), "words")
    )
    ranges = parsed.where("words is null").select("row", "start", "n").unionByName(remainder(left, window))
    met = rows.select("row", F.col("doc_id").cast("string").alias("doc_id"), "text").join(spans(ranges), "row", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, found in zip(pdf["doc_id"], pdf["text"], pdf["spans"], strict=True):
                words = text.encode().split() if isinstance(text, str) else []  # bytes split at these six characters
                found = [(x["start"], x["end"]) for x in found] if found is not None else []
                kept, at = [], 0
                for a, b in found:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                out.append((doc_id, len(words), len(words) - len(kept), found, b" ".join(kept).decode()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "spans", "kept"])

    made = met.select("doc_id", "text", "spans").mapInPandas(cut, KEPT)
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
