"""Near-duplicate documents by Order MinHash.

A document is its sequence of k-mers of K = 5 words (lower-cased runs of letters and digits), each labelled with
how often it has occurred before in the document, so that all are distinct. For each of BANDS hash functions the
PICKS labelled k-mers of smallest hash are taken and kept in text order; the hash of that sequence is the band's
bucket key. Documents that share a bucket are candidates: order and repetition count, as in edit similarity.

Candidates are verified by banded alignment of the labelled k-mers: the longest common subsequence L of both, in
the band of diagonals that the threshold leaves (|i - j| <= n + m - 2L at the least L), gives the similarity
L / (n + m - L), a Jaccard coefficient that respects order. Pairs of `threshold` = 0.8 or more are linked. A pair
that shares I of U k-mers shares a band with the chance C(I, 7) / C(U, 7), so few k-mers make bands a poor search.
Every class has its band keys, and besides them pairs with a document of at most `threshold` * SHORT = 60 k-mers are
searched exactly, by a prefix filter: the k-mers of every class of at most SHORT are ordered by one order that all
classes share, those that many classes hold last, and the first n - ceil(threshold * n) + 1 of them are bucket keys
too. Two classes that reach the threshold share such a key, whatever the order. Above 60 k-mers the bands miss a pair
of similarity 0.8 with a probability of 0.0025 at most (long texts 0.0014), one of 0.85 with 0.00004 at most.

No bucket gives all its pairs. Documents of equal word sequences are one class. In each bucket the classes are
first compared with one head, the class whose buckets are largest (the centre of a family of copies): in round one
each class with the head of its largest family, in round two with the heads of all its buckets that it is not yet
connected with. Links between classes that are connected need no check, since the result is the connected
components. What is left, pairs of classes that share a bucket in different components, is compared pair by pair,
but for those that an exact bound excludes. A class's k-mers are dealt by hash over about as many bins, and a bin
holds the exclusive or of their one-byte hashes: where two classes differ in D bins, at least D of their n + m
k-mers are unmatched, so L <= (n + m - D) / 2. Buckets are compared in blocks of bounded size.

Texts without words (null, empty, only punctuation) are each a group of their own, as they have nothing to
compare. Documents of fewer than K words are one k-mer. Rows that repeat an id are separate rows of one class or
more; the class id is the smallest doc_id of the group that is not null. Texts of any length are read whole, a few
bands at a time. Labelled k-mers of a text are distinct and a band's hash is a bijection, so its minima have no ties;
where two heads are equally good either serves, and the components are the same. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bvengine.llm.common import components, numbered, stored

K, THRESHOLD = 5, 0.8
BANDS, PICKS = 28, 7
WORD = re.compile(r"[^\W_]+")
#: Classes of at most so many k-mers have prefix keys. COMMON k-mers at most, of those in OFTEN short classes or more,
#: come last in their order, by their counts; that bounds the buckets and decides no result.
SHORT, COMMON, OFTEN = 75, 1 << 14, 16
#: Elements of the hash matrix of one pass: longer documents take the bands a few at a time.
MATRIX = 1 << 21
#: Bins of the bound at most, and rows of a block of an open bucket.
MOST_BINS, BLOCK = 4096, 1024


class Words(dict):
    """Hashes of words, remembered while the table stays small."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little")
        self[word] = h
        return h


def words_of(text: str | None, table: Words) -> np.ndarray:
    """Word hashes of a text, as unsigned 32-bit integers."""
    found = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(table.__getitem__, found), np.uint32, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """Occurrence-labelled k-mers of a word sequence, in order, as distinct 64-bit hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    w = words.astype(np.uint64)
    n = max(1, len(w) - k + 1)
    h = np.full(n, min(len(w), k), np.uint64)
    for i in range(min(k, len(w))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    if not new.all():
        at = np.arange(n)
        seen = np.empty(n, np.uint64)
        seen[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        h = mix(h + seen * np.uint64(0xD1B54A32D192ED03))
    return h


def sketch(h: np.ndarray, bands: int = BANDS, picks: int = PICKS) -> np.ndarray:
    """A bucket key per band: the hash of the band's smallest k-mers in text order."""
    seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    take = min(picks, len(h))
    rows = max(1, MATRIX // len(h))
    out = []
    for start in range(0, bands, rows):
        s = seeds[start : start + rows]
        x = (h[None, :] ^ s[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        at = np.sort(np.argpartition(x, take - 1, axis=1)[:, :take], axis=1)
        key = s.copy()
        for i in range(take):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + h[at[:, i]])
        out.append(key)
    return np.concatenate(out)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """L / (n + m - L) for the longest common subsequence of two sequences of distinct k-mers within the band;
    0 where it cannot reach the threshold."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < threshold * max(n, m):
        return 0.0
    need = threshold * (n + m) / (1 + threshold)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = np.abs(i - j) <= n + m - 2 * need + 1e-9
    i, j = i[band], j[band]
    if len(i) < need - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        common = len(j)
    else:  # the longest increasing run of matches
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        common = len(tails)
    return common / (n + m - common)


def prefix(h: np.ndarray, common: np.ndarray, counts: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The bucket keys of a short class: its first k-mers in the order by count among `common` (sorted; 0 elsewhere),
    then hash. One more than may be missing from a class that reaches the threshold with it."""
    count = np.zeros(len(h), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        count = np.where(common[at] == h, counts[at], 0)
    x = mix(h ^ np.uint64(0x8CB92BA72F3D8DD7))
    return x[np.lexsort((x, count))[: len(h) - int(np.ceil(threshold * len(h) - 1e-9)) + 1]]


def sequences(docs: DataFrame, bands: int, picks: int, number: str | None = None) -> DataFrame:
    """Per row of (doc_id, text): row, digest of the word sequence (null without words), words, keys of the bands
    and grams, the k-mers of short texts. `number` names a column
    of stored row numbers; without it rows are numbered here."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Words()
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                out = []
                for doc_id, text, *row in pdf.iloc[start : start + 500].itertuples(index=False, name=None):
                    w = words_of(text, table)
                    if len(w):
                        data = w.astype("<u4").tobytes()
                        h = kmers(w)
                        keys = sketch(h, bands, picks).view(np.int64)
                        grams = h.view(np.int64) if len(h) <= SHORT else None
                        out.append((doc_id, hashlib.blake2b(data, digest_size=16).digest(), data, keys, grams, *row))
                    else:
                        out.append((doc_id, None, None, None, None, *row))
                yield pd.DataFrame(out, columns=columns)

    columns = ["doc_id", "digest", "words", "keys", "grams"] + ["row"] * bool(number)
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(number).alias("row")] if number else [])
    )
    kind = "doc_id string, digest binary, words binary, keys array<long>, grams array<long>"
    made = rows.mapInPandas(of, kind + (", row long" if number else ""))
    made = made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    return made if number else made.withColumn("row", F.monotonically_increasing_id())


def prefixes(short: DataFrame, threshold: float) -> DataFrame:
    """(class, key) of the prefix keys of the short classes (class, grams). The driver gets COMMON counts at most."""
    often = short.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= OFTEN)
    top = often.orderBy(F.desc("c"), "gram").limit(COMMON).collect()
    common = np.array([r["gram"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(common)
    common, counts = common[order], np.array([r["c"] for r in top], np.int64)[order]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [prefix(np.asarray(x, np.int64).view(np.uint64), common, counts, threshold).view(np.int64) for x in pdf["grams"]]
            yield pd.DataFrame({"class": pdf["class"], "keys": keys})

    return short.mapInPandas(of, "class long, keys array<long>").select("class", F.explode("keys").alias("key"))


def verify(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes whose similarity reaches the threshold. Only the words of classes in some pair
    are moved; each side comes by an equi-join, whose large partitions Spark splits."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    texts = words.join(wanted, "class", "left_semi")
    both = pairs.join(texts.select(F.col("class").alias("b"), F.col("words").alias("wb")), "b").join(
        texts.select(F.col("class").alias("a"), F.col("words").alias("wa")), "a"
    )

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = [
                aligned(kmers(np.frombuffer(x, "<u4")), kmers(np.frombuffer(y, "<u4")), threshold) >= threshold
                for x, y in zip(pdf["wa"], pdf["wb"], strict=True)
            ]
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    return both.select("a", "b", "wa", "wb").mapInPandas(similar, "a long, b long")


def bins(h: np.ndarray) -> np.ndarray:
    """Bytes of the bins of a class: a power of two of them, 3/4 of the k-mers or more, at most MOST_BINS."""
    count = min(MOST_BINS, 1 << max(4, int(np.ceil(np.log2(0.75 * len(h))))))
    x = mix(h + np.uint64(0xA0761D6478BD642F))
    out = np.zeros(count, np.uint8)
    np.bitwise_xor.at(out, (x & np.uint64(count - 1)).astype(np.intp), (x >> np.uint64(56)).astype(np.uint8))
    return out


def folded(b: np.ndarray, count: int) -> np.ndarray:
    """The bins of a class as if there were only `count`."""
    return np.bitwise_xor.reduce(b.reshape(-1, count), axis=0)


def open_pairs(threshold: float):
    def of(group: pd.DataFrame) -> pd.DataFrame:
        """Pairs of a block of left and a block of right classes that the bound does not exclude."""
        out = []
        sides = []
        for left in (True, False):
            part = group[group["left"] == left]
            sides.append((part["class"].to_numpy(), part["part"].to_numpy(), part["n"].to_numpy(), [np.frombuffer(x, np.uint8) for x in part["bins"]]))
        (ca, pa, na, ba), (cb, pb, nb, bb) = sides
        tables: dict = {}  # the right side, folded to each number of bins that is needed
        for k in range(len(ca)):
            near = (cb > ca[k]) & (pb != pa[k])
            near &= np.minimum(nb, na[k]) >= threshold * np.maximum(nb, na[k])
            for size in {len(bb[i]) for i in np.flatnonzero(near)}:
                count = min(size, len(ba[k]))
                if (size, count) not in tables:
                    rows = np.array([i for i, x in enumerate(bb) if len(x) == size])
                    tables[size, count] = rows, np.array([folded(bb[i], count) for i in rows])
                rows, table = tables[size, count]
                use = near[rows]
                differ = (table[use] != folded(ba[k], count)).sum(axis=1)
                good = rows[use][differ <= (nb[rows[use]] + na[k]) * (1 - threshold) / (1 + threshold) + 1e-9]
                out.append(pd.DataFrame({"a": ca[k], "b": cb[good]}))
        return pd.concat(out) if out else pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})

    return of


def candidates(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per class of `wanted`: words, n (its k-mers) and bins. The only step that moves all documents' words."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = [kmers(np.frombuffer(x, "<u4")) for x in pdf["words"]]
            yield pdf.assign(n=[len(x) for x in h], bins=[bins(x).tobytes() for x in h])

    found = rows.select(F.col("row").alias("class"), "words").join(wanted.hint("merge"), "class", "left_semi")
    return found.mapInPandas(of, "class long, words binary, n long, bins binary")


def grouped(docs: DataFrame, threshold: float, bands: int, picks: int, number: str | None = None) -> DataFrame:
    """Per row of (doc_id, text): doc_id, row and group, stored."""
    rows = stored(sequences(docs, bands, picks, number), "sequences")
    # a class is named by the first row that holds its words
    first_row = rows.where("digest is not null").groupBy("digest").agg(F.min("row").alias("class"))
    member = stored(rows.select("doc_id", "row", "digest").join(first_row, "digest", "left").select("doc_id", "row", "class"), "members")
    heads_of = member.where("row = class").select("class")
    keys = rows.select(F.col("row").alias("class"), "keys").join(heads_of, "class", "left_semi").select("class", F.explode("keys").alias("key"))
    short = rows.where("grams is not null").select(F.col("row").alias("class"), "grams").join(heads_of, "class", "left_semi")
    keys = keys.unionByName(prefixes(stored(short, "short"), threshold))
    keys = keys.repartition("key")  # the sizes and the join with them share this shuffle
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = stored(keys.join(sizes, "key"), "shared")
    words = stored(candidates(rows, shared.select("class").distinct()), "candidates")
    score = shared.groupBy("class").agg(F.sum("c").alias("score"))
    heads = shared.join(score, "class").groupBy("key").agg(F.max_by("class", "score").alias("head"), F.max("score").alias("head_score"))
    buckets = stored(shared.select("key", "class").join(heads, "key"), "buckets")

    def connected(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Components (class, component) of the links and of those found before, which come as stars."""
        if before is not None:
            links = links.unionByName(before.select(F.col("class").alias("a"), F.col("component").alias("b")))
        return components(links).withColumnRenamed("node", "class")

    def opened(reached: DataFrame, name: str) -> DataFrame:
        """The buckets that still hold several components, with each class's component as `part`."""
        part = F.coalesce("component", "class").alias("part")
        all_ = stored(buckets.join(reached, "class", "left").select("key", "class", "head", part), name)
        split = all_.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
        return all_.join(split, "key", "left_semi")

    star = buckets.where("class <> head")
    tried = stored(star.groupBy("class").agg(F.max_by("head", "head_score").alias("a")).select("a", F.col("class").alias("b")), "pairs1")
    reached = connected(stored(verify(tried, words, threshold), "links1"))

    open_ = opened(reached, "open2")
    of_head = open_.where("class = head").select("key", F.col("part").alias("head_part"))
    pairs = open_.join(of_head, "key").where("part <> head_part").select(F.col("head").alias("a"), F.col("class").alias("b"))
    pairs = stored(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs2")
    tried = tried.unionByName(pairs)
    reached = connected(stored(verify(pairs, words, threshold), "links2"), reached)

    open_ = opened(reached, "open3")
    sizes = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    open_ = open_.join(sizes, "key").join(words.select("class", "n", "bins"), "class").select("key", "class", "part", "n", "bins", "blocks")
    open_ = stored(open_, "open4")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    left = open_.select("*", own.alias("i"), F.lit(True).alias("left")).withColumn("j", every)
    right = open_.select("*", own.alias("j"), F.lit(False).alias("left")).withColumn("i", every)
    # comparing costs more than the rows' bytes tell: a number of partitions that Spark does not merge by bytes
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.unionByName(right).repartition(tasks, "key", "i", "j")
    pairs = dealt.groupBy("key", "i", "j").applyInPandas(open_pairs(threshold), "a long, b long")
    both_ways = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = stored(pairs.distinct().join(both_ways, ["a", "b"], "left_anti"), "pairs3")
    reached = connected(stored(verify(pairs, words, threshold), "links3"), reached)

    alone = -1 - F.col("row")  # rows without words, apart from all classes
    return stored(member.join(reached, "class", "left").select("doc_id", "row", F.coalesce("component", "class", alone).alias("group")), "grouped")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, picks: int = PICKS) -> DataFrame:
    """Per row of (doc_id, text): class_id (smallest doc_id of its group), class_size and kept."""
    rows = grouped(docs, threshold, bands, picks)
    sizes = rows.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(sizes, "group").select(
        "doc_id", "class_id", "class_size", F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept")
    )


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one row of each group: the one with the smallest doc_id, of rows that share it the first. A row
    without an id stays only where its group has no id at all. Rows are told apart by a stored number, not by id."""
    docs, number = numbered(docs, "numbered")
    rows = grouped(docs, threshold, BANDS, PICKS, number)
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row").alias(number))
    # alike at every size: never a broadcast
    return docs.join(first.select(number).hint("merge"), number, "left_semi").drop(number)
