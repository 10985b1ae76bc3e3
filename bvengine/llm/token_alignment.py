"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded twice: by a byte-level BPE with a space in front (A) and by a piece model that puts one there
itself (B). Tokens are compared by the byte offsets of their ends. The shorter list of ends drives: each end is
searched in the longer list from its proportional place on, in steps that double until they pass it, then by halving (all
ends of a text at once). Its place there is a rank. An end found is a common one, and common ends cut both lists
into groups; a token's overlap range in the longer list runs from the rank of its start to the rank of its end.

Pairs (A id, B id) that overlap are counted over the corpus, each once a document. Documents are taken in blocks of
`BLOCK` code points of text: a block sends each of its pairs once, with the number of its documents that hold it, and gets the corpus
counts back once, so neither a frequent pair nor the number of documents decides what is shuffled; a document keeps its
pairs as places in its block's list. Documents and the counts of their block meet in one task.

Texts that are null or empty, or that the tokens of A or of B do not give back byte by byte (B turns a LOWER ONE EIGHTH BLOCK
into a space, for example), have no tokens: all their numbers are 0 and their groups empty. Strings of special tokens
are plain text. A long text is encoded as a whole by one task and makes a block of its own. Each row is a document of its
own, also where ids repeat or are null; counts that tie for an A id are all best. Extra columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bvengine.llm.common import stored
from bvengine.llm.packing import LONG_RUN, LONG_SPACE, byte_of, has_other_space, ranks

#: Code points of text after which a block of documents ends.
BLOCK = 4 << 20
#: Tokens whose bytes are compared with the text at a time.
STRETCH = 1 << 14

ALIGNED = (
    "side int, block long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
)
NAMES = ["side", "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
DOCUMENT, LIST = 0, 1


@lru_cache(maxsize=2)
def plain_tokenizer(path: str):
    """The file's tokenizer, with strings of special tokens read as text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@lru_cache(maxsize=2)
def bytes_a(path: str) -> tuple[list[bytes], np.ndarray]:
    """Bytes and their number per id of a byte-level vocabulary."""
    to_byte, vocab = byte_of(), plain_tokenizer(path).get_vocab()
    out = [b""] * (max(vocab.values()) + 1)
    for word, i in vocab.items():
        out[i] = bytes(map(to_byte.__getitem__, word))
    return out, np.array([len(x) for x in out])


@lru_cache(maxsize=2)
def array_merger(path: str):
    """The merging library's encoder for the file. It hands out its ids without a list only beside a special token, which
    is never allowed: its string in a text is plain text."""
    import public_tokenizers
    import tiktoken

    table = ranks(path)
    never = {"\0\U0010ffff\0": max(table.values()) + 1}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=never)


@lru_cache(maxsize=2)
def pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def bytes_b(path: str) -> tuple[list[bytes], np.ndarray]:
    """Bytes and their number per id of a piece model: <0xHH> is a byte, U+2581 a space."""
    sp = pieces(path)
    out = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
    return out, np.array([len(x) for x in out])


@lru_cache(maxsize=4)
def laid_out(table, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids in a row, and where each id's begin."""
    words, size = table(path)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size


def ends_in(whole: np.ndarray, ids: np.ndarray, table, path: str) -> np.ndarray | None:
    """The tokens' ends in the bytes `whole`; None where the tokens' bytes are others."""
    size = table(path)[1][ids]
    ends = np.cumsum(size)
    if not len(ends) or ends[-1] != len(whole):
        return None
    row, first = laid_out(table, path)
    shift = first[ids] - (ends - size)
    for k in range(0, len(ids), STRETCH):
        part = slice(k, k + STRETCH)
        low, high = ends[k] - size[k], ends[part][-1]
        at = np.repeat(shift[part], size[part])
        at += np.arange(low, high)
        if not np.array_equal(row[at], whole[low:high]):
            return None
    return ends


def encode(a: str, b: str, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Ids of both tokenizers and their tokens' ends; None where one does not give back the text."""
    if not text:
        return None
    spaced = " " + text
    # the merging library is the faster one; white space that it classes apart, and long runs, go through the tokenizer
    if has_other_space(text) or len(text) >= LONG_SPACE and LONG_RUN.search(text):
        ids_a = np.array(plain_tokenizer(a).encode(spaced, add_special_tokens=False).ids, np.int64)
    else:
        ids_a = array_merger(a).encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
    ids_b = pieces(b).encode(text, out_type="numpy").astype(np.int64)
    whole = np.frombuffer(spaced.encode(), np.uint8)
    if (ends_a := ends_in(whole, ids_a, bytes_a, a)) is None or (ends_b := ends_in(whole, ids_b, bytes_b, b)) is None:
        return None
    return ids_a, ids_b, ends_a, ends_b


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Per value of `short`, the first place in `long` whose value is not below it. Both rise."""
    n = len(long)
    start = np.arange(len(short)) * n // max(1, len(short))
    low, high = start - 1, start.copy()  # long[low] < value <= long[high] in the end, with -1 and n as open ends
    ahead = np.flatnonzero(long[start] < short)
    step = 1
    while len(ahead):
        low[ahead] = high[ahead]
        high[ahead] = np.minimum(start[ahead] + step, n)
        ahead = ahead[high[ahead] < n]
        ahead = ahead[long[high[ahead]] < short[ahead]]
        step *= 2
    behind = np.flatnonzero((low >= 0) & (high == start))
    behind = behind[long[low[behind]] >= short[behind]]
    step = 2
    while len(behind):
        high[behind] = low[behind]
        low[behind] = np.maximum(start[behind] - step, -1)
        behind = behind[low[behind] >= 0]
        behind = behind[long[low[behind]] >= short[behind]]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = long[middle] < short[open_]
        low[open_[below]] = middle[below]
        high[open_[~below]] = middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


class Alignment:
    """Groups and overlap ranges of two lists of token ends over the same bytes; neither list is empty."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        self.swapped = len(ends_b) < len(ends_a)
        short, long = (ends_b, ends_a) if self.swapped else (ends_a, ends_b)
        rank = gallop(short, long)
        common = long[rank] == short
        self.first = np.concatenate([[0], (rank + common)[:-1]])  # the token that holds the byte after the one before's end
        self.count = rank - self.first + 1
        self.common_short, self.common_long = np.flatnonzero(common), rank[common]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B, once per pair of tokens that overlap."""
        short = np.repeat(np.arange(len(self.count)), self.count)
        within = np.arange(len(short)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        long = np.repeat(self.first, self.count) + within
        return (long, short) if self.swapped else (short, long)

    def group_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Per group, the places after its last token of A and of B."""
        a, b = (self.common_long, self.common_short) if self.swapped else (self.common_short, self.common_long)
        return a + 1, b + 1


@lru_cache(maxsize=4)
def labels(n: int) -> np.ndarray:
    """Text of each id (below ten million) followed by a comma, a bar or a semicolon, in 8 bytes that end in zeros."""
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in ",|;"], "S8").view(np.uint64)


def groups_text(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
    """a1,a2|b1;a3|b2,b3: the ids of each group in order."""
    out = np.empty(len(a) + len(b), np.uint64)
    mark_a, mark_b = np.zeros(len(a), int), np.zeros(len(b), int)
    mark_a[ends_a - 1], mark_b[ends_b - 1] = 1, 2
    table = labels(1 + int(max(a.max(), b.max())) | 0xFFFF)
    # a group's tokens of A come after those of B of the groups before it, and its tokens of B after all its own of A
    before_a, before_b = np.zeros_like(ends_a), np.zeros_like(ends_b)
    before_a[1:], before_b[1:] = ends_a[:-1], ends_b[:-1]
    out[np.arange(len(a)) + np.repeat(before_b, ends_a - before_a)] = table[mark_a, a]
    out[np.arange(len(b)) + np.repeat(ends_a, ends_b - before_b)] = table[mark_b, b]
    return out.tobytes().translate(None, b"\0")[:-1]


def aligned(a: str, b: str, text: str | None):
    """(ids of A, ids of B, Alignment) of a text, or None where it has no tokens."""
    if (found := encode(a, b, text)) is None:
        return None
    return *found[:2], Alignment(*found[2:])


def alignments(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per row of (doc_id, text): ids_a, ids_b, and the groups as rows (end_a, end_b) of places after their last tokens.
    `a` and `b` are the paths of the tokenizers' files."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                if (x := aligned(a, b, text)) is None:
                    out.append((doc_id, [], [], [], []))
                else:
                    out.append((doc_id, x[0], x[1], *x[2].group_ends()))
            yield pd.DataFrame(out, columns=["doc_id", "ids_a", "ids_b", "end_a", "end_b"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInPandas(of, "doc_id string, ids_a array<long>, ids_b array<long>, end_a array<long>, end_b array<long>")
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def blocks(docs: DataFrame, a: str, b: str, block: int) -> DataFrame:
    """Rows of ALIGNED: a document's numbers and pairs (places in its block's list, and how often), and each block's
    list of pairs (A id << 32 | B id, and how many of its documents hold it)."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, open_ = TaskContext.get().partitionId() << 32, 0, []

        def close() -> pd.DataFrame:
            held = [x[-2] for x in open_]
            found, place, docs_with = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            ends = np.cumsum([len(x) for x in held])[:-1]
            out = [(DOCUMENT, number, *x[:-2], p, x[-1]) for x, p in zip(open_, np.split(place, ends), strict=True)]
            return pd.DataFrame([*out, (LIST, number, None, 0, 0, 0, 0, "", found, docs_with.astype(np.int32))], columns=NAMES)

        none, never = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                if (x := aligned(a, b, text)) is None:
                    open_.append((doc_id, 0, 0, 0, 0, "", none, never))
                else:
                    ids_a, ids_b, made = x
                    ends = made.group_ends()
                    at, bt = made.links()
                    pairs, times = np.unique(ids_a[at] << 32 | ids_b[bt], return_counts=True)
                    digest = hashlib.sha256(groups_text(ids_a, ids_b, *ends)).hexdigest()
                    open_.append((doc_id, len(ids_a), len(ids_b), len(ends[0]), len(at), digest, pairs, times.astype(np.int32)))
                size += len(text or "") + 256
                if size >= block:
                    yield close()
                    number, size, open_ = number + 1, 0, []
        if open_:
            yield close()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(of, ALIGNED)


def report(docs: DataFrame, a: str, b: str, block: int = BLOCK) -> DataFrame:
    """Per row of (doc_id, text): n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. `a` and `b` are the
    paths of the tokenizers' files."""
    made = stored(blocks(docs, a, b, block), "aligned")
    each = made.where(F.col("side") == LIST).select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x"))
    each = each.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = each.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = each.join(known, "pair").select("block", "place", "count", "best")
    numbers = made.where(F.col("side") == DOCUMENT).select(F.col("block").alias("of"), *NAMES[2:])

    def of(documents: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values("place")
        count, best = pairs["count"].to_numpy(np.int64), pairs["best"].to_numpy(bool)
        n_best, total = [], []
        for places, times in zip(documents.pop("pairs"), documents.pop("times"), strict=True):
            p, t = np.asarray(places, np.int64), np.asarray(times, np.int64)
            n_best.append(int(t[best[p]].sum()))
            total.append(int((t * count[p]).sum()))
        return documents.assign(n_best=n_best, count_sum=total)[OUT]

    out = numbers.groupBy("of").cogroup(known.groupBy("block")).applyInPandas(of, OUT_SCHEMA)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
OUT_SCHEMA = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
