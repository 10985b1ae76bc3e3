"""Byte-level BPE over whole documents, in overlapping chunks.

A text is cut into chunks of ``chunk`` code points; neighbouring chunks overlap by ``overlap``. In the overlap both
chunks look for the first place where a non-space is followed by a blank or a line end: no match of the pre-token
pattern crosses such a place, so pre-tokens started on either side agree from there on. A chunk's piece runs from
that place in its left overlap to that place in its right overlap and is pre-tokenised and encoded on its own,
in parallel with all others. Where an overlap holds no such place (one pre-token of more than ``overlap`` code
points), the two sides are left as text, joined in the stitching step and encoded there, so nothing is lost. A run of
white space too long for the pattern's matcher is cut by the pattern's own rule: all but its last character, or all of
it at the end of the text, is one pre-token and goes straight to the merges.
Decoding looks up each id's bytes and concatenates them.

Chunks of one document meet again by a shuffle on the document's row and are read there in order, one at a time;
a document of one chunk sends only its count and digests. Null text counts as empty: no ids, digests of nothing.
Repeated rows are separate documents. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 1 << 16, 1 << 10
SYNC = re.compile(r"(?<=\S)[ \n]")
#: The matcher fails on runs of a million characters. Its white space is Python's without the separators 1C to 1F.
LONG_SPACE = 100_000
LONG_RUN = re.compile(r"[^\S\x1c-\x1f]{%d,}" % LONG_SPACE)
#: Rows between the chunk and the stitching step; head and tail are text that has no boundary of its own.
PIECES = "row long, doc_id string, part int, parts int, n long, head string, ids binary, tail string, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path: str, text: str) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    import numpy as np

    out, at = [], 0
    for m in LONG_RUN.finditer(text) if len(text) >= LONG_SPACE else ():
        end = m.end() if m.end() == len(text) else m.end() - 1
        out.append(encoder(path).encode_to_numpy(text[at : m.start()], disallowed_special=()))
        # the merges of one pre-token, without the pattern
        out.append(np.array(encoder(path)._core_bpe.encode_single_piece(text[m.start() : end].encode()), np.uint32))
        at = end
    out.append(encoder(path).encode_to_numpy(text[at:], disallowed_special=()))
    return b"".join(x.astype("<u4").tobytes() for x in out)


def decode(path: str, ids: bytes) -> bytes:
    import numpy as np

    return encoder(path).decode_bytes(np.frombuffer(ids, "<u4").tolist()) if ids else b""


def sync(text: str, low: int, high: int) -> int | None:
    """First boundary in text[low:high]: the place of a blank or line end after a non-space."""
    m = SYNC.search(text, max(low, 1), min(high, len(text)))
    return m.start() if m else None


def piece(text: str, lead: int, chunk: int, overlap: int, first: bool, last: bool) -> tuple[str, str, str]:
    """(head, middle, tail) of one chunk. `text` starts `lead` code points before the chunk's own start; head and
    tail hold text that belongs to this chunk's side of an overlap without a boundary."""
    a = 0 if first else sync(text, lead, lead + overlap)
    own_end = len(text) if last else lead + chunk
    b = len(text) if last else sync(text, own_end, own_end + overlap)
    if a is not None and b is not None:
        return "", text[a:b], ""
    inner = [m.start() for m in SYNC.finditer(text, max(lead, 1), own_end)] if a is None or b is None else []
    if a is None and b is None:
        return (text[lead : inner[0]], text[inner[0] : inner[-1]], text[inner[-1] : own_end]) if inner else (text[lead:own_end], "", "")
    if a is None:
        return (text[lead : inner[0]], text[inner[0] : b], "") if inner else (text[lead:b], "", "")
    return ("", text[a : inner[-1]], text[inner[-1] : own_end]) if inner and inner[-1] > a else ("", "", text[a:own_end])


def encode_documents(docs: DataFrame, ranks: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row of (doc_id, text): n_tokens, ids_sha256 and decoded_sha256. `ranks` is the rank file's path."""
    if not 1 < overlap <= chunk:
        raise ValueError("overlap must be above 1 and at most chunk")
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.greatest(F.lit(1), F.ceil(F.length(text) / chunk)).cast("int")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"), parts.alias("parts"))
    cut = rows.select("row", "doc_id", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text").select(
        "row", "doc_id", "part", "parts",
        F.when(F.col("parts") == 1, F.col("text"))
        .otherwise(F.substring("text", F.greatest(F.col("part") * chunk, F.lit(1)), F.lit(chunk + overlap + 1)))
        .alias("text"),
    )

    def encode_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row, doc_id, part, n_parts, t in zip(pdf["row"], pdf["doc_id"], pdf["part"], pdf["parts"], pdf["text"], strict=True):
                # a chunk after the first starts one code point early, so that a boundary can lie at its start
                head, middle, tail = piece(t, int(part > 0), chunk, overlap, part == 0, part == n_parts - 1)
                ids = encode(ranks, middle)
                whole = n_parts == 1
                out.append((
                    row, doc_id, part, n_parts, len(ids) // 4, head, None if whole else ids, tail,
                    hashlib.sha256(ids).hexdigest() if whole else None, hashlib.sha256(decode(ranks, ids)).hexdigest() if whole else None,
                ))
            yield pd.DataFrame(out, columns=["row", "doc_id", "part", "parts", "n", "head", "ids", "tail", "ids_sha256", "decoded_sha256"])

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: list = []  # of the document being read: row, doc_id, n, digest of ids, digest of bytes, open text

        def add(ids: bytes) -> None:
            state[2] += len(ids) // 4
            state[3].update(ids)
            state[4].update(decode(ranks, ids))

        def close():
            return (state[1], state[2], state[3].hexdigest(), state[4].hexdigest())

        for pdf in batches:
            out = []
            for row, doc_id, part, n_parts, n, head, ids, tail, a, b in pdf.itertuples(index=False, name=None):
                if n_parts == 1:
                    out.append((doc_id, n, a, b))
                    continue
                if part == 0:
                    state[:] = [row, doc_id, 0, hashlib.sha256(), hashlib.sha256(), []]
                state[5].append(head)
                if ids or tail or part == n_parts - 1:  # the open text ends here
                    add(encode(ranks, "".join(state[5])))
                    add(ids)
                    state[5] = [tail]
                if part == n_parts - 1:
                    add(encode(ranks, "".join(state[5])))
                    out.append(close())
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    pieces = cut.mapInPandas(encode_chunks, PIECES)
    whole = pieces.repartition("row").sortWithinPartitions("row", "part")
    done = whole.mapInPandas(stitch, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
