"""Zstandard-compressed WARC archives: written with a dictionary, read back frame by frame.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; then each record is one
Zstandard frame compressed with it. The dictionary is trained per archive on a bounded sample of its own records
(`SAMPLES` records, `SAMPLE_BYTES` bytes of each). Archives are written by Spark's text writer, one frame a row:
the line separator is an empty skippable frame (magic 0x184D2A50, length 0), which readers pass over, so a file
is a valid sequence of frames from its first byte to its last. They are read by Spark's binary file reader, so any
path that Spark can open will do. Each is bounded by about `archive_bytes` of payload.

The reader loads the dictionary of the leading frame, decodes one frame at a time, and validates: one frame one
record, version line, required and single headers, Content-Length against the block, the closing line ends, record
type, and the payload's digest. A bad record raises `ValueError` with file and place.

Records of equal payloads (SHA-1, length and a second 64-bit hash) of at least `REVISIT` bytes: that with the
largest page_id is the response, the others are revisits that name it and repeat its digest and length without the
payload. Null html is an empty payload; a null page_id is written without that field, counts as smaller than any
other, and comes back as null; null urls stay null. Rows that share payload and page_id with the response are
responses too, so no record refers to itself. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bvengine.llm.common import scratch_path

DICTIONARY, FILLER = 0x184D2A5D, "P*M\x18\x00\x00\x00\x00"
REVISIT = 1000
SAMPLES, SAMPLE_BYTES, DICT_BYTES = 256, 4096, 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FIELDS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string"


def plan(pages: DataFrame, n: int, least: int = REVISIT) -> DataFrame:
    """Per row of (page_id, url, html): the record's fields, in `n` partitions. The largest page_id per digest is
    aggregated with partial maxima over narrow rows; payloads are shuffled once, to the archive they go to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"), F.xxhash64(payload).alias("check"),
    )
    key = ["digest", "size", "check"]
    narrow = rows.select("page_id", "id", *key).where(F.col("size") >= least)
    first = narrow.groupBy(*key).agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    others = narrow.join(first, key).where("page_id is null or page_id <> first").where("first is not null").select("id", *key, "first").distinct()
    spread = rows.repartition(n, "id", *key).join(others.repartition(n, "id", *key), ["id", *key], "left")
    return spread.select(
        F.col("page_id").cast("string"), "url", F.when(F.col("first").isNull(), F.col("html")).alias("html"), "digest", "size",
        F.col("first").cast("string").alias("refers_to"),
    )


def record(page_id: str | None, url: str | None, html: str | None, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC/1.1 record. The identity fields WARC-Page-Id and WARC-Payload-Length are extensions."""
    body = b"" if refers_to is not None else (html or "").encode()
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + body
    seed = "|".join(map(repr, (page_id, url, digest, refers_to)))
    heads = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:sha1:{hashlib.sha1(seed.encode()).hexdigest()}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(size)),
    ]
    if url is not None:
        heads.append(("WARC-Target-URI", url.encode("unicode_escape").decode()))
    if page_id is not None:
        heads.append(("WARC-Page-Id", page_id))
    if refers_to is not None:
        heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Page-Id", refers_to)]
    heads.append(("Content-Length", str(len(block))))
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in heads), "\r\n"]).encode() + block + b"\r\n\r\n"


def trained(samples: list[bytes]):
    """A dictionary from a bounded sample, or None where there is too little to learn from."""
    import zstandard

    cut = [s[:SAMPLE_BYTES] for s in samples]
    if len(cut) < 16 or sum(map(len, cut)) < 16 << 10:
        return None
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, cut)) // 8), cut, k=200, d=8)
    except zstandard.ZstdError:
        return None


def write(pages: DataFrame, path: str, archive_bytes: int = 16 << 20) -> None:
    """Write a record per row of `pages` as archives of about `archive_bytes` of payload each below `path`."""
    total = pages.agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))) + 400)).first()[0] or 0
    n = max(1, -(-total // archive_bytes))

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        def records():
            for pdf in batches:
                for row in pdf.itertuples(index=False, name=None):
                    yield record(*row)

        source = records()
        held = [r for _, r in zip(range(SAMPLES), source)]
        if not held:
            return
        dictionary = trained(held)
        raw = dictionary.as_bytes() if dictionary else b""
        press = zstandard.ZstdCompressor(level=3, write_checksum=True, **({"dict_data": dictionary} if dictionary else {}))
        out, size = [struct.pack("<II", DICTIONARY, len(raw)) + raw], 0
        for group in (held, source):
            for r in group:
                out.append(press.compress(r))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pd.DataFrame({"frame": out})
                    out, size = [], 0
        if out:
            yield pd.DataFrame({"frame": out})

    plan(pages, n).mapInPandas(frames, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", FILLER).option("compression", "none").text(path)


def split_frames(data: bytes, name: str) -> Iterator[bytes]:
    """The records of one archive's bytes, decoded one frame at a time."""
    import zstandard

    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY:
        raise ValueError(f"{name}: no dictionary frame at the start")
    size = struct.unpack_from("<I", data, 4)[0]
    raw, at = data[8 : 8 + size], 8 + size
    if len(raw) < size:
        raise ValueError(f"{name}: the dictionary frame is cut off")
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        raw = zstandard.ZstdDecompressor().decompress(raw)
    press = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}))
    view = memoryview(data)
    while at < len(data):
        magic = data[at : at + 4]
        if len(magic) == 4 and 0x184D2A50 <= (m := struct.unpack("<I", magic)[0]) <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                raise ValueError(f"{name}: a skippable frame is cut off")
            continue
        one, record, end = press.decompressobj(), [], at
        try:
            while not one.eof and end < len(data):
                record.append(one.decompress(view[end : end + 65536]))
                end = min(end + 65536, len(data)) - len(one.unused_data)
        except zstandard.ZstdError as e:
            raise ValueError(f"{name} at {at}: {e}") from e
        if not one.eof:
            raise ValueError(f"{name} at {at}: the last frame is cut off")
        yield b"".join(record)
        at = end


def parse(data: bytes, place: str) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of one record, validated."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"{place}: no WARC version line")
    heads: dict[str, str] = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if not colon or k.lower() in heads:
            raise ValueError(f"{place}: bad or repeated header {k!r}")
        heads[k.lower()] = v.strip()
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-payload-length"):
        if k not in heads:
            raise ValueError(f"{place}: header {k} is missing")
    if not heads["content-length"].isdigit() or len(rest) != int(heads["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"{place}: Content-Length does not fit the block")
    kind, digest, size = heads["warc-type"], heads["warc-payload-digest"].removeprefix("sha1:"), int(heads["warc-payload-length"])
    http, gap, body = rest[:-4].partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise ValueError(f"{place}: no HTTP head")
    if kind == "response":
        if len(body) != size or hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"{place}: the payload differs from its digest or length")
    elif kind != "revisit" or body or "warc-refers-to-page-id" not in heads or heads.get("warc-profile") != PROFILE:
        raise ValueError(f"{place}: not a response, nor a whole revisit")
    url = heads.get("warc-target-uri")
    return (
        heads.get("warc-page-id"), size, digest, kind, heads.get("warc-refers-to-page-id"),
        None if url is None else url.encode().decode("unicode_escape"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path`, one row each (FIELDS)."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                rows = [parse(r, f"{name}, record {i}") for i, r in enumerate(split_frames(data, name))]
                yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(records, FIELDS)


def archive(pages: DataFrame, archive_bytes: int = 16 << 20) -> DataFrame:
    """Write a record per row of `pages`, read the archives back and return their records."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    path = scratch_path(spark, "warc")
    write(pages, path, archive_bytes)
    back = read(spark, path)
    return back.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
