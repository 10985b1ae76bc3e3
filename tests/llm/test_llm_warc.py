import hashlib

import pytest

from bvengine.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, `id` string, first int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "i", 1) for i, u, h in rows], SCHEMA)


def brute(rows):
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = max(same, default=None)
        revisit = len(body) >= 1000 and first is not None and first != i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/", "x" * 1000), (2, "http://b/", "x" * 1000), (3, "http://c/", "x" * 999), (4, "http://d/", "x" * 999), (5, None, None), (6, "", ""),
    (7, "http://é\r\nX: y", "é" * 600), (8, "u", "é" * 600), (9, "u", "a\r\n\r\nWARC/1.1\r\n" * 200), (10, "u", W.FILLER * 300), (11, "u", "\x28\xb5" * 5), (12, "u", "0123456789" * 40_000),
    (None, "u", "x" * 1000), (None, "v", "z" * 2000), (13, "u", "x" * 1000), (13, "u", "x" * 1000),
    *[(100 + i, f"http://h{i}/", f"<html><body>page {i} " + "common words of the site " * 50 + "</body></html>") for i in range(120)],
    *[(500 + i, "u", "hot " * 400) for i in range(80)],
]


@pytest.mark.parametrize("size", [16 << 20, 20_000])
def test_round_trip_against_brute_force(spark, size):
    got = W.archive(pages(spark, ROWS).repartition(3), size).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_urls_and_empty(spark):
    back = W.archive(pages(spark, ROWS[:8])).collect()
    assert {r["page_id"]: r["url"] for r in back} == {i: u for i, u, _ in ROWS[:8]}
    assert W.archive(pages(spark, ROWS[:1]).limit(0)).count() == 0


def archive_of(spark, tmp_path, rows):
    path = str(tmp_path / "w")
    W.write(pages(spark, rows).coalesce(1), path)
    names = [p for p in (tmp_path / "w").glob("part-*") if p.stat().st_size]
    return names, [p.read_bytes() for p in names]


def test_frames_are_plain_zstandard(spark, tmp_path):
    import zstandard

    _, files = archive_of(spark, tmp_path, [(i, "u", f"<p>{i} some page with words</p>" * 30) for i in range(60)])
    total = 0
    for data in files:
        size = int.from_bytes(data[4:8], "little")
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])) if size else zstandard.ZstdDecompressor()
        for frame in data[8 + size :].split(W.FILLER.encode("latin-1")):
            if frame:
                assert d.decompressobj().decompress(frame).startswith(b"WARC/1.1\r\n")
                total += 1
    assert total == 60


def test_damage_is_told(spark, tmp_path):
    _, files = archive_of(spark, tmp_path, [(1, "u", "hello " * 300), (2, "u", "other")])
    data = files[0]
    assert list(W.split_frames(data, "f"))
    for bad in (data[1:], data[:-20], data[:40] + b"\x00\x01" + data[42:], b""):
        with pytest.raises(ValueError):
            for r in W.split_frames(bad, "f"):
                W.parse(r, "f")
    good = W.record("1", "u", "abc", hashlib.sha1(b"abc").hexdigest(), 3, None)
    assert W.parse(good, "p")[:4] == ("1", 3, hashlib.sha1(b"abc").hexdigest(), "response")
    for bad in (
        good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"WARC/9"), good[:-1], good.replace(b"WARC-Date", b"WARC-Type"), good + b"x",
        good.replace(b"WARC-Type: response", b"WARC-Type: other"),
    ):
        with pytest.raises(ValueError):
            W.parse(bad, "p")
