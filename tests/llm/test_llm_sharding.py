import re
import zlib

from bvengine.llm import sharding as S
from llm.helpers import documents, prose


def check(rows, got, shards):
    assert len(got) == len(rows)
    sizes, slots = {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 16 for _, t in rows)
    mean = sum(sizes.values()) / shards
    assert set(sizes) <= set(range(shards))
    assert max(sizes.values()) <= mean + largest and (len(sizes) < shards or min(sizes.values()) >= mean - largest)


def test_near_equal_bytes_with_a_hot_text(spark):
    rows = [(i, " ".join(prose(i, 5 + i % 300))) for i in range(1500)]
    rows += [(10_000 + i, "the same text " * 40) for i in range(900)] + [(20_000, None), (20_001, ""), (20_002, "ß" * 5000)]
    docs = documents(spark, rows).repartition(6)
    for shards, ranges in ((40, 8), (7, 2), (1, 1)):
        got = S.by_bytes(docs, shards, ranges_per_shard=ranges).collect()
        check(rows, got, shards)
    got = S.by_bytes(docs, 40, range_rows=20, ranges_per_shard=1).collect()  # nearly every range is subdivided
    check(rows, got, 40)
    a = sorted(map(tuple, S.by_bytes(docs).collect()))
    assert a == sorted(map(tuple, got))  # neither do the ranges
    assert a == sorted(map(tuple, S.by_bytes(docs.repartition(2)).collect()))  # the input's partitions don't matter


def test_edges(spark):
    assert S.by_bytes(documents(spark, [(1, "a")]).limit(0)).count() == 0
    one = S.by_bytes(documents(spark, [(1, None)])).collect()
    assert [(r["size"], r["text_crc32"], r["slot"]) for r in one] == [(16, 0, 0)]
    same = S.by_bytes(documents(spark, [(None, "x")] * 50 + [(5, "x")] * 50), 4).collect()
    assert sorted({(r["shard"], r["slot"]) for r in same}) and len({(r["shard"], r["slot"]) for r in same}) == 100


def keyed_rows(spark, n, hot):
    """`n` rows of which `hot` are alike, as by_bytes keys them."""
    return spark.range(n).selectExpr(
        "id AS doc_id", "16L AS size", "0L AS text_crc32",
        f"IF(id < {hot}, 7L, xxhash64(id)) AS k1", f"IF(id < {hot}, 7L, xxhash64(id, 1)) AS k2", "id AS k3",
    )


def test_pieces_keep_order_and_cut_rows_alike(spark):
    keyed = keyed_rows(spark, 6000, 2000)
    for ranges, most in ((50, 1 << 20), (4, 60)):  # ranges of their own splitters; few ranges, subdivided
        got = S.pieces(keyed, 6000 * 16, 6000, ranges, most).collect()
        assert len(got) == 6000
        got.sort(key=lambda r: (r["k1"], r["k2"], r["k3"]))
        at = [(r["range"], r["sub"]) for r in got]
        assert at == sorted(at)
        sizes = {}
        for x in at:
            sizes[x] = sizes.get(x, 0) + 1
        assert max(sizes.values()) <= 4 * min(6000 / ranges, most)
        assert len({(r["range"], r["sub"]) for r in got if r["k1"] == 7}) >= 10


def test_record_larger_than_a_shard(spark):
    rows = [(i, "ab") for i in range(20)] + [(99, "x" * 5000)]
    got = S.by_bytes(documents(spark, rows), 4).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_native_plan(spark):
    plan = S.by_bytes(documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
