import importlib

import pytest

import __spark_entry__ as E
import corpus_pipeline
from bvengine.llm import exact_dedup, order_minhash, pii, toxicity
from bvengine.llm.common import components
from bvengine.llm.queries import ORACLES, QUERIES
from oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    res = compare(QUERIES[name](spark, SF), duck_connect(SF), ORACLES[name])
    assert res["ok"], res


def test_registered_names():
    ops = [n for n in E.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in ops] == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, seen = docs.columns, {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF).cache()
        assert out.columns == columns and out.schema.simpleString() == docs.schema.simpleString()
        seen[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        now = out
    bad = {r["doc_id"] for r in toxicity.report(docs, labels).where("predicted = 1").collect()}
    first = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in bad}
    assert seen["toxicity"] == first
    best = {}
    for i, t in sorted(first.items()):
        best.setdefault(exact_dedup.normalise(t), i)
    assert set(seen["exact_dedup"]) == set(best.values())
    near = order_minhash.classes(spark.createDataFrame(list(seen["exact_dedup"].items()), "doc_id long, text string"))
    assert set(seen["near_dedup"]) == {r["doc_id"] for r in near.where("kept").collect()}
    assert seen["pii"] == {i: pii.mask(t) for i, t in seen["near_dedup"].items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert {r["doc_id"] for r in packed} == set(seen["pii"])
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(packed)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (300, 300), (90, 95), (95, 97), (97, 90)] + [(1000, 1000 + k) for k in range(1, 80)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    want = {i: 0 for i in range(61)} | {100: 100, 200: 100, 90: 90, 95: 90, 97: 90} | {1000 + k: 1000 for k in range(80)}
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_nothing_else_needs_the_package(monkeypatch):
    import sys

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.startswith(("bvengine.llm", "corpus_pipeline")):
                raise ModuleNotFoundError(name, name=name)

    kept = {k: v for k, v in sys.modules.items() if k.startswith(("bvengine.llm", "corpus_pipeline", "__spark_entry__"))}
    for k in kept:
        monkeypatch.delitem(sys.modules, k)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"] and entry.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    sys.modules.update(kept)


B = "this text has copies under other ids and its words are plain enough to be found by any search"
REPEATED = [
    (3, B), (4, "one text that is no copy of any other row here"), (4, B), (5, "one text that is no copy of any other row here"),
    (6, "the same row twice"), (6, "the same row twice"), (None, "only null ids hold this"), (None, "only null ids hold this"),
    (None, B), (None, "a third text whose id is missing too"), (None, ""), (7, ""),
]
ONE_EACH = sorted([
    (3, B), (4, "one text that is no copy of any other row here"), (6, "the same row twice"), (None, "only null ids hold this"),
    (None, "a third text whose id is missing too"), (7, ""),
], key=str)


def test_dedup_drops_rows_and_not_ids(spark):
    from llm.helpers import documents

    docs = documents(spark, REPEATED).repartition(3)

    def kept(df):
        assert df.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    assert kept(corpus_pipeline.drop_copies(spark, docs, SF)) == ONE_EACH
    # texts without words have no group
    assert kept(corpus_pipeline.drop_near_copies(spark, docs, SF)) == sorted([*ONE_EACH, (None, "")], key=str)
    near = [(i, t + " more" * (k % 2) if t else t) for k, (i, t) in enumerate(REPEATED[:5] + [(None, B + " end"), (None, B)])]
    got = kept(corpus_pipeline.drop_near_copies(spark, documents(spark, near), SF))
    assert [i for i, t in got if t.startswith(B)] == [3]
    ids = [i for i, _ in kept(exact_dedup.keep_first(docs))]
    assert ids.count(None) == 5 and sorted(i for i in ids if i is not None) == [3, 4, 6, 7]
