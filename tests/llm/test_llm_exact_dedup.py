import hashlib
import re

from pyspark.sql import functions as F

from bvengine.llm import exact_dedup as X
from llm.helpers import documents, prose


def brute(rows):
    norm = {}
    out = []
    for i, t in rows:
        x = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        norm.setdefault(x, []).append(i)
        out.append((i, x))
    ids = {x: min((i for i in g if i is not None), default=None) for x, g in norm.items()}
    return sorted(
        ((i, ids[x], len(norm[x]), i == ids[x], hashlib.sha256(x.encode()).hexdigest()) for i, x in out), key=str
    )


def test_against_brute_force(spark):
    long = " ".join(prose(5, 30_000))
    rows = [(i, " ".join(prose(i % 7, 50))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "\t\n"), (104, "a b"), (105, "a  b"), (106, "a b"), (107, "a\x0b\x0cb"), (108, "a b "), (109, " a b")]
    rows += [(200, long), (201, long.replace(" ", "\n", 5)), (202, long + "x"), (203, "y" + long), (None, "a b"), (104, "a b"), (204, "q" * 200_000), (205, "q" * 200_000)]
    docs = documents(spark, rows).repartition(5)
    got = sorted((tuple(r) for r in X.groups(docs).collect()), key=str)
    assert got == brute(rows)


def test_all_null_ids(spark):
    got = X.groups(documents(spark, [(None, "a"), (None, "a")])).collect()
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in got] == [(None, 2, True)] * 2
    assert X.groups(documents(spark, [(1, "a")]).limit(0)).count() == 0


def test_colliding_fingerprints_stay_apart(spark):
    made = spark.createDataFrame(
        [(1, "x", [(7, b"aa"), (8, b"cc")]), (2, "y", [(7, b"bb"), (8, b"cc")]), (3, "x", [(7, b"aa"), (8, b"cc")])],
        "doc_id long, text_sha256 string, recipe array<struct<fp:long,digest:binary>>",
    )
    ids = {r["doc_id"]: [(c["fp"], c["ordinal"]) for c in r["ids"]] for r in X.identify(made).collect()}
    assert ids[1] == ids[3] == [(7, 0), (8, 0)] and ids[2] == [(7, 1), (8, 0)]


def test_cuts_follow_content():
    data = (" ".join(prose(3, 20_000))).encode()
    ends = X.cuts(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(data) and max(sizes) <= X.MOST and min(sizes[:-1]) >= X.LEAST
    moved = X.cuts(b"some other start " * 40 + data)
    shift = len(b"some other start " * 40)
    assert len({e + shift for e in ends} & set(moved)) > 0.8 * len(ends)
    assert X.cuts(b"") == [] and X.cuts(b"abc") == [3] and X.cuts(b"z" * 50_000)[-1] == 50_000


def test_keep_first(spark):
    docs = documents(spark, [(1, "a b"), (2, "a  b"), (3, "c"), (None, "a b")])
    kept = X.keep_first(docs)
    assert kept.columns == docs.columns
    # a null id never matches an id that goes, so its row stays
    assert sorted(r["doc_id"] or 0 for r in kept.select(F.col("doc_id")).collect()) == [0, 1, 3]


def test_column_names_with_dots_and_blanks(spark):
    """Both dedup operators keep the columns as they are, whatever their names."""
    from bvengine.llm import order_minhash

    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "a", 1), (2, text, "b", 2), (3, "other words", "c", 3)], "doc_id long, text string, `a.b` string, `c d,e` int")
    for keep in (X.keep_first, order_minhash.keep_first):
        got = keep(docs)
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect())) == [(1, text, "a", 1), (3, "other words", "c", 3)]
