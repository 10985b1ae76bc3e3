import duckdb
import numpy as np
import pytest

from bvengine.llm import embedding_join as J
from bvengine.llm.queries import ORACLES, QUERIES
from oracle import compare

SCHEMA = "vec_id long, embedding array<float>, label int, node long, vec string"


def brute(rows, t):
    usable = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = {k: np.asarray(np.asarray(rows[k][1], np.float32), float) for k in usable}
    links = {k: set() for k in range(len(rows))}
    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= t:
                    links[a].add(b)
                    links[b].add(a)
    out, seen = [], {}
    for k in range(len(rows)):
        if k not in seen:
            todo, part = [k], set()
            while todo:
                n = todo.pop()
                if n not in part:
                    part.add(n)
                    todo += links[n]
            ids = [rows[n][0] for n in part if rows[n][0] is not None]
            seen.update(dict.fromkeys(part, min(ids, default=None)))
        c = seen[k]
        out.append((rows[k][0], len(links[k]), c, c is None or rows[k][0] == c))
    return sorted(out, key=str)


def near(rng, v, cos):
    u = rng.standard_normal(len(v))
    u -= u @ v * v / (v @ v)
    u *= np.linalg.norm(v) / np.linalg.norm(u)
    return v * cos + u * np.sqrt(1 - cos * cos)


def vectors():
    rng = np.random.default_rng(11)
    rows, i = [], 0
    for label in (0, 0, 0, 0, 1, 1, 2):
        for _ in range(40):
            v = rng.standard_normal(16)
            for c in (1.0, *rng.uniform(0.955, 0.999, rng.integers(0, 5))):
                rows.append((i, [float(z) for z in near(rng, v, c)], label))
                i += 1
    chain = rng.standard_normal(16)
    for _ in range(25):  # each next one links to the last only
        rows.append((i, [float(z) for z in chain], 0))
        chain, i = near(rng, chain, 0.9815), i + 1
    rows += [(9000 + k, rows[3][1], rows[3][2]) for k in range(150)]  # a large group of copies
    rows += [(9500, None, 0), (9501, [], 0), (9502, [0.0] * 16, 0), (9503, [float("nan")] * 16, 0), (9504, [float("inf")] + [1.0] * 15, 0), (9505, [None] + [1.0] * 15, 0)]
    rows += [(9506, rows[3][1], None), (None, rows[3][1], rows[3][2]), (5, rows[5][1], rows[5][2]), (9507, [3.0], 0), (9508, [5.0], 0), (9509, [-5.0], 0)]
    rows += [(9510, [2 * z for z in rows[3][1]], rows[3][2]), (9511, rows[3][1], 7)]
    return rows


@pytest.mark.parametrize(("cell", "block"), [(10_000, 1024), (20, 16), (60, 1024)])
def test_against_brute_force(spark, cell, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in J.link(df, cell=cell, block=block).collect()), key=str)
    assert got == brute(rows, 0.98)


def test_query_against_sql_on_planted_links(spark, tmp_path):
    seen, rows = set(), []
    for r in vectors():  # ids of the table are unique
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = compare(QUERIES["op2_embedding_join"](spark, str(tmp_path)), con, ORACLES["op2_embedding_join"])
    assert got["ok"], got


def test_empty(spark):
    assert J.link(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        J.link(spark.createDataFrame([], SCHEMA), threshold=0)


def test_exact_ties_agree_both_ways():
    a, b = np.array([[1.0, 0.0]]), np.array([[0.98, np.sqrt(1 - 0.98**2)]])
    assert J.linked(a, b, 0.98)[0, 0] == J.linked(b, a, 0.98)[0, 0]
    assert J.scale(np.array([[1e300, 1e300]])).max() <= 1
