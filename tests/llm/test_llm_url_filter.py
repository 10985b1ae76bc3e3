import math
import re

import duckdb

from bvengine.llm import url_filter as U
from bvengine.llm.queries import ORACLES, QUERIES
from oracle import compare

SCHEMA = "page_id long, url string, host string, path string, n int"
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/x?y#z", "https://www.example.com/en/", "http://a.example.com/en", "http://example.com", "http://example.com?x=/en/",
    "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr/1#f", "http://x.net/de/1", "http://net/es/", "ftp://ÀB.org/p?q://r", "http://u@h.org:80/a/b", "://q/fr/",
    "http://a.co.uk/1", "http://b.a.co.uk/2", "http://good.org/1", "http://bad.org/1",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "c", "c", 1) for i, u in enumerate(URLS)] + [(0, URLS[0], "c", "c", 1)], SCHEMA)
    got = U.judge(pages, spark.createDataFrame([], "page_id long, good int")).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = split(URLS[r["page_id"]])
        fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), URLS[r["page_id"]]


def test_posterior_against_brute_force(spark):
    marks, pages, i = [], [], 0
    for host, good, bad, none in (("bad.org", 1, 80, 5), ("good.org", 60, 2, 5), ("new.org", 0, 0, 3), ("x.mean.org", 0, 200, 1), ("y.mean.org", 0, 0, 1), ("a.co.uk", 3, 1, 0)):
        for mark in [1] * good + [0] * bad + [None] * none:
            pages.append((i, f"http://{host}/{i}", "c", "c", 1))
            if mark is not None:
                marks.append((i, mark))
            i += 1
    marks += [(10**9, 0), (0, None), (None, 1), (1, 7)]
    got = {r["host"]: r for r in U.judge(spark.createDataFrame(pages, SCHEMA), spark.createDataFrame(marks, "page_id long, good int")).collect()}
    s = 20.0
    n, k = 81 + 62 + 200 + 4, 64
    org = (61 + s * (k + 1) / (n + 2)) / (343 + s)

    def post(good, total, prior):
        return (good + s * prior) / (total + s)

    mean_org = post(0, 200, org)
    want = {
        "bad.org": post(1, 81, post(1, 81, org)), "good.org": post(60, 62, post(60, 62, org)), "new.org": post(0, 0, post(0, 0, org)),
        "x.mean.org": post(0, 200, mean_org), "y.mean.org": post(0, 0, mean_org),
    }
    for host, m in want.items():
        assert math.isclose(got[host]["host_mean"], m, rel_tol=1e-12), host
    totals = {"bad.org": 81, "good.org": 62, "new.org": 0, "x.mean.org": 200, "y.mean.org": 0}
    for host, m in want.items():
        upper = m + 1.645 * math.sqrt(m * (1 - m) / (totals[host] + s + 1))
        assert got[host]["verdict"] == ("block" if upper < 0.9 * (k + 1) / (n + 2) else "allow"), host
    assert {got[h]["verdict"] for h in ("good.org", "new.org", "a.co.uk")} == {"allow"} and got["x.mean.org"]["verdict"] == "block"


def test_planted_hosts(spark):
    """Among hosts of 85 % good outcomes: bad ones with evidence go, also as hosts of a bad domain; a host with two
    bad pages, one without outcomes and all others stay. The same holds at a base rate of 30 %."""
    for share, bad_share in ((0.85, 0.4), (0.30, 0.05)):
        pages, marks = [], []

        def plant(host, n, good):
            for j in range(n):
                pages.append((len(pages), f"http://{host}/{j}", "c", "c", 1))
                marks.append((len(pages) - 1, int(j < good)))

        hosts = [f"h{i}.org" for i in range(30)]
        for h in hosts:
            plant(h, 100, round(100 * share))
        plant("bad.org", 200, round(200 * bad_share))
        plant("a.farm.org", 300, round(300 * bad_share))
        plant("two.org", 2, 0)
        for h in ("b.farm.org", "none.org"):
            pages.append((len(pages), f"http://{h}/", "c", "c", 1))
        got = U.judge(spark.createDataFrame(pages, SCHEMA), spark.createDataFrame(marks, "page_id long, good int"))
        blocked = {r["host"] for r in got.filter("verdict = 'block'").select("host").distinct().collect()}
        assert {"bad.org", "a.farm.org"} <= blocked <= {"bad.org", "a.farm.org", "b.farm.org"}, share
        assert got.count() == len(pages)


def test_native_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "c", "c", 1)], SCHEMA)
    plan = U.judge(pages, spark.createDataFrame([(1, 1)], "page_id long, good int"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert U.judge(pages.limit(0), spark.createDataFrame([], "page_id long, good int")).count() == 0


def test_query_against_sql_with_bad_hosts(spark, tmp_path):
    urls = list(URLS)
    marks = []
    for host, good, bad in (("bad.org", 2, 90), ("good.org", 80, 3), ("x.bad.co.uk", 1, 70), ("y.bad.co.uk", 0, 2), ("fair.de", 300, 20)):
        for mark in [1] * good + [0] * bad:
            marks.append((len(urls), mark, None))
            urls.append(f"https://{host}/{len(urls)}")
    marks += [(3, None, 1), (4, 7, 0), (10**6, 0, 0)]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = QUERIES["op5_url_filter"](spark, str(tmp_path))
    got = compare(df, con, ORACLES["op5_url_filter"])
    assert got["ok"], got
    verdicts = {r["host"]: r["verdict"] for r in df.where("rule is null").collect()}
    assert verdicts["bad.org"] == verdicts["x.bad.co.uk"] == "block" and verdicts["good.org"] == verdicts["fair.de"] == "allow"
