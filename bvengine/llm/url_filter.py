"""URL filter by empirical-Bayes host reputation, in DataFrame functions only.

Rules come first: each is a host (or a parent domain) with a path prefix and a verdict; the longest that fits
decides. Pages without a rule are judged by their host's record. Labelled outcomes (good 1, bad 0) are summed per
host and shrunk through beta-binomial priors along the chain all pages -> public suffix -> registered domain ->
host: a level's posterior mean, weighted as `strength` pseudo-pages, is the prior of the next. A host is blocked
when the upper bound of its posterior, mean + z standard deviations, lies below `least` times the overall share of
good outcomes, so hosts with little evidence pass unless their domain or suffix is clearly bad. The limit is relative
because that share depends on who labels: at a share of 0.85, a host of 200 outcomes whose domain and suffix are no
worse than others is blocked at 0.7 and less, where an absolute limit of one half would pass it.

The registered query takes its labelled outcomes from ``labels``: the quality mark of the row with the page's id.

Null urls and urls without ``://`` have an empty host and path, fit no rule and form a host of their own, named by
the empty string. Outcomes that are null, neither 0 nor 1, or of no page are ignored; several of one page all
count. Repeated rows each get their own, equal result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Public suffixes of two labels, under which names are registered one level lower; others are the last label.
TWO_LABELS = ("co.uk", "ac.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za", "com.cn", "com.mx")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABELS), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABELS), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null: the longest host, then the longest path."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):  # later ones override
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        best = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def reputation(outcomes: DataFrame, strength: float = 20.0, z: float = 1.645) -> DataFrame:
    """Per host of `outcomes` (host, good 0/1 or null): pages, labelled n, good k, posterior mean, its upper bound, and
    the overall share of good outcomes (`base`).

    Hosts without labelled pages get their domain's posterior, and so on up to the overall one. All sums are
    partial aggregations of the level below: pages are shuffled once, as one row per host and task.
    """
    tally = lambda *names: (F.sum("n").alias(names[0]), F.sum("k").alias(names[1]))
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("suffix", "domain").agg(*tally("dn", "dk"))
    suffixes = hosts.groupBy("suffix").agg(*tally("sn", "sk"))
    whole = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("a0"))
    s = F.lit(float(strength))
    suffixes = suffixes.withColumn("s_mean", (F.col("sk") + s * whole.scalar()) / (F.col("sn") + s))
    domains = domains.join(suffixes.select("suffix", "s_mean"), "suffix").withColumn("d_mean", (F.col("dk") + s * F.col("s_mean")) / (F.col("dn") + s))
    hosts = hosts.join(domains.select("suffix", "domain", "d_mean"), ["suffix", "domain"])
    a = F.col("k") + s * F.col("d_mean")
    total = F.col("n") + s
    mean = a / total
    sd = F.sqrt(mean * (1 - mean) / (total + 1))
    return hosts.select("host", "n", "k", mean.alias("mean"), F.least(F.lit(1.0), mean + F.lit(float(z)) * sd).alias("upper"), whole.scalar().alias("base"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, strength: float = 20.0, z: float = 1.645, least: float = 0.9) -> DataFrame:
    """Per row of (page_id, url): host, path, rule, verdict (allow or block) and the host's posterior mean, null
    where a rule decides. `outcomes` is (page_id, good); `least` is a share of the overall one. Only pages without a rule are joined with the
    reputations, one row a host; the join's large partitions are split by Spark."""
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = seen.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"))
    marks = outcomes.select("page_id", F.col("good").cast("int").alias("good")).where("good in (0, 1)")
    known = reputation(hosts.join(marks, "page_id", "left"), strength, z).select("host", "mean", "upper", "base")
    ruled = seen.where("r is not null").select("page_id", "host", "path", "r.rule", "r.verdict", F.lit(None).cast("double").alias("host_mean"))
    rest = (
        seen.where("r is null")
        .join(known, "host")
        .select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
            F.when(F.col("upper") < least * F.col("base"), "block").otherwise("allow").alias("verdict"), F.col("mean").alias("host_mean"),
        )
    )
    return ruled.unionByName(rest)
