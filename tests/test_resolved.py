"""Stored inputs of the extract: payer-resolved coverages, bucketed tables."""

import pytest
from pyspark.sql import functions as F

from bvengine.plans import rules as R
from bvengine.plans.extract import active_coverages, benefit_verification_extract, resolved_coverages, with_mapped_payer
from bvengine.sources import DomainTables, write_bucketed
from bvengine.sources.schemas import DOMAIN_SCHEMAS
from golden import AS_OF, CONFIG, EXPECTED, golden_tables
from test_plans import plan_text

BUCKETS = 8  # the tests' number of shuffle partitions
KEYS = {"program_member": "id", "authorization_consent": "program_member_mvn__c", "benefits_coverage": "program_member_mvn__c"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The golden tables in a catalog, those with a member id bucketed by it,
    and the resolved coverages bucketed by theirs."""
    root = tmp_path_factory.mktemp("stored")
    spark.sql(f"CREATE DATABASE stored_golden LOCATION '{root}'")
    t = golden_tables(spark)
    for name in DOMAIN_SCHEMAS:
        if name in KEYS:
            write_bucketed(getattr(t, name), f"stored_golden.{name}", KEYS[name], BUCKETS)
        else:
            getattr(t, name).write.saveAsTable(f"stored_golden.{name}")
    tables = DomainTables.from_catalog(spark, {n: f"stored_golden.{n}" for n in DOMAIN_SCHEMAS})
    write_bucketed(resolved_coverages(tables.benefits_coverage, tables.payer_mapping), "stored_golden.resolved", "bc_pm", BUCKETS)
    yield tables, spark.table("stored_golden.resolved")
    spark.sql("DROP DATABASE stored_golden CASCADE")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("parity", ["repaired", "intent", "as_written"])
def test_same_list_from_stored_inputs(stored, parity):
    t, resolved = stored
    cfg = CONFIG.with_(parity=parity)
    want = sorted(map(repr, benefit_verification_extract(t, AS_OF, cfg).collect()))
    for options in ({}, {"reduce_by_members": True}):
        got = benefit_verification_extract(t, AS_OF, cfg, resolved=resolved, **options).collect()
        assert sorted(map(repr, got)) == want
    assert {r[0] for r in got} == EXPECTED[parity]


@pytest.mark.parametrize("parity", ["repaired", "intent", "as_written"])
def test_summary_of_resolved_coverages(stored, parity):
    t, resolved = stored
    cfg = CONFIG.with_(parity=parity)
    want = R.coverage_summary(t.benefits_coverage.filter("status_mvn__c = 'Active'"), t.payer_mapping, cfg)
    assert sorted(R.resolved_summary(resolved, cfg).collect()) == sorted(want.collect())


def test_resolving_keeps_every_active_coverage(stored):
    t, resolved = stored
    active = active_coverages(t.benefits_coverage)
    assert resolved.select("bc_id").distinct().count() == active.select("bc_id").distinct().count()
    assert resolved.filter(F.col("bc_payer").isNull() & F.col("hpm_id").isNotNull()).count() == 0
    twice = with_mapped_payer(active, t.payer_mapping.unionAll(t.payer_mapping))
    assert twice.distinct().count() == resolved.distinct().count()


def test_payer_map_is_not_read_again(stored, no_broadcast):
    t, resolved = stored
    cfg = CONFIG.with_(parity="intent")
    plain, done = (plan_text(benefit_verification_extract(t, AS_OF, cfg, resolved=r)) for r in (None, resolved))
    assert plain.count("stored_golden.payer_mapping") > 0 and done.count("stored_golden.payer_mapping") == 0
    assert done.count("stored_golden.benefits_coverage") == 0
    # the resolving plan itself reads each input once
    once = plan_text(resolved_coverages(t.benefits_coverage, t.payer_mapping), "simple")
    assert once.count("FileScan") == 2 and once.count("SortMergeJoin") == 1
    # the summary's read is a narrow one
    narrow = plan_text(R.resolved_summary(resolved, cfg))
    assert "ReadSchema: struct<hzn_pm_id__c:string,hzn_plan_coverage_type__c:string,bc_tier:string,bc_payer:string,hpm_id:string>" in narrow


def executed(df):
    """Lines of the final plan (subqueries hold final and initial plans of their own)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].splitlines()


def test_bucketed_tables_are_not_shuffled_on_the_member_id(stored, no_broadcast):
    t, resolved = stored
    lines = executed(benefit_verification_extract(t, AS_OF, CONFIG, resolved=resolved))
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in lines]

    def way_up(at):
        """The operators above line ``at``, nearest first."""
        d = depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] < d:
                d = depth[i]
                yield lines[i]

    def before_join(name, join):
        out = []
        for i, x in enumerate(lines):
            if f"stored_golden.{name}[" in x and "Scan" in x:
                path = []
                for up in way_up(i):
                    path.append(up)
                    if join in up:
                        break
                out.append(path)
        return out

    def free(path):
        return not any("Exchange" in x for x in path)

    # consents and members meet in the semi join (J-1), coverages in the inner join (J-8)
    assert any(free(p) for p in before_join("authorization_consent", "LeftSemi"))
    assert any(free(p) and "LeftSemi" in p[-1] for p in before_join("program_member", "LeftSemi"))
    coverages = before_join("resolved", "SortMergeJoin")
    assert any(free(p) and "bc_pm" in p[-1] for p in coverages)
