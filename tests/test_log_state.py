"""The logs' states: any split merges to the state of the whole, the extract
is the same from a state and the rows since, and live keys cut a log below
its shuffle."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bvengine.functions.cutoff import cutoff_literal
from bvengine.operators import blocked_keys, log_state, merge_log_state
from bvengine.plans.extract import benefit_verification_extract, log_states
from golden import AS_OF, CONFIG, EXPECTED, golden_tables
from test_plans import no_broadcast, parquet_tables, plan_text  # noqa: F401

ROW = st.tuples(st.sampled_from(["a", "b", " ", None]), st.sampled_from([None, dt.datetime(2024, 1, 20), dt.datetime(2024, 2, 1)]), st.sampled_from([None, 0, 1, -1]))
SCHEMA = "k string, at timestamp_ntz, ok int"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(ROW, max_size=14), st.lists(ROW, max_size=14), st.lists(ROW, max_size=5))
def test_any_split_merges_to_the_whole(spark, first, second, third):
    sums = {"n": F.sum("ok")}
    state = lambda rows: log_state(spark.createDataFrame(rows, SCHEMA), "k", "at", sums)
    parts = merge_log_state(merge_log_state(state(first), state(second)), state(third))
    other = merge_log_state(state(third), merge_log_state(state(second), state(first)))
    whole = sorted(map(str, state(first + second + third).collect()))
    assert sorted(map(str, parts.collect())) == whole == sorted(map(str, other.collect()))
    cut, cond = cutoff_literal(AS_OF), F.col("n") > 0
    want = {r[0] for r in blocked_keys(spark.createDataFrame(first + second, SCHEMA), "k", "at", cut, sums, cond).collect()}
    got = {r[0] for r in blocked_keys(spark.createDataFrame(second, SCHEMA), "k", "at", cut, sums, cond, state=state(first)).collect()}
    live = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    some = {r[0] for r in blocked_keys(spark.createDataFrame(first + second, SCHEMA), "k", "at", cut, sums, cond, live=live).collect()}
    assert got == want and some == want & {"a"}


@pytest.mark.parametrize("parity", ["repaired", "as_written"])
@pytest.mark.parametrize("day", [dt.datetime(2000, 1, 1), dt.datetime(2024, 1, 25), dt.datetime(2030, 1, 1)])
def test_extract_from_states_and_later_rows(spark, tmp_path, parity, day):
    t = golden_tables(spark)
    old = lambda c: F.coalesce(F.col(c) < F.lit(day), F.lit(True))
    kept = []
    for i, s in enumerate(log_states(t.outbound_log.filter(old("extraction_date")), t.allcare_log.filter(old("extraction date")))):
        s.write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
    later = t.__class__(**{**t.__dict__, "outbound_log": t.outbound_log.filter(~old("extraction_date")), "allcare_log": t.allcare_log.filter(~old("extraction date"))})
    for reduce in (False, True):
        df = benefit_verification_extract(later, AS_OF, CONFIG.with_(parity=parity), states=kept, reduce_by_members=reduce)
        assert {r[0] for r in df.select("`Customer BV Task ID`").collect()} == EXPECTED[parity]
    merged = log_states(later.outbound_log, later.allcare_log, earlier=kept)
    whole = log_states(t.outbound_log, t.allcare_log)
    assert [sorted(map(str, x.collect())) for x in merged] == [sorted(map(str, x.collect())) for x in whole]


def test_live_keys_cut_the_log_below_its_shuffle(spark, parquet_tables):  # noqa: F811
    """With few live tasks the semi join is broadcast and runs in the scan's stage, below the log's Exchange."""
    live = parquet_tables.benefits_coverage.select(F.concat("name", F.lit(" "), "hzn_pm_id__c").alias("task_id"))
    keys = blocked_keys(parquet_tables.outbound_log, "customer bv task id", "extraction_date", cutoff_literal(AS_OF), live=live)
    lines = plan_text(keys, "simple").split("== Physical Plan ==")[1].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "extraction_date" in line)
    semi = max(i for i, line in enumerate(lines[:scan]) if "LeftSemi" in line)
    exchange = max(i for i, line in enumerate(lines[:semi]) if "Exchange hashpartitioning" in line)
    assert "BroadcastHashJoin" in lines[semi] and exchange < semi < scan
    assert not any("Exchange hashpartitioning" in line for line in lines[semi:scan])
    on, off = (plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG, reduce_by_members=x)) for x in (True, False))
    assert on.count("LeftSemi") >= off.count("LeftSemi") + 4  # consents, coverages and both logs
