"""Property tests: each operator against a plain Python loop over the rows, on
random NULL-rich tables."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bvengine.functions.cutoff import cutoff_literal
from bvengine.operators import attach_flags, exclude_unless_stale, has_all, latest_per_key, with_member_flag
from bvengine.plans import rules as R
from golden import CONFIG

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.sampled_from(["a", "b", "c", "d", None])
DAYS = st.sampled_from([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1)])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def newest(rows, key, ts, tie):
    """Per non-NULL key the row with the largest (ts, tie), NULL times last."""
    best = {}
    for r in rows:
        rank = (r[ts] is not None, r[ts] or dt.datetime.min, r[tie])
        if r[key] is not None and (r[key] not in best or rank > best[r[key]][0]):
            best[r[key]] = (rank, r)
    return {k: r for k, (_, r) in best.items()}


@SETTINGS
@given(st.lists(st.tuples(KEYS, DAYS, st.sampled_from(["x", "y", None])), max_size=25))
def test_latest_per_key(spark, rows):
    rows = [(f"c{i:02}", *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "id string, acct string, ts timestamp_ntz, v string")
    got = rows_of(latest_per_key(df.filter("acct is not null"), "acct", "ts", "id"))
    assert got == sorted(newest(rows, 1, 2, 0).values(), key=str)


@SETTINGS
@given(st.lists(st.tuples(KEYS, DAYS, st.sampled_from([0, 1, 2, -1, None])), max_size=25))
def test_exclude_unless_stale(spark, log_rows):
    tasks = ["a", "b", "c", "d", "e", None]
    log = spark.createDataFrame(log_rows, "k string, ts timestamp_ntz, acc int")
    got = exclude_unless_stale(spark.createDataFrame([(k,) for k in tasks], "task string"), "task", log, "k", "ts",
                               cutoff_literal(dt.datetime(2024, 2, 3, 12)), extra_aggs={"n": F.sum("acc")}, extra_cond=F.col("n") > 0)

    def free(task):
        mine = [r for r in log_rows if task is not None and r[0] == task]
        times, flags = [r[1] for r in mine if r[1]], [r[2] for r in mine if r[2] is not None]
        return not mine or bool(times) and max(times) < dt.datetime(2024, 1, 30, 8) and sum(flags) > 0

    assert rows_of(got) == sorted(((k,) for k in tasks if free(k)), key=str)


PLANS = st.sampled_from(["Commercial", "Commercial PPO", "Medicare Advantage", "Managed Medicaid", "Medicare FFS", "Medicaid", None])
TIERS = st.sampled_from(["Primary", "Secondary", None])
PAYERS = st.sampled_from(["Mapped", "Unmapped", "Some BCBS plan", None])
SIX = ("Medicare Advantage", "Managed Medicaid", "Medicare FFS", "Commercial", "Federal Employee", "Supplemental")


def flags_of(own, intent, mapped):
    """The six flags of one member from its active coverages."""
    out = [False] * 6
    for _, plan, t1, t2, _, payer in own:
        tier = t1 if t1 is not None else t2
        open_plan = plan is None or "Commercial" not in plan
        gap = payer is not None and payer not in mapped and "BCBS" not in payer
        out[0] |= open_plan and tier == "Primary"
        out[1] |= open_plan and tier == "Secondary"
        out[2] |= plan is not None and plan not in ("Medicare Advantage", "Medicare FFS")
        out[3] |= plan is not None and plan not in ("Managed Medicaid", "Medicare FFS")
        out[4] |= not intent or plan is not None and (plan not in SIX or gap)
        out[5] |= not intent or gap
    return out


@SETTINGS
@given(st.lists(st.tuples(KEYS, PLANS, TIERS, TIERS, st.sampled_from(["Active", "Inactive"]), PAYERS), max_size=25))
def test_member_summary(spark, rows):
    cov = spark.createDataFrame(
        [(*r, None) for r in rows],
        "hzn_pm_id__c string, hzn_plan_coverage_type__c string, hzn_insurance_type__c string, coverage_type_mvn__c string, "
        "status_mvn__c string, hzn_eblu_payer_name__c string, hzn_kry_payer_name__c string")
    names = ["a", "b", "c", None]
    members = spark.createDataFrame([(k,) for k in names], "name string")
    payers = spark.createDataFrame([("Mapped", "1"), ("Mapped", "2"), ("Other", "3")], "payer_name string, infinitus_payer_id string")
    for parity in ("repaired", "intent"):
        s = R.coverage_summary(cov.filter(F.col("status_mvn__c") == "Active"), payers, CONFIG.with_(parity=parity))
        got = rows_of(attach_flags(members, "name", s, "hzn_pm_id__c", R.SUMMARY_FLAGS).select("name", *R.SUMMARY_FLAGS))
        want = [(k, *flags_of([r for r in rows if k is not None and r[0] == k and r[4] == "Active"], parity == "intent", {"Mapped"})) for k in names]
        assert got == sorted(want, key=str), parity


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.sampled_from(["H", "C", "X", None]), st.sampled_from(["Active", "Inactive", None])), max_size=25))
def test_has_all(spark, rows):
    consent = spark.createDataFrame(rows, "pm string, type string, status string")
    got = rows_of(has_all(consent, "pm", "type", ["H", "C"], where=F.col("status") == "Active"))
    held = {k: {t for p, t, s in rows if p == k and s == "Active"} for k in {r[0] for r in rows} - {None}}
    assert got == sorted((k,) for k, types in held.items() if {"H", "C"} <= types)


@SETTINGS
@given(st.lists(KEYS, max_size=15), st.lists(KEYS, max_size=15))
def test_member_flag(spark, left, right):
    l_df = spark.createDataFrame(list(enumerate(left)), "i int, k string")
    r_df = spark.createDataFrame([(k,) for k in right], "m string")
    got = rows_of(with_member_flag(l_df, "k", r_df, "m", "f"))
    assert got == sorted(((i, k, k is not None and k in right) for i, k in enumerate(left)), key=str)


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.sampled_from(["RT0", "RT1", "RT9", None]), st.sampled_from(["Active", "Inactive"])), max_size=25))
def test_record_type_join_changes_nothing(spark, rows):
    """J-16: under a filter and below a join, with DISTINCT above."""
    bc = spark.createDataFrame(rows, "pm string, rt string, status string")
    types = spark.createDataFrame([("RT0",), ("RT1",), ("RT2",)], "rt_id string")
    pm = spark.createDataFrame([("a",), ("b",), ("e",)], "pm_id string")
    x = bc.filter("status = 'Active'").join(types, F.col("rt") == F.col("rt_id"), "left").join(pm, F.col("pm") == F.col("pm_id"))
    got = rows_of(x.select("pm", "status").distinct())
    assert got == sorted({(k, s) for k, _, s in rows if s == "Active" and k in ("a", "b", "e")})


ACCOUNTS = [("p1", "P"), ("p2", "P"), ("d1", "D"), ("s1", "S"), ("s2", "S"), ("x1", "X")]
IDS = st.sampled_from([a for a, _ in ACCOUNTS] + ["gone", None])


@SETTINGS
@given(st.lists(st.tuples(IDS, DAYS, st.sampled_from(["CA", "NY", None]), st.sampled_from([0, 1, None])), max_size=20),
       st.lists(st.tuples(IDS, IDS, IDS, IDS), max_size=10))
def test_parties_in_long_form(spark, contact_rows, member_rows):
    from bvengine.config import Rules
    from bvengine.plans.extract import NPI_COLS, party_dimension, with_parties

    cfg = Rules(patient_record_type="P", provider_record_type="D", site_record_types=("S",), contact_record_type="C")
    contacts = [(f"c{i:02}", a, d, s, p) for i, (a, d, s, p) in enumerate(contact_rows)]
    contact_df = spark.createDataFrame(
        [(i, a, "C", p, "10001", "x", None, "T", s, d) for i, a, d, s, p in contacts],
        "id string, account_mvn__c string, recordtypeid string, primary_mvn__c int, zip_mvn__c string, address_line_1_mvn__c string, "
        "address_line_2_mvn__c string, city_mvn__c string, state_mvn__c string, lastmodifieddate timestamp_ntz")
    extra = ["name", "formatted_name_vod__c", "firstname", "lastname", "type", "hzn_tax_id__c", *NPI_COLS]
    accounts = spark.createDataFrame([(a, rt, *[a] * len(extra)) for a, rt in ACCOUNTS], ["id", "recordtypeid", *extra])
    keys = ["member_mvn__c", "__h_key", "__e_key", "__e1_key"]
    members = spark.createDataFrame([(f"m{i}", *r, None, None) for i, r in enumerate(member_rows)],
                                    ", ".join(f"{c} string" for c in ["pm_id", *keys, "__e2_key", "__e3_key"]))
    out = with_parties(members, party_dimension(accounts, contact_df, cfg))
    picked = [c for p in ("pe_", "h_", "e_", "e1_", "e2_") for c in (f"{p}id", f"{p}state_mvn__c")]
    latest, kind = newest([c for c in contacts if c[4] == 1], 1, 2, 0), dict(ACCOUNTS)
    want = []
    for i, r in enumerate(member_rows):
        line = [f"m{i}"]
        for key, k in zip((*r, None), "PDSSS", strict=True):
            ok = kind.get(key) == k
            line += [key if ok else None, latest[key][3] if ok and key in latest else None]
        want.append(tuple(line))
    assert rows_of(out.select("pm_id", *picked)) == sorted(want, key=str)
