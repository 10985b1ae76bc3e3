"""Repeated ids: the statement's joins return every match, so an account id
held by several rows gives a row for each, roles combine, and a member id
held by several rows keeps each row's own parties."""

import pytest
from pyspark.sql import functions as F

from bvengine.operators import dealt_join, hot_keys
from bvengine.operators.joins import repeated, with_shares
from bvengine.plans.extract import benefit_verification_extract, party_dimension, with_parties
from bvengine.sources.loader import DomainTables
from bvengine.sources.schemas import DOMAIN_SCHEMAS
from golden import AS_OF, CONFIG, PR, PT, ST, _acct, _contact, _pm, build_rows
from oracle import canon
from test_skew import largest_share, many_partitions, oracle_rows, skewed  # noqa: F401


def frames(spark, rows):
    return DomainTables.from_frames({
        n: spark.createDataFrame([tuple(r.get(f.name) for f in DOMAIN_SCHEMAS[n].fields) for r in rs], DOMAIN_SCHEMAS[n]) for n, rs in rows.items()})


def doubled_rows():
    rows = build_rows()
    rows["account"] += [
        _acct("DOC1", PR, firstname="Ann", lastname="Second", npi_vod__c="5555555555"),          # the provider of most members, twice
        _acct("SITE1", ST, name="Clinic North", type="Hospital (HOPD)"),
        _acct("SITE1", ST, name="Clinic North", type="Hospital (HOPD)"),                         # and once more, equal in all columns
        _acct("SITE_M", ST, name="M again"),
        _acct("PAT42", PT, firstname="F42", lastname="Other"),                                   # a patient
        _acct("DOC1", ST, name="Not a provider"),                                                # an id under two kinds
        _acct("DOC_X", PR, firstname="Free", lastname="Twin"),                                   # one of two is excluded
    ]
    rows["program_member"] += [
        _pm(1, name="N1", physician_mvn__c="DOC_L", site_of_care_mvn__c="SITE_I"),               # member 1, with other parties
        _pm(3, name="N3b", hzn_asoc_opt_1__c="SITE_M", member_mvn__c="PAT42"),
        _pm(10), _pm(10),                                                                        # equal rows
    ]
    rows["contact_info"] += [_contact("CTL", "DOC_L", state_mvn__c="US-WA")]
    return rows


@pytest.fixture(scope="module")
def doubled(spark):
    rows = doubled_rows()
    return rows, frames(spark, rows)


@pytest.mark.parametrize("parity", ["repaired", "intent", "as_written"])
@pytest.mark.parametrize("options", [{}, {"join_hint": "merge"}, {"reduce_by_members": True}])
def test_repeated_ids_agree_with_oracle(spark, doubled, parity, options):
    rows, t = doubled
    cols, expected = oracle_rows(rows, parity)
    df = benefit_verification_extract(t, AS_OF, CONFIG.with_(parity=parity), **options)
    df = df.withColumn("Member Date of Birth", df["`Member Date of Birth`"].cast("string"))
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, expected)


def test_repeated_ids_by_hand(doubled):
    _, t = doubled
    got = {}
    for r in benefit_verification_extract(t, AS_OF, CONFIG).collect():
        got.setdefault(r["Customer BV Task ID"], []).append((r["Member Last Name"], r["Provider Last Name"], r["Practice Name"]))
    # two providers x two different sites
    assert sorted(got["CV2 N2"]) == sorted(("L2", p, s) for p in ("Lee", "Second") for s in ("Clinic", "Clinic North"))
    # the first row of member 1 as above, its second row with parties of its own
    assert sorted(got["CV1 N1"]) == sorted([("L1", p, s) for p in ("Lee", "Second") for s in ("Clinic", "Clinic North")] + [("L1", "Ko", "Infusion Co")])
    # two patients x two providers x two sites; equal member rows count once
    assert len(got["CV42 N42"]) == 8 and len(got["CV10 N10"]) == 4
    # the excluded provider goes, the other of its id stays
    assert {x[1] for x in got["CV15 N15"]} == {"Twin"}


def test_only_hot_keys_are_repeated(spark, many_partitions):  # noqa: F811
    left = spark.range(6000).select(F.col("id").cast("string").alias("i"), F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("P"), F.col("id") % 50)).alias("k"))
    hot = hot_keys(left, "k")
    assert [tuple(r) for r in hot.collect()] == [("HOT", 24)]  # half of the rows with a key, over 48 partitions
    dim = spark.createDataFrame([(f"P{i}",) for i in range(50)] + [("HOT",), ("HOT",), (None,)], "name string")
    copies = {r["name"]: r["n"] for r in repeated(dim, "name", hot, "copy").groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert copies.pop("HOT") == 48 and set(copies.values()) == {1}
    for hint in (None, "merge"):
        dealt = dealt_join(left, dim, "k", "name", "left", by=["i"], hint=hint)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, left.join(dim, left["k"] == dim["name"], "left").collect()))
        assert largest_share(dealt) < 0.1
        shares = with_shares(left, "k", hot, ["i"], hint)
        assert shares.where("__shares > 1").count() == 2000 and shares.count() == 6000


def test_hot_keys_are_fewer_than_partitions(spark, many_partitions):  # noqa: F811
    even = spark.range(4800).select((F.col("id") % 48).alias("k"))
    assert hot_keys(even, "k").count() == 0
    steep = spark.range(1, 200).select(F.explode(F.array_repeat("id", (10000 / F.col("id")).cast("int"))).alias("k"))
    found = {r[0]: r[1] for r in hot_keys(steep, "k").collect()}
    assert 0 < len(found) < 48 and max(found, key=found.get) == 1
    assert hot_keys(spark.range(0).select(F.col("id").alias("k")), "k").count() == 0
    assert hot_keys(spark.range(5).select(F.lit(None).cast("string").alias("k")), "k").count() == 0


def test_a_patient_of_many_members_is_dealt(spark, many_partitions):  # noqa: F811
    """Patients too: one account that a third of the members name."""
    rows = build_rows()
    rows["program_member"] += [_pm(i, member_mvn__c="PAT1" if i % 3 == 0 else None) for i in range(2000, 2600)]
    t = frames(spark, rows)
    m = t.program_member.select(F.col("id").alias("pm_id"), "member_mvn__c", F.col("physician_mvn__c").alias("__h_key"), *[
        F.lit(None).cast("string").alias(k) for k in ("__e_key", "__e1_key", "__e2_key", "__e3_key")])
    out = with_parties(m, party_dimension(t.account, t.contact_info))
    assert out.count() == m.count() and out.where("pe_id = 'PAT1'").count() == 201
    assert largest_share(out) < 0.15
