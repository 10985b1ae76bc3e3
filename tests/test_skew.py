"""Hot keys: one member holds a third of all coverages, one provider and one
site serve a third of the members, two thirds of the optional site keys are
NULL, and one account has a third of all contacts.  Every plan must return
the rows of the DuckDB formulation, and no task of a dealt join may get a hot
key's rows whole."""

import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bvengine.functions.cutoff import cutoff_literal
from bvengine.operators import dealt_join, exclude_unless_stale, hot_key_salt, with_member_flag
from bvengine.plans.extract import benefit_verification_extract, party_dimension, with_parties
from bvengine.plans.oracle_extract import extract_oracle_sql
from bvengine.sources.loader import DomainTables
from bvengine.sources.schemas import DOMAIN_SCHEMAS, OUTPUT_COLUMNS
from golden import AS_OF, CONFIG, PR, PT, ST, _acct, _bc, _contact, _pm, build_rows
from oracle import canon

N = 240


def skewed_rows():
    rows = build_rows()
    rows["account"] += [_acct("HOTDOC", PR, firstname="Hot", lastname="Doc", npi_vod__c="9999999999"),
                        _acct("HOTSITE", ST, name="Hot Site", type="Hospital (HOPD)")]
    for i in range(1000, 1000 + N):
        hot = i % 3 == 0
        rows["program_member"].append(_pm(
            i, physician_mvn__c="HOTDOC" if hot else "DOC1", site_of_care_mvn__c="HOTSITE" if hot else "SITE1",
            hzn_asoc_opt_1__c=None if i % 3 else "HOTSITE", hzn_asoc_opt_2__c=None, hzn_asoc_opt_3__c=None))
        rows["account"].append(_acct(f"PAT{i}", PT, firstname=f"F{i}", lastname=f"L{i}"))
        rows["contact_info"].append(_contact(f"CT{i}", f"PAT{i}"))
        rows["authorization_consent"] += [dict(program_member_mvn__c=f"PM{i}", status_mvn__c="Active", type_mvn__c=t)
                                          for t in ("HIPAA Authorization", "CNE/PAM Consent")]
        rows["benefits_coverage"].append(_bc(i))
    # the hot member: a third of all coverages
    for j in range(N // 2):
        rows["benefits_coverage"].append(_bc(1002, f"h{j}", hzn_plan_coverage_type__c="Commercial PPO"))
    # the hot account: a third of all contacts, one of them newest
    for j in range(N // 2):
        rows["contact_info"].append(_contact(f"CTH{j}", "HOTSITE", state_mvn__c="US-OH",
                                             lastmodifieddate=dt.datetime(2023, 1, 1) + dt.timedelta(hours=j)))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    frames = {n: spark.createDataFrame([tuple(r.get(f.name) for f in DOMAIN_SCHEMAS[n].fields) for r in rs],
                                       DOMAIN_SCHEMAS[n]) for n, rs in rows.items()}
    return rows, DomainTables.from_frames(frames)


def oracle_rows(rows, parity):
    con = duckdb.connect()
    for name, rs in rows.items():
        pdf = pd.DataFrame([{f.name: r.get(f.name) for f in DOMAIN_SCHEMAS[name].fields} for r in rs],
                           columns=[f.name for f in DOMAIN_SCHEMAS[name].fields])
        con.register(f"{name}_src", pdf)
        casts = ", ".join(
            f'CAST("{f.name}" AS {"INTEGER" if f.dataType.typeName() == "integer" else "DATE" if f.dataType.typeName() == "date" else "TIMESTAMP" if "timestamp" in f.dataType.typeName() else "VARCHAR"}) AS "{f.name}"'
            for f in DOMAIN_SCHEMAS[name].fields)
        con.execute(f"CREATE TABLE {name} AS SELECT {casts} FROM {name}_src")
    cur = con.execute(extract_oracle_sql(AS_OF, CONFIG.with_(parity=parity), standins=False))
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("parity", ["repaired", "intent", "as_written"])
def test_skewed_plans_agree_with_oracle(spark, skewed, parity):
    rows, t = skewed
    cfg = CONFIG.with_(parity=parity)
    cols, expected = oracle_rows(rows, parity)
    want = canon(cols, expected)
    for options in ({}, {"join_hint": "merge"}, {"reduce_by_members": True}):
        df = benefit_verification_extract(t, AS_OF, cfg, **options)
        df = df.withColumn("Member Date of Birth", df["`Member Date of Birth`"].cast("string"))
        got = canon(df.columns, [tuple(r) for r in df.collect()])
        assert got == want, (parity, options, len(got), len(want))
    hot = [r for r in expected if r[cols.index("PM Veeva ID")] == "PM1002"]
    assert len(hot) == N // 2 + 1   # every coverage of the hot member survives


@pytest.fixture
def many_partitions(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_share(df) -> float:
    """Of the rows of ``df``, the share that its largest partition holds."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_no_task_gets_a_hot_key_whole(spark, many_partitions):
    """Without AQE: a third of the rows hold one payer, a third none."""
    left = spark.range(6000).select(F.col("id").cast("string").alias("bc_id"), F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("P"), F.col("id") % 50)).alias("payer"))
    dim = spark.createDataFrame([(f"P{i}", i) for i in range(50)] + [("HOT", -1)], "name string, v int")
    plain = left.join(dim, left["payer"] == dim["name"], "left")
    dealt = dealt_join(left, dim, "payer", "name", "left", by=["bc_id"])
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    assert largest_share(plain) > 0.3 and largest_share(dealt) < 0.1
    flagged = with_member_flag(left, "payer", dim, "name", "known")
    assert flagged.where("known").count() == 4000 and largest_share(flagged.where("payer is null")) < 0.15


def test_parties_of_a_hot_site_are_dealt(spark, skewed, many_partitions):
    _, t = skewed
    m = t.program_member.select(F.col("id").alias("pm_id"), "member_mvn__c", *[
        F.col(c).alias(k) for c, k in (("physician_mvn__c", "__h_key"), ("site_of_care_mvn__c", "__e_key"), ("hzn_asoc_opt_1__c", "__e1_key"),
                                       ("hzn_asoc_opt_2__c", "__e2_key"), ("hzn_asoc_opt_3__c", "__e3_key"))])
    out = with_parties(m, party_dimension(t.account, t.contact_info))
    assert out.count() == m.count()
    assert largest_share(out.where("h_lastname = 'Doc'")) < 0.2
    assert out.where("e_name = 'Hot Site' and e_state_mvn__c = 'US-OH'").count() == N // 3


def test_unnamed_tasks_are_dealt(spark, many_partitions):
    x = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 2 == 0, " ").otherwise(F.concat(F.lit("C"), F.col("id"))).alias("task"))
    x = x.withColumn("s", hot_key_salt("task", " ", ["id"]))
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2)
    log = spark.createDataFrame([("C1", new), ("C3", old), (" ", old)], "k string, at timestamp_ntz")
    free = exclude_unless_stale(x, "task", log, "k", "at", cutoff_literal(AS_OF), hot_key=" ", salt="s")
    assert free.count() == 2999 and largest_share(free) < 0.15
    log = log.unionAll(spark.createDataFrame([(" ", new)], log.schema))
    assert exclude_unless_stale(x, "task", log, "k", "at", cutoff_literal(AS_OF), hot_key=" ", salt="s").count() == 1499
    with pytest.raises(ValueError):
        exclude_unless_stale(x, "task", log, "k", "at", cutoff_literal(AS_OF), hot_key=" ")


def test_output_columns_are_the_76(skewed):
    assert len(OUTPUT_COLUMNS) == 76
