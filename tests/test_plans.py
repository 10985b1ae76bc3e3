"""Plan-shape tests: what Catalyst makes of the extract."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from bvengine.plans import rules as R
from bvengine.plans.extract import benefit_verification_extract
from bvengine.sources.loader import DomainTables, SchemaError, load
from bvengine.sources.schemas import DOMAIN_SCHEMAS
from golden import AS_OF, CONFIG, golden_tables


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def parquet_tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    t = golden_tables(spark)
    paths = {}
    for name in DOMAIN_SCHEMAS:
        p = str(root / name)
        getattr(t, name).write.parquet(p)
        paths[name] = p
    return DomainTables.from_paths(spark, paths)


def test_latest_contact_uses_window_group_limit(spark, parquet_tables):
    txt = plan_text(R.primary_contact(parquet_tables.contact_info))
    assert "WindowGroupLimit" in txt


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extract_is_native_and_capped_by_a_top_n(parquet_tables):
    txt = plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG.with_(cap=1024)))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "Cartesian", "NestedLoop"):
        assert node not in txt
    assert "TakeOrderedAndProject" in txt
    # the eight IN lists are one aggregation + LEFT JOIN, not existence joins
    assert "ExistenceJoin" not in txt


def test_building_the_plan_runs_no_job(spark, parquet_tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-building", "")
    try:
        benefit_verification_extract(parquet_tables, AS_OF, CONFIG)
        assert list(tracker.getJobIdsForGroup("plan-building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_contacts_are_ranked_once_and_accounts_read_once(parquet_tables, no_broadcast):
    txt = plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG), "simple")
    final = txt.split("== Physical Plan ==")[1]
    assert final.count("+- Window [row_number()") == 1, final
    assert final.count("/contact_info]") == 1 and final.count("/account]") == 1


def test_merge_hint_leaves_no_broadcast(parquet_tables):
    txt = plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG, join_hint="merge"), "simple")
    assert "BroadcastHashJoin" not in txt and "SortMergeJoin" in txt
    df = benefit_verification_extract(parquet_tables, AS_OF, CONFIG, join_hint="merge")
    df.collect()
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cap", [None, 10])
def test_distinct_shuffles_no_row_of_the_list(parquet_tables, cap):
    """The DISTINCT runs in the partitions of the anti joins on the task id;
    a cap adds only the merge of each task's first rows."""
    df = benefit_verification_extract(parquet_tables, AS_OF, CONFIG.with_(cap=cap), join_hint="merge")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = final[: final.index("SortMergeJoin")]  # down to the anti joins
    assert "Aggregate(keys=" in above and "Exchange hashpartitioning" not in above
    assert ("TakeOrderedAndProject" in final) == (cap is not None)


def test_distinct_along_a_partitioning(spark, no_broadcast):
    """Equal rows lie in one task already: one Exchange fewer, the same rows."""
    from bvengine.operators import top_distinct

    df = spark.range(2000).select(F.pmod("id", F.lit(37)).alias("k"), F.pmod("id", F.lit(3)).cast("string").alias("v"))
    df = df.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(4))).repartition("k", "salt")
    plain, along = top_distinct(df.drop("salt"), 50, ["v"]), top_distinct(df, 50, ["v"], along=["salt"])
    assert along.columns == ["k", "v"] and along.collect() == plain.collect() and len(along.collect()) == 50
    shuffles = [plan_text(x, "simple").split("== Initial Plan ==")[0].count("Exchange") for x in (along, plain)]
    assert shuffles == [1, 2]
    assert sorted(top_distinct(df, None, along=["salt"]).collect()) == sorted(df.drop("salt").distinct().collect())


def test_filters_reach_the_scan(parquet_tables):
    txt = plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG))
    # the program / status gate is pushed into the program-member scan
    pushed = [x for x in txt.splitlines() if x.startswith("PushedFilters") and "program_name_mvn__c" in x]
    assert len(pushed) >= 1  # the gated members, and their ids for a runtime filter
    assert "In(program_name_mvn__c" in pushed[0] and "EqualTo(status_mvn__c,Pending)" in pushed[0]
    assert "EqualTo(status_reason_mvn__c,Benefits Investigation)" in pushed[0]


def test_load_rejects_missing_columns(spark, tmp_path):
    p = str(tmp_path / "pm")
    spark.createDataFrame([("1",)], "id string").write.parquet(p)
    with pytest.raises(SchemaError):
        load(spark, "program_member", path=p)


def test_load_casts_and_prunes(spark, tmp_path):
    p = str(tmp_path / "hpm")
    spark.createDataFrame([("A", "1", "extra")], "PAYER_NAME string, infinitus_payer_id string, junk string") \
        .write.parquet(p)
    df = load(spark, "payer_mapping", path=p)
    assert df.columns == ["payer_name", "infinitus_payer_id"]
    assert df.filter(F.col("payer_name") == "A").count() == 1


def test_member_reduction_adds_semi_joins(parquet_tables):
    on, off = (plan_text(benefit_verification_extract(parquet_tables, AS_OF, CONFIG, reduce_by_members=x)) for x in (True, False))
    assert on.count("LeftSemi") > off.count("LeftSemi")


def test_instants_need_a_time_zone(spark):
    import datetime as dt

    from bvengine.sources.loader import conform

    schema = DOMAIN_SCHEMAS["allcare_log"]
    was = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            df = spark.sql("SELECT 't' AS `customer bv task id`, timestamp_micros(s) AS `extraction date` "
                           "FROM VALUES (1706961600000000), (1720440000123456), (CAST(NULL AS BIGINT)), (-86400000000) AS t(s)")
            with pytest.raises(SchemaError):
                conform(df, schema)
            got = [r[1] for r in conform(df, schema, time_zone="America/Chicago").collect()]
            assert got == [dt.datetime(2024, 2, 3, 6), dt.datetime(2024, 7, 8, 7, 0, 0, 123456), None, dt.datetime(1969, 12, 30, 18)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_flags_stay_integers(spark):
    from bvengine.sources.loader import conform

    df = spark.createDataFrame([(None, None, v) for v in (0, 1, 2, -1, None)], "`customer bv task id` string, extraction_date timestamp_ntz, is_accepted int")
    assert [r[2] for r in conform(df, DOMAIN_SCHEMAS["outbound_log"]).collect()] == [0, 1, 2, -1, None]
    bits = spark.createDataFrame([(None, None, v) for v in (True, False, None)], "`customer bv task id` string, extraction_date timestamp_ntz, is_accepted boolean")
    assert [r[2] for r in conform(bits, DOMAIN_SCHEMAS["outbound_log"]).collect()] == [1, 0, None]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_driver_schemas_match_the_files(spark, sf):
    import os

    from bvengine.sources.schemas import DRIVER_SCHEMAS

    root = f"/root/testdata/{sf}"
    if not os.path.isdir(root):
        pytest.skip("no test data")
    for name, schema in DRIVER_SCHEMAS.items():
        inferred = spark.read.parquet(f"{root}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in inferred.fields] == [(f.name, f.dataType) for f in schema.fields], name
