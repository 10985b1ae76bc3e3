"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS].  Prints ONE JSON line.

The session first runs the flagship $BENCH_WARMUP times (default 3) to warm
the JVM; then each query runs once more to warm up and $BENCH_REPS times
(default 3; at least 5 for the flagship); the median is reported.  Execution is forced with the ``noop`` sink, so nothing
is collected to the driver and every stage (including the final DISTINCT
and cap) runs.  Besides the extract, the bench times the latest contact both
ways (filter next to the window, and all ranks joined and filtered late), the
member summary and the log gate.  Stored tables go to $BENCH_TABLES_DIR.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from bvengine.functions.cutoff import cutoff_literal  # noqa: E402
from bvengine.operators import attach_flags, exclude_unless_stale, row_number_desc  # noqa: E402
from bvengine.plans import rules as R  # noqa: E402
from bvengine.plans.checks import CHECKS  # noqa: E402
from bvengine.plans.extract import benefit_verification_extract  # noqa: E402
from bvengine.plans.standins import CHECK_AS_OF, CHECK_CONFIG, standin_tables  # noqa: E402
from bvengine.session import local_session  # noqa: E402
from bvengine.sources.loader import DomainTables  # noqa: E402
from bvengine.sources.schemas import DOMAIN_SCHEMAS  # noqa: E402


def timed(df_fn, reps: int) -> float:
    df_fn().write.format("noop").mode("overwrite").save()  # warm-up
    times = []
    for _ in range(reps):
        t0 = time.perf_counter()
        df_fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def late_latest(spark, t):
    """Every rank is joined, those above 1 are rejected afterwards (as q_latest_late_filter)."""
    c = t.contact_info.filter(
        (F.col("primary_mvn__c") == F.lit(1)) & (F.col("recordtypeid") == CHECK_CONFIG.contact_record_type)
        & F.col("zip_mvn__c").isNotNull())
    ranked = row_number_desc(c, "account_mvn__c", "lastmodifieddate", "id").select("account_mvn__c", "zip_mvn__c", "r")
    joined = t.account.join(ranked, t.account["id"] == ranked["account_mvn__c"], "left")
    return joined.filter(F.coalesce("r", F.lit(0)) <= 1).select("id", "zip_mvn__c")


def early_latest(spark, t):
    lc = R.primary_contact(t.contact_info).select("account_mvn__c", "zip_mvn__c")
    return t.account.join(lc, t.account["id"] == lc["account_mvn__c"], "left").select("id", "zip_mvn__c")


def members_summary(spark, t):
    active = t.benefits_coverage.filter(F.col("status_mvn__c") == "Active")
    s = R.coverage_summary(active, t.payer_mapping, CHECK_CONFIG)
    return attach_flags(t.program_member.select("id", "name"), "name", s, "hzn_pm_id__c", R.SUMMARY_FLAGS)


def _tasks(t):
    pm = t.program_member.select(F.col("id").alias("pm_id"), F.col("name").alias("pm_name"))
    bc = t.benefits_coverage.select(F.col("name").alias("bc_name"), "program_member_mvn__c")
    return bc.join(pm, bc["program_member_mvn__c"] == pm["pm_id"]).select(R.task_id("bc_name", "pm_name").alias("task"))


def log_anti(spark, t):
    return exclude_unless_stale(
        _tasks(t), "task", t.outbound_log, "customer bv task id", "extraction_date", cutoff_literal(CHECK_AS_OF),
        extra_aggs={"n": F.sum("is_accepted")}, extra_cond=F.col("n") > 0)


def stored_tables(spark, sf_dir: str, root: str) -> DomainTables:
    """The stand-in tables written once as Parquet (8 files each) below
    ``root``, as a deployment reads stored domain tables."""
    t = standin_tables(spark, sf_dir)
    paths = {}
    for name in DOMAIN_SCHEMAS:
        paths[name] = f"{root}/{name}"
        getattr(t, name).repartition(8).write.mode("overwrite").parquet(paths[name])
    return DomainTables.from_paths(spark, paths)


def exec_only(df, reps: int) -> float:
    return timed(lambda: df, reps)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, app="bvengine-bench", extra={"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    t = standin_tables(spark, sf_dir)
    # Warm the JVM (JIT, generated-code caches) before any timing: the first
    # query of a fresh session otherwise pays for it.
    for _ in range(int(os.environ.get("BENCH_WARMUP", "3"))):
        CHECKS["q_flagship"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    q = {}
    q["q_flagship"] = timed(lambda: CHECKS["q_flagship"][0](spark, sf_dir), max(reps, 5))
    q["q_extract_all"] = timed(lambda: CHECKS["q_extract_all"][0](spark, sf_dir), reps)
    # timed as q_extract_all is, stand-ins and plan included; no side is broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    q["q_extract_forced_shuffle"] = timed(lambda: CHECKS["q_extract_forced_shuffle"][0](spark, sf_dir), reps)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    q["latest_contact_early_filter"] = timed(lambda: early_latest(spark, t), reps)
    q["latest_contact_late_filter"] = timed(lambda: late_latest(spark, t), reps)
    q["member_flags_summary"] = timed(lambda: members_summary(spark, t), reps)
    q["log_gate_left_anti"] = timed(lambda: log_anti(spark, t), reps)
    root = os.environ.get("BENCH_TABLES_DIR") or tempfile.mkdtemp(prefix="bvengine-bench-")
    stored = stored_tables(spark, sf_dir, root)
    capped = CHECK_CONFIG.with_(cap=1024)
    q["extract_stored_tables"] = timed(lambda: benefit_verification_extract(stored, CHECK_AS_OF, capped), reps)
    q["extract_stored_tables_exec_only"] = exec_only(
        benefit_verification_extract(stored, CHECK_AS_OF, capped), reps)
    q["extract_stored_tables_member_reduction"] = timed(
        lambda: benefit_verification_extract(stored, CHECK_AS_OF, capped, reduce_by_members=True), reps)
    for name in ("q_role_join", "q_segment_conflict", "q_repull_gates", "q_primary_contact"):
        q[name] = timed(lambda n=name: CHECKS[n][0](spark, sf_dir), reps)
    print(json.dumps({
        "metric": "q_flagship_median_sec",
        "value": q["q_flagship"],
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "reps": reps,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))


if __name__ == "__main__":
    main()
