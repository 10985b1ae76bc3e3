"""BR-26: the benefit-verification work list (76 columns) as one lazy plan.

The plan has two levels.  Member-level work runs on one row per program
member; only then are members joined to their coverages (about ten per
member), so the wide coverage rows are shuffled as few times as possible.
Nothing runs while the plan is built, and no size decides its shape: Spark
picks broadcasts from bytes at run time.  Accounts that hold more member roles
than an average shuffle partition are found by one narrow aggregation inside
the plan, and only these are repeated and their members dealt; payers and the
unnamed task are always dealt over many tasks.

member level
  1. program members cut to the programs / Pending / Benefits Investigation;
  2. LEFT SEMI to members holding both Active consents (one aggregation);
  3. the six party roles in long form (member, role, account): one join with
     the accounts and their latest primary contact (one window), one pivot
     back per member, with a row per combination where ids repeat; NULL keys
     never enter it;
  4. the per-member coverage summary (the eight ``IN`` lists of the source
     as one aggregation);
coverage level
  5. Active coverages with a payer name and subscriber id, LEFT payer map,
     resolved payer id and its gate;
  6. members x coverages on the member id, govt flag, segment filter;
  7. LEFT ANTI the blocked task ids of both submission logs;
  8. the 76 output expressions, DISTINCT in the partitions of the anti joins,
     deterministic cap.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import RULES, Rules, RulesConfig
from ..functions.cutoff import cutoff_literal
from ..operators.gates import exclude_unless_stale, hot_key_salt, log_state, merge_log_state
from ..operators.joins import SALTS, dealt_join, hot_keys, repeated, with_shares
from ..operators.limit import top_distinct
from ..operators.membership import attach_flags
from ..sources.loader import DomainTables
from ..sources.schemas import OUTPUT_COLUMNS
from . import rules as R

CONTACT_COLS = ("address_line_1_mvn__c", "address_line_2_mvn__c", "city_mvn__c", "state_mvn__c", "zip_mvn__c")
NPI_COLS = ("hzn_npi_facility__c", "hzn_npi_primary_hcp__c", "hzn_npi_secondary__c", "hzn_npi_tertiary__c",
            "npi_vod__c")
SITE_COLS = ("id", "name", "formatted_name_vod__c", "type", *NPI_COLS, "hzn_tax_id__c", *CONTACT_COLS)
PATIENT_COLS = ("id", "firstname", "lastname", *CONTACT_COLS)
PROVIDER_COLS = ("id", "firstname", "lastname", "npi_vod__c", "hzn_tax_id__c", *CONTACT_COLS)


# Output prefix, key column of the member row, kind of account, columns used.
ROLES = (
    ("pe_", "member_mvn__c", "patient", PATIENT_COLS),
    ("h_", "__h_key", "provider", PROVIDER_COLS),
    ("e_", "__e_key", "site", SITE_COLS),
    ("e1_", "__e1_key", "site", SITE_COLS),
    ("e2_", "__e2_key", "site", SITE_COLS),
    ("e3_", "__e3_key", "site", SITE_COLS),
)
# A task id without either name: many coverages may share it.
UNNAMED_TASK = " "


def party_dimension(account: DataFrame, contact_info: DataFrame, cfg: Rules = RULES, hint: str | None = None) -> DataFrame:
    """Patients, providers and sites (``kind``) with their latest primary contact."""
    rt = F.col("recordtypeid")
    kind = (
        F.when(rt == F.lit(cfg.patient_record_type), "patient")
        .when(rt == F.lit(cfg.provider_record_type), "provider")
        .when(rt.isin(*cfg.site_record_types), "site")
    )
    contact = R.primary_contact(contact_info, cfg).select("account_mvn__c", *CONTACT_COLS)
    contact = contact.hint(hint) if hint else contact
    acct = account.filter(rt.isin(cfg.patient_record_type, cfg.provider_record_type, *cfg.site_record_types))
    return acct.withColumn("kind", kind).join(contact, F.col("id") == F.col("account_mvn__c"), "left").drop("account_mvn__c")


def role_keys(m: DataFrame, member_id: str = "pm_id", roles=ROLES) -> DataFrame:
    """One row (member, role, kind, key) per role whose key is not NULL."""
    entries = F.array(*[F.struct(F.lit(p).alias("role"), F.lit(kind).alias("kind"), F.col(k).alias("key")) for p, k, kind, _ in roles])
    return m.select(member_id, F.explode(F.filter(entries, lambda e: e["key"].isNotNull())).alias("e")).select(member_id, "e.*")


def with_parties(
    m: DataFrame, party: DataFrame, member_id: str = "pm_id", roles=ROLES, hint: str | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """``m`` with each role's account columns, prefixed; NULL where the role's
    key is NULL or names no account of the role's kind.

    As in the chain of joins that this stands for, a key that names several
    accounts of its kind gives a row for each, several roles all their
    combinations, and every row of ``m`` is one of its own, also where
    ``member_id`` repeats.  Accounts that are equal in every used column count
    once (the statement is a DISTINCT).

    The role keys are joined in long form, so accounts and contacts are read,
    ranked and shuffled once for all roles.  Accounts of hot keys (``hot``,
    default the ``hot_keys`` of these roles) are repeated and their members
    dealt over the copies; any other account row is shuffled once.
    """
    long = role_keys(m, member_id, roles)
    hot = hot_keys(long, "key") if hot is None else hot
    by = [member_id, "role"]
    long = with_shares(long, "key", hot, by, hint).withColumn("salt", F.pmod(F.xxhash64(*by), F.col("__shares"))).drop("__shares")
    wanted = list(dict.fromkeys(c for _, _, _, cols in roles for c in cols))
    side = repeated(party.select("kind", *wanted), "id", hot, "copy", hint).withColumnRenamed("kind", "of_kind")
    side = side.hint(hint) if hint else side
    on = (F.col("key") == F.col("id")) & (F.col("kind") == F.col("of_kind")) & (F.col("salt") == F.col("copy"))
    found = long.join(side, on).select(member_id, "role", "key", F.struct(*wanted).alias("party"))
    found = found.groupBy(F.col(member_id).alias("__pm")).agg(F.array_distinct(F.collect_list(F.struct("role", "key", "party"))).alias("__parties"))
    found = found.hint(hint) if hint else found
    out = m.join(found, F.col(member_id) == F.col("__pm"), "left")

    def of(role: str, key: str) -> Column:
        return F.filter("__parties", lambda x: (x["role"] == F.lit(role)) & (x["key"] == F.col(key)))

    out = out.withColumns({f"__{p}": of(p, k) for p, k, _, _ in roles})
    # the combinations, numbered: one in all but a few rows
    size = {p: F.greatest(F.coalesce(F.size(f"__{p}"), F.lit(1)), F.lit(1)) for p, *_ in roles}
    ways = F.lit(1)
    for p, *_ in roles:
        ways = ways * size[p]
    out = out.withColumn("__way", F.explode(F.sequence(F.lit(0), ways - 1)))
    step, picked = F.lit(1), {}
    for p, *_ in roles:
        picked[f"__{p}"] = F.get(f"__{p}", F.pmod(F.floor(F.col("__way") / step).cast("int"), size[p]))["party"]
        step = step * size[p]
    out = out.withColumns(picked)
    out = out.withColumns({f"{p}{c}": F.col(f"__{p}")[c] for p, _, _, cols in roles for c in cols})
    return out.drop("__pm", "__parties", "__way", *[f"__{p}" for p, *_ in roles])


def _party_block(p: str, pbi: Column | None = None) -> list[Column]:
    def g(c: Column) -> Column:
        return c if pbi is None else F.when(pbi, c)

    return [
        g(F.col(f"{p}address_line_1_mvn__c")),
        g(F.col(f"{p}address_line_2_mvn__c")),
        g(F.col(f"{p}city_mvn__c")),
        g(R.state_code(f"{p}state_mvn__c")),
        g(R.zip_code(f"{p}zip_mvn__c")).cast("string"),
    ]


def _site_block(p: str, pbi: Column | None = None) -> list[Column]:
    def g(c: Column) -> Column:
        return c if pbi is None else F.when(pbi, c)

    return [
        g(R.party_name(f"{p}name", f"{p}formatted_name_vod__c")),
        g(R.npi10(*[f"{p}{c}" for c in NPI_COLS])),
        g(R.tax9(f"{p}hzn_tax_id__c")),
    ] + _party_block(p, pbi)


def output_columns(cfg: Rules = RULES) -> list[Column]:
    """The 76 output expressions over the joined row, in output order."""
    pbi = R.pending_bi("pm_status", "pm_reason", cfg)
    d1, d2, d3 = R.diagnosis_codes(
        "pm_program", "hzn_kxx_primary_diagnosis__c", "hzn_primary_diagnosis__c",
        "hzn_other_primary_diagnosis__c", "hzn_secondary_dx_code__c",
    )
    exprs = (
        [
            F.col("task_id"),
            F.lit(C.PROGRAM_ID),
            R.facility_type("pm_status", "pm_reason", "pm_program", "e_type", cfg),
            F.col("pm_id"),
            F.col("pm_status"),
            F.col("pm_reason"),
            F.col("bc_id"),
            F.col("bc_status"),
            F.col("hzn_plan_coverage_type__c"),
            F.col("govt_flag").cast("int"),
            F.col("pe_firstname"),
            F.col("pe_lastname"),
            F.col("patient_birthdate_mvn__c"),
        ]
        + _party_block("pe_")
        + _site_block("e_")
        + _site_block("e1_", pbi)
        + _site_block("e2_", pbi)
        + _site_block("e3_", pbi)
        + [F.col("h_firstname"), F.col("h_lastname"), R.npi10("h_npi_vod__c"), R.tax9("h_hzn_tax_id__c")]
        + _party_block("h_")
        + [
            R.product_code("pm_program"),
            F.col("pm_program"),
            *[F.lit(c).cast("int") for c in C.CPT_CODES],
            d1,
            d2,
            d3,
            F.col("payer_id"),
            F.col("bc_payer"),
            F.col("payer_phone_mvn__c"),
            F.col("hzn_plan_member_id__c"),
            R.insurance_status("bc_tier"),
            F.col("plan_name_mvn__c"),
            F.lit(C.NETWORK_STATUS),
            F.lit(C.COLLECT_PHARMACY_BENEFITS),
        ]
    )
    assert len(exprs) == len(OUTPUT_COLUMNS)
    return [e.alias(n) for e, n in zip(exprs, OUTPUT_COLUMNS)]


class LogStates(NamedTuple):
    """Per task id, what the gates need of the rows of both submission logs."""

    outbound: DataFrame
    allcare: DataFrame


def outbound_sums() -> dict[str, Column]:
    return {"count_accepted": F.sum("is_accepted")}


def log_states(outbound_log: DataFrame, allcare_log: DataFrame, earlier: LogStates | None = None) -> LogStates:
    """The states of both logs; with ``earlier`` ones, of these and the given
    later rows together.  To be written as tables after a run, so that the next
    run reads a row per task and the rows that came since, not all history."""
    now = LogStates(
        log_state(outbound_log, "customer bv task id", "extraction_date", outbound_sums()),
        log_state(allcare_log, "customer bv task id", "extraction date"),
    )
    return now if earlier is None else LogStates(*[merge_log_state(a, b) for a, b in zip(earlier, now)])


def active_coverages(coverages: DataFrame, cfg: Rules = RULES) -> DataFrame:
    """Active coverages: what the coverage level and the member summary read."""
    return coverages.filter(F.col("status_mvn__c") == F.lit(cfg.active_status)).select(
        F.col("id").alias("bc_id"),
        F.col("name").alias("bc_name"),
        F.col("program_member_mvn__c").alias("bc_pm"),
        F.col("status_mvn__c").alias("bc_status"),
        "hzn_pm_id__c",
        "hzn_plan_coverage_type__c",
        R.tier("hzn_insurance_type__c", "coverage_type_mvn__c").alias("bc_tier"),
        R.payer_name("hzn_eblu_payer_name__c", "hzn_kry_payer_name__c").alias("bc_payer"),
        "hzn_plan_member_id__c", "payer_phone_mvn__c", "plan_name_mvn__c",
    )


def with_mapped_payer(bc: DataFrame, payer_mapping: DataFrame, hint: str | None = None) -> DataFrame:
    """LEFT payer map (a repeated payer name fans out, as in the source);
    coverages of a hot payer, or without one, are dealt."""
    hpm = payer_mapping.select(F.col("payer_name").alias("hpm_name"), F.col("infinitus_payer_id").alias("hpm_id"))
    return dealt_join(bc, hpm, "bc_payer", "hpm_name", "left", by=["bc_id"], salts=SALTS, hint=hint).drop("hpm_name")


def resolved_coverages(coverages: DataFrame, payer_mapping: DataFrame, cfg: Rules = RULES, hint: str | None = None) -> DataFrame:
    """Active coverages with their mapped payer id, to be written as a table
    that the extract reads in place of both inputs (``resolved``): the payer
    map is then joined once for the coverage level and the member summary, and
    the summary's second read is one of five columns.  Written with
    ``sources.write_bucketed`` on ``bc_pm``, the join with the members moves no
    coverage."""
    return with_mapped_payer(active_coverages(coverages, cfg), payer_mapping, hint)


def benefit_verification_extract(
    t: DomainTables,
    as_of: _dt.datetime,
    cfg: RulesConfig,
    join_hint: str | None = None,
    reduce_by_members: bool = False,
    states: LogStates | None = None,
    resolved: DataFrame | None = None,
) -> DataFrame:
    """The work list.  ``as_of`` replaces the server clock; ``cfg.cap=None``
    returns every distinct row.

    ``join_hint="merge"`` makes every join a shuffled one.
    ``reduce_by_members`` first cuts consents and coverages to the gated
    members by semi joins, and both logs to the task ids of their coverages,
    which pays where most members are not gated; the result is the same.
    With ``states`` (``log_states`` of the rows up to the last run) the logs of
    ``t`` hold only the rows that came since.  With ``resolved``
    (``resolved_coverages``, read back) coverages and payer map of ``t`` are
    not read.
    """
    outbound_state, allcare_state = states or (None, None)
    cutoff = cutoff_literal(as_of, cfg)

    def side(df: DataFrame) -> DataFrame:
        return df.hint(join_hint) if join_hint else df

    # ---- member level: one row per program member (x coverages later) ----
    # 1. driving table, cut first
    gated = t.program_member.filter(
        R.program_status_gate("program_name_mvn__c", "status_mvn__c", "status_reason_mvn__c", cfg)
    )
    role_key = {
        "__h_key": F.coalesce("physician_mvn__c", "enrolling_physician_mvn__c"),
        "__e_key": F.coalesce("hzn_updated_site_of_care__c", "site_of_care_mvn__c"),
        "__e1_key": F.col("hzn_asoc_opt_1__c"),
        "__e2_key": F.col("hzn_asoc_opt_2__c"),
        "__e3_key": F.col("hzn_asoc_opt_3__c"),
    }
    # hot sites and providers, counted over the gated members: a narrow scan
    hot = hot_keys(role_keys(gated.select(F.col("id").alias("pm_id"), "member_mvn__c", *[c.alias(n) for n, c in role_key.items()])), "key")
    consents = t.authorization_consent
    coverages = active_coverages(t.benefits_coverage, cfg) if resolved is None else resolved
    if reduce_by_members:
        ids = side(gated.select(F.col("id").alias("__rk")))
        consents = consents.join(ids, F.col("program_member_mvn__c") == F.col("__rk"), "left_semi")
        coverages = coverages.join(ids, F.col("bc_pm") == F.col("__rk"), "left_semi")
    m = gated.select(
        F.col("id").alias("pm_id"),
        F.col("name").alias("pm_name"),
        F.col("status_mvn__c").alias("pm_status"),
        F.col("status_reason_mvn__c").alias("pm_reason"),
        F.col("program_name_mvn__c").alias("pm_program"),
        "member_mvn__c", "patient_birthdate_mvn__c",
        *[c.alias(n) for n, c in role_key.items()],
        "hzn_kxx_primary_diagnosis__c", "hzn_primary_diagnosis__c",
        "hzn_other_primary_diagnosis__c", "hzn_secondary_dx_code__c",
    )

    # 2. both consents Active (a semi join: the consent row adds no column)
    consented = R.consented_members(consents, cfg).withColumnRenamed("program_member_mvn__c", "__consent_pm")
    m = m.join(side(consented), F.col("pm_id") == F.col("__consent_pm"), "left_semi")

    # 3. parties.  The member account is INNER, then the raw-state exclusion;
    #    the provider exclusion's three-valued NOT drops members without one.
    m = with_parties(m, party_dimension(t.account, t.contact_info, cfg, join_hint), hint=join_hint, hot=hot)
    m = m.filter(F.col("pe_id").isNotNull() & R.state_exclusion("pe_state_mvn__c", cfg))
    m = m.filter(R.provider_exclusion("h_firstname", "h_lastname", cfg.excluded_providers))

    # 4. member summary: the eight IN lists of the source as one aggregation
    if resolved is not None:
        summary = R.resolved_summary(resolved, cfg)
    else:
        active = t.benefits_coverage.filter(F.col("status_mvn__c") == F.lit(cfg.active_status))
        summary = R.coverage_summary(active, t.payer_mapping, cfg, join_hint)
    m = attach_flags(m, "pm_name", summary, "hzn_pm_id__c", R.SUMMARY_FLAGS, join_hint)

    # ---- coverage level ----
    # 5. Active coverages with a payer name and a subscriber id, payer map
    bc = coverages.filter(R.completeness_gate("bc_payer", "hzn_plan_member_id__c")).drop("hzn_pm_id__c")
    if resolved is None:
        bc = with_mapped_payer(bc, t.payer_mapping, join_hint)
    bc = bc.withColumn("payer_id", R.resolve_payer_id("hpm_id", "bc_payer")).filter(R.supported_payer("payer_id"))

    # 6. members x coverages (the one join between the two levels)
    x = m.join(side(bc), F.col("pm_id") == F.col("bc_pm"), "inner").drop("bc_pm")
    x = x.withColumn("task_id", R.task_id("bc_name", "pm_name")).withColumn(
        "govt_flag",
        R.other_tier_flag("hzn_plan_coverage_type__c", "bc_tier", "bc_status", "has_nc_primary", "has_nc_secondary", cfg),
    )
    x = x.filter(R.segment_filter("hzn_plan_coverage_type__c", "govt_flag", cfg))

    live = None
    if reduce_by_members:
        names = gated.select(F.col("id").alias("__rk"), F.col("name").alias("pm_name"))
        kept = coverages.select("bc_pm", "bc_name")
        live = kept.join(side(names), F.col("bc_pm") == F.col("__rk")).select(R.task_id("bc_name", "pm_name").alias("task_id"))

    # 7. submission logs: drop tasks already sent unless stale (and accepted);
    #    both anti joins share the partitioning by task id and salt.
    x = x.withColumn("__task_salt", hot_key_salt("task_id", UNNAMED_TASK, ["bc_id"]))
    x = exclude_unless_stale(
        x, "task_id", t.outbound_log, "customer bv task id", "extraction_date", cutoff,
        extra_aggs=outbound_sums(), extra_cond=F.col("count_accepted") > 0,
        hot_key=UNNAMED_TASK, salt="__task_salt", hint=join_hint, state=outbound_state, live=live,
    )
    x = exclude_unless_stale(x, "task_id", t.allcare_log, "customer bv task id", "extraction date", cutoff,
                             hot_key=UNNAMED_TASK, salt="__task_salt", hint=join_hint, state=allcare_state, live=live)

    # 8. project, DISTINCT, cap.  The salt follows from the task id and the
    #    coverage id, both output columns, and the rows lie by task id and salt
    #    since the anti joins: the DISTINCT needs no shuffle of its own.
    out = x.select(*output_columns(cfg), "__task_salt")
    return top_distinct(out, cfg.cap, order=["Customer BV Task ID"], along=["__task_salt"])
