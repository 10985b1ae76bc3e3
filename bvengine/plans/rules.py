"""Business rules of the extract, as Column functions and DataFrame transforms.

Each rule takes column names (or Columns) so it can be applied to any table
that carries the fields, and every constant comes from ``RulesConfig`` or
the fixed values in ``bvengine.config``.  Three-valued logic is kept as the
source statement has it: ``NOT (a AND b)`` on a NULL stays unknown and drops
the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import RULES, Rules, RulesConfig
from ..functions.exprs import (
    col,
    contains_any,
    contains_none,
    digits_fixed,
    first_non_null,
    flag01,
    null_safe_concat,
    ordered_case,
    strip_text,
    zip5,
)
from ..operators.aggregate import has_all
from ..operators.joins import SALTS, dealt_join
from ..operators.membership import member_summary
from ..operators.window import latest_per_key


def null_str() -> Column:
    return F.lit(None).cast("string")


# BR-1
def task_id(coverage_name, member_name) -> Column:
    """``Concat(bc.NAME, ' ', pm.NAME)``: NULL parts count as ''."""
    return null_safe_concat(coverage_name, F.lit(" "), member_name)


def pending_bi(status, reason, cfg: Rules = RULES) -> Column:
    return (col(status) == F.lit(cfg.pending_status)) & (col(reason) == F.lit(cfg.pending_reason))


# BR-2
def facility_type(status, reason, program, site_type, cfg: Rules = RULES) -> Column:
    """Ordered facility-type rules; the first TRUE branch wins.

    Pending + Benefits Investigation decide by program.  Otherwise
    (``NOT (Pending AND BI)``, which is unknown when a status field is NULL
    and the other does not settle it) the site type decides, then the
    program, else NULL.
    """
    pbi = pending_bi(status, reason, cfg)
    prog = col(program)
    site = col(site_type)
    branches = [(pbi & (prog == F.lit(p)), v) for p, v in C.PROGRAM_FACILITY]
    branches += [(~pbi & site.contains(pat), v) for pat, v in C.SITE_TYPE_FACILITY]
    fallback = ordered_case([(prog == F.lit(p), v) for p, v in C.PROGRAM_FACILITY])
    return ordered_case(branches, otherwise=fallback)


def tier(insurance_type, coverage_type) -> Column:
    """The coverage's tier: ``COALESCE(insurance type, coverage type)``."""
    return first_non_null(insurance_type, coverage_type)


def plan_is_commercial(plan_type) -> Column:
    """``ISNULL(plan type, 'Commercial') LIKE '%Commercial%'``."""
    return F.coalesce(col(plan_type), F.lit(C.COMMERCIAL)).contains(C.COMMERCIAL)


def plan_is_noncommercial(plan_type) -> Column:
    """``plan type NOT LIKE '%Commercial%' OR plan type IS NULL``."""
    pt = col(plan_type)
    return (~pt.contains(C.COMMERCIAL)) | pt.isNull()


# BR-3
def other_tier_flag(
    plan_type, tier_col, coverage_status, has_nc_primary, has_nc_secondary, cfg: RulesConfig
) -> Column:
    """1 if this (commercial) coverage is Secondary while the member has an
    active non-commercial Primary, or Primary with a non-commercial
    Secondary; else 0.  Under ``parity="as_written"`` it is always 0."""
    if cfg.parity == "as_written":
        return F.lit(0)
    base = plan_is_commercial(plan_type) & (col(coverage_status) == F.lit(cfg.active_status))
    t = col(tier_col)
    cond = (base & (t == F.lit(C.SECONDARY)) & col(has_nc_primary)) | (
        base & (t == F.lit(C.PRIMARY)) & col(has_nc_secondary)
    )
    return flag01(cond)


# BR-4 .. BR-8
def zip_code(zip_col) -> Column:
    return zip5(zip_col)


def npi10(*npi_cols) -> Column:
    """First non-NULL NPI candidate, kept iff it has exactly 10 digits."""
    return digits_fixed(first_non_null(*npi_cols), 10)


def tax9(tax_col) -> Column:
    return digits_fixed(tax_col, 9)


def state_code(state_col) -> Column:
    return strip_text(state_col, C.STATE_PREFIX)


def party_name(name_col, formatted_col) -> Column:
    return first_non_null(name_col, formatted_col)


# BR-10
def product_code(program) -> Column:
    prog = col(program)
    return ordered_case([(prog == F.lit(p), v) for p, v in C.PRODUCT_CODES], otherwise=C.PRODUCT_CODE_DEFAULT)


# BR-11
def diagnosis_codes(program, kxx, prim, other, secondary) -> tuple[Column, Column, Column]:
    """The three diagnosis slots (first TRUE case wins, see README)."""
    prog, k, p, o, s = (col(x) for x in (program, kxx, prim, other, secondary))
    is_kxx = prog.isin(C.KRYSTEXXA)
    c1 = is_kxx & (k == F.lit(C.DIAGNOSIS_OTHER))
    c2 = is_kxx & (k != F.lit(C.DIAGNOSIS_OTHER))
    c3 = (~prog.isin(C.KRYSTEXXA)) & (p == F.lit(C.DIAGNOSIS_OTHER))
    d1 = ordered_case([(c1, o), (c2, k), (c3, o)], otherwise=p)
    d2 = ordered_case([(c1, s), (c2, o), (c3, s)], otherwise=o)
    d3 = ordered_case([(c1, null_str()), (c2, s), (c3, null_str())], otherwise=s)
    return d1, d2, d3


# BR-12
def payer_name(eblu, kry) -> Column:
    return first_non_null(eblu, kry)


# BR-13
def resolve_payer_id(
    mapped_id,
    payer,
    patterns=C.BLUES_PATTERNS,
    fallback_id: str = C.BLUES_FALLBACK_PAYER_ID,
    not_supported: str = C.PAYER_NOT_SUPPORTED,
) -> Column:
    """Mapped payer id, or the not-supported text; unmapped payers whose
    name contains one of ``patterns`` (the Blues plans) get ``fallback_id``."""
    dflt = F.coalesce(col(mapped_id), F.lit(not_supported))
    fallback = dflt.contains(not_supported) & contains_any(payer, patterns)
    return F.when(fallback, F.lit(fallback_id)).otherwise(dflt)


# BR-14
def supported_payer(resolved_id, not_supported: str = C.PAYER_NOT_SUPPORTED) -> Column:
    return ~col(resolved_id).contains(not_supported)


def unsupported_non_blues(mapped_id, payer) -> Column:
    """``ISNULL(id, default) = default AND payer NOT LIKE each Blues pattern``."""
    return (F.coalesce(col(mapped_id), F.lit(C.PAYER_NOT_SUPPORTED)) == F.lit(C.PAYER_NOT_SUPPORTED)) & contains_none(
        payer, C.BLUES_PATTERNS
    )


# BR-15
def insurance_status(tier_col) -> Column:
    t = col(tier_col)
    return ordered_case([(t.contains(k), v) for k, v in C.INSURANCE_STATUS], otherwise=C.INSURANCE_STATUS_UNKNOWN)


# BR-16
def consented_members(consent: DataFrame, cfg: Rules = RULES) -> DataFrame:
    """Members holding an Active row of every required consent type."""
    return has_all(
        consent,
        key="program_member_mvn__c",
        value_col="type_mvn__c",
        required=cfg.consent_types,
        where=F.col("status_mvn__c") == F.lit(cfg.active_status),
    )


# BR-17
def primary_contact(contact: DataFrame, cfg: Rules = RULES) -> DataFrame:
    """The newest primary contact of the contact record type with a zip, per
    account (ties broken by contact id).  Contacts without an account can
    never be joined and are dropped before the shuffle."""
    src = contact.filter(
        (F.col("primary_mvn__c") == F.lit(1))
        & (F.col("recordtypeid") == F.lit(cfg.contact_record_type))
        & F.col("zip_mvn__c").isNotNull()
        & F.col("account_mvn__c").isNotNull()
    )
    return latest_per_key(src, "account_mvn__c", "lastmodifieddate", tiebreak="id")


# SUM-1: the eight membership lists as one summary
SUMMARY_FLAGS = ("has_nc_primary", "has_nc_secondary", "has_not_ma_ffs", "has_not_mm_ffs", "has_ffs_conflict",
                 "has_comm_conflict")


def coverage_summary(
    active_coverage: DataFrame, payer_map: DataFrame | None, cfg: RulesConfig, hint: str | None = None
) -> DataFrame:
    """Per ``hzn_pm_id__c`` over Active coverages, one flag per membership list.

    ``active_coverage`` needs ``hzn_pm_id__c``, the plan type, both tier
    columns and both payer-name columns.  Under ``intent`` the FFS and
    commercial lists test the payer map, so it is joined first (duplicates
    from a repeated payer name are harmless to ``bool_or``); hot and NULL
    payer names are dealt over many tasks.
    """
    src = active_coverage.withColumn("__tier", tier("hzn_insurance_type__c", "coverage_type_mvn__c"))
    gap = None
    if cfg.parity == "intent":
        if payer_map is None:
            raise ValueError("parity='intent' needs the payer map")
        m = payer_map.select(F.col("payer_name").alias("__pn"), F.col("infinitus_payer_id").alias("__pid"))
        src = src.withColumn("__payer", payer_name("hzn_eblu_payer_name__c", "hzn_kry_payer_name__c"))
        src = dealt_join(src, m, "__payer", "__pn", "left", salts=SALTS, hint=hint)
        gap = unsupported_non_blues("__pid", "__payer")
    return member_summary(src, "hzn_pm_id__c", summary_conditions("hzn_plan_coverage_type__c", "__tier", gap))


def summary_conditions(plan_type, tier_col, gap: Column | None = None) -> dict[str, Column]:
    """The condition of each membership list on a coverage.  ``gap`` is the
    payer test of the FFS and commercial lists; without it they hold every
    active coverage."""
    pt, t = col(plan_type), col(tier_col)
    ffs = comm = F.lit(True)
    if gap is not None:
        ffs, comm = (~pt.isin(*C.SEGMENT_TYPES)) | (pt.isin(*C.SEGMENT_TYPES) & gap), gap
    return {
        "has_nc_primary": plan_is_noncommercial(pt) & (t == F.lit(C.PRIMARY)),
        "has_nc_secondary": plan_is_noncommercial(pt) & (t == F.lit(C.SECONDARY)),
        "has_not_ma_ffs": ~pt.isin(C.MEDICARE_ADVANTAGE, C.MEDICARE_FFS),
        "has_not_mm_ffs": ~pt.isin(C.MANAGED_MEDICAID, C.MEDICARE_FFS),
        "has_ffs_conflict": ffs,
        "has_comm_conflict": comm,
    }


def resolved_summary(resolved: DataFrame, cfg: RulesConfig) -> DataFrame:
    """``coverage_summary`` over coverages that carry their mapped payer id
    (``plans.extract.resolved_coverages``): no join, five narrow columns."""
    gap = unsupported_non_blues("hpm_id", "bc_payer") if cfg.parity == "intent" else None
    return member_summary(resolved, "hzn_pm_id__c", summary_conditions("hzn_plan_coverage_type__c", "bc_tier", gap))


# BR-21
def segment_filter(plan_type, flag, cfg: RulesConfig, summary_cols: dict[str, str] | None = None) -> Column:
    """Keep a coverage row iff A or B.

    A: the plan type (NULL = commercial) is commercial and the flag is 0.
    B: the plan type is one of the six listed and none of its conflicts
    holds (MA / MM: another active type; FFS and commercial-like: the FFS
    and commercial lists).
    """
    s = dict(zip(SUMMARY_FLAGS, SUMMARY_FLAGS), **(summary_cols or {}))
    pt = col(plan_type)
    a = plan_is_commercial(pt) & (col(flag) == F.lit(0))
    if cfg.parity == "as_written":
        ma = mm = F.lit(False)
    else:
        ma, mm = col(s["has_not_ma_ffs"]), col(s["has_not_mm_ffs"])
    conflict = (
        (pt.isin(C.MEDICARE_ADVANTAGE) & ma)
        | (pt.isin(C.MANAGED_MEDICAID) & mm)
        | (pt.isin(C.MEDICARE_FFS) & col(s["has_ffs_conflict"]))
        | (pt.isin(*C.COMMERCIAL_LIKE_TYPES) & col(s["has_comm_conflict"]))
    )
    b = pt.isin(*C.SEGMENT_TYPES) & (flag01(conflict) == F.lit(0))
    return a | b


# BR-22
def completeness_gate(payer, plan_member_id) -> Column:
    return ~(col(payer).isNull() | col(plan_member_id).isNull())


# BR-23
def provider_exclusion(first, last, excluded) -> Column:
    """``NOT (first = X AND last = Y)`` for each pair in ``excluded``: unknown
    (no provider, or a NULL name that cannot rule the pair out) drops the
    row, as written."""
    keep = F.lit(True)
    for fx, lx in excluded:
        keep = keep & ~((col(first) == F.lit(fx)) & (col(last) == F.lit(lx)))
    return keep


# BR-24
def state_exclusion(raw_state, cfg: Rules = RULES) -> Column:
    """Raw contact state ``<> 'CA'`` (before the ``US-`` strip); NULL drops."""
    return col(raw_state) != F.lit(cfg.excluded_state)


# BR-25
def program_status_gate(program, status, reason, cfg: Rules = RULES) -> Column:
    return col(program).isin(*cfg.programs) & pending_bi(status, reason, cfg)

