"""Rule constants and run parameters for the benefit-verification extract.

Every constant the business rules need lives here, so a run is described by
one ``RulesConfig`` value (plus the ``as_of`` clock).  Rules never read the
wall clock and never hard-code a constant inline.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values -----------------------------------------------------------
# These must equal the source statement's literals for the extract to be
# right.  They are listed once, in the order the statement uses them.

SITE_RECORD_TYPES = ("012460000015LxGAAU", "01246000000u0DwAAI", "01246000000u0E0AAI")
CONTACT_RECORD_TYPE = "01246000000NGFNAA4"
COMMERCIAL = "Commercial"
ACTIVE = "Active"
PRIMARY = "Primary"
SECONDARY = "Secondary"
TERTIARY = "Tertiary"
PENDING = "Pending"
BENEFITS_INVESTIGATION = "Benefits Investigation"
KRYSTEXXA = "KRYSTEXXA"
TEPRO = "TEPRO"
FACILITY_SPECIALIST_OFFICE = "INF_FACILITY_TYPE_SPECIALIST_OFFICE"
FACILITY_INFUSION_CENTER = "INF_FACILITY_TYPE_INFUSION_CENTER"
FACILITY_PHARMACY = "INF_FACILITY_TYPE_PHARMACY"
FACILITY_HOSPITAL_OUTPATIENT = "INF_FACILITY_TYPE_HOSPITAL_OUTPATIENT"
# site type substring -> facility type, first match wins
SITE_TYPE_FACILITY = (
    ("Independent Site of Infusion", FACILITY_INFUSION_CENTER),
    ("Specialty Pharmacy Infusion", FACILITY_PHARMACY),
    ("Hospital (HOPD)", FACILITY_HOSPITAL_OUTPATIENT),
    ("Non-Infusing Location", FACILITY_INFUSION_CENTER),
    ("Physician Office (POI)", FACILITY_SPECIALIST_OFFICE),
)
# program -> facility type (used for Pending + BI, and as the fallback)
PROGRAM_FACILITY = ((KRYSTEXXA, FACILITY_SPECIALIST_OFFICE), (TEPRO, FACILITY_INFUSION_CENTER))
STATE_PREFIX = "US-"
PROGRAM_ID = "prod"
# program -> product code, first match wins, then the default
PRODUCT_CODES = ((TEPRO, "75987013015"), (KRYSTEXXA, "7598708010"))
PRODUCT_CODE_DEFAULT = "72677055101"
CPT_CODES = (96365, 96366, 96413, 96415)
DIAGNOSIS_OTHER = "Other"
PAYER_NOT_SUPPORTED = "Payer currently not supported"
BLUES_PATTERNS = ("Blue Cross Blue Shield", "BCBS", "BlueCross BlueShield")
BLUES_FALLBACK_PAYER_ID = "4ac3679b-7123-450e-ae60-3960770a7f51"
# insurance tier substring -> status, first match wins
INSURANCE_STATUS = (
    (PRIMARY, "INF_OTHER_INSURANCE_STATUS_EXISTS_CURRENT_PLAN_PRIMARY"),
    (SECONDARY, "INF_OTHER_INSURANCE_STATUS_EXISTS_CURRENT_PLAN_SECONDARY"),
    (TERTIARY, "INF_OTHER_INSURANCE_STATUS_EXISTS_CURRENT_PLAN_TERTIARY"),
)
INSURANCE_STATUS_UNKNOWN = "INF_OTHER_INSURANCE_STATUS_UNKNOWN"
NETWORK_STATUS = "INF_INPUT_NETWORK_STATUS_UNKNOWN"
COLLECT_PHARMACY_BENEFITS = "Yes"
CONSENT_TYPES = ("HIPAA Authorization", "CNE/PAM Consent")
PATIENT_RECORD_TYPE = "01246000000NGFYAA4"
PROVIDER_RECORD_TYPE = "01246000000u0E6AAI"
REPULL_HOURS = 100
REPULL_HOURS_IF_SUNDAY = 148
REPULL_HOURS_IF_SATURDAY = 124
PROGRAMS = (TEPRO, KRYSTEXXA)
MEDICARE_ADVANTAGE = "Medicare Advantage"
MANAGED_MEDICAID = "Managed Medicaid"
MEDICARE_FFS = "Medicare FFS"
FEDERAL_EMPLOYEE = "Federal Employee"
SUPPLEMENTAL = "Supplemental"
SEGMENT_TYPES = (MEDICARE_ADVANTAGE, MANAGED_MEDICAID, MEDICARE_FFS, COMMERCIAL, FEDERAL_EMPLOYEE, SUPPLEMENTAL)
COMMERCIAL_LIKE_TYPES = (COMMERCIAL, FEDERAL_EMPLOYEE, SUPPLEMENTAL)
EXCLUDED_STATE = "CA"
# --- end of fixed values ----------------------------------------------------

PARITY_MODES = ("as_written", "repaired", "intent")


@dataclass(frozen=True, kw_only=True)
class Rules:
    """The rule constants; a run adds its own parameters (``RulesConfig``)."""

    site_record_types: tuple[str, ...] = SITE_RECORD_TYPES
    contact_record_type: str = CONTACT_RECORD_TYPE
    patient_record_type: str = PATIENT_RECORD_TYPE
    provider_record_type: str = PROVIDER_RECORD_TYPE
    programs: tuple[str, ...] = PROGRAMS
    pending_status: str = PENDING
    pending_reason: str = BENEFITS_INVESTIGATION
    active_status: str = ACTIVE
    consent_types: tuple[str, ...] = CONSENT_TYPES
    repull_hours: int = REPULL_HOURS
    repull_hours_if_sunday: int = REPULL_HOURS_IF_SUNDAY
    repull_hours_if_saturday: int = REPULL_HOURS_IF_SATURDAY
    excluded_state: str = EXCLUDED_STATE


RULES = Rules()


@dataclass(frozen=True, kw_only=True)
class RulesConfig(Rules):
    """Everything a run of the extract depends on besides the input tables
    and the clock.

    ``parity`` chooses how the three defective membership lists of the source
    statement are read (see README, "Parity"): ``"as_written"`` reproduces
    them, ``"repaired"`` lets the narrow lists see the columns their filters
    name, ``"intent"`` also makes the ON-clause conditions filter.
    ``excluded_providers`` are (first name, last name) pairs.  ``cap`` keeps
    that many rows (``TOP n``); None keeps all.
    """

    parity: str
    excluded_providers: tuple[tuple[str, str], ...]
    cap: int | None = None

    def __post_init__(self):
        if self.parity not in PARITY_MODES:
            raise ValueError(f"parity must be one of {PARITY_MODES}, got {self.parity!r}")

    def with_(self, **kw) -> "RulesConfig":
        return replace(self, **kw)
