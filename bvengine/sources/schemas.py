"""Declared schemas of the nine domain tables and of the 76-column extract.

The source statement ships no DDL; the types are inferred from how each
column is used.  Loaders check these on read (a missing column is an error,
never silently NULL) and cast to the declared types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, D, N, I = StringType(), DateType(), TimestampNTZType(), IntegerType()

# --- fixed values -----------------------------------------------------------
# Column names and output column names below must equal the source
# statement's for the extract to read its tables and produce its columns; they are listed in the order the statement uses them.


def _schema(*fields: tuple[str, object], required: tuple[str, ...] = ("id",)) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields])


# Flags are integers (a BIT or BOOLEAN source becomes 0 / 1): the statement
# compares one with 1 and sums the other.
ACCOUNT = _schema(
    ("id", S), ("recordtypeid", S), ("name", S), ("formatted_name_vod__c", S), ("firstname", S),
    ("lastname", S), ("type", S), ("npi_vod__c", S), ("hzn_npi_facility__c", S),
    ("hzn_npi_primary_hcp__c", S), ("hzn_npi_secondary__c", S), ("hzn_npi_tertiary__c", S),
    ("hzn_tax_id__c", S),
)

# ``id`` is not read by the statement; it is the tie-breaker for contacts
# modified at the same instant (the statement leaves such ties undefined).
CONTACT_INFO = _schema(
    ("id", S), ("account_mvn__c", S), ("recordtypeid", S), ("primary_mvn__c", I), ("zip_mvn__c", S),
    ("address_line_1_mvn__c", S), ("address_line_2_mvn__c", S), ("city_mvn__c", S),
    ("state_mvn__c", S), ("lastmodifieddate", N),
)

PROGRAM_MEMBER = _schema(
    ("id", S), ("name", S), ("member_mvn__c", S), ("status_mvn__c", S), ("status_reason_mvn__c", S),
    ("program_name_mvn__c", S), ("patient_birthdate_mvn__c", D), ("physician_mvn__c", S),
    ("enrolling_physician_mvn__c", S), ("hzn_updated_site_of_care__c", S), ("site_of_care_mvn__c", S),
    ("hzn_asoc_opt_1__c", S), ("hzn_asoc_opt_2__c", S), ("hzn_asoc_opt_3__c", S),
    ("hzn_kxx_primary_diagnosis__c", S), ("hzn_primary_diagnosis__c", S),
    ("hzn_other_primary_diagnosis__c", S), ("hzn_secondary_dx_code__c", S),
)

BENEFITS_COVERAGE = _schema(
    ("id", S), ("name", S), ("program_member_mvn__c", S), ("recordtypeid", S), ("status_mvn__c", S),
    ("hzn_pm_id__c", S), ("hzn_plan_coverage_type__c", S), ("hzn_insurance_type__c", S),
    ("coverage_type_mvn__c", S), ("hzn_eblu_payer_name__c", S), ("hzn_kry_payer_name__c", S),
    ("hzn_plan_member_id__c", S), ("payer_phone_mvn__c", S), ("plan_name_mvn__c", S),
)

AUTHORIZATION_CONSENT = _schema(
    ("program_member_mvn__c", S), ("status_mvn__c", S), ("type_mvn__c", S), required=()
)

PAYER_MAPPING = _schema(("payer_name", S), ("infinitus_payer_id", S), required=())

RECORD_TYPE = _schema(("id", S))

OUTBOUND_LOG = _schema(("customer bv task id", S), ("extraction_date", N), ("is_accepted", I), required=())

# The second vendor's log names its date column with a blank.
ALLCARE_LOG = _schema(("customer bv task id", S), ("extraction date", N), required=())

DOMAIN_SCHEMAS: dict[str, StructType] = {
    "account": ACCOUNT,
    "contact_info": CONTACT_INFO,
    "program_member": PROGRAM_MEMBER,
    "benefits_coverage": BENEFITS_COVERAGE,
    "authorization_consent": AUTHORIZATION_CONSENT,
    "payer_mapping": PAYER_MAPPING,
    "record_type": RECORD_TYPE,
    "outbound_log": OUTBOUND_LOG,
    "allcare_log": ALLCARE_LOG,
}

def _party_block(prefix: str) -> list[str]:
    return [
        f"{prefix} Street Address",
        f"{prefix} Street Address Line 2",
        f"{prefix} City",
        f"{prefix} State",
        f"{prefix} Zip",
    ]


def _site_block(prefix: str) -> list[str]:
    return [f"{prefix} Name", f"{prefix} NPI", f"{prefix} Tax ID"] + _party_block(prefix)


# The 76 output columns, in output order.
OUTPUT_COLUMNS: list[str] = (
    ["Customer BV Task ID", "Program ID", "Facility Type", "PM Veeva ID", "PM Status", "Status Reason",
     "BC Veeva ID", "BC Status", "Insurance Segment", "Member has at least one Govt Ins",
     "Member First Name", "Member Last Name", "Member Date of Birth"]
    + _party_block("Member")
    + _site_block("Practice")
    + _site_block("ASOC Option 1")
    + _site_block("ASOC Option 2")
    + _site_block("ASOC Option 3")
    + ["Provider First Name", "Provider Last Name", "Provider NPI", "Provider Tax ID"]
    + _party_block("Provider")
    + ["Product Code #1", "Product Name #1", "CPT Code #1", "CPT Code #2", "CPT Code #3", "CPT Code #4",
       "Diagnosis Code #1", "Diagnosis Code #2", "Diagnosis Code #3", "Infinitus Payer ID",
       "Customer Payer Name", "Customer Payer Phone", "Subscriber ID", "Other Insurance Status",
       "Plan Name", "Provider Network Status", "Collect Pharmacy Benefits"]
)

_INT_OUTPUTS = {"Member has at least one Govt Ins", "CPT Code #1", "CPT Code #2", "CPT Code #3", "CPT Code #4"}

OUTPUT_SCHEMA = StructType(
    [
        StructField(
            c,
            D if c == "Member Date of Birth" else (I if c in _INT_OUTPUTS else S),
            c not in _INT_OUTPUTS and c not in ("Customer BV Task ID", "Program ID"),
        )
        for c in OUTPUT_COLUMNS
    ]
)

assert len(OUTPUT_COLUMNS) == 76, len(OUTPUT_COLUMNS)
# --- end of fixed values ----------------------------------------------------


# Schemas of the driver's test tables that the checks read (declared, so a
# read does not open Parquet footers on the driver to infer them).
L, DB = LongType(), DoubleType()


def _plain(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


DRIVER_SCHEMAS: dict[str, StructType] = {
    "region": _plain(("r_regionkey", I), ("r_name", S)),
    "nation": _plain(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _plain(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", DB), ("c_mktsegment", S)),
    "supplier": _plain(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", DB)),
    "part": _plain(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I), ("p_retailprice", DB)),
    "orders": _plain(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", DB),
                     ("o_orderdate", N), ("o_orderpriority", S)),
    "lineitem": _plain(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I), ("l_quantity", DB),
                       ("l_extendedprice", DB), ("l_discount", DB), ("l_tax", DB), ("l_returnflag", S),
                       ("l_linestatus", S), ("l_shipdate", N)),
    "events": _plain(("event_id", L), ("ts", N), ("user_id", L), ("event_type", S), ("value", DB), ("props", S)),
}
