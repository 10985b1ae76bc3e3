"""Domain tables derived from the driver's test tables.

The extract needs nine CRM / patient-services tables; the test data holds
TPC-H-like tables.  Each domain table is a SELECT over them, written in the
SQL subset that Spark and DuckDB read identically, so the Spark extract and
the DuckDB oracle (an independent SQL formulation of the extract) see the
very same rows.  Every table grows with the scale factor except the payer map (one
row per payer, a reference table) and the record types.

Mapping: customer -> program members and patient accounts; orders ->
coverages, contacts and consents (many per member, dated); supplier ->
providers and sites; part -> payer map; events x orders -> the two
submission logs; region -> record types.  Value rules (``k % n``) spread
the branches of every rule: NULLs, wrong record types, malformed NPIs and
zips, ``CA`` / ``US-CA`` states, the excluded provider, Blues payers,
unmapped and doubly mapped payers, recent / stale / unaccepted submissions.
Two derivations read part of their source by design: the payer map takes
parts above size 10, so some payers stay unmapped, and the second log takes
views and errors, so some tasks were never sent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..sources.loader import DomainTables, read_table


# The run that the checks and the bench describe: an invented provider is
# excluded, and the clock is a Saturday (cutoff Tuesday 08:00).
EXCLUDED_PROVIDER = ("Alex", "Example")
CHECK_CONFIG = C.RulesConfig(parity="repaired", excluded_providers=(EXCLUDED_PROVIDER,))
CHECK_AS_OF = _dt.datetime(2024, 2, 3, 12, 0, 0)


def _lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# {{table}} placeholders name the driver tables; {name} ones are the rule
# constants below.
_TEMPLATES: dict[str, str] = {
    "account": """
SELECT 'AC' || CAST(c_custkey AS STRING) AS id,
       CASE WHEN c_custkey % 53 = 7 THEN 'RT-OTHER' ELSE {patient_rt} END AS recordtypeid,
       c_name AS name, CAST(NULL AS STRING) AS formatted_name_vod__c,
       'First' || CAST(c_custkey % 97 AS STRING) AS firstname,
       'Last' || CAST(c_custkey % 89 AS STRING) AS lastname,
       CAST(NULL AS STRING) AS type, CAST(NULL AS STRING) AS npi_vod__c,
       CAST(NULL AS STRING) AS hzn_npi_facility__c, CAST(NULL AS STRING) AS hzn_npi_primary_hcp__c,
       CAST(NULL AS STRING) AS hzn_npi_secondary__c, CAST(NULL AS STRING) AS hzn_npi_tertiary__c,
       CAST(NULL AS STRING) AS hzn_tax_id__c
FROM {{customer}}
UNION ALL
SELECT 'AH' || CAST(s_suppkey AS STRING) AS id,
       {provider_rt} AS recordtypeid,
       s_name AS name, CAST(NULL AS STRING) AS formatted_name_vod__c,
       CASE WHEN s_suppkey % 11 = 0 THEN {excluded_first} WHEN s_suppkey % 17 = 0 THEN NULL
            ELSE 'Doc' || CAST(s_suppkey AS STRING) END AS firstname,
       CASE WHEN s_suppkey % 11 = 0 THEN {excluded_last}
            WHEN s_suppkey % 17 = 0 AND s_suppkey % 2 = 0 THEN {excluded_last}
            ELSE 'Smith' || CAST(s_suppkey % 13 AS STRING) END AS lastname,
       CAST(NULL AS STRING) AS type,
       CASE s_suppkey % 4 WHEN 0 THEN CAST(1000000000 + s_suppkey AS STRING)
                          WHEN 1 THEN 'NPI-' || CAST(1000000000 + s_suppkey * 7 AS STRING)
                          WHEN 2 THEN CAST(100000000 + s_suppkey AS STRING)
                          ELSE NULL END AS npi_vod__c,
       CAST(NULL AS STRING) AS hzn_npi_facility__c, CAST(NULL AS STRING) AS hzn_npi_primary_hcp__c,
       CAST(NULL AS STRING) AS hzn_npi_secondary__c, CAST(NULL AS STRING) AS hzn_npi_tertiary__c,
       CASE s_suppkey % 3 WHEN 0 THEN '12-' || lpad(CAST(s_suppkey AS STRING), 7, '0')
                          WHEN 1 THEN lpad(CAST(s_suppkey AS STRING), 5, '0')
                          ELSE NULL END AS hzn_tax_id__c
FROM {{supplier}}
UNION ALL
SELECT 'AS' || CAST(s_suppkey AS STRING) AS id,
       CASE s_suppkey % 4 WHEN 0 THEN {site_rt_0} WHEN 1 THEN {site_rt_1}
                          WHEN 2 THEN {site_rt_2} ELSE 'RT-NOT-A-SITE' END AS recordtypeid,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'Site ' || CAST(s_suppkey AS STRING) END AS name,
       'Formatted Site ' || CAST(s_suppkey AS STRING) AS formatted_name_vod__c,
       CAST(NULL AS STRING) AS firstname, CAST(NULL AS STRING) AS lastname,
       CASE s_suppkey % 6 WHEN 0 THEN 'Independent Site of Infusion' WHEN 1 THEN 'Specialty Pharmacy Infusion'
                          WHEN 2 THEN 'Hospital (HOPD)' WHEN 3 THEN 'Non-Infusing Location'
                          WHEN 4 THEN 'Physician Office (POI)' ELSE NULL END AS type,
       CAST(4000000000 + s_suppkey AS STRING) AS npi_vod__c,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(2000000000 + s_suppkey AS STRING) END AS hzn_npi_facility__c,
       CASE WHEN s_suppkey % 7 = 0 THEN 'X' || CAST(3000000000 + s_suppkey AS STRING) END AS hzn_npi_primary_hcp__c,
       CAST(NULL AS STRING) AS hzn_npi_secondary__c,
       CASE WHEN s_suppkey % 2 = 0 THEN '12345' END AS hzn_npi_tertiary__c,
       CASE WHEN s_suppkey % 2 = 0 THEN lpad(CAST(s_suppkey AS STRING), 9, '9')
            ELSE 'TX' || CAST(s_suppkey AS STRING) END AS hzn_tax_id__c
FROM {{supplier}}
""",
    "contact_info": """
SELECT 'CI' || CAST(o_orderkey AS STRING) AS id,
       CASE o_orderkey % 3 WHEN 0 THEN 'AC' || CAST(o_custkey AS STRING)
                           WHEN 1 THEN 'AS' || CAST(o_custkey % 10 AS STRING)
                           ELSE 'AH' || CAST(o_custkey % 10 AS STRING) END AS account_mvn__c,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'RT-OTHER'
            ELSE {contact_rt} END AS recordtypeid,
       o_orderpriority <> '4-NOT SPECIFIED' AS primary_mvn__c,
       CASE o_orderkey % 5 WHEN 0 THEN NULL
                           WHEN 1 THEN CAST(10000 + o_orderkey % 89999 AS STRING)
                           WHEN 2 THEN CAST(10000 + o_orderkey % 89999 AS STRING) || '-' || CAST(1000 + o_orderkey % 8999 AS STRING)
                           WHEN 3 THEN CAST(o_orderkey % 1000 AS STRING)
                           ELSE 'Z' || CAST(o_orderkey AS STRING) END AS zip_mvn__c,
       CAST(o_orderkey AS STRING) || ' Main St' AS address_line_1_mvn__c,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Suite ' || CAST(o_orderkey % 50 AS STRING) END AS address_line_2_mvn__c,
       'City' || CAST(o_custkey % 50 AS STRING) AS city_mvn__c,
       CASE o_orderkey % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'US-CA' WHEN 2 THEN NULL WHEN 3 THEN 'US-NY'
                           WHEN 4 THEN 'TX' ELSE 'US-' || CAST(o_orderkey % 50 AS STRING) END AS state_mvn__c,
       o_orderdate AS lastmodifieddate
FROM {{orders}}
""",
    "program_member": """
SELECT 'PM' || CAST(c_custkey AS STRING) AS id,
       'M' || CAST(c_custkey AS STRING) AS name,
       'AC' || CAST(c_custkey AS STRING) AS member_mvn__c,
       CASE WHEN c_custkey % 19 = 3 THEN 'Active' WHEN c_custkey % 41 = 5 THEN NULL ELSE 'Pending' END AS status_mvn__c,
       CASE WHEN c_custkey % 23 = 4 THEN 'Other' ELSE 'Benefits Investigation' END AS status_reason_mvn__c,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {tepro} WHEN 'BUILDING' THEN {krystexxa}
                         WHEN 'FURNITURE' THEN {krystexxa} WHEN 'HOUSEHOLD' THEN {tepro}
                         ELSE 'UPLIZNA' END AS program_name_mvn__c,
       make_date(CAST(1940 + c_custkey % 60 AS INT), CAST(1 + c_custkey % 12 AS INT),
                 CAST(1 + c_custkey % 28 AS INT)) AS patient_birthdate_mvn__c,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'AH' || CAST(c_custkey % 10 AS STRING) END AS physician_mvn__c,
       CASE WHEN c_custkey % 3 = 0 THEN 'AH' || CAST(c_custkey % 7 AS STRING) END AS enrolling_physician_mvn__c,
       CASE WHEN c_custkey % 4 = 0 THEN 'AS' || CAST(c_custkey % 10 AS STRING) END AS hzn_updated_site_of_care__c,
       CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE 'AS' || CAST((c_custkey + 3) % 10 AS STRING) END AS site_of_care_mvn__c,
       CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE 'AS' || CAST((c_custkey + 1) % 10 AS STRING) END AS hzn_asoc_opt_1__c,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'AS' || CAST((c_custkey + 2) % 10 AS STRING) END AS hzn_asoc_opt_2__c,
       CASE WHEN c_custkey % 5 IN (1, 2, 3) THEN NULL ELSE 'AS' || CAST((c_custkey + 5) % 12 AS STRING) END AS hzn_asoc_opt_3__c,
       CASE c_custkey % 4 WHEN 0 THEN 'Other' WHEN 1 THEN NULL
                          ELSE 'M10.' || CAST(c_custkey % 10 AS STRING) END AS hzn_kxx_primary_diagnosis__c,
       CASE c_custkey % 3 WHEN 0 THEN 'Other' ELSE 'E05.' || CAST(c_custkey % 9 AS STRING) END AS hzn_primary_diagnosis__c,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'OTH' || CAST(c_custkey % 11 AS STRING) END AS hzn_other_primary_diagnosis__c,
       CASE WHEN c_custkey % 2 = 0 THEN 'SEC' || CAST(c_custkey % 13 AS STRING) END AS hzn_secondary_dx_code__c
FROM {{customer}}
""",
    "benefits_coverage": """
SELECT 'BC' || CAST(o_orderkey AS STRING) AS id,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey AS STRING) END AS name,
       'PM' || CAST(o_custkey AS STRING) AS program_member_mvn__c,
       'RT' || CAST(o_orderkey % 3 AS STRING) AS recordtypeid,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Inactive' ELSE 'Active' END AS status_mvn__c,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL
            WHEN o_orderkey % 37 = 0 THEN 'M' || CAST(o_custkey + 1 AS STRING)
            ELSE 'M' || CAST(o_custkey AS STRING) END AS hzn_pm_id__c,
       CASE o_orderkey % 8 WHEN 0 THEN 'Commercial' WHEN 1 THEN 'Medicare Advantage'
                           WHEN 2 THEN 'Managed Medicaid' WHEN 3 THEN 'Medicare FFS'
                           WHEN 4 THEN 'Federal Employee' WHEN 5 THEN 'Supplemental'
                           WHEN 6 THEN NULL ELSE 'Commercial PPO' END AS hzn_plan_coverage_type__c,
       CASE o_orderstatus WHEN 'O' THEN 'Primary' WHEN 'F' THEN 'Secondary' ELSE NULL END AS hzn_insurance_type__c,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Primary' ELSE 'Tertiary Plan' END AS coverage_type_mvn__c,
       CASE o_orderkey % 6 WHEN 0 THEN NULL
                           WHEN 1 THEN 'BCBS of State ' || CAST(o_orderkey % 5 AS STRING)
                           WHEN 2 THEN 'Blue Cross Blue Shield ' || CAST(o_custkey % 3 AS STRING)
                           ELSE 'Payer ' || CAST(o_orderkey % 60 AS STRING) END AS hzn_eblu_payer_name__c,
       CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 'Payer ' || CAST(o_custkey % 45 AS STRING) END AS hzn_kry_payer_name__c,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'SUB' || CAST(o_orderkey AS STRING) END AS hzn_plan_member_id__c,
       '800-555-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') AS payer_phone_mvn__c,
       'Plan ' || CAST(o_orderkey % 9 AS STRING) AS plan_name_mvn__c
FROM {{orders}}
""",
    "authorization_consent": """
SELECT 'PM' || CAST(o_custkey AS STRING) AS program_member_mvn__c,
       CASE WHEN o_orderstatus = 'P' THEN 'Inactive' ELSE 'Active' END AS status_mvn__c,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'HIPAA Authorization' WHEN '2-HIGH' THEN 'CNE/PAM Consent'
                            WHEN '3-MEDIUM' THEN 'HIPAA Authorization' ELSE 'Marketing Consent' END AS type_mvn__c
FROM {{orders}}
""",
    "payer_mapping": """
SELECT 'Payer ' || CAST(p_partkey % 50 AS STRING) AS payer_name,
       'PID-' || CAST(MIN(p_partkey) AS STRING) AS infinitus_payer_id
FROM {{part}} WHERE p_size > 10 GROUP BY p_partkey % 50
UNION ALL
SELECT 'Payer ' || CAST(p_partkey % 50 AS STRING) AS payer_name,
       'PID-ALT-' || CAST(MAX(p_partkey) AS STRING) AS infinitus_payer_id
FROM {{part}} WHERE p_partkey % 50 = 7 GROUP BY p_partkey % 50
""",
    "record_type": """
SELECT 'RT' || CAST(r_regionkey AS STRING) AS id FROM {{region}}
""",
    "outbound_log": """
SELECT coalesce(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey AS STRING) END, '')
         || ' ' || 'M' || CAST(o_custkey AS STRING) AS "customer bv task id",
       CASE WHEN value < 2 THEN NULL ELSE ts END AS extraction_date,
       event_type IN ('purchase', 'click', 'signup') AS is_accepted
FROM {{events}} JOIN {{orders}} ON o_orderkey = event_id
UNION ALL
SELECT coalesce(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey AS STRING) END, '')
         || ' ' || 'M' || CAST(o_custkey AS STRING) AS "customer bv task id",
       ts AS extraction_date,
       event_type = 'purchase' AS is_accepted
FROM {{events}} JOIN {{orders}} ON o_orderkey = event_id + 7
""",
    "allcare_log": """
SELECT coalesce(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey AS STRING) END, '')
         || ' ' || 'M' || CAST(o_custkey AS STRING) AS "customer bv task id",
       ts AS "extraction date"
FROM {{events}} JOIN {{orders}} ON o_orderkey = event_id + 3
WHERE event_type IN ('view', 'error')
""",
}

# The rule constants the derivations use come from the fixed values in
# ``bvengine.config`` (quoted as SQL literals); ``{table}`` placeholders stay.
_CONSTANTS = {
    "patient_rt": _lit(C.PATIENT_RECORD_TYPE),
    "provider_rt": _lit(C.PROVIDER_RECORD_TYPE),
    "site_rt_0": _lit(C.SITE_RECORD_TYPES[0]),
    "site_rt_1": _lit(C.SITE_RECORD_TYPES[1]),
    "site_rt_2": _lit(C.SITE_RECORD_TYPES[2]),
    "contact_rt": _lit(C.CONTACT_RECORD_TYPE),
    "tepro": _lit(C.TEPRO),
    "krystexxa": _lit(C.KRYSTEXXA),
    "excluded_first": _lit(EXCLUDED_PROVIDER[0]),
    "excluded_last": _lit(EXCLUDED_PROVIDER[1]),
}
STANDIN_SQL: dict[str, str] = {name: sql.format(**_CONSTANTS) for name, sql in _TEMPLATES.items()}

STANDIN_SOURCES = ("customer", "orders", "supplier", "part", "events", "region")


def _spark_sql(sql: str) -> str:
    # Spark SQL text reads double-quoted names as strings; use backticks.
    return sql.replace('"customer bv task id"', "`customer bv task id`").replace('"extraction date"', "`extraction date`")


def standin_tables(spark: SparkSession, sf_dir: str) -> DomainTables:
    """The nine domain tables, derived lazily from ``sf_dir``'s tables."""
    src = {n: read_table(spark, sf_dir, n) for n in STANDIN_SOURCES}
    frames: dict[str, DataFrame] = {}
    for name, sql in STANDIN_SQL.items():
        frames[name] = spark.sql(_spark_sql(sql), **src)
    return DomainTables.from_frames(frames)


def standin_ctes() -> str:
    """The same derivations as DuckDB CTEs over the registered driver views."""
    names = {n: n for n in STANDIN_SOURCES}
    parts = [f"{name} AS ({sql.format(**names).strip()})" for name, sql in STANDIN_SQL.items()]
    return "WITH " + ",\n".join(parts)
