"""Hand-made fixture for the extract: one member per reason to be kept or
dropped.  All values are invented.

Every member ``i`` starts from a clean template (first program, Pending,
Benefits Investigation, both consents Active, one Active Commercial Primary coverage
``CV{i}`` on a mapped payer, a patient account with one primary contact in
NY, provider DOC1, site SITE1) and overrides what its case needs.  The
expected task ids per parity mode are written by hand in ``EXPECTED``.
"""

from __future__ import annotations

import datetime as dt

from bvengine.config import RulesConfig
from bvengine.sources.loader import DomainTables
from bvengine.sources.schemas import DOMAIN_SCHEMAS

# Fixed values, written here again so that a wrong one in the library shows.
PT, PR, ST, CT = "01246000000NGFYAA4", "01246000000u0E6AAI", "012460000015LxGAAU", "01246000000NGFNAA4"
EXCLUDED = ("Alex", "Example")
CONFIG = RulesConfig(parity="repaired", excluded_providers=(EXCLUDED,))
AS_OF = dt.datetime(2024, 2, 3, 12, 0)  # cutoff 2024-01-30 08:00
OLD = dt.datetime(2024, 1, 20, 9, 0)
RECENT = dt.datetime(2024, 2, 1, 9, 0)


def _pm(i, **kw):
    row = dict(
        id=f"PM{i}", name=f"N{i}", member_mvn__c=f"PAT{i}", status_mvn__c="Pending",
        status_reason_mvn__c="Benefits Investigation", program_name_mvn__c="TEPRO",
        patient_birthdate_mvn__c=dt.date(1980, 1, 1), physician_mvn__c="DOC1", enrolling_physician_mvn__c=None,
        hzn_updated_site_of_care__c=None, site_of_care_mvn__c="SITE1", hzn_asoc_opt_1__c=None,
        hzn_asoc_opt_2__c=None, hzn_asoc_opt_3__c=None, hzn_kxx_primary_diagnosis__c=None,
        hzn_primary_diagnosis__c="E05", hzn_other_primary_diagnosis__c="O1", hzn_secondary_dx_code__c="S1",
    )
    row.update(kw)
    return row


def _bc(i, suffix="", **kw):
    row = dict(
        id=f"BC{i}{suffix}", name=f"CV{i}{suffix}", program_member_mvn__c=f"PM{i}", recordtypeid="RTX",
        status_mvn__c="Active", hzn_pm_id__c=f"N{i}", hzn_plan_coverage_type__c="Commercial",
        hzn_insurance_type__c="Primary", coverage_type_mvn__c=None, hzn_eblu_payer_name__c="PayerA",
        hzn_kry_payer_name__c=None, hzn_plan_member_id__c=f"SUB{i}{suffix}", payer_phone_mvn__c="800",
        plan_name_mvn__c="Gold",
    )
    row.update(kw)
    return row


def _acct(id_, rt, **kw):
    row = {f.name: None for f in DOMAIN_SCHEMAS["account"].fields}
    row.update(id=id_, recordtypeid=rt)
    row.update(kw)
    return row


def _contact(cid, account, **kw):
    row = dict(id=cid, account_mvn__c=account, recordtypeid=CT, primary_mvn__c=1, zip_mvn__c="10001",
               address_line_1_mvn__c=f"{cid} Main St", address_line_2_mvn__c=None, city_mvn__c="Town",
               state_mvn__c="NY", lastmodifieddate=dt.datetime(2024, 1, 1, 10, 0))
    row.update(kw)
    return row


# member -> overrides.  Keys: pm (dict), bcs (list of dicts, default one
# clean coverage), contacts (list, default one clean), consents (list of
# (type, status)), no_patient (bool).
CASES: dict[int, dict] = {
    1: {},                                                           # clean, kept
    2: {"pm": dict(program_name_mvn__c="KRYSTEXXA", hzn_kxx_primary_diagnosis__c="Other")},
    3: {"pm": dict(program_name_mvn__c="KRYSTEXXA", hzn_kxx_primary_diagnosis__c="M10.9")},
    4: {"pm": dict(program_name_mvn__c="KRYSTEXXA", hzn_kxx_primary_diagnosis__c=None)},
    5: {"pm": dict(program_name_mvn__c="UPLIZNA")},                   # wrong program
    6: {"pm": dict(status_mvn__c="Active")},                         # wrong status
    7: {"pm": dict(status_reason_mvn__c="Other")},                   # wrong reason
    8: {"consents": [("HIPAA Authorization", "Active")]},            # consent missing
    9: {"consents": [("HIPAA Authorization", "Inactive"), ("CNE/PAM Consent", "Active")]},
    10: {"contacts": [dict(state_mvn__c="CA", lastmodifieddate=dt.datetime(2024, 1, 1)),
                      dict(state_mvn__c="NY", lastmodifieddate=dt.datetime(2024, 1, 15))]},   # newest is NY: kept
    11: {"contacts": [dict(state_mvn__c="NY", lastmodifieddate=dt.datetime(2024, 1, 1)),
                      dict(state_mvn__c="CA", lastmodifieddate=dt.datetime(2024, 1, 15))]},   # newest is CA: dropped
    12: {"contacts": []},                                            # no contact
    13: {"contacts": [dict(zip_mvn__c=None)]},                       # only contact has no zip
    14: {"pm": dict(physician_mvn__c=None, enrolling_physician_mvn__c=None)},   # no provider
    15: {"pm": dict(physician_mvn__c="DOC_X")},                      # excluded pair
    16: {"pm": dict(physician_mvn__c="DOC_N1")},                     # NULL first, excluded last
    17: {"pm": dict(physician_mvn__c="DOC_N2")},                     # NULL first, other last: kept
    18: {"contacts": [dict(state_mvn__c="US-CA")]},                  # kept, state CA
    19: {"contacts": [dict(state_mvn__c=None)]},                     # dropped
    20: {"bcs": [dict(hzn_eblu_payer_name__c="PayerZ")]},           # unmapped: dropped
    21: {"bcs": [dict(hzn_eblu_payer_name__c="BCBS Texas")]},       # Blues fallback id
    22: {"bcs": [dict(hzn_eblu_payer_name__c="PayerB")]},           # mapped twice: two rows
    23: {"bcs": [dict(hzn_eblu_payer_name__c=None)]},               # no payer name
    24: {"bcs": [dict(hzn_plan_member_id__c=None)]},                # no subscriber id
    46: {"bcs": [dict(hzn_eblu_payer_name__c=None, hzn_kry_payer_name__c="PayerA")]},   # second payer column
    25: {"bcs": [dict(suffix="a", hzn_insurance_type__c="Secondary"),
                 dict(suffix="b", hzn_plan_coverage_type__c="Medicare Advantage")]},
    26: {"bcs": [dict(suffix="a", hzn_plan_coverage_type__c=None, hzn_insurance_type__c="Secondary"),
                 dict(suffix="b", hzn_plan_coverage_type__c="Medicare Advantage")]},
    27: {"bcs": [dict(suffix="a", hzn_insurance_type__c="Secondary"),
                 dict(suffix="b", hzn_plan_coverage_type__c="Medicaid", hzn_eblu_payer_name__c="PayerZ")]},
    28: {"bcs": [dict(suffix="a"),
                 dict(suffix="b", hzn_plan_coverage_type__c=None, hzn_insurance_type__c="Secondary")]},
    29: {"bcs": [dict(hzn_plan_coverage_type__c="Medicare FFS")]},
    30: {"bcs": [dict(suffix="a", hzn_plan_coverage_type__c="Medicare Advantage", hzn_insurance_type__c="Tertiary"),
                 dict(suffix="b")]},
    31: {"log": [("CV31 N31", RECENT, True)]},                       # sent recently: dropped
    32: {"log": [("CV32 N32", OLD, True)]},                          # stale and accepted: kept
    33: {"log": [("CV33 N33", OLD, False)]},                         # stale, never accepted: dropped
    34: {"log": [("CV34 N34", None, True)]},                         # date NULL: dropped
    35: {"log2": [("CV35 N35", RECENT)]},                            # second log recent: dropped
    36: {"log2": [("CV36 N36", OLD)]},                               # second log old: kept
    37: {"bcs": [dict(name=None)], "log": [(" N37", RECENT, True)]},  # NULL coverage name, still matched
    38: {"bcs": [dict(name=None)]},                                  # NULL coverage name, kept as ' N38'
    39: {"log": [("CV39 N39", OLD, True), ("CV39 N39", RECENT, False)]},   # latest send is recent
    40: {"pm": dict(physician_mvn__c="DOC_L")},                      # NPI with letters: digits kept
    41: {"pm": dict(physician_mvn__c="DOC_9", site_of_care_mvn__c="SITE_M")},   # 9-digit NPI; first site NPI malformed
    42: {"contacts": [dict(zip_mvn__c="12345-6789")]},
    43: {"contacts": [dict(zip_mvn__c="1234-5678")]},
    44: {"contacts": [dict(zip_mvn__c="123")]},
    45: {"pm": dict(hzn_asoc_opt_1__c="SITE1", hzn_asoc_opt_2__c="SITE_M", hzn_updated_site_of_care__c="SITE_I",
                    site_of_care_mvn__c="SITE1")},
    47: {"no_patient": True},                                        # no patient account: dropped
    48: {"contacts": [dict(primary_mvn__c=0)]},                  # non-primary contact only: dropped
    49: {"contacts": [dict(recordtypeid="RT-OTHER")]},               # wrong contact record type: dropped
    50: {"bcs": [dict(status_mvn__c="Inactive")]},                   # inactive coverage: dropped
    51: {"contacts": [dict(primary_mvn__c=2)]},                      # the flag is compared with 1: dropped
    52: {"contacts": [dict(primary_mvn__c=None)]},                   # dropped
    53: {"log": [("CV53 N53", OLD, 2), ("CV53 N53", OLD, -1)]},      # the flag is summed: 1, kept
    54: {"log": [("CV54 N54", OLD, 1), ("CV54 N54", OLD, -1)]},      # sums to 0: dropped
}

COMMON_KEPT = {
    "CV1 N1", "CV2 N2", "CV3 N3", "CV4 N4", "CV10 N10", "CV17 N17", "CV18 N18", "CV21 N21", "CV22 N22",
    "CV46 N46", "CV30b N30", "CV32 N32", "CV36 N36", " N38", "CV40 N40", "CV41 N41", "CV42 N42", "CV43 N43",
    "CV44 N44", "CV45 N45", "CV53 N53",
}
EXPECTED = {
    "repaired": COMMON_KEPT | {"CV26b N26", "CV28b N28"},
    "intent": COMMON_KEPT | {"CV25a N25", "CV26b N26", "CV28a N28", "CV28b N28", "CV29 N29"},
    "as_written": COMMON_KEPT | {"CV25a N25", "CV25b N25", "CV26a N26", "CV26b N26", "CV27a N27", "CV28a N28",
                                 "CV28b N28", "CV30a N30"},
}


def build_rows():
    pms, bcs, accts, contacts, consents, log, log2 = [], [], [], [], [], [], []
    for i, case in CASES.items():
        pms.append(_pm(i, **case.get("pm", {})))
        for spec in case.get("bcs", [{}]):
            spec = dict(spec)
            suffix = spec.pop("suffix", "")
            bcs.append(_bc(i, suffix, **spec))
        if not case.get("no_patient"):
            accts.append(_acct(f"PAT{i}", PT, firstname=f"F{i}", lastname=f"L{i}"))
        for j, spec in enumerate(case.get("contacts", [{}])):
            contacts.append(_contact(f"CT{i}-{j}", f"PAT{i}", **spec))
        for t, s in case.get("consents", [("HIPAA Authorization", "Active"), ("CNE/PAM Consent", "Active")]):
            consents.append(dict(program_member_mvn__c=f"PM{i}", status_mvn__c=s, type_mvn__c=t))
        for task, ts, acc in case.get("log", []):
            log.append({"customer bv task id": task, "extraction_date": ts, "is_accepted": None if acc is None else int(acc)})
        for task, ts in case.get("log2", []):
            log2.append({"customer bv task id": task, "extraction date": ts})
    accts += [
        _acct("DOC1", PR, firstname="Ann", lastname="Lee", npi_vod__c="1234567890", hzn_tax_id__c="12-3456789"),
        _acct("DOC_X", PR, firstname=EXCLUDED[0], lastname=EXCLUDED[1], npi_vod__c="1111111111"),
        _acct("DOC_N1", PR, firstname=None, lastname=EXCLUDED[1]),
        _acct("DOC_N2", PR, firstname=None, lastname="Smith"),
        _acct("DOC_L", PR, firstname="Lia", lastname="Ko", npi_vod__c="NPI 123-456-7890"),
        _acct("DOC_9", PR, firstname="Bo", lastname="Ng", npi_vod__c="123456789"),
        _acct("SITE1", ST, name="Clinic", type="Physician Office (POI)", hzn_npi_facility__c="2222222222",
              hzn_tax_id__c="987654321"),
        _acct("SITE_M", ST, name=None, formatted_name_vod__c="Formatted M", hzn_npi_facility__c="12345",
              hzn_npi_primary_hcp__c="3333333333"),
        _acct("SITE_I", "01246000000u0DwAAI", name="Infusion Co", type="Independent Site of Infusion"),
        _acct("SITE_NOT", "RT-OTHER", name="Not a site"),
    ]
    contacts += [
        _contact("CTD1", "DOC1", state_mvn__c="US-TX", zip_mvn__c="75001"),
        _contact("CTS1", "SITE1", state_mvn__c="US-NJ", zip_mvn__c="07001-1234"),
    ]
    hpm = [dict(payer_name="PayerA", infinitus_payer_id="PID-A"), dict(payer_name="PayerB", infinitus_payer_id="PID-B1"),
           dict(payer_name="PayerB", infinitus_payer_id="PID-B2")]
    rt = [dict(id="RTX")]
    return dict(account=accts, contact_info=contacts, program_member=pms, benefits_coverage=bcs,
                authorization_consent=consents, payer_mapping=hpm, record_type=rt, outbound_log=log, allcare_log=log2)


def golden_tables(spark) -> DomainTables:
    frames = {}
    for name, rows in build_rows().items():
        schema = DOMAIN_SCHEMAS[name]
        data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        frames[name] = spark.createDataFrame(data, schema)
    return DomainTables.from_frames(frames)
