import pytest

from bvengine.plans.extract import benefit_verification_extract
from bvengine.sources.schemas import OUTPUT_COLUMNS, OUTPUT_SCHEMA
from golden import AS_OF, CONFIG, EXPECTED, golden_tables


@pytest.fixture(scope="module")
def tables(spark):
    return golden_tables(spark)


def run(tables, parity="repaired", cap=None, **kw):
    return benefit_verification_extract(tables, AS_OF, CONFIG.with_(parity=parity, cap=cap), **kw)


@pytest.mark.parametrize("parity", ["repaired", "intent", "as_written"])
@pytest.mark.parametrize("options", [{}, {"join_hint": "merge"}, {"reduce_by_members": True}])
def test_kept_task_ids(tables, parity, options):
    df = run(tables, parity, **options)
    got = {r[0] for r in df.select("`Customer BV Task ID`").collect()}
    assert got == EXPECTED[parity]


def test_no_provider_excluded(tables):
    """Without a pair to exclude the provider join is a plain LEFT JOIN."""
    got = {r[0] for r in benefit_verification_extract(tables, AS_OF, CONFIG.with_(excluded_providers=())).collect()}
    assert got == EXPECTED["repaired"] | {"CV14 N14", "CV15 N15", "CV16 N16"}


def test_output_schema(tables):
    df = run(tables)
    assert df.columns == OUTPUT_COLUMNS
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in OUTPUT_SCHEMA.fields]


@pytest.fixture(scope="module")
def rows(tables):
    out = {}
    for r in run(tables).collect():
        out.setdefault(r["Customer BV Task ID"], []).append(r.asDict())
    return out


def one(rows, task):
    assert len(rows[task]) == 1, rows[task]
    return rows[task][0]


def test_payer_mapped_twice_fans_out(rows):
    assert sorted(r["Infinitus Payer ID"] for r in rows["CV22 N22"]) == ["PID-B1", "PID-B2"]


def test_blues_fallback(rows):
    assert one(rows, "CV21 N21")["Infinitus Payer ID"] == "4ac3679b-7123-450e-ae60-3960770a7f51"
    assert one(rows, "CV46 N46")["Customer Payer Name"] == "PayerA"


def test_diagnosis_slots(rows):
    def dx(t):
        r = one(rows, t)
        return r["Diagnosis Code #1"], r["Diagnosis Code #2"], r["Diagnosis Code #3"]

    assert dx("CV1 N1") == ("E05", "O1", "S1")
    assert dx("CV2 N2") == ("O1", "S1", None)
    assert dx("CV3 N3") == ("M10.9", "O1", "S1")
    assert dx("CV4 N4") == ("E05", "O1", "S1")


def test_facility_and_product(rows):
    r1, r2 = one(rows, "CV1 N1"), one(rows, "CV2 N2")
    assert r1["Facility Type"] == "INF_FACILITY_TYPE_INFUSION_CENTER" and r1["Product Code #1"] == "75987013015"
    assert r2["Facility Type"] == "INF_FACILITY_TYPE_SPECIALIST_OFFICE" and r2["Product Code #1"] == "7598708010"
    assert [r1[f"CPT Code #{i}"] for i in range(1, 5)] == [96365, 96366, 96413, 96415]


def test_contacts_states_zips(rows):
    assert one(rows, "CV10 N10")["Member State"] == "NY"
    assert one(rows, "CV18 N18")["Member State"] == "CA"
    assert one(rows, "CV42 N42")["Member Zip"] == "12345"
    assert one(rows, "CV43 N43")["Member Zip"] == "12345"
    assert one(rows, "CV44 N44")["Member Zip"] is None


def test_npi_tax_and_parties(rows):
    r1 = one(rows, "CV1 N1")
    assert (r1["Provider NPI"], r1["Provider Tax ID"], r1["Provider State"], r1["Provider Zip"]) == (
        "1234567890", "123456789", "TX", "75001")
    assert (r1["Practice Name"], r1["Practice NPI"], r1["Practice Tax ID"], r1["Practice State"], r1["Practice Zip"]) == (
        "Clinic", "2222222222", "987654321", "NJ", "07001")
    assert r1["ASOC Option 1 Name"] is None
    assert one(rows, "CV40 N40")["Provider NPI"] == "1234567890"
    r41 = one(rows, "CV41 N41")
    assert r41["Provider NPI"] is None
    assert r41["Practice Name"] == "Formatted M" and r41["Practice NPI"] is None  # no fall-through past a bad NPI
    r45 = one(rows, "CV45 N45")
    assert r45["Practice Name"] == "Infusion Co"
    assert r45["Practice Street Address"] is None and r45["Practice Zip"] is None  # site without a contact
    assert (r45["ASOC Option 1 Name"], r45["ASOC Option 1 NPI"], r45["ASOC Option 1 State"], r45["ASOC Option 1 Zip"]) == (
        "Clinic", "2222222222", "NJ", "07001")
    assert (r45["ASOC Option 2 Name"], r45["ASOC Option 2 NPI"]) == ("Formatted M", None)


def test_null_coverage_name_task_id(rows):
    assert one(rows, " N38")["BC Veeva ID"] == "BC38"


def test_govt_flag_in_intent(tables):
    df = run(tables, "intent")
    flags = {r[0]: r[1] for r in df.select("`Customer BV Task ID`", "`Member has at least one Govt Ins`").collect()}
    assert flags["CV25a N25"] == 1 and flags["CV28a N28"] == 1 and flags["CV1 N1"] == 0


def test_cap_is_deterministic(tables):
    ids = [r[0] for r in run(tables, cap=3).select("`Customer BV Task ID`").collect()]
    assert ids == sorted(EXPECTED["repaired"])[:3]
    assert ids == [r[0] for r in run(tables, cap=3).select("`Customer BV Task ID`").collect()]


def test_all_rows_without_a_cap(tables):
    assert CONFIG.cap is None
    assert run(tables).count() == len(EXPECTED["repaired"]) + 1  # PayerB fans out


def test_case_insensitive_collation(spark):
    """Under UTF8_LCASE_RTRIM a lower-case status / program, a padded reason
    and a lower-case 'ca' behave as SQL Server's default collation would."""
    from bvengine.sources.loader import DomainTables
    from golden import build_rows
    from bvengine.sources.schemas import DOMAIN_SCHEMAS

    rows = build_rows()
    pm1 = dict(rows["program_member"][0])
    assert pm1["id"] == "PM1"
    rows["program_member"][0].update(status_mvn__c="pending", program_name_mvn__c="tepro",
                                     status_reason_mvn__c="Benefits Investigation  ")
    for c in rows["contact_info"]:
        if c["account_mvn__c"] == "PAT18":
            c["state_mvn__c"] = "ca"   # would pass the binary <> 'CA'
    frames = {n: spark.createDataFrame([tuple(r.get(f.name) for f in DOMAIN_SCHEMAS[n].fields) for r in rs],
                                       DOMAIN_SCHEMAS[n]) for n, rs in rows.items()}
    binary = {r[0] for r in run(DomainTables.from_frames(frames)).select("`Customer BV Task ID`").collect()}
    ci = {r[0] for r in run(DomainTables.from_frames(frames, collation="UTF8_LCASE_RTRIM"))
          .select("`Customer BV Task ID`").collect()}
    assert "CV1 N1" not in binary and "CV18 N18" in binary
    assert "CV1 N1" in ci and "CV18 N18" not in ci
    assert ci - {"CV1 N1"} == binary - {"CV18 N18"}
