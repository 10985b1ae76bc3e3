import pytest

from bvengine.__main__ import main
from bvengine.sources.schemas import DOMAIN_SCHEMAS, OUTPUT_COLUMNS
from bvengine.sources.sink import write_worklist
from golden import AS_OF, CONFIG, EXCLUDED, EXPECTED, golden_tables
from pyspark.errors import AnalysisException

RUN = ["--parity", "repaired", "--excluded-provider", *EXCLUDED]


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    t = golden_tables(spark)
    for name in DOMAIN_SCHEMAS:
        getattr(t, name).write.parquet(str(root / name))
    return str(root)


def test_cli_writes_capped_csv(spark, tables_dir, tmp_path):
    out = str(tmp_path / "worklist")
    main(["--tables-dir", tables_dir, "--as-of", "2024-02-03T12:00:00", "--out", out, "--format", "csv", "--cap", "5", *RUN])
    with pytest.raises(AnalysisException):  # an earlier list stays
        main(["--tables-dir", tables_dir, "--as-of", "2024-02-03T12:00:00", "--out", out, "--format", "csv", *RUN])
    df = spark.read.option("header", True).csv(out)
    assert df.columns == OUTPUT_COLUMNS
    assert df.count() == 5
    assert len(spark.sparkContext.wholeTextFiles(out + "/*.csv").collect()) == 1


def test_cli_uncapped_parquet(spark, tables_dir, tmp_path):
    out = str(tmp_path / "all")
    main(["--tables-dir", tables_dir, "--as-of", "2024-02-03T12:00:00", "--out", out, "--parity", "intent", *RUN[2:]])
    got = {r[0] for r in spark.read.parquet(out).select("`Customer BV Task ID`").collect()}
    assert got == EXPECTED["intent"]


def test_write_rejects_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        write_worklist(spark.range(1), str(tmp_path / "x"), fmt="xlsx")


def test_from_catalog_reads_named_tables(spark):
    """Catalog tables by name (temporary views here stand in for the
    warehouse's schema.table names)."""
    from bvengine.plans.extract import benefit_verification_extract
    from bvengine.sources.loader import DomainTables

    t = golden_tables(spark)
    names = {}
    for name in DOMAIN_SCHEMAS:
        view = f"bv_test_{name}"
        getattr(t, name).createOrReplaceTempView(view)
        names[name] = view
    cat = DomainTables.from_catalog(spark, names)
    got = {r[0] for r in benefit_verification_extract(cat, AS_OF, CONFIG)
           .select("`Customer BV Task ID`").collect()}
    assert got == EXPECTED["repaired"]


def test_cli_explain_prints_the_plan(spark, tables_dir, capsys):
    main(["--tables-dir", tables_dir, "--as-of", "2024-02-03T12:00:00", "--cap", "9", "--explain", *RUN])
    out = capsys.readouterr().out
    assert "TakeOrderedAndProject" in out and "PushedFilters" in out


def test_cli_rule_parameters(spark, tables_dir, tmp_path):
    out = str(tmp_path / "params")
    main(["--tables-dir", tables_dir, "--as-of", "2024-02-03T12:00:00", "--out", out, "--parity", "repaired", "--no-excluded-provider",
          "--excluded-state", "NY", "--program", "KRYSTEXXA", "--program", "TEPRO", "--consent-type", "HIPAA Authorization"])
    got = {r[0] for r in spark.read.parquet(out).select("`Customer BV Task ID`").collect()}
    assert got == {"CV11 N11", "CV18 N18"}  # the members whose newest contact is in CA


def test_run_parameters_are_required(tables_dir, tmp_path):
    for argv in (["--tables-dir", tables_dir, "--out", str(tmp_path / "x"), *RUN[2:]], ["--tables-dir", tables_dir, "--out", str(tmp_path / "x"), *RUN[:2]]):
        with pytest.raises(SystemExit):
            main(argv)
    from bvengine.config import RulesConfig

    with pytest.raises(TypeError):
        RulesConfig(parity="repaired")
    with pytest.raises(TypeError):
        RulesConfig(excluded_providers=())


def test_from_catalog_wants_every_name(spark):
    from bvengine.sources.loader import DomainTables, load

    with pytest.raises(KeyError):
        DomainTables.from_catalog(spark, {"account": "x"})
    with pytest.raises(ValueError):
        load(spark, "account")
