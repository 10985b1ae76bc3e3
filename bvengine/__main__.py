"""Command line: run the extract and write it.

    python -m bvengine --parity repaired --excluded-provider FIRST LAST \\
        (--tables-dir DIR | --table NAME=QUALIFIED ...) --out /path/worklist \\
        [--as-of 2024-02-03T12:00:00] [--cap 1024] [--format parquet|csv] [--overwrite] \\
        [--excluded-state CA] [--program NAME ...] [--consent-type NAME ...] \\
        [--time-zone America/Chicago] [--collation UTF8_LCASE_RTRIM] [--explain]

``--tables-dir`` reads ``DIR/<name>`` Parquet for each of the nine tables
(account, contact_info, program_member, benefits_coverage,
authorization_consent, payer_mapping, record_type, outbound_log,
allcare_log); ``--table`` names all nine in the catalog instead.  Without
``--as-of`` the clock is now, in ``--time-zone`` if given, else in the
driver's zone.  ``--no-excluded-provider`` stands in for the pairs where none
is excluded.  ``--explain`` prints the formatted physical plan instead of
writing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import zoneinfo

from pyspark.sql import SparkSession

from .config import PARITY_MODES, RULES, RulesConfig
from .plans.extract import benefit_verification_extract
from .sources.loader import DomainTables
from .sources.schemas import DOMAIN_SCHEMAS
from .sources.sink import write_worklist


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="bvengine", description=__doc__.split("\n\n")[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables-dir", help="folder with one Parquet folder per table")
    src.add_argument("--table", action="append", metavar="NAME=QUALIFIED", help="catalog name of one table; give all nine")
    p.add_argument("--as-of", help="wall-clock time, ISO format (default: now)")
    p.add_argument("--parity", required=True, choices=PARITY_MODES,
                   help="how the three defective membership lists are read (README, Parity)")
    who = p.add_mutually_exclusive_group(required=True)
    who.add_argument("--excluded-provider", nargs=2, action="append", metavar=("FIRST", "LAST"))
    who.add_argument("--no-excluded-provider", action="store_true")
    p.add_argument("--excluded-state", default=RULES.excluded_state)
    p.add_argument("--program", action="append", help=f"default: {', '.join(RULES.programs)}")
    p.add_argument("--consent-type", action="append", help=f"default: {', '.join(RULES.consent_types)}")
    p.add_argument("--cap", type=int, help="keep that many rows (default: all)")
    p.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    p.add_argument("--overwrite", action="store_true", help="replace an earlier list")
    p.add_argument("--time-zone", help="whose wall clock columns of instants are read in")
    p.add_argument("--collation", help="e.g. UTF8_LCASE_RTRIM for case-insensitive, trailing-blank-insensitive text")
    p.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of writing")
    p.add_argument("--out", help="output folder (required unless --explain)")
    a = p.parse_args(argv)
    if not a.explain and not a.out:
        p.error("--out is required unless --explain is given")
    return a


def main(argv=None) -> None:
    a = parse_args(argv)
    spark = SparkSession.builder.appName("bvengine-extract").getOrCreate()
    if a.tables_dir:
        paths = {n: f"{a.tables_dir.rstrip('/')}/{n}" for n in DOMAIN_SCHEMAS}
        t = DomainTables.from_paths(spark, paths, a.collation, a.time_zone)
    else:
        t = DomainTables.from_catalog(spark, dict(kv.split("=", 1) for kv in a.table), a.collation, a.time_zone)
    zone = zoneinfo.ZoneInfo(a.time_zone) if a.time_zone else None
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now(zone).replace(microsecond=0, tzinfo=None)
    cfg = RulesConfig(
        parity=a.parity, cap=a.cap, excluded_providers=tuple(map(tuple, a.excluded_provider or ())), excluded_state=a.excluded_state,
        programs=tuple(a.program or RULES.programs), consent_types=tuple(a.consent_type or RULES.consent_types),
    )
    df = benefit_verification_extract(t, as_of, cfg)
    if a.explain:
        df.explain("formatted")
        return
    write_worklist(df, a.out, a.format, "overwrite" if a.overwrite else "errorifexists")


if __name__ == "__main__":
    main()
