"""Checked loaders for the domain tables and the driver's test tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType

from .schemas import DOMAIN_SCHEMAS, DRIVER_SCHEMAS


class SchemaError(ValueError):
    pass


def wall_clock(instant, time_zone: str):
    """An instant's wall-clock time in ``time_zone`` (NTZ), whatever the
    session's own zone is."""
    micros = F.unix_micros(F.from_utc_timestamp(instant, time_zone))
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def conform(
    df: DataFrame, schema: StructType, name: str = "table", collation: str | None = None, time_zone: str | None = None
) -> DataFrame:
    """Select the declared columns (case-insensitively) cast to the declared
    types.  A missing column raises; extra columns are pruned (and so never
    read from Parquet).

    The rules work on wall-clock times.  A column of instants (TIMESTAMP with
    local time zone) is refused unless ``time_zone`` says whose wall clock is
    meant; nothing depends on the session's zone.

    ``collation`` (e.g. ``"UTF8_LCASE_RTRIM"``: case-insensitive, trailing
    blanks ignored, like a SQL Server default collation) is applied to every
    string column, so comparisons, LIKE tests, REPLACE, join keys, grouping
    and DISTINCT all follow it.  Default: binary comparison.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise SchemaError(f"{name}: missing column(s) {missing}; has {sorted(df.columns)}")

    def one(f):
        src = have[f.name.lower()]
        c = F.col(f"`{src.name}`")
        if isinstance(f.dataType, TimestampNTZType) and isinstance(src.dataType, TimestampType):
            if time_zone is None:
                raise SchemaError(f"{name}.{src.name} holds instants; pass time_zone to read them as wall-clock times")
            c = wall_clock(c, time_zone)
        elif src.dataType != f.dataType:
            c = c.cast(f.dataType)
        if collation and isinstance(f.dataType, StringType):
            c = F.collate(c, collation)
        renamed = src.name != f.name or src.dataType != f.dataType or collation
        return c.alias(f.name) if renamed else c

    return df.select(*[one(f) for f in schema.fields])


def load(
    spark: SparkSession, name: str, path: str | None = None, table: str | None = None, collation: str | None = None,
    time_zone: str | None = None,
) -> DataFrame:
    """Load one domain table by logical name, from Parquet ``path`` or from a
    catalog ``table``."""
    if name not in DOMAIN_SCHEMAS:
        raise KeyError(f"unknown table {name!r}; known: {sorted(DOMAIN_SCHEMAS)}")
    if (path is None) == (table is None):
        raise ValueError(f"{name}: give either a path or a catalog table")
    df = spark.read.parquet(path) if path is not None else spark.table(table)
    return conform(df, DOMAIN_SCHEMAS[name], name, collation, time_zone)


@dataclass
class DomainTables:
    """The nine inputs of the extract."""

    account: DataFrame
    contact_info: DataFrame
    program_member: DataFrame
    benefits_coverage: DataFrame
    authorization_consent: DataFrame
    payer_mapping: DataFrame
    record_type: DataFrame
    outbound_log: DataFrame
    allcare_log: DataFrame

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame], collation: str | None = None, time_zone: str | None = None) -> "DomainTables":
        return cls(**{f.name: conform(frames[f.name], DOMAIN_SCHEMAS[f.name], f.name, collation, time_zone) for f in fields(cls)})

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], collation: str | None = None, time_zone: str | None = None) -> "DomainTables":
        return cls(**{f.name: load(spark, f.name, path=paths[f.name], collation=collation, time_zone=time_zone) for f in fields(cls)})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str], collation: str | None = None, time_zone: str | None = None) -> "DomainTables":
        """``names`` gives the catalog name of each of the nine tables."""
        missing = [f.name for f in fields(cls) if f.name not in names]
        if missing:
            raise KeyError(f"no catalog name for {missing}")
        return cls(**{f.name: load(spark, f.name, table=names[f.name], collation=collation, time_zone=time_zone) for f in fields(cls)})


DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's test tables (``{sf_dir}/{name}.parquet``), with
    its declared schema when there is one (no footer reads to infer it)."""
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown driver table {name!r}")
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
