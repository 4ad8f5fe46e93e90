"""Declared schemas of the silver tables, contract checks (Q8, Q9) and type normalisation before publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    """'name type!' per column; ! marks a required column."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "ntz": T.TimestampNTZType()}
    out = T.StructType()
    for part in spec.split(","):
        name, kind = part.split()
        out.add(name, kinds[kind.rstrip("!")], not kind.endswith("!"))
    return out


# Columns, types and required columns of the published tables.
SUBMISSIONS = struct(
    "adsh string!, cik int!, name string, sic int, countryba string, stprba string, fye string, form string, period date, fy int, fp string, filed date, accepted ntz, prevrpt boolean, detail boolean, "
    "instance string, nciks int, quarter string!, source_sha256 string!, loaded_at ntz!"
)
FACTS = struct(
    "adsh string!, cik int!, tag string!, version string!, ddate date!, qtrs int!, uom string!, value double, coreg string, footnote string, form string, fy int, fp string, knowledge_date date!, "
    "fact_key string!, quarter string!, source_sha256 string!, loaded_at ntz!, segments string, is_dimensional boolean!"
)
PROCESSED = struct("dataset string!, quarter string!, source_sha256 string!, n_submissions int!, n_facts int!, processed_at ntz!")
FACT_VERSIONS = struct(
    "fact_key string, cik int, tag string, ddate date, qtrs int, uom string, coreg string, segments string, is_dimensional boolean, value double, footnote string, adsh string, form string, fy int, "
    "fp string, taxonomy_version string, valid_from date, valid_to date, version_no bigint, n_versions bigint, is_latest boolean"
)


class ContractError(ValueError):
    """A frame breaks its declared schema."""


def schema_differences(df: DataFrame, declared: T.StructType) -> list[str]:
    """Q8: what differs in names, order and types; nullability isn't compared."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in declared]
    if have == want:
        return []
    return [f"missing {n} {t}" for n, t in want if (n, t) not in have] + [f"unexpected {n} {t}" for n, t in have if (n, t) not in want] or ["columns are in another order"]


def require_filled(df: DataFrame, declared: T.StructType) -> int:
    """Q9: rows of df; raises if a required column holds nulls. One pass for both."""
    required = [f.name for f in declared if not f.nullable]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in required)).first()
    if bad := {c: row[c] for c in required if row[c]}:
        raise ContractError("required columns hold nulls: " + ", ".join(f"{c} ({n})" for c, n in bad.items()))
    return row["__rows"]


def conform(df: DataFrame, declared: T.StructType, check: bool = True) -> DataFrame:
    """Cast to the declared columns; raise if a required column holds nulls (Q9). check=False leaves the scan out."""
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ContractError(f"columns missing: {', '.join(missing)}")
    out = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared))
    if check:
        require_filled(out, declared)
    return out


def normalize_for_publish(df: DataFrame) -> DataFrame:
    """Decimals to double, byte and short to bigint, other types as they are."""
    def of(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType | T.FloatType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, T.ByteType | T.ShortType):
            return F.col(f"`{f.name}`").cast("bigint").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*map(of, df.schema.fields))
