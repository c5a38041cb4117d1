"""Column roles (identifier, coordinates, address, boolean, numerical,
datetime, text, categorical) from names, the schema and ONE aggregate pass.

Name rules are substring matches on the lower-cased column name, checked in
this order: identifier > coordinates > address > data type.  The data-type
branch needs three statistics per column, all computed in a single ``agg``:
distinct values within {0, 1} (``bool_and``), the share of strings that parse
as timestamps, and the mean string length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

# Name patterns.
IDENTIFIER_PATTERNS = ["id", "code", "pid", "upi"]
COORDINATE_PATTERNS = ["latitude", "longitude", "coord"]
ADDRESS_PATTERNS = ["address", "street", "city", "state"]
ZIP_PATTERN = "zip"
TEXT_MIN_MEAN_LENGTH = 50
ZIP_MEAN_LENGTH = 5

ROLES = ["categorical", "numerical", "datetime", "address", "coordinates", "identifier", "text", "boolean"]


def matches(name: str, patterns: list[str]) -> bool:
    low = name.lower()
    return any(p in low for p in patterns)


def column_roles(df: DataFrame, overrides: dict[str, str] | None = None,
                 datetime_ratio: float = 0.9) -> dict[str, list[str]]:
    """Role -> column names.  ``overrides`` (column -> role) wins over rules."""
    overrides = overrides or {}
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for name, t in fields.items():
        c = F.col(f"`{name}`")
        if isinstance(t, NumericType):
            aggs.append(F.coalesce(F.bool_and(c.isNull() | c.isin(0, 1)), F.lit(True)).alias(f"b|{name}"))
            if ZIP_PATTERN in name.lower():
                aggs.append(F.avg(F.length(c.cast("string"))).alias(f"l|{name}"))
        elif isinstance(t, StringType):
            nonnull = F.count(c)
            aggs.append((F.count(F.try_to_timestamp(c)) / nonnull).alias(f"d|{name}"))
            aggs.append(F.avg(F.length(c)).alias(f"l|{name}"))
    stats = df.agg(*aggs).first().asDict() if aggs else {}
    roles: dict[str, list[str]] = {r: [] for r in ROLES}
    for name, t in fields.items():
        role = overrides.get(name) or _role(name, t, stats, datetime_ratio)
        roles[role].append(name)
    return roles


def _role(name, t, stats, datetime_ratio) -> str:
    if matches(name, IDENTIFIER_PATTERNS):
        return "identifier"
    if matches(name, COORDINATE_PATTERNS):
        return "coordinates"
    if matches(name, ADDRESS_PATTERNS):
        return "address"
    if ZIP_PATTERN in name.lower() and (isinstance(t, StringType) or stats.get(f"l|{name}") == ZIP_MEAN_LENGTH):
        return "address"
    if isinstance(t, BooleanType):
        return "boolean"
    if isinstance(t, NumericType):
        return "boolean" if stats.get(f"b|{name}") else "numerical"
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        return "datetime"
    if isinstance(t, StringType):
        ratio = stats.get(f"d|{name}")
        if ratio is not None and ratio >= datetime_ratio:
            return "datetime"
        mean_len = stats.get(f"l|{name}")
        if mean_len is not None and mean_len > TEXT_MIN_MEAN_LENGTH:
            return "text"
        return "categorical"
    return "categorical"


def roles_frame(spark: SparkSession, roles: dict[str, list[str]]) -> DataFrame:
    """(column, role) table; its size is bounded by the column count."""
    rows = [(c, r) for r, cs in roles.items() for c in cs]
    return spark.createDataFrame(rows, "column string, role string")
