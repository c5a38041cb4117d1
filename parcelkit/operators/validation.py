"""Data validation: column statistics with top values, schema inference
(type, presence, small string domains), and validation of new data against
a saved schema -> anomaly rows.

The expected schema is a small table (one row per column, domains capped at
``max_domain`` values), so comparing column sets is a join of two tables
bounded by the column count, and out-of-domain values are a left-anti join
against a broadcast domain table (bounded by columns x ``max_domain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.operators.profile import column_profile


def top_values(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """(column, value, count, rank) of the ``k`` most frequent values per
    column; ``rank <= k`` is planned with a partial group limit before the
    shuffle, so a high-cardinality column costs k rows per task."""
    long = df.select(F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
                     .alias("column", "value")).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def column_statistics(df: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(profile, top values) -- the statistics a schema is inferred from."""
    return column_profile(df), top_values(df, df.columns, k)


def infer_schema(df: DataFrame, max_domain: int = 20) -> DataFrame:
    """(column, type, required, domain): required when the column has no
    nulls; domain = sorted distinct values of string columns with at most
    ``max_domain`` values (else null)."""
    prof = column_profile(df).select(F.col("feature").alias("column"), "type", "missing_values", "unique_values")
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    small = [r["column"] for r in prof.where(F.col("column").isin(strings) & (F.col("unique_values") <= max_domain))
             .select("column").collect()]                        # bounded: column names
    if small:
        long = df.select(F.stack(F.lit(len(small)), *[x for c in small for x in (F.lit(c), F.col(f"`{c}`"))])
                         .alias("column", "value")).where(F.col("value").isNotNull())
        dom = long.groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("domain"))  # <= max_domain each
        prof = prof.join(F.broadcast(dom), "column", "left")
    else:
        prof = prof.withColumn("domain", F.lit(None).cast("array<string>"))
    return prof.select("column", "type", (F.col("missing_values") == 0).alias("required"), "domain")


def validate_against(df: DataFrame, schema: DataFrame) -> DataFrame:
    """Anomalies (column, anomaly, detail) of ``df`` against an inferred
    schema: missing_column, unexpected_column, type_mismatch,
    missing_required (nulls in a required column, count), out_of_domain
    (values outside the domain, count)."""
    spark = df.sparkSession
    actual = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                   "column string, actual_type string")
    j = schema.join(actual, "column", "full_outer")
    structural = j.select(
        "column",
        F.when(F.col("type").isNull(), F.lit("unexpected_column"))
         .when(F.col("actual_type").isNull(), F.lit("missing_column"))
         .when(F.col("type") != F.col("actual_type"), F.lit("type_mismatch")).alias("anomaly"),
        F.when((F.col("type").isNotNull()) & (F.col("actual_type").isNotNull()) & (F.col("type") != F.col("actual_type")),
               F.concat(F.lit("expected "), F.col("type"), F.lit(", got "), F.col("actual_type")))
         .otherwise(F.lit("")).alias("detail")).where(F.col("anomaly").isNotNull())
    rows = schema.select("column", "type", "required", "domain").collect()   # one row per column
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    req = [r["column"] for r in rows if r["required"] and present.get(r["column"]) == r["type"]]
    dom_cols = [r for r in rows if r["domain"] is not None and present.get(r["column"]) == r["type"]]
    parts = [structural]
    if req:
        nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in req]).unpivot([], req, "column", "n")
        parts.append(nulls.where(F.col("n") > 0).select("column", F.lit("missing_required").alias("anomaly"),
                                                          F.col("n").cast("string").alias("detail")))
    if dom_cols:
        names = [r["column"] for r in dom_cols]
        domain = spark.createDataFrame([(r["column"], v) for r in dom_cols for v in r["domain"]],
                                       "column string, value string")
        long = df.select(F.stack(F.lit(len(names)), *[x for c in names for x in (F.lit(c), F.col(f"`{c}`"))])
                         .alias("column", "value")).where(F.col("value").isNotNull())
        bad = long.join(F.broadcast(domain), ["column", "value"], "left_anti")
        parts.append(bad.groupBy("column").agg(F.count(F.lit(1)).cast("string").alias("detail"))
                     .select("column", F.lit("out_of_domain").alias("anomaly"), "detail"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validation_status(anomalies: DataFrame) -> DataFrame:
    """One row: status text and anomaly count."""
    return anomalies.agg(F.count(F.lit(1)).alias("anomalies")).select(
        F.when(F.col("anomalies") == 0, F.lit("valid")).otherwise(F.lit("anomalies found")).alias("status"),
        "anomalies")
