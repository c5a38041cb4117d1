"""Rows of files without a key, aligned by their place.

A row's position is the number of rows in the files before its own (by path)
plus its index in the file, both from the files' metadata: no sort, and no task
that sees more than its split.  The offsets are one row per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = "_position"


def read_with_position(spark: SparkSession, path: str, name: str = POSITION) -> DataFrame:
    """The Parquet table at ``path`` with the 0-based position of each row.

    Files count in the order of their paths, as writers number their parts; an
    empty file holds no positions.  A column called ``name`` is an error."""
    table = spark.read.parquet(path)
    if name in table.columns:
        raise ValueError(f"the table has a column {name!r}")
    placed = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    counts = placed.groupBy("_file").agg((F.max("_index") + 1).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    offsets = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_file").withColumn(name, F.col("_before") + F.col("_index")).drop("_file", "_index", "_before")


def align_by_position(spark: SparkSession, left: str, right: str, name: str = POSITION, keep: bool = False) -> DataFrame:
    """The columns of two Parquet tables of equal length side by side, row n with row n.

    Tables of different lengths are an error, as is a column name that both have; without ``keep`` the position is
    not returned."""
    a, b = read_with_position(spark, left, name), read_with_position(spark, right, name)
    both = set(a.columns) & set(b.columns) - {name}
    if both:
        raise ValueError(f"both tables have {sorted(both)}")
    lengths = [spark.read.parquet(p).count() for p in (left, right)]   # from the files' footers
    if lengths[0] != lengths[1]:
        raise ValueError(f"{lengths[0]} and {lengths[1]} rows cannot be aligned")
    out = a.join(b, name)
    return out if keep else out.drop(name)
