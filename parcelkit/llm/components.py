"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import drop_table, materialize


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> tuple[DataFrame, str]:
    """Every larger neighbour of a node is hung below the node's smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least, path = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()), path


def _small_star(edges: DataFrame) -> tuple[DataFrame, str]:
    """A node and its smaller neighbours are hung below the smallest of them."""
    least, path = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct(), path


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v): every node u of ``edges`` (a, b: bigint, any order) that is not the smallest of
    its component, with that smallest node v.

    Minima are partial aggregates, so a node with very many edges is combined
    before the shuffle; they are written before they are joined, so the join is
    one whose hot nodes AQE can split.  The edge table of a step is written to
    the shared folder and the one before it removed.  Ends when a step changes
    nothing (a logarithmic number)."""
    spark = edges.sparkSession
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, path = materialize(oriented, "edges")
    state = _fingerprint(current)
    while state[0]:
        large, least_path = _large_star(current)
        middle, middle_path = materialize(large, "edges")
        small, less_path = _small_star(middle)
        following, new_path = materialize(small, "edges")
        new_state = _fingerprint(following)
        drop_table(spark, path, least_path, middle_path, less_path)
        current, path = following, new_path
        if new_state == state:
            break
        state = new_state
    return current
