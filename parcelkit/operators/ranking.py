"""Ordering, limits, sampling and splits.

* ``hash_split``   -- deterministic train/test split from a key hash (does not
                      depend on partitioning, unlike ``randomSplit``).
* ``holdout_tail`` -- the last ``int(fraction * n)`` rows by an order become the
                      validation split, via ``global_index`` (no single-task
                      window).
* ``top_k`` / ``argmax_row`` / ``sample_n`` -- bounded outputs: Spark plans
  ``orderBy().limit(k)`` as a TakeOrderedAndProject (per-task top-k, then k
  rows merged), and ``max(struct)`` as a partial aggregate.
* ``best_model`` -- highest score strictly above a floor, ties -> first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.functions.stats import global_index


def key_hash(cols: list[str], seed: int = 42) -> Column:
    """64-bit hash of the key (well mixed; the library default)."""
    return F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))


def hash_split(df: DataFrame, hash_col: Column, test_fraction: float = 0.2, buckets: int | None = None,
               out: str = "split") -> DataFrame:
    """``out`` = 'test' for a ``test_fraction`` share of hash buckets, else
    'train'.  Disjoint and complete by construction.  There are 100 buckets,
    or as many powers of ten as the fraction has decimals to be met exactly."""
    if buckets is None:
        buckets = 100
        while buckets < 10 ** 15 and abs(test_fraction * buckets - round(test_fraction * buckets)) > 1e-9 * buckets ** 0.5:
            buckets *= 10
    cut = int(round(test_fraction * buckets))
    return df.withColumn(out, F.when(F.pmod(hash_col, F.lit(buckets)) < cut, F.lit("test"))
                         .otherwise(F.lit("train")))


def holdout_tail(df: DataFrame, order: list, fraction: float = 0.2, out: str = "split") -> DataFrame:
    """Rows after position n - int(fraction * n) in ``order`` -> 'validation'.

    ``order`` must be a total order of ascending columns.  Only the key columns
    are ranked, to find the last training key; the rows are then compared with
    it in a projection, so they are not moved."""
    names = [f"o{i}" for i in range(len(order))]
    keys = global_index(df.select(*[c.alias(k) for c, k in zip(order, names)]), [F.col(k) for k in names], "_at")
    n = keys.count()
    cut = n - int(n * fraction)
    if cut == 0:
        return df.withColumn(out, F.lit("validation"))
    last = keys.where(F.col("_at") == cut).select(F.struct(*names).alias("k")).scalar()
    key = F.struct(*[c.alias(k) for c, k in zip(order, names)])
    return df.withColumn(out, F.when(key > last, F.lit("validation")).otherwise(F.lit("train")))


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(o, *[F.col(c) for c in (tiebreak or [])]).limit(k)


def argmax_row(df: DataFrame, by: str, key: list[str]) -> DataFrame:
    """The row with the largest ``by``; ties -> smallest key (of any type).
    A sort with limit 1, which Spark runs as a top-1 per task and one merge."""
    best = df.where(F.col(by).isNotNull()).orderBy(F.col(by).desc(), *[F.col(c).asc() for c in key]).limit(1)
    return best.select(*key, *[c for c in df.columns if c != by and c not in key], by)


def sample_n(df: DataFrame, hash_col: Column, n: int = 100) -> DataFrame:
    """Deterministic fixed-size sample: the ``n`` rows with the smallest hash
    (min(n, rows) rows)."""
    return df.withColumn("_h", hash_col).orderBy("_h").limit(n).drop("_h")


def best_model(metrics: DataFrame, model_col: str = "model", score: str = "r2", order_col: str = "position",
               floor: float = 0.0) -> DataFrame:
    """Highest ``score`` strictly above ``floor``; ties -> the earlier model in
    ``order_col``.  Empty when no model beats the floor."""
    cand = metrics.where(F.col(score) > floor)
    best = cand.agg(F.max(F.struct(F.col(score), (-F.col(order_col)).alias("_o"), F.col(model_col))).alias("_b"))
    return best.where(F.col("_b").isNotNull()).select(F.col(f"_b.{model_col}").alias(model_col),
                                                      F.col(f"_b.{score}").alias(score))
