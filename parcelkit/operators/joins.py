"""Join operators: target alignment, membership
flags, outer alignment, geo lookup, champion/challenger, model comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: map fallback position (latitude, longitude).
DEFAULT_POSITION = (42.3601, -71.0589)


def align_target(features: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Positional alignment re-expressed as an equi-join on the carried key."""
    return features.join(target, key, "inner")


def flag_members(df: DataFrame, members: DataFrame, key: str, out: str) -> DataFrame:
    """``out`` = 1 when ``df[key]`` is in ``members[key]``, else 0.  The join
    strategy is left to Spark, which broadcasts the members by their size in
    bytes at run time and otherwise splits skewed keys of a sort-merge join."""
    m = members.select(F.col(key).alias("_mk")).distinct().withColumn("_hit", F.lit(1))
    j = df.join(m, F.col(key) == F.col("_mk"), "left")
    return j.withColumn(out, F.coalesce(F.col("_hit"), F.lit(0)).cast("bigint")).drop("_mk", "_hit")


def geo_lookup(df: DataFrame, zip_dim: DataFrame, zip_col: str = "ZIP_CODE",
               default: tuple[float, float] = DEFAULT_POSITION) -> DataFrame:
    """Attach (latitude, longitude) from a ZIP dimension; absent -> default."""
    dim = zip_dim.select(F.col(zip_col).alias("_z"), F.col("latitude").alias("_lat"),
                         F.col("longitude").alias("_lon"))
    j = df.join(dim, F.col(zip_col) == F.col("_z"), "left")
    return (j.withColumn("latitude", F.coalesce(F.col("_lat"), F.lit(default[0])))
             .withColumn("longitude", F.coalesce(F.col("_lon"), F.lit(default[1])))
             .drop("_z", "_lat", "_lon"))


def promote(new: DataFrame, current: DataFrame, keys: list[str], metric: str = "r2",
            higher_is_better: bool = True) -> DataFrame:
    """Champion/challenger: accept the new model unless it is worse than the
    current one; accept when there is no current model."""
    cur = current.select(*keys, F.col(metric).alias("current_" + metric))
    j = new.select(*keys, F.col(metric).alias("new_" + metric)).join(cur, keys, "left")
    n, c = F.col("new_" + metric), F.col("current_" + metric)
    better = (n >= c) if higher_is_better else (n <= c)
    return j.withColumn("promote", F.coalesce(better, c.isNull()))


def compare_models(preds_a: DataFrame, preds_b: DataFrame, key: list[str], label: str,
                   pred_a: str = "pred_a", pred_b: str = "pred_b") -> DataFrame:
    """Residual statistics of two models scored on the same rows (inner join
    on the row key), one row per model."""
    j = preds_a.select(*key, label, F.col(pred_a).alias("_pa")).join(
        preds_b.select(*key, F.col(pred_b).alias("_pb")), key, "inner")
    long = j.select(label, F.stack(F.lit(2), F.lit(pred_a), F.col("_pa"), F.lit(pred_b), F.col("_pb"))
                    .alias("model", "prediction"))
    r = F.col(label) - F.col("prediction")
    return long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(r).alias("mean_residual"),
        F.stddev_pop(r).alias("std_residual"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        F.corr(F.col(label), F.col("prediction")).alias("corr"),
    )


def outer_align(df: DataFrame, cols: list[str], value_type: str = "double") -> DataFrame:
    """Value counts of several columns aligned on the value (full outer
    semantics: a count is null where the column lacks the value), sorted by
    value.  One unpivot + one aggregate instead of outer joins."""
    long = df.select(F.stack(F.lit(len(cols)), *[x for c in cols for x in
                                               (F.lit(c), F.col(f"`{c}`").try_cast(value_type))])
                     .alias("column", "value")).where(F.col("value").isNotNull())
    aggs = [F.nullif(F.count_if(F.col("column") == c), F.lit(0)).alias(c) for c in cols]
    return long.groupBy("value").agg(*aggs).orderBy("value")


def membership(df: DataFrame, members: DataFrame, key: str, inside: bool = True) -> DataFrame:
    """Rows whose key is (semi) / is not (anti) in ``members``."""
    return df.join(members.select(key).distinct(), key, "left_semi" if inside else "left_anti")
