"""Model metrics: regression metrics, validation metrics, grouped metrics
with an overall row, disparities, threshold table, champion selection.

All metrics are aggregate expressions (``metric_columns``) so that any
grouping -- none, by group, rollup -- computes them in one partial+final
hash aggregate.  The only non-decomposable statistic, the median absolute
error, uses the skew-safe ``exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.functions.stats import exact_quantiles

# Default validation thresholds (metric -> threshold).
VALIDATION_THRESHOLDS = {"r2": 0.8, "rmse": 1.0, "mae": 0.8}
# Direction used by the fixed gate (the compat gate uses >= for all).
HIGHER_IS_BETTER = {"r2": True, "rmse": False, "mae": False, "mape": False}
DISPARITY_METRICS = ["rmse", "r2", "mae", "mean_prediction", "prediction_difference"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r2_score(y, pred) -> Column:
    """1 - SSE / SST as one aggregate expression."""
    y, p = _c(y), _c(pred)
    e = y - p
    # constant y: SST = 0 -> r2 undefined (null), not a division error
    return 1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))


def _rmse(y, p):
    return F.sqrt(F.avg((y - p) * (y - p)))


def _mae(y, p):
    return F.avg(F.abs(y - p))


# Metric registry: name -> builder(y, pred) of an aggregate Column.  Users add
# a grouped metric with ``register_metric`` (a native expression, no UDF).
METRICS = {
    "rmse": _rmse,
    "r2": r2_score,
    "mae": _mae,
    "mean_prediction": lambda y, p: F.avg(p),
    "prediction_difference": lambda y, p: F.avg(F.abs(p - y)),
}


def register_metric(name: str, builder) -> None:
    METRICS[name] = builder


def metric_columns(y, pred, names: list[str] | None = None) -> dict[str, Column]:
    y, p = _c(y), _c(pred)
    return {k: METRICS[k](y, p) for k in (names or DISPARITY_METRICS)}


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: r2, rmse, mae, mape (%), std_residuals (population),
    max_error, median_error (exact), mean_prediction, std_prediction."""
    yy, p = F.col(y), F.col(pred)
    e = yy - p
    med = exact_quantiles(df.select(F.abs(e).alias("_ae")), [], "_ae", [0.5], ["median_error"])
    return df.agg(
        r2_score(yy, p).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(F.try_divide(e, yy))) * 100).alias("mape"),
        F.stddev_pop(e).alias("std_residuals"),
        F.max(F.abs(e)).alias("max_error"),
        F.avg(p).alias("mean_prediction"),
        F.stddev_pop(p).alias("std_prediction"),
    ).withColumn("median_error", med.select("median_error").scalar())


def validation_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: r2 = corr(pred, y)^2 (the validation definition), rmse, mae."""
    yy, p = F.col(y), F.col(pred)
    return df.agg(F.pow(F.corr(p, yy), 2).alias("r2"), F.sqrt(F.avg((p - yy) * (p - yy))).alias("rmse"),
                  F.avg(F.abs(p - yy)).alias("mae"))


def group_metrics(df: DataFrame, y: str, pred: str, group: str, min_size: int | None = None,
                  overall: bool = True) -> DataFrame:
    """Metrics per group plus (``overall``) one overall row (level='overall',
    group null) from a single rollup aggregate.  With ``min_size``, metrics
    of smaller groups are null."""
    cols = metric_columns(y, pred)
    n = F.count(F.lit(1))
    aggs = [n.alias("n")]
    for k, v in cols.items():
        aggs.append((F.when(n >= min_size, v) if min_size else v).alias(k))
    if overall:
        out = df.rollup(group).agg(*aggs, F.grouping(group).alias("_lvl"))
    else:
        out = df.groupBy(group).agg(*aggs, F.lit(0).alias("_lvl"))
    return out.select(F.when(F.col("_lvl") == 1, F.lit("overall")).otherwise(F.lit("group")).alias("level"),
                      F.col(group).alias("group"), "n", *cols.keys())


def disparities(by_group: DataFrame, group: str = "group", privileged=1, unprivileged=0,
                metrics: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """(disparity, value): ``{m}_difference`` = privileged - unprivileged and
    ``{m}_ratio`` when the unprivileged value is not 0; only when there are
    exactly two groups; null / NaN / inf values are dropped."""
    metrics = metrics or DISPARITY_METRICS
    g = F.col(group)
    aggs = [F.count(F.lit(1)).alias("_ng")]
    for m in metrics:
        aggs += [F.max(F.when(g == privileged, F.col(m))).alias(f"p_{m}"),
                 F.max(F.when(g == unprivileged, F.col(m))).alias(f"u_{m}")]
    by = by or []
    wide = by_group.groupBy(*by).agg(*aggs).where(F.col("_ng") == 2)
    entries = []
    for m in metrics:
        p, u = F.col(f"p_{m}"), F.col(f"u_{m}")
        entries += [F.lit(f"{m}_difference"), p - u, F.lit(f"{m}_ratio"), F.when(u != 0, F.try_divide(p, u))]
    long = wide.select(*by, F.stack(F.lit(len(entries) // 2), *entries).alias("disparity", "value"))
    v = F.col("value")
    return long.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def threshold_table(metrics_long: DataFrame, thresholds: dict[str, float] | None = None,
                    compat: bool = False) -> DataFrame:
    """(metric, value, threshold, passed); no threshold -> passed.  Fixed
    gate compares in each metric's direction; ``compat`` uses >= for all."""
    thresholds = VALIDATION_THRESHOLDS if thresholds is None else thresholds
    spark = metrics_long.sparkSession
    th = spark.createDataFrame([(k, float(v), True if compat else HIGHER_IS_BETTER.get(k, True))
                                for k, v in thresholds.items()], "metric string, threshold double, higher boolean")
    j = metrics_long.join(F.broadcast(th), "metric", "left")  # thresholds: one row per metric
    v, t = F.col("value"), F.col("threshold")
    ok = F.when(F.col("higher"), v >= t).otherwise(v <= t)
    return j.select("metric", "value", "threshold", F.coalesce(ok, F.lit(True)).alias("passed"))


def gate(table: DataFrame) -> DataFrame:
    """One row: validation_passed = every metric passed."""
    return table.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("validation_passed"))


def to_long(one_row: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or one_row.columns
    return one_row.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "metric", "value")
