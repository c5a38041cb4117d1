"""User feedback jobs: record validation, visibility, daily metrics, retrain
signal and valuation history.

All aggregates are decomposable (count / sum / sum of squares), so Spark runs
them as partial + final hash aggregates: a hot day or user is combined
map-side before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.functions.numeric import deviation
from parcelkit.session import cut_lineage

# Table constraints and submit checks.
CONFIDENCE_RANGE = (1, 10)
PRICE_RANGE = (50_000, 5_000_000)
CONFIRM_DEVIATION = 0.5
REQUIRED = ["predicted_price", "actual_price", "confidence", "property_data", "user_id"]


@dataclass(frozen=True)
class RetrainLimits:
    min_count: int = 50
    max_rmse: float = 150_000.0
    max_mae: float = 100_000.0
    max_avg_deviation: float = 0.3
    min_confidence: int = 7
    lookback_days: int = 30


def validate_feedback(df: DataFrame, price_col: str = "actual_price",
                      predicted_col: str = "predicted_price") -> DataFrame:
    """Split-ready validation: adds ``deviation`` (4 decimals, as stored),
    ``needs_confirmation``, ``reasons`` ('; '-joined, '' when valid) and
    ``accepted``."""
    a, p, c = F.col(price_col), F.col(predicted_col), F.col("confidence")
    dev = F.round(deviation(a, p), 4)
    checks = [F.when(F.col(r).isNull(), F.lit(f"{r} is null")) for r in REQUIRED]
    checks += [
        F.when(~c.between(*CONFIDENCE_RANGE), F.lit("confidence out of range")),
        F.when(~a.between(*PRICE_RANGE), F.lit("actual_price out of range")),
        F.when(p.isNotNull() & a.isNotNull() & dev.isNull(), F.lit("deviation undefined")),
    ]
    reasons = F.array_compact(F.array(*checks))
    return (df.withColumn("deviation", dev)
              .withColumn("needs_confirmation", F.coalesce(dev > CONFIRM_DEVIATION, F.lit(False)))
              .withColumn("reasons", F.concat_ws("; ", reasons))
              .withColumn("accepted", F.size(reasons) == 0))


def visible_to(df: DataFrame, caller: str | Column, user_col: str = "user_id") -> DataFrame:
    """Row-level visibility: a caller reads only their own rows."""
    caller = F.lit(caller) if isinstance(caller, str) else caller
    return df.where(F.col(user_col) == caller)


def high_confidence_recent(df: DataFrame, as_of: Column, limits: RetrainLimits = RetrainLimits(),
                           ts_col: str = "created_at") -> DataFrame:
    since = as_of - F.make_dt_interval(days=F.lit(limits.lookback_days))
    return df.where((F.col("confidence") >= limits.min_confidence) & (F.col(ts_col) >= since))


def _error_aggs(a: str = "actual_price", p: str = "predicted_price") -> list[Column]:
    err = F.col(a) - F.col(p)
    return [
        F.count(F.lit(1)).alias("feedback_count"),
        F.avg("deviation").alias("avg_deviation"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
    ]


def feedback_daily(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """Daily metrics, newest day first."""
    return (df.groupBy(F.to_date(ts_col).alias("date"))
              .agg(*_error_aggs(), F.avg("confidence").alias("avg_confidence"))
              .orderBy(F.col("date").desc()))


def retrain_needed(df: DataFrame, as_of: Column | None = None,
                   limits: RetrainLimits = RetrainLimits(), ts_col: str = "created_at") -> DataFrame:
    """One row: the trailing-window metrics and the retrain flag.

    ``as_of`` defaults to the newest record, taken as a scalar subquery (no
    join).  A SQL null in the comparison counts as false, as in the table
    function.
    """
    if as_of is None:
        as_of = df.select(F.max(ts_col)).scalar()
    recent = high_confidence_recent(df, as_of, limits, ts_col)
    m = recent.agg(*_error_aggs())
    flag = (F.col("feedback_count") >= limits.min_count) & (
        (F.col("rmse") > limits.max_rmse) | (F.col("mae") > limits.max_mae)
        | (F.col("avg_deviation") > limits.max_avg_deviation))
    return m.withColumn("retrain_needed", F.coalesce(flag, F.lit(False)))


def recent_history(df: DataFrame, user_col: str = "user_id", ts_col: str = "created_at",
                   n: int = 50, tiebreak: str = "id") -> DataFrame:
    """Newest ``n`` records per user with their rank (1 = newest).

    ``row_number() <= n`` is planned with a partial window-group-limit
    before the shuffle, so each map task sends at most ``n`` rows per user:
    a hot user costs n x tasks rows, not all of its rows.
    """
    w = Window.partitionBy(user_col).orderBy(F.col(ts_col).desc(), F.col(tiebreak).desc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def valuation_change(df: DataFrame, user_col: str = "user_id", ts_col: str = "created_at",
                     value_col: str = "predicted_price", tiebreak: str = "id") -> DataFrame:
    """Previous valuation of the same user and the change to it.

    Skew-safe: rows are range-partitioned on (user, time) once, and written
    with their partition's number, so a hot user is spread over many tasks and
    both reads agree on the borders; the predecessor of each task's first row
    per user comes from a table of per-(partition, user) last values, bounded
    by partitions + users.
    """
    order = [user_col, ts_col, tiebreak]
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", user_col).orderBy(ts_col, tiebreak)
    local = (ranged.withColumn("_prev", F.lag(value_col).over(w))
                   .withColumn("_first", F.row_number().over(w) == 1))
    last = (local.groupBy("_pid", user_col)
                 .agg(F.max_by(F.col(value_col), F.struct(ts_col, tiebreak)).alias("_last")))
    wl = Window.partitionBy(user_col).orderBy("_pid")
    carry = last.select("_pid", user_col, F.lag("_last").over(wl).alias("_carry"))
    out = (local.join(carry, ["_pid", user_col], "left")
                .withColumn("prev_" + value_col,
                            F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))))
    return (out.withColumn("change", F.col(value_col) - F.col("prev_" + value_col))
               .drop("_pid", "_prev", "_first", "_carry"))
