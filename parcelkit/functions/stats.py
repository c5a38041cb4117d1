"""Distributed statistics helpers that stay bounded under key skew.

Spark's ``percentile`` / ``median`` / ``mode`` aggregates keep a value->count
map per group and merge all of a group's maps in one task, so one hot group
(a third of the rows, continuous values) would be held in one task.  The
helpers below avoid that:

* ``exact_quantiles`` -- a mergeable sketch brackets each wanted rank, then one
  aggregate counts what lies between the brackets and the values inside them:
  no value is shuffled unless it is within a bracket.  Same result as DuckDB
  ``quantile_cont`` / pandas linear interpolation.
* ``group_modes`` -- counts per (group, value), then a ``min`` of a struct
  (partial aggregation): the smallest most-frequent value.
* ``global_index`` -- a 1-based row number over a total order without a
  single-partition window: range exchange + in-partition position + offsets
  per partition (broadcast; bounded by the partition count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from parcelkit.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def nan_to_null(c: Column, kind) -> Column:
    """A missing number is null or NaN; floating columns get NaN as null."""
    floating = kind in ("double", "float") or isinstance(kind, (DoubleType, FloatType))
    return F.when(~F.isnan(c), c) if floating else c


def missing(df: DataFrame, name: str) -> Column:
    """True where a column has no value: null, or NaN in a floating column."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nulls_for_nan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN of floating columns as null, the others untouched."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))
             and (cols is None or f.name in cols)]
    return df.withColumns({n: nan_to_null(F.col(f"`{n}`"), "double") for n in names}) if names else df


def _pin(df: DataFrame, checkpoint: bool) -> DataFrame:
    """A range-partitioned frame that is read twice (rows and per-partition
    totals), written once: both reads then see the same partition boundaries
    even if Spark does not reuse the exchange or recomputes a stage after an
    executor loss."""
    if not checkpoint:
        return df
    return cut_lineage(df)


def global_index(df: DataFrame, order_cols: list, name: str = "_idx",
                 num_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Append a 1-based position ``name`` following ``order_cols``.

    ``order_cols`` must be a total order (include a unique tiebreak) so the
    result is deterministic.
    """
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ordered = _pin(ranged
                   .sortWithinPartitions(*order_cols)
                   .withColumn("_mid", F.monotonically_increasing_id())
                   .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
                   .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)), checkpoint)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # offsets has one row per partition: a proven bound, so broadcast is safe.
    return (ordered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_pos") + 1)
            .drop("_mid", "_pid", "_pos", "_off"))


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    c = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, (DoubleType, FloatType)):
        df = df.withColumn(value_col, F.nanvl(c, F.lit(None)) + F.lit(0.0))   # NaN is missing, -0.0 is 0.0
    return (df.where(c.isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))


def group_modes(df: DataFrame, group_cols: list[str], value_col: str,
                out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group; ties -> smallest value."""
    vc = value_counts(df, group_cols, value_col)
    best = vc.groupBy(*group_cols).agg(
        F.min(F.struct((-F.col("_c")).alias("neg"), F.col(value_col).alias("v"))).alias("_m"))
    return best.select(*group_cols, F.col("_m.v").alias(out))


#: Rank precision of the brackets: a bracket holds about 4 / ACCURACY of a group's rows.
ACCURACY = 5000
#: Up to so many groups, brackets and results pass through the driver; beyond, through written tables.
FEW_GROUPS = 1000


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], names: list[str] | None = None,
                    count_col: str | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value_col`` per group.

    Two passes of partial aggregation, no shuffle of values: a mergeable sketch
    gives a bracket around each wanted rank, then one aggregate counts the rows
    between the brackets (one row per gap) and the values inside them (a small
    share), so ranks inside a bracket are exact.  Should a sketch have missed a
    rank, the groups in question are counted value by value.

    Nulls and NaN are ignored; a group with no values yields no row.  With
    ``count_col`` the number of values per group is returned too.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    g = list(group_cols) or ["_g"]
    base = df if group_cols else df.withColumn("_g", F.lit(0))
    value = F.col(value_col).cast("double")
    base = base.select(*g, F.when(~F.isnan(value), value + F.lit(0.0)).alias("_x")).where(F.col("_x").isNotNull())
    around = [min(1.0, max(0.0, p + side * 2.0 / accuracy)) for p in probs for side in (-1, 1)]
    sketch = F.percentile_approx("_x", F.array(*map(F.lit, around)), F.lit(accuracy))
    brackets = base.groupBy(*g).agg(sketch.alias("_b"))
    few = brackets.limit(FEW_GROUPS + 1).collect()
    bounded = len(few) <= FEW_GROUPS
    if bounded:
        brackets = F.broadcast(df.sparkSession.createDataFrame(few, brackets.schema))
    else:   # written, so that its size is known and the join below broadcasts it only where it is small
        brackets = cut_lineage(brackets)
    found = _ranked(base.join(brackets, g), g, probs, names)
    rows = found.collect() if bounded else None
    exact = df.sparkSession.createDataFrame(rows, found.schema) if bounded else cut_lineage(found)
    missed = exact.where(F.col("_missed"))
    if any(r["_missed"] for r in rows) if bounded else not missed.isEmpty():
        whole = base.join(missed.select(*g), g).withColumn(
            "_b", F.array(*[F.lit(float(s + "inf")) for _ in probs for s in ("-", "")]))
        exact = exact.where(~F.col("_missed")).unionByName(_ranked(whole, g, probs, names))
    res = exact.select(*g, *names, *([F.col("_n").alias(count_col)] if count_col else []))
    return res if group_cols else res.drop("_g")


def _ranked(rows: DataFrame, g: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """(groups, quantiles, _n, _missed) from rows ``_x`` with their group's brackets ``_b``."""
    x, inside, passed = F.col("_x"), F.lit(False), F.lit(0)
    for i in range(len(probs)):
        low, high = F.col("_b")[2 * i], F.col("_b")[2 * i + 1]
        inside = inside | ((x >= low) & (x <= high))
        passed = passed + (x > high).cast("int")
    counted = (rows.select(*g, F.when(inside, x).alias("_v"), F.when(~inside, passed).alias("_gap"), "_x")
               .groupBy(*g, "_v", "_gap").agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_first")))
    # Written first, as the range partitions sample what they deal out.  Positions within range partitions, and their
    # offsets (one row per partition and group): no task gets a whole group.
    ranged = cut_lineage(cut_lineage(counted).repartitionByRange(*g, "_first").withColumn("_pid", F.spark_partition_id()))
    ahead = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid", *g).agg(F.sum("_c").alias("_cnt"))
               .select("_pid", *g, F.coalesce(F.sum("_cnt").over(ahead), F.lit(0)).alias("_off"),
                       F.sum("_cnt").over(Window.partitionBy(*g)).alias("_n")))
    upto = Window.partitionBy("_pid", *g).orderBy("_first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (ranged.withColumn("_at", F.sum("_c").over(upto)).join(offsets, ["_pid", *g])
              .withColumn("_hi", F.col("_off") + F.col("_at")).withColumn("_lo", F.col("_hi") - F.col("_c")))
    aggs, outs, missed = [F.max("_n").alias("_n")], [], F.lit(False)
    for k, p in enumerate(probs):
        at = (F.col("_n") - 1) * F.lit(float(p))
        for side, rank in (("a", F.floor(at)), ("b", F.ceil(at))):
            aggs.append(F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_v"))).alias(f"_{side}{k}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_f{k}"))
        low, high = F.col(f"_a{k}"), F.col(f"_b{k}")
        outs.append((low + (high - low) * F.col(f"_f{k}")).alias(names[k]))
        missed = missed | low.isNull() | high.isNull()
    return ranked.groupBy(*g).agg(*aggs).select(*g, *outs, "_n", missed.alias("_missed"))


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name_col: str = "column",
            value_col: str = "value", cast: str | None = None) -> DataFrame:
    """Long form (ids..., name_col, value_col); values cast to one type."""
    vals = [nan_to_null((F.col(c).cast(cast) if cast else F.col(c)), cast or df.schema[c].dataType).alias(c)
            for c in cols]
    wide = df.select(*ids, *vals)
    return wide.unpivot(ids, cols, name_col, value_col)
