"""Skew-safe statistics helpers against numpy / pandas."""
import numpy as np
from pyspark.sql import functions as F

from parcelkit.functions.stats import exact_quantiles, global_index, group_modes


def test_exact_quantiles_skewed_groups(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(0, 1, 3000)            # one group holds most rows
    cold = rng.normal(5, 2, 301)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("one", 7.0), ("nul", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    q = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.9], ["a", "b", "c"]).collect()}
    for name, arr in (("hot", hot), ("cold", cold)):
        expect = np.quantile(arr, [0.25, 0.5, 0.9])
        assert np.allclose([q[name]["a"], q[name]["b"], q[name]["c"]], expect, rtol=0, atol=1e-12)
    assert q["one"]["b"] == 7.0 and "nul" not in q


def test_exact_quantile_ties_and_global(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 2, 3, 10]], "v double")
    r = exact_quantiles(df, [], "v", [0.0, 0.5, 0.75, 1.0], ["a", "b", "c", "d"]).first()
    assert (r["a"], r["b"], r["c"], r["d"]) == tuple(np.quantile([1, 2, 2, 2, 3, 10], [0, 0.5, 0.75, 1.0]))


def test_modes_tie_smallest(spark):
    df = spark.createDataFrame([("x", "B"), ("x", "A"), ("x", "B"), ("x", "A"), ("y", None), ("y", "C")], "g string, v string")
    assert {r["g"]: r["mode"] for r in group_modes(df, ["g"], "v").collect()} == {"x": "A", "y": "C"}


def test_global_index_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(9)
    out = global_index(df, [F.col("k")], "pos", num_partitions=6).orderBy("k").collect()
    assert [r["pos"] for r in out] == list(range(1, 5001))


def test_quantile_ranks_are_not_counted_in_one_task_per_group(spark):
    from parcelkit.functions import stats
    rows = spark.range(20000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 20011).cast("double").alias("_x"))
    whole = rows.withColumn("_b", F.array(*[F.lit(float(s + "inf")) for _ in (1, 2) for s in ("-", "")]))
    ranked = stats._ranked(whole, ["g"], [0.25, 0.9], ["a", "b"])
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    ordered = [line for line in plan.splitlines() if "Window" in line and "_first" in line]
    assert ordered and all("_pid" in line for line in ordered)
    for r in ranked.collect():
        x = np.array([v._x for v in rows.where(F.col("g") == r.g).collect()])
        assert np.allclose([r.a, r.b], np.quantile(x, [0.25, 0.9])) and not r._missed
