"""Property tests: one-hot rows sum to 1, splits disjoint and complete,
statistics invariant to partitioning (hypothesis-generated inputs)."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelkit.functions.stats import exact_quantiles
from parcelkit.operators import encode as E
from parcelkit.operators.ranking import hash_split, holdout_tail, key_hash


def test_one_hot_rows_sum_to_one(spark):
    fit = spark.createDataFrame([(c,) for c in "ABCAB"], "kind string")
    enc = E.fit_encoders(fit, ["kind"], max_categories=10)
    data = spark.createDataFrame([(c,) for c in "ABCDXA"] + [(None,)], "kind string")
    out = E.apply_encoders(data, enc)
    cols = [c for c in out.columns if c.startswith("kind_")]
    sums = [r[0] for r in out.select(sum(F.col(c) for c in cols)).collect()]
    assert sums == [1.0] * 7


def test_splits_disjoint_and_complete(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    s = hash_split(df, key_hash(["k"]), 0.2)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 10000 and 1500 < counts["test"] < 2500
    assert s.groupBy("k").count().where("count > 1").count() == 0
    h = holdout_tail(df, [F.col("k")], 0.2)
    assert h.where("split = 'validation'").agg(F.min("k")).first()[0] == 8000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60),
       st.sampled_from([1, 4, 32]))
def test_quantiles_partition_invariant(spark, values, parts):
    import numpy as np
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(parts)
    r = exact_quantiles(df, [], "v", [0.25, 0.5, 0.75], ["a", "b", "c"], accuracy=parts).first()
    expect = np.quantile(np.array(values, dtype=float), [0.25, 0.5, 0.75])
    assert np.allclose([r["a"], r["b"], r["c"]], expect, rtol=1e-12, atol=1e-9)
