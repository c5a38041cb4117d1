"""Positions, idempotent logs, VARIANT payloads, mergeable statistics and saved stages."""
import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from parcelkit.operators import encode as E
from parcelkit.operators import ml as ML
from parcelkit.operators import sketches as SK
from parcelkit.operators import stages as ST
from parcelkit.session import scratch_path
from parcelkit.sources import files as S
from parcelkit.sources.positions import align_by_position, read_with_position


def test_rows_are_aligned_by_place(spark):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    ids = spark.range(1000, numPartitions=7)
    ids.write.parquet(a)
    spark.range(1000, numPartitions=3).select((F.col("id") * 10).alias("ten")).write.parquet(b)
    out = align_by_position(spark, a, b, keep=True).collect()
    assert len(out) == 1000 and all(r.ten == 10 * r.id and r._position == r.id for r in out)
    # A filter on the result does not move positions.
    assert read_with_position(spark, a).where("id = 777").first()._position == 777
    short = scratch_path(spark, "c")
    spark.range(999).select(F.col("id").alias("x")).write.parquet(short)
    with pytest.raises(ValueError):
        align_by_position(spark, a, short)
    with pytest.raises(ValueError):
        align_by_position(spark, a, a)
    empty = scratch_path(spark, "d")
    spark.range(0).write.parquet(empty)
    assert read_with_position(spark, empty).count() == 0


def test_a_retry_leaves_one_copy(spark):
    path = scratch_path(spark, "log")
    S.log_run(spark, path, "run-1", "gbt", {"rmse": 2.0}, {"depth": 3})
    S.log_run(spark, path, "run-1", "forest", {"rmse": 1.0})
    S.log_run(spark, path, "2", "gbt", {"rmse": 5.0})
    S.log_run(spark, path, "run-1", "gbt", {"rmse": 2.5}, {"depth": 3})
    rows = S.read_runs(spark, path).drop("ts").collect()
    assert sorted(tuple(r) for r in rows) == [("2", "gbt", "metric", "rmse", "5.0"), ("run-1", "forest", "metric", "rmse", "1.0"),
                                              ("run-1", "gbt", "metric", "rmse", "2.5"), ("run-1", "gbt", "param", "depth", "3")]


def test_schema_file_of_a_broken_path_is_not_created(spark):
    path = scratch_path(spark, "schema")
    made = S.schema_or_create(spark.range(1), path)
    assert made == S.schema_or_create(spark.range(1).select(F.col("id").alias("other")), path)
    with pytest.raises(Exception) as e:
        S.schema_or_create(spark.range(1), "nosuchscheme://x/y")
    assert "nosuchscheme" in str(e.value)


def test_payloads_of_any_shape(spark):
    rows = [('{"a": 1.5, "b": {"c": [1, "x"]}}',), ('{"a": "2.5"}',), ('{"a": {"v": 3}}',), ('{"a": null}',), ('{"a": [1]}',),
            ('{"a": true}',), ("{}",), ("not json",), (None,)]
    d = S.parse_payload(spark.createDataFrame(rows, "property_data string"))
    got = d.select(S.payload_field("payload", ["$.a", "$.a.v"], "double").alias("a"), S.payload_kind("payload", "$.a").alias("k"),
                   S.payload_field("payload", ["$.b.c[1]"], "string").alias("x")).collect()
    assert [r.k for r in got] == ["number", "text", "object", "null", "array", "boolean", "absent", "absent", "absent"]
    assert [r.a for r in got][:5] == [1.5, 2.5, 3.0, None, None] and got[0].x == "x"
    assert S.payload_schema(d.limit(2)).startswith("OBJECT<a:")


def test_statistics_merge(spark):
    rng = random.Random(2)
    rows = [(i % 9, rng.choice([None, 0.0, float("nan"), rng.gauss(0, 5), rng.gauss(100, 1)]), rng.choice([None, "", "abc"]), None)
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "day int, x double, t string, nothing double")
    stats = SK.daily_statistics(df, ["day"], ["x", "nothing"], ["t"])
    halves = SK.merge_statistics(stats.withColumn("half", F.col("day") % 2), ["half"])
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    for merged in (SK.merge_statistics(stats), SK.merge_statistics(halves)):
        got = {r["column"]: r for r in SK.sketch_quantiles(merged, probs).collect()}
        x = sorted(v for _, v, _, _ in rows if v is not None and not math.isnan(v))
        assert (got["x"].n, got["x"].nulls, got["x"].zeros) == (len(x), 20_000 - len(x), sum(v == 0 for v in x))
        assert (got["x"].least, got["x"].greatest) == (x[0], x[-1]) and math.isclose(got["x"].total, math.fsum(x), rel_tol=1e-9)
        for p, q in zip(probs, got["x"].quantiles):
            below, upto = sum(v < q for v in x) / len(x), sum(v <= q for v in x) / len(x)
            assert below <= p + SK.RANK_ERROR and upto >= p - SK.RANK_ERROR
        assert got["nothing"].n == 0 and got["nothing"].quantiles is None and got["t"].greatest == 3.0
        bins = SK.quantile_histogram(merged, 4).where("column = 'x'").orderBy("bin").collect()
        assert len(bins) == 4 and bins[0].low == x[0] and bins[3].high == x[-1]


def test_saved_cleaning_and_encoding(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.randint(500, 3000)) if i % 7 else None, rng.choice(["Ranch ", "cape cod", None]), f"T{i % 30}",
             rng.choice(["Good", "Poor"]), float(rng.randint(1, 9) * 1000)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, GROSS_AREA double, STYLE string, OWNER string, EXT_CONDITION string, TOTAL_VALUE double")
    cleaning = ST.fit_cleaning(df, ["k"], "TOTAL_VALUE")
    cleaned = cleaning.transform(df)
    encoding = ST.fit_encoding(cleaned, ["STYLE", "OWNER", "EXT_CONDITION"], scratch_path(spark, "vocabularies"))
    direct = E.apply_encoders(cleaned, E.fit_encoders(cleaned, ["STYLE", "OWNER", "EXT_CONDITION"]))
    encoded = encoding.transform(cleaned)
    assert sorted(map(tuple, encoded.collect())) == sorted(map(tuple, direct.collect()))
    features = [c for c in encoded.columns if c not in ("k", "TOTAL_VALUE") and dict(encoded.dtypes)[c] != "string"]
    model = Pipeline(stages=[cleaning, encoding, ML.assembler(features), ML.get_model("linear", label="TOTAL_VALUE")]).fit(df)
    path = scratch_path(spark, "pipeline")
    ML.save_model(model, path)
    loaded = PipelineModel.load(path)
    unseen = df.union(spark.createDataFrame([(999, None, "never", "seen", None, 1.0)], df.schema))
    want, got = ([tuple(r) for r in m.transform(unseen).select("k", "prediction").orderBy("k").collect()] for m in (model, loaded))
    assert want == got and len(got) == 301 and loaded.stages[0].fitted()["values"]["GROSS_AREA"] is not None
