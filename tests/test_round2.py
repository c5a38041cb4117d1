"""Missing numbers, tolerant reads, streams that resume, and statistics under odd input."""
import math
import shutil

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from parcelkit.functions.stats import exact_quantiles
from parcelkit.operators import clean as C
from parcelkit.operators import encode as E
from parcelkit.operators import fairness as FA
from parcelkit.operators import ml as ML
from parcelkit.operators import profile as P
from parcelkit.operators import quality as Q
from parcelkit.operators import ranking as R
from parcelkit.plans.registry import round_to
from parcelkit.session import scratch_path
from parcelkit.sources import files as S
from parcelkit.sources.tables import read_table, table_path
from parcelkit.streaming import feedback_stream as ST

NAN = float("nan")


def test_rounding_keeps_large_and_infinite_values(spark):
    values = [1e15, 3e16, -4e17, math.inf, -math.inf, 1.00005, -2.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.r for r in df.select("i", round_to(F.col("v")).alias("r")).orderBy("i").collect()]
    assert got == [1e15, 3e16, -4e17, math.inf, -math.inf, 1.0001, -2.5, None]


def test_nan_is_a_missing_number(spark):
    df = spark.createDataFrame([(v, "a") for v in (NAN, 1.0, 2.0, 3.0, None)], "AREA double, kind string")
    assert C.fit_impute(df, {"numerical": ["AREA"]}).values["AREA"] == 2.0
    assert [r.AREA for r in C.fit_impute(df, {"numerical": ["AREA"]}).apply(df).collect()] == [2.0, 1.0, 2.0, 3.0, 2.0]
    assert C.fit_outliers(df, ["AREA"]).bounds["AREA"] == (0.0, (2.5 + 1.5) * 1.5)
    assert {r["column"]: r["missing_ratio"] for r in Q.missing_ratios(df).collect()} == {"AREA": 0.4, "kind": 0.0}
    assert not [r for r in Q.quality_suite(df, Q.Rules(0.5, {"AREA": (0.0, 5.0)})).collect()]
    row = P.column_profile(df).where("feature = 'AREA'").first()
    assert (row.missing_values, row.unique_values, row["mean"], row["max"]) == (2, 3, 2.0, 3.0)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (NAN,)], "v double")
    assert P.column_profile(zeros).first().unique_values == 1


def test_invalid_year_is_not_clipped_and_keys_stay(spark):
    df = spark.createDataFrame([(i, 1950 + i % 40 if i else 0, float(i)) for i in range(50)],
                               "row_id bigint, YR_BUILT bigint, AREA double")
    bounds = C.fit_outliers(df, ["YR_BUILT", "AREA"], skip_integers=True).bounds
    assert "YR_BUILT" not in bounds and "AREA" in bounds
    out = C.clean_numeric(df, ["YR_BUILT", "AREA"], keep=["row_id"])
    assert dict(out.dtypes)["row_id"] == "bigint" and out.where("YR_BUILT = 0").count() == 1


def test_null_category_sets_the_unknown_flag(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "T string")
    out = E.apply_encoders(df, E.fit_encoders(df, ["T"])).collect()
    assert sum(r["T_UNKNOWN"] for r in out) == 1.0
    assert all(r["T_A"] + r["T_B"] + r["T_UNKNOWN"] == 1.0 for r in out)


def test_csv_keeps_short_rows_and_counts_alike(spark):
    path = scratch_path(spark, "csv")
    lines = ['" ID ","a,b",GROSS_AREA', "1,x,10", "2,y", "3,z,30,extra", '4,"q, r","1,000"']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    df = S.read_assessments_csv(spark, path)
    assert df.columns == ["ID", "a,b", "GROSS_AREA"]
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("1", "x", 10.0), ("2", "y", None), ("4", "q, r", 1000.0)]
    assert df.count() == df.select("ID").count() == 3


def test_rules_fall_back_key_by_key(spark):
    path = scratch_path(spark, "rules")
    spark.createDataFrame([('{"numeric_bounds": {"A": {"min": 1, "max": 2}}}',)], "value string").coalesce(1).write.text(path)
    assert S.load_rules(spark, path) == Q.Rules(Q.DEFAULT_MISSING_THRESHOLD, {"A": (1.0, 2.0)})
    assert S.load_rules(spark, path + "-absent") == Q.Rules()
    bad = scratch_path(spark, "rules")
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.text(bad)
    with pytest.raises(ValueError):
        S.load_rules(spark, bad)


def test_small_fractions_and_text_keys(spark):
    df = spark.range(200_000).withColumn("h", F.xxhash64("id"))
    n = R.hash_split(df, F.col("h"), 0.004).where("split = 'test'").count()
    assert 600 < n < 1000
    t = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 1.0)], "k string, v double")
    assert tuple(R.argmax_row(t, "v", ["k"]).first()) == ("a", 2.0)
    tail = R.holdout_tail(spark.range(10).toDF("k"), [F.col("k")], 0.3).where("split = 'validation'")
    assert sorted(r.k for r in tail.collect()) == [7, 8, 9]


def test_one_group_has_weight_one(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (2.0, 2.0, 1)], "y double, p double, g int")
    assert {tuple(r)[3:] for r in FA.sample_weights(df, "y", "p", "g").collect()} == {(1.0, 1.0)}


def test_quantiles_when_the_sketch_misses(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 4000), rng.lognormal(size=4000), strict=True)]
    rows += [(9, 1.0)] * 50 + [(8, None), (7, NAN)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    probs = [0.0, 0.1, 0.5, 0.97, 1.0]
    for accuracy in (1, 10, 2000):
        out = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, list("abcde"), count_col="n", accuracy=accuracy).collect()}
        assert set(out) == {0, 1, 2, 9}
        for g, r in out.items():
            mine = [v for k, v in rows if k == g]
            assert np.allclose(tuple(r)[1:6], np.quantile(mine, probs), rtol=1e-12) and r.n == len(mine)


def test_sinks_and_registered_metrics(spark):
    from parcelkit.operators import metrics as M
    from parcelkit.operators import validation as V
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 2.0)], "k string, y double, p double")
    for fmt in ("json", "csv", "parquet"):
        path = scratch_path(spark, "report")
        S.write_report(df, path, fmt)
        back = spark.read.option("header", True).schema(df.schema).format(fmt).load(path).select(*df.columns)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    path = scratch_path(spark, "table")
    S.append_table(df, path)
    S.append_table(df.limit(1), path, None)
    assert spark.read.parquet(path).count() == 3
    profile, top = V.column_statistics(df, k=1)
    assert profile.count() == 3 and top.count() == 3
    M.register_metric("bias", lambda y, p: F.avg(p - y))
    try:
        assert df.agg(M.metric_columns("y", "p", ["bias"])["bias"].alias("b")).first().b == 0.5
    finally:
        M.METRICS.pop("bias")


def test_boosting_keeps_the_best_round():
    assert ML.best_round([5, 4, 3, 3.5, 3.4, 1], patience=2) == 3
    assert ML.best_round([5, 4, 3], patience=2) == 3 and ML.best_round([1, 2, 3, 4], patience=50) == 1
    assert set(ML.TRAINING_CONFIGS) == {"random_forest", "gbt"}
    assert ML.TRAINING_CONFIGS["random_forest"]["numTrees"] == 500 and ML.TRAINING_CONFIGS["gbt"]["stepSize"] == 0.05


def test_stream_resumes_without_loss_or_duplicates(spark):
    """Two files, one run each with the same folders, then a replay of nothing."""
    events = read_table(spark, SF_SMALL, "events")
    source = scratch_path(spark, "events")
    paths = ST.StreamPaths.fresh(spark, "resume")
    halves = [events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")]
    seen = 0
    for part in halves:
        part.coalesce(1).write.mode("append").parquet(source)
        acc, rej = ST.stream_validate(spark, ST.file_stream(spark, source, events.schema), paths)
        seen += part.count()
        assert acc.count() + rej.count() == seen
    acc, rej = ST.stream_validate(spark, ST.file_stream(spark, source, events.schema), paths)
    both = acc.unionByName(rej)
    assert both.count() == both.select("id").distinct().count() == events.count()
    shutil.rmtree(source.removeprefix("file:"))


def test_stream_output_is_found_under_a_file_uri(spark):
    root = "file://" + scratch_path(spark, "uri").removeprefix("file://")
    stream = ST.file_stream(spark, table_path(SF_SMALL, "events"), read_table(spark, SF_SMALL, "events").schema)
    paths = ST.StreamPaths(f"{root}/out", f"{root}/checkpoint")
    assert ST.stream_feedback_daily(spark, stream, paths=paths).count() > 0
    none = ST.StreamPaths(f"{root}/none", f"{root}/checkpoint-2")
    empty = ST.file_stream(spark, table_path(SF_SMALL, "events"), read_table(spark, SF_SMALL, "events").schema).where("false")
    assert ST.stream_feedback_daily(spark, empty, mode="append", paths=none).count() == 0


def test_no_machine_local_scratch_on_a_cluster():
    from parcelkit import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Cluster:
        conf = Conf()
    with pytest.raises(ValueError):
        session.checkpoint_root(Cluster())


def test_registered_training_queries_run_the_declared_settings(spark, monkeypatch):
    """Each query up to its first fits, of which only the arguments are looked at."""
    from parcelkit.operators import forest as FO
    from parcelkit.plans import q_ml
    calls = []

    class Stop(Exception):
        pass

    def fit(df, features, label, name="random_forest", **params):
        calls.append((name, params))
        if name == "gbt" or queried == "rf":
            raise Stop
        return type("Model", (), {"transform": lambda self, x: x.withColumn("prediction", x[label])})()

    def stored(df, features, label, **params):
        return fit(df, features, label, "random_forest", **params)

    def patient(train_df, validation_df, features, label, **params):   # its first block is shorter than maxIter
        return fit(train_df, features, label, "gbt", **params)

    def search(df, features, label, key, draws, **kw):
        assert draws == ML.sample_grid(ML.RF_SEARCH, len(draws)) and kw["base"] == ML.TRAINING_CONFIGS["random_forest"]
        calls.append(("space", ML.RF_SEARCH))
        raise Stop

    frame = spark.createDataFrame([(i, 1, 1, 1, 1.0, float(i), float(i), i % 2, "test" if i % 5 == 0 else "train")
                                   for i in range(40)], [*q_ml.KEY, q_ml.Y, "x", "OWN_OCC", "split"])
    monkeypatch.setattr(q_ml, "_ml_frame", lambda spark, sf: frame)
    monkeypatch.setattr(ML, "train", fit)
    monkeypatch.setattr(ML, "train_with_patience", patient)
    monkeypatch.setattr(FO, "stored_forest", stored)
    monkeypatch.setattr(FO, "search_forest", search)
    forest, boosted = (("random_forest", ML.TRAINING_CONFIGS["random_forest"]), ("gbt", ML.TRAINING_CONFIGS["gbt"]))
    for query, queried, expected in (
            (q_ml.q_rf_score, "rf", [forest]), (q_ml.q_gbt_score, "", [boosted]), (q_ml.q_train_models, "", [forest, boosted]),
            (q_ml.q_run_log, "", [forest, boosted]), (q_ml.q_random_search, "", [("space", ML.RF_SEARCH)]),
            (q_ml.q_feature_importance, "rf", [forest]), (q_ml.q_batch_score, "rf", [forest])):
        calls.clear()
        try:
            query(spark, None)
        except Stop:
            pass
        assert calls == expected, query.__name__


def test_train_models_cuts_boosting_back_to_its_best_round(spark):
    rows = spark.createDataFrame([(float(i % 7), float(i % 7 * 10 + (i * 37) % 11), i % 3) for i in range(120)], "x double, y double, p int")
    train, validation, test = (rows.where(f"p = {k}") for k in range(3))
    params = {"gbt": {"maxIter": 6, "stepSize": 0.9, "maxDepth": 2}}
    res = ML.train_models(train, test, ["x"], "y", ["gbt"], params, validation)
    _, errors = ML.train_with_patience(train, validation, ["x"], "y", **params["gbt"])
    assert res[0].model.stages[-1].getNumTrees == ML.best_round(errors) < 6


def test_mitigation_queries_run_the_whole_grid_and_rounds(spark, monkeypatch):
    from parcelkit.plans import pipeline as PL
    from parcelkit.plans import q_ml
    calls = []

    def rounds(df, features, label, sensitive, key, rounds=3, **kw):
        calls.append((rounds, kw.get("grid_size"), len(features)))
        raise ValueError

    monkeypatch.setattr(PL, "evaluate_and_mitigate", rounds)
    for query in (q_ml.q_bias_mitigation_rounds, q_ml.q_mitigated_predictions):
        with pytest.raises(ValueError):
            query(spark, SF_SMALL)
    assert [c[:2] for c in calls] == [(3, None)] * 2 and all(c[2] > 3 for c in calls)
    rows = [(i, i % 2, float(i), float(i + (1 if i % 2 == 0 else far))) for far in (1, 2) for i in range(10)]
    near, far = (spark.createDataFrame(part, "k int, g int, y double, prediction double") for part in (rows[:10], rows[10:]))
    assert PL.constraint_grid(near, "y", "g") == (-4, -1, 10) and PL.constraint_grid(far, "y", "g") == (-3, -1, 15)
