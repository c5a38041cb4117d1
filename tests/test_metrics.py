"""Metrics, disparities, gate, fairness (FIXTURES section 6)."""
import numpy as np
from pyspark.sql import functions as F

from parcelkit.operators import fairness as FA
from parcelkit.operators import metrics as M


def _frame(spark, rows):
    return spark.createDataFrame(rows, "y double, pred double, group bigint")


def test_regression_metrics_match_numpy(spark):
    rng = np.random.default_rng(7)
    y = rng.normal(100, 20, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, pred double")
    m = M.regression_metrics(df, "y", "pred").first().asDict()
    r = y - p
    assert abs(m["r2"] - (1 - np.sum(r ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-9
    assert abs(m["rmse"] - np.sqrt(np.mean(r ** 2))) < 1e-9
    assert abs(m["median_error"] - np.median(np.abs(r))) < 1e-9
    assert abs(m["std_residuals"] - np.std(r)) < 1e-9
    assert abs(m["mape"] - np.mean(np.abs(r / y)) * 100) < 1e-9
    v = M.validation_metrics(df, "y", "pred").first()
    assert abs(v["r2"] - np.corrcoef(p, y)[0, 1] ** 2) < 1e-9


def test_group_min_size(spark):
    rows = [(float(i), float(i) + 1, 0) for i in range(6)] + [(float(i), float(i) - 1, 1) for i in range(4)]
    g = {r["group"]: r for r in M.group_metrics(_frame(spark, rows), "y", "pred", "group", min_size=5).collect()}
    assert g[0]["rmse"] == 1.0 and g[1]["rmse"] is None and g[None]["n"] == 10 and g[None]["level"] == "overall"


def test_disparities_two_groups(spark):
    rows = [(10.0, 12.0, 0)] * 5 + [(20.0, 21.0, 1)] * 5
    by = M.group_metrics(_frame(spark, rows), "y", "pred", "group", overall=False)
    d = {r["disparity"]: r["value"] for r in M.disparities(by).collect()}
    assert d["rmse_difference"] == -1.0 and d["rmse_ratio"] == 0.5
    assert d["mean_prediction_difference"] == 9.0
    assert "r2_ratio" not in d      # r2 of constant y is NaN -> dropped


def test_disparities_single_group_empty(spark):
    by = M.group_metrics(_frame(spark, [(1.0, 2.0, 0)] * 6), "y", "pred", "group", overall=False)
    assert M.disparities(by).count() == 0


def test_no_ratio_when_unprivileged_zero(spark):
    rows = [(float(i), float(i), 0) for i in range(5)] + [(float(i), float(i) + 2, 1) for i in range(5)]
    by = M.group_metrics(_frame(spark, rows), "y", "pred", "group", overall=False)
    d = {r["disparity"]: r["value"] for r in M.disparities(by).collect()}
    assert "rmse_ratio" not in d and d["rmse_difference"] == 2.0


def test_threshold_table_directions(spark):
    long = spark.createDataFrame([("r2", 0.9), ("rmse", 2.0), ("mae", 0.5), ("n", 10.0)], "metric string, value double")
    t = {r["metric"]: r["passed"] for r in M.threshold_table(long).collect()}
    assert t == {"r2": True, "rmse": False, "mae": True, "n": True}
    compat = {r["metric"]: r["passed"] for r in M.threshold_table(long, compat=True).collect()}
    assert compat["rmse"] is True and compat["mae"] is False
    assert M.gate(M.threshold_table(long)).first()[0] is False


def test_sample_weights_and_calibration(spark):
    rows = [(100.0, 90.0, 0)] * 6 + [(200.0, 150.0, 1)] * 4
    df = _frame(spark, rows)
    w = {r["group"]: (r["weight_pass1"], r["weight_pass2"]) for r in
         FA.sample_weights(df, "y", "pred", "group").select("group", "weight_pass1", "weight_pass2").distinct().collect()}
    assert w[0][1] == 10 / 12 and w[1][1] == 10 / 8
    c = {r["group"]: r["calibration_factor"] for r in FA.calibrate(df, "y", "pred", "group").select(
        "group", "calibration_factor").distinct().collect()}
    assert c == {0: 1.0, 1: 1.0}        # scaling group 1 would widen the gap: not kept
    df2 = _frame(spark, [(100.0, 80.0, 0)] * 6 + [(200.0, 200.0, 1)] * 4)
    c2 = {r["group"]: r["calibration_factor"] for r in FA.calibrate(df2, "y", "pred", "group").select(
        "group", "calibration_factor").distinct().collect()}
    assert abs(c2[0] - 1.25) < 1e-12 and c2[1] == 1.0


def test_bias_report_flags(spark):
    rows = [(100.0 + i, 100.0 + i, 0) for i in range(10)] + [(300.0 + i, 380.0 + i, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "y double, pred double, OWN_OCC bigint")
    long = FA.sensitive_long(df, {"OWN_OCC": "OWN_OCC"}, "y", "pred")
    rep = FA.bias_report(FA.bias_metrics(long), ["OWN_OCC"]).first()
    assert rep["significant"] is True
    assert "Average predictions are $" in rep["interpretation"]


def test_best_model_floor(spark):
    m = spark.createDataFrame([("a", 1, -0.1), ("b", 2, 0.5), ("c", 3, 0.5)], "model string, position int, r2 double")
    assert M_best(m) == ("b", 0.5)


def M_best(m):
    from parcelkit.operators.ranking import best_model
    r = best_model(m).first()
    return (r["model"], r["r2"])
