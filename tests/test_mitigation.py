"""Mitigation from group moments against plain numpy loops and Spark's weighted fit."""
import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from parcelkit.operators import fairness as FA
from parcelkit.operators import mitigation as MI
from parcelkit.operators import ml as ML
from parcelkit.plans import pipeline as PL

FEATURES = ["a", "b b", "c", "same"]


def table(n=600, gap=40.0):
    rng = np.random.default_rng(4)
    group = (rng.random(n) < 0.3).astype(int)
    a, b = rng.normal(size=n) * 5 + 20, rng.normal(size=n)
    y = 100 + 3 * a + 10 * b + gap * group * (1 + 0.5 * b) + rng.normal(size=n) * (2 + 6 * group)
    return group, np.column_stack([a, b, a + b, np.full(n, 7.0)]), y


def frame(spark, group, x, y):
    rows = [(i, int(g), *map(float, r), float(v)) for i, (g, r, v) in enumerate(zip(group, x, y))]
    return spark.createDataFrame(rows, "k long, g int, a double, `b b` double, c double, same double, y double")


def plain_fit(x, y, w):
    z = np.column_stack([np.ones(len(y)), (x - x.mean(0)) / np.where(x.std(0), x.std(0), 1)])
    return z, np.linalg.pinv((z.T * w) @ z, rcond=1e-11) @ ((z.T * w) @ y)


def test_weighted_fit_equals_spark(spark):
    group, x, y = table()
    df = frame(spark, group, x, y)
    moments = MI.group_moments(df.repartition(4), ["a", "b b"], "y", "g")
    intercept, slopes = moments.raw(moments.fit((0.4, 2.5)))
    weighted = ML.assembler(["a", "b b"]).transform(df.withColumn("w", F.when(F.col("g") == 1, 2.5).otherwise(0.4)))
    spark_fit = LinearRegression(labelCol="y", weightCol="w", solver="normal").fit(weighted)
    assert np.isclose(intercept, spark_fit.intercept, rtol=1e-6)
    assert np.allclose(list(slopes.values()), spark_fit.coefficients.toArray(), rtol=1e-6)


def test_group_metrics_and_score_equal_row_computation(spark):
    group, x, y = table()
    df = frame(spark, group, x, y)
    moments = MI.group_moments(df, FEATURES, "y", "g")
    fit = moments.fit((1.0, 3.0))
    intercept, slopes = moments.raw(fit)
    predicted = df.withColumn("prediction", MI.linear_prediction(intercept, slopes))
    wide = FA.disparity_score(FA.disparity_wide(predicted, "y", "prediction", "g"), F.lit(float(y.mean()))).first()
    assert np.isclose(MI.disparity(moments.metrics(fit), moments.mean_label), wide.disparity_score)
    assert np.isclose(PL.disparity_scores(predicted, "y", "g", ["prediction"])[0], wide.disparity_score)
    z, plain = plain_fit(x, y, np.where(group == 1, 3.0, 1.0))
    assert np.allclose([r.prediction for r in predicted.orderBy("k").collect()], z @ plain)
    span = np.ptp(y)
    assert np.allclose(moments.squared(fit), [np.mean((y - z @ plain)[group == g] ** 2) / span ** 2 for g in (0, 1)])


def plain_loop(group, x, y, loss, bound, shares, steps, rounds=MI.ROUNDS, most=100.0, rate=2.0):
    """The reduction on rows: losses of every answer computed from its residuals."""
    n = np.bincount(group)
    fits, table_ = [], []
    for s in np.linspace(0, 1, steps)[1:-1]:
        z, c = plain_fit(x, y, np.where(group == 1, s / n[1], (1 - s) / n[0]))
        error = np.abs(y - z @ c) / np.ptp(y)
        fits.append(c)
        table_.append([np.mean((error ** 2 if loss == "squared_loss" else error)[group == g]) for g in (0, 1)])
    table_, theta, answers = np.array(table_), np.zeros(2), []
    for _ in range(rounds):
        lam = most * np.exp(theta) / (1 + np.exp(theta).sum())
        answers.append(min(range(len(fits)), key=lambda i: (shares + lam) @ table_[i]))
        theta = theta + rate * (table_[answers[-1]] - bound) / table_.max()
    mean = np.mean([fits[i] for i in answers], 0)
    error = np.abs(y - z @ mean) / np.ptp(y)
    own = [np.mean((error ** 2 if loss == "squared_loss" else error)[group == g]) for g in (0, 1)]
    return mean, np.mean([table_[i] for i in answers], 0), own


@pytest.mark.parametrize("loss", MI.LOSSES)
def test_bound_holds_on_an_injected_gap(spark, loss):
    group, x, y = table()
    moments = MI.group_moments(frame(spark, group, x, y), FEATURES, "y", "g")
    options = MI.answers(frame(spark, group, x, y), moments, "y", "g", steps=41)
    shares = moments.rows / moments.rows.sum()
    alone = options.losses[loss]
    plain_losses = alone[int((alone @ shares).argmin())]
    reachable = alone.max(1).min()
    assert plain_losses.max() > 1.1 * reachable
    bound = float((plain_losses.max() + reachable) / 2)
    got = MI.bounded_group_loss(options, shares, loss, bound)
    mean, losses, own = plain_loop(group, x, y, loss, bound, shares, 41)
    assert np.allclose(got.coefficients, mean, atol=1e-6) and np.allclose(got.losses, losses)
    assert got.holds and max(own) <= bound * 1.001 and got.multipliers[1] > got.multipliers[0]
    assert not MI.bounded_group_loss(options, shares, loss, reachable / 2).holds


def test_mitigation_lowers_the_score_and_handles_odd_rows(spark):
    group, x, y = table()
    df = frame(spark, group, x, y)
    odd = spark.createDataFrame([(9001, None, 1.0, 1.0, 1.0, 7.0, 5.0), (9002, 1, None, float("nan"), 1.0, 7.0, None),
                                 (9003, 0, 1.0, 1.0, 1.0, 7.0, float("nan"))], df.schema)
    res = PL.mitigate(df.union(odd), FEATURES, "y", "g", ["k"])
    rows = res.candidates.collect()
    assert sum(r.chosen for r in rows) == 1 and len(rows) in (41, 61)
    assert min(r.disparity_score for r in rows) == next(r.disparity_score for r in rows if r.chosen) <= rows[0].disparity_score
    assert res.predictions.count() == 603 and res.predictions.where("prediction is null or isnan(prediction)").isEmpty()
    one = PL.mitigate(df.where("g = 1"), FEATURES, "y", "g", ["k"])
    assert [r.chosen for r in one.candidates.collect()] == [True]
    none = PL.mitigate(df.where("k < 0"), FEATURES, "y", "g", ["k"])
    assert none.predictions.count() == 0


def test_rounds_never_accept_a_higher_score(spark):
    group, x, y = table()
    df = frame(spark, group, x, y).withColumn("h", (F.col("k") % 2).cast("int"))
    reports, out = PL.evaluate_and_mitigate(df, FEATURES, "y", {"g": "g", "h": "h"}, ["k"])
    now, first = PL.disparity_scores(out, "y", "g", ["prediction", "first_prediction"])
    assert now < first and out.count() == 600
    by_round = [r["round"] for r in reports.select("round").distinct().orderBy("round").collect()]
    assert by_round == list(range(len(by_round))) and len(by_round) >= 2


def test_other_models_are_fitted_again(spark):
    group, x, y = table(200)
    res = PL.mitigate(frame(spark, group, x, y), FEATURES, "y", "g", ["k"], name="gbt", grid_size=1, maxIter=2)
    assert res.candidates.count() == 3 and res.predictions.count() == 200
