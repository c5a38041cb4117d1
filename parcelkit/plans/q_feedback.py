"""Registered queries: feedback table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelkit.operators import feedback as fb
from parcelkit.plans import bindings as b
from parcelkit.plans.oracle import with_ctes
from parcelkit.plans.registry import register, rounded

CALLER = "7"


@register("feedback_daily", with_ctes("""
SELECT CAST(created_at AS DATE) AS date, count(*) AS feedback_count,
  round(avg(deviation), 4) AS avg_deviation,
  round(sqrt(avg((actual_price - predicted_price) * (actual_price - predicted_price))), 4) AS rmse,
  round(avg(abs(actual_price - predicted_price)), 4) AS mae,
  round(avg(confidence), 4) AS avg_confidence
FROM feedback GROUP BY 1 ORDER BY 1 DESC""", "feedback"), bench=True)
def q_feedback_daily(spark, sf):
    return rounded(fb.feedback_daily(b.feedback(spark, sf)))


@register("retrain_needed", with_ctes("""
SELECT count(*) AS feedback_count,
  round(avg(deviation), 4) AS avg_deviation,
  round(sqrt(avg((actual_price - predicted_price) * (actual_price - predicted_price))), 4) AS rmse,
  round(avg(abs(actual_price - predicted_price)), 4) AS mae,
  coalesce(count(*) >= 50 AND (sqrt(avg((actual_price - predicted_price) * (actual_price - predicted_price))) > 150000
           OR avg(abs(actual_price - predicted_price)) > 100000 OR avg(deviation) > 0.3), false) AS retrain_needed
FROM feedback
WHERE confidence >= 7 AND created_at >= (SELECT max(created_at) FROM feedback) - INTERVAL 30 DAY""", "feedback"))
def q_retrain_needed(spark, sf):
    return rounded(fb.retrain_needed(b.feedback(spark, sf)))


@register("validate_feedback", with_ctes("""
SELECT id, user_id, confidence, actual_price, predicted_price, deviation,
  coalesce(deviation > 0.5, false) AS needs_confirmation, reasons, reasons = '' AS accepted
FROM feedback_checked""", "feedback_checked"))
def q_validate_feedback(spark, sf):
    v = fb.validate_feedback(b.feedback_raw(spark, sf))
    return rounded(v.select("id", "user_id", "confidence", "actual_price", "predicted_price",
                            "deviation", "needs_confirmation", "reasons", "accepted"))


@register("row_visibility", with_ctes(f"""
SELECT id, user_id, created_at, predicted_price, actual_price, confidence, deviation
FROM feedback WHERE user_id = '{CALLER}'""", "feedback"))
def q_row_visibility(spark, sf):
    return rounded(fb.visible_to(b.feedback(spark, sf), CALLER)
                   .select("id", "user_id", "created_at", "predicted_price", "actual_price",
                           "confidence", "deviation"))


@register("recent_history", with_ctes("""
SELECT user_id, id, created_at, predicted_price, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rank FROM feedback)
WHERE rank <= 50""", "feedback"))
def q_recent_history(spark, sf):
    h = fb.recent_history(b.feedback(spark, sf))
    return rounded(h.select("user_id", "id", "created_at", "predicted_price", F.col("rank").cast("bigint")))


@register("valuation_change", with_ctes("""
SELECT user_id, id, created_at, predicted_price,
  lag(predicted_price) OVER (PARTITION BY user_id ORDER BY created_at, id) AS prev_predicted_price,
  round(predicted_price - lag(predicted_price) OVER (PARTITION BY user_id ORDER BY created_at, id), 4) AS change
FROM feedback""", "feedback"))
def q_valuation_change(spark, sf):
    c = fb.valuation_change(b.feedback(spark, sf))
    return rounded(c.select("user_id", "id", "created_at", "predicted_price", "prev_predicted_price", "change"))
