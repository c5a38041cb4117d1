"""Feedback validation, daily metrics and retrain trigger edge cases."""
import datetime as dt

from pyspark.sql import functions as F

from parcelkit.operators import feedback as FB

SCHEMA = ("id bigint, created_at timestamp_ntz, predicted_price double, actual_price double, confidence bigint, "
          "property_data string, user_id string")
T0 = dt.datetime(2025, 1, 31, 12, 0, 0)


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _stored(spark, rows):
    return FB.validate_feedback(_rows(spark, rows))


def test_validation_reasons(spark):
    rows = [(1, T0, 100000.0, 120000.0, 0, "{}", "u"), (2, T0, 100000.0, 120000.0, 11, "{}", "u"),
            (3, T0, 100000.0, 49999.0, 5, "{}", "u"), (4, T0, 100000.0, 5000001.0, 5, "{}", "u"),
            (5, T0, 100000.0, 160000.0, 10, "{}", "u"), (6, T0, 0.0, 60000.0, 1, "{}", "u"),
            (7, T0, 100000.0, 110000.0, 3, None, "u")]
    v = {r["id"]: r for r in FB.validate_feedback(_rows(spark, rows)).collect()}
    assert v[1]["reasons"] == "confidence out of range" and v[2]["accepted"] is False
    assert v[3]["reasons"] == "actual_price out of range" and v[4]["accepted"] is False
    assert v[5]["accepted"] is True and v[5]["needs_confirmation"] is True and v[5]["deviation"] == 0.6
    assert v[6]["reasons"] == "deviation undefined"
    assert v[7]["reasons"] == "property_data is null"


def _recent(spark, n, err, days_old=0.0, conf=8):
    ts = T0 - dt.timedelta(days=days_old)
    return [(i, ts, 100000.0, 100000.0 + err, conf, "{}", "u") for i in range(n)]


def test_retrain_trigger_count_edge(spark):
    as_of = F.lit(T0)
    r49 = FB.retrain_needed(_stored(spark, _recent(spark, 49, 200000.0)), as_of).first()
    r50 = FB.retrain_needed(_stored(spark, _recent(spark, 50, 200000.0)), as_of).first()
    assert r49["retrain_needed"] is False and r50["retrain_needed"] is True


def test_retrain_window_and_confidence(spark):
    as_of = F.lit(T0)
    exactly_30 = FB.retrain_needed(_stored(spark, _recent(spark, 50, 200000.0, days_old=30)), as_of).first()
    older = FB.retrain_needed(_stored(spark, _recent(spark, 50, 200000.0, days_old=30.01)), as_of).first()
    low_conf = FB.retrain_needed(_stored(spark, _recent(spark, 60, 200000.0, conf=6)), as_of).first()
    assert exactly_30["retrain_needed"] is True
    assert older["retrain_needed"] is False and low_conf["feedback_count"] == 0


def test_retrain_empty_is_false(spark):
    r = FB.retrain_needed(_stored(spark, []), F.lit(T0)).first()
    assert r["retrain_needed"] is False and r["feedback_count"] == 0


def test_daily_newest_first(spark):
    rows = [(1, T0, 100.0, 110.0, 5, "{}", "u"), (2, T0 - dt.timedelta(days=1), 100.0, 90.0, 7, "{}", "u"),
            (3, T0, 100.0, 130.0, 9, "{}", "u")]
    df = FB.validate_feedback(_rows(spark, rows)).drop("accepted")
    d = FB.feedback_daily(df).collect()
    assert [r["date"] for r in d] == [T0.date(), (T0 - dt.timedelta(days=1)).date()]
    assert d[0]["feedback_count"] == 2 and d[0]["mae"] == 20.0 and d[0]["avg_confidence"] == 7.0


def test_history_and_change(spark):
    rows = [(i, T0 + dt.timedelta(hours=i), float(i * 10), 60000.0, 5, "{}", "a" if i % 3 else "b") for i in range(120)]
    df = _rows(spark, rows)
    h = FB.recent_history(df, n=50)
    assert h.where("user_id = 'a'").count() == 50 and h.agg(F.max("rank")).first()[0] == 50
    newest = h.where("user_id = 'a' AND rank = 1").first()["id"]
    assert newest == max(i for i in range(120) if i % 3)
    for parts in (1, 5, 16):
        c = FB.valuation_change(df.repartition(parts)).where("user_id = 'b'").orderBy("created_at").collect()
        assert c[0]["prev_predicted_price"] is None
        assert all(r["change"] == 30.0 for r in c[1:])
