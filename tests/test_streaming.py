"""Streaming jobs equal their batch form (availableNow + complete mode)."""
from conftest import SF_SMALL

from parcelkit.operators import feedback as FB
from parcelkit.plans import bindings as b
from parcelkit.sources.tables import read_table, table_path
from parcelkit.streaming import feedback_stream as ST


def _events(spark):
    return ST.file_stream(spark, table_path(SF_SMALL, "events"), read_table(spark, SF_SMALL, "events").schema)


def test_stream_daily_equals_batch(spark):
    s = sorted(tuple(r) for r in ST.stream_feedback_daily(spark, _events(spark)).collect())
    bt = sorted(tuple(r) for r in FB.feedback_daily(b.feedback(spark, SF_SMALL)).collect())
    assert len(s) == len(bt)
    for x, y in zip(s, bt):
        assert x[0] == y[0] and x[1] == y[1]
        assert all(abs(a - c) < 1e-6 * max(1.0, abs(c)) for a, c in zip(x[2:], y[2:]))


def test_stream_validate_splits(spark):
    acc, rej = ST.stream_validate(spark, _events(spark))
    total = read_table(spark, SF_SMALL, "events").count()
    assert acc.count() + rej.count() == total
    assert acc.where("reasons <> ''").count() == 0 and rej.where("reasons = ''").count() == 0


def test_trailing_windows_cover_each_day_30_times(spark):
    daily = ST.stream_daily_sums(spark, _events(spark))
    w = ST.trailing_windows(daily)
    days = daily.count()
    assert w.count() == days + 29
    assert w.agg({"feedback_count": "sum"}).first()[0] == 30 * daily.agg({"n": "sum"}).first()[0]


def test_append_mode_omits_open_windows(spark):
    """With a 1-day watermark, append mode emits only closed days: the last
    day(s) are still open when the input ends; emitted days equal batch."""
    complete = {r["date"]: r for r in ST.stream_feedback_daily(spark, _events(spark), mode="complete").collect()}
    append = {r["date"]: r for r in ST.stream_feedback_daily(spark, _events(spark), mode="append").collect()}
    assert 0 < len(append) < len(complete)
    assert max(append) < max(complete)
    for d, r in append.items():
        assert r["feedback_count"] == complete[d]["feedback_count"]


def test_update_mode_equals_complete(spark):
    upd = sorted((r["date"], r["feedback_count"]) for r in
                 ST.stream_feedback_daily(spark, _events(spark), mode="update").collect())
    com = sorted((r["date"], r["feedback_count"]) for r in
                 ST.stream_feedback_daily(spark, _events(spark), mode="complete").collect())
    assert upd == com
