"""The stateful retraining trigger against a plain replay of the days, after a restart, per feed and on odd input."""
import datetime as dt
from dataclasses import replace

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from parcelkit.operators.feedback import RetrainLimits
from parcelkit.plans import bindings as b
from parcelkit.session import scratch_path
from parcelkit.sources.tables import read_table
from parcelkit.streaming import feedback_stream as ST
from parcelkit.streaming.retrain_state import stream_retrain_state

# Limits near the data's own figures, so that the trigger changes often in a window of three days.
LIMITS = RetrainLimits(min_count=8, max_rmse=600_000.0, max_mae=480_000.0, max_avg_deviation=5.0, min_confidence=5, lookback_days=3)


def _replay(rows, limits, close_until):
    """Every day from the first to the last closed one: sums of its window by a loop over all records."""
    first, day_s, flag, out = min(r["created_at"].date() for r in rows), dt.timedelta(days=1), False, {}
    day = first
    while dt.datetime.combine(day + day_s, dt.time()) <= close_until:
        window = [r for r in rows if day - (limits.lookback_days - 1) * day_s <= r["created_at"].date() <= day]
        n = len(window)
        err = [r["actual_price"] - r["predicted_price"] for r in window]
        now = n >= limits.min_count and n > 0 and (
            (sum(e * e for e in err) / n) ** 0.5 > limits.max_rmse or sum(abs(e) for e in err) / n > limits.max_mae
            or sum(r["deviation"] for r in window) / n > limits.max_avg_deviation)
        out[day] = (n, now, now != flag)
        flag, day = now, day + day_s
    return out


def _replayed(spark, limits):
    rows = b.feedback(spark, SF_SMALL).where(F.col("confidence") >= limits.min_confidence).collect()
    return _replay(rows, limits, max(r["created_at"] for r in rows) - dt.timedelta(days=1))


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _stream(spark, folder, schema):
    return ST.file_stream(spark, folder, schema)


@pytest.fixture(scope="module")
def replayed(spark):
    want = _replayed(spark, LIMITS)
    assert sum(f for _, _, f in want.values()) >= 3  # the data really flip under these limits
    return want


def test_flips_equal_the_replay_also_after_a_restart(spark, replayed):
    events = read_table(spark, SF_SMALL, "events")
    folder, paths = scratch_path(spark, "events"), ST.StreamPaths.fresh(spark, "state")
    events.where("ts < timestamp_ntz'2024-01-12 07:00:00'").coalesce(1).write.parquet(folder)
    first = stream_retrain_state(spark, _stream(spark, folder, events.schema), LIMITS, paths=paths, every_day=True).collect()
    assert 0 < len(first) < len(replayed)
    events.where("ts >= timestamp_ntz'2024-01-12 07:00:00'").coalesce(1).write.mode("append").parquet(folder)
    got = stream_retrain_state(spark, _stream(spark, folder, events.schema), LIMITS, paths=paths, every_day=True).collect()
    assert {r["day"]: (r["feedback_count"], r["retrain_needed"], r["flipped"]) for r in got} == replayed and len(got) == len(replayed)


def test_only_flips_per_feed_with_a_gap_and_null_times(spark):
    """Two feeds in one stream; one has a gap longer than its window, so its flag falls back on a day without feedback."""
    events = read_table(spark, SF_SMALL, "events")
    gap = events.where("ts < timestamp_ntz'2024-01-05' OR ts >= timestamp_ntz'2024-01-20'")
    odd = events.limit(5).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    folder = scratch_path(spark, "events")
    frame = gap.unionByName(odd)
    frame.write.parquet(folder)
    limits = replace(LIMITS, min_count=2)
    clicks = F.when(F.col("notes") == "click", "click")  # the others have no feed
    got = stream_retrain_state(spark, _stream(spark, folder, events.schema), limits, feed=clicks).collect()
    fb = (ST.feedback_from_events(frame).where(F.col("accepted") & (F.col("confidence") >= LIMITS.min_confidence)
                                               & F.col("created_at").isNotNull()).withColumn("feed", F.coalesce(clicks, F.lit(""))).collect())
    until = max(r["created_at"] for r in fb) - dt.timedelta(days=1)
    for feed in ("click", ""):
        mine = [r for r in fb if r["feed"] == feed]
        last = max(r["created_at"].date() for r in mine if dt.datetime.combine(r["created_at"].date() + dt.timedelta(days=1), dt.time()) <= until)
        want = {d: v[:2] for d, v in _replay(mine, limits, until).items() if v[2] and d <= last}
        assert {r["day"]: (r["feedback_count"], r["retrain_needed"]) for r in got if r["feed"] == feed} == want
        assert want or not feed
    assert any(not r["retrain_needed"] for r in got)


def test_empty_stream_has_no_rows(spark):
    events = read_table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "events")
    events.where("false").write.parquet(folder)
    assert stream_retrain_state(spark, _stream(spark, folder, events.schema)).collect() == []
