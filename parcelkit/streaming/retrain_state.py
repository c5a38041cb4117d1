"""The retraining trigger as a stateful stream (O2): one state per feed, evaluated as each day closes.

Feedback is summed by day inside each Arrow batch before the shuffle, so a feed sends a few rows per task and batch,
however many records it has.  Its state is a map of daily sums (the trailing window and the days still open) and the last
closed day with its flag.  A timer per day, set to the day's end, fires once the watermark has passed it; the trailing window of that
day, and of days without feedback before it, is then reduced from the map and the flag compared with the day before.

Results depend on the records only, not on how they are cut into batches: a day is evaluated once, when it is closed.  Records of
a closed day are dropped, as by any watermark; records without a time or with a rejected check do not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from parcelkit.operators.feedback import RetrainLimits
from parcelkit.streaming.feedback_stream import StreamPaths, _per_batch, _run, _written, feedback_from_events

_SUMS = ["n", "sse", "sae", "sdev"]
_PARTIAL = "feed string, day long, ends long, newest long, n long, sse double, sae double, sdev double"
_DAYS = "feed string, day long, n long, sse double, sae double, sdev double, retrain_needed boolean, flipped boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _sum_by_day(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sums = pdf.groupby(["feed", "day", "ends"], as_index=False).agg(
            {"newest": "max", "n": "sum", "sse": "sum", "sae": "sum", "sdev": "sum"})
        yield sums[["feed", "day", "ends", "newest", *_SUMS]]


def partial_daily_sums(feedback: DataFrame, limits: RetrainLimits, feed: Column) -> DataFrame:
    """Sums by (feed, day) of each Arrow batch; a null feed is the feed ''."""
    counted = feedback.where(F.col("accepted") & (F.col("confidence") >= limits.min_confidence) & F.col("created_at").isNotNull())
    err = F.col("actual_price") - F.col("predicted_price")
    date = F.to_date("created_at")
    rows = counted.select(
        F.coalesce(feed.cast("string"), F.lit("")).alias("feed"), F.unix_date(date).cast("bigint").alias("day"),
        F.unix_millis(F.date_add(date, 1).cast("timestamp")).alias("ends"), F.unix_micros("created_at").alias("newest"),
        F.lit(1).cast("bigint").alias("n"), (err * err).alias("sse"), F.abs(err).alias("sae"), F.col("deviation").alias("sdev"))
    return rows.mapInPandas(_sum_by_day, _PARTIAL)


class TrailingTrigger(StatefulProcessor):
    """Daily sums of one feed; a row for each closed day, or only for those on which the flag changes."""

    def __init__(self, limits: RetrainLimits, every_day: bool):
        self.limits, self.every_day = limits, every_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "n long, sse double, sae double, sdev double, ends long")
        self.closed = handle.getValueState("closed", "day long, flag boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.closed.get()
        for pdf in rows:
            for (day, ends), part in pdf.groupby(["day", "ends"]):
                if last is not None and day <= last[0]:
                    continue
                sums = [int(part["n"].sum()), *(float(part[c].sum()) for c in _SUMS[1:])]
                at = (int(day),)
                if self.days.containsKey(at):
                    sums = [a + b for a, b in zip(sums, self.days.getValue(at))]
                else:
                    self.handle.registerTimer(int(ends))
                self.days.updateValue(at, (*sums, int(ends)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        known = {k[0]: tuple(v) for k, v in self.days.iterator()}
        last = self.closed.get()
        due = [d for d, v in known.items() if v[4] <= expiry and (last is None or d > last[0])]
        if not due:
            return iter(())
        first = min(due) if last is None else last[0] + 1
        flag, out = (False if last is None else last[1]), []
        back = self.limits.lookback_days
        for day in range(first, max(due) + 1):
            window = [known[d] for d in range(day - back + 1, day + 1) if d in known]
            sums = [sum(v[i] for v in window) for i in range(4)]
            now = self._needed(*sums)
            if self.every_day or now != flag:
                out.append((key[0], day, *sums, now, now != flag))
            flag = now
        self.closed.update((max(due), flag))
        for day in known:
            if day <= max(due) - back + 1:
                self.days.removeKey((day,))
        return iter([pd.DataFrame(out, columns=["feed", "day", *_SUMS, "retrain_needed", "flipped"])] if out else [])

    def close(self) -> None:
        pass

    def _needed(self, n, sse, sae, sdev) -> bool:
        lim = self.limits
        return n > 0 and n >= lim.min_count and (
            (sse / n) ** 0.5 > lim.max_rmse or sae / n > lim.max_mae or sdev / n > lim.max_avg_deviation)


@contextmanager
def _rocksdb(spark: SparkSession):
    """State variables and timers need the RocksDB provider; the session's own setting is put back afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def stream_retrain_state(spark: SparkSession, events: DataFrame, limits: RetrainLimits = RetrainLimits(),
                         feed: Column | None = None, watermark: str = "1 day", every_day: bool = False,
                         paths: StreamPaths | None = None) -> DataFrame:
    """(feed, day, feedback_count, rmse, mae, avg_deviation, retrain_needed, flipped) of the days on which the trigger changes
    (``every_day``: of all closed days); statistics of an empty window are null.  Started again with the same ``paths`` it goes
    on from the saved state.  Days run in the session's time zone."""
    paths = paths or StreamPaths.fresh(spark, "retrain-state")
    sums = partial_daily_sums(feedback_from_events(events), limits, F.lit("all") if feed is None else feed)
    keyed = sums.withColumn("newest", F.timestamp_micros("newest")).withWatermark("newest", watermark).groupBy("feed")
    days = keyed.transformWithStateInPandas(TrailingTrigger(limits, every_day), _DAYS, "append", "eventTime")
    with _rocksdb(spark):
        _run(_per_batch(paths.output), days, "append", "retrain_state", paths)
    out = _written(spark, paths.output, days.schema)
    n = F.nullif("n", F.lit(0))
    return out.select("feed", F.date_from_unix_date(F.col("day").cast("int")).alias("day"), F.col("n").alias("feedback_count"),
                      F.sqrt(F.col("sse") / n).alias("rmse"), (F.col("sae") / n).alias("mae"), (F.col("sdev") / n).alias("avg_deviation"),
                      "retrain_needed", "flipped")
