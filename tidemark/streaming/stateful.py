"""Keyed state that the built-in aggregates can't hold, as processors for transformWithState.

All of them keep a few values for each key, take a key's rows in any order
within a batch, and give the same rows when a batch is run again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from typing import Any

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import scalars as S
from tidemark.operators import alerts

# executors get the processors by value, so the package need not be installed there
register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start while this is open keep their state in RocksDB; the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def timed(handle: StatefulProcessorHandle, at_ms: int) -> None:
    """Moves the key's one timer."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    handle.registerTimer(at_ms)


class Detector(StatefulProcessor):
    """Alerts of one series from its closed buckets, by a ring of the last ones: z-scores of volume, or bursts of moderation with absent buckets as zeros.

    Buckets come in order over batches.  A gap before a bucket is judged when the
    bucket comes, as far as its own window still holds events.
    """

    def __init__(self, volume: dict[str, Any], bursts: dict[str, Any], bucket_ms: int) -> None:
        self.volume, self.bursts, self.bucket_ms = volume, bursts, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring, self.handle = handle.getValueState("ring", "ks array<bigint>, ns array<bigint>"), handle

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        kind, _, name = key[0].partition(":")
        held = dict(zip(*self.ring.get(), strict=True)) if self.ring.exists() else {}
        for k, n in sorted((r.k, r.event_count) for r in rows):
            if kind == "log_type":
                last, span = max(held, default=k - 1), self.bursts["span"]
                held[k] = n
                for at in [*range(last + 1, min(last + span, k)), k]:
                    yield from self.burst(key[0], name, at, held)
                keep = span * (self.bursts["groups"] + 1)
            else:
                yield from self.spike(key[0], kind, k, n, held)
                held[k] = n
                keep = self.volume["window_len"] + 1
            held = {b: c for b, c in held.items() if b > k - keep}
        self.ring.update((list(held), list(held.values())))
        timed(self.handle, (max(held) + keep) * self.bucket_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """A series that is silent for as long as its ring spans is forgotten."""
        self.ring.clear()
        return iter(())

    def spike(self, series: str, kind: str, k: int, n: int, held: dict[int, int]) -> Iterator[Row]:
        past = [c for b, c in held.items() if k - self.volume["window_len"] <= b < k]
        if n < self.volume["least"][kind] or len(past) < self.volume["min_points"]:
            return
        mean = sum(past) / len(past)
        deviation = (sum((c - mean) ** 2 for c in past) / len(past)) ** 0.5
        z = (n - mean) / (deviation if deviation >= 1 else max(1.0, 0.1 * mean))
        if z > self.volume["z"][kind]:
            yield found(series, k, alerts.SPIKE_ALERTS[kind], n, mean, baseline_stddev=deviation, z_score=z, threshold=float(self.volume["z"][kind]))

    def burst(self, series: str, name: str, k: int, held: dict[int, int]) -> Iterator[Row]:
        span = self.bursts["span"]
        total = lambda last: sum(held.get(b, 0) for b in range(last - span + 1, last + 1))
        current, earlier = total(k), [total(k - span * g) for g in range(1, self.bursts["groups"] + 1)]
        some = [x for x in earlier if x > 0]
        if current < max(1, self.bursts["least"][name]) or len(some) < self.bursts["min_groups"]:
            return
        mean = sum(some) / len(some)
        ratio = current / max(mean, 1.0)
        if ratio > self.bursts["ratio"]:
            yield found(series, k, alerts.MODERATION_ALERT, current, mean, burst_ratio=ratio, threshold_ratio=float(self.bursts["ratio"]))

    def close(self) -> None:
        pass


FOUND = "series string, k bigint, alert_type string, current_count bigint, baseline_avg double, baseline_stddev double, z_score double, threshold double, burst_ratio double, threshold_ratio double"
_EMPTY = {f.split()[0]: None for f in FOUND.split(", ")}


def found(series: str, k: int, alert_type: str, count: int, mean: float, **more: float) -> Row:
    return Row(**(_EMPTY | {"series": series, "k": k, "alert_type": alert_type, "current_count": count, "baseline_avg": mean} | more))


def detected(
    closed: DataFrame, bucket_seconds: int = 60, window_len: int = 30, min_points: int = 10, z: float | dict[str, float] = 2.0, min_count: dict[str, int] | None = None,
    span: int = 5, groups: int = 6, min_groups: int = 3, ratio: float = 3.0, min_moderation: dict[str, int] | None = None,
) -> DataFrame:
    """Alerts of every kind, as all_alerts returns them, from a stream of closed series (append mode); limits as in alert_zscore and moderation_burst."""
    kinds = tuple(alerts.SPIKE_ALERTS)
    volume = {"window_len": window_len, "min_points": min_points, "z": z if isinstance(z, dict) else dict.fromkeys(kinds, z), "least": min_count or alerts.LEAST_EVENTS}
    bursts = {"span": span, "groups": groups, "min_groups": min_groups, "ratio": ratio, "least": min_moderation or alerts.LEAST_MODERATION}
    rows = closed.select("series", "at", S.bucket_number(F.col("bucket"), bucket_seconds).alias("k"), "event_count")
    out = rows.groupBy("series").transformWithState(Detector(volume, bursts, 1000 * bucket_seconds), FOUND, "append", "eventTime")
    rounded = [F.round(c, 4).alias(c) for c in ("baseline_avg", "baseline_stddev", "z_score")]
    at = F.timestamp_seconds(F.col("k") * bucket_seconds).alias("bucket")
    return out.select("series", at, "alert_type", "current_count", *rounded, "threshold", F.round("burst_ratio", 4).alias("burst_ratio"), "threshold_ratio")


class PublishOnce(StatefulProcessor):
    """Status of each (series, bucket): none, PUBLISHING when it's first seen, then SENT or FAILED by its outcome; whatever it is keeps it from being published again."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status, self.handle = handle.getValueState("status", "status string"), handle

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = self.status.get()[0] if self.status.exists() else None
        before, error, message = now, None, None
        for row in sorted(rows, key=lambda r: (r.outcome is not None, r.outcome or "")):
            if row.outcome is None:
                if now is None:
                    now, message = "PUBLISHING", row.message
            elif now == "PUBLISHING":
                now, error = row.outcome, row.error
        if now != before:
            self.status.update((now,))
            timed(self.handle, int(key[1].timestamp() * 1000) + self.ttl_ms)
            # an alert that is new goes out first: its outcome can only be an earlier try's
            yield Row(series=key[0], bucket=key[1], status=now, alert_error=error, message=message)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.status.clear()
        return iter(())

    def close(self) -> None:
        pass


PUBLISHED = "series string, bucket timestamp, status string, alert_error string, message string"


def publish_states(candidates: DataFrame, outcomes: DataFrame, ttl_seconds: int = 2100) -> DataFrame:
    """(series, bucket, status, alert_error, message) of each change of status, of streams of candidates (series, bucket, message) and outcomes (series, bucket, error).

    A status expires once buckets are so much older than the newest one; what comes later than that is dropped, so it isn't published either.
    """
    new = candidates.select("series", "bucket", F.lit(None).cast("string").alias("outcome"), F.lit(None).cast("string").alias("error"), "message")
    done = outcomes.select("series", "bucket", F.when(F.col("error").isNull(), "SENT").otherwise("FAILED"), F.substring("error", 1, 500), F.lit(None).cast("string"))
    rows = new.union(done).withColumn("at", F.col("bucket")).withWatermark("at", f"{ttl_seconds} seconds")
    return rows.groupBy("series", "bucket").transformWithState(PublishOnce(1000 * ttl_seconds), PUBLISHED, "update", "eventTime")


class Fold(StatefulProcessor):
    """One connection's topics from its actions in any order, any of them repeated: of each topic, the connect and all actions only the last by number counts."""

    def __init__(self, ttl_seconds: int) -> None:
        self.ttl_ms = 1000 * ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getValueState("marks", "since bigint, top bigint, action string, seen bigint")
        self.topics = handle.getMapState("topics", "topic string", "seq bigint, held boolean")
        self.handle = handle

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        since, top, action, seen = self.marks.get() if self.marks.exists() else (None, None, None, 0)
        for row in rows:
            seen = max(seen, int(row.at.timestamp() * 1000))
            if top is None or row.seq > top:
                top, action = row.seq, row.action
            if row.action == "connect":
                since = row.seq if since is None else max(since, row.seq)
            elif row.topic is not None and row.action in ("subscribe", "unsubscribe"):
                known = self.topics.getValue((row.topic,)) if self.topics.containsKey((row.topic,)) else None
                if known is None or row.seq > known[0]:
                    self.topics.updateValue((row.topic,), (row.seq, row.action == "subscribe"))
        self.marks.update((since, top, action, seen))
        timed(self.handle, max(seen, timerValues.getCurrentWatermarkInMs()) + self.ttl_ms)
        # a closed connection is remembered until it would have expired, so that what comes late doesn't open it again
        gone = action == "disconnect"
        held = {t for (t,), (seq, on) in self.topics.iterator() if on and (since is None or seq > since)}
        yield Row(connection_id=key[0], topics=[] if gone else sorted(held | {"global"}), gone=gone)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        was_open = self.marks.exists() and self.marks.get()[2] != "disconnect"
        self.marks.clear()
        self.topics.clear()
        if was_open:
            yield Row(connection_id=key[0], topics=[], gone=True)

    def close(self) -> None:
        pass


TOPICS = "connection_id string, topics array<string>, gone boolean"


def folded(actions: DataFrame, ttl_seconds: int = 7200) -> DataFrame:
    """(connection_id, topics, gone) of each connection that a batch of (connection_id, seq, action, topic, at) touched; `at` has a watermark."""
    return actions.groupBy("connection_id").transformWithState(Fold(ttl_seconds), TOPICS, "update", "eventTime")
