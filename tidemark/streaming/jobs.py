"""The consumers of the event log as streaming queries, each with its own checkpoint.

What a batch writes lies in a folder of its own number, so a batch that is run
again replaces what it wrote.  Tables that later batches read are live tables:
bases by day and the batches since, of which only the touched days are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.functions import scalars as S
from tidemark.operators import alerts, live, monitoring, snapshots
from tidemark.sources import files, lake, livetable
from tidemark.streaming import stateful


def read_files(spark: SparkSession, schema: StructType, path: str, kind: str = "parquet", max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """A stream over files; a micro-batch takes so many files or bytes at most."""
    reader = spark.readStream.schema(schema).format(kind)
    for name, value in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        reader = reader if value is None else reader.option(name, str(value))
    return reader.load(path)


def deduplicated(events: DataFrame, watermark: str = "2 days", by_id: bool = True) -> DataFrame:
    """Late events within the watermark count in their own minute; redelivered ones count once, unless by_id is off."""
    marked = events.withWatermark("occurred_at", watermark)
    return marked.dropDuplicatesWithinWatermark(["event_id"]) if by_id else marked


def _start(writer, trigger: dict):
    return writer.trigger(**trigger).start()


def write_days(batch: DataFrame, number: int, path: str, time_col: str) -> None:
    batch.withColumn("day", F.date_format(time_col, "yyyy-MM-dd")).write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")


def read_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a folder; none where nothing has been written."""
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def touched_days(batch: DataFrame, time_col: str) -> list[str]:
    """The days of a batch's rows: as many as the watermark spans, at most."""
    return sorted(r.day for r in batch.select(F.date_format(time_col, "yyyy-MM-dd").alias("day")).distinct().collect())


COUNTS = StructType().add("family", "string").add("window_start", "timestamp").add("wiki", "string").add("change_type", "string").add("is_bot", "boolean").add("namespace", "string").add("event_count", "long")
COUNT_KEYS = ["family", "window_start", *live.DIMENSIONS]
#: Days that live counters are kept for.
KEEP_DAYS = 2


def start_live(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = "2 days", window: str = "1 minute", by_id: bool = True, every: int = livetable.EVERY, keep_days: int | None = None
) -> StreamingQuery:
    """Counters of all families: state holds totals, so a batch replaces what it touched and a retry changes nothing; a redelivered event counts once."""
    counts = live.live_counts(deduplicated(events, watermark, by_id), window)
    write = lambda batch, number: livetable.write(batch, number, path, COUNT_KEYS, "window_start", every, keep_days)
    return _start(counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "5 seconds"})


def latest_counts(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The counters' present values, of these days alone if given."""
    return livetable.read(spark, path, COUNTS, COUNT_KEYS, days)


PAGES = StructType().add("window_start", "timestamp").add("wiki", "string").add("title", "string").add("event_count", "long").add("last_change_type", "string").add("last_seen_at", "timestamp").add("title_url", "string")
PAGE_KEYS = ["window_start", "wiki", "title"]


def start_pages(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = "2 days", window: str = "1 minute", every: int = livetable.EVERY, keep_days: int | None = None) -> StreamingQuery:
    """Articles by window with the attributes of their last event, in state; the largest of a window are read by latest_pages."""
    counts = live.live_top_pages_counts(deduplicated(events, watermark), window)
    write = lambda batch, number: livetable.write(batch, number, path, PAGE_KEYS, "window_start", every, keep_days)
    return _start(counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "5 seconds"})


def latest_pages(spark: SparkSession, path: str, days: list[str] | None = None, n: int = 10) -> DataFrame:
    return live.top_n(livetable.read(spark, path, PAGES, PAGE_KEYS, days), ["window_start"], n, ("wiki", "title"))


def start_archive(envelopes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Bronze: gzip JSON lines by event hour; rows without a readable hour go to an error folder."""

    def write(batch: DataFrame, number: int) -> None:
        ok = F.coalesce(F.col("occurred_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}"), F.lit(False))
        batch.persist()
        try:
            lake.write_bronze_batch(batch.where(ok), path, str(number))
            batch.where(~ok).write.mode("overwrite").option("compression", "gzip").json(f"{path.rstrip('/')}_errors/batch={number}")
        finally:
            batch.unpersist()

    return _start(envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "300 seconds"})


#: Bytes of a bronze batch at most, and how often the archive runs at least.
ROLL_BYTES, ROLL_SECONDS = 64 << 20, 300


def archive_backlog(spark: SparkSession, source: str, schema: StructType, path: str, checkpoint: str, kind: str = "parquet", roll_bytes: int = ROLL_BYTES) -> StreamingQuery:
    """Archives what has come since the last run, in batches of so many bytes; to be run every ROLL_SECONDS, so that bronze files end at either bound."""
    return start_archive(read_files(spark, schema, source, kind, max_bytes=str(roll_bytes)), path, checkpoint, {"availableNow": True})


class FunnelLog(StreamingQueryListener):
    """What observed_live_events counts in each micro-batch, as one small JSON file a batch; a batch that is run again doesn't count twice."""

    def __init__(self, spark: SparkSession, path: str, name: str = "funnel") -> None:
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows:
            row = {"run": str(event.progress.id), "batch": event.progress.batchId} | seen.asDict()
            files.put_text(self.spark, f"{self.path}/{event.progress.id}-{event.progress.batchId}.json", json.dumps(row))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


FUNNEL = "run string, batch bigint, input_records bigint, decoded_count bigint, valid_count bigint, skipped_count bigint"


def funnel(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch, input_records, decoded_count, valid_count, skipped_count) of each micro-batch."""
    return spark.read.schema(FUNNEL).json(path)


def closed_series(events: DataFrame, bucket: str = "1 minute", delay: str = "10 seconds") -> DataFrame:
    """Alert series, with `at`, of closed buckets alone: append mode emits a bucket once the watermark has passed it."""
    return alerts.alert_series(events.withWatermark("occurred_at", delay), bucket, True)


STATES = StructType().add("series", "string").add("bucket", "timestamp").add("status", "string").add("alert_error", "string")
Publisher = Callable[[DataFrame], DataFrame]


def always_sent(reservations: DataFrame) -> DataFrame:
    return reservations.select("series", "bucket", F.lit(None).cast("string").alias("error"))


def reserve(batch: DataFrame, number: int, path: str) -> DataFrame:
    """The alerts of a batch that no try of it has reserved before, written down as PUBLISHING; only the batch's own folder is read.

    A batch that died while it published leaves its reservations; when it is run
    again, those stay as they are, and nobody publishes them.
    """
    spark, own = batch.sparkSession, f"{path}/reserved/batch={number}"
    known = read_or_none(spark, own, StructType([*STATES.fields]).add("message", "string").add("attempt", "long"))
    attempt = 1 + (known.agg(F.max("attempt")).first()[0] or 0)
    new = alerts.reserved(batch, known.select("series", "bucket")).select("series", "bucket", "status", F.lit(None).cast("string").alias("alert_error"), "message")
    new.write.mode("overwrite").parquet(f"{own}/attempt={attempt}")
    return spark.read.schema(new.schema).parquet(f"{own}/attempt={attempt}")


def with_message(found: DataFrame) -> DataFrame:
    """Alerts with their message as JSON, if they have none yet."""
    if "message" in found.columns:
        return found
    if "alert_type" not in found.columns:
        return found.withColumn("message", F.to_json(F.struct("*")))
    return found.withColumn("message", F.to_json(F.struct(*alerts.message_fields(found))))


def write_alerts(path: str, publish: Publisher = always_sent, once: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of an alert log: each (series, bucket) is reserved before it is published, and published at most once.

    publish takes the reserved alerts, with their messages, and returns (series,
    bucket, error), the error null where an alert went out.  once: the stream
    gives each (series, bucket) once, so only this batch's own reservations are
    read, and none of other batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, batch
        if not once:
            first, last = batch.agg(F.min("bucket"), F.max("bucket")).first()
            others = read_or_none(spark, f"{path}/reserved", StructType([*STATES.fields]).add("batch", "long"))
            rows = alerts.new_alerts(batch, others.where((F.col("batch") != number) & F.col("bucket").between(F.lit(first), F.lit(last))))
        mine = reserve(with_message(rows), number, path)
        states = alerts.settled(mine.drop("alert_error"), publish(mine)).select(*STATES.names)
        write_days(states, number, f"{path}/settled", "bucket")

    return write


def alert_states(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """(series, bucket, status, alert_error) of every alert that was ever reserved."""
    rows = [read_or_none(spark, f"{path}/reserved", STATES), read_or_none(spark, f"{path}/settled", STATES)]
    known = rows[0].select(*STATES.names).union(rows[1].select(*STATES.names))
    return alerts.latest_states(known if days is None else known.where(F.date_format("bucket", "yyyy-MM-dd").isin(days)))


def start_alerts(candidates: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, publish: Publisher = always_sent, ttl_seconds: int = 2100) -> StreamingQuery:
    """Publishes each (series, bucket) of a stream once, whichever batches repeat it: its status is keyed state that expires.

    What publish says of an alert goes into the log at once, and to a folder that
    the same stream reads: its next batch settles the keyed status.
    """
    spark, outcomes = candidates.sparkSession, f"{path}/outcomes"
    told = spark.createDataFrame([], "series string, bucket timestamp, error string")
    if not files.exists(spark, outcomes):
        told.write.mode("append").parquet(outcomes)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            mine = reserve(batch.where("status = 'PUBLISHING'"), number, path)
            done = batch.where("status <> 'PUBLISHING'").select(*STATES.names)
            if not mine.isEmpty():
                publish(mine).select("series", "bucket", "error").write.mode("overwrite").parquet(f"{path}/said/batch={number}")
                said = spark.read.schema(told.schema).parquet(f"{path}/said/batch={number}")
                said.write.mode("append").parquet(outcomes)
                done = done.union(alerts.settled(mine.drop("alert_error"), said).select(*STATES.names))
            write_days(done, number, f"{path}/settled", "bucket")
        finally:
            batch.unpersist()

    states = stateful.publish_states(with_message(candidates).select("series", "bucket", "message"), read_files(spark, told.schema, outcomes), ttl_seconds)
    with stateful.disk_state(spark):
        return _start(states.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "5 seconds"})


def start_detection(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, bucket: str = "1 minute", bucket_seconds: int = 60, delay: str = "10 seconds", publish: Publisher = always_sent, **limits
) -> StreamingQuery:
    """Volume alerts and moderation bursts from closed buckets, each series judged by a ring of its last ones in keyed state; limits as for stateful.detected."""
    found = stateful.detected(closed_series(events, bucket, delay), bucket_seconds, **limits)
    with stateful.disk_state(events.sparkSession):
        return _start(found.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write_alerts(path, publish, True)), trigger or {"processingTime": "5 seconds"})


def start_snapshots(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = "2 days", window: str = "1 minute", n: int = 10, refresh_seconds: int = 5,
    subscribed: Callable[[], DataFrame] | None = None, every: int = livetable.EVERY, keep_days: int | None = None, now: Callable[[], Column] = F.current_timestamp,
) -> StreamingQuery:
    """Messages for the windows that batches touched: global, top_pages and each touched wiki, one for each topic, window and refresh.

    State holds each wiki's counters and pages by window.  A wiki's largest pages
    are kept beside its counters: a batch has all pages that it changed, counts
    only grow, so the largest of these and of the ones before are the largest of
    all.  The global lists come from the wikis' rows.

    subscribed gives the connections with their topics, anew for each batch; then
    only wikis that one of them wants get a message.  Windows whose refresh has
    been sent already wait for the next one.
    """
    rows = snapshots.with_pages(deduplicated(events, watermark), window)
    wikis = snapshots.wiki_schema(rows.schema)
    keys = ["window_start", "wiki"]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = livetable.read(spark, f"{path}/wikis", wikis, keys, touched_days(batch, "window_start"))
            livetable.write(snapshots.merged_pages(batch, before, n), number, f"{path}/wikis", keys, "window_start", every, keep_days)
            batch.select("window_start", "wiki").distinct().write.mode("overwrite").parquet(f"{path}/touched/batch={number}")
        finally:
            batch.unpersist()
        refresh = S.floor_seconds(now(), refresh_seconds)
        mark = f"{path}/messages/refresh={spark.range(1).select(refresh.cast('long')).first()[0]}"
        # a try of this batch that died may have sent a part
        if any(name != f"batch={number}" for name in files.listed(spark, mark)):
            return
        waiting = spark.read.schema("window_start timestamp, wiki string").parquet(f"{path}/touched").distinct()
        last = livetable.read(spark, f"{path}/wikis", wikis, keys, touched_days(waiting, "window_start"))
        single = last.join(waiting, [last["window_start"] == waiting["window_start"], last["wiki"].eqNullSafe(waiting["wiki"])], "left_semi")
        if subscribed is not None:
            single = snapshots.required_wikis(single, snapshots.subscribed_wikis(subscribed()))
        everything = last.join(waiting.select("window_start").distinct(), "window_start", "left_semi")
        snapshots.messages(everything, single, refresh, window, n, now()).write.mode("overwrite").parquet(f"{mark}/batch={number}")
        for name in files.listed(spark, f"{path}/touched"):
            files.deleted(spark, f"{path}/touched/{name}")

    return _start(rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": f"{refresh_seconds} seconds"})


LATENCY = StructType().add("label", "string").add("measure", "string").add("le_ms", "long").add("n", "long").add("min_ms", "long").add("max_ms", "long")


def start_latency(deliveries: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = "10 minutes", every: int = livetable.EVERY) -> StreamingQuery:
    """Histograms of event-to-delivery latency by type of topic, of a stream of deliveries (delivery_id, topic, status, posted_ms, latest_ms, oldest_ms, at); a repeated delivery counts once, one that failed doesn't."""
    once = deliveries.withWatermark("at", watermark).dropDuplicatesWithinWatermark(["delivery_id"])
    counted = monitoring.delivery_latency(once)
    write = lambda batch, number: livetable.write(batch, number, path, ["label", "measure", "le_ms"], None, every)
    return _start(counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "10 seconds"})


def latest_latency(spark: SparkSession, path: str) -> DataFrame:
    return livetable.read(spark, path, LATENCY, ["label", "measure", "le_ms"])


def subscriptions_stream(actions: DataFrame, watermark: str = "1 minute", ttl_seconds: int = 7200) -> DataFrame:
    """(connection_id, topics, gone) of each connection that a batch changed, of actions (connection_id, seq, action, topic, at); topics that aren't valid are no topics.

    Start it within stateful.disk_state: its state needs RocksDB.
    """
    rows = actions.withColumn("topic", F.when(S.valid_topic(F.col("topic")), F.col("topic"))).withWatermark("at", watermark)
    return stateful.folded(rows, ttl_seconds)


def start_subscriptions(
    actions: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, watermark: str = "1 minute", ttl_seconds: int = 7200, every: int = livetable.EVERY
) -> StreamingQuery:
    """The table of connections that latest_subscriptions reads."""
    spark, keys = actions.sparkSession, ["connection_id"]
    write = lambda batch, number: livetable.write(batch, number, path, keys, None, every)
    with stateful.disk_state(spark):
        return _start(subscriptions_stream(actions, watermark, ttl_seconds).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), trigger or {"processingTime": "5 seconds"})


def latest_subscriptions(spark: SparkSession, path: str) -> DataFrame:
    """(connection_id, topics) of the connections that are open now."""
    return livetable.read(spark, path, StructType.fromDDL(stateful.TOPICS), ["connection_id"]).where("NOT gone").select("connection_id", "topics")
