"""Streams against their batch forms: detection, publishing, subscriptions, snapshots, latency, live tables."""

import base64
import itertools
import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, live, monitoring, snapshots, subscriptions
from tidemark.sources import adapter, feed, files, lake, livetable
from tidemark.sources.schemas import ENVELOPE
from tidemark.streaming import jobs, stateful

ONCE = {"availableNow": True}
T0 = datetime(2024, 1, 1)
EVENTS = "event_id string, occurred_at timestamp, wiki string, change_type string, log_type string"


def fed(spark, frames, path):
    """A stream that takes one of the frames with each micro-batch."""
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return jobs.read_files(spark, frames[0].schema, path, max_files=1)


def moderation_events(spark, seed, kinds=("delete", "block")):
    """Deletions and blocks by minute: quiet ones, gaps, and bursts; edits keep the other series going."""
    rng, rows = random.Random(seed), []
    for kind in kinds:
        minute = 0
        while minute < 240:
            burst = rng.random() < 0.06
            for _ in range(rng.randrange(8, 40) if burst else rng.randrange(1, 4)):
                rows.append((minute, kind))
            minute += rng.choice([1, 1, 1, 2, 3, 7, 12])
    rows += [(m, None) for m in range(240) for _ in range(60 if m % 37 else 400)]
    data = [(f"e{i}", T0 + timedelta(minutes=m, seconds=rng.randrange(60)), "w", "log" if kind else "edit", kind) for i, (m, kind) in enumerate(rows)]
    return spark.createDataFrame(sorted(data, key=lambda r: r[1]), EVENTS)


def batch_alerts(events, until):
    series = alerts.alert_series(events)
    return alerts.all_alerts(alerts.alert_zscore(series), alerts.moderation_burst(series)).where(F.col("bucket") < F.lit(until))


def test_detection_at_default_limits_equals_batch(spark, tmp_path):
    events = moderation_events(spark, 4).persist()
    parts = [events.where((F.col("occurred_at") >= T0 + timedelta(minutes=a)) & (F.col("occurred_at") < T0 + timedelta(minutes=b))) for a, b in itertools.pairwise((0, 55, 56, 130, 180, 240))]
    sent = []

    def publish(rows):
        sent.extend(rows.collect())
        return jobs.always_sent(rows)

    jobs.start_detection(fed(spark, parts, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, publish=publish).awaitTermination()
    want = batch_alerts(events, T0 + timedelta(minutes=239))
    got = {(r.series, r.bucket) for r in jobs.alert_states(spark, str(tmp_path / "o")).where("status = 'SENT'").collect()}
    assert got == {(r.series, r.bucket) for r in want.collect()}
    assert {k.split(":")[0] for k, _ in got} == {"global", "wiki", "log_type"} and {r for r, _ in got} >= {"log_type:delete", "log_type:block"}
    told = {(m["alert_key"], m["window_start"]): m for m in (json.loads(r.message) for r in sent)}
    for r in alerts.alert_messages(want).collect():
        made = told[r.alert_key, r.window_start]
        expected = {k: v for k, v in r.asDict().items() if v is not None and k != "created_at"}
        assert {k: pytest.approx(v, abs=1.1e-4) if isinstance(v, float) else v for k, v in expected.items()} == {k: v for k, v in made.items() if k != "created_at"}
        assert made["window_key"] == f"WINDOW#{made['window_start']}" and made["severity"] == "warning"


def test_a_gap_before_a_bucket_is_judged(spark, tmp_path):
    # the burst's window is over the limit only once its first, empty minutes have left the earlier groups
    events = moderation_events(spark, 11, ("delete",)).where("log_type IS NOT NULL")
    series = alerts.alert_series(events)
    want = {(r.series, r.bucket) for r in alerts.moderation_burst(series).collect()}
    has_events = {(r.series, r.bucket) for r in series.collect()}
    assert want - has_events, "the rows need a burst in a minute without events"
    jobs.start_detection(fed(spark, [events], str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, min_count={"global": 10**9, "wiki": 10**9}).awaitTermination()
    closed = sorted({b for _, b in has_events})[-2]  # no later event says that the last bucket is over
    assert {(r.series, r.bucket) for r in jobs.alert_states(spark, str(tmp_path / "o")).collect()} == {x for x in want if x[1] <= closed}


def test_alerts_are_published_once_over_batches(spark, tmp_path):
    frame = lambda *minutes: spark.createDataFrame([("s", T0 + timedelta(minutes=m)) for m in minutes], "series string, bucket timestamp")
    source, path, sent = str(tmp_path / "in"), str(tmp_path / "o"), []

    def publish(rows):
        minutes = sorted(r.bucket.minute for r in rows.collect())
        sent.append(minutes)
        if 3 in minutes:
            raise RuntimeError("lost")
        return rows.select("series", "bucket", F.when(F.minute("bucket") == 1, "refused").alias("error"))

    def run():
        jobs.start_alerts(jobs.read_files(spark, frame(0).schema, source, max_files=1), path, str(tmp_path / "c"), ONCE, publish).awaitTermination()

    frame(0, 0, 1).coalesce(1).write.mode("append").parquet(source)
    run()
    frame(0, 1, 2, 3).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="lost"):
        run()
    run()  # the batch that died is run again: what it had reserved isn't published by it
    frame(0, 1, 2, 3, 4).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert [m for minutes in sent for m in minutes] == [0, 1, 2, 3, 4]
    states = {r.bucket.minute: (r.status, r.alert_error) for r in jobs.alert_states(spark, path).collect()}
    frame(0, 600, 0).where("minute(bucket) < 60").coalesce(1).write.mode("append").parquet(source)
    run()
    frame(0, 1).coalesce(1).write.mode("append").parquet(source)
    run()  # far too late: the state has expired, and so have they
    assert len([m for minutes in sent for m in minutes]) == 6
    assert states == {0: ("SENT", None), 1: ("FAILED", "refused"), 2: ("PUBLISHING", None), 3: ("PUBLISHING", None), 4: ("SENT", None)}


ACTIONS = "connection_id string, seq bigint, action string, topic string, at timestamp"


def actions_of(seed):
    rng, rows = random.Random(seed), []
    for c in range(8):
        for seq in range(rng.randrange(1, 12)):
            action = rng.choice(["connect", "subscribe", "subscribe", "subscribe", "unsubscribe", "disconnect"] if rng.random() < 0.5 else ["subscribe"])
            topic = rng.choice(["global", "top_pages", "wiki:enwiki", "wiki:frwiki", "BAD TOPIC"]) if action.endswith("subscribe") else None
            rows.append((f"c{c}", seq, action, topic, T0 + timedelta(seconds=seq)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_subscriptions_in_any_order_and_repeated(spark, tmp_path, seed):
    rows = actions_of(seed)
    shuffled = rows + random.Random(seed).sample(rows, len(rows) // 2)
    random.Random(seed + 9).shuffle(shuffled)
    cuts = [0, len(shuffled) // 3, 2 * len(shuffled) // 3, len(shuffled)]
    frames = [spark.createDataFrame(shuffled[a:b], ACTIONS) for a, b in itertools.pairwise(cuts)]
    jobs.start_subscriptions(fed(spark, frames, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, every=2).awaitTermination()
    got = {r.connection_id: r.topics for r in jobs.latest_subscriptions(spark, str(tmp_path / "o")).collect()}
    want = subscriptions.subscription_table(subscriptions.subscription_state(spark.createDataFrame(rows, ACTIONS)))
    assert got == {r.connection_id: r.topics for r in want.collect()}


def test_closed_connections_stay_closed_until_they_expire(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "o")

    def run(*rows):
        spark.createDataFrame([(c, s, a, t, T0 + timedelta(hours=h)) for c, s, a, t, h in rows], ACTIONS).coalesce(1).write.mode("append").parquet(source)
        jobs.start_subscriptions(jobs.read_files(spark, spark.createDataFrame([], ACTIONS).schema, source, max_files=1), out, str(tmp_path / "c"), ONCE, "1 minute", 7200).awaitTermination()
        return {r.connection_id: r.topics for r in jobs.latest_subscriptions(spark, out).collect()}

    assert run(("a", 1, "connect", None, 0), ("a", 2, "subscribe", "top_pages", 0), ("a", 3, "disconnect", None, 0), ("b", 1, "connect", None, 0)) == {"b": ["global"]}
    assert run(("a", 2, "subscribe", "top_pages", 0)) == {"b": ["global"]}
    assert run(("a", 4, "connect", None, 1)) == {"a": ["global"], "b": ["global"]}
    run(("d", 1, "connect", None, 9))
    assert run(("d", 2, "subscribe", "top_pages", 9)) == {"d": ["global", "top_pages"]}  # silent for over two hours


def day_messages(spark, path):
    rows = spark.read.parquet(f"{path}/messages")
    assert rows.groupBy("refresh", "topic", "window_start").count().where("count > 1").isEmpty()
    last = rows.groupBy("topic", "window_start").agg(F.max_by("message", F.struct("refresh", "batch")).alias("m"))
    return {(r.topic, r.window_start): json.loads(r.m) for r in last.collect()}


def pages_of(pages, wiki=None):
    return [(p.asDict().get("wiki", wiki), p["title"], p["event_count"], p["title_url"], p["last_change_type"]) for p in pages or []]


def test_snapshot_messages_equal_batch(spark, tmp_path):
    events = adapter.silver_events(spark, "/root/testdata/sf0.001").persist()
    clock = itertools.count()
    now = lambda: F.lit(T0 + timedelta(seconds=5 * next(clock)))
    frames = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k) for k in range(3)]
    jobs.start_snapshots(fed(spark, frames, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, "60 days", "1 day", 4, every=2, now=now).awaitTermination()
    got = day_messages(spark, str(tmp_path / "o"))
    fields = ("bot_count", "human_count", "bot_ratio", "change_types", "namespace_distribution")
    want = {}
    for r in snapshots.snapshot_global(events, "1 day", 4).collect():
        want["global", r.window_start] = (r, {"top_wikis": [{"wiki": w.wiki, "count": w.event_count} for w in r.top_wikis]}, pages_of(r.top_pages))
    for r in snapshots.snapshot_wiki(events, None, "1 day", 4).collect():
        want[r.topic, r.window_start] = (r, {"wiki": r.wiki, "top_wikis": []}, pages_of(r.top_pages, r.wiki))
    for r in snapshots.snapshot_top_pages(events, "1 day", 4).collect():
        want["top_pages", r.window_start] = (r, {}, pages_of(r.top_pages))
    none = [got.pop(k) for k in set(got) - set(want)]  # windows without any article
    assert set(got) == set(want) and all(m["topic"] == "top_pages" and m["data"] == {"current_minute_events_so_far": 0, "top_pages": []} for m in none)
    for key, (r, more, pages) in want.items():
        message, data = got[key], got[key]["data"]
        assert data["current_minute_events_so_far"] == r.total and [(p["wiki"], p["title"], p["count"], p["url"], p["last_change_type"]) for p in data["top_pages"]] == pages
        assert {k: data[k] for k in more} == more
        if key[0] != "top_pages":
            assert {f: data[f] for f in fields} == {f: r[f] for f in fields}
            assert (message["oldest_event_timestamp_ms"], message["latest_event_timestamp_ms"]) == (r.oldest_ms, r.latest_ms)
        assert message["aggregation_window"] == r.window_start.strftime("%Y-%m-%dT%H:%M:%SZ") and message["type"] == "stats.update"


def test_one_message_a_refresh_and_subscribed_wikis_alone(spark, tmp_path):
    events = adapter.silver_events(spark, "/root/testdata/sf0.001").persist()
    times = iter([0, 0, 1, 6, 6])  # seconds of each batch's clock: for its refresh and, if that's new, for its messages
    last = [0]

    def now():
        last[0] = next(times, last[0])
        return F.lit(T0 + timedelta(seconds=last[0]))

    wanted = spark.createDataFrame([("x", ["global", "wiki:w03wiki"]), ("y", ["top_pages"])], "connection_id string, topics array<string>")
    frames = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k) for k in range(3)]
    jobs.start_snapshots(fed(spark, frames, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, "60 days", "1 day", subscribed=lambda: wanted, now=now).awaitTermination()
    assert [n for n in sorted(files.listed(spark, str(tmp_path / "o/messages"))) if n.startswith("refresh")] == [f"refresh={int(T0.timestamp()) + k}" for k in (0, 5)]
    got = day_messages(spark, str(tmp_path / "o"))
    assert {t for t, _ in got} == {"global", "top_pages", "wiki:w03wiki"}
    totals = {r.window_start: r.total for r in snapshots.snapshot_global(events, "1 day").collect()}
    assert {w: m["data"]["current_minute_events_so_far"] for (t, w), m in got.items() if t == "global"} == totals


def test_latency_stream_equals_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        posted = 1_700_000_000_000 + k
        latest = posted - rng.choice([-5, 0, 999, 1000, 1001, 8000, 119_999, 120_001])
        rows.append((f"d{k}", rng.choice(["global", "top_pages", "wiki:a", "wiki:b", "x"]), rng.choice(["sent", "sent", "gone", "failed"]), posted, latest, latest - 3000, T0))
    schema = "delivery_id string, topic string, status string, posted_ms bigint, latest_ms bigint, oldest_ms bigint, at timestamp"
    frame = spark.createDataFrame(rows, schema)
    again = spark.createDataFrame(rows[:150], schema)
    jobs.start_latency(fed(spark, [frame.where("posted_ms % 2 = 0"), frame.where("posted_ms % 2 = 1"), again], str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), ONCE, every=2).awaitTermination()
    names = ["label", "measure", "le_ms", "n", "min_ms", "max_ms"]
    got, want = jobs.latest_latency(spark, str(tmp_path / "o")).select(names), monitoring.delivery_latency(frame).select(names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.le_ms for r in got.where("measure = 'latest'").collect()} == {0, 1000, 2000, 10_000, 120_000, None}
    assert got.where("label = 'wiki'").count() > 0 and got.where("min_ms < 0").isEmpty()


def test_a_live_table_opens_a_bounded_number_of_folders(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k bigint, at timestamp, n bigint"
    frame = lambda rows: spark.createDataFrame([(k, T0 + timedelta(days=d), n) for k, d, n in rows], schema)
    want = {}
    for number in range(11):
        rows = [(k, k % 3 + (number > 6), 100 * number + k) for k in range(number, number + 4)]
        want |= {(k, d): n for k, d, n in rows}
        for _ in range(1 + (number == 5)):  # a batch that is run again replaces itself
            livetable.write(frame(rows), number, path, ["k", "at"], "at", every=4)
        opened = livetable.read(spark, path, frame([]).schema, ["k", "at"])
        assert {(r.k, (r.at - T0).days): r.n for r in opened.collect()} == want
        assert len({f.split("/day=")[0] for f in opened.inputFiles()}) <= 4 + 4
    assert len(files.listed(spark, f"{path}/delta")) <= 8 and livetable.manifest(spark, path)["upto"] >= 7
    day = livetable.read(spark, path, frame([]).schema, ["k", "at"], ["2024-01-02"])
    assert {(r.k, (r.at - T0).days): r.n for r in day.collect()} == {x: n for x, n in want.items() if x[1] == 1}
    # a merge that died before its manifest stood changes nothing
    livetable.merge(spark, path, frame([]).schema, ["k", "at"], 10, keep_days=1)
    files.deleted(spark, f"{path}/_manifest/{10:020d}")
    assert {(r.k, (r.at - T0).days) for r in livetable.read(spark, path, frame([]).schema, ["k", "at"]).collect()} == set(want)
    livetable.merge(spark, path, frame([]).schema, ["k", "at"], 10, keep_days=1)
    assert {(r.at - T0).days for r in livetable.read(spark, path, frame([]).schema, ["k", "at"]).collect()} == {2, 3}


def test_pages_of_a_batch_take_the_place_of_earlier_ones(spark):
    events = adapter.silver_events(spark, "/root/testdata/sf0.001")
    rows = snapshots.with_pages(events, "1 day")
    merged = snapshots.merged_pages(rows, spark.createDataFrame([], snapshots.wiki_schema(rows.schema)), 3)
    got = merged.select("window_start", "wiki", F.posexplode("pages").alias("at", "p")).select("window_start", "wiki", "p.title", (-F.col("p.down")).alias("event_count"), (F.col("at") + 1).alias("rank"))
    want = live.live_wiki_top_pages(events, "1 day", 3).select(got.columns)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0


def test_session_settings_come_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with stateful.disk_state(spark):
        assert spark.conf.get(name) == stateful.ROCKSDB
    assert spark.conf.get(name, None) == before


def test_funnel_of_each_batch(spark, tmp_path):
    meta = {"id": "e", "dt": "2024-05-01T10:00:03Z", "domain": "d"}
    lines = [("data: " + json.dumps({"meta": meta | {"id": f"e{k}"}, "type": "edit", "wiki": "w", "title": "t", "namespace": 0}),) for k in range(5)]
    good, _ = feed.ingest_raw_lines(spark.createDataFrame(lines, "value string"))
    texts = [r.j for r in feed.normalize(good).select(F.to_json(F.struct("*")).alias("j")).collect()]
    other = [json.dumps(json.loads(texts[0]) | {"event_type": "x"}), json.dumps(json.loads(texts[0]) | {"event_id": ""}), "[1]", "no"]
    coded = [base64.b64encode(t.encode()).decode() for t in texts + other] + ["%%%", None]
    frames = [spark.createDataFrame([(c,) for c in coded[a:b]], "data string") for a, b in ((0, 3), (3, 8), (8, 11))]
    log = jobs.FunnelLog(spark, str(tmp_path / "f"))
    spark.streams.addListener(log)
    try:
        query = feed.observed_live_events(fed(spark, frames, str(tmp_path / "in"))).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(50):
            if len(files.listed(spark, str(tmp_path / "f"))) == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    rows = [tuple(r)[1:] for r in jobs.funnel(spark, str(tmp_path / "f")).orderBy("batch").collect()]
    assert rows == [(0, 3, 3, 3, 0), (1, 5, 4, 2, 3), (2, 3, 0, 0, 3)]


def test_the_archive_rolls_by_size(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "b")
    row = json.dumps({"event_id": "e", "occurred_at": "2024-05-01T10:00:00Z"})
    events = spark.read.schema(ENVELOPE).json(spark.sparkContext.parallelize([row] * 90, 9))
    events.write.json(source)
    size = max(files.listed(spark, source).values())
    for _ in range(2):  # the second run finds nothing new
        jobs.archive_backlog(spark, source, ENVELOPE, path, str(tmp_path / "c"), "json", 3 * size).awaitTermination()
    hour = f"{path}/year=2024/month=05/day=01/hour=10"
    assert sorted(files.listed(spark, hour)) == ["batch=0", "batch=1", "batch=2"]
    assert lake.read_bronze_hours(spark, path, ("2024", "05", "01", "10")).count() == 90


def test_compaction_rewrites_what_is_fragmented(spark, tmp_path):
    assert lake.packed_bins([], 10) == 0 and lake.packed_bins([10, 11, 9, 1, 4, 4], 10) == 4 and lake.packed_bins([3] * 10, 10) == 4
    path = str(tmp_path / "s")
    rows = spark.range(4000).select((F.lit(T0).cast("timestamp") + F.make_dt_interval(hours=F.col("id") % 2)).alias("occurred_at"), "id", F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("01").alias("day"), (F.col("id") % 2).cast("string").alias("hour"))
    rows.where("hour = '0'").repartition(7).write.partitionBy("year", "month", "day", "hour").parquet(path)
    rows.where("hour = '1'").coalesce(1).write.mode("append").partitionBy("year", "month", "day", "hour").parquet(path)
    hours = [("2024", "01", "01", h) for h in "01"]
    whole = files.listed(spark, f"{path}/year=2024/month=01/day=01/hour=1")
    assert lake.compact(spark, path, *hours) == hours[:1]
    assert [len(x) for _, x in sorted(lake.hours_of(spark, path, *hours).items())] == [1, 1]
    assert files.listed(spark, f"{path}/year=2024/month=01/day=01/hour=1") == whole
    assert not [n for n in files.listed(spark, path) if n.startswith("_compact")]
    assert lake.compact(spark, path, *hours) == [] and spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(4000))
    size = sum(whole.values())
    assert lake.compact(spark, path, *hours, file_bytes=size // 3) == []  # whole files are never cut
    # a run that died between its two moves of an hour
    at, other = f"{path}/year=2024/month=01/day=01/hour=0", "year=2024/month=01/day=01/hour=0"
    assert files.renamed(spark, at, f"{path}/_compacting/{other}") and files.put_text(spark, f"{path}/_compact_plan", other)
    assert lake.compact(spark, path, *hours) == [] and spark.read.parquet(path).count() == 4000
