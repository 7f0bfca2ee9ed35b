"""Contracts, boundaries, idempotence and streams."""

import base64
import hashlib
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import alerts, live, monitoring, snapshots, subscriptions
from tidemark.operators.silver import to_silver
from tidemark.sources import adapter, feed, lake
from tidemark.streaming import jobs

META = {"id": "e1", "dt": "2024-05-01T10:00:03Z", "domain": "en.example.org", "uri": "https://en.example.org/x"}


def line(**changes):
    return "data: " + json.dumps({"meta": META, "id": 7, "type": "edit", "namespace": 0, "title": "A#b", "wiki": "ENWIKI", "bot": True} | changes)


def envelopes(spark, *lines):
    good, bad = feed.ingest_raw_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    return feed.normalize(good), bad


def test_lines_are_split(spark):
    good, bad = feed.ingest_raw_lines(spark.createDataFrame([(x,) for x in (line(), ": comment", "data: nope", "data: [1]", "data:", line(log_params=[1, 2]))], "value string"))
    assert good.count() == 2 and bad.count() == 3
    assert {r[0] for r in good.select("event.log_params").collect()} == {None, "[1,2]"}


def test_reasons_and_canaries(spark):
    metas = [None, {**META, "id": " "}, {**META, "dt": ""}, {**META, "domain": "CaNaRy"}, META]
    good, _ = feed.ingest_raw_lines(spark.createDataFrame([(line(meta=m),) for m in metas], "value string"))
    assert [r[0] for r in feed.accepted(good).select("status").collect()].count("invalid") == 3
    raw, _ = feed.ingest_raw_lines(spark.createDataFrame([(line(meta={**META, "id": str(k)}),) for k in range(200)], "value string"))
    kept = {r.id for r in feed.accepted(raw, 0.3).where("status = 'kept'").select("event.meta.id").collect()}
    assert kept == {str(k) for k in range(200) if int(hashlib.sha256(f"wikimedia-{k}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF < 0.3}
    funnel = monitoring.ingest_funnel(feed.accepted(good, 0.0)).first()
    assert (funnel.received, funnel.invalid, funnel.canary, funnel.sampled_out) == (5, 3, 1, 1)


def test_envelopes_to_silver_and_back(spark):
    made, _ = envelopes(spark, line(length={"old": 5, "new": 9}, log_params={"a": 1}))
    row = to_silver(made).first()
    assert (row.wiki, row.delta_bytes, row.user_is_bot, row.wikimedia_rcid) == ("enwiki", 4, True, 7)
    assert json.loads(row.log_params) == {"a": 1} and len(row) == 24
    assert row.event_id == "wikimedia-e1"
    sent = {"change_type": "Edit", "log_type": "Delete", "user_is_bot": None, "bot": None, "is_minor": "maybe", "is_patrolled": "2"}
    payload = F.col("payload")
    for name, value in sent.items():
        payload = payload.withField(name, F.lit(value))
    other = to_silver(made.withColumn("payload", payload)).first()
    assert (other.change_type, other.log_type, other.user_is_bot, other.is_minor, other.is_patrolled) == ("Edit", "Delete", None, None, True)
    event = feed.to_live_event(made).first()
    assert event.wiki == "enwiki" and event.title == "A#b" and event.user_is_bot
    alert = feed.to_alert_event(made).first()
    assert (alert.wiki, alert.change_type, alert.log_type, alert.log_action) == ("enwiki", "edit", None, None)
    nameless = made.withColumns({"event_id": F.lit(""), "payload": F.col("payload").withField("title", F.lit(" "))})
    assert feed.to_live_event(nameless).isEmpty() and feed.to_alert_event(nameless).isEmpty()
    assert feed.to_live_event(nameless.withColumn("event_id", F.lit("e"))).first().title == "unknown"
    sent = made.select(F.base64(F.to_json(F.struct("*")).cast("binary")).alias("data")).union(spark.createDataFrame([(base64.b64encode(b"junk").decode(),), ("!",)], "data string"))
    good, bad = feed.decode_envelopes(sent)
    assert good.count() == 1 and bad.count() == 2


def test_scalars(spark):
    row = spark.range(1).select(
        S.as_flag(F.lit(" Yes ")), S.as_flag(F.lit(None)), S.as_flag(F.lit(0)), S.parse_time(F.lit("nope")), S.parse_millis(F.lit("-1"), F.lit("x"), F.lit("5")),
        S.bot_ratio(F.lit(1), F.lit(2)), S.round4(F.lit(float("nan"))), S.first_filled(F.lit(" "), F.lit("u")), S.key_safe(F.lit("a#b")),
        S.valid_topic(F.lit("wiki:EN")), S.topics_without(F.array(F.lit("global"), F.lit("x")), F.lit("global")), S.sampled(F.lit("a"), 1.0), S.token12(F.lit("a")),
    ).first()
    assert tuple(row) == (True, False, False, None, 5, 0.3333, 0.0, "u", "a_b", False, ["global", "x"], True, "ca978112ca1b")


def series(spark, counts, name="global"):
    at = datetime(2024, 1, 1)
    return spark.createDataFrame([(name, at + timedelta(minutes=k), n) for k, n in counts], "series string, bucket timestamp, event_count bigint")


def test_zscore_boundaries(spark):
    flat = [(k, 50) for k in range(10)]
    run = lambda last, points=flat: alerts.alert_zscore(series(spark, [*points, (10, last)])).count()
    assert run(60) == 0 and run(61) == 1  # a deviation of 5 by the guard: 60 is exactly 2
    apart = alerts.alert_zscore(series(spark, [*flat, (10, 61)]), z={"global": 2.2, "wiki": 2.0})
    assert apart.isEmpty() and alerts.alert_zscore(series(spark, [*flat, (10, 61)], "wiki:w"), z={"global": 2.2, "wiki": 2.0}).first().alert_type == "WIKI_ACTIVITY_SPIKE"
    assert run(100, flat[:9]) == 0  # nine points are too few
    assert alerts.alert_zscore(series(spark, [(k, 5) for k in range(10)] + [(10, 49)])).count() == 0  # under the least count


def test_burst_boundaries(spark):
    earlier = [(k, 1) for k in range(30)]
    run = lambda n: alerts.moderation_burst(series(spark, [*earlier, (34, n)], "log_type:delete")).count()
    assert run(15) == 0 and run(16) == 1  # means are 5: a ratio of exactly 3 isn't over it


def test_gap_is_zero_in_bursts_only(spark):
    assert alerts.dense_spine(series(spark, [(0, 1), (3, 1)])).count() == 4
    assert alerts.zscores(series(spark, [(0, 1), (3, 1)])).orderBy("bucket").collect()[1].n == 1


def test_alerts_are_published_once(spark):
    candidates = series(spark, [(0, 1), (0, 1), (1, 1)])
    log = series(spark, [(1, 9)])
    assert alerts.publish_once(candidates, log).count() == 1


def test_lake_reruns_replace_and_guard(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / x) for x in ("bronze", "silver", "gold"))
    made, _ = envelopes(spark, line(), line(meta={**META, "id": "e2", "dt": "2024-05-01T11:00:00Z"}))
    lake.write_bronze_batch(made, bronze)
    hour = ("2024", "05", "01", "10")
    for _ in range(2):
        lake.run_hour(spark, bronze, silver, gold, hour)
    assert spark.read.parquet(f"{gold}/wiki_activity_by_hour").count() == 1
    lake.run_range(spark, bronze, silver, gold, hour, ("2024", "05", "01", "11"))
    assert spark.read.parquet(f"{gold}/wiki_activity_by_hour").count() == 2
    lake.compact(spark, silver, hour)
    assert spark.read.parquet(silver).count() == 2
    with pytest.raises(lake.EmptyHour):
        lake.read_silver_hours(spark, silver, ("2024", "05", "01", "12"))
    assert lake.resolve_hour(None, datetime(2024, 1, 1, 0, 5)) == ("2023", "12", "31", "23")


def test_streams_equal_batches(spark, tmp_path):
    events = adapter.silver_events(spark, "/root/testdata/sf0.001")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.start_live(stream, out, str(tmp_path / "c1"), {"availableNow": True}, "60 days", "1 hour").awaitTermination()
    got, want = jobs.latest_counts(spark, out), live.live_counts(events, "1 hour")
    columns = ["family", "window_start", *live.DIMENSIONS, "event_count"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty() and got.count() == want.count()
    jobs.start_alerts(stream.select("event_id", F.lit("s").alias("series"), F.window("occurred_at", "1 day").start.alias("bucket")), str(tmp_path / "a"), str(tmp_path / "c2"), {"availableNow": True}).awaitTermination()
    log = jobs.alert_states(spark, str(tmp_path / "a"))
    assert log.count() == events.select(F.window("occurred_at", "1 day")).distinct().count() and {r.status for r in log.collect()} == {"SENT"}


def test_archive_stream(spark, tmp_path):
    made, _ = envelopes(spark, line(), line(meta={**META, "dt": "junk"}))
    made.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / "in"))
    jobs.start_archive(stream, str(tmp_path / "b"), str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    assert lake.read_bronze_hours(spark, str(tmp_path / "b"), ("2024", "05", "01", "10")).count() == 1
    assert spark.read.json(str(tmp_path / "b_errors")).count() == 1


def test_subscriptions(spark):
    log = [("a", 1, "subscribe", "top_pages"), ("a", 2, "connect", None), ("a", 3, "subscribe", "wiki:enwiki"), ("a", 4, "unsubscribe", "global"), ("b", 1, "connect", None), ("b", 2, "disconnect", None)]
    state = subscriptions.subscription_state(spark.createDataFrame(log, "connection_id string, seq int, action string, topic string"))
    table = subscriptions.subscription_table(state)
    assert [tuple(r) for r in table.collect()] == [("a", ["global", "wiki:enwiki"])]
    assert [r.wiki for r in snapshots.subscribed_wikis(table).collect()] == ["enwiki"]
    assert subscriptions.remove_gone(table, table).isEmpty()


def test_charts_read_maps_and_lists(spark):
    messages = [json.dumps({"topic": "global", "data": {"top_wikis": [{"wiki": "w", "count": 3}], "changeTypes": {"edit": 2}}})]
    points = snapshots.flatten_snapshot(spark.createDataFrame([(m,) for m in messages], "message string")).collect()
    assert {tuple(r) for r in points} == {("global", "wikis", "w", 3), ("global", "change_types", "edit", 2)}


def stream_of(spark, events, path, files=3):
    events.repartition(files).write.parquet(path)
    return jobs.read_files(spark, events.schema, path, max_files=1)


ONCE = {"availableNow": True}


def test_redelivered_events_count_once(spark, tmp_path):
    events = adapter.silver_events(spark, "/root/testdata/sf0.001").orderBy("event_id").limit(300)
    stream = stream_of(spark, events.union(events), str(tmp_path / "in"))
    jobs.start_live(stream, str(tmp_path / "o"), str(tmp_path / "c"), ONCE, "60 days", "1 day").awaitTermination()
    got = jobs.latest_counts(spark, str(tmp_path / "o")).where("family = 'global_activity'").agg(F.sum("event_count")).first()[0]
    assert got == 300
    days = [str(r.d) for r in events.select(F.to_date("occurred_at").alias("d")).distinct().orderBy("d").limit(2).collect()]
    assert {r.day for r in jobs.latest_counts(spark, str(tmp_path / "o"), days).select(F.date_format("window_start", "yyyy-MM-dd").alias("day")).collect()} == set(days)
    jobs.start_pages(stream, str(tmp_path / "p"), str(tmp_path / "cp"), ONCE, "60 days", "1 day").awaitTermination()
    top = live.live_top_pages(events, "1 day").select("window_start", "wiki", "title", "event_count", "last_change_type", "title_url", "rank")
    assert jobs.latest_pages(spark, str(tmp_path / "p")).select(*top.columns).exceptAll(top).isEmpty()


def test_alert_states(spark, tmp_path):
    candidates = series(spark, [(0, 1), (1, 1), (2, 1)])
    outcomes = candidates.limit(2).select("series", "bucket", F.when(F.minute("bucket") == 1, F.repeat(F.lit("x"), F.lit(600))).alias("error"))
    held = alerts.reserved(candidates, candidates.limit(0))
    states = {r.bucket.minute: (r.status, len(r.alert_error or "")) for r in alerts.settled(held, outcomes).collect()}
    assert states == {0: ("SENT", 0), 1: ("FAILED", 500), 2: ("PUBLISHING", 0)}
    path, sent = str(tmp_path / "a"), []

    def publish(rows):
        sent.append(rows.count())
        if len(sent) == 1:
            raise RuntimeError("lost")
        return jobs.always_sent(rows)

    write = jobs.write_alerts(path, publish)
    with pytest.raises(RuntimeError):
        write(candidates, 7)
    write(candidates, 7)  # what was reserved before it died isn't published again
    write(candidates.union(series(spark, [(9, 1)])), 8)
    assert sent == [3, 0, 1]
    assert {r.bucket.minute: r.status for r in jobs.alert_states(spark, path).collect()} == {0: "PUBLISHING", 1: "PUBLISHING", 2: "PUBLISHING", 9: "SENT"}


def test_source_times_and_bad_times(spark):
    made, _ = envelopes(spark, line(), line(meta={**META, "id": "e2", "dt": "junk"}))
    plain = feed.to_live_event(made).orderBy("event_id").collect()
    assert plain[0].source_ms == 1714557603000 and (datetime.now() - plain[1].occurred_at).total_seconds() < 86_400
    text = made.limit(1).select(F.to_json(F.struct("*")).alias("j")).first().j
    sent = [json.dumps(json.loads(text) | extra) for extra in ({"source_event_timestamp_ms": "1700000000123.9"}, {"source_event_timestamp_ms": -5, "event_timestamp_ms": 1700000000456}, {"source_event_timestamp_ms": "x"}, {})]
    rows = spark.createDataFrame([(base64.b64encode(x.encode()).decode(),) for x in sent], "data string")
    good, bad = feed.decode_envelopes(rows)
    assert bad.isEmpty() and sorted(r.source_ms for r in feed.to_live_event(good).collect()) == [1700000000123, 1700000000456, 1714557603000, 1714557603000]
    assert live.live_event_bounds(feed.to_live_event(good)).where("window_start is null").first().oldest_ms == 1700000000123
    odd, none = feed.ingest_raw_lines(spark.createDataFrame([(line(namespace="text"),)], "value string"))
    assert none.isEmpty() and odd.first().event.namespace is None and odd.first().event.title == "A#b"


def test_tables_hours_and_reports_at_a_time(spark, tmp_path):
    from tidemark.plans import reports

    bronze, silver, gold = (str(tmp_path / x) for x in ("bronze", "silver", "gold"))
    made, _ = envelopes(spark, *[line(meta={**META, "id": f"e{k}", "dt": f"2024-05-0{1 + k}T10:00:03Z"}) for k in range(3)])
    for _ in range(2):
        lake.write_bronze_batch(made, bronze, "0")  # a batch that is written again
    assert lake.read_bronze_hours(spark, bronze, ("2024", "05", "01", "10"), ("2024", "05", "03", "23")).count() == 3
    lake.run_range(spark, bronze, silver, gold, ("2024", "05", "01", "00"), ("2024", "05", "03", "23"))
    tables = lake.declared_tables(bronze, silver, gold)
    lake.register_tables(spark, tables)
    try:
        assert len(tables) == 7 and [spark.table(n).count() for n in ("bronze_events", "silver_events", "gold_wiki_activity_by_hour")] == [3, 3, 3]
        found = reports.report("bot_ratio_24h", spark.table("silver_events"), "2024-05-02 12:00:00")
        assert found.count() == 1 and len(found.inputFiles()) == 1
        plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "GreaterThan(occurred_at,2024-05-01" in plan, plan
        hourly = reports.gold_report("bot_ratio_24h", spark.table("gold_wiki_activity_by_hour"), "2024-05-02 12:00:00")
        assert [r.hour.day for r in hourly.collect()] == [2] and len(hourly.inputFiles()) == 1
        assert lake.retain(spark, silver, ("2024", "05", "02", "10")) == 1
        assert spark.read.parquet(silver).count() == 2
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_large_hour_is_dealt_over_several_files(spark, tmp_path):
    rows = adapter.silver_events(spark, "/root/testdata/sf0.1").withColumn("occurred_at", F.lit(datetime(2024, 5, 1, 10))).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        lake.write_silver(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(str(tmp_path / "s")).inputFiles()) > 2
    lake.compact(spark, str(tmp_path / "s"), ("2024", "05", "01", "10"))
    assert len(spark.read.parquet(str(tmp_path / "s")).inputFiles()) == 1 and spark.read.parquet(str(tmp_path / "s")).count() == 100_000


def test_display_and_time_scalars(spark):
    at = lambda text: F.lit(text).cast("timestamp")
    row = spark.range(1).select(
        S.percent(F.lit(1), F.lit(4)), S.percent(F.lit(1), F.lit(0)), S.scaled(F.lit(5), 0.1),
        S.is_partial(at("2024-01-01 10:00:00"), at("2024-01-01 10:00:59")), S.is_partial(at("2024-01-01 10:00:00"), at("2024-01-01 10:01:00")), S.is_partial(F.lit(None).cast("timestamp"), at("2024-01-01")),
        S.latest_closed_minute(at("2024-01-01 10:05:09")).cast("string"), S.latest_closed_minute(at("2024-01-01 10:05:10")).cast("string"),
        F.concat_ws("/", *S.hour_parts_of_text(F.lit("2024-05-01T07:00:03Z")).values()), S.topic_type(F.lit("wiki:x")), S.topic_type(F.lit("y")),
    ).first()
    assert tuple(row) == (25.0, 0.0, 50.0, True, False, True, "2024-01-01 10:03:00", "2024-01-01 10:04:00", "2024/05/01/07", "wiki", "unknown")


def test_delivered_events_and_observed_counts(spark):
    events = spark.createDataFrame([("a", 0, 40), ("b", 0, 60), ("b", 0, 60), ("c", 10, 5), (None, 0, 200_000)], "event_id string, s bigint, t bigint")
    sent = monitoring.delivered(events, spark.createDataFrame([("b",), (None,)], "event_id string")).withColumn("of", F.lit("all"))
    found = {r.le_ms: (r.n, r.min_ms, r.max_ms) for r in monitoring.latency_histogram(sent, "s", "t", "of").collect()}
    assert found == {1000: (1, 40, 40), None: (1, 200_000, 200_000)}  # a row without an id is delivered; a negative latency is none
    observed, seen = monitoring.with_observation(events, "job", n=F.count(F.lit(1)), valid=F.count_if(F.col("event_id").isNotNull()))
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 5, "valid": 4}


def test_log_counters_need_log_events(spark):
    at = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(at, "w", "log", "delete"), (at, "w", "log", "block"), (at, "w", "log", None), (at, "w", "edit", "delete"), (at, None, "log", "move")], "occurred_at timestamp, wiki string, change_type string, log_type string")
    found = {r.series: tuple(r)[2:] for r in alerts.alert_series(rows).collect()}
    assert found == {"global": (5, 4, 1, 1), "wiki:w": (4, 3, 1, 1), "log_type:delete": (1, 1, 1, 0), "log_type:block": (1, 1, 0, 1)}
