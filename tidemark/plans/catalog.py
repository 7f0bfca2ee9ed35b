"""Registered queries over the given tables, each with the same result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import alerts, gold, live, monitoring, snapshots, subscriptions
from tidemark.plans import reports
from tidemark.sources.adapter import DUCK_EVENTS, plain, silver_events, subscription_actions
from tidemark.sources.schemas import NAMESPACES

HOUR = "1 hour"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def add(name: str, make: Callable[[DataFrame], DataFrame], sql: str) -> None:
    """A query over the adapted events; sql sees them as `a`."""
    QUERIES[name] = lambda spark, sf_dir: plain(make(silver_events(spark, sf_dir)))
    ORACLE_SQL[name] = f"WITH a AS ({DUCK_EVENTS}), {sql[5:]}" if sql.startswith("WITH ") else f"WITH a AS ({DUCK_EVENTS}) {sql}"


D, H = "cast(cast(occurred_at AS date) AS varchar)", "date_trunc('hour', occurred_at)"
GOLD_KEYS = f"SELECT {D} AS metric_date, {H} AS metric_hour"
SPAN = "min(occurred_at) AS first_event_at, max(occurred_at) AS last_event_at"
BOTS = "count(*) FILTER (user_is_bot) AS bot_event_count, count(*) FILTER (NOT user_is_bot) AS human_event_count"
add("gold_wiki_activity_by_hour", lambda e: gold.gold_wiki_activity_by_hour(gold.gold_base(e)),
    f"{GOLD_KEYS}, wiki, count(*) AS event_count, {BOTS}, count(DISTINCT title) AS distinct_titles, {SPAN} FROM a GROUP BY 1, 2, 3")
for _key, _name in (("change_type", "change_type"), ("user_is_bot", "bot"), ("namespace", "namespace")):
    add(f"gold_{_name}_by_hour" if _name == "change_type" else f"gold_{_name}_activity_by_hour", lambda e, k=_key: gold.by_hour(gold.gold_base(e), k),
        f"{GOLD_KEYS}, {_key}, count(*) AS event_count, {SPAN} FROM a GROUP BY 1, 2, 3")
PAGES = f"{GOLD_KEYS}, wiki, namespace, title, count(*) AS event_count, {BOTS}, {SPAN} FROM a WHERE title IS NOT NULL GROUP BY 1, 2, 3, 4, 5"
RANK = "SELECT *, row_number() OVER (PARTITION BY metric_hour ORDER BY event_count DESC, wiki, namespace, title) AS page_rank FROM p QUALIFY page_rank <= 100"
add("gold_top_pages_by_hour", lambda e: gold.gold_top_pages_by_hour(gold.gold_base(e)), f"WITH p AS ({PAGES}) {RANK}")
add("hash_sample", lambda e: e.where(S.sampled(F.col("event_id"), 0.1)).select("event_id", "wiki"),
    "SELECT event_id, wiki FROM a WHERE cast('0x' || substr(sha256(event_id), 1, 8) AS bigint) / 4294967295 < 0.1")

TYPES = ", ".join(f"count(*) FILTER (change_type = '{t}') AS {t}_count" for t in ("edit", "new", "categorize", "log", "external"))
COUNTS = "count(*) FILTER (user_is_bot) AS bot_count, count(*) FILTER (NOT user_is_bot) AS human_count"
add("top_wikis_by_hour", gold.top_wikis_by_hour, f"SELECT {H} AS hour, wiki, count(*) AS event_count, {COUNTS}, {TYPES} FROM a GROUP BY 1, 2")
add("bot_vs_human_by_hour", gold.bot_vs_human_by_hour,
    f"SELECT {H} AS hour, {COUNTS}, count(*) AS total_count, round(count(*) FILTER (user_is_bot) / count(*), 4) AS bot_ratio FROM a GROUP BY 1")
LAST = "max_by(change_type, struct_pack(t := occurred_at, e := event_id)) AS last_change_type, max(occurred_at) AS last_seen_at"
add("top_pages_by_day", gold.top_pages_by_day, f"SELECT {D} AS day, wiki, title, count(*) AS event_count, {LAST} FROM a WHERE namespace = 0 GROUP BY 1, 2, 3")
add("change_type_distribution", gold.change_type_distribution, f"SELECT {H} AS hour, change_type, count(*) AS event_count FROM a GROUP BY 1, 2")


def z_sql(series: str, seconds: int = 3600, window_len: int = 30) -> str:
    """CTEs c (series, bucket, event_count) -> z with n, mean, deviation, z."""
    return f"""c AS ({series}), k AS (SELECT *, cast(epoch(bucket) AS bigint) // {seconds} AS k FROM c),
m AS (SELECT *, count(*) OVER w AS n, avg(event_count) OVER w AS mean, stddev_pop(event_count) OVER w AS deviation FROM k
  WINDOW w AS (PARTITION BY series ORDER BY k RANGE BETWEEN {window_len} PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (event_count - mean) / CASE WHEN deviation >= 1 THEN deviation ELSE greatest(1.0, mean * 0.1) END AS z FROM m)"""


SPIKE_SERIES = f"SELECT wiki AS series, {H} AS bucket, count(*) AS event_count FROM a GROUP BY 1, 2 UNION ALL SELECT '*', {H}, count(*) FROM a GROUP BY 1, 2"
SPIKES = "SELECT bucket AS hour, series AS wiki, event_count, round(z, 4) AS z_score, z > 2 AS is_spike FROM z WHERE n >= 10"
add("activity_spikes", gold.activity_spikes, f"WITH {z_sql(SPIKE_SERIES)} {SPIKES}")
for _name, _text in reports.REPORTS.items():
    add(_name, lambda e, n=_name: reports.report(n, e), _text.replace("{a}", "a"))
AS_OF = "2024-01-20 12:34:56"
for _name in ("bot_ratio_24h", "kpi_totals", "most_edited_articles_7d", "active_wikis_last_hour"):
    add(f"{_name}_as_of", lambda e, n=_name: reports.report(n, e, AS_OF), reports.at_time(reports.REPORTS[_name], AS_OF).replace("{a}", "a"))
for _name, (_set, _) in reports.GOLD_REPORTS.items():
    add(f"{_name}_from_gold", lambda e, n=_name, s=_set: reports.gold_report(n, gold.GOLD[s](gold.gold_base(e))), reports.whole_hours(reports.REPORTS[_name]).replace("{a}", "a"))
for _name, _text in reports.SPIKES.items():
    add(_name, lambda e, n=_name: reports.spike_report(n, gold.activity_spikes(e)), f"WITH {z_sql(SPIKE_SERIES)}, s AS ({SPIKES}) {_text.replace('{s}', 's')}")
BEFORE = SPIKE_SERIES.replace("FROM a GROUP", f"FROM a WHERE occurred_at <= TIMESTAMP '{AS_OF}' GROUP")
for _name in reports.SPIKES:
    add(f"{_name}_as_of", lambda e, n=_name: reports.spike_report_at(n, e, AS_OF), f"WITH {z_sql(BEFORE)}, s AS ({SPIKES}) {reports.spike_text_at(_name, AS_OF).replace('{s}', 's')}")

#: The same dimensions as in live.FAMILIES, in SQL.
L = f"SELECT {H} AS window_start, wiki, change_type, user_is_bot AS is_bot, cast(namespace AS varchar) AS namespace, occurred_at, event_id, title, title_url FROM a"
for _name, _keys in live.FAMILIES.items():
    _key_list = "".join(f", {k}" for k in _keys)
    add(f"live_{_name}", lambda e, n=_name: live.family(e, n, HOUR), f"WITH l AS ({L}) SELECT window_start{_key_list}, count(*) AS event_count FROM l GROUP BY window_start{_key_list}")
FAMILY_UNION = " UNION ALL ".join(
    f"SELECT '{n}' AS family, window_start, " + ", ".join(d if d in ks else f"NULL AS {d}" for d in live.DIMENSIONS) + f", count(*) AS event_count FROM l GROUP BY window_start{''.join(', ' + k for k in ks)}"
    for n, ks in live.FAMILIES.items()
)
add("live_grouping_sets", lambda e: live.live_counts(e, HOUR), f"WITH l AS ({L}) {FAMILY_UNION}")
TOP_PAGES = f"t AS (SELECT window_start, wiki, title, count(*) AS event_count, {LAST}, max_by(title_url, struct_pack(t := occurred_at, e := event_id)) AS title_url FROM l WHERE namespace = '0' GROUP BY 1, 2, 3)"
add("live_top_pages_counts", lambda e: live.live_top_pages_counts(e, HOUR), f"WITH l AS ({L}), {TOP_PAGES} SELECT * FROM t")
add("live_event_bounds", lambda e: live.live_event_bounds(e, HOUR),
    f"WITH l AS ({L}) SELECT window_start, epoch_us(min(occurred_at)) // 1000 AS oldest_ms, epoch_us(max(occurred_at)) // 1000 AS latest_ms FROM l GROUP BY ROLLUP (window_start)")
TOP_WIKIS = "SELECT window_start, wiki, count(*) AS event_count, row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, wiki) AS rank FROM l GROUP BY 1, 2 QUALIFY rank <= 10"
add("live_top_wikis", lambda e: live.live_top_wikis(e, HOUR), f"WITH l AS ({L}) {TOP_WIKIS}")
add("live_top_pages", lambda e: live.live_top_pages(e, HOUR),
    f"WITH l AS ({L}), {TOP_PAGES} SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, wiki, title) AS rank FROM t QUALIFY rank <= 10")
add("live_wiki_top_pages", lambda e: live.live_wiki_top_pages(e, HOUR),
    f"WITH l AS ({L}), {TOP_PAGES} SELECT *, row_number() OVER (PARTITION BY window_start, wiki ORDER BY event_count DESC, title) AS rank FROM t QUALIFY rank <= 10")
add("touched_windows", lambda e: live.touched_windows(e, HOUR), f"SELECT DISTINCT {H} AS window_start FROM a")

FOUR = "count(*) AS event_count, count(*) FILTER (change_type = 'log') AS log_count, count(*) FILTER (change_type = 'log' AND log_type = 'delete') AS delete_count, count(*) FILTER (change_type = 'log' AND log_type = 'block') AS block_count"
SERIES = f"""SELECT 'global' AS series, {H} AS bucket, {FOUR} FROM a GROUP BY 1, 2 UNION ALL SELECT 'wiki:' || wiki, {H}, {FOUR} FROM a GROUP BY 1, 2
UNION ALL SELECT 'log_type:' || log_type, {H}, {FOUR} FROM a WHERE change_type = 'log' AND log_type IN ('delete', 'block') GROUP BY 1, 2"""
add("alert_series", lambda e: alerts.alert_series(e, HOUR), SERIES)
add("alert_series_global", lambda e: alerts.alert_series(e, HOUR).where("series = 'global'"), f"WITH s AS ({SERIES}) SELECT * FROM s WHERE series = 'global'")
add("alert_series_wiki", lambda e: alerts.alert_series(e, HOUR).where("series LIKE 'wiki:%'"), f"WITH s AS ({SERIES}) SELECT * FROM s WHERE series LIKE 'wiki:%'")
add("alert_series_log_type", lambda e: alerts.alert_series(e, HOUR).where("series LIKE 'log_type:%'"), f"WITH s AS ({SERIES}) SELECT * FROM s WHERE series LIKE 'log_type:%'")
add("touched_series", alerts.touched_series, f"WITH s AS ({SERIES}) SELECT DISTINCT series FROM s")
NO_LEAST = {"global": 0, "wiki": 0}
add("alert_baseline", lambda e: alerts.baseline(alerts.alert_series(e, HOUR), 3600).select("series", "bucket", "event_count", "n", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation")),
    f"WITH {z_sql(SERIES)} SELECT series, bucket, event_count, n, round(mean, 4) AS mean, round(deviation, 4) AS deviation FROM z")
ZSCORE = "SELECT series, bucket, CASE WHEN series = 'global' THEN 'GLOBAL_ACTIVITY_SPIKE' ELSE 'WIKI_ACTIVITY_SPIKE' END AS alert_type, event_count AS current_count, round(mean, 4) AS baseline_avg, round(deviation, 4) AS baseline_stddev, round(z, 4) AS z_score, 2.0::DOUBLE AS threshold FROM z WHERE n >= 10 AND z > 2 AND series NOT LIKE 'log_type:%'"
add("alert_zscore", lambda e: alerts.alert_zscore(alerts.alert_series(e, HOUR), 3600, min_count=NO_LEAST), f"WITH {z_sql(SERIES)} {ZSCORE}")
BY_DAY = SERIES.replace("'hour'", "'day'")
add("alert_zscore_by_day", lambda e: alerts.alert_zscore(alerts.alert_series(e, "1 day"), 86_400),
    f"WITH {z_sql(BY_DAY, 86_400)}, q AS ({ZSCORE}) SELECT * FROM q WHERE current_count >= CASE WHEN series = 'global' THEN 50 ELSE 30 END")
GROUPS = ", ".join(f"coalesce(sum(event_count) OVER (PARTITION BY series ORDER BY k RANGE BETWEEN {5 * (g + 1) - 1} PRECEDING AND {5 * g} PRECEDING), 0)" for g in range(6, 0, -1))
BURST = f"""WITH s AS ({SERIES}), n AS (SELECT series, cast(epoch(bucket) AS bigint) // 3600 AS k, event_count FROM s WHERE series LIKE 'log_type:%'),
x AS (SELECT series, unnest(range(min(k), max(k) + 1)) AS k FROM n GROUP BY series),
d AS (SELECT x.series, x.k, coalesce(n.event_count, 0) AS event_count FROM x LEFT JOIN n USING (series, k)),
w AS (SELECT series, k, sum(event_count) OVER (PARTITION BY series ORDER BY k RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS current, list_filter([{GROUPS}], lambda v: v > 0) AS g FROM d),
r AS (SELECT *, list_sum(g) / len(g) AS mean FROM w WHERE len(g) >= 3 AND current > 0)
SELECT series, to_timestamp(k * 3600)::TIMESTAMP AS bucket, 'MODERATION_BURST' AS alert_type, current::BIGINT AS current_count, round(mean, 4) AS baseline_avg, round(current / greatest(mean, 1), 4) AS burst_ratio, 1.5::DOUBLE AS threshold_ratio
FROM r WHERE current / greatest(mean, 1) > 1.5 AND current >= 5"""
add("moderation_burst", lambda e: alerts.moderation_burst(alerts.alert_series(e, HOUR), 3600, ratio=1.5, min_count={"delete": 5, "block": 5}), BURST)
#: The usual limits, at the grain of a day: bursts of a day over the five days' sums before it.
BURST_LIMITS = {"span": 1, "groups": 6}
DAY_GROUPS = ", ".join(f"coalesce(sum(event_count) OVER (PARTITION BY series ORDER BY k RANGE BETWEEN {g} PRECEDING AND {g} PRECEDING), 0)" for g in range(6, 0, -1))
DAY_BURST = f"""n AS (SELECT series, cast(epoch(bucket) AS bigint) // 86400 AS k, event_count FROM s WHERE series LIKE 'log_type:%'),
w AS (SELECT series, k, event_count AS current, list_filter([{DAY_GROUPS}], lambda v: v > 0) AS g FROM n),
r AS (SELECT *, list_sum(g) / len(g) AS mean FROM w WHERE len(g) >= 3)
SELECT series, to_timestamp(k * 86400)::TIMESTAMP AS bucket, 'MODERATION_BURST' AS alert_type, current::BIGINT AS current_count, mean AS baseline_avg, current / greatest(mean, 1) AS burst_ratio, 1.05::DOUBLE AS threshold_ratio
FROM r WHERE current / greatest(mean, 1) > 1.05 AND current >= CASE series WHEN 'log_type:delete' THEN 5 ELSE 3 END"""
CREATED = "2024-02-01 00:00:00"


def alert_messages(events: DataFrame) -> DataFrame:
    """Messages of all alerts at the grain of a day; bursts at a ratio that the given rows reach."""
    series = alerts.alert_series(events, "1 day")
    found = alerts.all_alerts(alerts.alert_zscore(series, 86_400), alerts.moderation_burst(series, 86_400, ratio=1.05, **BURST_LIMITS))
    return alerts.alert_messages(found, F.lit(CREATED).cast("timestamp"))


ISO = "%Y-%m-%dT%H:%M:%SZ"
add("alert_messages", alert_messages, f"""WITH s AS ({BY_DAY}), {z_sql("SELECT * FROM s", 86_400)}, q AS ({ZSCORE}), v AS (SELECT * FROM q WHERE current_count >= CASE WHEN series = 'global' THEN 50 ELSE 30 END),
{DAY_BURST.replace("SELECT series, to_timestamp", ", b AS (SELECT series, to_timestamp", 1)}),
u AS (SELECT series, bucket, alert_type, current_count, baseline_avg, baseline_stddev, z_score, threshold, NULL::DOUBLE AS burst_ratio, NULL::DOUBLE AS threshold_ratio FROM v
UNION ALL SELECT series, bucket, alert_type, current_count, round(baseline_avg, 4), NULL, NULL, NULL, round(burst_ratio, 4), threshold_ratio FROM b)
SELECT 'realtime.alert.triggered' AS message_type, alert_type, 'warning' AS severity, CASE WHEN series LIKE 'wiki:%' THEN substr(series, 6) END AS wiki, CASE WHEN series LIKE 'log_type:%' THEN substr(series, 10) END AS log_type,
CASE WHEN series = 'global' THEN 'ALERT#GLOBAL' WHEN series LIKE 'wiki:%' THEN 'ALERT#WIKI#' || substr(series, 6) ELSE 'ALERT#LOG_TYPE#' || substr(series, 10) END AS alert_key,
'WINDOW#' || strftime(bucket, '{ISO}') AS window_key, strftime(bucket, '{ISO}') AS window_start,
CASE WHEN burst_ratio IS NULL THEN current_count END AS current_count, CASE WHEN burst_ratio IS NULL THEN baseline_avg END AS baseline_avg, baseline_stddev, z_score, threshold,
CASE WHEN burst_ratio IS NOT NULL THEN current_count END AS current_5m_count, CASE WHEN burst_ratio IS NOT NULL THEN baseline_avg END AS baseline_5m_avg, burst_ratio, threshold_ratio, '2024-02-01T00:00:00Z' AS created_at FROM u""")  # fmt: skip
add("dense_spine", lambda e: alerts.dense_spine(alerts.alert_series(e, HOUR).where("series LIKE 'log_type:%'"), 3600).select("series", "k", "event_count"), BURST.split("w AS (")[0].rstrip(",\n ") + " SELECT series, k, event_count FROM d")
add("alert_candidates", lambda e: alerts.alert_candidates(alerts.alert_series(e, HOUR), 5),
    f"WITH s AS ({SERIES}) SELECT bucket, series FROM s QUALIFY series NOT LIKE 'wiki:%' OR row_number() OVER (PARTITION BY bucket, series LIKE 'wiki:%' ORDER BY series) <= 5")
add("new_alerts", lambda e: alerts.publish_once((z := alerts.alert_zscore(alerts.alert_series(e, HOUR), 3600, min_count=NO_LEAST)), z.where("series = 'global'")).select("series", "bucket", "status"),
    f"WITH {z_sql(SERIES)}, q AS ({ZSCORE}) SELECT series, bucket, 'SENT' AS status FROM q WHERE series <> 'global'")

RATIO = "round(count(*) FILTER (is_bot) / count(*), 4) AS bot_ratio"
TOTALS = f"count(*) AS total, count(*) FILTER (is_bot) AS bot_count, count(*) FILTER (NOT is_bot) AS human_count, {RATIO}"
BOUNDS = "epoch_us(min(occurred_at)) // 1000 AS oldest_ms, epoch_us(max(occurred_at)) // 1000 AS latest_ms"
SCALARS = ("total", "bot_count", "human_count", "bot_ratio")
add("snapshot_global", lambda e: snapshots.snapshot_global(e, HOUR).select("window_start", *SCALARS, F.size("change_types").alias("n_types"), F.size("top_pages").alias("n_pages"), "oldest_ms", "latest_ms"),
    f"WITH l AS ({L}) SELECT window_start, {TOTALS}, 5 AS n_types, CASE WHEN count(*) FILTER (namespace = '0') > 0 THEN least(10, count(DISTINCT (wiki, title)) FILTER (namespace = '0')) END::INT AS n_pages, {BOUNDS} FROM l GROUP BY 1")
add("snapshot_global_types", lambda e: snapshots.snapshot_global(e, HOUR).select("window_start", F.explode("change_types").alias("change_type", "event_count")),
    f"WITH l AS ({L}), t AS (SELECT unnest(['edit', 'new', 'categorize', 'log', 'external']) AS change_type), w AS (SELECT DISTINCT window_start FROM l) "
    "SELECT w.window_start, t.change_type, count(l.event_id) AS event_count FROM w CROSS JOIN t LEFT JOIN l ON l.window_start = w.window_start AND l.change_type = t.change_type GROUP BY 1, 2")  # fmt: skip
add("snapshot_wiki", lambda e: snapshots.snapshot_wiki(e, None, HOUR).select("window_start", "wiki", "topic", *SCALARS, F.size("change_types").alias("n_types")),
    f"WITH l AS ({L}) SELECT window_start, wiki, 'wiki:' || wiki AS topic, {TOTALS}, count(DISTINCT change_type)::INT AS n_types FROM l GROUP BY 1, 2")
add("snapshot_top_pages", lambda e: snapshots.snapshot_top_pages(e, HOUR).select("window_start", "total", F.size("top_pages").alias("n_pages"), F.col("top_pages")[0]["title"].alias("first_title")),
    f"WITH l AS ({L}), {TOP_PAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, wiki, title) AS rank FROM t QUALIFY rank <= 10) "
    "SELECT window_start, sum(event_count)::BIGINT AS total, count(*)::INT AS n_pages, max(CASE WHEN rank = 1 THEN title END) AS first_title FROM r GROUP BY 1")  # fmt: skip
KNOWN = ", ".join(f"'{n}'" for n in NAMESPACES)
add("snapshot_global_namespaces", lambda e: snapshots.snapshot_global(e, HOUR).select("window_start", F.explode("namespace_distribution").alias("namespace", "event_count")),
    f"WITH l AS ({L}) SELECT window_start, namespace, count(*) AS event_count FROM l WHERE namespace IN ({KNOWN}) GROUP BY 1, 2")
add("snapshot_global_top_wikis", lambda e: snapshots.snapshot_global(e, HOUR).select("window_start", F.posexplode("top_wikis").alias("at", "w")).select("window_start", (F.col("at") + 1).alias("rank"), "w.*"), f"WITH l AS ({L}) {TOP_WIKIS}")
add("snapshot_global_top_pages", lambda e: snapshots.snapshot_global(e, HOUR).select("window_start", F.posexplode("top_pages").alias("at", "p")).select("window_start", (F.col("at") + 1).alias("rank"), "p.*"), 
    f"WITH l AS ({L}), {TOP_PAGES} SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY event_count DESC, wiki, title) AS rank FROM t QUALIFY rank <= 10")
add("snapshot_wiki_types", lambda e: snapshots.snapshot_wiki(e, None, HOUR).select("window_start", "wiki", F.explode("change_types").alias("change_type", "event_count")),
    f"WITH l AS ({L}) SELECT window_start, wiki, change_type, count(*) AS event_count FROM l GROUP BY 1, 2, 3")
add("snapshot_wiki_namespaces", lambda e: snapshots.snapshot_wiki(e, None, HOUR).select("window_start", "wiki", F.explode("namespace_distribution").alias("namespace", "event_count")),
    f"WITH l AS ({L}) SELECT window_start, wiki, namespace, count(*) AS event_count FROM l WHERE namespace IN ({KNOWN}) GROUP BY 1, 2, 3")
add("snapshot_wiki_top_pages", lambda e: snapshots.snapshot_wiki(e, None, HOUR).select("window_start", "wiki", F.posexplode("top_pages").alias("at", "p")).select("window_start", "wiki", (F.col("at") + 1).alias("rank"), "p.*"),
    f"WITH l AS ({L}), {TOP_PAGES} SELECT *, row_number() OVER (PARTITION BY window_start, wiki ORDER BY event_count DESC, title) AS rank FROM t QUALIFY rank <= 10")
#: Windows whose bots give no bounds of their own take those of all bots.
add("snapshot_with_bounds", lambda e: snapshots.with_bounds(snapshots.by_wiki(e, HOUR).select("window_start", "wiki", "total"), live.live_event_bounds(e.where("user_is_bot AND change_type = 'log'"), HOUR)),
    f"WITH l AS ({L}), b AS (SELECT window_start, epoch_us(min(occurred_at)) // 1000 AS oldest_ms, epoch_us(max(occurred_at)) // 1000 AS latest_ms FROM l WHERE is_bot AND change_type = 'log' GROUP BY ROLLUP (window_start)), "
    "c AS (SELECT window_start, wiki, count(*) AS total FROM l GROUP BY 1, 2) SELECT c.*, coalesce(b.oldest_ms, o.oldest_ms) AS oldest_ms, coalesce(b.latest_ms, o.latest_ms) AS latest_ms "
    "FROM c LEFT JOIN b USING (window_start), (SELECT * FROM b WHERE window_start IS NULL) AS o")  # fmt: skip
BY_MINUTE = L.replace("'hour'", "'minute'")
add("live_counts_by_minute", live.live_counts, f"WITH l AS ({BY_MINUTE}) {FAMILY_UNION}")
add("snapshot_global_by_minute", lambda e: snapshots.snapshot_global(e).select("window_start", *SCALARS, "oldest_ms", "latest_ms"), f"WITH l AS ({BY_MINUTE}) SELECT window_start, {TOTALS}, {BOUNDS} FROM l GROUP BY 1")
for _kind, _keys, _n in (("wikis", "wiki", 10), ("change_types", "change_type", 8), ("namespaces", "namespace", 10), ("pages", "wiki, title", 15)):
    add(f"chart_points_{_kind}", lambda e, k=_kind, c=_keys: snapshots.chart_points(e.groupBy(*c.split(", ")).agg(F.count(F.lit(1)).alias("event_count")), k),
        f"SELECT {_keys}, count(*) AS event_count FROM a GROUP BY {_keys} ORDER BY event_count DESC, {_keys} LIMIT {_n}")
#: Fixed values, written out apart from the operator's own.
EDGE_SQL = """CASE WHEN ms <= 0 THEN 0 WHEN ms <= 1000 THEN 1000 WHEN ms <= 2000 THEN 2000 WHEN ms <= 3000 THEN 3000 WHEN ms <= 4000 THEN 4000 WHEN ms <= 5000 THEN 5000
WHEN ms <= 6000 THEN 6000 WHEN ms <= 7500 THEN 7500 WHEN ms <= 10000 THEN 10000 WHEN ms <= 12500 THEN 12500 WHEN ms <= 15000 THEN 15000 WHEN ms <= 20000 THEN 20000
WHEN ms <= 30000 THEN 30000 WHEN ms <= 45000 THEN 45000 WHEN ms <= 60000 THEN 60000 WHEN ms <= 90000 THEN 90000 WHEN ms <= 120000 THEN 120000 END"""
#: A delivery for each event: topics of all types, some negative latencies, some that failed.
DELIVERIES = """SELECT event_id AS delivery_id, CASE new_length % 5 WHEN 0 THEN 'global' WHEN 1 THEN 'top_pages' WHEN 2 THEN 'other' ELSE concat('wiki:', wiki) END AS topic,
CASE WHEN user_is_bot THEN 'failed' ELSE 'sent' END AS status, {ms} AS posted_ms, {ms} - (new_length * 300 - 900) AS latest_ms, {ms} - new_length * 500 AS oldest_ms FROM {a}"""
TYPE_SQL = "CASE WHEN topic IN ('global', 'top_pages') THEN topic WHEN topic LIKE 'wiki:%' THEN 'wiki' ELSE 'unknown' END"
HISTOGRAM_SQL = f"{EDGE_SQL} AS le_ms, count(*) AS n, min(ms) AS min_ms, max(ms) AS max_ms"


def deliveries(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(DELIVERIES.format(ms="unix_millis(occurred_at)", a="{a}"), a=events)


add("latency_histogram", lambda e: monitoring.latency_histogram(deliveries(e).withColumn("type", S.topic_type(F.col("topic"))), "latest_ms", "posted_ms", "type"),
    f"WITH d AS ({DELIVERIES.format(ms='epoch_us(occurred_at) // 1000', a='a')}), m AS (SELECT {TYPE_SQL} AS label, posted_ms - latest_ms AS ms FROM d) SELECT label, {HISTOGRAM_SQL} FROM m WHERE ms >= 0 GROUP BY 1, 2")
add("delivery_latency", lambda e: monitoring.delivery_latency(deliveries(e)),
    f"WITH d AS ({DELIVERIES.format(ms='epoch_us(occurred_at) // 1000', a='a')}), m AS (SELECT {TYPE_SQL} AS label, 'latest' AS measure, posted_ms - latest_ms AS ms FROM d WHERE status = 'sent' "
    f"UNION ALL SELECT {TYPE_SQL}, 'oldest', posted_ms - oldest_ms FROM d WHERE status = 'sent') SELECT label, measure, {HISTOGRAM_SQL} FROM m WHERE ms >= 0 GROUP BY 1, 2, 3")  # fmt: skip
add("ingest_funnel", lambda e: monitoring.ingest_funnel(e.withColumn("status", F.when(F.col("title").isNull(), "invalid").when(S.sampled(F.col("event_id"), 0.1), "kept").otherwise("sampled_out"))),
    "WITH s AS (SELECT cast('0x' || substr(sha256(event_id), 1, 8) AS bigint) / 4294967295 < 0.1 AS k FROM a) "
    "SELECT count(*) AS received, 0::BIGINT AS parse_failed, 0::BIGINT AS invalid, 0::BIGINT AS canary, count(*) FILTER (NOT k) AS sampled_out, count(*) FILTER (k) AS kept FROM s")  # fmt: skip

ACTIONS = """WITH x AS (SELECT conv_id AS connection_id, turn AS seq, CASE WHEN length(text) % 3 = 0 THEN 'unsubscribe' ELSE 'subscribe' END AS action,
  CASE turn % 5 WHEN 0 THEN 'global' WHEN 1 THEN 'top_pages' WHEN 2 THEN 'wiki:w00wiki' WHEN 3 THEN 'wiki:w01wiki' ELSE 'BAD TOPIC' END AS topic FROM conversations),
f AS (SELECT connection_id, topic, max_by(action, seq) AS action FROM x WHERE topic <> 'BAD TOPIC' GROUP BY 1, 2),
st AS (SELECT connection_id, topic FROM f WHERE action = 'subscribe' UNION SELECT DISTINCT connection_id, 'global' FROM x)"""
QUERIES["subscription_state"] = lambda spark, d: subscriptions.subscription_state(subscription_actions(spark, d))
ORACLE_SQL["subscription_state"] = f"{ACTIONS} SELECT connection_id, topic FROM st"


def active_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections whose time to live, from their last action and two hours on, isn't over in the middle of all; some have none."""
    last = subscription_actions(spark, sf_dir).groupBy("connection_id").agg(F.max("seq").alias("seq"))
    ttl = F.when(F.col("connection_id") % 7 > 0, F.col("connection_id") * 60 + F.col("seq") + 7200).alias("ttl")
    return subscriptions.active_subscriptions(last.select("connection_id", ttl), F.timestamp_seconds(F.lit(9000)))


QUERIES["active_subscriptions"] = active_subscriptions
ORACLE_SQL["active_subscriptions"] = """WITH x AS (SELECT conv_id AS connection_id, CASE WHEN conv_id % 7 > 0 THEN conv_id * 60 + max(turn) + 7200 END AS ttl FROM conversations GROUP BY conv_id)
SELECT * FROM x WHERE ttl IS NULL OR ttl >= 9000"""


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = subscriptions.subscription_table(subscriptions.subscription_state(subscription_actions(spark, sf_dir)))
    events = silver_events(spark, sf_dir)
    wikis = live.family(snapshots.required_wikis(events, snapshots.subscribed_wikis(table)), "wiki_activity", "1 day")
    shots = wikis.select(F.concat(F.lit("wiki:"), "wiki").alias("topic"), "window_start", F.col("event_count").alias("total"))
    everything = live.family(events, "global_activity", "1 day")
    shots = shots.union(everything.select(F.lit("global"), "window_start", "event_count"))
    return plain(snapshots.fan_out(shots, table).select("connection_id", "topic", "window_start", "total"))


QUERIES["fan_out"] = fan_out
ORACLE_SQL["fan_out"] = f"""{ACTIONS}, a AS ({DUCK_EVENTS}), g AS (SELECT 'global' AS topic, date_trunc('day', occurred_at)::TIMESTAMP AS window_start, count(*) AS total FROM a GROUP BY 1, 2
UNION ALL SELECT 'wiki:' || wiki, date_trunc('day', occurred_at)::TIMESTAMP, count(*) FROM a GROUP BY 1, 2) SELECT connection_id, topic, window_start, total FROM st JOIN g USING (topic)"""
