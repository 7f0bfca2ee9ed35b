"""Reports in SQL over silver-like rows. {a} stands for the events; times count from the data's last event, or as_of.

With as_of nothing is read to learn the time, and the filter on event time is a
literal that reaches the scan; of rows by hour partition, only the hours that the
report looks at are listed.

Reports that ask for no single page also come from the hourly gold sets, which
are far smaller than the events: {s} stands for the set.  Their "last 24 hours"
are the hour of the last event, or of as_of, and the 23 before it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gold import activity_spikes
from tidemark.sources.lake import in_hours
from tidemark.sources.schemas import PARTS

H, D = "date_trunc('hour', occurred_at)", "cast(cast(occurred_at AS date) AS string)"
NOW = "(SELECT max(occurred_at) AS now FROM {a})"
RECENT = "FROM {a} CROSS JOIN " + NOW + " t WHERE occurred_at > t.now - INTERVAL '%s' %s"
BOT_PERCENT = "round(1e2 * sum(CASE WHEN user_is_bot THEN 1 ELSE 0 END) / count(*), 2)"

REPORTS: dict[str, str] = {
    "most_edited_articles_7d": f"SELECT wiki, title, count(*) AS edits {RECENT % (7, 'day')} AND namespace = 0 AND change_type = 'edit' GROUP BY wiki, title ORDER BY edits DESC, wiki, title LIMIT 10",
    "bot_ratio_24h": f"SELECT {H} AS hour, {BOT_PERCENT} AS bot_percent {RECENT % (24, 'hour')} GROUP BY 1 ORDER BY 1",
    "active_wikis_last_hour": "SELECT wiki, count(*) AS event_count, " + BOT_PERCENT + " AS bot_percent FROM {a} CROSS JOIN " + NOW
    + f" t WHERE {H} = date_trunc('hour', t.now) - INTERVAL '1' hour GROUP BY wiki ORDER BY event_count DESC, wiki LIMIT 10",
    "kpi_totals": "SELECT sum(CASE WHEN occurred_at > t.now - INTERVAL '24' hour THEN 1 ELSE 0 END) AS events_24h, sum(CASE WHEN occurred_at > t.now - INTERVAL '7' day THEN 1 ELSE 0 END) AS events_7d,"
    " sum(CASE WHEN occurred_at > t.now - INTERVAL '30' day THEN 1 ELSE 0 END) AS events_30d, round(count(*) * 1e0 / count(DISTINCT " + H + "), 4) AS events_per_hour FROM {a} CROSS JOIN " + NOW + " t",
    "kpi_peak_hour": f"SELECT {H} AS hour, count(*) AS event_count FROM {{a}} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "bot_ratio_trend": f"SELECT {D} AS day, {BOT_PERCENT} AS bot_percent FROM {{a}} GROUP BY 1",
    "events_over_time": f"SELECT {H} AS hour, count(*) AS event_count FROM {{a}} GROUP BY 1",
    "bot_human_daily": f"SELECT {D} AS day, user_is_bot, count(*) AS event_count FROM {{a}} GROUP BY 1, 2",
    "most_active_wiki_24h": f"SELECT wiki, count(*) AS event_count {RECENT % (24, 'hour')} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 1",
    "highest_bot_ratio_wiki": f"SELECT wiki, {BOT_PERCENT} AS bot_percent FROM {{a}} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 1",
    "top10_wikis": "SELECT wiki, count(*) AS event_count FROM {a} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 10",
    "wiki_heatmap": "SELECT wiki, cast(extract(dow FROM occurred_at) AS int) AS day_of_week, cast(extract(hour FROM occurred_at) AS int) AS hour_of_day, count(*) AS event_count FROM {a} GROUP BY 1, 2, 3",
    "wiki_trend_30d": f"SELECT {D} AS day, wiki, count(*) AS event_count {RECENT % (30, 'day')} GROUP BY 1, 2",
    "most_edited_page_24h": f"SELECT wiki, title, count(*) AS event_count {RECENT % (24, 'hour')} AND change_type = 'edit' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1",
    "most_created_pages_7d": f"SELECT wiki, title, count(*) AS event_count {RECENT % (7, 'day')} AND change_type = 'new' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
    "top20_pages": "SELECT wiki, title, count(*) AS event_count FROM {a} WHERE change_type = 'edit' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20",
    "page_activity_over_time": f"SELECT {H} AS hour, wiki, title, count(*) AS event_count FROM {{a}} GROUP BY 1, 2, 3",
    "change_type_daily": f"SELECT day, change_type, n AS event_count, round(n * 1e0 / sum(n) OVER (PARTITION BY day), 4) AS share FROM (SELECT {D} AS day, change_type, count(*) AS n FROM {{a}} GROUP BY 1, 2) x",
    "change_type_trend_30d": f"SELECT {D} AS day, change_type, count(*) AS event_count {RECENT % (30, 'day')} GROUP BY 1, 2",
    "namespace_distribution": "SELECT namespace, count(*) AS event_count FROM {a} GROUP BY namespace",
}

#: Over hourly spikes {s}.
SPIKES: dict[str, str] = {
    "spikes_30d": "SELECT hour, wiki, event_count, z_score FROM {s} CROSS JOIN (SELECT max(hour) AS now FROM {s}) t WHERE z_score > 2 AND hour > t.now - INTERVAL '30' day ORDER BY z_score DESC, hour, wiki LIMIT 20",
    "spike_timeline": "SELECT hour, event_count, z_score FROM {s} WHERE wiki = '*'",
    "spike_table": "SELECT hour, wiki, event_count, z_score FROM {s} WHERE is_spike",
}


#: Hours that a report looks back, where it doesn't read everything.
HOURS = {
    "most_edited_articles_7d": 168, "bot_ratio_24h": 24, "active_wikis_last_hour": 2, "most_active_wiki_24h": 24, "wiki_trend_30d": 720, "most_edited_page_24h": 24,
    "most_created_pages_7d": 168, "change_type_trend_30d": 720,
}


def at_time(text: str, as_of: str, column: str = "occurred_at", now: str = NOW) -> str:
    """The text with a literal time for the data's last one, and nothing later counted."""
    dated = text.replace(f" CROSS JOIN {now} t WHERE", f" WHERE {column} <= TIMESTAMP '{as_of}' AND").replace(f" CROSS JOIN {now} t", f" WHERE {column} <= TIMESTAMP '{as_of}'")
    return dated.replace("t.now", f"TIMESTAMP '{as_of}'")


def looked_at(rows: DataFrame, name: str, as_of: str) -> DataFrame:
    """Rows of the hours that a report looks at, where they are laid out by hour."""
    if name not in HOURS or not set(PARTS) <= set(rows.columns):
        return rows
    last = datetime.fromisoformat(as_of)
    first = last - timedelta(hours=HOURS[name])
    return rows.where(in_hours(*(tuple(t.strftime(f) for f in ("%Y", "%m", "%d", "%H")) for t in (first, last))))


def report(name: str, events: DataFrame, as_of: str | None = None) -> DataFrame:
    """as_of: a UTC time as text, 'yyyy-MM-dd HH:mm:ss'."""
    text = REPORTS[name].replace("extract(dow FROM occurred_at)", "dayofweek(occurred_at) - 1")
    if as_of is not None:
        text, events = at_time(text, as_of), looked_at(events, name, as_of)
    return events.sparkSession.sql(text, a=events)


GOLD_NOW = "(SELECT max(metric_hour) AS now FROM {s})"
HOURLY = "FROM {s} CROSS JOIN " + GOLD_NOW + " t WHERE metric_hour > t.now - INTERVAL '%s' %s"
TOTAL, DAY = "sum(event_count) AS event_count", "cast(metric_date AS string) AS day"
BOTS = "round(1e2 * sum(bot_event_count) / sum(event_count), 2) AS bot_percent"
WIKIS, TYPES = "wiki_activity_by_hour", "change_type_by_hour"
IN_LAST = "sum(CASE WHEN metric_hour > t.now - INTERVAL '%s' %s THEN event_count ELSE 0 END) AS %s"
#: Report -> the gold set it reads, and its text.
GOLD_REPORTS: dict[str, tuple[str, str]] = {
    "bot_ratio_24h": (WIKIS, f"SELECT metric_hour AS hour, {BOTS} {HOURLY % (24, 'hour')} GROUP BY 1 ORDER BY 1"),
    "active_wikis_last_hour": (WIKIS, f"SELECT wiki, event_count, round(1e2 * bot_event_count / event_count, 2) AS bot_percent FROM {{s}} CROSS JOIN {GOLD_NOW} t WHERE metric_hour = t.now - INTERVAL '1' hour ORDER BY event_count DESC, wiki LIMIT 10"),
    "kpi_totals": (WIKIS, f"SELECT {IN_LAST % (24, 'hour', 'events_24h')}, {IN_LAST % (7, 'day', 'events_7d')}, {IN_LAST % (30, 'day', 'events_30d')}, round(sum(event_count) * 1e0 / count(DISTINCT metric_hour), 4) AS events_per_hour FROM {{s}} CROSS JOIN {GOLD_NOW} t"),
    "kpi_peak_hour": (WIKIS, f"SELECT metric_hour AS hour, {TOTAL} FROM {{s}} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
    "bot_ratio_trend": (WIKIS, f"SELECT {DAY}, {BOTS} FROM {{s}} GROUP BY 1"),
    "events_over_time": (WIKIS, f"SELECT metric_hour AS hour, {TOTAL} FROM {{s}} GROUP BY 1"),
    "bot_human_daily": ("bot_activity_by_hour", f"SELECT {DAY}, user_is_bot, {TOTAL} FROM {{s}} GROUP BY 1, 2"),
    "most_active_wiki_24h": (WIKIS, f"SELECT wiki, {TOTAL} {HOURLY % (24, 'hour')} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 1"),
    "highest_bot_ratio_wiki": (WIKIS, f"SELECT wiki, {BOTS} FROM {{s}} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 1"),
    "top10_wikis": (WIKIS, f"SELECT wiki, {TOTAL} FROM {{s}} GROUP BY wiki ORDER BY 2 DESC, 1 LIMIT 10"),
    "wiki_heatmap": (WIKIS, f"SELECT wiki, dayofweek(metric_hour) - 1 AS day_of_week, hour(metric_hour) AS hour_of_day, {TOTAL} FROM {{s}} GROUP BY 1, 2, 3"),
    "wiki_trend_30d": (WIKIS, f"SELECT {DAY}, wiki, {TOTAL} {HOURLY % (30, 'day')} GROUP BY 1, 2"),
    "change_type_daily": (TYPES, f"SELECT day, change_type, event_count, round(event_count * 1e0 / sum(event_count) OVER (PARTITION BY day), 4) AS share FROM (SELECT {DAY}, change_type, {TOTAL} FROM {{s}} GROUP BY 1, 2) x"),
    "change_type_trend_30d": (TYPES, f"SELECT {DAY}, change_type, {TOTAL} {HOURLY % (30, 'day')} GROUP BY 1, 2"),
    "namespace_distribution": ("namespace_activity_by_hour", f"SELECT namespace, {TOTAL} FROM {{s}} GROUP BY namespace"),
}


def gold_report(name: str, gold_set: DataFrame, as_of: str | None = None) -> DataFrame:
    """A report from the gold set that GOLD_REPORTS names for it."""
    text = GOLD_REPORTS[name][1]
    if as_of is not None:
        hour = f"{as_of[:13]}:00:00"
        text, gold_set = at_time(text, hour, "metric_hour", GOLD_NOW), looked_at(gold_set, name, hour)
    return gold_set.sparkSession.sql(text, s=gold_set)


def whole_hours(text: str) -> str:
    """A report's text over events, with its last hours counted by the hour as the gold sets do."""
    return text.replace("occurred_at > t.now -", f"{H} > date_trunc('hour', t.now) -")


SPIKE_NOW = "(SELECT max(hour) AS now FROM {s})"
#: Days that a spike report at a given time looks back, and hours before them that the first z-scores need.
SPIKE_DAYS, SPIKE_BASE_HOURS = 30, 30


def spike_report(name: str, spikes: DataFrame) -> DataFrame:
    return spikes.sparkSession.sql(SPIKES[name], s=spikes)


def spike_text_at(name: str, as_of: str) -> str:
    """A spike report's text at a time: over the spikes of the days before it."""
    text = at_time(SPIKES[name], as_of, "hour", SPIKE_NOW)
    return text if text != SPIKES[name] else f"{text} AND hour <= TIMESTAMP '{as_of}' AND hour > TIMESTAMP '{as_of}' - INTERVAL '{SPIKE_DAYS}' day"


def spike_report_at(name: str, events: DataFrame, as_of: str) -> DataFrame:
    """A spike report of a time, from the events of the days before it alone and of the hours that their first baselines take."""
    last = datetime.fromisoformat(as_of)
    first = last.replace(minute=0, second=0, microsecond=0) - timedelta(days=SPIKE_DAYS, hours=SPIKE_BASE_HOURS)
    if set(PARTS) <= set(events.columns):
        events = events.where(in_hours(*(tuple(t.strftime(f) for f in ("%Y", "%m", "%d", "%H")) for t in (first, last))))
    rows = events.where((F.col("occurred_at") >= F.lit(first.isoformat(" ")).cast("timestamp")) & (F.col("occurred_at") <= F.lit(as_of).cast("timestamp")))
    return events.sparkSession.sql(spike_text_at(name, as_of), s=activity_spikes(rows, SPIKE_BASE_HOURS))
