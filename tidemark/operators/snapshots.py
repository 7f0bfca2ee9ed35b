"""Read models by window, their subscribers and their form for charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.functions import scalars as S
from tidemark.operators import live
from tidemark.sources.schemas import CHANGE_TYPES, NAMESPACES

PAGE = ("wiki", "title", "event_count", "last_change_type", "last_seen_at", "title_url")


def counters() -> list[Column]:
    """Aggregates of rows with change_type, user_is_bot, namespace and ms: total, bots, humans, known types and namespaces, oldest and latest event time."""
    types = [F.count_if(F.col("change_type") == t).alias(f"type_{k}") for k, t in enumerate(CHANGE_TYPES)]
    spaces = [F.count_if(F.col("namespace") == str(n)).alias(f"space_{k}") for k, n in enumerate(NAMESPACES)]
    flags = (F.count_if("user_is_bot").alias("bot_count"), F.count_if(~F.col("user_is_bot")).alias("human_count"))
    return [F.count(F.lit(1)).alias("total"), *flags, *types, *spaces, F.min("ms").alias("oldest_ms"), F.max("ms").alias("latest_ms")]


def by_wiki(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """All counters of a wiki's window in one row and one pass."""
    rows = events.select(F.window("occurred_at", window).start.alias("window_start"), "wiki", "change_type", "user_is_bot", F.col("namespace").cast("string").alias("namespace"), live.event_ms(events).alias("ms"))
    return rows.groupBy("window_start", "wiki").agg(*counters())


SUMS = ("total", "bot_count", "human_count", *(f"type_{k}" for k in range(len(CHANGE_TYPES))), *(f"space_{k}" for k in range(len(NAMESPACES))))


def as_map(names: tuple, prefix: str, zeros: bool) -> Column:
    """Counters as a map from their names, with or without those at 0."""
    entries = F.array(*[F.struct(F.lit(str(n)).alias("key"), F.col(f"{prefix}{k}").alias("value")) for k, n in enumerate(names)])
    return F.map_from_entries(entries if zeros else F.filter(entries, lambda e: e["value"] > 0))


def as_list(fields: tuple[str, ...], keep: Column | None = None) -> Column:
    """An aggregate: ranked rows, at most the n that top_n has left, in order of rank."""
    item = F.struct("rank", *fields)
    ordered = F.array_sort(F.collect_list(item if keep is None else F.when(keep, item)))
    return F.transform(ordered, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def finished(counts: DataFrame, by: tuple[str, ...], zeros: bool, *lists: str) -> DataFrame:
    return counts.select(
        *by, "total", "bot_count", "human_count", S.bot_ratio(F.col("bot_count"), F.col("human_count")).alias("bot_ratio"),
        as_map(CHANGE_TYPES, "type_", zeros).alias("change_types"), as_map(NAMESPACES, "space_", False).alias("namespace_distribution"), *lists, "oldest_ms", "latest_ms",
    )


def global_of(wikis: DataFrame, n: int = 10) -> DataFrame:
    """From rows of by_wiki to rows of a window, with its largest wikis: the rank and the sums share one shuffle by window."""
    order = Window.partitionBy("window_start").orderBy(F.col("total").desc(), "wiki")
    ranked = wikis.withColumns({"rank": F.row_number().over(order), "event_count": F.col("total")})
    top = as_list(("wiki", "event_count"), (F.col("rank") <= n) & F.col("wiki").isNotNull())
    sums = ranked.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in SUMS], F.min("oldest_ms").alias("oldest_ms"), F.max("latest_ms").alias("latest_ms"), top.alias("top_wikis"))
    return finished(sums, ("window_start",), True, "top_wikis")


def snapshot_global(events: DataFrame, window: str = "1 minute", n: int = 10) -> DataFrame:
    """One pass for all counters and one for pages; both end dealt by window, so they are joined where they are."""
    pages = live.live_top_pages(events, window, n).groupBy("window_start").agg(as_list(PAGE).alias("top_pages"))
    return global_of(by_wiki(events, window), n).join(pages, "window_start", "left").withColumn("topic", F.lit("global"))


def snapshot_wiki(events: DataFrame, wikis: DataFrame | None = None, window: str = "1 minute", n: int = 10) -> DataFrame:
    """By wiki; given wikis, only theirs are computed."""
    events = events if wikis is None else required_wikis(events, wikis)
    by = ("window_start", "wiki")
    pages = live.live_wiki_top_pages(events, window, n).groupBy(*by).agg(as_list(PAGE[1:]).alias("top_pages"))
    out = finished(by_wiki(events, window), by, False).join(pages, list(by), "left")
    return out.withColumn("topic", F.concat(F.lit("wiki:"), "wiki"))


def snapshot_top_pages(events: DataFrame, window: str = "1 minute", n: int = 10) -> DataFrame:
    ranked = live.live_top_pages(events, window, n)
    lists = ranked.groupBy("window_start").agg(F.sum("event_count").alias("total"), as_list(PAGE).alias("top_pages"))
    return lists.withColumn("topic", F.lit("top_pages"))


def with_pages(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Rows of by_wiki (title null) and of its articles (title not null) in one pass; works in an update-mode stream."""
    is_article = (F.col("namespace").try_cast("int") == 0) & F.col("title").isNotNull() & F.col("wiki").isNotNull()
    url = F.col("title_url") if "title_url" in events.columns else F.lit(None).cast("string")
    rows = events.select(
        F.window("occurred_at", window).alias("w"), "wiki", F.when(is_article, F.col("title")).alias("title"), "change_type", "user_is_bot", F.col("namespace").cast("string").alias("namespace"),
        live.event_ms(events).alias("ms"), "occurred_at", "event_id", url.alias("title_url"),
    )
    at = F.struct("occurred_at", "event_id")
    page = [F.max_by("change_type", at).alias("last_change_type"), F.max("occurred_at").alias("last_seen_at"), F.max_by("title_url", at).alias("title_url")]
    by = [[F.col("w"), F.col("wiki")], [F.col("w"), F.col("wiki"), F.col("title")]]
    counted = rows.groupingSets(by, "w", "wiki", "title").agg(*counters(), *page, F.grouping("title").alias("whole"))
    return counted.where("whole = 1 OR title IS NOT NULL").select(F.col("w.start").alias("window_start"), *[c for c in counted.columns if c != "w"])


LISTED = ArrayType(StructType().add("down", "long").add("title", "string").add("last_change_type", "string").add("last_seen_at", "timestamp").add("title_url", "string"))


def wiki_schema(rows: StructType) -> StructType:
    """What merged_pages returns, of rows as with_pages returns them."""
    pages = {"title", "last_change_type", "last_seen_at", "title_url", "whole"}
    return StructType([f for f in rows.fields if f.name not in pages]).add("pages", LISTED)


def merged_pages(rows: DataFrame, before: DataFrame, n: int = 10) -> DataFrame:
    """The wikis' rows with their n largest pages, from a batch's rows and the wikis as they were before it."""
    by = ["window_start", "wiki"]
    item = F.struct((-F.col("total")).alias("down"), "title", "last_change_type", "last_seen_at", "title_url")
    ranked = Window.partitionBy(*by).orderBy(F.col("total").desc(), "title")
    top = rows.where("whole = 0").withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= n)
    top = top.groupBy(*by).agg(F.collect_list(item).alias("new"))
    names = [f.name for f in wiki_schema(rows.schema).fields if f.name != "pages"]
    known = before.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("pages").alias("old"))
    met = rows.where("whole = 1").select(*names).join(top, by, "left")
    met = met.join(known, (F.col("window_start") == F.col("_window_start")) & F.col("wiki").eqNullSafe(F.col("_wiki")), "left")
    new, old = (F.coalesce(c, F.array().cast(LISTED)) for c in ("new", "old"))
    stays = F.filter(old, lambda p: ~F.array_contains(F.transform(new, lambda q: q["title"]), p["title"]))
    return met.select(*names, F.slice(F.array_sort(F.concat(new, stays)), 1, n).alias("pages"))


def listed_pages(pages: Column, wiki: Column) -> Column:
    """Pages as messages have them."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.transform(
        F.coalesce(pages, F.array().cast(LISTED)),
        lambda p: F.struct(
            wiki.alias("wiki"), p["title"].alias("title"), (-p["down"]).alias("count"), p["title_url"].alias("url"), p["title_url"].alias("title_url"), F.lit("0").alias("namespace"),
            p["last_change_type"].alias("last_change_type"), iso(p["last_seen_at"]).alias("last_seen_at"),
        ),
    )


def messages(everything: DataFrame, single: DataFrame, refresh: Column, window: str = "1 minute", n: int = 10, now: Column | None = None) -> DataFrame:
    """(topic, window_start, latest_ms, oldest_ms, message): the message of each window for global and top_pages, and of each wiki in single.

    everything: all wikis' rows, as merged_pages returns them, of the windows; single: those whose own message is wanted.
    """
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    now = F.current_timestamp() if now is None else now

    def told(rows: DataFrame, topic: Column, *data: Column) -> DataFrame:
        message = F.struct(
            F.lit("stats.update").alias("type"), topic.alias("topic"), iso(now).alias("timestamp"), iso("window_start").alias("aggregation_window"), iso(refresh).alias("broadcast_window"),
            F.coalesce(now < F.col("window_start") + F.expr(f"INTERVAL {window}"), F.lit(True)).alias("is_partial_window"), F.struct(*data).alias("data"),
            F.col("latest_ms").alias("latest_event_timestamp_ms"), F.col("oldest_ms").alias("oldest_event_timestamp_ms"),
        )
        return rows.select(topic.alias("topic"), "window_start", "latest_ms", "oldest_ms", F.to_json(message).alias("message"))

    total = F.col("total").alias("current_minute_events_so_far")
    counts = [total, *map(F.col, ("bot_count", "human_count", "bot_ratio"))]
    maps = [F.col("change_types"), F.col("namespace_distribution")]
    wikis = finished(single, ("window_start", "wiki"), False, "pages")
    none = F.array().cast("array<struct<wiki:string,count:bigint>>").alias("top_wikis")
    own = told(wikis, F.concat(F.lit("wiki:"), "wiki"), F.col("wiki"), *counts, none, *maps, listed_pages(F.col("pages"), F.col("wiki")).alias("top_pages"))
    pages = everything.select("window_start", "wiki", F.explode("pages").alias("p")).select("window_start", "wiki", (-F.col("p.down")).alias("event_count"), "p.*")
    item = F.struct("rank", "wiki", "down", "title", "last_change_type", "last_seen_at", "title_url")
    best = live.top_n(pages, ["window_start"], n, ("wiki", "title")).groupBy("window_start").agg(F.array_sort(F.collect_list(item)).alias("pages"), F.sum("event_count").alias("listed"))
    shots = global_of(everything, n).join(best, "window_start", "left")
    of_page = lambda p: listed_pages(F.array(F.struct(*[p[c].alias(c) for c in ("down", "title", "last_change_type", "last_seen_at", "title_url")])), p["wiki"])[0]
    listed = F.coalesce(F.transform("pages", of_page), F.array()).alias("top_pages")
    top = F.transform("top_wikis", lambda w: F.struct(w["wiki"].alias("wiki"), w["event_count"].alias("count"))).alias("top_wikis")
    out = told(shots, F.lit("global"), *counts, top, *maps, listed)
    sums = F.coalesce("listed", F.lit(0).cast("long")).alias("current_minute_events_so_far")
    return out.union(told(shots, F.lit("top_pages"), sums, listed)).union(own)


def with_bounds(snapshots: DataFrame, bounds: DataFrame) -> DataFrame:
    """Oldest and latest event time of a snapshot's window, or of all windows where it has none."""
    overall = bounds.where("window_start IS NULL").select(F.col("oldest_ms").alias("_o"), F.col("latest_ms").alias("_l"))
    own = bounds.where("window_start IS NOT NULL")
    joined = snapshots.join(own, "window_start", "left").join(F.broadcast(overall), F.lit(True), "left")
    return joined.withColumns({"oldest_ms": F.coalesce("oldest_ms", "_o"), "latest_ms": F.coalesce("latest_ms", "_l")}).drop("_o", "_l")


def required_wikis(events: DataFrame, wikis: DataFrame) -> DataFrame:
    return events.join(wikis.select("wiki").distinct(), "wiki", "left_semi")


def subscribed_wikis(subscriptions: DataFrame) -> DataFrame:
    topics = subscriptions.select(F.explode("topics").alias("topic")).where(S.topic_type(F.col("topic")) == "wiki")
    return topics.select(F.substring_index("topic", ":", -1).alias("wiki")).distinct()


def fan_out(snapshots: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """A row for each snapshot and each connection that subscribed to its topic, once. Spark sends the smaller side if it is small."""
    wanted = subscriptions.select("connection_id", F.explode(F.array_distinct("topics")).alias("topic"))
    return snapshots.join(wanted, "topic")


def chart_points(df: DataFrame, kind: str, n: int | None = None) -> DataFrame:
    """The largest points for a chart, with its usual number of them."""
    limits, keys = {"wikis": 10, "change_types": 8, "namespaces": 10, "pages": 15}, {"wikis": ["wiki"], "change_types": ["change_type"], "namespaces": ["namespace"], "pages": ["wiki", "title"]}
    return df.orderBy(F.col("event_count").desc(), *keys[kind]).limit(n or limits[kind])


#: Kinds of chart rows: the fields that name a row, and where a message has them.
CHARTS = {
    "wikis": (("wiki", "name"), ("$.data.top_wikis", "$.data.topWikis")),
    "change_types": (("change_type", "type", "name"), ("$.data.change_types", "$.data.changeTypes")),
    "namespaces": (("namespace", "name"), ("$.data.namespace_distribution", "$.data.namespaces")),
    "pages": (("title", "page"), ("$.data.top_pages", "$.data.topPages")),
}


def flatten_snapshot(messages: DataFrame, column: str = "message") -> DataFrame:
    """(topic, kind, key, value) chart rows of snapshot messages with maps or lists, under either field name; each message is read once."""
    get = lambda *paths: F.coalesce(*[F.get_json_object(column, p) for p in paths])

    def points(kind: str, key_fields: tuple[str, ...], paths: tuple[str, ...]) -> Column:
        text = get(*paths)
        row = lambda key, value: F.struct(F.lit(kind).alias("kind"), key.alias("key"), value.alias("value"))
        pairs = F.transform(F.map_entries(F.from_json(text, "map<string,bigint>")), lambda e: row(e["key"], e["value"]))
        item = "struct<" + ",".join(f"{k}:string" for k in (*key_fields, "count", "event_count", "value")) + ">"
        count = lambda e: F.coalesce(e["count"], e["event_count"], e["value"]).try_cast("bigint")
        listed = F.transform(F.from_json(text, f"array<{item}>"), lambda e: row(F.coalesce(*[e[k] for k in key_fields]), count(e)))
        return F.coalesce(F.when(F.trim(text).startswith("["), listed).otherwise(pairs), F.array())

    every = F.concat(*[points(kind, *where) for kind, where in CHARTS.items()])
    return messages.select(get("$.topic").alias("topic"), F.explode(every).alias("p")).select("topic", "p.kind", "p.key", "p.value")
