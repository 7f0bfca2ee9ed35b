"""One-minute live counters: all families in one pass, in batch or in an update-mode stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Family -> the columns it groups by besides the window.
FAMILIES: dict[str, tuple[str, ...]] = {
    "global_activity": (),
    "wiki_activity": ("wiki",),
    "change_type": ("change_type",),
    "wiki_change_type": ("wiki", "change_type"),
    "bot_activity": ("is_bot",),
    "wiki_bot_activity": ("wiki", "is_bot"),
    "namespace": ("namespace",),
    "wiki_namespace": ("wiki", "namespace"),
}
DIMENSIONS = ("wiki", "change_type", "is_bot", "namespace")


def windowed(events: DataFrame, window: str = "1 minute") -> DataFrame:
    return events.select(F.window("occurred_at", window).alias("w"), "wiki", "change_type", F.col("user_is_bot").alias("is_bot"), F.col("namespace").cast("string").alias("namespace"))


def live_counts(events: DataFrame, window: str = "1 minute", families: tuple[str, ...] = tuple(FAMILIES)) -> DataFrame:
    """(family, window_start, dimensions, event_count): GROUPING SETS over one scan, partial counts before the shuffle."""
    sets = [("w", *FAMILIES[f]) for f in families]
    rows = windowed(events, window)
    marks = F.struct(*[F.grouping(d).alias(d) for d in DIMENSIONS])
    keys = [tuple(int(d not in FAMILIES[f]) for d in DIMENSIONS) for f in families]
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], "w", *DIMENSIONS).agg(F.count(F.lit(1)).alias("event_count"), marks.alias("_marks"))
    family = None
    for f, key in zip(families, keys, strict=True):
        test = F.lit(True)
        for d, k in zip(DIMENSIONS, key, strict=True):
            test = test & (F.col(f"_marks.{d}") == k)
        family = F.when(test, f) if family is None else family.when(test, f)
    return counted.select(family.alias("family"), F.col("w.start").alias("window_start"), *DIMENSIONS, "event_count")


def family(events: DataFrame, name: str, window: str = "1 minute") -> DataFrame:
    return live_counts(events, window, (name,)).select("window_start", *FAMILIES[name], "event_count")


def live_top_pages_counts(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Articles by window, with the attributes of their last event; ties by event id."""
    articles = events.where((F.col("namespace").try_cast("int") == 0) & F.col("title").isNotNull() & F.col("wiki").isNotNull())
    url = F.col("title_url") if "title_url" in events.columns else F.lit(None).cast("string")
    return articles.groupBy(F.window("occurred_at", window).alias("w"), "wiki", "title").agg(
        F.count(F.lit(1)).alias("event_count"), F.max_by("change_type", F.struct("occurred_at", "event_id")).alias("last_change_type"), F.max("occurred_at").alias("last_seen_at"), F.max_by(url, F.struct("occurred_at", "event_id")).alias("title_url"),
    ).select(F.col("w.start").alias("window_start"), "wiki", "title", "event_count", "last_change_type", "last_seen_at", "title_url")


def event_ms(events: DataFrame) -> Column:
    """An event's own time in milliseconds: that of its source, where the rows carry it."""
    at = F.unix_millis("occurred_at")
    return F.coalesce("source_ms", at) if "source_ms" in events.columns else at


def live_event_bounds(events: DataFrame, window: str = "1 minute") -> DataFrame:
    """Oldest and latest event time by window, and overall with a null window."""
    ms = event_ms(events)
    per = events.groupBy(F.window("occurred_at", window).start.alias("window_start")).agg(F.min(ms).alias("oldest_ms"), F.max(ms).alias("latest_ms"))
    return per.rollup("window_start").agg(F.min("oldest_ms").alias("oldest_ms"), F.max("latest_ms").alias("latest_ms"))


def top_n(counts: DataFrame, by: list[str], n: int = 10, ties: tuple[str, ...] = ("wiki",)) -> DataFrame:
    """The n largest of each group, ranked; the filter on the rank is pushed below the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col("event_count").desc(), *ties)
    return counts.where("event_count > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def live_top_wikis(events: DataFrame, window: str = "1 minute", n: int = 10) -> DataFrame:
    return top_n(family(events, "wiki_activity", window), ["window_start"], n)


def live_top_pages(events: DataFrame, window: str = "1 minute", n: int = 10) -> DataFrame:
    return top_n(live_top_pages_counts(events, window), ["window_start"], n, ("wiki", "title"))


def live_wiki_top_pages(events: DataFrame, window: str = "1 minute", n: int = 10) -> DataFrame:
    return top_n(live_top_pages_counts(events, window), ["window_start", "wiki"], n, ("title",))


def touched_windows(events: DataFrame, window: str = "1 minute") -> DataFrame:
    return events.select(F.window("occurred_at", window).start.alias("window_start")).distinct()
