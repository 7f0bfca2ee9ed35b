"""Hourly aggregates of silver rows. Each groups by hour, so one call covers any range of hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.sources.schemas import CHANGE_TYPES

COLUMNS = ("event_id", "occurred_at", "wiki", "change_type", "namespace", "title", "user_is_bot")


def hour() -> Column:
    return F.date_trunc("hour", F.col("occurred_at"))


def gold_base(silver: DataFrame) -> DataFrame:
    """Rows with all required fields, pruned to what the aggregates read, with their hour and date."""
    kept = silver.dropna(subset=["event_id", "occurred_at", "wiki", "change_type", "namespace"])
    kept = kept.select(*COLUMNS[:-1], F.coalesce("user_is_bot", F.lit(False)).alias("user_is_bot"))
    return kept.withColumns({"metric_date": F.to_date("occurred_at"), "metric_hour": hour()})


def n_events() -> Column:
    return F.count(F.lit(1)).alias("event_count")


def bots(flag: bool = True) -> Column:
    test = F.col("user_is_bot") if flag else ~F.col("user_is_bot")
    return F.count_if(test).alias("bot_event_count" if flag else "human_event_count")


def span() -> tuple[Column, Column]:
    return F.min("occurred_at").alias("first_event_at"), F.max("occurred_at").alias("last_event_at")


def gold_wiki_activity_by_hour(base: DataFrame) -> DataFrame:
    return base.groupBy("metric_date", "metric_hour", "wiki").agg(n_events(), bots(), bots(False), F.count_distinct("title").alias("distinct_titles"), *span())


def by_hour(base: DataFrame, key: str) -> DataFrame:
    return base.groupBy("metric_date", "metric_hour", key).agg(n_events(), *span())


def gold_change_type_by_hour(base: DataFrame) -> DataFrame:
    return by_hour(base, "change_type")


def gold_bot_activity_by_hour(base: DataFrame) -> DataFrame:
    return by_hour(base, "user_is_bot")


def gold_namespace_activity_by_hour(base: DataFrame) -> DataFrame:
    return by_hour(base, "namespace")


def gold_top_pages_by_hour(base: DataFrame, limit: int = 100) -> DataFrame:
    """Ranks within each hour; the rank filter becomes a group limit before the shuffle."""
    pages = base.where(F.col("title").isNotNull()).groupBy("metric_date", "metric_hour", "wiki", "namespace", "title").agg(n_events(), bots(), bots(False), *span())
    order = Window.partitionBy("metric_hour").orderBy(F.col("event_count").desc(), "wiki", "namespace", "title")
    return pages.withColumn("page_rank", F.row_number().over(order)).where(F.col("page_rank") <= limit)


GOLD = {
    "wiki_activity_by_hour": gold_wiki_activity_by_hour,
    "change_type_by_hour": gold_change_type_by_hour,
    "bot_activity_by_hour": gold_bot_activity_by_hour,
    "namespace_activity_by_hour": gold_namespace_activity_by_hour,
    "top_pages_by_hour": gold_top_pages_by_hour,
}


def top_wikis_by_hour(silver: DataFrame) -> DataFrame:
    types = [F.count_if(F.col("change_type") == t).alias(f"{t}_count") for t in CHANGE_TYPES]
    counts = (F.count_if("user_is_bot").alias("bot_count"), F.count_if(~F.col("user_is_bot")).alias("human_count"))
    return silver.groupBy(hour().alias("hour"), "wiki").agg(n_events(), *counts, *types)


def bot_vs_human_by_hour(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy(hour().alias("hour")).agg(F.count_if("user_is_bot").alias("bot_count"), F.count_if(~F.col("user_is_bot")).alias("human_count"))
    total = F.col("bot_count") + F.col("human_count")
    return counts.withColumns({"total_count": total, "bot_ratio": S.bot_ratio(F.col("bot_count"), F.col("human_count"))})


def top_pages_by_day(silver: DataFrame) -> DataFrame:
    """Articles by day, with the type of their last change; ties by event id."""
    articles = silver.where((F.col("namespace") == 0) & F.col("title").isNotNull())
    return articles.groupBy(F.to_date("occurred_at").alias("day"), "wiki", "title").agg(
        n_events(), F.max_by("change_type", F.struct("occurred_at", "event_id")).alias("last_change_type"), F.max("occurred_at").alias("last_seen_at")
    )


def change_type_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy(hour().alias("hour"), "change_type").agg(n_events())


def activity_spikes(silver: DataFrame, window_hours: int = 30, min_points: int = 10, z: float = 2.0) -> DataFrame:
    """Hourly z-scores by wiki and overall ('*')."""
    from tidemark.operators.alerts import zscores

    named = silver.select(hour().alias("hour"), F.explode(F.array("wiki", F.lit("*"))).alias("series"))
    counts = named.groupBy("hour", "series").agg(n_events())
    scored = zscores(counts.withColumn("bucket", F.col("hour")), 3600, window_hours)
    return scored.where(F.col("n") >= min_points).select("hour", F.col("series").alias("wiki"), "event_count", S.round4(F.col("z")).alias("z_score"), (F.col("z") > z).alias("is_spike"))
