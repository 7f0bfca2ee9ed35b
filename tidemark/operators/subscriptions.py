"""Subscriptions folded from the log of connection actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def active_subscriptions(subscriptions: DataFrame, now: Column) -> DataFrame:
    """Rows with an id that haven't expired; ttl is in epoch seconds."""
    return subscriptions.where(S.filled(F.col("connection_id")).isNotNull() & (F.col("ttl").isNull() | (F.col("ttl") >= F.unix_timestamp(now))))


def subscription_state(actions: DataFrame, as_of: Column | None = None, ttl_seconds: int = 7200) -> DataFrame:
    """(connection_id, topic) after all actions: the last one for each topic since the last connect, and global always.

    actions: connection_id, seq, action (connect, subscribe, unsubscribe,
    disconnect), topic; with as_of, an `at` column expires connections.
    """
    marks = actions.groupBy("connection_id").agg(
        F.max(F.when(F.col("action") == "connect", F.col("seq"))).alias("since"), F.max_by("action", "seq").alias("last"), *([F.max("at").alias("seen")] if as_of is not None else [])
    )
    marks = marks.where(F.col("last") != "disconnect")
    if as_of is not None:
        marks = marks.where(F.unix_timestamp(as_of) - F.unix_timestamp("seen") <= ttl_seconds)
    changes = actions.where(F.col("action").isin("subscribe", "unsubscribe") & S.valid_topic(F.col("topic"))).join(marks.select("connection_id", "since"), "connection_id")
    changes = changes.where(F.col("since").isNull() | (F.col("seq") > F.col("since")))
    final = changes.groupBy("connection_id", "topic").agg(F.max_by("action", "seq").alias("action")).where("action = 'subscribe'")
    # a connection's own topics and global, in one row of its; no union of two sides that are dealt alike
    held = marks.join(final.groupBy("connection_id").agg(F.collect_set("topic").alias("topics")), "connection_id", "left")
    topics = F.array_union(F.array(F.lit("global")), F.coalesce("topics", F.array().cast("array<string>")))
    return held.select("connection_id", F.explode(topics).alias("topic"))


def subscription_table(state: DataFrame) -> DataFrame:
    return state.groupBy("connection_id").agg(F.array_sort(F.collect_set("topic")).alias("topics"))


def remove_gone(subscriptions: DataFrame, gone: DataFrame) -> DataFrame:
    return subscriptions.join(gone.select("connection_id"), "connection_id", "left_anti")
