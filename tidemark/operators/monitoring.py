"""Latency histograms and funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import scalars as S

#: Edges in milliseconds from event to dashboard.
EDGES_MS = (0, 1000, 2000, 3000, 4000, 5000, 6000, 7500, 10000, 12500, 15000, 20000, 30000, 45000, 60000, 90000, 120000)
STATUSES = ("received", "parse_failed", "invalid", "canary", "sampled_out", "kept")


def upper_edge(ms: Column, edges_ms: tuple[int, ...] = EDGES_MS) -> Column:
    """The least edge that is no less; null beyond the last."""
    return F.coalesce(*[F.when(ms <= e, F.lit(e).cast("long")) for e in edges_ms])


def latency_histogram(df: DataFrame, start_ms: str, end_ms: str, label: str, edges_ms: tuple[int, ...] = EDGES_MS) -> DataFrame:
    """(label, upper edge, count, min, max); negative latencies are skipped, the last edge is null for what lies beyond."""
    rows = df.select(F.col(label).alias("label"), (F.col(end_ms) - F.col(start_ms)).alias("ms")).where("ms >= 0")
    return rows.groupBy("label", upper_edge(F.col("ms"), edges_ms).alias("le_ms")).agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"))


def delivery_latency(deliveries: DataFrame, edges_ms: tuple[int, ...] = EDGES_MS) -> DataFrame:
    """(label, measure, upper edge, count, min, max) of deliveries (topic, status, posted_ms, latest_ms, oldest_ms), in batch or in an update-mode stream.

    label is the type of topic; measure says from which of a snapshot's events
    time is taken, its latest or its oldest.  Only what was sent counts.
    """
    sent = deliveries.where("status = 'sent' AND posted_ms > 0")
    since = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), (F.col("posted_ms") - F.col(f"{m}_ms")).alias("ms")) for m in ("latest", "oldest")]))
    rows = sent.select(S.topic_type(F.col("topic")).alias("label"), since.alias("x")).select("label", "x.*").where("ms >= 0")
    return rows.groupBy("label", "measure", upper_edge(F.col("ms"), edges_ms).alias("le_ms")).agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"))


def delivered(events: DataFrame, failed: DataFrame) -> DataFrame:
    return events.join(failed.select("event_id"), "event_id", "left_anti")


def ingest_funnel(statuses: DataFrame, status_col: str = "status") -> DataFrame:
    """One row of counts by status; received is all rows."""
    counts = [F.count_if(F.col(status_col) == s).alias(s) for s in STATUSES[1:]]
    return statuses.agg(F.count(F.lit(1)).alias("received"), *counts)


def with_observation(df: DataFrame, name: str, **expressions: Column) -> tuple[DataFrame, Observation]:
    """Counts in the same pass as the job itself."""
    seen = Observation(name)
    return df.observe(seen, *[e.alias(k) for k, e in expressions.items()]), seen
