"""Alert series, rolling z-scores and moderation bursts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.sources.schemas import MODERATION_ALERT, SPIKE_ALERTS


#: Events of a bucket, and deletions and blocks of five, that an alert takes at least.
LEAST_EVENTS = {"global": 50, "wiki": 30}
LEAST_MODERATION = {"delete": 5, "block": 3}


def alert_series(events: DataFrame, bucket: str = "1 minute", with_time: bool = False) -> DataFrame:
    """Four counters by series (global, wiki:<w>, log_type:<t> of log events) and bucket, from one scan; with_time adds `at`, the bucket's last instant, for a further stateful step."""
    is_log = F.col("change_type") == "log"
    rows = events.select(F.explode(series_of()).alias("series"), F.window("occurred_at", bucket).alias("w"), "change_type", "log_type")
    return rows.groupBy("series", "w").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if(is_log).alias("log_count"),
        F.count_if(is_log & (F.col("log_type") == "delete")).alias("delete_count"), F.count_if(is_log & (F.col("log_type") == "block")).alias("block_count"),
    ).select(*([F.window_time("w").alias("at")] if with_time else []), "series", F.col("w.start").alias("bucket"), "event_count", "log_count", "delete_count", "block_count")


def series_of() -> Column:
    """The names of the series that an event counts in."""
    moderation = F.when((F.col("change_type") == "log") & F.col("log_type").isin("delete", "block"), F.concat(F.lit("log_type:"), F.col("log_type")))
    return F.array_compact(F.array(F.lit("global"), F.concat(F.lit("wiki:"), F.col("wiki")), moderation))


def touched_series(events: DataFrame) -> DataFrame:
    return events.select(F.explode(series_of()).alias("series")).distinct()


def zscores(series: DataFrame, bucket_seconds: int = 60, window_len: int = 30) -> DataFrame:
    """Adds n, mean, deviation and z against the buckets that exist among the previous window_len."""
    numbered = series.withColumn("_k", S.bucket_number(F.col("bucket"), bucket_seconds))
    past = Window.partitionBy("series").orderBy("_k").rangeBetween(-window_len, -1)
    x = F.col("event_count")
    scored = numbered.withColumns({"n": F.count(x).over(past), "mean": F.avg(x).over(past), "deviation": F.stddev_pop(x).over(past)})
    guarded = F.when(F.col("deviation") >= 1, F.col("deviation")).otherwise(F.greatest(F.lit(1.0), F.col("mean") * 0.1))
    return scored.withColumn("z", (x - F.col("mean")) / guarded).drop("_k")


def baseline(series: DataFrame, bucket_seconds: int = 60, window_len: int = 30) -> DataFrame:
    return zscores(series, bucket_seconds, window_len).select("series", "bucket", "event_count", "n", "mean", "deviation")


def alert_zscore(
    series: DataFrame,
    bucket_seconds: int = 60,
    window_len: int = 30,
    min_points: int = 10,
    z: float | dict[str, float] = 2.0,
    min_count: dict[str, int] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Volume alerts of the global and wiki series: z above the limit, strictly, and enough events; z is one limit, or one for each kind of series."""
    least = LEAST_EVENTS if min_count is None else min_count
    limits = z if isinstance(z, dict) else dict.fromkeys(SPIKE_ALERTS, z)
    kind = F.substring_index("series", ":", 1)
    need = F.when(kind == "global", least.get("global", 0)).otherwise(least.get("wiki", 0))
    limit = F.when(kind == "global", float(limits["global"])).otherwise(float(limits["wiki"]))
    rows = zscores(series.where(kind.isin("global", "wiki")), bucket_seconds, window_len)
    if as_of is not None:
        rows = rows.where(F.col("bucket") == as_of)
    hit = rows.where((F.col("n") >= min_points) & (F.col("z") > limit) & (F.col("event_count") >= need))
    alert_type = F.when(kind == "global", SPIKE_ALERTS["global"]).otherwise(SPIKE_ALERTS["wiki"])
    return hit.select("series", "bucket", alert_type.alias("alert_type"), F.col("event_count").alias("current_count"), F.round("mean", 4).alias("baseline_avg"),
                      F.round("deviation", 4).alias("baseline_stddev"), F.round("z", 4).alias("z_score"), limit.alias("threshold"))


def dense_spine(series: DataFrame, bucket_seconds: int = 60) -> DataFrame:
    """Every bucket from each series' first to last, with 0 where it has none."""
    numbered = series.withColumn("k", S.bucket_number(F.col("bucket"), bucket_seconds))
    spine = numbered.groupBy("series").agg(F.min("k").alias("a"), F.max("k").alias("b")).select("series", F.explode(F.sequence("a", "b")).alias("k"))
    joined = spine.join(numbered.select("series", "k", "event_count"), ["series", "k"], "left")
    return joined.select("series", "k", F.timestamp_seconds(F.col("k") * bucket_seconds).alias("bucket"), F.coalesce("event_count", F.lit(0)).alias("event_count"))


def moderation_burst(
    series: DataFrame,
    bucket_seconds: int = 60,
    span: int = 5,
    groups: int = 6,
    min_groups: int = 3,
    ratio: float = 3.0,
    min_count: dict[str, int] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Bursts of deletions or blocks: the last span buckets against the mean of the earlier spans that aren't empty."""
    least = LEAST_MODERATION if min_count is None else min_count
    rows = dense_spine(series.where(F.col("series").startswith("log_type:")), bucket_seconds)
    by = Window.partitionBy("series").orderBy("k")
    total = lambda a, b: F.coalesce(F.sum("event_count").over(by.rangeBetween(a, b)), F.lit(0))
    earlier = F.array(*[total(-span * (g + 1) + 1, -span * g) for g in range(groups, 0, -1)])
    rows = rows.withColumns({"current": total(-span + 1, 0), "groups": earlier}).withColumn("groups", F.filter("groups", lambda x: x > 0))
    mean = F.aggregate("groups", F.lit(0).cast("bigint"), lambda a, x: a + x) / F.size("groups")
    rows = rows.where((F.size("groups") >= min_groups) & (F.col("current") > 0)).withColumn("mean", mean)
    rows = rows.withColumn("ratio", F.col("current") / F.greatest("mean", F.lit(1.0)))
    if as_of is not None:
        rows = rows.where(F.col("bucket") == as_of)
    need = F.when(F.col("series") == "log_type:delete", least["delete"]).otherwise(least["block"])
    hit = rows.where((F.col("ratio") > ratio) & (F.col("current") >= need))
    return hit.select("series", "bucket", F.lit(MODERATION_ALERT).alias("alert_type"), F.col("current").alias("current_count"), F.round("mean", 4).alias("baseline_avg"),
                      F.round("ratio", 4).alias("burst_ratio"), F.lit(float(ratio)).alias("threshold_ratio"))


def all_alerts(volume: DataFrame, bursts: DataFrame) -> DataFrame:
    """Volume alerts and moderation bursts as rows of one kind; what the other kind has is null."""
    return volume.unionByName(bursts, allowMissingColumns=True)


def alert_messages(found: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The messages that subscribers of alerts read, one for each row of all_alerts."""
    return found.select(*message_fields(found, created_at))


def message_fields(found: DataFrame, created_at: Column | None = None) -> list[Column]:
    """The fields of an alert's message; those that its kind doesn't have are null, which JSON leaves out."""
    now = F.current_timestamp() if created_at is None else created_at
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind, name = F.substring_index("series", ":", 1), F.expr("substr(series, instr(series, ':') + 1)")
    burst = F.col("alert_type") == MODERATION_ALERT
    key = F.when(kind == "global", "ALERT#GLOBAL").otherwise(F.concat(F.lit("ALERT#"), F.upper(kind), F.lit("#"), name))
    number = lambda c: F.col(c) if c in found.columns else F.lit(None).cast("double").alias(c)
    return [
        F.lit("realtime.alert.triggered").alias("message_type"), F.col("alert_type"), F.lit("warning").alias("severity"),
        F.when(kind == "wiki", name).alias("wiki"), F.when(kind == "log_type", name).alias("log_type"),
        key.alias("alert_key"), F.concat(F.lit("WINDOW#"), iso("bucket")).alias("window_key"), iso("bucket").alias("window_start"),
        F.when(~burst, F.col("current_count")).alias("current_count"), F.when(~burst, F.col("baseline_avg")).alias("baseline_avg"),
        *map(number, ("baseline_stddev", "z_score", "threshold")),
        F.when(burst, F.col("current_count")).alias("current_5m_count"), F.when(burst, F.col("baseline_avg")).alias("baseline_5m_avg"),
        *map(number, ("burst_ratio", "threshold_ratio")), iso(now).alias("created_at"),
    ]


def alert_candidates(series: DataFrame, max_wikis: int | None = None) -> DataFrame:
    """Series to evaluate in each bucket: all, or only the first so many wikis by name."""
    if max_wikis is None:
        return series.select("bucket", "series")
    is_wiki = F.col("series").startswith("wiki:")
    order = Window.partitionBy("bucket", is_wiki).orderBy("series")
    return series.withColumn("_r", F.row_number().over(order)).where(~is_wiki | (F.col("_r") <= max_wikis)).select("bucket", "series")


def new_alerts(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Alerts whose series and bucket aren't in the log, whatever their status there."""
    return candidates.join(log.select("series", "bucket"), ["series", "bucket"], "left_anti")


def publish_once(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """New alerts as SENT log rows, one for each series and bucket."""
    return new_alerts(candidates, log).dropDuplicates(["series", "bucket"]).withColumn("status", F.lit("SENT"))


def reserved(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """New alerts as PUBLISHING rows: whatever becomes of them, nobody else publishes them from now on."""
    return publish_once(candidates, log).withColumn("status", F.lit("PUBLISHING"))


def settled(reservations: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Reservations by what became of them: SENT, FAILED with the start of its error, or PUBLISHING still where outcomes (series, bucket, error) have no row."""
    known = outcomes.groupBy("series", "bucket").agg(F.count(F.lit(1)).alias("_n"), F.max("error").alias("_error"))
    joined = reservations.join(known, ["series", "bucket"], "left")
    status = F.when(F.col("_n").isNull(), "PUBLISHING").when(F.col("_error").isNull(), "SENT").otherwise("FAILED")
    return joined.withColumns({"status": status, "alert_error": F.substring("_error", 1, 500)}).drop("_n", "_error")


def latest_states(log: DataFrame) -> DataFrame:
    """The last state of each alert, from a log of all states: a final one comes after its reservation."""
    final = F.struct(F.col("status") != "PUBLISHING", "status", "alert_error")
    last = log.groupBy("series", "bucket").agg(F.max(final).alias("s"))
    return last.select("series", "bucket", "s.status", "s.alert_error")
