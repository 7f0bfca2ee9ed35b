"""From feed lines to envelopes; every step works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.sources.schemas import ENVELOPE, EVENT_TYPE, ID_PREFIX, RAW, SENT, SOURCE, SOURCE_TIMES


def ingest_raw_lines(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good with `raw` and `event`, bad with `raw`) of lines that start with data:; other lines are no events."""
    data = lines.where(F.col(column).startswith("data:")).select(F.trim(F.expr(f"substring(`{column}`, 6)")).alias("raw"))
    ok = is_object(F.col("raw"))
    return data.where(ok).withColumn("event", F.from_json("raw", RAW)), data.where(~ok).select("raw")


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object; a field of another type than declared is null, and spoils nothing else."""
    return F.coalesce(F.startswith(F.trim(text), F.lit("{")) & F.try_parse_json(text).isNotNull(), F.lit(False))


def decode_envelopes(df: DataFrame, column: str = "data") -> tuple[DataFrame, DataFrame]:
    """(envelopes, bad rows) of base64 JSON records."""
    texts = df.withColumn("_text", F.decode(F.expr(f"try_to_binary(`{column}`, 'base64')"), "UTF-8"))
    ok = is_object(F.col("_text"))
    return texts.where(ok).select(F.from_json("_text", SENT).alias("_e")).select("_e.*"), texts.where(~ok).drop("_text")


def event_id() -> Column:
    """The id that an event is sampled by and goes on under."""
    return F.concat(F.lit(ID_PREFIX), F.col("event.meta.id"))


def reason() -> Column:
    """Why a raw event is dropped, null if it isn't."""
    return (
        F.when(F.col("event.meta").isNull(), "missing_or_invalid_meta")
        .when(S.filled(F.col("event.meta.id")).isNull(), "missing_meta_id")
        .when(S.filled(F.col("event.meta.dt")).isNull(), "missing_meta_dt")
    )


def classify_raw(events: DataFrame) -> DataFrame:
    return events.withColumn("reason", reason())


def is_canary() -> Column:
    return F.coalesce(F.lower("event.meta.domain") == "canary", F.lit(False))


def drop_canary(events: DataFrame) -> DataFrame:
    return events.where(~is_canary())


def hash_sample(df: DataFrame, key: str, rate: float) -> DataFrame:
    return df.where(S.sampled(F.col(key), rate))


def normalize(events: DataFrame, source: str = SOURCE) -> DataFrame:
    """Envelopes of valid raw events."""
    e = lambda path: F.col(f"event.{path}")
    payload = {
        "wikimedia_recentchange_id": e("id"), "id": e("id"), "wiki": F.lower(e("wiki")), "domain": e("meta.domain"), "stream": e("meta.stream"),
        "request_id": e("meta.request_id"), "topic": e("meta.topic"), "partition": e("meta.partition"), "offset": e("meta.offset"),
        "change_type": e("type"), "namespace": e("namespace"), "title": e("title"), "title_url": e("title_url"), "user": e("user"),
        "user_is_bot": e("bot"), "is_minor": e("minor"), "is_patrolled": e("patrolled"), "comment": e("comment"), "parsedcomment": e("parsedcomment"),
        "source_timestamp": e("timestamp"), "old_length": e("length.old"), "new_length": e("length.new"), "delta_bytes": S.delta(e("length.new"), e("length.old")),
        "revision_old": e("revision.old"), "revision_new": e("revision.new"), "change_url": S.first_filled(e("notify_url"), e("title_url"), e("meta.uri")),
        "raw_notify_url": e("notify_url"), "server_url": e("server_url"), "server_name": e("server_name"), "server_script_path": e("server_script_path"),
        "log_type": e("log_type"), "log_action": e("log_action"), "log_params": e("log_params"),
    }
    types = {f.name: f.dataType for f in ENVELOPE["payload"].dataType}
    return events.select(
        event_id().alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.lit("1.0").alias("event_version"),
        F.lit(source).alias("source"),
        e("meta.dt").alias("occurred_at"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ingested_at"),
        F.expr("uuid()").alias("correlation_id"),
        F.struct(*[payload.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()]).alias("payload"),
        F.col("event").alias("raw_event"),
    )


def accepted(events: DataFrame, rate: float = 1.0) -> DataFrame:
    """Adds status: what becomes of each parsed line."""
    return events.withColumn(
        "status", F.when(reason().isNotNull(), "invalid").when(is_canary(), "canary").when(~S.sampled(event_id(), rate), "sampled_out").otherwise("kept")
    )


def is_page_change() -> Column:
    return F.coalesce((F.col("event_type") == EVENT_TYPE) & F.col("payload").isNotNull(), F.lit(False))


def source_millis(envelopes: DataFrame) -> Column:
    """The source's time: of envelope, then payload, the exact field before the other; null where a frame has none."""
    payload = envelopes.schema["payload"].dataType.names
    places = [(n, t) for t in SOURCE_TIMES for n in (t, f"payload.{t}") if t in (envelopes.columns if n == t else payload)]
    return S.parse_millis(*[F.col(n) for n, _ in places]) if places else F.lit(None).cast("bigint")


def to_live_event(envelopes: DataFrame) -> DataFrame:
    """Events for live counters, with defaults for what is missing; a time that can't be read is now, and without an id there is no event."""
    p = lambda name: F.col(f"payload.{name}")
    at = F.coalesce(S.parse_time(F.col("occurred_at")), F.current_timestamp())
    out = envelopes.where(is_page_change() & (F.col("event_id") != "")).select(
        "event_id", at.alias("occurred_at"), S.key_safe(p("wiki")).alias("wiki"), S.key_safe(p("change_type")).alias("change_type"),
        S.key_safe(p("namespace")).alias("namespace"), S.safe_string(p("title")).alias("title"), S.safe_string(p("title_url"), None).alias("title_url"),
        S.bot_flag(p("user_is_bot"), p("bot")).alias("user_is_bot"), S.filled(p("log_type")).alias("log_type"),
        F.coalesce(source_millis(envelopes), F.unix_millis(at)).alias("source_ms"),
    )
    return out


def observed_live_events(records: DataFrame, name: str = "funnel", column: str = "data") -> DataFrame:
    """Live events of base64 JSON records; how many records came, were decoded, were valid and were skipped is observed under the name, in the same pass."""
    text = F.decode(F.expr(f"try_to_binary(`{column}`, 'base64')"), "UTF-8")
    rows = records.select(F.when(is_object(text), F.from_json(text, SENT)).alias("_e"))
    valid = F.coalesce((F.col("_e.event_type") == EVENT_TYPE) & F.col("_e.payload").isNotNull() & (F.col("_e.event_id") != ""), F.lit(False))
    counts = {"input_records": F.count(F.lit(1)), "decoded_count": F.count_if(F.col("_e").isNotNull()), "valid_count": F.count_if(valid), "skipped_count": F.count_if(~valid)}
    observed = rows.observe(name, *[c.alias(k) for k, c in counts.items()])
    return to_live_event(observed.where("_e IS NOT NULL").select("_e.*"))


def to_alert_event(envelopes: DataFrame) -> DataFrame:
    """Events for alert series: lower case, nothing without id, time or wiki."""
    p = lambda name: F.lower(S.filled(F.col(f"payload.{name}")))
    out = envelopes.where(is_page_change()).select(
        S.filled(F.col("event_id")).alias("event_id"), S.parse_time(F.col("occurred_at")).alias("occurred_at"), p("wiki").alias("wiki"),
        F.coalesce(p("change_type"), F.lit("unknown")).alias("change_type"), p("log_type").alias("log_type"), p("log_action").alias("log_action"),
        S.bot_flag(F.col("payload.user_is_bot"), F.col("payload.bot")).alias("user_is_bot"),
    )
    return out.dropna(subset=["event_id", "occurred_at", "wiki"])
