"""Declared schemas: no inference pass, missing fields are null."""

from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

KINDS = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "boolean": BooleanType(), "timestamp": TimestampType(), "date": DateType()}


def flat(columns: str, **nested: StructType) -> StructType:
    """Columns as `name type` pairs, then nested ones; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(n, KINDS[k]) for n, k in pairs] + [StructField(n, k) for n, k in nested.items()])


META = flat("uri string, request_id string, id string, domain string, stream string, dt string, topic string, partition int, offset bigint")
CHANGE = flat("old bigint, new bigint")
RAW = flat(
    "id bigint, type string, namespace int, title string, title_url string, comment string, timestamp bigint, user string,"
    " bot boolean, notify_url string, minor boolean, patrolled boolean,"
    " server_url string, server_name string, server_script_path string, wiki string, parsedcomment string, log_id bigint, log_type string,"
    " log_action string, log_params string, log_action_comment string",
    meta=META,
    length=CHANGE,
    revision=CHANGE,
)
PAYLOAD = flat(
    "wikimedia_recentchange_id bigint, id bigint, wiki string, domain string, stream string, request_id string, topic string, partition int, offset bigint,"
    " change_type string, namespace string, title string, title_url string, user string, user_is_bot string, bot string, is_minor string, minor string,"
    " is_patrolled string, patrolled string, comment string, parsedcomment string, source_timestamp bigint, old_length bigint, new_length bigint,"
    " delta_bytes bigint, length_old bigint, length_new bigint, length_delta bigint, revision_old bigint, revision_new bigint, change_url string,"
    " raw_notify_url string, server_url string, server_name string, server_script_path string, log_type string, log_action string, log_params string"
)
HEADER = "event_id string, event_type string, event_version string, source string, occurred_at string, ingested_at string, correlation_id string"
ENVELOPE = flat(HEADER, payload=PAYLOAD, raw_event=RAW)
#: Times of the source in milliseconds that a later collector may send, in the envelope or its payload.
SOURCE_TIMES = ("source_event_timestamp_ms", "event_timestamp_ms")
SENT = StructType(
    [f for f in ENVELOPE.fields if f.name != "payload"] + [StructField("payload", StructType(PAYLOAD.fields + [StructField(t, StringType()) for t in SOURCE_TIMES]))]
    + [StructField(t, StringType()) for t in SOURCE_TIMES]
)
PARTS = ("year", "month", "day", "hour")
BRONZE = StructType(ENVELOPE.fields + [StructField(p, StringType()) for p in PARTS])
SILVER = flat(
    "event_id string, occurred_at timestamp, ingestion_date date, wiki string, domain string, change_type string, namespace int, title string,"
    " title_url string, user string, user_is_bot boolean, is_minor boolean, is_patrolled boolean, old_length bigint, new_length bigint,"
    " delta_bytes bigint, revision_old bigint, revision_new bigint, change_url string, raw_notify_url string, log_type string, log_action string,"
    " log_params string, wikimedia_rcid bigint"
)
_HOUR, _SPAN = "metric_date date, metric_hour timestamp, ", "first_event_at timestamp, last_event_at timestamp"
_BOTS = "event_count bigint, bot_event_count bigint, human_event_count bigint, "
GOLD_SCHEMAS = {
    "wiki_activity_by_hour": flat(_HOUR + "wiki string, " + _BOTS + "distinct_titles bigint, " + _SPAN),
    "change_type_by_hour": flat(_HOUR + "change_type string, event_count bigint, " + _SPAN),
    "bot_activity_by_hour": flat(_HOUR + "user_is_bot boolean, event_count bigint, " + _SPAN),
    "namespace_activity_by_hour": flat(_HOUR + "namespace int, event_count bigint, " + _SPAN),
    "top_pages_by_hour": flat(_HOUR + "page_rank int, wiki string, namespace int, title string, " + _BOTS + _SPAN),
}
EVENT_TYPE = "wiki.recentchange"
#: Fixed values of the feed and of its alerts.
ID_PREFIX, SOURCE = "wikimedia-", "wikimedia.eventstreams"
CHANGE_TYPES = ("edit", "new", "categorize", "log", "external")
SPIKE_ALERTS = {"global": "GLOBAL_ACTIVITY_SPIKE", "wiki": "WIKI_ACTIVITY_SPIKE"}
MODERATION_ALERT = "MODERATION_BURST"
NAMESPACES = (-1, 0, 1, 2, 4, 6, 10, 14)
