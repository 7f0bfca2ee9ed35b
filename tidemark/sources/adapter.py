"""The given tables seen as this engine's own: events as page changes, conversations as subscription actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import NAMESPACES

EVENTS = """
SELECT concat('wikimedia-', event_id) AS event_id, {ts} AS occurred_at,
  concat('w', lpad(cast(user_id % 12 AS {text}), 2, '0'), 'wiki') AS wiki,
  CASE event_type WHEN 'click' THEN 'edit' WHEN 'view' THEN 'categorize' WHEN 'signup' THEN 'new' WHEN 'error' THEN 'log' ELSE 'external' END AS change_type,
  {namespaces}[cast({json}(props, '$.k') AS int) % 8 + {base}] AS namespace,
  concat('Page_', {json}(props, '$.k')) AS title, concat('https://w.example.org/', event_id) AS title_url, user_id % 5 = 0 AS user_is_bot,
  CASE WHEN event_type IN ('error', 'signup') THEN CASE WHEN user_id % 2 = 0 THEN 'delete' ELSE 'block' END END AS log_type,
  cast(floor(value) AS bigint) AS new_length
FROM events"""
DUCK_EVENTS = EVENTS.format(ts="ts", text="varchar", namespaces=f"({list(NAMESPACES)})", json="json_extract_string", base=1)
SPARK_EVENTS = EVENTS.format(ts="cast(ts AS timestamp)", text="string", namespaces=f"array{NAMESPACES}", json="get_json_object", base=0).replace("FROM events", "FROM {events}")
ACTIONS = """
SELECT conv_id AS connection_id, turn AS seq, CASE WHEN length(text) % 3 = 0 THEN 'unsubscribe' ELSE 'subscribe' END AS action,
  CASE turn % 5 WHEN 0 THEN 'global' WHEN 1 THEN 'top_pages' WHEN 2 THEN 'wiki:w00wiki' WHEN 3 THEN 'wiki:w01wiki' ELSE 'BAD TOPIC' END AS topic
FROM conversations"""


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the shape of silver rows; times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(SPARK_EVENTS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def subscription_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ACTIONS.replace("FROM conversations", "FROM {conversations}"), conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone and dates as text, so that they read alike in any engine."""
    to = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.select(*[F.col(n).cast(to[t]).alias(n) if t in to else F.col(n) for n, t in df.dtypes])
