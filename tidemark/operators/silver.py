"""Bronze envelopes to typed silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import scalars as S
from tidemark.sources.schemas import SILVER

REQUIRED = ("occurred_at", "wiki", "change_type", "namespace")
#: Payload fields by their old and new names, for columns that aren't called like their field.
NAMES = {
    "user_is_bot": ("user_is_bot", "bot"), "is_minor": ("is_minor", "minor"), "is_patrolled": ("is_patrolled", "patrolled"), "old_length": ("old_length", "length_old"),
    "new_length": ("new_length", "length_new"), "delta_bytes": ("delta_bytes", "length_delta"), "wikimedia_rcid": ("wikimedia_recentchange_id", "id"),
}
LOWERED = frozenset(("wiki",))


def to_silver(bronze: DataFrame) -> DataFrame:
    """Columns and types of SILVER; the first name that a payload has a value under counts, and fields that a frame lacks are null."""
    payload = bronze.schema["payload"].dataType
    at = S.parse_time(F.col("occurred_at"))

    def column(name: str, to: str) -> Column:
        found = [as_type(F.col(f"payload.{n}"), payload[n].dataType, to) for n in NAMES.get(name, (name,)) if n in payload.names]
        value = F.coalesce(*found) if found else F.lit(None).cast(to)
        return F.lower(value) if name in LOWERED else value

    own = {"event_id": F.col("event_id"), "occurred_at": at, "ingestion_date": F.to_date(at)}
    kinds = {f.name: f.dataType.simpleString() for f in SILVER.fields}
    columns = own | {n: column(n, k) for n, k in kinds.items() if n not in own}
    columns["delta_bytes"] = F.coalesce(columns["delta_bytes"], S.delta(columns["new_length"], columns["old_length"]))
    rows = bronze.dropna(subset=["event_id", "occurred_at"]).select(*[columns[n].alias(n) for n in kinds])
    return rows.dropna(subset=list(REQUIRED))


def as_type(x: Column, kind, to: str) -> Column:
    """A payload field as a column's type: objects and arrays as JSON text, flags three-valued, null where a cast fails."""
    if to == "boolean":
        return S.as_boolean(x)
    if not isinstance(kind, StructType) and not hasattr(kind, "elementType") and not hasattr(kind, "valueType"):
        return x.try_cast(to)
    return F.to_json(x) if to == "string" else F.lit(None).cast(to)
