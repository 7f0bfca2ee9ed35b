"""Column expressions: Column in, Column out, no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(x: Column) -> Column:
    """Trimmed text, null where blank."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def safe_string(x: Column, default: str | None = "unknown") -> Column:
    return F.coalesce(filled(x), F.lit(default))


def key_safe(x: Column, default: str = "unknown") -> Column:
    return F.replace(safe_string(x, default), F.lit("#"), F.lit("_"))


def as_flag(x: Column) -> Column:
    """True for true, 1, yes, y in any case and for non-zero numbers, else false; never null."""
    text = F.lower(F.trim(x.cast("string")))
    return F.coalesce(text.isin("true", "yes", "y") | (text.try_cast("double") != 0), F.lit(False))


def as_boolean(x: Column) -> Column:
    """A boolean as Spark casts text or numbers to it; null for what is neither."""
    text = F.trim(x.cast("string"))
    return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)


def bot_flag(user_is_bot: Column, bot: Column) -> Column:
    return as_flag(F.coalesce(user_is_bot.cast("string"), bot.cast("string")))


def parse_time(x: Column) -> Column:
    """ISO time, UTC without an offset, null if junk."""
    return F.try_to_timestamp(x.cast("string"))


def parse_millis(*candidates: Column) -> Column:
    """The first candidate that is a number of one or more milliseconds; fractions go."""
    numbers = [c.cast("string").try_cast("double") for c in candidates]
    return F.coalesce(*[F.when((x >= 1) & (x < 9e15), x.cast("bigint")) for x in numbers])


def floor_seconds(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) - F.pmod(F.unix_timestamp(ts), F.lit(seconds)))


def stable_hash(x: Column) -> Column:
    """First 32 bits of the SHA-256 as a non-negative long."""
    return F.conv(F.substring(F.sha2(x, 256), 1, 8), 16, 10).cast("bigint")


def shard(x: Column, n: int) -> Column:
    return F.pmod(stable_hash(x), F.lit(n)).cast("int")


def token12(x: Column) -> Column:
    return F.substring(F.sha2(x, 256), 1, 12)


def sampled(key: Column, rate: float) -> Column:
    """Keeps a fixed share of the keys: all at 1 or more, none at 0 or less."""
    if rate >= 1:
        return F.lit(True)
    if rate <= 0:
        return F.lit(False)
    return F.coalesce(stable_hash(key) / F.lit(4294967295) < F.lit(float(rate)), F.lit(False))


def delta(new: Column, old: Column) -> Column:
    return new - old


def first_filled(*urls: Column) -> Column:
    return F.coalesce(*[filled(u) for u in urls])


def bot_ratio(bots: Column, humans: Column) -> Column:
    total = bots + humans
    return F.when(total > 0, F.round(bots / total, 4)).otherwise(F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, 100.0 * part / total).otherwise(F.lit(0.0))


def scaled(count: Column, rate: float) -> Column:
    """A count over a sample, scaled to the whole feed."""
    return count / F.lit(float(rate))


def round4(x: Column) -> Column:
    bad = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(x.isNull() | bad, F.lit(0.0)).otherwise(F.round(x, 4))


def is_partial(window_start: Column, now: Column, minutes: int = 1) -> Column:
    return F.coalesce(now < window_start + F.make_dt_interval(mins=F.lit(minutes)), F.lit(True))


def latest_closed_minute(now: Column, delay_seconds: int = 10) -> Column:
    return F.date_trunc("minute", now - F.make_dt_interval(secs=F.lit(delay_seconds))) - F.make_dt_interval(mins=F.lit(1))


def hour_parts(ts: Column) -> dict[str, Column]:
    """Two-digit partition values."""
    return {name: F.date_format(ts, pattern) for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}


def hour_parts_of_text(occurred_at: Column) -> dict[str, Column]:
    return {n: F.substring(occurred_at, a, k) for n, a, k in (("year", 1, 4), ("month", 6, 2), ("day", 9, 2), ("hour", 12, 2))}


def bucket_number(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds).cast("bigint")


def topic_type(topic: Column) -> Column:
    return F.when(topic == "global", "global").when(topic == "top_pages", "top_pages").when(topic.startswith("wiki:"), "wiki").otherwise("unknown")


def valid_topic(topic: Column) -> Column:
    return F.coalesce(topic.isin("global", "top_pages") | topic.rlike("^wiki:[a-z0-9_-]{2,80}$"), F.lit(False))


def topics_with(topics: Column, topic: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_union(topics, F.array(topic))))


def topics_without(topics: Column, topic: Column) -> Column:
    """global always stays."""
    return F.array_sort(F.array_union(F.array_remove(topics, topic), F.array(F.lit("global"))))
