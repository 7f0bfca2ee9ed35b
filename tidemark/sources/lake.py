"""Bronze, silver and gold on files, by hour; re-running an hour replaces it."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import scalars as S
from tidemark.operators.gold import GOLD, gold_base
from tidemark.operators.silver import REQUIRED, to_silver
from tidemark.sources import files
from tidemark.sources.schemas import BRONZE, ENVELOPE, GOLD_SCHEMAS, PARTS, SILVER

FILE_BYTES = 128 << 20


class EmptyHour(ValueError):
    """Raised before anything is overwritten."""


def resolve_hour(args: dict[str, str] | None, now: datetime) -> tuple[str, str, str, str]:
    """The hour asked for, or the last whole one, in two-digit parts."""
    if args:
        return tuple(str(args[p]).zfill(4 if p == "year" else 2) for p in PARTS)
    last = now - timedelta(hours=1)
    return tuple(last.strftime(f) for f in ("%Y", "%m", "%d", "%H"))


def in_hours(first: tuple[str, ...], last: tuple[str, ...] | None = None):
    """Partition predicate of an hour, or of all hours from first to last."""
    joined = F.concat(*[F.col(p) for p in PARTS])
    if last is None:
        test = F.lit(True)
        for p, v in zip(PARTS, first, strict=True):
            test = test & (F.col(p) == v)
        return test
    return F.col("year").between(first[0], last[0]) & joined.between("".join(first), "".join(last))


def write_bronze_batch(envelopes: DataFrame, base: str, batch: str | None = None) -> None:
    """Gzip JSON lines by hour and batch; a batch that is written again replaces itself."""
    parts = S.hour_parts_of_text(F.col("occurred_at")) | {"batch": F.lit(batch or uuid.uuid4().hex)}
    out = envelopes.withColumns(parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
    out.partitionBy(*PARTS, "batch").json(base)


def read_bronze_hours(spark: SparkSession, base: str, first: tuple[str, ...], last: tuple[str, ...] | None = None) -> DataFrame:
    return spark.read.schema(StructType([*BRONZE.fields, StructField("batch", StringType())])).option("mode", "PERMISSIVE").json(base).where(in_hours(first, last)).drop(*PARTS, "batch")


def _replace(df: DataFrame, path: str, hour: str) -> None:
    parts = {k: F.date_format(hour, f) for k, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    # by hour, a large one dealt over as many tasks as its size asks for
    out = df.withColumns(parts).hint("rebalance", *PARTS)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*PARTS).parquet(path)


def write_silver(silver: DataFrame, path: str) -> None:
    _replace(silver, path, "occurred_at")


def read_silver_hours(spark: SparkSession, path: str, first: tuple[str, ...], last: tuple[str, ...] | None = None) -> DataFrame:
    """Fails rather than let gold be overwritten by nothing."""
    schema = StructType(SILVER.fields + [f for f in BRONZE.fields if f.name in PARTS])
    rows = spark.read.schema(schema).parquet(path).where(in_hours(first, last)).drop(*PARTS)
    if rows.dropna(subset=["event_id", *REQUIRED]).isEmpty():
        raise EmptyHour(f"no valid silver rows for {first}")
    return rows


def write_gold(df: DataFrame, base: str, name: str) -> None:
    _replace(df, f"{base}/{name}", "metric_hour")


def run_range(spark: SparkSession, bronze: str, silver: str, gold: str, first: tuple[str, ...], last: tuple[str, ...] | None = None) -> None:
    """Silver, then all gold sets, for an hour or a range of hours in one pass each."""
    write_silver(to_silver(read_bronze_hours(spark, bronze, first, last)), silver)
    base = gold_base(read_silver_hours(spark, silver, first, last)).persist()
    try:
        for name, make in GOLD.items():
            write_gold(make(base), gold, name)
    finally:
        base.unpersist()


run_hour = run_range


def declared_tables(bronze: str, silver: str, gold: str) -> dict[str, tuple[str, str, StructType]]:
    """Name -> (format, path, columns) of the lake's tables: bronze JSON, silver and the gold sets."""
    sets = {f"gold_{n}": ("parquet", f"{gold}/{n}", columns) for n, columns in GOLD_SCHEMAS.items()}
    return {"bronze_events": ("json", bronze, ENVELOPE), "silver_events": ("parquet", silver, SILVER)} | sets


def register_tables(spark: SparkSession, tables: dict[str, tuple[str, str, StructType]]) -> None:
    """External tables with text partitions by hour; partitions that stand on the shared folder are taken in."""
    for name, (kind, path, columns) in tables.items():
        parts = (*PARTS, "batch") if kind == "json" else PARTS
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields) + "".join(f", {p} STRING" for p in parts)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {kind} PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'")
        spark.catalog.recoverPartitions(name)


def packed_bins(sizes: list[int], file_bytes: int) -> int:
    """Files that these would fill, the largest first, each into the first one with room; files of the full size stay by themselves."""
    room: list[int] = []
    for size in sorted(sizes, reverse=True):
        k = next((k for k, left in enumerate(room) if size <= left), None)
        if k is None:
            room.append(file_bytes - size)
        else:
            room[k] -= size
    return len(room)


def hours_of(spark: SparkSession, path: str, first: tuple[str, ...], last: tuple[str, ...] | None = None) -> dict[tuple[str, ...], list[int]]:
    """The sizes of the data files of each hour's folder."""
    found, levels = {}, [()]
    while levels:
        values = levels.pop()
        at = "/".join([path.rstrip("/"), *(f"{p}={v}" for p, v in zip(PARTS, values, strict=False))])
        names = files.listed(spark, at)
        if len(values) == len(PARTS):
            found[values] = [size for name, size in names.items() if not name.startswith(("_", "."))]
            continue
        for name in names:
            part, _, value = name.partition("=")
            here = (*values, value)
            if part == PARTS[len(values)] and first[: len(here)] <= here <= (last or first)[: len(here)]:
                levels.append(here)
    return found


def compact(spark: SparkSession, path: str, first: tuple[str, ...], last: tuple[str, ...] | None = None, file_bytes: int = FILE_BYTES) -> list[tuple[str, ...]]:
    """Rewrites the hours whose files would fill fewer ones of about file_bytes, all in one job; which.

    New files are written aside.  Once they are whole, a manifest names the hours
    to swap: each hour's folder is moved away and the new one moved to its place.
    A run that died before the manifest has changed nothing, one that died after
    it is finished by the next.
    """
    path = path.rstrip("/")
    aside, old, plan = f"{path}/_compacting", f"{path}/_compacted", f"{path}/_compact_plan"
    swap_hours(spark, path)
    files.deleted(spark, aside)
    bins = {hour: packed_bins(sizes, file_bytes) for hour, sizes in hours_of(spark, path, first, last).items() if packed_bins(sizes, file_bytes) < len(sizes)}
    if not bins:
        return []
    folders = ["/".join(f"{p}={v}" for p, v in zip(PARTS, hour, strict=True)) for hour in bins]
    found = spark.read.parquet(f"{path}/{folders[0]}")
    schema = StructType([f for f in found.schema.fields if f.name not in PARTS] + [StructField(p, StringType()) for p in PARTS])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    # an hour's rows go to as many tasks as it gets files
    wanted = F.create_map(*[F.lit(x) for hour, n in bins.items() for x in ("".join(hour), n)])
    deal = F.floor(F.rand(42) * F.element_at(wanted, F.concat(*PARTS)))
    rows.repartition(sum(bins.values()), *PARTS, deal).write.mode("overwrite").option("compression", "snappy").partitionBy(*PARTS).parquet(aside)
    files.put_text(spark, plan, "\n".join(folders))
    swap_hours(spark, path)
    files.deleted(spark, old)
    return sorted(bins)


def swap_hours(spark: SparkSession, path: str) -> None:
    """Moves compacted hours to their places, as far as that hasn't happened yet."""
    aside, old, plan = f"{path}/_compacting", f"{path}/_compacted", f"{path}/_compact_plan"
    if not files.exists(spark, plan):
        return
    for folder in files.get_text(spark, plan).split("\n"):
        if files.exists(spark, f"{aside}/{folder}"):
            if files.exists(spark, f"{path}/{folder}"):
                files.renamed(spark, f"{path}/{folder}", f"{old}/{folder}")
            files.renamed(spark, f"{aside}/{folder}", f"{path}/{folder}")
    files.deleted(spark, aside)
    files.deleted(spark, old)
    files.deleted(spark, plan)


def retain(spark: SparkSession, path: str, first: tuple[str, ...]) -> int:
    """Deletes the year, month, day and hour folders that lie before an hour, and reads no file; how many."""
    gone = 0
    levels = [(path, ())]
    while levels:
        at, values = levels.pop()
        for entry in files.listed(spark, at):
            name, _, value = entry.partition("=")
            if len(values) == len(PARTS) or name != PARTS[len(values)]:
                continue
            here = (*values, value)
            if here < first[: len(here)]:
                gone += files.deleted(spark, f"{at}/{entry}")
            elif here == first[: len(here)]:
                levels.append((f"{at}/{entry}", here))
    return gone
