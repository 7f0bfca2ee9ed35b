"""Tables that a stream's batches change row by row: a base for each day, and the batches since.

A batch writes its rows as a delta, in a folder of its number, so that a batch
that is run again replaces what it wrote.  Every few batches the deltas are
merged into new bases of the days they touch; a manifest, put in place under its
final name in one step, then names the bases and the last batch that they hold.
Readers take the newest manifest, its bases and the deltas after it: however
many batches there were, they open the files of a bounded number of folders.
What a manifest replaces is deleted one merge later, when its readers are done.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import files

#: Deltas that are merged at a time.
EVERY = 50
ALL = "all"


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: the last batch that bases hold, and the base folder of each day."""
    found = sorted(n for n in files.listed(spark, f"{path}/_manifest") if n.isdigit())
    return json.loads(files.get_text(spark, f"{path}/_manifest/{found[-1]}")) if found else {"upto": -1, "days": {}}


def deltas(spark: SparkSession, path: str, after: int) -> list[int]:
    numbers = (n.removeprefix("batch=") for n in files.listed(spark, f"{path}/delta") if n.startswith("batch="))
    return sorted(int(n) for n in numbers if int(n) > after)


def write(batch: DataFrame, number: int, path: str, keys: list[str], time_col: str | None = None, every: int = EVERY, keep_days: int | None = None) -> None:
    """A batch's rows, whole for each key that it has, which replace those of earlier batches; merges when it's time.

    keep_days: days that lie further than this before the newest one leave the table with a merge.
    """
    spark = batch.sparkSession
    day = F.date_format(time_col, "yyyy-MM-dd") if time_col else F.lit(ALL)
    batch.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{path}/delta/batch={number}")
    if len(deltas(spark, path, manifest(spark, path)["upto"])) >= every:
        merge(spark, path, batch.schema, keys, number, keep_days)


def _rows(spark: SparkSession, path: str, schema: StructType, known: dict, upto: int | None = None, days: list[str] | None = None) -> DataFrame:
    """Rows of bases and of deltas after them, with the batch that each comes from."""
    full = StructType([*schema.fields]).add("batch", "long").add("day", "string")
    empty = spark.createDataFrame([], full)
    bases = [f"{path}/{at}/day={d}" for d, at in known["days"].items() if days is None or d in days]
    out = spark.read.schema(full).option("basePath", f"{path}/base").parquet(*bases).select(*full.names) if bases else empty
    new = [n for n in deltas(spark, path, known["upto"]) if upto is None or n <= upto]
    if new:
        more = spark.read.schema(full).option("basePath", f"{path}/delta").parquet(*[f"{path}/delta/batch={n}" for n in new]).select(*full.names)
        out = out.unionByName(more if days is None else more.where(F.col("day").isin(days)))
    return out


def _last(rows: DataFrame, schema: StructType, keys: list[str]) -> DataFrame:
    others = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys, "day").agg(F.max_by(F.struct(*others, "batch"), "batch").alias("_x"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_x.`{c}`") for c in schema.names], F.col("_x.batch").alias("batch"), "day")


def read(spark: SparkSession, path: str, schema: StructType, keys: list[str], days: list[str] | None = None) -> DataFrame:
    """The rows as they are now, of these days alone if given."""
    return _last(_rows(spark, path, schema, manifest(spark, path), days=days), schema, keys).select(*schema.names)


def merge(spark: SparkSession, path: str, schema: StructType, keys: list[str], number: int, keep_days: int | None = None) -> dict:
    """New bases of the days that deltas up to this batch touch; days that none touches keep theirs."""
    known = manifest(spark, path)
    new = [n for n in deltas(spark, path, known["upto"]) if n <= number]
    touched = sorted({d.removeprefix("day=") for n in new for d in files.listed(spark, f"{path}/delta/batch={n}") if d.startswith("day=")})
    at = f"base/upto={number}"
    if touched:
        rows = _last(_rows(spark, path, schema, known, number, touched), schema, keys)
        # a merge that died before its manifest stood is replaced
        rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{path}/{at}")
    days = known["days"] | dict.fromkeys(touched, at)
    if keep_days is not None and days:
        newest = max(days)
        first = spark.range(1).select(F.date_format(F.date_sub(F.lit(newest).cast("date"), keep_days), "yyyy-MM-dd")).first()[0]
        days = {d: b for d, b in days.items() if d >= first}
    made = {"upto": number, "days": days}
    files.put_text(spark, f"{path}/_manifest/{number:020d}", json.dumps(made))
    for n in deltas(spark, path, -1):
        if n <= known["upto"]:
            files.deleted(spark, f"{path}/delta/batch={n}")
    used = {*known["days"].values(), *days.values()}
    for name in files.listed(spark, f"{path}/base"):
        if name.startswith("upto=") and f"base/{name}" not in used and int(name[5:]) < number:
            files.deleted(spark, f"{path}/base/{name}")
    for name in sorted(files.listed(spark, f"{path}/_manifest"))[:-2]:
        files.deleted(spark, f"{path}/_manifest/{name}")
    return made
