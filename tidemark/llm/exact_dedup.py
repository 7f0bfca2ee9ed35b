"""Exact deduplication by a streaming query over keyed state on disk.

Rows are staged once, in the shared folder: digest, id, content locator and the
row itself.  The locator numbers the staged rows (part file, row in it), so
content is found again by it alone.  A stream over digest, id and locator, dealt
over several micro-batches, keeps for each digest and without expiry the least
id, its locator and the number of rows in a RocksDB state store that checkpoints
to the shared folder.  Equal digests are only hits: the staged bytes of every
hit, white space normalised, are then compared with those of the row that stays.  Should texts with one
digest differ, their groups are formed anew by the whole text.

Everything on the data's path is DataFrame functions.  A group of any size is
one state row, since Spark adds up each task's rows before it shuffles; fetched
texts meet the row that stays in a plain equi-join, whose large partitions
Spark splits.

Null texts count as empty, and empty texts equal each other.  Rows that repeat
an id are rows of their own: each counts, and of those with the least id of a
group one stays.  A null id is less than any other; rows without an id are
compared like all others.  Columns besides id and text are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, cut, scratch, stored, without

#: Groups with more than one text whose digests are sent to all tasks at most: 32 bytes each and less than 10 MB in all.
SENT_DIGESTS = 100_000
#: Micro-batches that the staged rows are dealt over, and the bytes that one reads at least.
BATCHES, LEAST_BATCH = 3, 16 << 20


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def keyed_state(rows: DataFrame) -> DataFrame:
    """Of a stream (or table) of (digest, id, locator): digest -> least (id, locator) and number of rows."""
    return rows.groupBy("digest").agg(F.min(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n"))


def run_stream(staged: DataFrame, path: str, batch_bytes: int) -> DataFrame:
    """The state after all rows that are staged at path have gone through the streaming query; staged holds their columns digest, id, locator."""
    spark = staged.sparkSession
    out = f"{path}-state"
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # a store for each partition, of small rows: no space is set aside before it is needed
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(staged.schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(path)
        query = (
            keyed_state(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", f"{path}-checkpoint")
            .trigger(availableNow=True)
            # a batch that is run again replaces what it wrote before
            .foreachBatch(lambda changed, batch: changed.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    batches = spark.read.schema(keyed_state(staged).schema.add("batch", "long")).parquet(out)
    if query.lastProgress is None or query.lastProgress["batchId"] == 0:
        return batches.drop("batch")
    # a key's later batches hold lower ids and higher counts
    # stored, so that Spark can split large groups where rows are joined with it
    return stored(batches.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("n").alias("n")), "state")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    row_col: str | None = None,
    batches: int = BATCHES,
    least_batch: int = LEAST_BATCH,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of each row; digest is for tests of what happens when digests collide.

    row_col: a column that numbers the rows, which the result has too.
    """
    staged, state, _ = grouped_by_digest(docs.select(id_col, text_col, *([row_col] if row_col else [])), id_col, text_col, digest, row_col, batches, least_batch)
    name = docs.schema[id_col].name
    named = digest is sha256
    out = (staged.select("digest", "id", "locator") if named else staged).join(state, "digest").select(
        F.col("id").alias(name),
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"),
        (F.lower(F.hex("digest")) if named else F.sha2(staged_text(text_col), 256)).alias("text_sha256"),
        *([F.col("locator").alias(row_col)] if row_col else []),
        "digest",
    )
    wrong = differing(staged, state, text_col)
    if not wrong.isEmpty():
        wrong = cut(wrong.distinct())
        return out.join(wrong, "digest", "left_anti").drop("digest").unionByName(regrouped(staged, wrong, text_col, name, row_col))
    return out.drop("digest")


def staged_text(text_col: str) -> Column:
    return normalised(F.col(f"doc.`{text_col}`"))


def grouped_by_digest(
    docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], row_col: str | None, batches: int, least_batch: int
) -> tuple[DataFrame, DataFrame, str]:
    """(staged rows, state, path): rows of digest, id, locator and doc, a struct of the given columns."""
    spark = docs.sparkSession
    if docs.schema[id_col].dataType.simpleString() != "bigint":
        raise ValueError("ids must be of type long")
    # the upper bits name the part file that a row is staged in, the lower ones the row
    locator = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(digest(normalised(F.col(text_col))).alias("digest"), F.col(id_col).alias("id"), locator.alias("locator"), doc.alias("doc"))
    path = scratch(spark, "dedup")
    rows.write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    keys = staged.drop("doc")
    size = int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    state = run_stream(keys, path, max(least_batch, -(-size // batches))) if not keys.isEmpty() else keyed_state(keys)
    return staged, state, path


def differing(staged: DataFrame, state: DataFrame, text_col: str) -> DataFrame:
    """Digests, some repeatedly, of hits whose bytes are not those of the row that stays."""
    hit = state.where("n > 1").select("digest", F.col("keep.locator").alias("keep_locator"))
    few = hit.limit(SENT_DIGESTS + 1).count() <= SENT_DIGESTS
    sent = F.broadcast if few else (lambda df: df)
    # all texts with a digest that occurs again: by a filter of proven size, or else by a join like any other
    found = staged.join(sent(hit.select("digest")), "digest", "left_semi").select("digest", "locator", staged_text(text_col).alias("text"))
    first = staged.select(F.col("locator").alias("keep_locator"), "doc")
    # stored, so that both sides come straight from an exchange and Spark can split a large group
    first = stored(first.join(sent(hit), "keep_locator").select("digest", "keep_locator", staged_text(text_col).alias("keep_text")), "first")
    return found.join(first, "digest").where("locator <> keep_locator AND text <> keep_text").select("digest")


def regrouped(staged: DataFrame, wrong: DataFrame, text_col: str, name: str, row_col: str | None) -> DataFrame:
    """The result's rows of these digests, grouped by the whole text."""
    held = staged.join(wrong, "digest", "left_semi").select("id", "locator", staged_text(text_col).alias("text"))
    groups = held.groupBy("text").agg(F.min(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n"))
    return held.join(groups, "text").select(
        F.col("id").alias(name),
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"),
        F.sha2("text", 256).alias("text_sha256"),
        *([F.col("locator").alias(row_col)] if row_col else []),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    staged, state, _ = grouped_by_digest(docs, id_col, text_col, sha256, None, BATCHES, LEAST_BATCH)
    gone = staged.select("digest", "locator").join(state.where("n > 1"), "digest").where("locator <> keep.locator")
    wrong = differing(staged, state, text_col)
    if not wrong.isEmpty():
        wrong = cut(wrong.distinct())
        groups = regrouped(staged, wrong, text_col, "id", "locator")
        gone = gone.join(wrong, "digest", "left_anti").select("locator").union(groups.where(~F.col("kept")).select("locator"))
    return without(staged, gone.select("locator"), "locator").select("doc.*")
