"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these ASCII white-space characters; bytes.split() cuts at exactly them.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; a session in local mode may leave that unset."""
    sc = spark.sparkContext
    own = sc._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", "") or (own.get() if own.isDefined() else "")
    if not base and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")  # driver and executors are one process
    if own.isEmpty():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


#: Lists that note each path that scratch gives out.
_notes: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _notes:
        paths.append(path)
    return path


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """While this is open, paths takes every path that scratch gives out."""
    _notes.append(paths)
    try:
        yield
    finally:
        _notes.pop(next(k for k, x in enumerate(_notes) if x is paths))


def removed(spark: SparkSession, paths: list[str], in_use: DataFrame | None = None) -> None:
    """Deletes intermediate tables, with what lies beside them under the same name, but for those that in_use reads."""
    sc = spark.sparkContext
    read = in_use.inputFiles() if in_use is not None and paths else []
    for path in paths:
        if any(f"/{path.rsplit('/', 1)[-1]}/" in f for f in read):
            continue
        for name in (path, f"{path}-state", f"{path}-checkpoint"):
            at = sc._jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read from reliable storage from then on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: like cut, but compressed, for rows with texts."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")  # nothing reads the step's shuffle files once its rows are stored
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its texts go to Python workers in batches of a few megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column has."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def located(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, stored, with a number of their own that tells equal rows and rows with one id apart; that column's name."""
    row = fresh(docs, "_row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


#: Numbers of rows that are sent to all tasks at most, eight bytes each; more are joined like any other table.
SENT_ROWS = 1_000_000


def without(docs: DataFrame, gone: DataFrame, row_col: str) -> DataFrame:
    """The rows whose number isn't in the one column of gone."""
    name = fresh(docs, "_gone")
    gone = stored(gone.toDF(name), "gone")
    few = gone.limit(SENT_ROWS + 1).count() <= SENT_ROWS
    return docs.join(F.broadcast(gone) if few else gone, F.col(row_col) == F.col(name), "left_anti")


def word_count(text: Column) -> Column:
    """Words of a text without splitting it into an array; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_text(values: list[bytes]) -> pa.Array:
    """UTF-8 as a column of text, whatever bytes it holds."""
    return pa.array(values, pa.binary()).view(pa.string())


def decoded(value: bytes) -> str:
    """Bytes that are no UTF-8 become replacement characters."""
    return value.decode("utf-8", "replace")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `limit` bytes of the column's text, or one row."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.binary())
        start, held = 0, 0
        for i in range(batch.num_rows):
            n = len(sizes[i].as_buffer() or b"") if sizes[i].is_valid else 0
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    trimmed()  # an idle worker keeps nothing


def trimmed() -> None:
    """Gives memory that a worker has freed back to the machine, where its C library can."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    per_slice: Callable[[list[bytes]], list[pa.Array]],
    fields: list[tuple[str, str]],
) -> DataFrame:
    """One row per input row: the id, then the (name, type) fields that per_slice makes of a slice of texts."""
    names = [id_col, *(name for name, _ in fields)]
    kinds = [df.schema[id_col].dataType.simpleString(), *(kind for _, kind in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            columns = per_slice(text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=names)

    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
