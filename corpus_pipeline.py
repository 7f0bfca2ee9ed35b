"""A training corpus in five stages, each on all that the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last
return the columns of documents.  Each is written and read again before the
next one starts, which then removes what the ones before have left in the shared
folder.  A stage may be called for several tables: its results all stay until
the next stage starts.

Null texts count as empty in every stage.  An empty table passes through all of
them.  Rows that share an id, or have none, are documents of their own; of
equal texts, or near copies, the row with the least id stays (a null id is less
than any other for equal texts, and comes last among near copies), of rows that
repeat it one.  Further columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, mixing, quality_ftrl, simhash
from tidemark.llm.common import noted, removed, stored, table
from tidemark.llm.queries import rank_file

#: Tables that each stage has made on its way, until a stage after it starts.
_left: dict[str, list[str]] = {}


@contextmanager
def _step(spark: SparkSession, docs: DataFrame, name: str) -> Iterator[None]:
    """Removes what the stages before this one have left, but for what docs still reads, and notes what this one leaves."""
    for before in [n for n, _ in STAGES[: [n for n, _ in STAGES].index(name)]]:
        removed(spark, _left.pop(before, []), docs)
    with noted(_left.setdefault(name, [])):
        yield


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; an empty text scores the intercept, like any text without known words."""
    with _step(spark, docs, "quality"):
        return quality_ftrl.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the least id stays; all empty ones are equal."""
    with _step(spark, docs, "exact"):
        return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays: shingles of five words, a similarity of 0.8 or more."""
    with _step(spark, docs, "near"):
        return simhash.one_of_each(docs, **simhash.SIMILAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; null sources are one source."""
    with _step(spark, docs, "mixture"):
        return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, checked by decoding; an empty text has none."""
    with _step(spark, docs, "tokens"):
        return bpe.digests(bpe.round_trip(docs, *rank_file()))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixture", mixture), ("tokens", tokens)]

#: Trained weights, hashed shingles and merges have no form in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        path: list[str] = []
        with noted(path):
            docs = stored(made, name)
        removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
