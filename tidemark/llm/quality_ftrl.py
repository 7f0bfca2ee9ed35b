"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and digits and runs of other signs; a token that
repeats the one before it counts as a repeat whatever it says.  Unigrams and
bigrams are hashed into a fixed number of weights, counts are dampened and each
document's vector has length one.  Training takes a bounded sample of labelled
rows, dealt over shards: each shard runs its updates in a task, and the shards'
weights are averaged.  Scores are sparse dot products, computed where the
documents are read; the weights, of fixed size, are sent to all tasks.

Null and empty texts have no features and score the intercept.  Labels that are
null or without a document are not learned from; without any label all scores
are 0.5.  Rows without an id are scored like all others, and aren't held out; texts
of any length are read whole.  Repeated rows score alike; columns besides id and text never matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, text_bytes, trimmed

BITS = 18
#: Labelled rows learned from at most: the sample is by a hash of the id, and these are the only rows that are capped.
MAX_TRAIN, SHARDS, EPOCHS = 8_000, 4, 8
ALPHA, BETA, L1, L2 = 10.0, 1.0, 0.01, 0.0
THRESHOLD, FOLDS = 0.3, 5
TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text's hashed uni- and bigrams."""
    tokens = TOKEN.findall(text)
    if not tokens:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    h = np.fromiter(map(crc32, tokens), dtype=np.uint64, count=len(tokens))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = h[1:] == h[:-1]
    h[same] = 1
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    places = np.concatenate([h * np.uint64(0xD6E8FEB86659FD93), pairs]) >> np.uint64(64 - bits)
    at, counts = np.unique(places, return_counts=True)
    values = np.log1p(counts).astype(np.float32)
    return at.astype(np.int32), values / np.sqrt((values * values).sum())


def fold(id_col: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int, epochs: int) -> np.ndarray:
    """Weights, the intercept last, after passes over (places, values, label)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at: np.ndarray | slice, l1: float) -> np.ndarray:
        small = np.abs(z[at]) <= l1
        return np.where(small, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for places, values, label in examples:
            at, x = np.append(places, 1 << bits), np.append(values, 1.0)
            w = weights(at, L1)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(slice(None), L1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
    bits: int = BITS,
) -> np.ndarray:
    """Weights from at most max_train labelled rows outside fold 0."""
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    # max_train rows of an id and a label: a size that is known beforehand
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("id") == F.col("_id"))

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        found = [features(x, bits) for x in texts]
        return [pa.array([a.tolist() for a, _ in found], pa.list_(pa.int32())), pa.array([v.tolist() for _, v in found], pa.list_(pa.float32()))]

    key = chosen.select(F.struct("id", "_label").alias("key"), "text")
    vectors = map_texts(key, "key", "text", per_slice, [("places", "array<int>"), ("values", "array<float>")])
    vectors = vectors.withColumn("shard", F.pmod(F.xxhash64("key.id"), F.lit(SHARDS)))

    def fit(rows: pa.Table) -> pa.Table:
        trimmed()
        keys = rows.column("key").to_pylist()
        order = sorted(range(len(keys)), key=lambda k: (crc32(str(keys[k]["id"]).encode()), keys[k]["id"]))
        places, values = (rows.column(c).combine_chunks() for c in ("places", "values"))
        ends = places.offsets.to_numpy()
        at, x = places.values.to_numpy(), values.values.to_numpy()
        examples = [(at[ends[k] : ends[k + 1]].astype(np.int64), x[ends[k] : ends[k + 1]].astype(np.float64), keys[k]["_label"]) for k in order]
        w = ftrl(examples, bits, EPOCHS)
        trimmed()
        return pa.table({"n": pa.array([len(examples)], pa.int64()), "w": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    # SHARDS rows of fixed size
    fitted = vectors.groupBy("shard").applyInArrow(fit, "n bigint, w binary").collect()
    if not fitted:
        return np.zeros((1 << bits) + 1, np.float32)
    return np.average([np.frombuffer(x["w"], dtype=np.float32) for x in fitted], axis=0, weights=[x["n"] for x in fitted]).astype(np.float32)


def scores_of(texts: list[bytes], w: np.ndarray) -> pa.Array:
    bits = (len(w) - 1).bit_length() - 1
    out = []
    for x in texts:
        at, values = features(x, bits)
        out.append(float(w[-1]) + float(w[at] @ values))
    return pa.array(1 / (1 + np.exp(-np.clip(np.array(out, dtype=np.float64), -30, 30))), pa.float64())


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row: how likely its label is 1."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        return [scores_of(texts, sent.value)]

    return map_texts(docs, id_col, text_col, per_slice, [("score", "double")])


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of each row."""
    scored = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    held_out = F.coalesce(fold(F.col(id_col)) == 0, F.lit(False))
    return scored.select(id_col, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns: a filter where they are read."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))

    def own_score(text: pa.Array) -> pa.Array:
        trimmed()
        return scores_of(text_bytes(text), sent.value)

    return docs.where(F.arrow_udf(own_score, "double")(F.col(text_col)) >= threshold)
