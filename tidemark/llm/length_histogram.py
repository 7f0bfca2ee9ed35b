"""Token counts as an exact length histogram.

Documents are aggregated by their encoded length, once.  Suffix sums over the
histogram then answer totals, quantiles and truncated totals for every context
limit without reading a document again.  Sums run within blocks of lengths and
over the blocks' totals, so no task holds more than a block of lengths or the
list of blocks.

Null and empty texts have length 0; bytes that are no UTF-8 are encoded as
replacement characters.  Ties don't matter to counts, repeated rows
each count, columns besides the text are ignored; an empty table gives an empty
histogram, and limits on it answer 0 documents and tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import shared_tokens
from tidemark.llm.common import cut, decoded, map_texts

BLOCK = 1024


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of each row under the rank file at path."""
    tokens = shared_tokens(docs.sparkSession, path)
    made: list = []

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        if not made:
            import tiktoken

            ranks = {t: i for i, t in enumerate(tokens.value)}
            made.append(tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        counts = [len(made[0].encode_ordinary(decoded(x))) for x in texts]
        return [pa.array(np.array(counts, dtype=np.int64), pa.int64())]

    return map_texts(docs, id_col, text_col, per_slice, [("n_tokens", "bigint")])


def histogram(counts: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """For each length that occurs: n_docs, docs_at_least, tokens_at_least (suffix sums), truncated_total, share_at_most.

    truncated_total is the sum of all lengths cut at this one; share_at_most the
    share of documents that are no longer.
    """
    lengths = counts.groupBy(F.col(length_col).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    lengths = cut(lengths)  # texts are encoded once, though two branches read their lengths
    lengths = lengths.withColumns({"block": F.floor(F.col("length") / BLOCK), "tokens": F.col("length") * F.col("n_docs")})
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = lengths.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        F.col("block"),
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    down = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = lengths.join(blocks, "block").withColumns(
        {"docs_at_least": F.col("docs_after") + F.sum("n_docs").over(down), "tokens_at_least": F.col("tokens_after") + F.sum("tokens").over(down)}
    )
    return summed.select(
        F.col("length").alias(length_col),
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("share_at_most"),
    )


def at_limits(hist: DataFrame, limits: list[int], length_col: str = "n_tokens") -> DataFrame:
    """(context_limit, docs_over, tokens_over, truncated_total) for any limits, whether or not they occur as lengths."""
    asked = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    total = hist.agg(F.coalesce(F.sum(F.col(length_col) * F.col("n_docs")), F.lit(0)).alias("total"))
    # the suffix sums of the first length over the limit
    over = hist.join(F.broadcast(asked), F.col(length_col) > F.col("context_limit"))
    over = over.groupBy("context_limit").agg(F.min(F.struct(length_col, "docs_at_least", "tokens_at_least")).alias("x"))
    docs, tokens = (F.coalesce(F.col(f"x.{c}"), F.lit(0)) for c in ("docs_at_least", "tokens_at_least"))
    joined = asked.join(over, "context_limit", "left").join(F.broadcast(total), how="cross")
    return joined.select("context_limit", docs.alias("docs_over"), tokens.alias("tokens_over"), (F.col("total") - tokens + F.col("context_limit") * docs).alias("truncated_total"))


def quantile(hist: DataFrame, q: float, length_col: str = "n_tokens") -> Column | int | None:
    """The least length that a share q of the documents doesn't exceed; None without documents."""
    return hist.where(F.col("share_at_most") >= q).agg(F.min(length_col)).first()[0]
