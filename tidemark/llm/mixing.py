"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of the mix, at most max_copies times its size;
what a full source can't take is reshared by weight (water filling).  Each
document's expected copies are its source's target over its size, or follow the
documents' own weights.  The whole copies are certain.  For what remains a
document has an inclusion probability p, and the documents of a source are
ranked by random odds over inclusion odds, u / (1 - u) over p / (1 - p); the
lowest are taken until the words left to take are met.  The document on the
boundary is taken if that brings the sum nearer to the target.  So the size of
the sample in words is fixed, within half a document, and documents stand in it
with their own probabilities.

No source is ever sorted in one task: ranks are first counted into buckets,
whose number follows the square root of the rows; only a source's bucket with
the boundary is put in order.  u is a hash of the id, so reruns agree.

A null text has size 0; null sources are one source, the last by name.  Rows
that repeat an id share its u and are ordered by size; a table without words
gives targets of 0 and takes nothing.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh, located, word_count

#: Weights of the sources in order of their names, repeating.
CYCLE = (3, 1, 2)
SHARE, MAX_COPIES = 1.5, 2
#: Sources sent to all tasks at most; with more, they are joined like any other table.
SENT_SOURCES = 10_000


def uniform(id_col: Column, seed: int) -> Column:
    """In (0, 1), from 48 bits of a hash of the id."""
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256), 1, 12), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) of (source, source_size) rows, one for each source: closed-form water filling.

    With sources ordered by size over weight, those that are filled up come
    first; a source is filled if the level that the rest would get without it
    reaches its limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, cycle)), ((F.row_number().over(by_name) - 1) % len(cycle) + 1).cast("int"))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * max_copies
    filled = sizes.withColumn("weight", weight).withColumns({"left": left, "open": F.sum("weight").over(rest)})
    filled = filled.withColumn("full", F.col("left") * F.col("weight") >= F.col("source_size") * max_copies * F.col("open"))
    # the first source that isn't full sets the level for all that follow
    level = F.first(F.when(~F.col("full"), F.struct("left", "open")), ignorenulls=True).over(whole)
    return filled.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("source_size").cast("double") * max_copies)
        .otherwise(F.col("level.left") * F.col("weight") / F.col("level.open"))
        .alias("target"),
    )


def expected_copies(docs: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Adds source_size, target and copies, the expected copies: min(max_copies, level * weight), the level set for each source.

    Each round counts documents that are at their limit as full and sets the
    level for the rest; limits only ever grow, and with equal weights the first
    round is the last.
    """
    weighted = "weight" in docs.columns
    if not weighted:
        return docs.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
            "copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        )
    level = targets.withColumn("level", F.lit(0.0))
    full = -1
    while True:
        at = docs.join(level, F.col("source").eqNullSafe(F.col("_source")))
        is_full = F.col("level") * F.col("weight") >= max_copies
        words = F.col("size").cast("double")
        sums = at.groupBy("_source").agg(
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            F.count_if(is_full).alias("n_full"),
            ((F.first("target") - F.coalesce(F.sum(F.when(is_full, words * max_copies)), F.lit(0.0))) / F.sum(F.when(~is_full, words * F.col("weight")))).alias("new"),
            F.first("level").alias("old"),
        )
        level = cut(sums.select("_source", "source_size", "target", "n_full", F.coalesce(F.greatest("new", "old"), "old").alias("level")))
        now = level.agg(F.coalesce(F.sum("n_full"), F.lit(0))).first()[0]
        if now == full:
            at = docs.join(level.drop("n_full"), F.col("source").eqNullSafe(F.col("_source")))
            return at.withColumn("copies", F.least(F.lit(float(max_copies)), F.col("level") * F.col("weight"))).drop("level", "weight")
        full = now


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    cycle: tuple[int, ...] = CYCLE,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    seed: int = 42,
) -> DataFrame:
    """(id, size, source_size, target, taken) of each document, taken in words, repeats counted.

    weight_col: positive weights that the expected copies of a source's
    documents follow; equal if not given.
    """
    return copies(docs, id_col, text_col, source_col, weight_col, cycle, share, max_copies, seed).drop("copies")


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    cycle: tuple[int, ...] = CYCLE,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    seed: int = 42,
    row_col: str | None = None,
) -> DataFrame:
    """The rows of mix with copies, the times each is taken; row_col: a column that numbers the rows, which the result has too."""
    own = [F.col(row_col).alias("_row")] if row_col else []
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        *([F.col(weight_col).cast("double").alias("weight")] if weight_col else []),
        *own,
    )
    rows = cut(rows)  # words are counted once
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sizes = cut(sizes)
    total = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_rows, n_sources = total[0] or 0, total[1]
    targets = cut(source_targets(sizes.drop("n"), cycle, share, max_copies)).withColumnRenamed("source", "_source")
    small = n_sources <= SENT_SOURCES
    ranked = expected_copies(rows, F.broadcast(targets) if small else targets, max_copies)
    ranked = ranked.withColumns({"sure": F.floor(F.least(F.col("copies"), F.lit(max_copies)))})
    ranked = ranked.withColumns({"p": F.col("copies") - F.col("sure"), "u": uniform(F.col("id"), seed)})
    odds = lambda x: x / (1 - x)
    ranked = ranked.withColumn("rank", F.when(F.col("p") > 0, odds(F.col("u")) / odds(F.col("p"))))
    # rank / (1 + rank) lies in (0, 1) whatever the probabilities are
    buckets = 1 << max(8, math.ceil(math.log2(max(n_rows, 1)) / 2))
    ranked = ranked.withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * buckets))
    # 1. words for each source and bucket, and what is left to take after the certain copies
    held = ranked.groupBy("_source", "target", "bucket").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("sure")).alias("certain"))
    by_source = Window.partitionBy("_source")
    held = held.withColumns(
        {
            "left": F.col("target") - F.sum("certain").over(by_source),
            "below": F.coalesce(
                F.sum(F.when(F.col("bucket").isNotNull(), F.col("words"))).over(by_source.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )
    # 2. the bucket where the words run out
    edge = held.where("bucket is not null and below + words > left and below <= left")
    edge = edge.groupBy(F.col("_source").alias("_edge_source")).agg(F.min(F.struct("bucket", "below", "left")).alias("edge"))
    edge = cut(edge)
    decided = ranked.join(F.broadcast(edge) if small else edge, F.col("_source").eqNullSafe(F.col("_edge_source")), "left")
    # 3. only that bucket's documents are put in order
    inside = F.col("bucket") == F.col("edge.bucket")
    order = Window.partitionBy("_source").orderBy("rank", "id", "size", *(["_row"] if own else [])).rowsBetween(Window.unboundedPreceding, -1)
    ordered = decided.where(inside).withColumn("before", F.col("edge.below") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    picked = F.col("before") + F.col("size") / 2 <= F.col("edge.left")
    # without an edge, all that has a chance is taken
    rest = decided.where(~F.coalesce(inside, F.lit(False))).withColumn("more", F.when(F.col("rank").isNotNull() & (F.col("edge").isNull() | (F.col("bucket") < F.col("edge.bucket"))), 1).otherwise(0))
    both = rest.unionByName(ordered.withColumn("more", F.when(picked, 1).otherwise(0)).drop("before"))
    return both.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("sure") + F.col("more"))).cast("long").alias("taken"),
        (F.col("sure") + F.col("more")).cast("int").alias("copies"),
        *([F.col("_row").alias(row_col)] if own else []),
    )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row as many times as it is taken, with all its columns.

    Rows are told apart whatever their ids: those that repeat an id, or have
    none, come as many times each as mix takes them.  A text without words is
    taken like any other of its source, though it adds no words; a source
    without any words is not taken.
    """
    rows, row = located(docs)
    taken, n, copy = (fresh(rows, x) for x in ("_taken_row", "_times", "_copy"))
    times = copies(rows, id_col, text_col, source_col, row_col=row, **options).where("copies > 0").select(F.col(row).alias(taken), F.col("copies").alias(n))
    joined = rows.join(times, F.col(row) == F.col(taken))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
f AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2 AS remain,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS unfilled FROM w),
g AS (SELECT *, remain * weight >= source_size * 2 * unfilled AS filled FROM f),
l AS (SELECT max_by(remain, unfilled) AS remain, max(unfilled) AS unfilled FROM g WHERE NOT filled),
t AS (SELECT g.source, g.source_size, CASE WHEN filled THEN g.source_size::DOUBLE * 2 ELSE l.remain * weight / l.unfilled END AS target FROM g LEFT JOIN l ON true),
c AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS copies FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, floor(copies) AS sure, copies - floor(copies) AS p FROM c),
r AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank, target - sum(size * sure) OVER (PARTITION BY source) AS left_over FROM p),
o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r)
SELECT doc_id, size, source_size, target, (size * (sure + CASE WHEN rank IS NOT NULL AND before + size / 2 <= left_over THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""
