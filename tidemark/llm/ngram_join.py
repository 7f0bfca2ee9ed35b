"""Documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, by a blocked sparse matrix product.

The incidence matrix has a row for each distinct set (documents with equal sets
share one) and a column for each n-gram, by its 64-bit hash.  Its product with
its own transpose holds all overlaps, but only entries that can reach the
threshold are made:

Which entries.  In any order of the columns, two sets that reach the threshold
share one of the first n - ceil(threshold * n) + 1 columns of each, a bound from
the sizes alone.  The order is by hash, with common columns last: a column that
more than HOT sets lead with is marked in a bitmap of fixed size, for all sets
alike, and the leading columns are taken anew.  So a passage or line that many
documents share brings no two of them together.

What an entry counts.  Columns fall into blocks by hash.  Each of 256 blocks (of
4,096 for large sets) has a bit that says whether a set has an odd number of its
columns; where these bits of two sets differ, a column is in one set alone, so a
pair with more differing bits than its sizes leave room for is discarded, and
one whose shared column stands too far back in either set is too.  What remains is multiplied block by
block (16 blocks): its overlap is at most the sum of the smaller block sizes, a
bound that gives way to each block's own overlap, until it falls below what the
sizes ask for or is the overlap itself.

Rows of a leading column are multiplied with one of them (the pivot) first, in
up to PIVOTS rounds with another one each, then those of different components
with each other.  The first pivot is the row whose parities are nearest to a few
rows drawn by hash, which near copies of one text make that text, wherever it is
among them; later ones are drawn.  So a large group of near copies takes as many
entries a round as it has members, and no link between components is lost.  Two
sets that share many leading columns meet in the first of each run of them: not
where one of the last BEFORE columns of both is the same.  A join's output rows
are pairs that no bound has discarded.

Null and empty texts have no n-gram and link with nothing.  A text of fewer
words than an n-gram has one, of all its words.  Rows that share an id, or have
none, are documents of their own; a component without any id has a null one.
Columns besides id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, noted, removed, slices, stored, text_bytes
from tidemark.llm.components import connected_components
from tidemark.llm.similar import open_keys

WORDS, THRESHOLD = 3, Fraction(9, 10)
#: A column that more sets than this lead with is common; rounds in which such columns are looked for.
HOT, ROUNDS = 32, 2
#: Bits of the map of common columns (2 MB) and of the map of documents whose sets are needed.
MAP_BITS = 24
#: Blocks of columns that are multiplied one by one, longs of the blocks that have a parity bit, pivots of a column.
BLOCKS, ODD, PIVOTS = 16, 4, 3
#: Rows of a column that are drawn to find the most central one.
DRAWS = 6
#: So many columns before a leading one are looked at for whether two sets have met already.
BEFORE = 8
#: Sets of more columns than this have so many longs of finer parities too.
LARGE, WIDE = 1000, 64
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
#: Words are hashed as polynomials over the long of each byte, modulo 2**64, in this base (odd, so that it has an inverse).
DRAWN = np.random.default_rng(42).integers(0, 1 << 63, 257, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
OF_BYTE, BASE = DRAWN[:256], int(DRAWN[256])
IN_WORD = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])


def word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of a text that ends in white space."""
    data = np.frombuffer(joined, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(IN_WORD[data].view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(OF_BYTE[data] * np.multiply.accumulate(np.full(len(data), BASE, dtype=np.uint64)), out=sums[1:])
    back = np.multiply.accumulate(np.full(len(data), pow(BASE, -1, 1 << 64), dtype=np.uint64))
    each = (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)
    return starts, (each ^ each >> np.uint64(32)) * MIX[1]


def gram_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct n-grams; bytes.lower() lowers A-Z alone."""
    joined = b" ".join(texts).lower() + b" "
    starts, each = word_hashes(joined)
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    runs = [joined_hashes(each, take) for take in range(1, words + 1)]
    sets = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        take = min(words, b - a)
        sets.append(np.unique(runs[take - 1][a : b - take + 1]) if take else np.zeros(0, dtype=np.uint64))
    return sets


def joined_hashes(each: np.ndarray, take: int) -> np.ndarray:
    """Hashes of every run of so many words."""
    h = np.full(max(0, len(each) - take + 1), take, dtype=np.uint64)
    for k in range(take):
        h = (h ^ each[k : k + len(h)]) * MIX[k % len(MIX)]
        h ^= h >> np.uint64(31)
    return h * MIX[0] ^ h >> np.uint64(29)


def leading(hashes: np.ndarray, threshold: Fraction, common: np.ndarray) -> np.ndarray:
    """The first columns of a set: those of which any set that reaches the threshold with it has one among its own."""
    n = len(hashes)
    take = n - -(-n * threshold.numerator // threshold.denominator) + 1
    if not n or not len(common):
        return hashes[:take]
    is_common = bit_of(common, hashes)
    return np.concatenate([hashes[~is_common], hashes[is_common]])[:take]


def parities(hashes: np.ndarray, longs: int = ODD) -> np.ndarray:
    """A bit for each of 64 blocks of columns a long: whether the set has an odd number of them."""
    counts = np.bincount((hashes >> np.uint64(8)).astype(np.int64) & (64 * longs - 1), minlength=64 * longs)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def bit_of(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(values: DataFrame) -> np.ndarray:
    """A map of fixed size with a bit for the upper bits of each long in the one column; ORed on the cluster, 512 pieces of 4 KB."""
    # bitmap_bucket_number counts from 1 for positive numbers
    bit = F.shiftrightunsigned(F.col(values.columns[0]), 64 - MAP_BITS) + F.lit(1)
    pieces = values.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    out = np.zeros((1 << MAP_BITS) // 8, dtype=np.uint8)
    for row in pieces.collect():
        out[(row.k - 1) * 4096 : row.k * 4096] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return out


def needed(a: Column, b: Column, threshold: Fraction) -> Column:
    """The least overlap of two sets of these sizes that reaches the threshold, in whole numbers."""
    up, down = threshold.numerator, threshold.numerator + threshold.denominator
    return F.floor((F.lit(up) * (a + b) + F.lit(down - 1)) / F.lit(down)).cast("bigint")


def sizes_allow(a: Column, b: Column, threshold: Fraction) -> Column:
    return F.least(a, b) * F.lit(threshold.denominator) >= F.greatest(a, b) * F.lit(threshold.numerator)


def overlap(a: str, b: str, least: Column) -> Column:
    """The overlap of two sets that are given as blocks, or -1 as soon as it can't reach the least one."""
    lesser = lambda k: F.least(F.size(F.get(a, k)), F.size(F.get(b, k)))
    bound = F.aggregate(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), F.lit(0), lambda s, k: s + lesser(k))

    def step(so_far: Column, k: Column) -> Column:
        exact = so_far - lesser(k) + F.size(F.array_intersect(F.get(a, k), F.get(b, k)))
        return F.when(so_far < least, F.lit(-1)).otherwise(exact)

    return F.aggregate(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), bound, step)


def may_link(a: str, b: str, threshold: Fraction) -> Column:
    """Whether sizes and parities of two structs (n, s0, s1, ...) leave a chance: each differing bit is a column that one set has alone."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return sizes_allow(na, nb, threshold) & (bits_apart(a, b) <= na + nb - 2 * needed(na, nb, threshold))


def large_may_link(na: Column, nb: Column, threshold: Fraction) -> Column:
    """The same by the finer parities of two large sets."""
    apart = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.coalesce(apart <= na + nb - 2 * needed(na, nb, threshold), F.lit(True))


def meets_first(a: str, b: str, na: Column, nb: Column, threshold: Fraction) -> Column:
    """Whether a column at these places of two sets may be the first they share: what comes from there on must suffice."""
    least = needed(na, nb, threshold)
    return (na - F.col(a) >= least) & (nb - F.col(b) >= least)


def list_column(parts: list[np.ndarray]) -> pa.Array:
    """A list of longs for each array, or null."""
    some = [p for p in parts if p is not None]
    ends = np.cumsum([0, *(0 if p is None else len(p) for p in parts)])
    values = np.concatenate(some).view(np.int64) if some else np.zeros(0, dtype=np.int64)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
    return lists if len(some) == len(parts) else pc.if_else(pa.array([p is not None for p in parts]), lists, None)


MARKS = ("n", *(f"s{k}" for k in range(ODD)))


def marked_sets(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: Fraction, common: np.ndarray) -> DataFrame:
    """(id, digest, lead, wide, n, parities) of each row: a digest of its set, the set's leading columns, its size and block parities."""

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        sets = gram_sets(texts, words)
        digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        lead, wide = ([f(s) for s in sets] for f in (lambda s: leading(s, threshold, common), lambda s: parities(s, WIDE) if len(s) > LARGE else None))
        odd = np.array([parities(s) for s in sets], dtype=np.int64).reshape(-1, ODD)
        marks = [np.fromiter(map(len, sets), dtype=np.int64, count=len(sets)), *odd.T]
        return [digests, list_column(lead), list_column(wide), *(pa.array(np.ascontiguousarray(m)) for m in marks)]

    fields = [("digest", "binary"), ("lead", "array<bigint>"), ("wide", "array<bigint>"), *((m, "bigint") for m in MARKS)]
    return map_texts(docs, id_col, text_col, per_slice, fields)


def blocked_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: np.ndarray) -> DataFrame:
    """(digest, blocks) of the rows whose id's hash has its bit in the map: all that are wanted, and a few others."""
    edges = np.arange(1, BLOCKS, dtype=np.uint64) << np.uint64(64 - (BLOCKS - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.filter(pa.array(bit_of(wanted, batch.column("id").to_numpy().view(np.uint64))))
            for part in slices(iter([held]), "text"):
                sets = gram_sets(text_bytes(part.column("text")), words)
                cells = list_column([b for s in sets for b in np.split(s, np.searchsorted(s, edges))])
                blocks = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BLOCKS, pa.int32()), cells)
                digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([digests, blocks], names=["digest", "blocks"])

    ids = docs.select(F.xxhash64(id_col).alias("id"), F.col(text_col).alias("text"))
    return ids.mapInArrow(run, "digest binary, blocks array<array<bigint>>")


def shared_columns(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(digest, id, sizes and parities) of each row, and (key, place, digest) of each leading column that more than one set leads with."""
    common, before = np.zeros(0, dtype=np.uint8), []
    for k in range(ROUNDS):
        made: list[str] = []
        with noted(made):
            marked = stored(marked_sets(docs, id_col, text_col, words, threshold, common).withColumnRenamed(id_col, "id"), "marked")
            rows = marked.where("n > 0").dropDuplicates(["digest"]).select(F.posexplode("lead").alias("place", "key"), "digest")
            sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "columns")
        removed(docs.sparkSession, before)
        before = made
        if k == ROUNDS - 1 or sizes.where(F.col("rows") > HOT).isEmpty():
            break
        common = bitmap(sizes.where(F.col("rows") > HOT).select("key"))
    return marked.drop("lead"), rows.join(sizes.select("key"), "key")


def joined_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(id, n_shingles, component_id) of each row; the component is named by its least id."""
    marked, rows = shared_columns(docs, id_col, text_col, words, threshold)
    marks = F.struct(*MARKS)
    classes = marked.where("n > 0").groupBy("digest").agg(F.min("id").alias("first"), F.min(marks).alias("mark"), F.min("wide").alias("wide"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows = stored(rows.join(classes, "digest").select("key", "place", "node", F.col("mark.n").alias("n")), "rows")
    keep = lambda df: stored(df, "links")

    def links(pairs: DataFrame) -> DataFrame:
        """(a, b) of those pairs whose overlap suffices; only the sets of their nodes are made."""
        wide = classes.select("node", "wide")
        pairs = pairs.distinct().join(wide.toDF("a", "wide_a"), "a").join(wide.toDF("b", "wide_b"), "b")
        pairs = stored(pairs.where(large_may_link(F.col("na"), F.col("nb"), threshold)).drop("wide_a", "wide_b"), "pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        met = stored(classes.join(nodes, "node", "left_semi").select("node", "digest", "first"), "met")
        sets = blocked_sets(docs, id_col, text_col, words, bitmap(met.select(F.xxhash64("first").alias("h")))).dropDuplicates(["digest"])
        sets = stored(sets.join(met, "digest").select("node", "blocks"), "sets")
        both = pairs.join(sets.toDF("a", "blocks_a"), "a").join(sets.toDF("b", "blocks_b"), "b")
        least = needed(F.col("na"), F.col("nb"), threshold)
        return keep(both.where(overlap("blocks_a", "blocks_b", least) >= least).select("a", "b"))

    open_rows, linked, known = rows.withColumn("component", F.col("node")), None, None
    for k in range(PIVOTS):
        found = links(pivot_pairs(open_rows, classes, threshold, k))
        if found.isEmpty():
            break
        linked = found if linked is None else linked.union(found)
        known = connected_components(linked, keep)
        open_rows = in_open_keys(rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")))
    found = links(other_pairs(open_rows, classes, threshold))
    if known is None or not found.isEmpty():
        known = connected_components(found if linked is None else linked.union(found), keep)
    labels = classes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = stored(labels.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    named = stored(labels.join(least, "component").select("digest", "component_id"), "named")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    return marked.join(named, "digest", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component)


def in_open_keys(rows: DataFrame) -> DataFrame:
    """The rows of keys that hold more than one component."""
    rows = stored(rows, "labelled")
    return stored(rows.join(stored(open_keys(rows, "component"), "keys"), "key"), "open")


def bits_apart(a: str | Column, b: str | Column) -> Column:
    """Parities that differ in two structs."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return sum((F.bit_count(a[f"s{k}"].bitwiseXOR(b[f"s{k}"])) for k in range(ODD)), F.lit(0))


def central(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows, with an order that puts each key's row first which differs least from some that are drawn."""
    held = stored(rows.join(classes.select("node", "mark"), "node"), "held")
    draws = [F.min(F.struct(F.xxhash64("node", F.lit(k)), "mark"))["mark"] for k in range(DRAWS)]
    drawn = stored(held.groupBy("key").agg(F.array(*draws).alias("drawn")), "drawn")
    far = F.aggregate("drawn", F.lit(0), lambda s, d: s + bits_apart("mark", d))
    return held.join(drawn, "key").withColumn("order", far).drop("mark", "drawn")


def pivot_pairs(rows: DataFrame, classes: DataFrame, threshold: Fraction, turn: int) -> DataFrame:
    """(a, b, na, nb) of each key's rows with its pivot, where they aren't in its component yet: the most central one, in later turns one by hash."""
    ordered = rows.withColumn("order", F.xxhash64("node", F.lit(turn))) if turn else central(rows, classes)
    first = ordered.groupBy("key").agg(F.min(F.struct("order", "node", "component", "n", "place")).alias("p"))
    first = stored(first.select("key", *(F.col(f"p.{c}").alias(f"{c}_b") for c in ("node", "component", "n", "place"))), "pivots")
    pairs = rows.join(first, "key").where(F.col("component") != F.col("component_b"))
    pairs = pairs.where(meets_first("place", "place_b", F.col("n"), F.col("n_b"), threshold)).select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
    marks = classes.select("node", "mark")
    met = pairs.join(marks.toDF("a", "mark_a"), "a").join(marks.toDF("b", "mark_b"), "b")
    return met.where(may_link("mark_a", "mark_b", threshold)).select("a", "b", F.col("mark_a.n").alias("na"), F.col("mark_b.n").alias("nb"))


def other_pairs(rows: DataFrame, classes: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b, na, nb) of rows that share a key and are in different components, where no bound discards them.

    The first column that two sets share has none before it that both have, so every pair meets there at least.
    """
    earlier = Window.partitionBy("node").orderBy("place").rowsBetween(-BEFORE, -1)
    rows = rows.select("key", "place", "node", "component", F.collect_list("key").over(earlier).alias("before"))
    held = rows.join(classes.select("node", "mark"), "node")
    # both sides come straight from an exchange, so that Spark can split a large key
    left, right = (held.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("place", "node", "component", "mark", "before"))) for x in "ab")
    apart = (F.col("component_a") < F.col("component_b")) & meets_first("place_a", "place_b", F.col("mark_a.n"), F.col("mark_b.n"), threshold)
    met = left.join(right, "key").where(apart & may_link("mark_a", "mark_b", threshold) & ~F.arrays_overlap("before_a", "before_b"))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("mark_a.n").alias("na"), F.col("mark_b.n").alias("nb"))
