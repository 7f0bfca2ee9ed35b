"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint bit is set if it is set in over half the shingles' hashes.  To
find fingerprints that differ in at most `distance` bits, they are cut into so
few segments that one of these differs by at most one bit (three for four
bits).  Each segment's variants with one bit as wildcard are indexed, keyed by
segment, wildcard and the other bits; fingerprints that may be near meet in an
equality join on these keys and are verified by their full difference.

Equal fingerprints are one row from the start.  First, fingerprints near to the
least one of a key (the pivot) are linked to it, so a large group of near
copies gives as many links as it has members, not all its pairs.  Then those of
different components are compared, and linked where they meet first.  The
classes are those of all links: none between different texts is lost.  No key
is gathered in one task: pivots are aggregates, and Spark splits the large
partitions of the joins.

Four bits of 64 stand for texts that are almost equal; at a similarity of 0.8
of five-word shingles about ten bits differ, too many to tell texts apart by.
For such a similarity (one_of_each, the pipeline) longer fingerprints meet by
variants that leave out a piece of several bits, and rows are linked by their
shingles themselves: see similar.

Null and empty texts have no words, fingerprint zero, and are linked like any
other.  Repeated rows share fingerprint and class.  A null id names no class: one
whose rows have no ids at all has a null name.  Columns besides id and text
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, located, map_texts, without
from tidemark.llm.components import connected_components
from tidemark.llm.similar import similar_components

SHINGLE_WORDS, DISTANCE, SEED, BITS = 4, 4, 42, 64
#: Copies of documents: a Jaccard similarity of 0.8 or more of the sets of five-word shingles.
SIMILAR = {"shingle_words": 5, "similarity": 0.8}


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint as a signed long. bytes.lower() lowers A-Z alone, bytes.split() cuts at ASCII white space."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts.tolist(), ends[shingle_words - 1 :].tolist(), strict=False)
        hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in spans]
    counts = np.zeros(BITS, dtype=np.int64)
    every = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    for k in range(0, len(every), 1 << 16):
        counts += np.unpackbits(every[k : k + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp long) of each row."""

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([fingerprint(x, shingle_words, seed) for x in texts], pa.int64())]

    return map_texts(docs, id_col, text_col, per_slice, [("fp", "bigint")])


def keyed(fps: DataFrame, cuts: list[tuple[int, int]], *columns: str) -> DataFrame:
    """Columns of each fingerprint once for each of its keys."""
    return fps.select(*columns, F.explode(variant_keys(F.col("fp"), cuts)).alias("key"))


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs by at most one bit: distance < 2 * segments."""
    m = distance // 2 + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variant_keys(fp: Column, cuts: list[tuple[int, int]]) -> Column:
    """Every one-wildcard variant of every segment: the segment's other bits, with segment and wildcard in the low bits."""
    keys = []
    for s, (low, width) in enumerate(cuts):
        rest = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
        for j in range(width):
            masked = rest.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << j)))
            keys.append(F.shiftleft(masked, 12).bitwiseOR(F.lit(s << 6 | j)))
    return F.array(*keys)


def first_meeting(x: Column, cuts: list[tuple[int, int]]) -> Column:
    """Segment and wildcard of the first key where two fingerprints with difference x meet."""
    found = F.lit(None).cast("int")
    for s, (low, width) in reversed(list(enumerate(cuts))):
        part = F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << width) - 1))
        # a single differing bit must be the wildcard; with none, the first wildcard is the one that counts
        at = F.when(part == 0, F.lit(0)).otherwise(F.bit_count(part - 1))
        found = F.when(F.bit_count(part) <= 1, at.bitwiseOR(F.lit(s << 6))).otherwise(found)
    return found


def apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def pivot_links(fps: DataFrame, cuts: list[tuple[int, int]], distance: int) -> DataFrame:
    """(a, b) links from fingerprints to the least one of a key they share, if that is near."""
    rows = keyed(fps, cuts, "fp")
    pivots = rows.groupBy("key").agg(F.min("fp").alias("pivot"))
    near = rows.join(pivots, (rows["key"] == pivots["key"]) & (F.col("fp") != F.col("pivot")) & (apart("fp", "pivot") <= distance))
    return near.select(F.col("fp").alias("a"), F.col("pivot").alias("b"))


def other_links(rows: DataFrame, cuts: list[tuple[int, int]], distance: int) -> DataFrame:
    """(a, b) links of components that hold near fingerprints, of (key, fp, component); each pair of fingerprints meets once."""
    left, right = (rows.select(F.col("key").alias(f"key_{x}"), F.col("fp").alias(x), F.col("component").alias(f"component_{x}")) for x in "ab")
    met = (
        (F.col("key_a") == F.col("key_b"))
        & (F.col("a") < F.col("b"))
        & (F.col("component_a") != F.col("component_b"))
        & (apart("a", "b") <= distance)
        & (F.col("key_a").bitwiseAND(F.lit(4095)) == first_meeting(F.col("a").bitwiseXOR(F.col("b")), cuts))
    )
    return left.join(right, met).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))


def components(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component) of distinct fingerprints; the component is its least fingerprint.

    First all are linked to pivots.  Then only fingerprints of different
    components are compared, so pairs within a large group are never made.
    """
    cuts = segments(distance)
    stars = connected_components(pivot_links(fps, cuts, distance))
    known = cut(fps.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")).repartition(spread(fps)))
    larger = connected_components(other_links(keyed(known, cuts, "fp", "component"), cuts, distance)).toDF("component", "larger")
    return known.join(larger, "component", "left").select("fp", F.coalesce("larger", "component").alias("component"))


def spread(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    seed: int = SEED,
    similarity: float | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id) of each row; the component is named by its least id.

    similarity: rows are linked where their shingle sets have this Jaccard
    similarity or more, whatever bits their fingerprints differ in.
    """
    code = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    if similarity is not None:
        rows, row = located(docs.select(id_col, text_col))
        named = cut(grouped(rows, row, id_col, text_col, shingle_words, similarity))
        least = named.groupBy("component").agg(F.min(id_col).alias("component_id"))
        codes = fingerprints(rows, row, text_col, shingle_words, seed).join(named, row).select(id_col, code, "component")
        return codes.join(least, "component").select(id_col, "fingerprint", "component_id")
    marked = cut(fingerprints(docs, id_col, text_col, shingle_words, seed))
    first = cut(marked.groupBy("fp").agg(F.min(id_col).alias("first")).repartition(spread(docs)))
    labels = cut(components(first.select("fp"), distance))
    least = labels.join(first, "fp").groupBy("component").agg(F.min("first").alias("component_id"))
    named = labels.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(id_col, code, "component_id")


def grouped(rows: DataFrame, row: str, id_col: str, text_col: str, shingle_words: int, similarity: float) -> DataFrame:
    """(row, id, component) of each row, the component by similarity."""
    linked = similar_components(rows, row, text_col, shingle_words, similarity).withColumnRenamed("node", row)
    return rows.select(row, id_col).join(linked, row, "left").withColumn("component", F.coalesce("component", row))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The row with the least id of each component of similar rows, with all columns; null ids come last, of rows that repeat the least id one stays."""
    rows, row = located(docs)
    linked = similar_components(rows, row, text_col, shingle_words, similarity).withColumnRenamed("node", "_node")
    marked = cut(rows.select(F.col(row).alias("_node"), F.col(id_col).alias("_id")).join(linked, "_node"))
    stays = cut(marked.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_node"))["_node"].alias("_stays")))  # so that Spark can split the join
    gone = marked.join(stays, "component").where("_node <> _stays").select("_node")
    return without(rows, gone, row).drop(row)
