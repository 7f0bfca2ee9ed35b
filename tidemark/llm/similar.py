"""Documents whose sets of word shingles have a Jaccard similarity of at least a threshold, as connected components.

Candidates come from SimHash by deletion variants, as in simhash, for a
similarity at which far more bits differ than there: the fingerprint of a
shingle set has 3,072 bits, a bit being set if it is set in over half the
shingles' hashes.  At a similarity of 0.8 some 0.15 of the bits differ.  The
fingerprint is cut into pieces of 12 bits and these are dealt, three times over,
into segments of three.  A segment's variants leave one piece out; each is a
key, of segment, piece left out and the other bits.  Texts meet where a segment
differs within one piece only.  In a simulation at a similarity of 0.8 four
pairs in 60,000 met nowhere, and fewer above.  Among sets of at most five
shingles more bits differ, so these meet by a second kind of variant besides:
the set's hash, and those with one shingle left out.
Whatever meets is linked only if the shingle sets themselves, compared whole,
reach the threshold.

By the first segments' keys each text is compared with the nearest of its keys'
least rows (pivots), twice; what is linked forms groups.  Then all keys are
looked at, but only for texts that are in no group, or in different ones: two
lone texts are compared with each other, a lone text with all of a group that it
may be near to.  So a large group of copies takes about as many comparisons as
it has members, and joins by key give rows only for what may be alike.  Sizes
and the first words of the fingerprints tell most other texts apart before
their shingles are looked at: by each of these bounds at most one pair in a
million at 0.8 is missed.  Keys are made and joined a few segments at a time,
so that only what meets is on the disk.

A text of no more words than a shingle is one shingle of all its words, so
empty and null texts equal each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SENT_ROWS, map_texts, stored
from tidemark.llm.components import connected_components

#: Longs of a fingerprint, and bits of a piece.
WORDS, PIECE = 48, 12
PIECES = 64 * WORDS // PIECE
#: Segments of three pieces: so many deals of all pieces; the segments whose keys are joined at a time.
DEALS, AT_ONCE = 3, 32
#: Longs of the sketch (the fingerprint's first), and five standard deviations more of its bits than differ at a similarity on average.
SKETCH, DEVIATIONS = 16, 5
#: Sets of so few shingles have keys of their own.
FEW = 5
#: Rounds in which each row is compared with the nearest pivot that is not of its group yet.
ROUNDS = 2
#: Longs of the sketch that go with each key, as columns.
LONGS = [f"s{k}" for k in range(4)]
#: What a row is known to have met, so that later keys don't give it again: so many at most.  The rest is only given repeatedly.
SEEN = 256
FACTORS = np.random.default_rng(42).integers(0, 1 << 63, (2, WORDS), dtype=np.uint64)
FACTORS[1] |= np.uint64(1)


def segments() -> list[tuple[int, int, int]]:
    """The pieces of each segment, the same in every process."""
    order = np.random.default_rng(42)
    deals = (order.permutation(PIECES)[: PIECES // 3 * 3].reshape(-1, 3) for _ in range(DEALS))
    return [tuple(s) for s in np.concatenate(list(deals)).tolist()]


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """64-bit hashes of a text's shingles, repeats included; words as in simhash.fingerprint."""
    from xxhash import xxh64_intdigest

    split = text.lower().split()
    joined = b" ".join(split)
    if len(split) <= words:
        return np.array([xxh64_intdigest(joined)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts.tolist(), ends[words - 1 :].tolist(), strict=False)
    return np.array([xxh64_intdigest(joined[a:b]) for a, b in spans], dtype=np.uint64)


def fingerprint_bits(hashes: np.ndarray) -> np.ndarray:
    """The 64 * WORDS bits of a set of hashes: each hash gives WORDS longs, and a bit is set if it is in over half of them."""
    counts = np.zeros(64 * WORDS, dtype=np.int64)
    for k in range(0, len(hashes), 255):  # so many fit into a byte's sum
        mixed = (hashes[k : k + 255, None] ^ FACTORS[0]) * FACTORS[1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return (2 * counts > len(hashes)).astype(np.uint8)


def pieces_of(bits: np.ndarray) -> np.ndarray:
    """The fingerprint's pieces as numbers."""
    return (bits.reshape(PIECES, PIECE) @ (1 << np.arange(PIECE))).astype(np.int16)


def sketch_of(bits: np.ndarray) -> np.ndarray:
    """The first SKETCH longs of the fingerprint."""
    return np.packbits(bits[: 64 * SKETCH], bitorder="little").view(np.int64)


def few_keys(hashes: np.ndarray) -> list[int]:
    """For a set of few shingles, its hash and those with one of them left out; none for others."""
    if len(hashes) > FEW:
        return []
    whole = (hashes * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes >> np.uint64(29))
    left_out = whole.sum(dtype=np.uint64) - whole
    return np.concatenate([[whole.sum(dtype=np.uint64)], left_out[: len(hashes) if len(hashes) > 1 else 0]]).astype(np.uint64).view(np.int64).tolist()


def variant_keys(pieces: Column, cuts: list[tuple[int, int, int]], first: int = 0) -> Column:
    """Each segment's variants with one piece left out: the other two pieces, above them segment and piece left out; first is the first segment's number.

    One expression over a list of numbers: an expression for each key makes plans and code that fill the driver.
    """
    kept = [[i for k, i in enumerate(cut) if k != j] for cut in cuts for j in range(3)]
    variants = F.array(*(F.lit((3 * first + v) << 2 * PIECE | x << PIECE | y).cast("long") for v, (x, y) in enumerate(kept)))
    low = F.lit((1 << PIECE) - 1)
    piece = lambda at: F.get(pieces, at.bitwiseAND(low).cast("int")).cast("long")

    def key(variant: Column) -> Column:
        above = F.shiftleft(F.shiftright(variant, 2 * PIECE), 2 * PIECE)
        return above.bitwiseOR(F.shiftleft(piece(F.shiftright(variant, PIECE)), PIECE)).bitwiseOR(piece(variant))

    return F.transform(variants, key)


def differing_share(similarity: float) -> float:
    """The share of bits that differ between sets of one size with that similarity: their angle."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def sketch_limit(similarity: float, longs: int = SKETCH) -> int:
    """So many bits of a sketch of so many longs may differ."""
    share = differing_share(similarity)
    return int(np.ceil(64 * longs * share + DEVIATIONS * np.sqrt(64 * longs * share * (1 - share))))


def may_be_alike(a: str, b: str, similarity: float) -> Column:
    """Whether size and sketch of two texts, as structs, leave a chance of that similarity; for FEW shingles and one less the size alone."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = [F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(SKETCH)]
    near = [sum(differ[:n], F.lit(0)) <= sketch_limit(similarity, n) for n in (2, 8, SKETCH)]  # most fail at the first few
    few = (F.greatest(na, nb) == FEW) & (na != nb)
    return (F.least(na, nb) >= F.greatest(na, nb) * F.lit(similarity - 1e-9)) & (few | (near[0] & near[1] & near[2]))


def alike(a: str, b: str, similarity: float) -> Column:
    """Whether two sets, as arrays without repeats, have that Jaccard similarity; sizes alone tell many apart."""
    na, nb = F.size(a), F.size(b)
    least = F.ceil((na + nb) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))
    return (F.least(na, nb) >= least) & (F.size(F.array_intersect(a, b)) >= least)


def sent(df: DataFrame) -> DataFrame:
    """A stored table, sent to all tasks if it has few rows; else joined like any other."""
    return F.broadcast(df) if df.limit(SENT_ROWS + 1).count() <= SENT_ROWS else df


def of_different(met: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of met whose node and pivot are of different groups."""
    labelled = met.join(sent(groups), "node", "left").join(sent(groups).toDF("pivot", "of_pivot"), "pivot", "left")
    return labelled.where(F.coalesce("component", "node") != F.coalesce("of_pivot", "pivot"))


def bits_of(*longs: Column) -> Column:
    return sum((F.bit_count(x) for x in longs), F.lit(0))


def meetings(rows: DataFrame, limit: int) -> DataFrame:
    """(a, b, group) of (key, node, component, *LONGS, seen): what shares a key, no component (null: the row is alone), and differs in at most limit bits of LONGS.

    b is a node, or with group a component that the lone row a is to be compared
    with; of a component's rows in a key only the bits that all agree in are
    looked at, so that it is one row there.  What is in seen doesn't meet again.
    """
    rows = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in ("key", "node", *LONGS)))  # said here, all uses share one exchange
    side = lambda df, i: df.select("key", *(F.col(c).alias(f"{c}_{i}") for c in ("node", "component", *LONGS, "seen")))
    known = lambda i, what: F.coalesce(F.array_contains(f"seen_{i}", F.col(what)), F.lit(False))
    near = bits_of(*(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")) for c in LONGS)) <= limit
    ordered = F.col("node_a") < F.col("node_b")
    pair = [F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.lit(False).alias("group")]

    alone, grouped = rows.where("component IS NULL"), rows.where("component IS NOT NULL")
    lone = side(alone, "a").join(side(alone, "b").hint("shuffle_hash"), "key").where(ordered & near & ~known("a", "node_b") & ~known("b", "node_a")).select(*pair)
    spans = grouped.groupBy("key", "component").agg(*(f(c).alias(f"{c}_{n}") for c in LONGS for n, f in (("all", F.bit_and), ("any", F.bit_or))))
    outside = (F.col(f"{c}_a").bitwiseAND(F.bitwise_not(f"{c}_any")).bitwiseOR(F.bitwise_not(f"{c}_a").bitwiseAND(F.col(f"{c}_all"))) for c in LONGS)
    to_group = side(alone, "a").join(spans.hint("shuffle_hash"), "key").where((bits_of(*outside) <= limit) & ~known("a", "component"))
    mixed = grouped.join(open_keys(grouped, "component"), "key")
    between = side(mixed, "a").join(side(mixed, "b"), "key").where(ordered & near & (F.col("component_a") != F.col("component_b"))).select(*pair)
    return lone.union(between).union(to_group.select("node_a", "component", F.lit(True)))


def open_keys(rows: DataFrame, by: str) -> DataFrame:
    """The keys that hold more than one value of the column."""
    return rows.groupBy("key").agg(F.min(by).alias("least"), F.max(by).alias("most")).where("least <> most").select("key")


def with_pivots(rows: DataFrame, partitions: int) -> DataFrame:
    """(key, node, pivot, differ) of (key, node, *LONGS): all rows of a key but its pivot, and in how many bits of LONGS they differ from it.

    A key's rows only stream past its pivot, so that a common key is no more than its rows.
    """
    rows = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in ("key", "node", *LONGS))).repartition(partitions, "key")  # said here, both uses share one exchange
    of_pivot = [F.min_by(c, "node").alias(f"{c}_pivot") for c in LONGS]
    pivots = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), *of_pivot)
    met = rows.join(pivots.where("pivot <> last").drop("last").hint("shuffle_hash"), "key").where("node <> pivot")
    differ = bits_of(*(F.col(c).bitwiseXOR(F.col(f"{c}_pivot")) for c in LONGS))
    return met.select("key", "node", "pivot", differ.alias("differ"))


def similar_components(docs: DataFrame, node_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    """(node, component) of every row that is linked to another; node_col tells rows apart, a component is its least node."""

    fields = [("pieces", "array<smallint>"), ("few", "array<bigint>"), ("n", "bigint"), *((f"s{k}", "bigint") for k in range(SKETCH))]

    def fingerprints(texts: list[bytes]) -> list[pa.Array]:
        distinct = [np.unique(shingle_hashes(x, words)) for x in texts]
        bits = [fingerprint_bits(h) for h in distinct]
        sketches = np.array([sketch_of(x) for x in bits], dtype=np.int64).reshape(-1, SKETCH)
        keys = [pa.array([pieces_of(x) for x in bits], pa.list_(pa.int16())), pa.array([few_keys(h) for h in distinct], pa.list_(pa.int64()))]
        return [*keys, pa.array([len(h) for h in distinct], pa.int64()), *(pa.array(sketches[:, k]) for k in range(SKETCH))]

    def sets(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([np.unique(shingle_hashes(x, words)).view(np.int64).tolist() for x in texts], pa.list_(pa.int64()))]

    def shingles(nodes: DataFrame) -> DataFrame:
        """(node, shingles) of those rows, which may repeat."""
        nodes = stored(nodes.distinct().toDF(node_col), "nodes")
        of = docs.join(sent(nodes), node_col, "left_semi")
        return stored(map_texts(of, node_col, text_col, sets, [("shingles", "array<bigint>")]).withColumnRenamed(node_col, "node"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of (a, b) pairs, each given once, that are linked."""
        maybe = pairs.join(marks.toDF("a", "mark_a"), "a").join(marks.toDF("b", "mark_b"), "b")
        maybe = stored(maybe.where(may_be_alike("mark_a", "mark_b", similarity)).select("a", "b"), "pairs")
        of = shingles(maybe.select("a").union(maybe.select("b")))
        met = maybe.join(of.toDF("a", "of_a"), "a").join(of.toDF("b", "of_b"), "b")
        return met.where(alike("of_a", "of_b", similarity)).select("a", "b")

    def verified_in_groups(near: DataFrame, groups: DataFrame) -> DataFrame:
        """(a, b) links of the rows in (a, component), each given once, to rows of that component; pairs that aren't linked are no rows."""
        members = groups.join(near.select("component").distinct(), "component", "left_semi")
        of = shingles(near.select("a").union(members.select("node"))).join(marks, "node")
        # stored, so that both sides come straight from an exchange and Spark can split a large group
        left = stored(near.join(of.toDF("a", "of_a", "mark_a"), "a"), "lone")
        right = stored(members.join(of, "node").select("component", F.col("node").alias("b"), F.col("shingles").alias("of_b"), F.col("mark").alias("mark_b")), "members")
        return left.join(right, "component").where(may_be_alike("mark_a", "mark_b", similarity) & alike("of_a", "of_b", similarity)).select("a", "b")

    def keys(k: int) -> Column:
        """The keys of AT_ONCE segments, from the k-th on."""
        return F.explode(variant_keys(F.col("pieces"), cuts[k : k + AT_ONCE], k)).alias("key")

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keep = lambda df: stored(df, "links")
    cuts, limit = segments(), sketch_limit(similarity, len(LONGS))
    no_bits = [F.lit(0).cast("bigint").alias(c) for c in LONGS]  # keys of few shingles don't ask for bits
    marked = stored(map_texts(docs, node_col, text_col, fingerprints, fields).withColumnRenamed(node_col, "node"), "fingerprints")
    marks = marked.select("node", F.struct("n", *(f"s{k}" for k in range(SKETCH))).alias("mark"))
    by_few, by_first = marked.select("node", *no_bits, F.explode("few").alias("key")), marked.select("node", *LONGS, keys(0))
    met = stored(with_pivots(by_few, partitions).union(with_pivots(by_first, partitions)).where(F.col("differ") <= limit), "met")
    links = groups = None
    for _ in range(ROUNDS):
        apart = met if groups is None else of_different(met, groups)
        nearest = apart.groupBy("node").agg(F.min_by("pivot", F.struct("differ", "pivot")).alias("pivot"))
        found = verified(nearest.toDF("a", "b"))
        links = stored(found if links is None else found.union(links), "links")
        groups = stored(connected_components(links, keep), "groups")
    known = marked.select("node", "pieces", "few", *LONGS).join(sent(groups), "node", "left")
    columns = ["node", "component", *LONGS, "seen"]
    first = known.withColumn("seen", F.lit(None).cast("array<bigint>"))
    found = stored(meetings(first.select(*columns, keys(0)), limit).distinct(), "found")
    seen = found.groupBy(F.col("a").alias("node")).agg(F.slice(F.sort_array(F.collect_set("b")), 1, SEEN).alias("seen"))
    known = stored(known.join(seen, "node", "left"), "known")
    found = found.union(stored(meetings(known.select("node", "component", *no_bits, "seen", F.explode("few").alias("key")), limit), "found"))
    for k in range(AT_ONCE, len(cuts), AT_ONCE):
        found = found.union(stored(meetings(known.select(*columns, keys(k)), limit), "found"))
    found = stored(found.distinct(), "found")
    near = found.where("group").select("a", F.col("b").alias("component"))
    more = verified(found.where("NOT group").select("a", "b")).union(verified_in_groups(near, groups))
    return stored(connected_components(links.union(more), keep), "similar")
