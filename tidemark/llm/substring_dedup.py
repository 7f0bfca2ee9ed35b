"""Removal of repeated passages by fixed-block anchors.

Any window of 20 words holds a whole block of 10 words that starts at a
multiple of 10.  So each document's non-overlapping blocks are the index, every
rolling window of 10 words probes it, and a passage that occurs twice hits at
least once in each place.  Hits are then extended: all windows of 20 words
around a hit are compared, word for word by a wide hash, and where a window
also starts earlier its words go; together the windows of a place are its
maximal exact repeats.

Blocks and probes travel packed, some six bytes each: a slice of documents
sends each hash range one row with its entries.  What a slice can settle by
itself it doesn't send: a place whose block is indexed by another place of the
slice is a hit, and a window that also starts earlier in the slice is a repeat.
Of such a hash only the first entry is sent, so a range holds at most one entry
of a common passage for each slice that has it, however often it occurs.  Copies of whole documents are
known by their digest and not compared again.  What hits is decided per place,
never per pair of places.  Anchors are found by 32 bits of a hash and only
propose places; windows are compared by 128 bits of another.

Null texts have no words.  Places are ordered by id and start, null ids last.
Rows that share an id, or have none, are documents of their own, in an order
that is fixed once they are stored: of equal rows with one id one keeps its
words.  Bytes that are no UTF-8 are kept as they are.  Texts of any length are
whole; columns besides id and text are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, cut, fresh, located, map_texts, slices, stored, text_bytes

WINDOW, BLOCK = 20, 10
#: Words that one hash range holds.
RANGE_WORDS = 400_000
SLICE = 1_000_000
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


class Powers:
    """Powers of the hash's base and its inverse modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * SLICE)
            self.up, self.down = _powers(BASE, n), _powers(INVERSE, n)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)  # kept in 64 bits throughout: a mixed array would turn to floats
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def rolling_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of buffer[start:end]; equal bytes have equal hashes wherever they stand."""
    powers.reach(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(np.frombuffer(buffer, dtype=np.uint8) * powers.up[: len(buffer)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers.down[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_spans(docs: list[list[bytes]]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Of documents' words: all joined by spaces, each word's start and end in that, each document's number of words."""
    counts = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
    words = [w for d in docs for w in d]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words)]
    return b" ".join(words), starts, ends, counts


def small(values: np.ndarray) -> bytes:
    """A byte with the width, then the values in so many bytes each."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


LOW = np.uint64(0xFFFFFFFF)
#: 128 bits of a window's hash; the first half also says which range it belongs to.
WIDE = [("h", "<u8"), ("low", "<u8")]
PACKED = "p int, first bigint, ids binary, counts binary, places binary, hashes binary"


def ranges(hashes: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)


def packed(p: np.ndarray, ids: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """A row for each p: entries in order of id, as id steps, entries of each id, places and hashes (of any fixed width)."""
    order = np.lexsort((ids, p)) if len(ids) and (np.diff(ids) < 0).any() else np.argsort(p, kind="stable")
    p, ids, places, hashes = p[order], ids[order], places[order], hashes[order]
    rows: list[list] = [[] for _ in range(6)]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1, [len(p)]]) if len(p) else np.zeros(1, int)
    for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        at = np.concatenate([[0], np.flatnonzero(np.diff(ids[a:b])) + 1])
        own = ids[a:b][at]
        for column, x in zip(
            rows,
            (
                int(p[a]),
                int(own[0]),
                # steps fit in unsigned numbers, even from the least id to the largest
                small(np.diff(own.astype(np.uint64))),
                small(np.diff(np.concatenate([at, [b - a]]))),
                small(places[a:b]),
                hashes[a:b].tobytes(),
            ),
            strict=True,
        ):
            column.append(x)
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=["p", "first", "ids", "counts", "places", "hashes"])


def unpacked(table: pa.Table, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, places, hashes) of a hash range's rows."""
    ids, places, hashes = [], [], []
    for row in table.to_pylist():
        own = np.cumsum(np.concatenate([[row["first"]], large(row["ids"])]).astype(np.int64))
        ids.append(np.repeat(own, large(row["counts"])))
        places.append(large(row["places"]))
        hashes.append(np.frombuffer(row["hashes"], dtype=dtype))
    return np.concatenate(ids), np.concatenate(places), np.concatenate(hashes)


def with_settled(ids: np.ndarray, places: np.ndarray, hashes: np.ndarray, settled: np.ndarray, sent: np.ndarray, n_ranges: int) -> pa.RecordBatch:
    """Entries to send by hash range, and the settled places in ranges below 0, as many, by id."""
    p = np.concatenate([ranges(hashes["h"] if hashes.dtype.names else hashes, n_ranges)[sent], -1 - id_buckets(ids[settled], n_ranges)])
    both = np.concatenate([np.flatnonzero(sent), np.flatnonzero(settled)])
    kept = (hashes if hashes.dtype.names else hashes.astype("<u4"))[both]
    kept[int(sent.sum()) :] = np.zeros(1, kept.dtype)[0]  # nobody reads them, and zeros take no room in a shuffle file
    return packed(p, ids[both], places[both], kept)


def by_id(ids: np.ndarray, places: np.ndarray) -> pa.Table:
    """A row for each id with its places."""
    order = np.argsort(ids, kind="stable")
    ids, places = ids[order], places[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1]) if len(ids) else np.zeros(0, int)
    ends = np.concatenate([cuts[1:], [len(ids)]])[: len(cuts)]
    found = [small(places[a:b]) for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)]
    return pa.table({"id": pa.array(ids[cuts], pa.int64()), "found": pa.array(found, pa.binary())})


def id_buckets(ids: np.ndarray, n_buckets: int) -> np.ndarray:
    return ranges(ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), n_buckets)


def by_bucket(ids: np.ndarray, places: np.ndarray, n_buckets: int) -> pa.Table:
    """The places dealt by id: a row for each bucket, however many documents it holds."""
    return pa.Table.from_batches([packed(id_buckets(ids, n_buckets), ids, places, np.zeros(len(ids), dtype=np.uint8))])


def gathered(found: DataFrame) -> DataFrame:
    """(id, found) from rows of by_bucket, one for each id."""

    def gather(table: pa.Table) -> pa.Table:
        ids, places, _ = unpacked(table, "u1")
        return by_id(ids, places)

    return found.groupBy("p").applyInArrow(gather, "id bigint, found binary")


def anchors(rows: DataFrame, n_ranges: int, block: int) -> DataFrame:
    """(id, found) places of rolling windows that are also an index block elsewhere."""
    powers: list[Powers] = []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers[:] = powers or [Powers()]
        for part in slices(batches, "text", SLICE):
            ids = np.array(part.column("id").to_pylist(), dtype=np.int64)
            texts = text_bytes(part.column("text"))
            order = np.argsort(ids, kind="stable")
            buffer, starts, ends, counts = word_spans([texts[k].split() for k in order.tolist()])
            firsts = np.cumsum(counts) - counts
            place = np.arange(len(starts)) - np.repeat(firsts, counts)
            at = np.flatnonzero(place + block <= np.repeat(counts, counts))
            if len(at):
                h = rolling_hashes(buffer, starts[at], ends[at + block - 1], powers[0])
                own, place = np.repeat(ids[order], counts)[at], place[at]
                _, first, which = np.unique(h & LOW | ranges(h, n_ranges).astype(np.uint64) << np.uint64(32), return_index=True, return_inverse=True)
                indexed = place % block == 0
                held = np.bincount(which, weights=indexed, minlength=len(first))
                settled = held[which] > indexed
                # of a hash with settled places, an index entry stands for all
                stands = np.zeros(len(first), dtype=np.int64)
                stands[which[indexed][::-1]] = np.flatnonzero(indexed)[::-1]
                sent = ~settled
                sent[stands[np.unique(which[settled])]] = True
                yield with_settled(own, place, h, settled, sent, n_ranges)

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        ids, places, hashes = unpacked(table, "<u4")
        if key[0].as_py() < 0:
            return by_bucket(ids, places, n_ranges)
        indexed = places % block == 0
        index, held = np.unique(hashes[indexed], return_counts=True)
        k = np.minimum(np.searchsorted(index, hashes), max(len(index) - 1, 0))
        hit = (index[k] == hashes) & (held[k] > indexed) if len(index) else np.zeros(len(ids), bool)
        return by_bucket(ids[hit], places[hit], n_ranges)

    return gathered(rows.mapInArrow(pack, PACKED).groupBy("p").applyInArrow(probe, PACKED))


def repeats(rows: DataFrame, n_ranges: int, window: int, block: int) -> DataFrame:
    """(id, found) starts of windows that also start earlier, of rows (id, text, found) with the places of anchors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for part in slices(batches, "text", SLICE):
            ids, places, hashes = [], [], []
            found = part.column("found").to_pylist()
            for i, text, hits in zip(part.column("id").to_pylist(), text_bytes(part.column("text")), found, strict=True):
                words = text.split()
                n = len(words) - window + 1
                if n <= 0:
                    continue
                # a hit at h can stand in windows from h - (window - block) to h
                change = np.zeros(n + window + 1, dtype=np.int64)
                at = large(hits)
                at = at[at < n + window]
                np.add.at(change, np.maximum(at - (window - block), 0), 1)
                np.add.at(change, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(change)[:n] > 0)
                buffer, begins, ends, _ = word_spans([words])
                spans = zip(begins[starts].tolist(), ends[starts + window - 1].tolist(), strict=True)
                hashes += [xxh3_128_digest(buffer[a:b]) for a, b in spans]
                ids.append(np.full(len(starts), i, dtype=np.int64))
                places.append(starts)
            if hashes:
                own, place, h = np.concatenate(ids), np.concatenate(places), np.frombuffer(b"".join(hashes), dtype=WIDE)
                late = later_places(own, place, h)
                yield with_settled(own, place, h, late, ~late, n_ranges)

    def later(key: tuple, table: pa.Table) -> pa.Table:
        ids, places, hashes = unpacked(table, WIDE)
        late = later_places(ids, places, hashes) if key[0].as_py() >= 0 else np.ones(len(ids), dtype=bool)
        return by_bucket(ids[late], places[late], n_ranges)

    return gathered(rows.mapInArrow(pack, PACKED).groupBy("p").applyInArrow(later, PACKED))


def later_places(ids: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which places aren't the first of their hash."""
    order = np.lexsort((places, ids, hashes["low"], hashes["h"]))
    h = hashes[order]
    late = np.zeros(len(ids), dtype=bool)
    late[order[1:]] = (h["h"][1:] == h["h"][:-1]) & (h["low"][1:] == h["low"][:-1])
    return late


def documents_digests(rows: DataFrame) -> DataFrame:
    """(id, n_words, sha) with the SHA-256 of the words joined by one space."""

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        words = [x.split() for x in texts]
        return [pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary())]

    return map_texts(rows, "id", "text", per_slice, [("n_words", "bigint"), ("sha", "binary")])


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK, row_col: str | None = None
) -> DataFrame:
    """(id, n_words, n_removed, kept_text, kept_sha) of each row; row_col: a column that numbers the rows, which the result has too.

    kept_text has the kept words joined by one space, and is null where a row
    lost nothing and never came near a repeat; kept_sha is its SHA-256 always,
    but null where a whole document goes.
    """
    if not 0 < block <= (window + 1) // 2:
        raise ValueError("a window must hold a whole block wherever it starts")
    spark = docs.sparkSession
    rows, names = numbered(docs, id_col, text_col, row_col)
    whole = cut(documents_digests(rows))
    words = whole.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // RANGE_WORDS + 1)
    hits = stored(anchors(rows, n_ranges, block), "anchors")
    # a copy of a whole document goes whole, if it holds a window
    firsts = cut(whole.groupBy("sha").agg(F.min("id").alias("first")))  # so that Spark can split the join's large groups
    state = cut(whole.join(firsts, "sha").select("id", "n_words", "sha", (F.col("first") < F.col("id")).alias("copy")))
    compared = state.where(~F.col("copy")).select("id").distinct()
    hit = hits.join(compared, "id", "left_semi")
    touched = stored(rows.join(hit, "id"), "touched")
    late = stored(repeats(touched, n_ranges, window, block), "repeats").withColumnRenamed("found", "late")
    kept = touched.select("id", "text").join(late, "id", "left").mapInArrow(keep_words(window), f"id bigint, {RESULT}")
    others = state.join(touched.select("id").distinct(), "id", "left_anti")
    gone = F.col("copy") & (F.col("n_words") >= window)
    others = others.select(
        "id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(gone, F.lit("")).alias("kept_text"),
        F.when(~gone, F.col("sha")).alias("kept_sha"),
    )
    name = docs.schema[id_col].name
    found = kept.unionByName(others)
    found = found.withColumnRenamed("id", name) if names is None else found.join(names, "id").withColumnRenamed("own", name)
    out_row = [] if row_col is None else [F.col("row").alias(row_col)]
    return found.select(name, "n_words", "n_removed", "kept_text", "kept_sha", *out_row)


def numbered(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows, names): rows of (id, text) with an id of its own each, in the order of the given ids; names gives (id, own) the given id, None if that is the same."""
    plain = row_col is None and docs.where(F.col(id_col).isNull()).isEmpty() and docs.groupBy(id_col).count().where("count > 1").isEmpty()
    own = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"), *([F.col(row_col).alias("row")] if row_col else []))
    if plain:
        return own.select(F.col("own").alias("id"), "text"), None
    # numbers that rise from partition to partition, and within each
    rows = own.orderBy(F.col("own").asc_nulls_last(), *(["row"] if row_col else [F.xxhash64("text")])).withColumn("id", F.monotonically_increasing_id())
    rows = stored(rows, "numbered")
    return rows.select("id", "text"), rows.drop("text")


RESULT = "n_words bigint, n_removed bigint, kept_text string, kept_sha binary"


def keep_words(window: int):
    """Of rows (id, text, late) with the starts of repeated windows: what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            total, removed, kept = [], [], []
            for text, late in zip(text_bytes(part.column("text")), part.column("late").to_pylist(), strict=True):
                words = text.split()
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                if late:
                    at = large(late)
                    at = at[at < len(words)]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.minimum(at + window, len(words)), -1)
                stays = np.cumsum(cover)[: len(words)] == 0
                left = [words[k] for k in np.flatnonzero(stays).tolist()]
                total.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            columns = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), as_text(kept), pa.array([hashlib.sha256(x).digest() for x in kept], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", "n_words", "n_removed", "kept_text", "kept_sha"])

    return run


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with all their columns, the text without its repeats; a text that loses nothing stays as it is."""
    rows, row = located(docs)
    left = fresh(rows, "_kept")
    found = without_repeats(rows, id_col, text_col, row_col=row, **options).where("n_removed > 0").select(row, F.col("kept_text").alias(left))
    joined = rows.join(found, row, "left")
    return joined.select(*[F.coalesce(left, F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
