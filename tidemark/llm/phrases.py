"""Phrases that occur together more often than their parts would, by weighted acyclic automata.

First all runs of one to three words are counted by hash, to tell which can't
reach the least count: each task sends the hashes it has, packed by range, and
a bitmap of bounded size takes those whose sums do.  A hash that meets another
one there costs work and changes nothing.

Then each task collects its phrases whose runs are all in the map, sorts them,
and builds count automata from them, one for each language and prefix range (the
phrases whose first two words hash into it).  Automata of a range are united,
their weights summed, and what stays below the least count is dropped.  The
phrases that are left are exact.  A phrase's own beginnings lie in its automaton
but for the first word; that and the rests after each cut are asked of the
ranges they lie in: what is asked becomes an automaton, which is composed with
the range's counts.

Counts of any size: a task sends a phrase once, so a frequent one is as many
entries as there are tasks; ranges grow in number with the text.  Scores are
whole numbers, worked out in decimals.

Null texts count as empty, null languages as `und`.  Ids are not used, so
repeated rows count each time, and further columns are ignored.  A long text is
cut between pieces.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.automata import Automaton, composed, union
from tidemark.llm.common import as_text, slices, stored, text_bytes

LEAST, MOST_WORDS, TOP = 100, 5, 2000
#: Runs of so many words are counted by hash.
RUN = 3
#: Bytes of text that a range of phrases stands for, a range of hashes, and that a task handles at a time; phrases that a task holds before it sends them.
RANGE_BYTES, HASH_RANGE_BYTES, SLICE, HELD = 32 << 20, 6 << 20, 6 << 20, 1_000_000
#: Bits of a hash that are counted, and of the map at least and at most (128 MB).
HASH_BITS, LEAST_BITS, MOST_BITS = 40, 16, 30
#: What ends a piece, as one byte, and tabs as spaces.
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
WORD = r"[^\x20\x09-\x0D.,;:!?]+"
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hash of each word; 0 marks the end of a piece, 1 is no word."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
            self.update({b"\n": 0, b"": 1})
        self[word] = found = xxhash.xxh64_intdigest(word) | 2
        return found


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text, pieces ended by newlines; some of them empty."""
    return text.lower().translate(ENDS).replace(b"\n", b" \n ").split(b" ")


def cut_text(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    while len(text) > limit:
        part = text[:limit].translate(ENDS)
        at = part.rfind(b"\n") + 1 or text.translate(ENDS).find(b"\n") + 1 or len(text)
        yield text[:at]
        text = text[at:]
    yield text


def by_language(batch: pa.RecordBatch, known: Words, limit: int) -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
    """(language, words, their hashes) of the texts of a batch, with ends of pieces between texts."""
    held: dict[bytes, list[bytes]] = {}
    for lang, text in zip(text_bytes(batch.column("lang")), text_bytes(batch.column("text")), strict=True):
        for part in cut_text(text, limit):
            if len(text) > limit:
                yield lang, *hashed(tokens_of(part), known)
            else:
                held.setdefault(lang, []).extend(tokens_of(part))
                held[lang].append(b"\n")
    for lang, words in held.items():
        yield lang, *hashed(words, known)


def hashed(words: list[bytes], known: Words) -> tuple[list[bytes], np.ndarray]:
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    some = h != 1
    return ([w for w in words if w] if not some.all() else words), h[some]


def runs(lang: bytes, h: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash of the n words from each place on, whether they lie in one piece) for n = 1, 2, ..."""
    seed, inside = np.uint64(xxhash.xxh64_intdigest(lang)), h != 0
    run, whole = h ^ seed, inside
    for n in range(1, longest + 1):
        if n > 1:
            run, whole = run[:-1] ^ h[n - 1 :], whole[:-1] & inside[n - 1 :]
        run = run * MIX
        run = (run ^ run >> np.uint64(32)) * MIX
        yield run, whole
        if len(run) < 2:
            return


def packed(found: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes of HASH_BITS bits and counts of a byte, byte plane by byte plane, so that they compress."""
    planes = found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8].T
    return planes.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = HASH_BITS // 8
    planes = np.frombuffer(data, np.uint8).reshape(width + 1, -1)
    found = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    found[:, :width] = planes[:width].T
    return found.view("<u8").ravel(), planes[width].astype(np.int64)


def run_counts(docs: DataFrame, ranges: int, limit: int) -> DataFrame:
    """(range, data) of the hashes of runs of up to RUN words."""
    known = Words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, ranges, dtype=object) << HASH_BITS) // ranges
        for batch in batches:
            for part in slices(iter([batch]), "text", limit):
                seen = [r[w] >> np.uint64(64 - HASH_BITS) for lang, _, h in by_language(part, known, limit) for r, w in runs(lang, h, RUN)]
                found, counts = np.unique(np.concatenate(seen), return_counts=True)
                cuts = [0, *np.searchsorted(found, np.array(edges, dtype=np.uint64)).tolist(), len(found)]
                rows = {k: packed(found[a:b], counts[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b}
                yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array(list(rows.values()), pa.binary())], names=["range", "data"])

    return docs.mapInArrow(run, "range int, data binary")


def frequent_runs(packs: DataFrame, least: int) -> DataFrame:
    """(hash) of the runs whose counts sum to at least this much."""

    def run(rows: pa.Table) -> pa.Table:
        found, counts = (np.concatenate(x) for x in zip(*(unpacked(d.as_py()) for d in rows.column("data")), strict=True))
        order = np.argsort(found, kind="stable")
        found, counts = found[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        return pa.table({"hash": pa.array(found[starts][np.add.reduceat(counts, starts) >= least].astype(np.int64))})

    return packs.groupBy("range").applyInArrow(run, "hash bigint")


def map_of(hashes: DataFrame, most_bits: int = MOST_BITS) -> tuple[np.ndarray, int]:
    """A bitmap with a bit for each hash, and the number of the hash's upper bits that it goes by; 4 KB pieces are made on the cluster."""
    bits = min(most_bits, max(LEAST_BITS, int(16 * hashes.count()).bit_length()))
    at = F.shiftrightunsigned("hash", HASH_BITS - bits) + F.lit(1)  # bitmap_bucket_number counts from 1 for positive numbers
    pieces = hashes.select(at.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in pieces.collect():
        out[(row.k - 1) * 4096 : row.k * 4096] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return out, bits


def in_map(frequent: np.ndarray, bits: int, run: np.ndarray) -> np.ndarray:
    at = run >> np.uint64(64 - bits)
    return (frequent[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def prefix_range(phrase: tuple[bytes, ...], ranges: int) -> int:
    """Where a phrase's first two words hash to, as part_range says it in Spark."""
    h = xxhash.xxh64_intdigest(b" ".join(phrase[:2]), 42)
    return (h - (1 << 64) if h >> 63 else h) % ranges


def part_range(part: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.substring_index(part, " ", 2)), F.lit(ranges)).cast("int")


AUTOMATA = "lang string, range int, automaton binary"


def automata_batch(rows: list[tuple[bytes, int, Automaton]]) -> pa.RecordBatch:
    cells = [(x, k, a.to_bytes()) for x, k, a in rows]
    langs, places, data = (list(x) for x in zip(*cells, strict=True)) if cells else ([], [], [])
    return pa.RecordBatch.from_arrays([as_text(langs), pa.array(places, pa.int32()), pa.array(data, pa.binary())], names=["lang", "range", "automaton"])


def shard_automata(docs: DataFrame, frequent: np.ndarray, bits: int, ranges: int, longest: int, limit: int, held: int = HELD) -> DataFrame:
    """Automata of each task's phrases whose runs are all in the map."""
    known = Words()

    def phrases_in(lang: bytes, words: list[bytes], h: np.ndarray, counts: dict[tuple[bytes, ...], int]) -> None:
        for n, (run, whole) in enumerate(runs(lang, h, longest), 1):
            if n <= RUN:
                within = whole & in_map(frequent, bits, run)
            else:  # both runs of one word less
                within = whole & within[:-1] & within[1:]
            places = np.flatnonzero(within)
            if not len(places):
                if n >= RUN:
                    return
                continue
            _, first, times = np.unique(run[places], return_index=True, return_counts=True)
            for at, k in zip(places[first].tolist(), times.tolist(), strict=True):
                phrase = tuple(words[at : at + n])
                counts[phrase] = counts.get(phrase, 0) + k

    def batch_of(all_counts: dict[bytes, dict[tuple[bytes, ...], int]]) -> pa.RecordBatch:
        rows = []
        for lang, counts in all_counts.items():
            dealt: dict[int, list[tuple[bytes, ...]]] = {}
            for phrase in counts:
                dealt.setdefault(prefix_range(phrase, ranges), []).append(phrase)
            rows += [(lang, k, Automaton.of((p, counts[p]) for p in sorted(mine))) for k, mine in dealt.items()]
        return automata_batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, dict[tuple[bytes, ...], int]] = {}
        for batch in batches:
            for part in slices(iter([batch]), "text", limit):
                for lang, words, h in by_language(part, known, limit):
                    phrases_in(lang, words, h, found.setdefault(lang, {}))
                if sum(map(len, found.values())) > held:
                    yield batch_of(found)
                    found = {}
        yield batch_of(found)

    return docs.mapInArrow(run, AUTOMATA)


def united(shards: DataFrame, least: int) -> DataFrame:
    """One automaton for each language and range, of the phrases that reach the least count."""

    def run(rows: pa.Table) -> pa.Table:
        lang, at = rows.column("lang")[0].cast(pa.binary()).as_py(), rows.column("range")[0].as_py()
        made = union([Automaton.from_bytes(x.as_py()) for x in rows.column("automaton")], least)
        return pa.Table.from_batches([automata_batch([(lang, at, made)] if made.weights else [])])

    return shards.groupBy("lang", "range").applyInArrow(run, AUTOMATA)


def candidates(automata: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, lefts) of all phrases of two words or more; lefts are the counts of their first two, three, ... words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lang, way = batch.column("lang").slice(k, 1), [0] * 64
                rows = []
                # in order, so a phrase's beginnings are the last ones of their lengths; whatever reaches the least count has them
                for phrase, n in Automaton.from_bytes(batch.column("automaton")[k].as_py()):
                    way[len(phrase)] = n
                    if len(phrase) > 1:
                        rows.append((b" ".join(phrase), len(phrase), n, way[2 : len(phrase)]))
                if rows:
                    phrases, sizes, counts, lefts = (list(x) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([lang] * len(rows)), as_text(phrases), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64()), pa.array(lefts, pa.list_(pa.int64()))],
                        names=["lang", "phrase", "size", "a", "lefts"],
                    )

    return automata.mapInArrow(run, "lang string, phrase string, size int, a bigint, lefts array<bigint>")


def answered(asked: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """(lang, part, f) of the parts (lang, part) that are asked for, each once: their automaton composed with their range's."""

    def run(wanted: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if wanted.num_rows and held.num_rows:
            parts = sorted({tuple(x.split(b" ")) for x in text_bytes(wanted.column("part").combine_chunks())})
            found = list(composed(Automaton.of((p, 1) for p in parts), Automaton.from_bytes(held.column("automaton")[0].as_py())))
        lang = wanted.column("lang").combine_chunks()[:1] if found else None
        langs = pa.concat_arrays([lang] * len(found)) if found else pa.array([], pa.string())
        return pa.table({"lang": langs, "part": as_text([b" ".join(p) for p, _ in found]), "f": pa.array([n for _, n in found], pa.int64())})

    by = ("lang", "range")
    wanted = asked.distinct().withColumn("range", part_range(F.col("part"), ranges))
    return wanted.groupBy(*by).cogroup(automata.groupBy(*by)).applyInArrow(run, "lang string, part string, f bigint")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = MOST_WORDS, top: int = TOP, range_bytes: int = RANGE_BYTES, hash_range_bytes: int = HASH_RANGE_BYTES, limit: int = SLICE, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first phrases by score."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 + size // range_bytes
    frequent, bits = map_of(stored(frequent_runs(run_counts(texts, 1 + size // hash_range_bytes, limit), least), "frequent"), most_bits)
    totals = texts.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD))).cast("long").alias("n"))
    automata = stored(united(shard_automata(texts, frequent, bits, ranges, longest, limit), least), "automata")
    found = stored(candidates(automata), "candidates")
    # the first word, then the rest after each cut
    words = lambda n: F.call_function("substring_index", F.col("phrase"), F.lit(" "), n)
    rests = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: words(k - F.col("size")))
    parts = found.select("lang", "phrase", F.posexplode(F.concat(F.array(words(F.lit(1))), rests)).alias("k", "part"))
    answers = stored(answered(parts.select("lang", "part"), automata, ranges), "answers")
    of = [F.max(F.when(F.col("k") == k, F.col("f"))).alias(f"f{k}") for k in range(longest)]
    known = parts.join(answers, ["lang", "part"]).groupBy("lang", "phrase").agg(*of)
    inner = found.where("size > 2").select("lang", F.explode(F.array(words(F.col("size") - 1), words(1 - F.col("size")))).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    rows = found.join(known, ["lang", "phrase"]).join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").join(totals, "lang")
    big = lambda c: c.cast("decimal(19,0)")
    cuts = []
    for k in range(1, longest):
        left, right = F.col("f0") if k == 1 else F.get("lefts", F.lit(k - 2)), F.col(f"f{k}")
        score = F.call_function("div", F.lit(1000) * big(F.col("a")) * big(F.col("n")), big(left) * big(right)).cast("long")
        cuts.append(F.when(F.lit(k) < F.col("size"), F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))))
    best = F.array_min(F.array_compact(F.array(*cuts)))
    scored = rows.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
