"""Byte-level BPE encoding and decoding.

Each match of the splitting pattern is merged by itself.  A segment tree over
its byte positions stores at every node the leftmost least pair rank below it,
so the root names the next merge; a merge changes the pair at its own position,
the pair before it and the pair it swallows, which are point updates up the
tree, each logarithmic in the length.  Short pieces of like size go through the
tree together, as rows of one array; long ones one by one.

Null texts count as empty; an empty text has no ids and decodes to no bytes.
Bytes that are no UTF-8 are read as replacement characters.  An empty table
gives an empty result.  Pieces of any length, repeated rows and further columns are fine: the result
holds the id column and the operator's own columns, a row for each input row.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidemark.llm.common import decoded, map_texts, trimmed

#: Distinct pieces a task remembers before it starts afresh; a bound on memory, without effect on results.
REMEMBERED = 400_000
#: Pieces longer than this are merged one at a time.
LONG = 256
NONE = np.int64(1 << 62)
POSITION_BITS = 31


class Vocabulary:
    """Tokens by rank, and which two tokens each token can be merged from."""

    def __init__(self, tokens: list[bytes]):
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for c, t in enumerate(tokens):
            for i in range(1, len(t)):
                a, b = self.rank.get(t[:i]), self.rank.get(t[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = c
        self.pairs = pairs
        self.codes = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[int(x)] for x in self.codes], dtype=np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, NONE where it doesn't."""
        code = a << 32 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.merged[at], NONE)


def read_tokens(path: str) -> list[bytes]:
    """Tokens in order of rank, from a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def merge_long(piece: bytes, v: Vocabulary) -> list[int]:
    """One piece by a segment tree of its own: node 1 is the root, the leaves start at `size`."""
    n = len(piece)
    ids = v.byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << max(1, (n - 1).bit_length())
    none, pairs = int(NONE), v.pairs
    tree = [none] * (2 * size)

    def key(i: int) -> int:
        rank = pairs.get(ids[i] << 32 | ids[after[i]]) if after[i] < n else None
        return none if rank is None else rank << POSITION_BITS | i

    def put(i: int, value: int) -> None:
        at = size + i
        tree[at] = value
        while at > 1:
            at >>= 1
            left, right = tree[2 * at], tree[2 * at + 1]
            least = left if left <= right else right
            if tree[at] == least:
                break
            tree[at] = least

    for i in range(n):
        tree[size + i] = key(i)
    for at in range(size - 1, 0, -1):
        tree[at] = min(tree[2 * at], tree[2 * at + 1])
    while tree[1] != none:
        rank, i = tree[1] >> POSITION_BITS, tree[1] & (1 << POSITION_BITS) - 1
        gone = after[i]
        ids[i], after[i] = rank, after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, key(i))
        if before[i] >= 0:
            put(before[i], key(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_many(pieces: list[bytes], size: int, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of up to `size` bytes (a power of two), a tree in each row: (ids in one array, count of each piece)."""
    w = len(pieces)
    n = np.fromiter(map(len, pieces), dtype=np.int64, count=w)
    column = np.arange(size)
    live = column < n[:, None]
    ids = np.zeros((w, size + 1), dtype=np.int64)
    ids[:, :size][live] = v.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    after = np.broadcast_to(np.arange(1, size + 2), (w, size + 1)).copy()
    before = np.broadcast_to(np.arange(-1, size), (w, size + 1)).copy()
    tree = np.full((w, 2 * size), NONE)
    paired = column[:-1] < n[:, None] - 1
    ranks = v.ranks_of(ids[:, : size - 1][paired], ids[:, 1:size][paired])
    keys = np.full((w, size - 1), NONE)
    keys[paired] = np.where(ranks == NONE, NONE, ranks << POSITION_BITS | np.nonzero(paired)[1])
    tree[:, size : 2 * size - 1] = keys
    at = size
    while at > 1:
        tree[:, at // 2 : at] = np.minimum(tree[:, at : 2 * at : 2], tree[:, at + 1 : 2 * at : 2])
        at //= 2

    flat = tree.ravel()

    def put(rows: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        base, at = rows * (2 * size), i + size
        flat[base + at] = value
        while len(at) and at[0] > 1:
            least = np.minimum(flat[base + at], flat[base + (at ^ 1)])
            at = at >> 1
            flat[base + at] = least

    def key(rows: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[rows, i]
        rank = np.where(j < n[rows], v.ranks_of(ids[rows, i], ids[rows, np.minimum(j, size)]), NONE)
        return np.where(rank == NONE, NONE, rank << POSITION_BITS | i)

    rows = np.arange(w)
    while len(rows := rows[tree[rows, 1] < NONE]):
        root = tree[rows, 1]
        rank, i = root >> POSITION_BITS, root & (1 << POSITION_BITS) - 1
        gone = after[rows, i]
        follow = after[rows, gone]
        ids[rows, i], after[rows, i] = rank, follow
        before[rows, np.minimum(follow, size)] = i
        live[rows, gone] = False
        put(rows, gone, np.full(len(rows), NONE))
        put(rows, i, key(rows, i))
        left = before[rows, i]
        has = left >= 0
        put(rows[has], left[has], key(rows[has], left[has]))
    return ids[:, :size][live], live.sum(axis=1)


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Encodes texts; remembers the ids of pieces seen before."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex

        self.v, self.split = Vocabulary(tokens), regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.at, self.starts, self.counts, self.flat, self.used = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    def learn(self, new: list[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        ids, counts, order = [], [], []
        for x, b in zip(new, map(str.encode, new), strict=True):
            if (whole := self.v.rank.get(b)) is not None:  # a piece that is a token needs no merges
                ids.append(np.array([whole]))
                counts.append(np.array([1]))
                order.append(x)
            elif len(b) > LONG:
                long = merge_long(b, self.v)
                ids.append(np.array(long))
                counts.append(np.array([len(long)]))
                order.append(x)
            else:
                by_size.setdefault((len(b) - 1).bit_length(), []).append((x, b))
        for bits, same in by_size.items():
            step = max(1, 200_000 >> bits)
            for k in range(0, len(same), step):
                part = same[k : k + step]
                got, count = merge_many([b for _, b in part], 1 << bits, self.v)
                ids.append(got)
                counts.append(count)
                order += [x for x, _ in part]
        if not order:
            return
        fresh, count = np.concatenate(ids).astype(np.int32), np.concatenate(counts)
        self.at.update(zip(order, range(len(self.counts), len(self.counts) + len(order)), strict=True))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(count) - count])
        self.counts = np.concatenate([self.counts, count])
        self.flat, self.used = np.concatenate([self.flat, fresh]), self.used + len(fresh)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        pieces: list[str] = []
        ends = []
        for x in texts:
            pieces += self.split(x)
            ends.append(len(pieces))
        new = set(pieces) - self.at.keys()
        if len(self.at) + len(new) > REMEMBERED:
            self.forget()
            new = set(pieces)
        self.learn(list(new))
        k = np.fromiter(map(self.at.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        counts = self.counts[k]
        ids = self.flat[gathered(self.starts[k], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])[np.array([0, *ends], dtype=np.int64)]
        return np.diff(upto), ids


def shared_tokens(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary for all tasks: a file of fixed size, under a megabyte for 50,000 tokens."""
    return spark.sparkContext.broadcast(read_tokens(path))


ENCODED = [("ids", "array<int>"), ("n_tokens", "bigint")]


def encoded_slices(tokens: Broadcast, pattern: str) -> Callable[[list[bytes]], list[pa.Array]]:
    """Encodes slices of texts into ENCODED's columns; the encoder is made where the first slice is."""
    made: list[Encoder] = []

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        if not made:
            made.append(Encoder(tokens.value, pattern))
        counts, ids = made[0](list(map(decoded, texts)))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return [pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(counts, pa.int64())]

    return per_slice


def encode(df: DataFrame, tokens: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_tokens long) of each row's text, without special tokens."""
    return map_texts(df, id_col, text_col, encoded_slices(tokens, pattern), ENCODED)


#: Ids that are decoded at a time, or those of one row.
DECODED = 250_000


class Decoder:
    """The bytes of ids, from all tokens' bytes in one array."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def parts(self, rows: pa.ListArray) -> Iterator[tuple[int, pa.Array]]:
        """(first row, bytes of each row) of parts of so many ids, or of one row; a null row has no bytes."""
        sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = (np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // DECODED)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            ids = rows.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
            lengths = self.lengths[ids]
            data = self.flat[gathered(self.starts[ids], lengths)]
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes[a:b])])].astype(np.int32)
            yield a, pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def decode(df: DataFrame, tokens: Broadcast, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with one more column, the bytes that the ids stand for; null ids give no bytes."""
    schema = StructType([*df.schema.fields, StructField(to, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(tokens.value)
        for batch in batches:
            for a, column in decoder.parts(batch.column(ids_col)):
                part = batch.slice(a, len(column))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, to])
        trimmed()

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, n_tokens, decoded) of each row: encode, then decode of its ids, by one worker."""
    tokens = shared_tokens(df.sparkSession, path)
    made: list[tuple[Callable[[list[bytes]], list[pa.Array]], Decoder]] = []

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        if not made:
            made.append((encoded_slices(tokens, pattern), Decoder(tokens.value)))
        of_slice, decoder = made[0]
        ids, counts = of_slice(texts)
        return [ids, counts, pa.concat_arrays([column for _, column in decoder.parts(ids)])]

    return map_texts(df, id_col, text_col, per_slice, [*ENCODED, ("decoded", "binary")])


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of round_trip's rows: counts and SHA-256 of the ids in decimal and of the decoded bytes."""
    return df.select(
        id_col,
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
