"""Conversations repaired to the role grammar (s?(ua)+)? by the cheapest edits, with a graph-structured stack.

A stack top is a state of the grammar after some rows: nothing yet, or what was
last put out (system, user or assistant).  Each row extends every top by all
actions that the grammar allows there: inserting messages before the row, then
keeping, reroling or deleting it.  Tops of one state merge into the one with the
least (cost, audit); its node keeps a link to the top it came from, so paths
share what they have in common.  Inserts stand before a row or at the end, hence
two audits of one cost never have one at the front of the other: tops compare by
their parents' order, then by the new letters, and audits are never copied.

Rows are dealt by range of conversation and turn, so that a conversation of any
size is spread over tasks.  A conversation that lies whole in a task is repaired
there.  One that meets an end of a task's rows, or is long, is cut into pieces:
each is run once from every state that it may be entered in, which gives a matrix
of costs and of its audits' ranks.  Matrices of a conversation, a few numbers a
piece, are multiplied in order; then each piece is repaired by itself on the way
found, and the texts are hashed in order as a stream.

Nulls: a null role or text is one space, a null turn comes before all others
and is a space in the damage's key, as a null conversation id is; rows without
one are one conversation.  Rows of one turn come by role, then text.  Repeated
rows are duplicates of the first and are counted before they are dealt.  Empty
tables give empty results; further columns are ignored; a gap count that a long
can't hold is the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored

#: Fixed values of the contract: costs of edits and of a truncated message that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of the grammar: nothing yet, then what was put out last.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: b"user", ASSISTANT: b"assistant"}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = (b"su", b"ua", b"au")
#: What a row's first fault is, and rows and bytes of a piece at most.
GOOD, BLANK, DUPLICATE, CUT = range(4)
PIECE_ROWS, PIECE_BYTES = 2048, 4 << 20
SPACE = b" \t\n\x0b\x0c\r"
LONGEST = (1 << 63) - 1


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after damage, equal rows as one; a row that is dropped leaves one without copies, so that its conversation stays known."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    gone = kind == 0
    rows = conversations.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(gone | (kind == 1), "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Damaged rows in order, dealt by range, with whether their role and text have occurred earlier in the conversation."""
    rows = stored(rows.withColumn("same", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))), "damaged")
    by, turn = ["conv_id", "same"], F.struct(F.col("turn").isNotNull(), "turn")
    again = rows.where("copies > 0").groupBy(*by).agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = stored(again.select(F.col("conv_id").alias("of"), F.col("same").alias("like"), "first"), "again")
    met = rows.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("like")), "left")
    later = F.coalesce(turn > F.col("first"), F.lit(False))
    out = stored(met.select("conv_id", "turn", "role", "text", "copies", later.alias("later")), "marked")
    # long texts with one beginning stay in one task; the sample that ranges are taken from stays small
    return out.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")


class Piece:
    """Consecutive rows of a conversation: (role, text, fault, copies of it that follow), and their counts."""

    def __init__(self, key, start: bool) -> None:
        self.key, self.start, self.rows, self.size = key, start, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = b""
        self.low = self.high = None

    def add(self, turn: int | None, role: bytes, text: bytes, copies: int, later: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        said = text.strip(SPACE)
        fault = BLANK if not said else DUPLICATE if later else CUT if said[-1:] not in b".!?" else GOOD
        self.blank += copies if fault == BLANK else 0
        self.duplicate += copies if fault == DUPLICATE else 0 if fault == BLANK else copies - 1
        self.truncated += fault == CUT
        initial = role[:1]
        self.illegal += copies - 1 + (bool(self.rows) and self.last + initial not in LEGAL)
        self.first, self.last = (self.first if self.rows else initial), initial
        self.rows.append((role, text, fault, copies - 1))
        self.size += len(text)


def stack_run(rows: list[tuple], entry: int) -> dict[int, tuple]:
    """Tops after these rows by state: (cost, rank among the tops, node), a node being (parent, letters, messages)."""
    tops = {entry: (0, 0, None)}
    for role, text, fault, more in rows:
        found: dict[int, tuple] = {}
        stays = 0 if fault == GOOD else TRUNCATED
        after = b"D" * more
        for state, (cost, rank, node) in tops.items():
            put: tuple = ()
            for inserts in range(3):
                if inserts:
                    state = NEXT[state]
                    put += (ROLES[state] + b":",)
                here = cost + inserts * INSERT + more * DELETE
                ways = [(here + DELETE, b"D", state, put)]
                if fault in (GOOD, CUT):
                    to = NEXT[state]
                    ways.append((here + stays + REROLE, b"R", to, (*put, ROLES[to] + b":" + text)))
                    initial = role[:1]
                    if initial == b"s" and state == START:
                        ways.append((here + stays, b"K", SYSTEM, (*put, role + b":" + text)))
                    elif initial == ROLES[to][:1]:
                        ways.append((here + stays, b"K", to, (*put, role + b":" + text)))
                for total, letter, to, messages in ways:
                    way = (total, rank, b"I" * inserts + letter + after)
                    if to not in found or way < found[to][0]:
                        found[to] = (way, node, messages)
        order = sorted(found, key=lambda s: found[s][0][1:])
        tops = {s: (found[s][0][0], k, (found[s][1], found[s][0][2], found[s][2])) for k, s in enumerate(order)}
    return tops


def ended(tops: dict[int, tuple]) -> tuple[int, int, int]:
    """(cost, state, inserts) of the best top, with the messages that are still to come."""
    ways = []
    for state, (cost, rank, _) in tops.items():
        inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
        ways.append((cost + inserts * INSERT, rank, inserts, state))
    cost, _, inserts, state = min(ways)
    return cost, state, inserts


def tail(state: int, inserts: int) -> list[bytes]:
    out = []
    for _ in range(inserts):
        state = NEXT[state]
        out.append(ROLES[state] + b":")
    return out


def path(node: tuple | None) -> tuple[bytes, list[bytes]]:
    """Letters and messages of the way to a node."""
    letters, messages = [], []
    while node is not None:
        node, step, put = node
        letters.append(step)
        messages.append(put)
    return b"".join(reversed(letters)), [m for put in reversed(messages) for m in put]


COUNTS = ("blank", "duplicate", "truncated", "illegal")
SCHEMA = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string, part int, piece int, first binary, last binary,"
    " low bigint, high bigint, turns bigint, costs array<bigint>, ranks array<int>, roles array<binary>, texts array<binary>, faults array<int>, more array<bigint>"
)
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, LONGEST)


def whole(p: Piece) -> dict:
    """The result row of a conversation that is one piece."""
    tops = stack_run(p.rows, START)
    cost, state, inserts = ended(tops)
    letters, messages = path(tops[state][2])
    said = b"\n".join(messages + tail(state, inserts))
    return {
        "gaps": gaps(p.low, p.high, p.turns), **{c: getattr(p, c) for c in COUNTS}, "cost": cost,
        "audit": (letters + b"I" * inserts).decode(), "repaired_sha256": hashlib.sha256(said).hexdigest(),
    }


def matrix(p: Piece) -> tuple[list[int], list[int]]:
    """Cost, and rank of the audit among all of them, from each state to each; -1 where there's no way."""
    costs, audits = [-1] * 16, {}
    for entry in (START,) if p.start else range(4):
        for state, (cost, _, node) in stack_run(p.rows, entry).items():
            costs[4 * entry + state] = cost
            audits[4 * entry + state] = path(node)[0]
    order = {a: k for k, a in enumerate(sorted(set(audits.values())))}
    return costs, [order[audits[k]] if k in audits else -1 for k in range(16)]


def part_of(p: Piece, part: int, number: int) -> dict:
    costs, ranks = matrix(p)
    cells = {"part": part, "piece": number, "first": p.first, "last": p.last, "low": p.low, "high": p.high, "turns": p.turns, "costs": costs, "ranks": ranks}
    roles, texts, faults, more = (list(x) for x in zip(*p.rows, strict=True)) if p.rows else ([], [], [], [])
    return {c: getattr(p, c) for c in COUNTS} | cells | {"roles": roles, "texts": texts, "faults": faults, "more": more}


def repaired_parts(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Result rows of conversations that lie whole in a task, and the pieces (part not null) of all others."""
    kind = rows.schema["conv_id"].dataType
    fields = [f.split() for f in SCHEMA.split(", ")]
    arrow = {n: ARROW[k] for n, k in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, out, key_type = TaskContext.get().partitionId(), 0, None, [], None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            keys = pa.array([k for k, _ in found], key_type)
            return pa.RecordBatch.from_arrays([keys, *(pa.array([r.get(n) for _, r in found], t) for n, t in arrow.items())], names=["conv_id", *arrow])

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for one in slices(iter([batch]), "text"):
                columns = [one.column(c) if c in ("conv_id", "turn", "copies", "later") else one.column(c).cast(pa.binary()) for c in ("conv_id", "turn", "role", "text", "copies", "later")]
                for key, turn, role, text, copies, later in zip(*(c.to_pylist() for c in columns), strict=True):
                    if held is None or held.key != key:
                        if held is not None:
                            out.append((held.key, whole(held) if held.start else part_of(held, part, number)))
                        # the first conversation of a task may have begun in an earlier one
                        number, held = number + 1, Piece(key, held is not None)
                    elif len(held.rows) >= piece_rows or held.size > PIECE_BYTES:
                        out.append((held.key, part_of(held, part, number)))
                        number, held = number + 1, Piece(key, False)
                    if copies:
                        held.add(turn, role, text, copies, later)
                if out:
                    yield batch_of(out)
                    out = []
        if held is not None:
            yield batch_of([(held.key, part_of(held, part, number))])

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, {SCHEMA}")


def ways_through(pieces: pa.Table) -> pa.Table:
    """One conversation's pieces with the states that they are entered and left in, and the conversation's counts in the row of the first."""
    rows = sorted(pieces.to_pylist(), key=lambda r: (r["part"], r["piece"]))
    tops, back = {START: (0, 0)}, []
    for r in rows:
        ways = {}
        for entry, (cost, rank) in tops.items():
            for to in range(4):
                k = 4 * entry + to
                if r["costs"][k] >= 0:
                    way = (cost + r["costs"][k], rank, r["ranks"][k], entry)
                    ways[to] = min(ways.get(to, way), way)
        order = sorted(ways, key=lambda s: ways[s][1:3])
        back.append({s: ways[s][3] for s in ways})
        tops = {s: (ways[s][0], k) for k, s in enumerate(order)}
    cost, state, inserts = ended({s: (*t, None) for s, t in tops.items()})
    through = []
    for k in range(len(rows) - 1, -1, -1):
        through.append((back[k][state], state))
        state = back[k][state]
    through.reverse()
    sums = {c: sum(r[c] for r in rows) for c in COUNTS}
    dated, said = [r for r in rows if r["low"] is not None], [r for r in rows if r["said"]]
    sums["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(said, said[1:], strict=False))
    turns = sum(r["turns"] for r in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:], strict=False))
    sums |= {"gaps": gaps(dated[0]["low"], dated[-1]["high"], turns) if dated else 0, "cost": cost}
    n = len(rows)
    once = lambda x: [x] + [None] * (n - 1)
    out = {"conv_id": pieces.column("conv_id"), "part": [r["part"] for r in rows], "piece": [r["piece"] for r in rows], "entry": [a for a, _ in through], "exit": [b for _, b in through]}
    out |= {"inserts": [0] * (n - 1) + [inserts]} | {c: once(sums[c]) for c in ("gaps", *COUNTS, "cost")}
    ints = {"part", "piece", "entry", "exit", "inserts"}
    return pa.table({c: v if c == "conv_id" else pa.array(v, pa.int32() if c in ints else pa.int64()) for c, v in out.items()})


def repaired_pieces(met: DataFrame) -> DataFrame:
    """(conv_id, part, piece, counts, letters, said): each piece repaired on its way; said is null where nothing of it stays."""
    kind = met.schema["conv_id"].dataType.simpleString()
    kept = ("conv_id", "part", "piece", "gaps", *COUNTS, "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in (batch.slice(k, 1) for k in range(batch.num_rows)):
                r = {c: one.column(c)[0].as_py() for c in ("roles", "texts", "faults", "more", "entry", "exit", "inserts")}
                rows = list(zip(r["roles"], r["texts"], r["faults"], r["more"], strict=True))
                letters, messages = path(stack_run(rows, r["entry"])[r["exit"]][2])
                messages += tail(r["exit"], r["inserts"])
                said = b"\n".join(messages) if messages else None
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(c) for c in kept), pa.array([(letters + b"I" * r["inserts"]).decode()]), pa.array([said], pa.binary())], names=[*kept, "letters", "said"]
                )

    return met.mapInArrow(run, f"conv_id {kind}, part int, piece int, {', '.join(f'{c} bigint' for c in kept[3:])}, letters string, said binary")


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """Result rows from pieces that come in order; texts are hashed as they come."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    kept = ("gaps", *COUNTS, "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # key, counts, letters, hash, whether it has taken a text

        def row() -> pa.RecordBatch:
            key, counts, letters, digest, _ = held
            return pa.RecordBatch.from_arrays(
                [key, *(pa.array([counts[c]], pa.int64()) for c in kept), pa.array(["".join(letters)]), pa.array([digest.hexdigest()])], names=["conv_id", *kept, "audit", "repaired_sha256"]
            )

        for batch in batches:
            for k in range(batch.num_rows):
                key, said = batch.column("conv_id").slice(k, 1), batch.column("said")[k].as_py()
                if held is None or held[0] != key:
                    if held is not None:
                        yield row()
                    held = [key, {c: batch.column(c)[k].as_py() for c in kept}, [], hashlib.sha256(), False]
                held[2].append(batch.column("letters")[k].as_py())
                if said is not None:
                    held[3].update(b"\n" + said if held[4] else said)
                    held[4] = True
        if held is not None:
            yield row()

    return pieces.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} bigint' for c in kept)}, audit string, repaired_sha256 string")


def repaired(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation, of rows as `damaged` returns them."""
    parts = stored(repaired_parts(ordered(rows), piece_rows), "repaired")
    done = parts.where("part IS NULL").select("conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256")
    pieces = parts.where("part IS NOT NULL").select("conv_id", "part", "piece", *COUNTS, "first", "last", "low", "high", "turns", "costs", "ranks", "roles", "texts", "faults", "more")
    short = pieces.select("conv_id", "part", "piece", *COUNTS, "first", "last", "low", "high", "turns", "costs", "ranks", (F.size("roles") > 0).alias("said"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    through = short.groupBy("conv_id").applyInArrow(ways_through, f"conv_id {kind}, part int, piece int, entry int, exit int, inserts int, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint")
    through = stored(through, "through").drop("conv_id")
    met = pieces.select("conv_id", "part", "piece", "roles", "texts", "faults", "more").join(through, ["part", "piece"])
    said = stored(repaired_pieces(met), "said")
    return done.union(joined_pieces(said.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")))
