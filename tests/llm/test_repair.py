"""Conversation repair against plain searches over whole audits."""

import hashlib
import itertools
import random
import zlib

import pytest

from tidemark.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
EDITS = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def grammar_ok(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return not roles or (rest and len(rest) % 2 == 0 and all(c == "ua"[i % 2] for i, c in enumerate(rest)))


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = text.strip(SPACE)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit) with its messages for each role sequence state, one edit at a time; states are what was put out so far, folded to what the grammar needs."""
    faults = faults_of(rows)
    fold = lambda roles: roles if roles in ("", "s") else "." + roles[-1]

    def better(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def inserted(table):
        for _ in range(3):
            for key, (cost, audit, said) in list(table.items()):
                for c in "ua":
                    if c == ("a" if key == ".u" else "u"):
                        better(table, fold(key + c), (cost + 5, audit + "I", [*said, EDITS[c] + ":"]))
        return table

    table = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for key, (cost, audit, said) in table.items():
            better(after, key, (cost + 2, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            want = "a" if key == ".u" else "u"
            better(after, fold(key + want), (cost + more + 1, audit + "R", [*said, f"{EDITS[want]}:{text}"]))
            if role[:1] == want or (role[:1] == "s" and key == ""):
                better(after, fold(key + role[:1]), (cost + more, audit + "K", [*said, f"{role}:{text}"]))
        table = inserted(after)
    return min(v for k, v in table.items() if k in ("", ".a"))


def exhaustive(rows):
    """Every sequence of edits with up to two inserts between rows."""
    faults, best = faults_of(rows), None
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product("KDua", repeat=len(rows)):
        for puts in itertools.product(gaps, repeat=len(rows) + 1):
            roles, cost, audit = puts[0], 5 * len(puts[0]), "I" * len(puts[0])
            for (_, _, role, _), fault, edit, put in zip(rows, faults, edits, puts[1:], strict=True):
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                cost += {"K": 0, "D": 2}.get(edit, 1) + (5 if fault == "truncated" and edit != "D" else 0) + 5 * len(put)
                roles += {"K": role[:1], "D": ""}.get(edit, edit) + put
                audit += {"u": "R", "a": "R"}.get(edit, edit) + "I" * len(put)
            else:
                if grammar_ok(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in plain_damage(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = faults_of(mine)
        turns = {r[1] for r in mine if r[1] is not None}
        cost, audit, said = plain_repair(mine)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def rows_of(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        at = rng.randrange(5)
        for k in range(rng.randrange(1, longest)):
            at += rng.choice([0, 1, 1, 1, 1, 3])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""]) if rng.random() < 0.4 else ("user", "assistant")[k % 2]
            text = rng.choice(["a. b!", "no end", "", "  \t", None, "é so? ", f"{k}.", "…", "x!\n"])
            rows.append((conv if conv else None, None if rng.random() < 0.05 else at, role, text))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def found(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_plain_repair_is_the_least_of_all_edits():
    rng = random.Random(5)
    for _ in range(12):
        rows = [(1, k, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b.", "cut", "", f"{k}!"])) for k in range(rng.randrange(1, 4))]
        assert plain_repair(rows)[:2] == exhaustive(rows)


def test_stack_against_plain_search():
    for rows in (rows_of(seed, 2, 9) for seed in range(60)):
        mine = sorted((r for r in plain_damage(rows) if r[0] == 1), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        p, seen = cr.Piece(1, True), set()
        for _, turn, role, text in mine:
            p.add(turn, role.encode(), text.encode(), 1, (role, text) in seen)
            seen.add((role, text))
        cost, audit, said = plain_repair(mine)
        made = cr.whole(p)
        assert (made["cost"], made["audit"], made["repaired_sha256"]) == (cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


@pytest.mark.parametrize("piece_rows", [1, 3, 2048])
def test_repair_in_pieces(spark, piece_rows):
    rows = rows_of(1, 25, 12) + rows_of(2, 2, 200)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copies", "'x' AS same", "2 AS part").repartition(5)
    assert found(cr.repaired(cr.damaged(df), piece_rows)) == expected(rows)


def test_one_conversation_over_all_tasks(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], f"text {k % 900}{'.' if k % 11 else ''}") for k in range(4000)] + [(8, 0, "user", "hm."), (9, None, None, None), (None, 1, "user", "a.")]
    df = cr.repaired(cr.damaged(spark.createDataFrame(rows, SCHEMA)), 64)
    assert found(df) == expected(rows)
    assert sorted(map(str, found(df))) == ["7", "8", "9", "None"]


def test_dropped_and_empty(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    out = found(cr.repaired(cr.damaged(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA))))
    assert out == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert found(cr.repaired(cr.damaged(spark.createDataFrame([], SCHEMA)))) == {}
