"""The n-gram join against all overlaps, counted pair by pair."""

import random
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import ngram_join

SCHEMA = "doc_id bigint, text string, n bigint, key string"


def set_of(text, words=3):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < words else [tuple(w[k : k + words]) for k in range(len(w) - words + 1)])


def plain(rows, threshold=Fraction(9, 10)):
    sets = [set_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both >= threshold * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "k") for d, t in rows], SCHEMA).repartition(3)


def near_rows(seed):
    """Copies of any similarity, among documents that share a long passage."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(120))
    rows = []
    for doc in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([5, 40, 120, 300]))]
        rows.append((rng.randrange(10**6), f"{' '.join(base)} {passage if doc % 2 else ''}"))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            rows.append((rng.randrange(10**6), f"{' '.join(copy)}\n{passage if doc % 2 else ''}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 6)
    monkeypatch.setattr(ngram_join, "LARGE", 200)
    odd = [(None, "A b"), (None, "a B"), (None, "a b c"), (4, None), (4, ""), (5, " \t\x0b"), (6, "one"), (7, "ONE"), (7, "one"), (8, "a b"), (9, "É b c d"), (10, "é b c d")]
    rows = near_rows(seed) + odd
    expected = plain(rows)
    assert len({c for _, _, c in expected}) < len(rows) - 12
    assert found(ngram_join.joined_components(frame(spark, rows))) == expected


def test_a_chain_of_near_copies_in_one_column(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([*(f"x{j}" for j in range(k)), *words[k:]])) for k in range(60)]
    out = found(ngram_join.joined_components(frame(spark, rows)))
    assert out == plain(rows)


def test_no_rows(spark):
    assert found(ngram_join.joined_components(frame(spark, []))) == []


def test_hashes_follow_words():
    texts = [b"a bb  ccc dddd", b"", b" bb\tccc\ndddd ", b"x", b"A BB CCC DDDD eeeee"]
    sets = ngram_join.gram_sets(texts)
    assert [len(s) for s in sets] == [2, 0, 1, 1, 3]
    assert set(sets[2]) < set(sets[0]) < set(sets[4])
    rng = random.Random(3)
    words = {bytes(rng.choices(b"abAB\x00\xff", k=rng.randrange(1, 9))).lower() for _ in range(5000)}
    assert len({int(ngram_join.gram_sets([w])[0][0]) for w in words}) == len(words)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 1 << 60, n, dtype=np.int64).astype(np.uint64)) for n in (300, 40))
        a2 = np.unique(np.concatenate([a[:-20], b]))
        for longs in (ngram_join.ODD, ngram_join.WIDE):
            bits = np.bitwise_count((ngram_join.parities(a, longs) ^ ngram_join.parities(a2, longs)).view(np.uint64)).sum()
            assert bits <= len(np.setxor1d(a, a2))


def test_copies_of_one_text_meet_that_text(spark, monkeypatch):
    """Copies that are near to one text, but not to each other, take no pairs among themselves; pairs that are left meet once."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = [(500, " ".join(base))]
    for doc in range(150):
        copy = list(base)
        for k in rng.sample(range(150), 4):
            copy[2 * k] = f"x{doc}_{k}"
        rows.append((doc, " ".join(copy)))
    # each of these shares two thirds of its columns, but reaches nothing
    rows += [(1000 + doc, " ".join([*(f"y{doc}_{k}" for k in range(60)), *base[60:]])) for doc in range(20)]
    left = []
    plainly = ngram_join.other_pairs
    monkeypatch.setattr(ngram_join, "other_pairs", lambda *a: left.append(plainly(*a)) or left[-1])
    out = found(ngram_join.joined_components(frame(spark, rows)))
    assert {c for d, _, c in out if d <= 500} == {0} and all(c == d for d, _, c in out if d >= 1000)
    assert left[0].count() <= len(rows)
