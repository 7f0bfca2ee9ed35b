"""Phrases against plain counting, automata against dictionaries."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import phrases
from tidemark.llm.automata import Automaton, composed, union

SCHEMA = "doc_id bigint, text string, lang string, score double"


def plain(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = tuple(re.findall(r"[^ \t]+", piece))
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, words[i : i + k]] += 1
    cands = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    gone = set()
    for (lang, words), a in cands.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= 100 * cands[lang, words[i : i + k]]:
                    gone.add((lang, words[i : i + k]))
    out = {}
    for (lang, words), a in cands.items():
        if (lang, words) in gone:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    return {(lang, rank, p.decode(), -a, left, right, total, -s) for lang, found in out.items() for rank, (s, a, p, left, right, total) in enumerate(sorted(found)[:top], 1)}


def found(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def texts_of(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "The", "new", "york", "cité", "x", "a-b", "big", "apple", "Été"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(["new york city hall park", "New  York\tcity", "in the big apple", "x x x x x x"]) if rng.random() < 0.3 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " "]))
        out.append(("".join(parts), rng.choice(["en", "en", "en", "fr", None, ""])))
    return out


@pytest.mark.parametrize("options", [{}, {"range_bytes": 500, "hash_range_bytes": 300, "limit": 200, "most_bits": 16}, {"range_bytes": 3000, "limit": 40}])
def test_phrases_against_plain_counts(spark, options):
    rows = [*texts_of(3, 500), (None, "en"), ("", None), ("one", "it"), ("a" * 300 + " b. " * 200, "en")]
    df = spark.createDataFrame([(i // 3, t, lang, 1.0) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(4)
    for least, top in ((8, 2000), (3, 7)):
        assert found(phrases.collocations(df, least=least, top=top, **options)) == plain(rows, least, top=top)


def test_no_rows(spark):
    assert found(phrases.collocations(spark.createDataFrame([], SCHEMA))) == set()
    assert found(phrases.collocations(spark.createDataFrame([(1, None, None, 0.0)], SCHEMA))) == set()


def test_scores_past_64_bits(spark):
    a, n, left, right = 3 * 10**9, 10**12 + 7, 3 * 10**9 + 1, 4 * 10**9
    row = spark.sql(f"SELECT CAST((1000 * CAST({a} AS DECIMAL(19,0)) * CAST({n} AS DECIMAL(19,0))) div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0))) AS BIGINT) AS x").first()
    assert row.x == 1000 * a * n // (left * right)


def test_automata():
    rng = random.Random(1)
    draw = lambda n: {tuple(rng.choice([b"a", b"b", b"cc", b"\xff"]) for _ in range(rng.randrange(1, 5))): rng.randrange(1, 9) for _ in range(n)}
    sets = [draw(n) for n in (0, 1, 30, 80)]
    made = [Automaton.of(sorted(x.items())) for x in sets]
    for words, automaton in zip(sets, made, strict=True):
        assert list(automaton) == sorted(words.items())
        assert list(Automaton.from_bytes(automaton.to_bytes())) == sorted(words.items())
    total = sum(map(Counter, sets), Counter())
    assert list(union(made, 5)) == sorted((p, n) for p, n in total.items() if n >= 5)
    assert list(composed(made[2], made[3])) == sorted((p, n) for p, n in sets[3].items() if p in sets[2])
    # states that the same words follow are one
    assert len(Automaton.of(sorted((((x,) + t), 1) for x in (b"k", b"l", b"m") for t in sets[3])).finals) == len(made[3].finals) + 1
