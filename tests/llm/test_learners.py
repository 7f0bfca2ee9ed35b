"""Learners against plain second versions: FTRL one number at a time, a decision list as SQL over statistics that SQL counts."""

import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import decision_lists, quality_ftrl
from tidemark.llm.queries import BASE_COUNTS_SQL, op6_decision_list

DATA = "/root/testdata/sf0.01"


def plain_ftrl(examples, bits, epochs, alpha, beta, l1, l2):
    z, n = {}, {}

    def weight(i, cut):
        if abs(z.get(i, 0.0)) <= cut:
            return 0.0
        return -(z[i] - math.copysign(cut, z[i])) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for places, values, label in examples:
            row = [*zip(places, values, strict=True), (1 << bits, 1.0)]
            w = {i: weight(i, l1) for i, _ in row}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in row)))
            for i, x in row:
                g = (p - label) * x
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return [weight(i, l1) for i in range((1 << bits) + 1)]


def test_ftrl_by_plain_updates():
    rng = random.Random(2)
    examples = []
    for _ in range(60):
        label = rng.randrange(2)
        places = sorted(rng.sample(range(24), rng.randrange(0, 7)) + ([24 + label] if rng.random() < 0.8 else []))
        examples.append((np.array(places, dtype=np.int64), np.array([rng.random() for _ in places]), label))
    got = quality_ftrl.ftrl(examples, 5, 3)
    want = plain_ftrl([(p.tolist(), v.tolist(), y) for p, v, y in examples], 5, 3, quality_ftrl.ALPHA, quality_ftrl.BETA, quality_ftrl.L1, quality_ftrl.L2)
    assert np.allclose(got, want) and got[25] > 0 > got[24]


def test_decision_list_by_sql(spark):
    """op6: the learned rules, printed, as conditions of SQL over the base columns that SQL counts; each document's verdict is the same."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rules = decision_lists.learn(decision_lists.statistics(docs), labels)
    assert rules
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    shares = ", ".join(f"{sql} AS {name}" for name, sql in SHARES.items())
    conditions = " OR ".join("(" + " AND ".join(map(repr_of, rule)) + ")" for rule in rules)
    want = duck.sql(f"WITH b AS ({BASE_COUNTS_SQL}), m AS ({MORE_SQL}), s AS (SELECT *, {shares} FROM b JOIN m USING (doc_id)) SELECT doc_id, NOT base_failed AND NOT ({conditions}) FROM s").fetchall()
    got = [(r.doc_id, r.kept) for r in op6_decision_list(spark, DATA).select("doc_id", "kept").collect()]
    assert sorted(got) == sorted(want)
    assert {k for _, k in got} == {True, False}


def repr_of(condition):
    return f"{condition.name} {'>' if condition.over else '<='} {condition.threshold!r}"


#: What rules set thresholds on, besides the base counts, in SQL.
MORE_SQL = r"""SELECT doc_id, len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines, len(list_distinct(w)) AS n_distinct,
len(regexp_extract_all(t, '[!?]')) AS n_marks, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_same
FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"""
SHARES = {
    name: f"{a} / greatest({b}, 1)"
    for name, a, b in (
        ("mean_word", "word_chars", "n_words"),
        ("symbols_per_word", "n_symbols", "n_words"),
        ("marks_per_word", "n_marks", "n_words"),
        ("dup_line_share", "n_dup_lines", "n_lines"),
        ("repeat_share", "n_repeat_words", "n_words"),
        ("same_share", "n_same", "n_words"),
        ("distinct_share", "n_distinct", "n_words"),
        ("words_per_line", "n_words", "n_lines"),
    )
}
