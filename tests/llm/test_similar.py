"""Near copies meet by SimHash's deletion variants at a similarity of 0.8, where a tenth and more of the bits differ."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import similar, simhash


def keys_of(hashes):
    """The variants' keys in plain Python."""
    pieces = similar.pieces_of(similar.fingerprint_bits(hashes)).tolist()
    keys = set(similar.few_keys(hashes))
    for s, cut in enumerate(similar.segments()):
        for j in range(3):
            x, y = (pieces[i] for k, i in enumerate(cut) if k != j)
            keys.add((3 * s + j) << 2 * similar.PIECE | x << similar.PIECE | y)
    return keys


def test_sets_of_that_similarity_meet_by_deletion_variants():
    """Pairs of exactly 0.8, of any size, share a key; unrelated sets next to never do."""
    rng = np.random.default_rng(5)
    assert len(similar.segments()) == similar.DEALS * (similar.PIECES // 3)
    for n, m, shared in ((200, 160, 160), (180, 180, 160), (45, 45, 40), (9, 9, 8), (5, 4, 4), (10, 8, 8)):
        missed = strangers = 0
        for _ in range(150):
            h = np.unique(rng.integers(0, 1 << 64, n + m - shared, dtype=np.uint64, endpoint=False))
            rng.shuffle(h)
            a, b = np.unique(h[:n]), np.unique(h[n - shared :])
            assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8
            missed += not keys_of(a) & keys_of(b)
            strangers += bool(keys_of(a) & keys_of(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))))
        assert missed <= 1 and strangers <= 3, (n, m)


def test_keys_in_spark_are_those_of_the_fingerprint(spark):
    """The joins' keys are the variants of the fingerprint's segments, one piece left out."""
    hashes = np.unique(similar.shingle_hashes(b"the quick brown fox jumps over the lazy dog and sleeps", 5))
    pieces = similar.pieces_of(similar.fingerprint_bits(hashes)).tolist()
    cuts = similar.segments()
    row = spark.createDataFrame([(pieces,)], "pieces array<smallint>")
    got = {k for first in (0, 100) for k in row.select(similar.variant_keys(F.col("pieces"), cuts[first : first + 100], first)).first()[0]}
    assert len(got) == 600 and got <= keys_of(hashes)


def test_plans_do_not_grow_with_the_keys(spark):
    """A batch's keys are one expression, whatever their number: one for each of them fills the driver."""
    cuts = similar.segments()
    rows = spark.range(1).select(F.expr("transform(sequence(0, 255), i -> cast(i as smallint))").alias("pieces"))
    batches = [rows.select(F.explode(similar.variant_keys(F.col("pieces"), cuts[:n])).alias("key")) for n in (4, similar.AT_ONCE)]
    few, many = (df._jdf.queryExecution().optimizedPlan().expressions().toString().count("pieces") for df in batches)
    assert [df.count() for df in batches] == [12, 3 * similar.AT_ONCE] and few == many


def test_a_link_that_no_pivot_sees(spark):
    """Two near copies are linked though all of their keys' pivots may be nearer to neither; a word more at the end of a short text counts as well."""
    words = [f"w{i}" for i in range(400)]
    base = words[:100]
    texts = [base, words[200:230] + base[30:], words[200:230] + base[30:97] + words[300:303], words[:8], words[:9]]
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows, **simhash.SIMILAR).collect()}
    assert group == {0: 0, 1: 1, 2: 1, 3: 3, 4: 3}


def test_what_shares_a_key_is_a_row_only_if_it_may_be_alike(spark):
    """Members of one group don't meet; a lone row meets a group once however many members share its key, other rows one by one, and nothing that was seen."""
    far = [-1] * len(similar.LONGS)
    zero = [0] * len(similar.LONGS)
    rows = [(1, n, 100, *zero, None) for n in range(100, 150)]  # a group in one key
    rows += [(1, 1, None, *zero, None), (1, 2, None, *zero, [1]), (1, 3, None, *far, None), (1, 4, None, *zero, [100])]
    rows += [(2, n, n // 10 * 10, *zero, None) for n in (100, 101, 200, 201)]  # two groups in another
    schema = "key long, node long, component long, " + ", ".join(f"{c} long" for c in similar.LONGS) + ", seen array<long>"
    got = {tuple(r) for r in similar.meetings(spark.createDataFrame(rows, schema), 60).collect()}
    assert got == {(1, 100, True), (2, 100, True), (1, 4, False), (2, 4, False), (100, 200, False), (100, 201, False), (101, 200, False), (101, 201, False)}


def test_a_large_group_of_which_many_are_not_alike(spark):
    """Copies that each differ from a base in words of their own are linked by it though few of them are alike; those too far stay alone."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = [base]
    for i in range(60):
        words = list(base)
        for at in rng.choice(200, 3 if i < 40 else 12, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append(words)
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(w[k : k + 5]) for k in range(196)} for w in texts]
    want = list(range(len(sets)))
    for _ in sets:  # the least id spreads along the links
        want = [min(want[j] for j in range(len(sets)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in range(len(sets))]
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows, **simhash.SIMILAR).collect()}
    assert want.count(0) > 40 and len(set(want)) > 10 and [group[i] for i in range(len(sets))] == want
