"""Operators against brute force, round trips and held-out labels; nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decision_lists, exact_dedup, html_extract, length_histogram, mixing, pii, quality_ftrl, simhash, substring_dedup
from tidemark.llm.queries import ORACLE_SQL, QUERIES, rank_file

DATA = "/root/testdata/sf0.001"
LONG = "word " * 30_000
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (5, "one  two", "b"), (5, "one  two", "b"), (6, LONG, "c"), (7, "é😀 #$% +1 (222) 333-4444", None)]
SCHEMA = "doc_id bigint, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with every oddity, and columns that operators use themselves."""
    clash = {c: F.lit(1) for c in ("id", "size", "digest", "fp", "ids", "score", "found", "key", "weight", "_gone")}
    return spark.createDataFrame(ODD, SCHEMA).withColumns(clash)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))


def test_mixing(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(tuple, mixing.mix(odd).collect())) == sorted(map(tuple, rows))
    assert mixing.mix(odd.limit(0)).isEmpty()
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.lit(20)).alias("text"), F.lit("s").alias("source"), (1 + F.col("id") % 3).alias("likes"))
    taken = mixing.mix(many, weight_col="likes", share=0.6).join(many, "doc_id").groupBy("likes").agg((F.sum("taken") / F.sum("size")).alias("x")).orderBy("likes").collect()
    assert [round(r.x, 1) for r in taken] == [0.3, 0.6, 0.9]
    assert mixing.repeated(many, share=1.5).count() == 6000


def test_simhash(spark, odd, texts):
    got = simhash.near_duplicates(spark.read.parquet(f"{DATA}/documents.parquet")).collect()
    fps = np.array([int(r.fingerprint, 16) for r in got], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    group = {r.doc_id: r.doc_id for r in got}
    for _ in got:
        before = dict(group)
        for i, r in enumerate(got):
            group[r.doc_id] = min(group[got[j].doc_id] for j in np.flatnonzero(near[i]))
        if before == group:
            break
    assert {r.doc_id: r.component_id for r in got} == group
    odd_rows = simhash.near_duplicates(odd).collect()
    assert len(odd_rows) == len(ODD) and {r.component_id for r in odd_rows if r.doc_id in (1, 2, 3)} == {1}
    assert simhash.near_duplicates(odd.limit(0)).isEmpty()


def test_one_of_similar_documents(spark, odd):
    """Near copies of 0.8 or more, by brute force over word shingles, lose all but one; other documents stay."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: (r.text or "").lower().split() for r in rows.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in texts.items()}
    holders: dict[tuple, list] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    met = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in met}
    got = simhash.near_duplicates(rows, **simhash.SIMILAR).collect()
    group = {r.doc_id: r.component_id for r in got}
    near = [p for p, j in alike.items() if j >= 0.8]
    assert near and sum(group[a] == group[b] for a, b in near) >= 0.99 * len(near)
    linked = {i for p in near for i in p}
    assert all(group[i] == i for i in group if i not in linked)
    kept = [r.doc_id for r in simhash.one_of_each(rows).collect()]
    assert sorted(kept) == sorted(i for i, c in group.items() if i == c)
    assert {1, 4, 6, 7} == {r.doc_id for r in simhash.one_of_each(odd).collect()} and simhash.one_of_each(odd.limit(0)).isEmpty()


def test_simhash_large_group(spark):
    """Many fingerprints a bit or two from each other are one component."""
    fps = [0] + [1 << i for i in range(63)] + [1 << i | 1 << j for i in range(0, 60, 3) for j in range(1, 60, 7) if i != j]
    rows = spark.createDataFrame([(x,) for x in {*fps}], "fp bigint")
    assert simhash.components(rows).select("component").distinct().count() == 1


def test_length_histogram(spark, odd):
    counts = spark.createDataFrame([(x,) for x in (0, 5, 5, 3000, 7)], "n_tokens bigint")
    hist = length_histogram.histogram(counts)
    for limit, over, tokens, cut in (r for r in length_histogram.at_limits(hist, [0, 5, 6, 10_000]).collect()):
        lengths = [0, 5, 5, 3000, 7]
        assert (over, tokens, cut) == (sum(x > limit for x in lengths), sum(x for x in lengths if x > limit), sum(min(x, limit) for x in lengths))
    assert length_histogram.quantile(hist, 0.5) == 5
    assert length_histogram.token_counts(odd, *rank_file()).count() == len(ODD)
    assert length_histogram.histogram(counts.limit(0)).isEmpty()


def test_html(spark):
    page = "<nav><a>Menu</a></nav><article><header><h1>T&amp;t</h1></header><p>a  b<div class='ad'>buy</div><p>c&nbsp;d<br>e</article><section class=comments>no</section><footer>f"
    assert html_extract.main_text(page) == "T&t\na b\nc d\ne"
    plain = "<div id=menu>x</div><div><p>" + "long text " * 30 + "</p><p>short</p></div><ul><li><a>l1</a><li><a>l2</a></ul><form>q</form>"
    assert html_extract.main_text(plain) == ("long text " * 30).strip() + "\nshort"
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", "<article><p" )], "page_id bigint, url string, html string").withColumn("_html", F.lit(1))
    assert sorted(r.n_chars for r in html_extract.extract(pages).collect()) == [0, 0, 0, 13]


def test_substrings_against_brute_force(spark, odd, texts):
    passage = " ".join(f"p{i}" for i in range(37))
    # ids of their own: rows that share one are documents of their own, which this count by id doesn't tell apart
    rows = [(100 + i, f"a{i} b{i} " * (i % 7) + passage + f" z{i}" * 5 + (" " + passage if i == 9 else ""), "s") for i in range(40)] + ODD
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_text or "") if r.kept_text is not None else (r.doc_id, r.n_words, r.n_removed, None) for r in substring_dedup.without_repeats(docs).collect()}
    first: dict[str, tuple] = {}
    split = {(i, t): re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t, _ in rows}
    for (i, _), w in split.items():
        for k in range(len(w) - 19):
            first[" ".join(w[k : k + 20])] = min(first.get(" ".join(w[k : k + 20]), (i, k)), (i, k))
    gone: dict[int, set] = {}
    for (i, _), w in split.items():
        for k in range(len(w) - 19):
            if first[" ".join(w[k : k + 20])] != (i, k):
                gone.setdefault(i, set()).update(range(k, k + 20))
    for (i, _), w in split.items():
        kept = [x for k, x in enumerate(w) if k not in gone.get(i, ())]
        assert (i, len(w), len(w) - len(kept), " ".join(kept)) in got or (len(w) == len(kept) and (i, len(w), 0, None) in got)


def test_decision_list(spark, odd):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    judged = decision_lists.judged(docs, labels).join(labels, "doc_id")
    good = judged.where("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = judged.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97 and bad < 0.3
    assert decision_lists.statistics_of("a b c\na b c\n\nx #é".encode())[:5] == (8, 9, 1, 1, 6)
    assert decision_lists.judged(odd, labels.limit(0)).count() == len(ODD)


def test_pii(spark, odd):
    assert pii.detect(odd.limit(0)).isEmpty()
    found = {r.doc_id: r for r in pii.detect(odd).select("doc_id", pii.span_list(pii.base_spans()).alias("s")).collect()}
    assert found[7].s == "phone:7:24" and found[1].s == ""
    text = "x a.b@c.de 10.0.0.256 1.2.3.4 and 4111 1111 1111 1111 +12 34"
    assert [(pii.KINDS[s["kind"]], text[s["start"] : s["end"]]) for s in pii.candidates_of(text) if s["base"]] == [("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111")]
    votes, counts = np.array([[2, 2, 2, 2], [0, 0, 1, 0], [2, 2, 1, 2]]), np.array([30.0, 40.0, 30.0])
    p, _ = pii.estimate(votes, counts)
    assert p[0] > 0.9 and p[2] > 0.9 and p[1] < 0.1
    assert "[PHONE]" in pii.redacted(odd).where("doc_id = 7").first().text


def test_quality_on_held_out_rows(spark, odd):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality_ftrl.classified(docs, labels).join(labels, "doc_id").where("held_out")
    good, bad = ([r.score for r in scored.where(f"quality = {q}").collect()] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    kept = {r.doc_id for r in quality_ftrl.accepted(docs, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in quality_ftrl.classified(docs, labels).where("predicted = 1").collect()}
    assert {r.score for r in quality_ftrl.classified(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_ftrl.accepted(odd, labels.limit(0)).count() == len(ODD) and quality_ftrl.accepted(odd.limit(0), labels).isEmpty()


def test_exact_dedup_when_digests_collide(spark, odd):
    weak = lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1).cast("binary")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    a, b = (sorted(map(tuple, exact_dedup.exact_duplicates(odd, **k).select(columns).collect())) for k in ({}, {"digest": weak}))
    assert a == b and [x[:4] for x in a if x[0] in (4, 5)] == [(4, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False)]
    assert exact_dedup.deduplicated(odd).count() == 5
    assert exact_dedup.exact_duplicates(odd.limit(0)).isEmpty()


def test_bpe_against_the_library(spark, odd):
    import tiktoken

    path, pattern = rank_file()
    known = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(bpe.read_tokens(path))}, special_tokens={})
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, x) for i, x in enumerate(["a" * 2000, "ab" * 300, "  \n x", "<|endoftext|>", "é" * 500, "\x00\x1c it's 12345678901"])], "doc_id bigint, text string"))
    out = bpe.round_trip(docs, path, pattern).join(docs.dropDuplicates(["doc_id"]).withColumnRenamed("text", "t"), "doc_id").collect()
    assert len(out) == len(ODD) + 6
    for r in out:
        assert r.ids == known.encode_ordinary(r.t or "") and r.n_tokens == len(r.ids) and bytes(r.decoded) == (r.t or "").encode()


def test_decoding_alone(spark):
    """Ids of other makers decode too: null ones give no bytes, as do no ids."""
    path, _ = rank_file()
    tokens = bpe.read_tokens(path)
    rows = spark.createDataFrame([(1, [5, 300, 5]), (2, None), (3, []), (4, [len(tokens) - 1])], "k bigint, ids array<int>")
    got = {r.k: bytes(r.decoded) for r in bpe.decode(rows, bpe.shared_tokens(spark, path)).collect()}
    assert got == {1: tokens[5] + tokens[300] + tokens[5], 2: b"", 3: b"", 4: tokens[-1]}


def test_pipeline(spark, texts):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "exact":
            kept = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in docs.collect()]
            assert len(kept) == len(set(kept))
    final = p.STAGES[-1][1](spark, docs, DATA).collect()
    assert final and all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in final)


def test_pipeline_takes_odd_rows(spark):
    """Null, empty and repeated rows and an empty table go through all stages; results of two calls of a stage both stay."""
    import corpus_pipeline as p

    good = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(4).collect()]
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, good[0], "en", "a", 9), (2, good[0], "en", "a", 9), (3, good[1], None, "b", 9), (None, good[2], "fr", None, 9)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in p.STAGES[:-1]:
        first, second = stage(spark, docs, DATA), stage(spark, docs, DATA)
        assert sorted(map(str, first.collect())) == sorted(map(str, second.collect())), name
        docs = spark.createDataFrame(first.collect(), schema)
        texts = {r.text or "" for r in docs.collect()}
        if name == "exact":
            assert docs.count() == len(texts)
        assert texts <= {t or "" for _, t, *_ in rows}
    last = p.STAGES[-1][1](spark, docs, DATA)
    assert sorted(r.n_tokens for r in last.collect()) == sorted(r.n_tokens for r in bpe.round_trip(docs, *rank_file()).collect())
    none = spark.createDataFrame([], schema)
    for name, stage in p.STAGES:
        made = stage(spark, none, DATA)
        assert made.isEmpty(), name


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_near_stage_drops_what_has_a_similar_partner(spark, sf):
    """By brute force over word shingles: each linked document has a partner of 0.8 or more in its component, and all such pairs are linked."""
    rows = exact_dedup.deduplicated(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"))
    split = {r.doc_id: (r.text or "").lower().split() for r in rows.collect()}
    sets = {i: {hash(tuple(w[k : k + 5])) for k in range(max(1, len(w) - 4))} for i, w in split.items()}
    holders: dict[int, list] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    met: set[tuple] = set()
    for i, s in sets.items():
        # of 0.8 or more, one of any so many of the shingles is shared: the rarest are tried
        rare = sorted(s, key=lambda x: len(holders[x]))[: len(s) // 5 + 1]
        met |= {(min(i, j), max(i, j)) for x in rare for j in holders[x] if i != j}
    similar = {(a, b) for a, b in met if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows, **simhash.SIMILAR).collect()}
    assert similar and all(group[a] == group[b] for a, b in similar)
    backed = {x for a, b in similar for x in (a, b)}
    gone = set(sets) - {r.doc_id for r in simhash.one_of_each(rows, **simhash.SIMILAR).collect()}
    assert gone == {i for i, c in group.items() if i != c} and gone <= backed


def test_only_rows_that_are_not_kept_go(spark):
    """Rows that repeat the least id of their group, share an id with another text's copy, or have no id."""
    rows = [(5, "x y"), (5, "x y"), (6, "x  y"), (6, "alone"), (None, "n"), (None, "n"), (None, "other"), (7, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = [(None, "n"), (None, "other"), (5, "x y"), (6, "alone")]
    in_order = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0] or 0, r[1]))
    assert in_order(exact_dedup.deduplicated(docs)) == want
    weak = lambda text: F.lit(b"0")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    a, b = (sorted(map(str, exact_dedup.exact_duplicates(docs, **k).select(columns).collect())) for k in ({}, {"digest": weak}))
    assert a == b
    # here a null id comes last
    assert in_order(simhash.one_of_each(docs)) == [(None, "other"), (5, "x y"), (6, "alone"), (7, "n")]


def test_mix_repeats_rows_whatever_their_ids(spark):
    """Null and repeated ids and texts without words come as often as the mix takes them."""
    rows = [(None, "a b c"), (None, "d e"), (1, "f"), (1, "g h i j"), (2, ""), (3, None), (4, " \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", F.lit("s"))
    assert sorted(map(str, mixing.repeated(docs, share=2.0).collect())) == sorted(2 * [str(r) for r in docs.collect()])
    many = spark.createDataFrame([(None if i % 3 else i // 6, "w " * (i % 9)) for i in range(600)], "doc_id bigint, text string").withColumn("source", F.lit("s"))
    words = mixing.mix(many).agg(F.sum("taken")).first()[0]
    assert mixing.repeated(many).agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == words
