"""The operators as queries over the given tables, and what SQL can say about them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, conversation_repair, decision_lists, exact_dedup, html_extract, length_histogram, mixing, ngram_join, phrases, pii, quality_ftrl, simhash, substring_dedup
from tidemark.llm.common import table


def rank_file() -> tuple[str, str]:
    """Path of the rank file and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.histogram(length_histogram.token_counts(table(spark, sf_dir, "documents"), *rank_file()))


def op4_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    sha = F.when(F.col("kept_sha").isNull(), F.sha2(F.col("kept_text"), 256)).otherwise(F.lower(F.hex("kept_sha")))
    return found.select("doc_id", "n_words", "n_removed", sha.alias("kept_sha256"))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decision_lists.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = pii.base_spans()
    kinds = F.transform(base, lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *n, F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans"))


def op8_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ftrl.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), *rank_file()))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined_components(table(spark, sf_dir, "documents"))


def op12_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def decision_list_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op6_decision_list returns, less the learned verdict."""
    return op6_decision_list(spark, sf_dir).drop("kept")


def weak_pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op7_weak_pii returns, less the spans that its classifier adds."""
    return op7_weak_pii(spark, sf_dir).drop("spans")


def ftrl_quality_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows op8_ftrl_quality scores without their labels."""
    return op8_ftrl_quality(spark, sf_dir).select("doc_id", "held_out")


def segment_tree_bpe_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op10_segment_tree_bpe's ids stand for: the texts themselves."""
    return op10_segment_tree_bpe(spark, sf_dir).select("doc_id", "decoded_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pareto_mix,
        op2_simhash,
        op3_length_histogram,
        op4_line_blocks,
        op5_block_anchors,
        op6_decision_list,
        op7_weak_pii,
        op8_ftrl_quality,
        op9_exact_dedup,
        op10_segment_tree_bpe,
        op11_ngram_join,
        op12_glr_repair,
        op13_phrase_automata,
        decision_list_base,
        weak_pii_base,
        ftrl_quality_held_out,
        segment_tree_bpe_decoded,
    )
}

EXACT_DEDUP_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""

#: Whole windows of 20 words in SQL: every window's hash, its first place, the words that later windows cover.
SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS late FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM f WHERE late),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    sha256(coalesce(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
"""

#: Words, symbols, equal lines and repeated windows of three words, counted in SQL.
BASE_COUNTS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
c AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i) AS n FROM c GROUP BY doc_id),
e AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
l AS (SELECT doc_id, sum(n - 1) AS n FROM e GROUP BY 1),
x AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM x
"""

#: The base patterns of personal data, and what a match must pass, over its text f and its digits.
SPAN_RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(f, '.'), lambda x: x::DOUBLE)) <= 255"),
    ("card", r"[0-9]([\x20-]?[0-9])+", "length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), "
        "lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT ELSE 2 * x::INT - CASE WHEN x::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
)
#: A match starts after all gaps up to it and all matches before it.
BASE_SPANS_SQL = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ("
    + " UNION ALL ".join(f"SELECT doc_id, {k} AS k, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM d" for k, (kind, p, _) in enumerate(SPAN_RULES))
    + "), s AS (SELECT doc_id, k, kind, found[i] AS f, regexp_replace(found[i], '[^0-9]', '', 'g') AS digits, (length(array_to_string(gaps[1:i], '')) + length(array_to_string(found[1:i - 1], ''))) AS a"
    " FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)), g AS (SELECT * FROM s WHERE CASE kind "
    + " ".join(f"WHEN '{kind}' THEN {test}" for kind, _, test in SPAN_RULES)
    + " END) SELECT d.doc_id, "
    + ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, _, _ in SPAN_RULES)
    + ", sha256(coalesce(string_agg(kind || ':' || a || ':' || (a + length(f)), ',' ORDER BY k, a), '')) AS base_sha256 FROM d LEFT JOIN g USING (doc_id) GROUP BY d.doc_id"
)

#: CRC-32 bit by bit over the digits of an id; 3988292384 is its polynomial.
HELD_OUT_SQL = """
WITH b AS (SELECT doc_id, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT) AS bytes FROM documents)
SELECT doc_id, xor(list_reduce(bytes, lambda c, x: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, x)), 4294967295::BIGINT), 4294967295::BIGINT) % 5 = 0 AS held_out FROM b
"""

ORACLE_SQL: dict[str, str] = {
    "op1_pareto_mix": mixing.ORACLE_SQL,
    "op9_exact_dedup": EXACT_DEDUP_SQL,
    "op5_block_anchors": SUBSTRING_SQL,
    "decision_list_base": BASE_COUNTS_SQL,
    "weak_pii_base": BASE_SPANS_SQL,
    "ftrl_quality_held_out": HELD_OUT_SQL,
    "segment_tree_bpe_decoded": "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents",
}
