"""Quality rules as a learned decision list.

Statistics are counted over every text.  From those of a bounded sample of
labelled rows, sequential covering learns an ordered list: each rule, a
conjunction of thresholds that rejects, is grown condition by condition on two
thirds of the rows left (by information gain), pruned from its end on the other
third, and taken while it is right there more often than not; the rows it
covers then go.  The list becomes one conditional expression of Spark columns:
the first rule that holds decides, and a text that none holds for is kept.

Null texts have no words.  Lines are cut at \\n alone; a line is a duplicate if
an earlier one is equal.  Without labels of both kinds the list is empty.
Rows without an id are judged like all others, and texts of any length are
counted whole.  Repeated rows and ties count like any other; columns besides id and text never
matter; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts

#: Labelled rows that rules are learned from at most, chosen by a hash of the id.
MAX_LABELLED = 10_000
#: Thresholds tried for each statistic, conditions in a rule, rules in a list, share of the pruning rows that a rule must be right on.
CUTS, MAX_CONDITIONS, MAX_RULES, LEAST_RIGHT = 24, 4, 16, 0.8
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_marks", "n_same")
MIN_WORDS, MAX_REPEATED = 50, 50


def statistics_of(text: bytes) -> tuple[int, ...]:
    """COUNTS of a text: n_lines have a word, n_marks are ! and ?, n_same are words equal to the one before."""
    words = text.split()
    n = len(words)
    # code points are the bytes that don't continue one
    chars = sum(map(len, words)) - _continued(text)
    symbols = sum(text.count(bytes([s])) for s in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    repeated = 0
    if n > 3:
        windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:] if len(number) < 1 << 20 else _ranked(ids, len(number))
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        cover = np.zeros(n + 1, dtype=np.int64)
        at = np.flatnonzero(counts[which] > 1)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + 3, -1)
        repeated = int((np.cumsum(cover)[:n] > 0).sum())
    same = int((ids[1:] == ids[:-1]).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), len(number), text.count(b"!") + text.count(b"?"), same


def _continued(text: bytes) -> int:
    return int(((np.frombuffer(text, dtype=np.uint8) & 0xC0) == 0x80).sum())


def _ranked(ids: np.ndarray, n: int) -> np.ndarray:
    """Windows of three as numbers, where the product of the ids would not fit."""
    _, pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
    return pairs * n + ids[2:]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, COUNTS) of each row."""

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        found = [statistics_of(x) for x in texts]
        return [pa.array([x[k] for x in found], pa.int64()) for k in range(len(COUNTS))]

    return map_texts(docs, id_col, text_col, per_slice, [(c, "bigint") for c in COUNTS])


def ratios() -> dict[str, Column]:
    """What rules set thresholds on: the counts and their shares."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {c: F.col(c).cast("double") for c in ("n_words", "n_symbols", "n_dup_lines", "n_repeat_words")} | {
        "mean_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "same_share": share("n_same", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    over: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.threshold if self.over else x[self.name] <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.name] > self.threshold if self.over else of[self.name] <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.over else '<='} {self.threshold:.6g}"


def _covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """Adds the condition with the most information gain while good rows are still covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (~bad[inside]).any() and bad[inside].any():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            own = values[inside]
            # midpoints between neighbouring quantiles of the covered rows and of the bad ones among them
            edges = np.unique(np.concatenate([np.quantile(own, np.linspace(0, 1, CUTS)), np.quantile(own[bad[inside]], np.linspace(0, 1, CUTS))]))
            for t in (edges[1:] + edges[:-1]) / 2:
                for over in (True, False):
                    hit = own > t if over else own <= t
                    p, n = (hit & bad[inside]).sum(), (hit & ~bad[inside]).sum()
                    g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
                    if g > gain:
                        best, gain = Condition(name, over, float(t)), g
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """The beginning of the rule that is worth most on rows it wasn't grown on."""

    def worth(k: int) -> float:
        hit = _covers(rule[:k], x, len(bad))
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def cover(x: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """The ordered list of rules that reject; rows must be in an order that doesn't follow their labels."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), dtype=bool)
    # of each label alike
    third = np.where(bad, np.cumsum(bad), np.cumsum(~bad)) % 3 == 0
    while len(rules) < MAX_RULES and bad[left & ~third].any():
        a, b = left & ~third, left & third
        xa, xb = ({k: v[m] for k, v in x.items()} for m in (a, b))
        rule = prune(grow(xa, bad[a]), xb, bad[b])
        hit = _covers(rule, xb, int(b.sum()))
        p, n = (hit & bad[b]).sum(), (hit & ~bad[b]).sum()
        if not rule or not p or p / (p + n) < LEAST_RIGHT:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return rules


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> list[list[Condition]]:
    """Rules from at most max_labelled labelled rows of statistics, which go to the driver: a few numbers each."""
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    of = ratios()
    rows = stats.join(F.broadcast(sample), F.col(id_col) == F.col("_id")).select("_id", "_label", *[c.alias(k) for k, c in of.items()])
    rows = rows.orderBy(F.xxhash64("_id", F.lit(7)), *of).limit(2 * max_labelled).collect()
    if not rows:
        return []
    return cover({k: np.array([r[k] for r in rows]) for k in of}, np.array([r["_label"] == 0 for r in rows]))


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as a Spark expression over COUNTS: false where the first rule that holds rejects, else true."""
    of, out = ratios(), None
    for rule in rules:
        all_of = rule[0].column(of)
        for c in rule[1:]:
            all_of = all_of & c.column(of)
        out = F.when(all_of, False) if out is None else out.when(all_of, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed() -> Column:
    """The fixed rule that comes before all learned ones."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, COUNTS, base_failed, kept) of each row."""
    stats = statistics(docs, id_col, text_col)
    # rules are learned from the labelled rows' texts alone
    chosen = labels.where(F.col("quality").isin(0, 1)).select(F.col(id_col).alias("_chosen")).distinct()
    chosen = chosen.orderBy(F.xxhash64("_chosen"), "_chosen").limit(MAX_LABELLED)
    texts = docs.select(id_col, text_col)
    own = statistics(texts.join(F.broadcast(chosen), F.col(id_col) == F.col("_chosen"), "left_semi"), id_col, text_col)
    rules = learn(own, labels, id_col)
    failed = base_failed()
    return stats.select(id_col, *COUNTS, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
