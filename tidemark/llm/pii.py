"""Personal data by weak supervision.

Candidates are the spans of fixed base patterns and of looser ones: addresses
with (at) and (dot), numbers inside longer runs of digits, local phone numbers,
base matches that failed.  Labelers vote on each: the check of its digits or its
domain, a gazetteer (mail domains, card prefixes, reserved addresses, dialling
codes), the words before it and the signs around it.  Expectation-maximisation
over the counts of all votes in the table estimates how reliable each labeler
is, with nobody's labels; the resulting probabilities train a logistic span
classifier on votes, kind and length.  A candidate that passes it is added to
the base spans, which stay.

Spans are (kind, start, end) in code points, end exclusive; bytes that are no
UTF-8 are read as replacement characters.  Base spans of a
kind never overlap; an added span overlaps no base span.  Null texts count as
empty; texts of any length are searched whole, in time that follows their
length; repeated rows have the same
spans and each counts in the estimation; columns besides id and text never
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_text, decoded, map_texts, stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns with runs taken whole: a run that leads to no match is passed over at once, so a search is linear; a match is what the group holds.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(?P<rest>@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?"),
    "ip": re.compile(r"[0-9]++(?P<rest>\.[0-9]++\.[0-9]++\.[0-9]++)?"),
    "card": re.compile(r"[0-9](?P<rest>[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9](?P<rest>[\x20().0-9-]+)[0-9]"),
}
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(?P<rest> ?(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++)?", re.I),
    "ip": re.compile(r"(?<![0-9.])(?P<rest>[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|[\[(]dot[\])]) ?[0-9]{1,3}){3})(?![0-9])", re.I),
    "card": re.compile(r"(?<![0-9])(?P<rest>[0-9]{4}([ .-]?)[0-9]{4}\2[0-9]{4}\2[0-9]{4}|3[47][0-9]{2}([ .-]?)[0-9]{6}\3[0-9]{5})(?![0-9])"),
    # with its dialling code, where one stands before it
    "phone": re.compile(r"(?<![0-9+])(?P<rest>(?:\+[0-9]{1,3}[ .-]?|00[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\2[0-9]{4}))(?![0-9])"),
}
#: A sign that a text must hold to be searched for a kind by its base pattern; all but the addresses need digits.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
DIGIT, AT = re.compile("[0-9]"), re.compile(r"@|[\[(]at[\])]", re.I)
#: Common top-level domains, dialling codes by first digit, words that announce a kind.
DOMAINS = frozenset(
    "com org net edu gov mil int info biz name pro museum aero coop app dev io ai co me tv cc eu ac ad ae ar at au ba be bg br by ca ch ci cl"
    " cm cn cr cu cy cz de dk do dz ec ee eg es et fi fr gb ge gh gr gt hk hr hu id ie il in iq ir is it jm jo jp ke kr kw kz lb lk lt lu lv"
    " ly ma md mk mm mn mt mx my mz ng ni nl no np nz om pa pe ph pk pl pr pt py qa ro rs ru rw sa se sg si sk sn sv sy th tn tr tw tz ua ug"
    " uk us uy uz ve vn ye za zm zw example test".split()
)
CUES = {
    "email": re.compile(r"(?:e-?mail|contact|write|mailto|reach|correo|courriel)\W*(?:\w+\W+){0,2}\Z", re.I),
    "ip": re.compile(r"(?:\bip|address|host|server|client|addr)\W*(?:\w+\W+){0,2}\Z", re.I),
    "card": re.compile(r"(?:card|visa|mastercard|amex|payment|account|tarjeta|carte|karte)\W*(?:\w+\W+){0,2}\Z", re.I),
    "phone": re.compile(r"(?:phone|tel|call|mobile|fax|cell|telefon|teléfono)\W*(?:\w+\W+){0,2}\Z", re.I),
}
AGAINST = re.compile(r"(?:version|release|\bv|section|chapter|\bno|token|id|order|isbn|hash)\W*\Z", re.I)
LABELERS = ("check", "gazetteer", "context", "edges")
CONTEXT = 48
PASS = 0.9
SPAN = "array<struct<kind:int,start:int,end:int,base:boolean,code:int>>"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    """The check of a base match."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in found.split(".") if x.strip("0"))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def checks(kind: str, found: str) -> bool:
    """The check of any candidate: what its digits or its domain say, however it is written."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "email":
        labels = re.findall("[A-Za-z0-9-]+", re.split(r"@|[\[(]at[\])]", found, flags=re.I)[-1])
        return len(labels) > 1 and labels[-1].isalpha() and len(labels[-1]) > 1
    if kind == "ip":
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and (found[0] == "+" or found[:2] == "00" or digits[0] in "23456789" and digits[3:4] in tuple("23456789"))


def gazetteer(kind: str, found: str) -> int:
    digits = re.sub("[^0-9]", "", found)
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9-]+", found.lower().rstrip(")]"))[-1] in DOMAINS else -1
    if kind == "card":
        return 1 if len(digits) == 16 and re.match(r"4|5[1-5]|2[2-7]|6011|65|3[568]", digits) or len(digits) == 15 and digits[:2] in ("34", "37") else -1
    if kind == "ip":
        return -1 if re.match(r"(?:0|127|255)\.|\d\.\d\.\d\.\d\Z", found) else 1
    return 1 if found[0] == "+" or re.match(r"00[1-9]|\(?[2-9]", found) else -1


def votes(kind: str, text: str, a: int, b: int) -> tuple[int, int, int, int]:
    """Of LABELERS: 1 for personal data, -1 against, 0 abstains."""
    before = text[max(0, a - CONTEXT) : a]
    context = 1 if CUES[kind].search(before) else -1 if AGAINST.search(before) else 0
    around = text[max(0, a - 1) : a] + text[b : b + 1]
    edges = -1 if any(c.isdigit() or c in "-_/=" for c in around) else 1 if all(c.isspace() or c in "\"'()<>[],;:.!?" for c in around) else 0
    return 1 if checks(kind, text[a:b]) else -1, gazetteer(kind, text[a:b]), context, edges


def matches(kind: str, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Spans of the matches: leftmost, none overlapping another."""
    return [m.span() for m in pattern.finditer(text) if m["rest"]]


def candidates_of(text: str) -> list[dict]:
    """All base spans of a text, then others that overlap none of them: of looser patterns, then base matches that failed their check."""
    out = []
    digits, at = DIGIT.search(text), AT.search(text)
    for k, kind in enumerate(KINDS):
        if not (at if kind == "email" else digits):
            continue
        taken: list[tuple[int, int]] = []
        failed: list[tuple[int, int]] = []
        for a, b in matches(kind, BASE[kind], text) if NEEDS[kind] in text else ():
            if passes(kind, text[a:b]):
                taken.append((a, b))
            elif kind != "card" or 13 <= sum(map(str.isdigit, text[a:b])) <= 19:
                failed.append((a, b))
        out += [(k, a, b, True, votes(kind, text, a, b)) for a, b in taken]
        for found in (matches(kind, LOOSE[kind], text), failed):
            free = apart_from(found, taken)
            out += [(k, a, b, False, votes(kind, text, a, b)) for a, b in free]
            taken = sorted(taken + free)
    return [{"kind": k, "start": a, "end": b, "base": base, "code": _code(k, v)} for k, a, b, base, v in out]


def apart_from(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of spans in order, those that overlap none of the taken ones, which are in order and overlap none of their own."""
    out, k = [], 0
    for a, b in spans:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or b <= taken[k][0]:
            out.append((a, b))
    return out


def _code(kind: int, v: tuple[int, ...]) -> int:
    """Kind and votes as one number."""
    code = kind
    for x in v:
        code = code * 3 + x + 1
    return code


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) of each row."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32())]))

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([candidates_of(decoded(x)) for x in texts], kind)]

    return map_texts(docs, id_col, text_col, per_slice, [("found", SPAN)])


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kinds, votes as 0 against, 1 abstains, 2 for) of codes."""
    columns = []
    for _ in LABELERS:
        columns.append(codes % 3)
        codes = codes // 3
    return codes, np.stack(columns[::-1], axis=1)


def estimate(votes_: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: (probability of each vote pattern, reliabilities [class, labeler, vote])."""
    p = np.clip(0.5 + (votes_ - 1).sum(axis=1) / (2 * votes_.shape[1]), 0.05, 0.95)  # the majority to start with
    table = np.zeros((2, votes_.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        for v in range(3):
            # a labeler is taken to be right rather than wrong, so the classes can't change places
            table[:, :, v] = weight @ (votes_ == v) + np.where((v == 2) == np.arange(2)[:, None], 2.0, 1.0)
        table /= table.sum(axis=2, keepdims=True)
        score = np.stack([np.log(prior[c]) + sum(np.log(table[c, j, votes_[:, j]]) for j in range(votes_.shape[1])) for c in (0, 1)])
        p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -40, 40)))
    return p, table


def span_features(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    kinds, v = unpacked(codes)
    columns = [np.ones(len(codes))]
    columns += [(kinds == k).astype(float) for k in range(len(KINDS))]
    columns += [(v[:, j] == x).astype(float) for j in range(v.shape[1]) for x in (0, 2)]
    return np.stack([*columns, np.minimum(lengths, 64) / 64.0], axis=1)


def fit_spans(x: np.ndarray, p: np.ndarray, counts: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression on probable labels, by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    weight = counts / counts.sum()
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (q - p)) + 1e-3 * w
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


def train(found: DataFrame) -> dict[tuple[int, int], float]:
    """(code, length up to 64) -> probability, from the counts of all candidates: at most 324 codes times 65 lengths."""
    spans = found.select(F.explode("found").alias("s"))
    counts = spans.groupBy(F.col("s.code").alias("code"), F.least(F.col("s.end") - F.col("s.start"), F.lit(64)).alias("length")).count().orderBy("code", "length").collect()
    if not counts:
        return {}
    codes, lengths, n = (np.array([r[k] for r in counts]) for k in range(3))
    _, v = unpacked(codes)
    p, _ = estimate(v, n.astype(float))
    x = span_features(codes, lengths)
    q = 1 / (1 + np.exp(-np.clip(x @ fit_spans(x, p, n.astype(float)), -30, 30)))
    return {(int(c), int(k)): float(s) for c, k, s in zip(codes, lengths, q, strict=True)}


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = PASS) -> DataFrame:
    """(id, spans) of each row: (kind, start, end, base) in order of kind, then start."""
    found = stored(candidates(docs, id_col, text_col), "candidates")
    model = train(found)
    good = sorted(k for k, p in model.items() if p >= least)
    length = lambda s: F.least(s["end"] - s["start"], F.lit(64))
    if good:
        passing = F.array(*[F.lit(c * 100 + n) for c, n in good])
        keep = lambda s: s["base"] | F.array_contains(passing, s["code"] * 100 + length(s))
    else:
        keep = lambda s: s["base"]
    spans = F.array_sort(F.transform(F.filter("found", keep), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))))
    return found.select(id_col, spans.alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans() -> Column:
    return F.filter("spans", lambda s: s["base"])


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of each row with [KIND] in place of its spans; where spans overlap, the one that starts first is taken."""
    found = candidates(docs, id_col, text_col)
    good = {k for k, p in train(stored(found, "candidates")).items() if p >= PASS}

    def per_slice(texts: list[bytes]) -> list[pa.Array]:
        out = []
        for x in texts:
            text, parts, at = decoded(x), [], 0
            for s in sorted(candidates_of(text), key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at and (s["base"] or (s["code"], min(s["end"] - s["start"], 64)) in good):
                    parts += [text[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                    at = s["end"]
            out.append("".join(parts) + text[at:])
        return [pa.array(out, pa.string())]

    return map_texts(docs, id_col, text_col, per_slice, [(text_col, "string")])
