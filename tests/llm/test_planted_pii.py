"""Spans that the base patterns can't see, planted into the given documents among look-alikes: how many are found, and how many of what is found is right."""

import random

from pyspark.sql import functions as F

from tidemark.llm import pii

DATA = "/root/testdata/sf0.01"


def card(rng):
    digits = [4, *(rng.randrange(10) for _ in range(14))]
    total = sum(sum(divmod(2 * d, 10)) if k % 2 == 0 else d for k, d in enumerate(digits))
    return "".join(map(str, [*digits, -total % 10]))


def planted(rng):
    """(text before, kind or None for a look-alike, text) of one span."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = "".join(rng.choices("abcdefghij", k=6))
    area = f"{rng.randrange(2, 10)}{d(2)}"
    local = f"{rng.randrange(2, 10)}{d(2)}"
    number = card(rng)
    dotted = ".".join(number[k : k + 4] for k in (0, 4, 8, 12))
    wrong = dotted[:-1] + str((int(dotted[-1]) + 5) % 10)
    return rng.choice(
        [
            ("mail me at ", "email", f"{name} [at] {name}{d(1)} [dot] com"),
            ("", "email", f"{name}(at){name}.org"),
            ("call ", "phone", f"({area}) {local}-{d(4)}"),
            ("tel: ", "phone", f"{area}-{local}-{d(4)}"),
            ("my card is ", "card", dotted),
            ("server ", "ip", f"{rng.randrange(11, 99)}[.]{d(2).lstrip('0') or 1}[.]{rng.randrange(1, 200)}[.]{rng.randrange(1, 200)}"),
            ("order ", None, wrong),
            ("version ", None, f"{rng.randrange(300, 999)}[.]{rng.randrange(300, 999)}[.]{rng.randrange(300, 999)}[.]{rng.randrange(300, 999)}"),
            ("ratio ", None, f"{d(3)}/{d(3)}-{d(4)}"),
            ("meet (at) the gate ", None, f"no. {d(5)}"),
            ("id ", None, f"1{d(2)}-1{d(2)}-{d(4)}"),
        ]
    )


def test_planted_spans(spark):
    rng, rows, true = random.Random(7), [], set()
    for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        text = r.text or ""
        if rng.random() < 0.5:
            before, kind, span = planted(rng)
            at = len(text) + 2 + len(before)
            text = f"{text}. {before}{span} and so on."
            if kind:
                true.add((r.doc_id, kind, at, at + len(span)))
        rows.append((r.doc_id, text))
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string"))
    added = {(r.doc_id, pii.KINDS[s.kind], s.start, s.end) for r in found.select("doc_id", F.explode("spans").alias("s")).where("NOT s.base").selectExpr("doc_id", "s").collect() for s in [r.s]}
    recall, precision = len(added & true) / len(true), len(added & true) / len(added)
    print(f"planted {len(true)}, added {len(added)}, recall {recall:.3f}, precision {precision:.3f}")
    assert recall >= 0.9 and precision >= 0.95, (recall, precision, sorted(true - added)[:5], sorted(added - true)[:5])


def test_a_number_is_taken_whole():
    text = "call +1 (826) 555-4081 190.137.2.1 or 0049 301-555-4081"
    spans = {text[s["start"] : s["end"]] for s in pii.candidates_of(text) if s["kind"] == 3}
    assert {"+1 (826) 555-4081", "0049 301-555-4081"} <= spans
