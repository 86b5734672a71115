import random
import re

import numpy as np
from llm_helpers import wide

from fleetlake.llm import skip_chain as s

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(1, *m.span()) for m in EMAIL.finditer(text)]
    out += [(2, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(3, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(4, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_patterns_against_plain_regular_expressions():
    draw = random.Random(2)
    for _ in range(5000):
        text = "".join(draw.choice("a1234567890..@@- +()_é\n") for _ in range(draw.randint(0, 60)))
        assert s.base_spans(text) == brute(text)


def test_long_odd_texts_take_linear_time():
    for piece, times in (("1", 100_000), ("1.", 50_000), ("1 ", 50_000), ("+1(", 50_000), ("a@", 50_000), ("@a.b", 30_000)):
        text = piece * times
        s.added_spans(text, s.base_spans(text), s.Potentials({}))


def test_distant_repeats_are_added_and_unlinked_numbers_are_not(load):
    model = s.fit(load("documents"))
    far = "words " * 300
    text = f"Call +1 (017) 555-7713. {far} 555-7713 or (017) 555 7713. Order 7654321, 12 items, 2024-01-05."
    added = s.added_spans(text, s.base_spans(text), model)
    assert [(s.LABELS[k], text[a:b]) for k, a, b in added] == [("phone", "555-7713"), ("phone", "(017) 555 7713")]
    assert s.mask(text, s.base_spans(text) + added).count("[PHONE]") == 3
    lone = f"{far} 555-7713 and order 7654321"
    assert s.added_spans(lone, s.base_spans(lone), model) == []


def test_messages_on_a_tree_give_exact_marginals():
    draw = np.random.default_rng(1)
    unary = draw.normal(size=(4, 5))
    edges = [(0, 1), (1, 2), (1, 3)]
    table = draw.normal(size=(3, 5, 5))
    total = np.zeros((4, 5))
    for x in np.ndindex(5, 5, 5, 5):
        weight = np.exp(sum(unary[i, x[i]] for i in range(4)) + sum(t[x[a], x[b]] for t, (a, b) in zip(table, edges)))
        for i in range(4):
            total[i, x[i]] += weight
    assert np.allclose(s.marginals(unary, edges, table, rounds=80), total / total.sum(axis=1, keepdims=True), atol=1e-6)


def test_whole_table_keeps_every_base_span(load):
    texts = {r["doc_id"]: r["text"] for r in load("documents").collect()}
    for r in s.detect(wide(load("documents"))).collect():
        assert [(s.LABELS.index(x["kind"]), x["start"], x["end"]) for x in r["base"]] == brute(texts[r["doc_id"]])
        if not r["base"]:
            assert r["masked"] == texts[r["doc_id"]] and not r["added"]


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "é 1.2.3.4 x"), (4, "999.1.1.1"), (5, "x " * 100_000 + "a@b.c")]
    got = s.detect(docs(*rows)).collect()
    assert sorted((str(r["doc_id"]), [(x["kind"], x["start"], x["end"]) for x in r["base"]]) for r in got) == [
        ("1", []), ("2", []), ("3", [("email", 0, 5)]), ("3", [("email", 0, 5)]), ("4", []),
        ("5", [("email", 200_000, 200_005)]), ("None", [("ip", 2, 9)])]
    assert [r["masked"] for r in got if r["doc_id"] == 1] == [None]
    assert s.detect(docs((1, "a")).limit(0)).count() == 0


def test_redacted_keeps_rows_and_columns(docs):
    df = docs((1, "mail a@b.c now"), (2, None), (3, "clean"))
    out = s.redacted(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "mail [EMAIL] now", 2: None, 3: "clean"}


def test_potentials_come_from_all_documents(spark, monkeypatch):
    from pyspark.sql import functions as F
    n = 25_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("write to a1@b.example now").alias("text"))
    monkeypatch.setattr(s, "Potentials", dict)
    assert sum(v for k, v in s.fit(docs).items() if k[0] == "s") == n
