import re

import pytest
from llm_helpers import wide

from fleetlake.llm import positional_index as p

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    grams = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out.append((doc is None, doc or 0, len(w), len(hit), sorted(found)))
    return sorted(out)


def got(df, bench, **kw):
    rows = p.contamination(df, bench, **kw).collect()
    for r in rows:
        assert r["n_hit"] == sum(b - a for a, b in r["runs"]) or kw.get("block_words")
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in rows)


DOCS = [(1, "The quick brown fox jumps over the lazy dog and runs far away today"), (2, None), (3, ""),
        (4, "..., !!"), (5, "one TWO"), (5, "one TWO"), (None, "x one, two y one two"),
        (6, "lazy dog lazy dog lazy dog"), (7, "ça été naïve " * 20), (8, "a " * 60_000 + "one two")]
ITEMS = [(1, "quick brown fox jumps over the lazy dog and runs far"), (2, "one two"), (2, "lazy dog"), (3, None),
         (4, "!!"), (None, "été naïve ça"), (10, "one two")]


@pytest.mark.parametrize("block_words", [None, 4])
def test_edges(spark, docs, block_words):
    bench = wide(spark.createDataFrame(ITEMS, "item_id long, text string"))
    kw = {"block_words": block_words} if block_words else {}
    assert got(docs(*DOCS), bench, **kw) == brute(DOCS, ITEMS)


def test_whole_tables(load):
    docs, items = ([(r[0], r["text"]) for r in load(t).collect()] for t in ("documents", "benchmark"))
    assert got(load("documents"), load("benchmark")) == brute(docs, items)


def test_empty_tables(docs, load):
    bench = load("benchmark")
    assert p.contamination(docs((1, "a")).limit(0), bench).count() == 0
    assert got(docs((1, "a b")), bench.limit(0)) == [(False, 1, 2, 0, [])]


def test_small_segments_give_the_same(docs, load):
    phrases = next(p.phrase_blocks(load("benchmark")))
    one = p.search(p.build_index(load("documents"), phrases), phrases)
    many = p.search(p.build_index(load("documents"), phrases, segment_words=500), phrases)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_proximity(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    df = docs((1, "alpha x beta y gamma"), (2, "alpha x x x x beta gamma"), (3, "beta alpha gamma"), (4, "alpha"),
              (5, "beta gamma"))
    near = {r["doc_id"]: bool(r["items"]) for r in p.contamination(df, bench, slop=2).collect()}
    assert near == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert not any(r["items"] for r in p.contamination(df, bench).collect())


def test_decontaminated_keeps_columns_and_clean_rows(spark, docs):
    df = docs(*DOCS)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = p.decontaminated(df, bench)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 3, 4]
