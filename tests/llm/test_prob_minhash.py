import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
from llm_helpers import wide

from fleetlake.llm import prob_minhash as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    n = min(5, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()


def brute_groups(rows):
    """Row sets linked by equal texts or Jaccard similarity of 0.8 or more."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        ta, tb = rows[a][1], rows[b][1]
        if ta is None or tb is None:
            continue
        both = len(sets[a] & sets[b])
        if ta == tb or both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            up[find(a)] = find(b)
    out = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        out[find(i)].append(doc)
    return sorted(sorted(x, key=str) for x in out.values())


def groups(df):
    out = defaultdict(list)
    rows = m.near_duplicates(df).collect()
    for r in rows:
        out[r["group_id"]].append((r["doc_id"], r["kept"]))
    for name, found in out.items():
        if name is not None:
            assert sum(k for _, k in found) == 1 and name == min(d for d, _ in found if d is not None)
    return sorted(sorted((d for d, _ in x), key=str) for x in out.values())


def test_whole_table_against_brute_force(load):
    rows = [(r["doc_id"], r["text"]) for r in load("documents").collect()]
    assert groups(load("documents")) == brute_groups(rows)


def test_edges(docs):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base.replace("w30", "other")), (3, base.upper()), (3, base), (3, base), (4, "a b"), (5, "A, b!"),
            (6, ""), (7, ""), (8, "..."), (9, "!!!"), (10, "c"), (12, "word " * 50_000), (13, "word " * 50_000)]
    assert groups(docs(*rows)) == brute_groups(rows)
    got = m.near_duplicates(docs((1, None), (2, None), (None, "x y z"), (None, "x y z"))).collect()
    assert sorted((str(r["doc_id"]), r["kept"], r["copies"]) for r in got) == [
        ("1", True, 1), ("2", True, 1), ("None", False, 2), ("None", True, 2)]
    assert m.near_duplicates(docs((1, "a")).limit(0)).count() == 0


def test_chain_of_near_copies_in_one_large_group(docs):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = list(words)
        w[draw.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(w)))
    assert groups(docs(*rows)) == brute_groups(rows)


def test_shared_passages_do_not_link(docs):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"d{i}_{k}" for k in range(40))) for i in range(120)]
    assert groups(docs(*rows)) == brute_groups(rows) and len(groups(docs(*rows))) == 120


def test_registers_estimate_probability_jaccard():
    draw = np.random.default_rng(3)
    element = draw.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = element[:220], element[80:]
    wa, wb = draw.integers(1, 6, 220), draw.integers(1, 6, 220)
    x = dict(zip(a.tolist(), m.weights(wa).tolist()))
    y = dict(zip(b.tolist(), m.weights(wb).tolist()))
    exact = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in {*x} & {*y})
    won = m.registers(np.repeat([0, 1], 220), np.concatenate([a, b]),
                      m.weights(np.concatenate([wa, wb])), 2, 20_000)
    assert abs((won[0] == won[1]).mean() - exact) < 0.02
    order = np.argsort(a), np.argsort(b)
    plain = len({*x} & {*y}) / len({*x, *y})
    assert abs(m.similarity(a[order[0]], wa[order[0]], b[order[1]], wb[order[1]]) - max(plain, exact)) < 1e-9


def test_deduplicated_keeps_columns_and_one_row_per_group(docs):
    df = docs((2, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (3, None), (3, None), (4, ""))
    out = m.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 3, 4]
    assert {r["_key"] for r in out.collect()} == {"x"}
    assert m.deduplicated(wide(df.limit(0))).count() == 0


def test_repeats_do_not_hide_plain_similarity(docs):
    rows = []
    for i in range(12):
        words = [f"t{i}w{k}" for k in range(300)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[:90] * 30))]
    for i in range(12, 18):
        words = [f"t{i}w{k}" for k in range(300)]
        rows += [(2 * i, " ".join(words + words[:60] * 100)), (2 * i + 1, " ".join(words + words[200:260] * 100))]
    assert groups(docs(*rows)) == brute_groups(rows) and len(brute_groups(rows)) == 18
