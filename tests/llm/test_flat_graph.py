import numpy as np
from llm_helpers import wide

from fleetlake.llm import flat_graph as g


def brute(rows, cosine=0.95):
    out = {}
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(np.array(v, float))
        x = np.array(v, np.float64) if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    n = len(rows)
    up = list(range(n))
    degree = [0] * n

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) \
                    and units[i] @ units[j] >= cosine:
                degree[i] += 1
                degree[j] += 1
                up[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), name), name)
    return sorted((name, degree[i], low[find(i)], low[find(i)] == name) for i, (name, _) in enumerate(rows))


def frame(spark, rows):
    return wide(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def got(df):
    return sorted(tuple(r) for r in g.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [1.0, None]), (9, []), (10, [0.0, 1.0]), (11, [0.0, 1.0, 0.0]), (12, [0.0, 1.0, 0.01]), (13, [-1.0, 0.0]),
            (2, [1.0, 0.0])]
    assert got(frame(spark, rows)) == brute(rows)
    assert g.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_clusters_and_blocks_reach_all_links(spark, monkeypatch):
    draw = np.random.default_rng(2)
    centre = draw.normal(size=(12, 16))
    rows = [(i, (centre[i % 12 if i % 3 else 0] + 0.08 * draw.normal(size=16)).tolist()) for i in range(400)]
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    monkeypatch.setattr(g.search_links, "__defaults__", (g.COSINE, g.OVERLAP, 40, 50))
    found, true = got(frame(spark, rows)), brute(rows)
    assert sum(r[1] for r in found) >= 0.98 * sum(r[1] for r in true)
    assert all(a[1] <= b[1] for a, b in zip(found, true))
    assert [r[2] for r in found] == [r[2] for r in true]


def planted(load, sizes=(2, 3, 5, 40, 250)):
    """The test table with groups of near copies of its vectors planted in it."""
    draw = np.random.default_rng(9)
    rows = [(r["vec_id"], r["embedding"]) for r in load("embeddings").collect()]
    spread = np.linalg.norm(rows[0][1]) / 64 ** 0.5
    for g_, size in enumerate(sizes):
        middle = np.array(rows[g_ * 7][1])
        rows += [(100_000 * (g_ + 1) + i, np.float32(middle + 0.15 * spread * draw.normal(size=64)).astype(float).tolist())
                 for i in range(size)]
    return rows


def test_links_planted_in_the_table_over_several_blocks(spark, load, monkeypatch):
    rows = planted(load)
    monkeypatch.setattr(g.search_links, "__defaults__", (g.COSINE, g.OVERLAP, 100, 90))
    found, true = got(frame(spark, rows)), brute(rows)
    assert [r[2] for r in found] == [r[2] for r in true] and sum(r[1] > 0 for r in true) > 300
    assert sum(r[1] for r in found) >= 0.97 * sum(r[1] for r in true)
    assert all(a[1] <= b[1] for a, b in zip(found, true))


def test_large_shards_are_split_again(spark, load, monkeypatch):
    rows = planted(load)
    monkeypatch.setattr(g, "MOST_SHARDS", 3)
    monkeypatch.setattr(g, "SPLIT_ROWS", 70)
    nodes = g.materialised(spark.createDataFrame(
        [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, (_, v) in enumerate(rows)],
        "node long, unit array<double>"), "nodes")
    first = g.materialised(g._placed(nodes, np.eye(64)[:1], 1), "shards")
    parts = g._split(first, 2, 60)
    assert parts.count() == 2 * len(rows) and parts.groupBy("node").count().where("count <> 2").isEmpty()
    assert parts.select("cluster").distinct().count() == 3
    again = g._split(g.materialised(parts, "shards"), 2, 60)
    assert again.select("cluster").distinct().count() > 3
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v in rows])
    true = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= g.COSINE)) if i < j}
    links = {(r["a"], r["b"]) for r in g.search_links(nodes, g.COSINE, 2, 40, 90).collect()}
    assert links <= true and len(links) >= 0.9 * len(true)


def test_pairs_just_below_the_cosine_do_not_link():
    x = np.array([[1.0, 0.0]])
    just = [0.95 - 1e-14, 0.95, 0.95 + 1e-14]
    y = np.array([[c, (1 - c * c) ** 0.5] for c in just])
    value = np.full(3, 0.95 + 1e-13)  # as if rounding had lifted them all
    assert g.reaching(x, y, np.zeros(3, int), np.arange(3), value, 0.95).tolist() == [False, True, True]


def test_search_reaches_what_brute_force_finds():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(600, 24))
    x[300:] = x[:300] + 0.15 * draw.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, b, v = g.range_search(x, g.robust_pruned(x), x, 0.95)
    true = {(i, j) for i, j in zip(*np.nonzero(x @ x.T >= 0.95))}
    assert {*zip(q.tolist(), b.tolist())} <= true and len(q) >= 0.97 * len(true)
    assert len({*zip(q.tolist(), b.tolist())}) == len(q) and (v >= 0.95).all()


def test_lists_hold_no_node_twice_and_few():
    x = np.random.default_rng(5).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = g.robust_pruned(x)
    assert lists.shape[1] <= 2 * g.DEGREE


def tight_groups(groups=10, each=100, seed=7):
    """Unit vectors in groups: cosine 0.95 or more within one, below 0.4 between."""
    draw = np.random.default_rng(seed)
    centre = np.linalg.qr(draw.normal(size=(32, 32)))[0][:groups]
    x = np.repeat(centre, each, axis=0) + 0.02 * draw.normal(size=(groups * each, 32))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_tight_groups_larger_than_the_candidates_keep_their_links(spark):
    x = tight_groups()
    true = x @ x.T >= 0.95
    q, b, _ = g.range_search(x, g.robust_pruned(x), x, 0.95)
    assert len(q) >= 0.97 * true.sum() and true[q, b].all()
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in enumerate(x)]
    found = g.near_duplicates(frame(spark, rows)).collect()
    assert {r["component_id"] for r in found} == set(range(0, 1000, 100))
    assert sum(r["n_links"] for r in found) >= 0.97 * (true.sum() - 1000)


def test_parts_without_links_have_entries_of_their_own():
    x = tight_groups(3, 5)
    lists = np.array([[i // 5 * 5 + (i + 1) % 5] for i in range(15)])
    assert sorted(i // 5 for i in g.entries(x, lists)) == [0, 1, 2]
    q, _, _ = g.range_search(x, lists, x, 0.95)
    assert len(q) == 15 * 5


def test_low_recall_ends_in_exact_comparison(spark, monkeypatch):
    x = tight_groups(6, 20)
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in enumerate(x)]
    none = np.empty(0, int)
    monkeypatch.setattr(g, "range_search", lambda *_: (none, none, none))
    assert got(frame(spark, rows)) == brute(rows)


def test_audit_counts_rows_not_pairs(spark):
    x = np.repeat(np.eye(8)[:5], [40, 2, 2, 2, 2], axis=0)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, unit array<double>")
    links = spark.createDataFrame([(i, j) for j in range(40) for i in range(j)], "a long, b long")
    assert abs(g.audit(nodes, links) - 40 / 48) < 1e-9
