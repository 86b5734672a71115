import hashlib

import duckdb
import numpy as np
import pytest
from llm_helpers import SF, wide

from fleetlake.llm import queries, zone_kmeans as z


def brute(rows, k=40, rounds=5, dims=64):
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and None not in v and np.isfinite(v).all()]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return min(range(len(centres)), key=lambda j: (away[j], j)), min(away)

    for _ in range(rounds):
        mine = [nearest(v)[0] for _, v in kept]
        for j in range(len(centres)):
            of = [v for (_, v), m in zip(kept, mine) if m == j]
            if of:
                centres[j] = [sum(c) // len(of) for c in zip(*of)]
    last = [nearest(v) for _, v in kept]
    total = [sum(d for c, d in last if c == j) for j in range(len(centres))]
    return sorted((str(i), c, d, total[c], sum(total),
                   hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                  for (i, _), (c, d) in zip(kept, last))


def got(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                   r["centroid_sha256"]) for r in df.collect())


def frame(spark, rows):
    return wide(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def test_whole_table(load):
    rows = [(r["vec_id"], r["embedding"]) for r in load("embeddings").collect()]
    assert got(z.cluster(load("embeddings"))) == brute(rows)


def test_edges(spark):
    draw = np.random.default_rng(1)
    far = [(i, (draw.standard_normal(64) + 5 * (i % 3)).tolist()) for i in range(30)]
    rows = far + far[:3] + [(7, [0.5] * 64)] * 3 + [
        (40, None), (41, []), (42, [1.0] * 63), (43, [1.0] * 65), (44, [None] + [1.0] * 63),
        (45, [float("nan")] * 64), (46, [float("inf")] + [0.0] * 63), (47, [0.0] * 64), (None, [2.0] * 64),
        (None, [2.0] * 64), (None, [-1.0] * 64)]
    assert got(z.cluster(frame(spark, rows))) == brute(rows)
    few = rows[-5:]
    assert got(z.cluster(frame(spark, few))) == brute(few)
    assert z.cluster(frame(spark, rows[:1]).limit(0)).count() == 0
    assert z.cluster(frame(spark, [(1, None)])).count() == 0
    with pytest.raises(Exception, match="do not fit"):
        z.cluster(frame(spark, [(1, [1e30] * 64)])).count()


def test_boxes_prune_and_one_candidate_blocks_add_up(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.standard_normal(64) * 0.01 + 3 * ((i % 8) == np.arange(64) % 8)).tolist()) for i in range(800)]
    found = z.cluster(frame(spark, rows), block_rows=16)
    assert got(found) == brute(rows)
    assert found.agg({"compared": "avg"}).first()[0] < 30
    few = z.cluster(frame(spark, rows), k=3, block_rows=16)
    assert got(few) == brute(rows, k=3) and few.agg({"compared": "min"}).first()[0] == 1


def test_hilbert_neighbours_touch():
    for bits, axes in ((3, 2), (2, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = [k.tobytes() for k in z.hilbert(cells, bits)]
        assert len(set(keys)) == len(keys)
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_large_numbers_stay_exact():
    draw = np.random.default_rng(3)
    x, c = draw.integers(-z.MOST, z.MOST, (50, 64)), draw.integers(-z.MOST, z.MOST, (7, 64))
    number, away = z.nearest(x, c)
    truth = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
    assert [int(n) for n in number] == [min(range(7), key=lambda j: (t[j], j)) for t in truth]
    assert away.tolist() == [min(t) for t in truth]


def test_expected_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    df = queries.QUERIES["op11_zone_kmeans"](spark, SF)
    cols = sorted(df.columns)
    expected = con.execute(f"select {', '.join(cols)} from ({queries.ORACLES['op11_zone_kmeans']})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(expected)
