import zlib

import numpy as np
from llm_helpers import wide

from fleetlake.llm import pairwise_quality as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in q.score(docs, labels).collect()}
    assert len(rows) == docs.count()
    right = []
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    for label in labels.collect():
        if rows[label["doc_id"]]["held_out"]:
            right.append(rows[label["doc_id"]]["predicted"] == label["quality"])
    assert np.mean(right) > 0.97


def test_held_out_labels_do_not_matter(spark, load):
    from pyspark.sql import functions as F
    labels = load("labels")
    flipped = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in q.score(load("documents"), x).collect()} for x in (labels, flipped))
    assert a == b


def test_pairs_rank_as_a_fitted_logistic_would():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(1, 1, (300, 3)), draw.normal(0, 1, (80, 3))
    ranker = q.fit_pairs(good, bad, 5000)
    wins = (ranker.score(good)[:, None] > ranker.score(bad)[None]).mean()
    assert wins > 0.85 and (ranker.weights > 0).all()
    assert not q.fit_pairs(good, bad[:0]).weights.any()


def test_all_labelled_documents_take_part(spark, load, monkeypatch):
    """Above one block of labels nothing is sampled: the fit has every document's features."""
    from functools import partial
    docs, train = load("documents"), q.training_labels(load("labels"))
    found = q._map_features(q._texts(docs)).select("doc_id", "value").cache()
    ids = {r["doc_id"]: r["good"] for r in train.collect()}
    x = np.array([r["value"] for r in found.collect() if r["doc_id"] in ids])
    assert len(x) == len(ids) > 50
    ranker, share = q.fit(found, train, 20)
    assert np.allclose(ranker.mean, x.mean(axis=0)) and np.allclose(ranker.scale, x.std(axis=0) + 1e-6)
    assert share == np.mean([*ids.values()]) and ranker.weights.any()
    monkeypatch.setattr(q, "fit", partial(q.fit, rows=20))
    rows = {r["doc_id"]: r for r in q.score(docs, load("labels")).collect()}
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in load("labels").collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean(right) > 0.9


def test_blocks_without_both_kinds(spark):
    rows = [(i, [float(i % 7)] * q.FEATURES) for i in range(300)]
    found = spark.createDataFrame(rows, "doc_id long, value array<double>")
    for labels in ([(i, True) for i in range(300)], [(i, True) for i in range(900, 990)]):
        ranker, _ = q.fit(found, spark.createDataFrame(labels, "doc_id long, good boolean"), 20)
        assert not ranker.weights.any() and np.isfinite(ranker.scale).all()
    ranker, _ = q.fit(found, spark.createDataFrame([(i, i % 7 > 3) for i in range(300)], "doc_id long, good boolean"), 20)
    assert (ranker.weights > 0).all()


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "some words here"), (3, "word " * 100_000), (4, "x"), (5, "\n\n")]
    labels = wide(spark.createDataFrame([(1, 1), (1, 0), (4, 0), (3, 1), (9, None), (None, 1)],
                                        "doc_id long, quality int"))
    got = q.score(docs(*rows), labels).collect()
    assert len(got) == len(rows) and all(r["score"] is not None for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert not [r for r in got if r["doc_id"] is None][0]["held_out"]


def test_no_labels_or_documents(docs, load):
    got = q.score(docs((1, "a"), (2, "b")), load("labels").limit(0)).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.5, 1)] * 2
    assert q.score(docs((1, "a")).limit(0), load("labels")).count() == 0


def test_kept_drops_what_scores_low(docs, load):
    df = wide(load("documents"))
    out = q.kept(df, load("labels"))
    low = {r["doc_id"] for r in q.score(df, load("labels")).collect() if not r["predicted"]}
    assert low and out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in df.collect()} - low
