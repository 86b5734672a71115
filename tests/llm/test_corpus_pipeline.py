import hashlib

from llm_helpers import SF, wide

import corpus_pipeline
from fleetlake.llm import pairwise_quality, positional_index, prob_minhash, skip_chain


def test_every_stage_takes_effect(spark, load):
    docs = load("documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    low = {r["doc_id"] for r in pairwise_quality.score(docs, load("labels")).collect() if not r["predicted"]}
    good = docs.where(~docs["doc_id"].isin([*low])) if low else docs
    groups = prob_minhash.near_duplicates(good).collect()
    one = {r["doc_id"] for r in groups if r["kept"]}
    assert len(one) == len({r["group_id"] for r in groups})
    hit = {r["doc_id"] for r in positional_index.contamination(docs, load("benchmark")).collect() if r["n_hit"]}
    left = one - hit
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == left and len(out) == len(left)
    assert low and hit & one and len(one) < good.count()
    model = skip_chain.fit(docs)
    for r in out:
        base = skip_chain.base_spans(text[r["doc_id"]])
        masked = skip_chain.mask(text[r["doc_id"]], base + skip_chain.added_spans(text[r["doc_id"]], base, model))
        assert r["decoded_sha256"] == hashlib.sha256(masked.encode()).hexdigest()
        assert r["n_tokens"] == len(r["tokens"])


def test_stages_keep_columns_and_bear_empty_tables(spark, load):
    for docs in (wide(load("documents").limit(40)), wide(load("documents").limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_stages_bear_nulls_repeats_and_long_texts(spark, load):
    from pyspark.sql import functions as F
    base = load("documents").limit(12)
    odd = spark.createDataFrame(
        [(None, None), (None, ""), (1, None), (2, ""), (2, ""), (None, "the same words stand here twice over"),
         (None, "the same words stand here twice over"), (900_001, "a long line of plain words, told again. " * 20_000)],
        "doc_id long, text string")
    docs = base.unionByName(odd, allowMissingColumns=True).unionByName(base.limit(3)).withColumn("part", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).collect()
        assert len(out) <= docs.count(), name
        if name in ("pii", "byte_bpe"):
            assert len(out) == docs.count()
        if name == "minhash_near_dedup":
            assert sum(r["text"] is None for r in out) == 2
            assert sum(r["text"] == "the same words stand here twice over" for r in out) == 1
        if name == "byte_bpe":
            assert sum(r["n_tokens"] == 0 for r in out) == 5


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "pii", "byte_bpe"]
