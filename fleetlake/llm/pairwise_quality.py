"""Document quality by Bradley-Terry pairwise ranking.

A preference pair is (a document labelled good, one labelled bad). The chance that the first
beats the second is the logistic function of the difference of their scores, and a score is
linear in the features of the whole text, so fitting is a logistic regression without intercept
on feature differences. The ranking has no natural cut: the threshold is the score quantile at
which the share above equals the share of good labels.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.llm.common import columns, released, text_key
from fleetlake.sources.scratch import materialised

# Labelled documents of a block, about, and preference pairs drawn in it. All blocks take part in the fit.
BLOCK_ROWS = 20_000
PAIRS = 60_000
# Width of the quantile band whose middle is the threshold.
_BAND = 0.01
_RIDGE = 1e-3
_SHARES = 10
FEATURES = 2 * _SHARES + 4


def held_out(key: Column, folds: int = 3, fold: int = 1) -> Column:
    """Documents that never take part in learning. A null key is not held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % folds == fold, F.lit(False))


def features(body: bytes | None) -> np.ndarray:
    """FEATURES numbers of one UTF-8 text; a null or empty text has the ones of no words."""
    body = body or b""
    byte = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    tokens, lines = body.split(), [x for x in body.split(b"\n") if x.strip()]
    counts = Counter(tokens)
    n, bytes_n = max(len(tokens), 1), max(len(body), 1)
    letters = max(int(byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum()), 1)
    common = byte[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]]
    symbols = byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum()
    ends = sum(x[-1] in b"!#$%&*" for x in tokens)
    shares = np.array([
        byte[65:91].sum() / letters, byte[48:58].sum() / bytes_n,
        (symbols - common.sum()) / bytes_n, byte[33] / bytes_n, common.sum() / bytes_n,
        byte[124] / n, ends / n, max(counts.values(), default=0) / n,
        1 - len(counts) / n, 1 - len(set(lines)) / max(len(lines), 1)])
    return np.concatenate([shares, np.log(shares + 0.003), [
        np.log1p(len(tokens)), np.log1p(len(body) / n), np.log1p(n / max(len(lines), 1)),
        np.log1p(len(counts)) / np.log1p(n)]])


class Ranker:
    """Weights on standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights


def _drawn(good: np.ndarray, bad: np.ndarray, ranker: Ranker, pairs: int, seed: int) -> np.ndarray:
    """Differences of ``pairs`` (good, bad) pairs; each document takes part equally."""
    draw = np.random.default_rng(seed)
    a = np.resize(draw.permutation(len(good)), pairs)
    b = np.resize(draw.permutation(len(bad)), pairs)
    draw.shuffle(b)
    z = [np.clip((x - ranker.mean) / ranker.scale, -8, 8) for x in (good, bad)]
    return z[0][a] - z[1][b]


def _sums(d: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the pairs' log likelihood."""
    p = 1 / (1 + np.exp(-np.clip(d @ weights, -30, 30)))
    return d.T @ (1 - p), (d * (p * (1 - p))[:, None]).T @ d


def _climb(ranker: Ranker, sums) -> Ranker:
    """Newton steps; ``sums`` gives slope, curvature and number of the pairs at some weights."""
    for _ in range(25):
        slope, curve, pairs = sums(ranker.weights)
        slope = slope / pairs - _RIDGE * ranker.weights
        curve = curve / pairs + _RIDGE * np.eye(len(slope))
        move = np.linalg.solve(curve, slope)
        ranker.weights = ranker.weights + move
        if np.abs(move).max() < 1e-6:
            break
    return ranker


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranker:
    """Fit by Newton steps on ``pairs`` (good, bad) pairs; each document takes part equally.

    Without documents of both kinds there are no pairs and all scores are 0.
    """
    both = np.concatenate([good, bad])
    width = both.shape[1]
    mean = both.mean(axis=0) if len(both) else np.zeros(width)
    scale = both.std(axis=0) + 1e-6 if len(both) else np.ones(width)
    ranker = Ranker(mean, scale, np.zeros(width))
    if not len(good) or not len(bad):
        return ranker
    d = _drawn(good, bad, ranker, pairs, seed)
    return _climb(ranker, lambda weights: (*_sums(d, weights), pairs))


_FEATURES = "doc_id long, text_key binary, value array<double>"


def _map_features(rows: DataFrame) -> DataFrame:
    """mapInArrow over (key, hash, text): the features of each text."""
    def run(batches):
        for batch in batches:
            x = [features(b.as_py()) for b in batch.column(2)]
            value = pa.array(np.array(x).reshape(len(x), FEATURES).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), value],
                                             names=["doc_id", "text_key", "value"])
    return rows.mapInArrow(released(run), _FEATURES)


def _map_scores(rows: DataFrame, ranker: Ranker) -> DataFrame:
    """The features of each text turned into its score."""
    def run(batches):
        for batch in batches:
            value = pa.array(ranker.score(_matrix(batch.column(2))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), value],
                                             names=["doc_id", "text_key", "value"])
    return rows.mapInArrow(run, "doc_id long, text_key binary, value double")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _texts(docs: DataFrame) -> DataFrame:
    return columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_key(F.col("text")), F.encode(F.col("text"), "utf-8"))


def training_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row (doc_id, good) per labelled document outside the held-out fold.

    Null labels and ids do not count; of several labels the majority holds, ties are good.
    """
    return (columns(labels, "doc_id", label)
            .where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                   & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg((F.avg(F.col(label)) >= 0.5).alias("good")))


def fit(found: DataFrame, train: DataFrame, rows: int = BLOCK_ROWS) -> tuple[Ranker, float]:
    """The ranker, fitted on the features (``doc_id``, ``value``) of all documents labelled in
    ``train``, and the share of good labels.

    Documents are dealt by a hash of their id into blocks of about ``rows``, and good and bad ones of
    a block meet in pairs. Only a single block, as small as any, reaches the driver; of several each
    is one row at rest, and a Newton step adds up what the blocks sum over their pairs.
    """
    n, good = train.agg(F.count(F.lit(1)), F.coalesce(F.avg(F.col("good").cast("double")),
                                                     F.lit(0.5))).first()
    blocks = max(1, -(-n // rows))
    labelled = found.groupBy("doc_id").agg(F.min("value").alias("value")).join(
        F.broadcast(train) if blocks == 1 else train, "doc_id")
    if blocks == 1:
        data = labelled.select("good", "value").toPandas()
        x = np.array(data["value"].tolist()).reshape(len(data), FEATURES)
        is_good = data["good"].to_numpy(bool)
        return fit_pairs(x[is_good], x[~is_good]), float(good)
    of = F.array_sort(F.collect_list(F.struct("good", "doc_id", "value")))
    block = materialised(
        labelled.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block")).agg(of.alias("x"))
        .select("block", F.col("x.good").alias("good"), F.flatten("x.value").alias("value")), "quality-blocks")
    return _fit_blocks(block), float(good)


def _fit_blocks(block: DataFrame) -> Ranker:
    """``fit_pairs`` over blocks (``block``, ``good``, ``value``: the features one after another)."""
    def total(make):
        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    number, good, value = (c[at] for c in batch.columns)
                    good = np.array(good.as_py(), bool)
                    x = value.values.to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
                    part = make(number.as_py(), x[good], x[~good])
                    if part is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), pa.array(
                            [np.concatenate([np.ravel(p) for p in part]).tolist()], pa.list_(pa.float64()))],
                            names=["block", "part"])

        parts = block.mapInArrow(released(run), "block long, part array<double>").toPandas().sort_values("block")
        return np.sum(np.array(parts["part"].tolist()), axis=0) if len(parts) else None

    def moments(number, good, bad):
        x = np.concatenate([good, bad])
        return len(x), len(good) > 0 and len(bad) > 0, x.sum(axis=0)

    found = total(moments)
    if found is None:  # labels of absent documents alone
        return Ranker(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES))
    mean = found[2:] / found[0]
    squares = total(lambda number, good, bad: (((np.concatenate([good, bad]) - mean) ** 2).sum(axis=0),))
    ranker = Ranker(mean, np.sqrt(squares / found[0]) + 1e-6, np.zeros(FEATURES))

    def sums(weights):
        def part(number, good, bad):
            if len(good) and len(bad):
                return *_sums(_drawn(good, bad, ranker, PAIRS, 7 + number), weights), PAIRS
            return None

        got = total(part)
        return got[:FEATURES], got[FEATURES:-1].reshape(FEATURES, FEATURES), got[-1]

    return _climb(ranker, sums) if found[1] else ranker


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, text_key, held_out, score (0 to 1), predicted (1 from 0.5 on); one row per row.

    Scores depend on the text alone, so repeated texts score alike; null and empty texts have
    the score of a text without words. The threshold is taken over all training labels. Without
    labels of both kinds no text ranks above another: all scores are 0.5. An empty table of documents
    gives no rows, further columns are ignored, a null id is never held out. Texts of any length count whole.
    """
    train = materialised(training_labels(labels, label), "quality-labels")
    found = materialised(_map_features(_texts(docs)), "quality-features")
    ranker, share = fit(found.select("doc_id", "value"), train)
    scored = materialised(_map_scores(found, ranker), "quality-scores")
    marks = [min(max(1 - share + d, 0.0), 1.0) for d in (-_BAND / 2, _BAND / 2)]
    cut = scored.join(train, "doc_id").agg(
        F.percentile_approx("value", marks, 100_000).alias("at")).first()["at"]
    cut = sum(cut) / 2 if cut else 0.0
    value = 1 / (1 + F.exp(-F.greatest(F.least(F.col("value") - F.lit(cut), F.lit(500.0)), F.lit(-500.0))))
    return scored.select("doc_id", "text_key", held_out(F.col("doc_id")).alias("held_out"),
                         value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``docs`` without the documents that score below 0.5; other columns stay."""
    bad = (score(docs, labels, label).where("predicted = 0")
           .select(F.col("doc_id").alias("_fleetlake_id"), F.col("text_key").alias("_fleetlake_key")).distinct())
    key = F.coalesce(text_key(docs["text"]), F.lit(b""))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_fleetlake_id"))
                     & (key == F.coalesce(F.col("_fleetlake_key"), F.lit(b""))), "left_anti")
