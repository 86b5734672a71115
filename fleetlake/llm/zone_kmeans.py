"""Centroid clustering over space-filling-curve zone maps.

Vectors become integers and are laid along a Hilbert curve through their most spread dimensions;
runs of neighbours on the curve form blocks, each with the smallest and largest value of every
dimension. A round is one pass over the blocks: the distance of a centroid to a block's box bounds
the distances to all of its vectors, so centroids whose least distance exceeds the smallest greatest
distance of another one are out of the question for the whole block. The others are compared with
every vector at once, in exact integer arithmetic. A block with one candidate is not compared at
all: its stored sum is added. Per task only (centroid, dimension) sums leave, so the driver sees
k * (dimensions + 1) numbers a round, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.llm.common import columns
from fleetlake.sources.scratch import materialised

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
# Vectors of a block; dimensions of the curve, those with the greatest variance, and bits of each.
BLOCK_ROWS = 256
CURVE_DIMENSIONS = 8
CURVE_BITS = 8
# Components beyond this have squared distances that no long can hold.
MOST = 1 << 27


def usable(vectors: DataFrame, dimensions: int | None, vector: str = "embedding") -> DataFrame:
    """(vec_id long, vector array<double>): rows whose vector has the wanted number of components
    (any, if None), all of them finite numbers."""
    rows = columns(vectors, "vec_id", vector).select(
        F.col("vec_id").cast("long"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    sized = F.col("vector").isNotNull() if dimensions is None else F.size("vector") == dimensions
    return rows.where(sized & finite)


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Arrow lists of equal length as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as longs; an error where squared distances would leave the range of a long."""
    whole = np.floor(scale * x)
    if whole.size and np.abs(whole).max() > MOST:
        raise ValueError(f"a component times {scale} exceeds {MOST}: distances do not fit a long")
    return whole.astype(np.int64)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (whole numbers below 2**bits), as
    bytes whose order is that of the curve.

    From the highest bit down, a set bit turns the lower bits of the first axis around and a clear
    one swaps them with the axis's; a Gray code over the axes and bits follows.
    """
    axes = np.ascontiguousarray(cells.T).astype(np.uint32)
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for axis in axes:
            swap = np.where(axis >> bit & 1, np.uint32(0), (axes[0] ^ axis) & low)
            turn = np.where(axis >> bit & 1, low, np.uint32(0))
            axes[0] ^= swap | turn
            axis ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros(axes.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] >> bit & 1, np.uint32((1 << bit) - 1), np.uint32(0))
    axes ^= flip
    planes = np.stack([axes >> bit & 1 for bit in range(bits - 1, -1, -1)])
    return np.packbits(planes.reshape(bits * len(axes), -1).T.astype(np.uint8), axis=1)


def spread(rows: DataFrame, dimensions: int, scale: int) -> np.ndarray:
    """Per dimension the least and greatest integer and the variance, from one row a task and
    dimension."""
    def run(batches):
        low, high = np.full(dimensions, MOST), np.full(dimensions, -MOST)
        n, total, square = 0, np.zeros(dimensions), np.zeros(dimensions)
        for batch in batches:
            x = integers(matrix(batch.column(0), dimensions), scale)
            if len(x):
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
                n, total, square = n + len(x), total + x.sum(axis=0), square + (x.astype(float) ** 2).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(low), pa.array(high),
                 pa.array(np.full(dimensions, n)), pa.array(total), pa.array(square)],
                names=["pos", "low", "high", "n", "total", "square"])

    found = (rows.select("vector")
             .mapInArrow(run, "pos int, low long, high long, n long, total double, square double")
             .groupBy("pos").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"),
                                 F.sum("total").alias("total"), F.sum("square").alias("square"))
             .orderBy("pos").collect())
    return np.array([(r["low"], r["high"], r["square"] / r["n"] - (r["total"] / r["n"]) ** 2) for r in found])


def blocks(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE,
           block_rows: int = BLOCK_ROWS, vector: str = "embedding") -> DataFrame:
    """The zone map: (ids array<long>, codes binary, low, high, total array<long>), a row per block.

    ``codes`` holds the block's vectors as 32-bit integers, row by row. Vectors are dealt by ranges
    of (curve position, hash of the id), so equal vectors, however many, spread over tasks.
    """
    rows = usable(vectors, dimensions, vector)
    box = spread(rows, dimensions, scale)
    if not len(box):
        return rows.sparkSession.createDataFrame(
            [], "ids array<long>, codes binary, low array<long>, high array<long>, total array<long>")
    axes = np.argsort(-box[:, 2], kind="stable")[:CURVE_DIMENSIONS]
    start, width = box[axes, 0], box[axes, 1] - box[axes, 0] + 1

    def place(batches):
        for batch in batches:
            x = integers(matrix(batch.column(1), dimensions), scale)
            cells = ((x[:, axes] - start) * (1 << CURVE_BITS) / width).astype(np.uint32)
            key = hilbert(cells, CURVE_BITS)
            code = np.ascontiguousarray(x, dtype="<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k.tobytes() for k in key], pa.binary()),
                 pa.array([c.tobytes() for c in code], pa.binary())], names=["vec_id", "key", "code"])

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                body = b"".join(part.column(1).to_pylist())
                x = np.frombuffer(body, "<i4").reshape(-1, dimensions).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([body], pa.binary())]
                    + [pa.array([v.tolist()], pa.list_(pa.int64()))
                       for v in (x.min(axis=0), x.max(axis=0), x.sum(axis=0))],
                    names=["ids", "codes", "low", "high", "total"])

    placed = rows.mapInArrow(place, "vec_id long, key binary, code binary")
    return (placed.repartitionByRange("key", F.xxhash64("vec_id"))
            .sortWithinPartitions("key", F.xxhash64("vec_id")).select("vec_id", "code")
            .mapInArrow(cut, "ids array<long>, codes binary, low array<long>, high array<long>, total array<long>"))


def seeds(vectors: DataFrame, k: int, dimensions: int, scale: int, seed: int = SEED,
          vector: str = "embedding") -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order; all of them if
    there are fewer. Null ids come last; equal ids are ordered by their vectors."""
    rows = usable(vectors, dimensions, vector)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(name.asc_nulls_last(), "vector").select("vector").limit(k).collect()
    return integers(np.array([r["vector"] for r in first]).reshape(len(first), dimensions), scale)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box."""
    nearest = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    least, most = (nearest * nearest).sum(axis=1), (farthest * farthest).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row; the first of equals.

    In doubles, where every partial sum is a whole number below 2**53, else in longs.
    """
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    exact = np.float64 if 4 * x.shape[1] * reach * reach < 1 << 53 else np.int64
    x, centroids = x.astype(exact), centroids.astype(exact)
    away = (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)
    number = away.argmin(axis=1)
    return number, away[np.arange(len(x)), number].astype(np.int64)


def _compared(batch: pa.RecordBatch, centroids: np.ndarray):
    """Per block of a batch: (row, candidates, vectors)."""
    d = centroids.shape[1]
    low, high = (matrix(batch.column(batch.schema.get_field_index(c)), d) for c in ("low", "high"))
    codes = batch.column(batch.schema.get_field_index("codes"))
    for i in range(batch.num_rows):
        x = np.frombuffer(codes[i].as_buffer(), "<i4").reshape(-1, d).astype(np.int64)
        yield i, candidates(low[i], high[i], centroids), x


def moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each one's vectors; empty ones stay."""
    k, d = centroids.shape

    def run(batches):
        total = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            sums = matrix(batch.column(batch.schema.get_field_index("total")), d)
            for i, near, x in _compared(batch, centroids):
                if len(near) == 1:
                    total[near[0], :d] += sums[i]
                    total[near[0], d] += len(x)
                    continue
                number, _ = nearest(x, centroids[near])
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                total[near[found], :d] += np.add.reduceat(x[order], first, axis=0)
                total[near[found], d] += np.diff([*first, len(x)])
        used = np.flatnonzero(total[:, d])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, d + 1).astype(np.int32)),
             pa.array(np.tile(np.arange(d + 1, dtype=np.int32), len(used))),
             pa.array(total[used].ravel())], names=["cluster", "pos", "value"])

    sums = (zones.select("codes", "low", "high", "total").mapInArrow(run, "cluster int, pos int, value long")
            .groupBy("cluster", "pos").agg(F.sum("value").alias("value")).collect())
    total = np.zeros((k, d + 1), object)
    for r in sums:
        total[r["cluster"], r["pos"]] = r["value"]
    out = centroids.copy()
    for j in range(k):
        if total[j, d]:
            out[j] = [v // total[j, d] for v in total[j, :d]]
    return out


def assigned(zones: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, compared): the nearest centroid of every vector, and how many
    centroids its block was compared with."""
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for i, near, x in _compared(batch, centroids):
                number, distance = nearest(x, centroids[near])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, 1).flatten(), pa.array(near[number].astype(np.int32)), pa.array(distance),
                     pa.array(np.full(len(x), len(near), np.int32))],
                    names=["vec_id", "cluster", "distance", "compared"])

    return (zones.select("ids", "codes", "low", "high")
            .mapInArrow(run, "vec_id long, cluster int, distance long, compared int"))


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: int = SEED, block_rows: int = BLOCK_ROWS,
            vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, compared, cluster_inertia, inertia, centroid, centroid_sha256.

    One row per row whose vector has ``dimensions`` components, all finite; others (null, shorter,
    longer, with nulls, NaN or infinities) are left out. Repeated rows each get theirs; null ids are
    kept; further columns are ignored; an empty table gives no rows. A component so large that its
    squared distances do not fit a long is an error. Ties go to the smaller centroid. Fewer vectors
    than ``k`` make fewer centroids.
    """
    spark: SparkSession = vectors.sparkSession
    centroids = seeds(vectors, k, dimensions, scale, seed, vector)
    zones = materialised(blocks(vectors, dimensions, scale, block_rows, vector), "zones")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(zones, centroids)
    rows = materialised(assigned(zones, centroids), "assigned")
    named = spark.createDataFrame(
        [(i, c.tolist(), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
         for i, c in enumerate(centroids)], "cluster int, centroid array<long>, centroid_sha256 string")
    # One row per centroid, at most k.
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia = spark.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], sum(s["cluster_inertia"] for s in sums)) for r in sums],
        "cluster int, cluster_inertia long, inertia long")
    facts = F.broadcast(named.join(inertia, "cluster"))
    return rows.join(facts, "cluster").select(
        "vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
