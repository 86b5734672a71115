"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping cluster shards.

Centroids are fitted on a bounded sample; every vector goes to its few nearest ones, so shards
overlap. Each shard builds a pruned neighbour graph with a few far links, the lists of a vector
from all its shards are united, and every vector is sought by a greedy search that goes on,
within the range, until no neighbour of a hit is new. It starts from the shard's medoid, from
one more node of each part that cannot be reached from there, and from the vector itself where
the shard holds it. Hits are checked in double precision. A sample is compared with brute force;
too low a recall repeats the work with more overlap, then with exact comparison in the shards.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlake.llm.common import columns, components
from fleetlake.sources.scratch import materialised

COSINE = 0.95
# Bound of the sample that centroids are fitted on, and mean size of a shard where it suffices.
SAMPLE_ROWS = 4096
SHARD_ROWS = 1024
# Centroids of one level. Where a table needs more, large shards are split again, each by centroids
# fitted on a sample of its own, so shards stay near SHARD_ROWS at any size.
MOST_SHARDS = 512
# Vectors of a shard that one task sends to its parts.
SPLIT_ROWS = 20_000
# A shard with more vectors is cut into blocks; each pair of blocks is one task's work.
BLOCK_ROWS = 2048
OVERLAP = 2
DEGREE = 24
CANDIDATES = 64
# Links of a node to random members of its block, the medoid among them, whatever their distance.
FAR = 4
ALPHA = 1.2
BEAM = 32
# How far below the wanted cosine a node may lie and still be passed through.
SLACK = 0.07
AUDIT_ROWS = 256
# The audited sample grows until so many of its rows have links, or to so many rows.
AUDIT_LINKED = 64
MOST_AUDITED = 4096
RECALL = 0.9
# Cosines this near to the wanted one are summed again without rounding.
_EDGE = 1e-12
_log = logging.getLogger(__name__)


def unit_rows(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, key, unit): ``unit`` is null where a vector can link with nothing."""
    def run(batches):
        for batch in batches:
            units = []
            for v in batch.column(3).to_pylist():
                x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
                scale = np.abs(x).max(initial=0.0)
                good = len(x) and np.isfinite(x).all() and scale > 0
                x = x / scale if good else x
                units.append((x / np.sqrt(x @ x)).tolist() if good else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(units, pa.list_(pa.float64()))],
                names=["row", "vec_id", "key", "unit"])

    rows = columns(vectors, "vec_id", "embedding").select(
        F.monotonically_increasing_id(), F.col("vec_id").cast("long"),
        F.unhex(F.md5(F.col("embedding").cast("array<double>").cast("string"))),
        F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "row long, vec_id long, key binary, unit array<double>")


def _matrix(values) -> np.ndarray:
    return np.array(values.tolist() if hasattr(values, "tolist") else values, np.float64)


def centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Spherical k-means on the sample."""
    draw = np.random.default_rng(seed)
    centres = sample[draw.permutation(len(sample))[:k]]
    for _ in range(rounds):
        home = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def robust_pruned(x: np.ndarray) -> np.ndarray:
    """Neighbour lists (n x width, -1 for none) of a block of unit vectors.

    Of the nearest candidates a node keeps the nearest, drops every other that is ALPHA times
    nearer to the kept one than to the node, and so on up to DEGREE. FAR links lead elsewhere in
    the block, so groups of near copies larger than CANDIDATES hang together. Nearest reverse
    edges fill up to as many again as DEGREE.
    """
    n = len(x)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    width = min(CANDIDATES, n - 1)
    if width <= 0:
        return np.full((n, 1), -1)
    pool = np.argpartition(-near, width - 1, axis=1)[:, :width]
    order = np.argsort(-np.take_along_axis(near, pool, axis=1), axis=1, kind="stable")
    pool = np.take_along_axis(pool, order, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, pool, axis=1), 0))
    alive = np.ones_like(pool, bool)
    kept = np.full((n, DEGREE), -1)
    every = np.arange(n)
    for i in range(min(DEGREE, width)):
        first = np.argmax(alive, axis=1)
        has = alive[every, first]
        if not has.any():
            break
        chosen = pool[every, first]
        kept[:, i] = np.where(has, chosen, -1)
        between = np.sqrt(np.maximum(2 - 2 * near[chosen[:, None], pool], 0))
        alive &= ~((ALPHA * between <= apart) & has[:, None])
        alive[every, first] = False
    source, slot = np.nonzero(kept >= 0)
    target = kept[source, slot]
    by = np.lexsort((-near[target, source], target))
    source, target = source[by], target[by]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    back = np.full((n, DEGREE - FAR), -1)
    some = place < DEGREE - FAR
    back[target[some], place[some]] = source[some]
    back[(back[:, :, None] == kept[:, None, :]).any(axis=2)] = -1
    far = np.random.default_rng(n).integers(0, n, (n, FAR))
    far[:, 0] = np.argmax(x @ x.mean(axis=0))
    far[far == every[:, None]] = -1
    for i in range(FAR):
        known = np.concatenate([kept, back, far[:, :i]], axis=1)
        far[(known == far[:, i:i + 1]).any(axis=1), i] = -1
    return np.concatenate([kept, back, far], axis=1)


def entries(base: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The medoid, then the medoid of what links do not reach from there, and so on: every node
    can be reached from one of them."""
    left = np.ones(len(base), bool)
    starts = []
    while left.any():
        ids = np.flatnonzero(left)
        front = ids[[np.argmax(base[ids] @ base[ids].mean(axis=0))]]
        starts.append(front[0])
        while len(front):
            left[front] = False
            around = lists[front]
            front = np.unique(around[around >= 0])
            front = front[left[front]]
    return np.array(starts)


def range_search(base: np.ndarray, lists: np.ndarray, queries: np.ndarray, cosine: float,
                 own: np.ndarray | None = None):
    """(query, base, cosine) of hits: greedy with a beam from the entries, then outward in range.

    ``own`` is a query's own place in the base, -1 if it has none; the search starts there too.
    """
    starts = entries(base, lists)
    n, width = len(queries), min(BEAM, len(base))
    seen = np.zeros((n, len(base)), bool)
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def visit(q, b):
        """Cosines of new (query, base) pairs; each is met once."""
        seen[q, b] = True
        value = np.einsum("ij,ij->i", queries[q], base[b])
        hits.append((q, b, value))
        return value

    ids = np.full((n, width), -1)
    value = np.full((n, width), -np.inf)
    done = np.ones((n, width), bool)
    every = np.arange(n)
    seen[:, starts] = True
    first = queries @ base[starts].T
    hits.append((np.repeat(every, len(starts)), np.tile(starts, n), first.ravel()))
    top = np.argsort(-first, axis=1, kind="stable")[:, :width]
    ids[:, :top.shape[1]] = starts[top]
    value[:, :top.shape[1]] = np.take_along_axis(first, top, axis=1)
    done[:, :top.shape[1]] = False
    if own is not None:
        q = np.flatnonzero((own >= 0) & ~seen[every, own])
        ids[q, -1], done[q, -1] = own[q], False
        value[q, -1] = visit(q, own[q])
    active = every
    while len(active):
        todo = np.where(done[active], -np.inf, value[active])
        at = np.argmax(todo, axis=1)
        go = np.take_along_axis(todo, at[:, None], axis=1)[:, 0] > -np.inf
        active, at = active[go], at[go]
        if not len(active):
            break
        done[active, at] = True
        around = lists[ids[active, at]]
        new = (around >= 0) & ~seen[active[:, None], np.maximum(around, 0)]
        # A list has no node twice.
        got = np.full(around.shape, -np.inf)
        r, c = np.nonzero(new)
        got[r, c] = visit(active[r], around[r, c])
        all_ids = np.concatenate([ids[active], np.where(new, around, -1)], axis=1)
        all_values = np.concatenate([value[active], got], axis=1)
        all_done = np.concatenate([done[active], ~new], axis=1)
        best = np.argsort(-all_values, axis=1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        value[active] = np.take_along_axis(all_values, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)
    at = 0
    while at < len(hits):
        q, b, v = (np.concatenate(x) for x in zip(*hits[at:]))
        at = len(hits)
        near = v >= cosine - SLACK
        q, b = q[near], b[near]
        for lo in range(0, len(q), 20_000):
            around = lists[b[lo:lo + 20_000]]
            owner = np.repeat(q[lo:lo + 20_000], around.shape[1])
            around = around.ravel()
            ok = around >= 0
            code = np.unique(owner[ok] * len(base) + around[ok])
            owner, around = code // len(base), code % len(base)
            new = ~seen[owner, around]
            if new.any():
                visit(owner[new], around[new])
    q, b, v = (np.concatenate(x) for x in zip(*hits))
    good = v >= cosine
    return q[good], b[good], v[good]


def reaching(x: np.ndarray, y: np.ndarray, q: np.ndarray, b: np.ndarray, value: np.ndarray,
             cosine: float) -> np.ndarray:
    """Which pairs (q of x, b of y) reach ``cosine``: near it by the exactly rounded sum of products,
    which does not depend on the order of a matrix product."""
    keep = value >= cosine
    for i in np.flatnonzero(np.abs(value - cosine) <= _EDGE):
        keep[i] = math.fsum((x[q[i]] * y[b[i]]).tolist()) >= cosine
    return keep


def _placed(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """(node, unit, cluster): a row for each of the nearest ``overlap`` clusters."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist()).reshape(batch.num_rows, -1)
            k = min(overlap, len(centres))
            near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :k]
            take = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(near.ravel(), pa.int64())],
                names=["node", "unit", "cluster"])
    return nodes.mapInArrow(run, "node long, unit array<double>, cluster long")


def _split(placed: DataFrame, overlap: int, shard_rows: int) -> DataFrame:
    """(node, unit, cluster) with every cluster above 2 * ``shard_rows`` split into up to MOST_SHARDS
    parts, a vector going to the nearest ``overlap`` of them.

    Centroids of a cluster are fitted in one task, on a sample of about SAMPLE_ROWS of its vectors.
    They meet the vectors in pieces of about SPLIT_ROWS, so no task gets a whole cluster.
    """
    most = MOST_SHARDS
    sizes = materialised(placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")), "graph-sizes")
    large = sizes.where(F.col("size") > 2 * shard_rows).withColumn(
        "pieces", F.ceil(F.col("size") / SPLIT_ROWS).cast("int"))
    picked = placed.join(large, "cluster").where(
        F.pmod(F.xxhash64("node", "cluster"), F.lit(1 << 30)) < F.least(
            F.lit(1.0), F.lit(float(SAMPLE_ROWS)) / F.col("size")) * (1 << 30))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        sample = _matrix(group["unit"])
        k = int(np.clip(group["size"].iloc[0] // shard_rows, 2, min(most, max(len(sample), 2))))
        return pd.DataFrame({"cluster": group["cluster"].iloc[:1], "pieces": group["pieces"].iloc[:1],
                             "centres": [centroids(sample, k).tolist()]})

    centres = materialised(picked.groupBy("cluster").applyInPandas(
        fitted, "cluster long, pieces int, centres array<array<double>>"), "graph-centres")
    asked = centres.select("cluster", "centres", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    rows = placed.join(centres.select("cluster", "pieces"), "cluster").withColumn(
        "piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")).select("node", "unit", "cluster", "piece")

    def sent(vectors: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"node": [], "unit": [], "cluster": []})
        middle = np.array([list(map(float, c)) for c in of["centres"].iloc[0]])
        k = min(overlap, len(middle))
        near = np.argsort(-(_matrix(vectors["unit"]) @ middle.T), axis=1, kind="stable")[:, :k]
        again = vectors.loc[vectors.index.repeat(k)]
        return pd.DataFrame({"node": again["node"].to_numpy(), "unit": again["unit"].to_numpy(),
                             "cluster": (again["cluster"].to_numpy() + 1) * most + near.ravel()})

    parts = rows.groupBy("cluster", "piece").cogroup(asked.groupBy("cluster", "piece")).applyInPandas(
        sent, "node long, unit array<double>, cluster long")
    return placed.join(centres.select("cluster"), "cluster", "left_anti").select("node", "unit", "cluster").union(parts)


def _graph(block: pd.DataFrame) -> pd.DataFrame:
    node = block["node"].to_numpy()
    lists = robust_pruned(_matrix(block["unit"]))
    return pd.DataFrame({"node": node, "near": [np.unique(node[x[x >= 0]]).tolist() for x in lists]})


def _found(cosine: float, exact: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        base = group[group["role"] != 1]
        asked = group[group["role"] != 0]
        if not len(base) or not len(asked):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        node, other = base["node"].to_numpy(), asked["node"].to_numpy()
        if exact:
            x, y = _matrix(asked["unit"]), _matrix(base["unit"])
            value = x @ y.T
            q, b = np.nonzero(value >= cosine - _EDGE)
            keep = reaching(x, y, q, b, value[q, b], cosine)
            return pairs(other[q[keep]], node[b[keep]])
        local = {v: i for i, v in enumerate(node.tolist())}
        near = [[local[v] for v in x if v in local] for x in base["near"].tolist()]
        lists = np.full((len(node), max(1, max(map(len, near)))), -1)
        for i, x in enumerate(near):
            lists[i, :len(x)] = x
        own = np.array([local.get(v, -1) for v in other.tolist()])
        x, y = _matrix(asked["unit"]), _matrix(base["unit"])
        q, b, value = range_search(y, lists, x, cosine - _EDGE, own)
        keep = reaching(x, y, q, b, value, cosine)
        return pairs(other[q[keep]], node[b[keep]])

    def pairs(x, y):
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)[x != y], axis=0)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})
    return run


def search_links(nodes: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP,
                 shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
                 *, exact: bool = False) -> DataFrame:
    """(a, b) pairs, a < b, of (node, unit) rows found at ``cosine`` or more; ``exact`` compares
    the blocks of a shard instead of searching their graphs.

    ``nodes`` must be a written table. A cluster may hold most rows: it is cut into blocks by a
    hash, and each pair of blocks is a group of its own, so no task gets more than two blocks.
    """
    n = nodes.count()
    part = min(1.0, SAMPLE_ROWS / max(n, 1))
    picked = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(part * (1 << 30)))
    sample = _matrix(picked.select("unit").toPandas()["unit"])
    if len(sample) == 0:
        sample = _matrix(nodes.limit(1).toPandas()["unit"])
    k = int(np.clip(n // shard_rows, 1, min(MOST_SHARDS, len(sample))))
    placed = materialised(_placed(nodes, centroids(sample, k), overlap), "graph-shards")
    reach = k * shard_rows
    while reach * 2 < n:
        placed = materialised(_split(placed, overlap, shard_rows), "graph-shards")
        reach *= MOST_SHARDS
    blocks = placed.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    placed = placed.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("node", "cluster"), F.col("blocks")).cast("int"))
    lists = None if exact else (placed.groupBy("cluster", "block").applyInPandas(_graph, "node long, near array<long>")
             .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    rows = (placed.withColumn("near", F.array().cast("array<long>")) if exact
            else placed.join(materialised(lists, "graph-lists"), "node"))
    last = F.col("blocks") - 1
    role = F.when(F.col("blocks") == 1, F.array(F.struct(F.col("block").alias("i"), F.col("block").alias("j"),
                                                         F.lit(2).alias("role"))))
    base = F.transform(F.sequence(F.col("block"), last), lambda j: F.struct(
        F.col("block").alias("i"), j.alias("j"), F.lit(0).alias("role")))
    asked = F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(
        i.alias("i"), F.col("block").alias("j"), F.lit(1).alias("role")))
    rows = rows.select("node", "unit", "near", "cluster", F.explode(
        F.coalesce(role, F.concat(base, asked))).alias("g")).select("*", "g.*").drop("g")
    return (rows.groupBy("cluster", "i", "j").applyInPandas(_found(cosine, exact), "a long, b long").distinct())


def audit(nodes: DataFrame, links: DataFrame, cosine: float = COSINE, rows: int = AUDIT_ROWS) -> float:
    """Recall of ``links`` on about ``rows`` vectors: the mean over vectors of the share of a
    vector's true links, or the share of all their true links if that is lower; 1 without any.

    The sample grows fourfold while few of its vectors have links.
    """
    n = max(nodes.count(), 1)
    while True:
        linked, recall = _audited(nodes, links, cosine, min(1.0, rows / n))
        if linked >= AUDIT_LINKED or rows >= min(n, MOST_AUDITED):
            return recall
        rows *= 4


def _audited(nodes: DataFrame, links: DataFrame, cosine: float, part: float) -> tuple[int, float]:
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(part * (1 << 30)))
    sample = picked.toPandas()
    if not len(sample):
        return 0, 1.0
    ids, x = sample["node"].to_numpy(), _matrix(sample["unit"])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                piece = batch.slice(lo, 1024)
                node = np.array(piece.column(0).to_pylist(), np.int64)
                q, b = np.nonzero(x @ piece.column(1).flatten().to_numpy().reshape(len(node), -1).T >= cosine)
                keep = ids[q] != node[b]
                yield pa.RecordBatch.from_arrays([pa.array(ids[q][keep]), pa.array(node[b][keep])], names=["q", "o"])

    true = nodes.select("node", "unit").mapInArrow(run, "q long, o long").select(
        "q", F.least("q", "o").alias("a"), F.greatest("q", "o").alias("b"))
    each = true.join(links.withColumn("hit", F.lit(1)), ["a", "b"], "left").groupBy("q").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found"))
    linked, mean, wanted, found = each.agg(F.count(F.lit(1)), F.avg(F.col("found") / F.col("wanted")),
                                           F.sum("wanted"), F.sum("found")).first()
    return linked, min(mean, found / wanted) if linked else 1.0


def _tries(n: int):
    """Ways of ``search_links`` to try in turn; the last compares all pairs."""
    k = min(MOST_SHARDS, max(n // SHARD_ROWS, 1))
    for overlap in range(OVERLAP, OVERLAP + 4):
        if overlap == OVERLAP or overlap <= k:
            yield {"overlap": overlap}
    overlap = OVERLAP + 3
    while overlap < k:
        yield {"overlap": overlap, "exact": True}
        overlap *= 2
    yield {"overlap": 1, "exact": True, "shard_rows": n + 1}


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    Vectors of different lengths do not link. ``n_links`` counts the other rows at ``cosine`` or
    more, ``component_id`` is the smallest vec_id that links reach, ``kept`` whether it is the
    row's own. Equal vectors collapse to one node first; their links are counted, not listed.
    Repeated rows count as copies. An empty table gives an empty result.
    """
    rows = materialised(unit_rows(vectors), "graph-rows")
    light = rows.select("row", "vec_id", "key", F.col("unit").isNotNull().alias("usable"))
    classes = materialised(light.where("usable").groupBy("key").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")),
        "graph-classes")
    nodes = materialised(rows.where("unit is not null").select(F.col("row").alias("node"), "unit").join(
        classes.select("node"), "node", "left_semi"), "graph-nodes")
    lengths = [r[0] for r in nodes.select(F.size("unit")).distinct().collect()]
    links = None
    for length in lengths:
        same = nodes if len(lengths) == 1 else materialised(nodes.where(F.size("unit") == length), "graph-nodes")
        for how in _tries(same.count()):
            found = materialised(search_links(same, cosine, **how), "graph-links")
            reached = audit(same, found, cosine)
            _log.log(logging.INFO if reached >= recall else logging.WARNING,
                     "recall %.4f of vectors of length %d, %s", reached, length, how)
            if reached >= recall:
                break
        links = found if links is None else links.union(found)
    if links is None:
        links = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    label = components(links)
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("o")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("o")))
    counts = (ends.join(classes.select(F.col("node").alias("o"), "copies"), "o")
              .groupBy("node").agg(F.sum("copies").alias("others")))
    named = (classes.join(label, "node", "left").join(counts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    keyed = materialised(named.join(smallest, "component").select(
        F.col("key").alias("_key"), "component_id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")), "graph-keys")
    linked = light.where("usable").join(keyed, F.col("key") == F.col("_key")).select(
        "vec_id", "n_links", "component_id")
    alone = light.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
