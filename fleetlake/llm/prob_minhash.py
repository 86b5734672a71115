"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Each distinct shingle of a document emits a Poisson process of arrivals whose rate is the
shingle's weight; every arrival falls on one of M registers, and a register keeps the shingle
that reaches it first. An element stops as soon as its next arrival lies beyond the latest
register. Two documents agree in a register with the probability Jaccard similarity of their
weights. Registers are banded for candidates; agreement over all registers sorts out most of
them; the rest is verified on the shingle sets. A text with repeated shingles has a second set of
registers, of weight 1 throughout, for plain Jaccard similarity; elsewhere the sets are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from fleetlake.llm.common import columns, components, released, text_key, words
from fleetlake.sources.scratch import materialised

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# At a similarity of 0.8 a pair shares no band with probability (1 - 0.8^5)^25 = 5e-5.
BAND_ROWS = 5
BANDS = 25
REGISTERS = BANDS * BAND_ROWS
# Share of agreeing registers (four standard deviations below SIMILARITY) that calls for the
# exact check; 8 bits of each register are compared.
_AGREE = 0.8 - 4 * (0.8 * 0.2 / REGISTERS) ** 0.5
# Members of an unresolved bucket that one step compares with as many others.
BLOCK_ROWS = 256
# Best partners that a member of an unresolved bucket tries before it tries all.
FIRST_TRIES = 16
# Bits that hold the parity of a text's shingles: their exclusive or over two texts tells how many
# shingles the texts do not share.
PARITY_BITS = 1024
_SHINGLES_AT_ONCE = 200_000
_SKETCH = ("row long, doc_id long, text_key binary, bands array<long>, marks binary, "
           "shingles binary, repeats binary, size int, parity binary")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): every input bit sways every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    """64-bit hashes of words; remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = value
        return value


def shingle_counts(tokens: list[bytes], hashes: dict, width: int = SHINGLE_WORDS):
    """(ascending distinct 64-bit shingles, their counts); fewer words make one shingle."""
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    width = min(width, len(h))
    grams = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i]
    return np.unique(_mix(grams), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    """Weight of a shingle that occurs so many times: a repeat counts less than a new shingle."""
    return 1.0 + np.log(counts)


def registers(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int,
              m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (owners x m) of elements with weights, ``owner`` giving their set.

    Round k draws the k-th gap and register of every element still alive, from a generator
    seeded by the element alone; an element dies once its arrival is later than the latest
    register of its owner. A set without elements keeps zeros.
    """
    first = np.full(owners * m, np.inf)
    winner = np.zeros(owners * m, np.uint64)
    time = np.zeros(len(element))
    k = np.uint64(0)
    while len(element):
        k += np.uint64(1)
        draw = _mix(element + np.full(1, k) * np.uint64(0x9E3779B97F4A7C15))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight
        slot = owner * m + (_mix(draw ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = element[won]
        alive = time < first.reshape(owners, m).max(axis=1)[owner]
        owner, element, weight, time = owner[alive], element[alive], weight[alive], time[alive]
    return winner.reshape(owners, m)


def similarity(a, count_a, b, count_b) -> float:
    """The larger of probability Jaccard on the weights and Jaccard on the distinct shingles.

    Probability Jaccard sums, over shared shingles i, 1 / sum_j max(a_j/a_i, b_j/b_i); over all
    ratios r_j = a_j/b_j in ascending order this needs prefix sums only.
    """
    if not len(a) or not len(b):
        return 0.0
    shared, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    plain = len(shared) / (len(a) + len(b) - len(shared))
    wa, wb = weights(count_a), weights(count_b)
    sa, sb = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - sa.sum(), wb.sum() - sb.sum()
    ratio = sa / sb
    order = np.argsort(ratio, kind="stable")
    ratio, sa, sb = ratio[order], sa[order], sb[order]
    # With i's ratio r, element j takes a_j/a_i where r_j > r, else b_j/b_i.
    below = np.cumsum(sb)
    above = sa.sum() - np.cumsum(sa)
    total = (above + only_a) / sa + (below + only_b) / sb
    return max(plain, float((1 / total).sum()))


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document, in one pass: bands, 8-bit registers and 32-bit shingles.

    Texts without words have null bands. ``repeats`` holds the counts where any exceeds one; then
    bands and registers of weight 1 follow the weighted ones.
    """
    def run(batches):
        hashes = _WordHash()
        for batch in batches:
            held, rows = 0, []
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for row, doc, key, body in zip(*(c.to_pylist() for c in part.columns)):
                    rows.append((row, doc, key, *shingle_counts(words(body), hashes)))
                    held += len(rows[-1][3])
                    if held >= _SHINGLES_AT_ONCE:
                        yield _sketch(rows)
                        held, rows = 0, []
            if rows:
                yield _sketch(rows)

    keyed = columns(docs, "doc_id", "text").select(
        F.monotonically_increasing_id(), F.col("doc_id").cast("long"), text_key(F.col("text")),
        F.encode(F.col("text"), "utf-8"))
    return keyed.mapInArrow(released(run), _SKETCH)


def _sketch(rows: list) -> pa.RecordBatch:
    sizes = [len(r[3]) for r in rows]
    owner = np.repeat(np.arange(len(rows)), sizes)
    element = np.concatenate([r[3] for r in rows])
    won = registers(owner, element, weights(np.concatenate([r[4] for r in rows])), len(rows))
    bands, marks = _bands(won), [x.tobytes() for x in (won & np.uint64(255)).astype(np.uint8)]
    again = [i for i, r in enumerate(rows) if len(r[4]) and r[4].max() > 1]
    if again:
        owner = np.repeat(np.arange(len(again)), [sizes[i] for i in again])
        won = registers(owner, np.concatenate([rows[i][3] for i in again]), np.ones(len(owner)), len(again))
        for i, band, mark in zip(again, _bands(won), (won & np.uint64(255)).astype(np.uint8)):
            bands[i] = bands[i] + band
            marks[i] += mark.tobytes()
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.binary()),
        pa.array([b if n else None for b, n in zip(bands, sizes)], pa.list_(pa.int64())),
        pa.array(marks, pa.binary()),
        pa.array([(r[3] >> np.uint64(32)).astype(np.uint32).tobytes() for r in rows], pa.binary()),
        pa.array([r[4].astype(np.uint32).tobytes() if len(r[4]) and r[4].max() > 1 else None
                  for r in rows], pa.binary()),
        pa.array(sizes, pa.int32()), pa.array([_parity(r[3]) for r in rows], pa.binary())],
        names=["row", "doc_id", "text_key", "bands", "marks", "shingles", "repeats", "size", "parity"])


def _bands(won: np.ndarray) -> list[list[int]]:
    band = np.zeros((len(won), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + won[:, i::BAND_ROWS])
    return band.view(np.int64).tolist()


def _both(values: list) -> list:
    """Weighted and plain bands or marks of every text: where there is one set it is both."""
    most = max(map(len, values), default=0)
    return [v if len(v) == most else v + v for v in values]


def _parity(shingles: np.ndarray) -> bytes:
    bits = np.bincount((shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def most_odd_bits(shingles: np.ndarray) -> np.ndarray:
    """Differing parity bits of two texts with so many distinct shingles together, at most (four
    standard deviations) where their Jaccard similarity reaches SIMILARITY.

    Such texts differ in (1 - s) / (1 + s) of the sum; each difference flips a random bit.
    """
    n = PARITY_BITS
    apart = shingles * (1 - SIMILARITY) / (1 + SIMILARITY)
    two, four = np.exp(apart * np.log1p(-2 / n)), np.exp(apart * np.log1p(-4 / n))
    variance = n / 4 * (1 - four) + n * (n - 1) / 4 * (four - two * two)
    return n / 2 * (1 - two) + 4 * np.sqrt(np.maximum(variance, 0)) + 2


@pandas_udf(T.BooleanType())
def _agree(a, b):
    """Do enough 8-bit registers agree, weighted or plain? Chance agreement is allowed for on the
    safe side."""
    import pandas as pd
    if not len(a):
        return pd.Series([], dtype=bool)
    sides = np.frombuffer(b"".join(_both([*a, *b])), np.uint8).reshape(2, len(a), -1, REGISTERS)
    return pd.Series((sides[0] == sides[1]).mean(axis=2).max(axis=1) >= _AGREE)


@pandas_udf(T.BooleanType())
def _near(a, count_a, b, count_b):
    import pandas as pd
    out = []
    for x, n, y, m in zip(a, count_a, b, count_b):
        x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
        n = np.frombuffer(n, np.uint32) if n is not None else np.ones(len(x))
        m = np.frombuffer(m, np.uint32) if m is not None else np.ones(len(y))
        if len(x) and len(y):
            x, n = _folded(x, n)
            y, m = _folded(y, m)
        out.append(similarity(x, n, y, m) >= SIMILARITY - 1e-9)
    return pd.Series(out)


def _folded(x, n):
    """Shingles that share 32 bits within one text become one; the high bits keep the order."""
    if len(x) > 1 and (x[1:] == x[:-1]).any():
        first = np.flatnonzero(np.diff(x.astype(np.int64), prepend=-1))
        return x[first], np.add.reduceat(n, first)
    return x, n


def _verified(pairs: DataFrame, sketch: DataFrame, agreeing: bool = False) -> DataFrame:
    """The (a, b) pairs of rows that are near duplicates; registers first (unless they are known
    to agree), then the sets."""
    def side(name, *cols):
        return sketch.select(F.col("row").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    close = pairs
    if not agreeing:
        close = (pairs.join(side("a", "marks"), "a").join(side("b", "marks"), "b")
                 .where(_agree("marks_a", "marks_b")).select("a", "b"))
        close = materialised(close, "minhash-close")
    return (close.join(side("a", "shingles", "repeats"), "a").join(side("b", "shingles", "repeats"), "b")
            .where(_near("shingles_a", "repeats_a", "shingles_b", "repeats_b")).select("a", "b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, group_id, kept, copies, grouped; one row per row of ``docs``.

    Documents are linked when their texts are equal or reach SIMILARITY; a group is what links
    connect. ``group_id`` is its smallest doc_id (null where all are), ``grouped`` whether the
    group has several distinct texts, ``copies`` the number of rows with the very same text.
    ``kept`` marks one row per group: the first with the smallest doc_id, nulls last. Equal texts
    without words are copies; different ones are not near. Null texts are copies of no one: each
    such row is a group of its own. Repeated rows are copies. Further columns are ignored; an empty
    table gives no rows; texts of any length are read whole.

    Equal texts collapse by a grouped count first, so a text may repeat without bound. A bucket
    of equal bands is not paired off: its members are compared with one of them, a different one
    in each band, and the links give components. In buckets left with several components the
    members outside the largest one are compared with those of other components, first with the
    FIRST_TRIES that agree most, then with all. No bucket is cut off and no link is lost; what
    components connect already is not compared again.
    """
    sketch = materialised(sketches(docs), "minhash-sketches")
    light = sketch.select("row", "doc_id", "text_key")
    classes = materialised(
        light.where("text_key is not null").groupBy("text_key")
        .agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"),
             F.min("doc_id").alias("least")), "minhash-classes")
    one = materialised(sketch.where("bands is not null").select(F.col("row").alias("node"), "bands").join(
        classes.select("node"), "node", "left_semi"), "minhash-bands")
    members = one.select(F.explode(F.array_distinct("bands")).alias("bucket"), "node")
    shared = (members.groupBy("bucket").agg(
        F.min_by("node", F.xxhash64("node", "bucket")).alias("head"), F.count(F.lit(1)).alias("size"))
        .where("size > 1"))
    members = materialised(members.join(shared, "bucket"), "minhash-shared")
    tested = materialised(members.where("node <> head").select(
        F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct(), "minhash-pairs")
    links = materialised(_verified(tested, sketch), "minhash-links")
    label = components(links)
    # Buckets of two are done: their only pair has been tested.
    rest = materialised(members.where("size > 2").select("bucket", "node").join(
        sketch.select(F.col("row").alias("node"), "marks", "parity", "bands",
                      F.when(F.col("repeats").isNull(), F.col("size")).otherwise(0).alias("size")), "node"),
        "minhash-rest")
    for tries in (FIRST_TRIES, None):
        pairs = materialised(_across(_labelled(rest, label), tries).join(tested, ["a", "b"], "left_anti"),
                             "minhash-pairs")
        if pairs.isEmpty():  # the best partners may all have been tested: the others are still to come
            continue
        found = materialised(_verified(pairs, sketch, True), "minhash-links")
        tested = tested.union(pairs)
        if not found.isEmpty():
            links = links.union(found)
            label = components(links)

    named = _labelled(classes, label)
    group = named.groupBy("component").agg(F.min("least").alias("group_id"), F.count(F.lit(1)).alias("texts"))
    texts = materialised(named.join(group, "component").select(
        "text_key", "component", "group_id", "copies", (F.col("texts") > 1).alias("grouped")),
        "minhash-texts")
    rows = _by_text(light, texts)
    keeper = (rows.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("row").alias("r"))).alias("k"))
        .select("component", F.col("k.r").alias("keep")))
    # One row per group: whether a row is kept is looked up by row number, which is unique.
    marked = rows.join(keeper.select(F.col("keep").alias("row"), F.lit(True).alias("is_kept")), "row", "left")
    alone = light.where("text_key is null").select(
        "doc_id", "text_key", F.col("doc_id").alias("group_id"), F.lit(True).alias("kept"),
        F.lit(1).cast("long").alias("copies"), F.lit(False).alias("grouped"))
    return marked.select("doc_id", "text_key", "group_id",
                         F.coalesce("is_kept", F.lit(False)).alias("kept"), "copies", "grouped").union(alone)


def _across(rows: DataFrame, tries: int | None) -> DataFrame:
    """Distinct (a, b), a < b, of members of one bucket in different components whose registers
    agree enough and whose parities differ little enough; the ``tries`` best of a member in each
    step, or all. Parities judge plain Jaccard similarity, so they are asked only where no shingle
    of either text repeats (``size`` is 0 elsewhere). A pair that shares several bands is given out
    by the first of them only.

    A step has one block of a bucket's members and one block of those outside its largest
    component, so a bucket of any size is worked off in bounded pieces.
    """
    rows = rows.withColumnRenamed("size", "of")
    kinds = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    per = (kinds.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                       F.sum("n").alias("size"), F.max("n").alias("most"),
                                       F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    per = per.select("bucket", "main", F.ceil(F.col("size") / BLOCK_ROWS).alias("blocks"),
                     F.ceil((F.col("size") - F.col("most")) / BLOCK_ROWS).alias("asking"))

    def spread(n, i, j, role):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), lambda x: F.struct(
            i(x).cast("int").alias("i"), j(x).cast("int").alias("j"), F.lit(role).alias("role")))

    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks"))
    asks = F.pmod(F.xxhash64("bucket", "node"), F.col("asking"))
    base = spread("asking", lambda x: own, lambda x: x, 0)
    asked = spread("blocks", lambda x: x, lambda x: asks, 1)
    steps = (rows.join(per, "bucket").select(
        "bucket", "node", "component", "marks", "parity", "bands", "of",
        F.explode(F.when(F.col("component") == F.col("main"), base).otherwise(F.concat(base, asked))).alias("g"))
        .select("bucket", "g.i", "g.j", "g.role", "node", "component", "marks", "parity", "bands", "of")
        .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            group = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
            cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            # The last group may go on in the next batch.
            for lo, hi in zip([0, *cuts[:-1]], cuts):
                yield from _step(table.slice(lo, hi - lo), tries)
            held = table.slice(cuts[-1] if len(cuts) else 0)
        if held is not None and held.num_rows:
            yield from _step(held, tries)

    return steps.mapInArrow(released(run), "a long, b long").distinct()


def _step(table: pa.Table, tries: int | None):
    asks = table.column("role").to_numpy() == 1
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    marks = np.frombuffer(b"".join(_both(table.column("marks").to_pylist())), np.uint8).reshape(len(node), -1, REGISTERS)
    q, b = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(q) or not len(b):
        return
    agree = np.stack([(marks[b] == marks[i]).sum(axis=2).max(axis=1) for i in q])
    agree[component[q][:, None] == component[b][None]] = 0
    size = table.column("of").to_numpy().astype(np.float64)
    parity = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(len(node), -1)
    i, j = np.nonzero(agree >= _AGREE * REGISTERS)
    odd = np.bitwise_count(parity[q[i]] ^ parity[b[j]]).sum(axis=1)
    a, c = size[q[i]], size[b[j]]
    near = (a == 0) | (c == 0) | (odd <= most_odd_bits(a + c))
    i, j = i[near], j[near]
    bands = np.array(_both(table.column("bands").to_pylist()))
    first = (bands[q[i]] == bands[b[j]]).argmax(axis=1)
    here = bands[q[i], first] == table.column("bucket")[0].as_py()
    i, j = i[here], j[here]
    if tries is not None and len(i):
        # The best of each asking member come first in its run.
        order = np.lexsort((-agree[i, j], i))
        i, j = i[order], j[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < tries
        i, j = i[top], j[top]
    if len(i):
        x, y = node[q[i]], node[b[j]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _by_text(light: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows with what their text has. A third of all rows may share one text: the join is an
    inner one whose heavy partitions the adaptive planner splits."""
    return light.join(texts, "text_key")


def _labelled(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """Add ``component``: that of the node, or the node itself where it has no link."""
    return (nodes.join(label.select("node", F.col("component").alias("_c")), "node", "left")
            .withColumn("component", F.coalesce("_c", "node")).drop("_c"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group; other columns stay. Rows with null texts all stay."""
    keep = near_duplicates(docs).where("kept and text_key is not null").select(
        F.col("doc_id").alias("_fleetlake_id"), F.col("text_key").alias("_fleetlake_kept"))
    keyed = docs.withColumn("_fleetlake_key", text_key(docs["text"]))
    rest = [c for c in docs.columns if c not in ("doc_id",)]
    held = keyed.join(keep, keyed["doc_id"].eqNullSafe(keep["_fleetlake_id"])
                      & (keyed["_fleetlake_key"] == keep["_fleetlake_kept"]), "left_semi")
    # Repeated rows share id and text; they meet where the join has put them.
    once = held.groupBy("doc_id", "_fleetlake_key").agg(*[F.first(f"`{c}`").alias(c) for c in rest])
    return once.select(*docs.columns).unionByName(docs.where("text is null"))
