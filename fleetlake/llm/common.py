"""What several operators share: words, null-safe inputs, connected components."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.sources.scratch import materialised

# Bytes of words: digits, letters (A-Z lower-cased) and every byte of a non-ASCII character.
# All else becomes a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 ``text``; a null has none."""
    return text.translate(_WORD_BYTES).split() if text else []


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so further ones with clashing names cannot interfere."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null and empty texts differ."""
    return F.unhex(F.md5(text))


def sliced(batches, rows: int = 512):
    """Arrow batches cut into smaller ones: a task holds what it makes of so many rows only."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def released(run):
    """``run`` over Arrow batches, after which freed memory goes back to the machine.

    Workers outlive their tasks: what one stage held would else add to what the next one needs.
    """
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return wrapped


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over the undirected (a, b) ``edges``.

    Nodes are those with an edge to another node. Alternating large and small stars: each
    round hangs every neighbour of a node on the smallest one it knows, until all components
    are stars around their smallest node. A round needs only grouped minima (combined before
    the shuffle) and joins with them, so a node with very many neighbours is never gathered.
    Each round is written to the shared folder, which also cuts the lineage.
    """
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"),
                                        F.least("a", "b").alias("lo")).distinct()
    kept = materialised(kept, name)
    before = _state(kept)
    while before[0]:
        both = kept.select("hi", "lo").union(kept.select(F.col("lo").alias("hi"),
                                                         F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("node"), F.least("m", "hi").alias("m"))
        large = (both.where("lo > hi").join(least, F.col("hi") == F.col("node"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("node"), "m")
        small = (large.join(low, F.col("hi") == F.col("node")).where("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(low.select(F.col("node").alias("hi"), F.col("m").alias("lo"))))
        kept = materialised(small.distinct(), name)
        after = _state(kept)
        if after == before:
            break
        before = after
    stars = kept.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.union(kept.select(F.col("lo").alias("node"),
                                   F.col("lo").alias("component")).distinct())
