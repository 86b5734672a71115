"""Lookup joins that hold at any size and under any key skew.

A side is broadcast only when the optimizer's size for it is below a stated bound.
Above the bound the join shuffles, and the keys that hold most rows are salted:
their rows spread over many tasks and the few matching lookup rows are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType, VariantType

# Bytes of the lookup side as the optimizer sees them (compressed files count as stored).
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024
# Heaviest keys that get salted. The list is broadcast: 1000 longs at most.
HOT_KEYS = 1000
SALTS = 64


def plan_size(df: DataFrame) -> int | None:
    """Optimizer's size of ``df`` in bytes; None where the session does not tell it."""
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    size = plan_size(df)
    return size is not None and size <= (BROADCAST_LIMIT_BYTES if limit is None else limit)


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """At most HOT_KEYS hashes of the most frequent keys.

    The frequent-item sketch is one mergeable aggregate over the key columns: no shuffle
    of keys and a fixed state per task. It only decides what gets salted, so its
    approximation cannot change a result.
    """
    sketch = F.expr(f"approx_top_k(_key_hash, {HOT_KEYS}, {HOT_KEYS * 16})")
    return (df.select(F.xxhash64(*on).alias("_key_hash"))
            .agg(sketch.alias("_top")).select(F.inline("_top"))
            .select(F.col("item").alias("_hot_hash")))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    condition: Column | None = None,
    limit: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join a large ``left`` to ``right`` on equal keys (``how``: left or inner).

    ``right`` should hold few rows per key. ``condition`` may add a residual test over
    the columns of both sides. Columns of ``left`` come first, then the non-key columns
    of ``right``. ``keys_from`` is a cheaper source of the same keys for finding hot ones:
    in a chain of joins pass the first table, not the joined one.
    """
    extra = [c for c in right.columns if c not in on]
    keys = {k: f"_r_{k}" for k in on}
    right = right.select(*[F.col(k).alias(keys[k]) for k in on], *extra)

    def same(a, b):
        return F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)

    match = None
    for k in on:
        match = same(k, keys[k]) if match is None else match & same(k, keys[k])
    if condition is not None:
        match = match & condition

    if is_small(right, limit):
        joined = left.join(F.broadcast(right), match, how)
        return joined.select(*left.columns, *extra)

    hot = hot_keys(left if keys_from is None else keys_from, on)
    # The salt is a hash of the row itself, so a task that runs again gives the same one.
    hashed = [f.name for f in left.schema if not isinstance(f.dataType, (MapType, VariantType))]
    left_salted = _mark_hot(left, on, hot).withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*hashed), F.lit(SALTS)))
        .otherwise(F.lit(0)).cast("int"))
    right_salted = _mark_hot(right, list(keys.values()), hot).withColumn(
        "_r_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                             .otherwise(F.array(F.lit(0))))).drop("_hot")
    joined = left_salted.join(right_salted, match & (F.col("_salt") == F.col("_r_salt")), how)
    return joined.select(*left.columns, *extra)


def _mark_hot(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_hot``. ``hot`` has at most HOT_KEYS rows by construction, so it is broadcast."""
    marked = df.withColumn("_key_hash", F.xxhash64(*on))
    return (marked.join(F.broadcast(hot), F.col("_key_hash") == F.col("_hot_hash"), "left")
            .withColumn("_hot", F.col("_hot_hash").isNotNull())
            .drop("_key_hash", "_hot_hash"))
