"""Shards by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.llm.common import columns
from fleetlake.sources.scratch import materialised

# Fixed values of the published algorithm: the generator's multiplier, the width of its output.
_MULTIPLIER = "2862933555777941757"
_TWO_64 = "18446744073709551616"
_TWO_33 = "8589934592"
_TWO_31 = 2147483648.0


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long ``key`` (negative keys count as unsigned; null as 0).

    The bucket jumps forward with probability 1/(b+1) at bucket b. One more shard therefore
    takes only the keys whose last jump lands in it. Each jump goes up by one at least, so
    ``shards`` steps suffice; a key that has landed beyond the end keeps its bucket. The
    64-bit product fits decimal(38) (below 5.3e37), which spares overflow checks.
    """
    if shards < 1:
        raise ValueError("at least one shard")

    def dec(x):
        return F.lit(x).cast("decimal(20,0)")

    key = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    start = F.struct(
        F.when(key < 0, (key + dec(_TWO_64)).cast("decimal(20,0)")).otherwise(key).alias("k"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s, _):
        k = ((s["k"] * F.lit(_MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"))
             % dec(_TWO_64)).cast("decimal(20,0)")
        high = F.floor(k.cast("decimal(20,0)") / dec(_TWO_33)).cast("double") + 1.0
        moved = F.struct(k.alias("k"), s["j"].alias("b"),
                         F.floor((s["j"] + 1).cast("double") * (F.lit(_TWO_31) / high))
                         .cast("long").alias("j"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"]).cast("int")


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, text_crc32, shard, grown_shard, slot.

    ``size`` is the UTF-8 length plus 8; a null text counts as empty. ``grown_shard`` is the
    shard with one more shard. ``slot`` counts the rows of a shard from 0 without gaps. Rows
    with the same key share a shard; repeated rows each get a slot. Null keys go where key 0
    goes. Further columns are ignored. An empty table gives an empty result.

    Only narrow columns leave the scan. Slots need a count per shard, and a shard holds an
    unbounded number of rows: rows are therefore numbered within (scan partition, shard),
    which is never more than a partition's rows however the keys are spread, and a table of
    counts per (partition, shard) gives each such piece its first slot.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = columns(docs, key, text).select(
        F.col(key), (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        F.spark_partition_id().alias("_part"))
    # Written, so that numbers and counts see the same partitions even if tasks run again.
    rows = materialised(rows, "jump-shards")
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(
        "shard", "_part",
        F.expr("sum(_n) over (partition by shard order by _part "
               "rows between unbounded preceding and 1 preceding)").alias("_before"))
    numbered = rows.withColumn("_in_part", F.expr(
        f"row_number() over (partition by _part, shard order by `{key}`, text_crc32, size)"))
    placed = numbered.join(first, ["_part", "shard"])
    slot = (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_in_part") - 1).cast("long")
    return placed.select(key, "size", "text_crc32", "shard", "grown_shard", slot.alias("slot"))
