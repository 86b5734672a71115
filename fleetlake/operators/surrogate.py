"""Dense surrogate keys 1..n over a global order, without a single-task sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from fleetlake.sources.scratch import materialised

# monotonically_increasing_id() keeps the partition above and the row offset below this bit.
_PARTITION_BITS = 33


def dense_key(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Add ``name`` = start + position (from 1) of each row in the order of ``order``.

    Range partitioning plus a sort within partitions gives each row its offset in its own
    partition; the running total of the partitions before it makes that global. The ranged
    rows are written in between: range bounds are sampled, so a second evaluation could cut
    the partitions elsewhere. Only one count per partition, never a row, reaches the driver.
    """
    ranged = materialised(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_position", _PARTITION_BITS)), name)
    sizes = {r["_part"]: r["n"] for r in
             ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    last = max(sizes, default=0)
    before = accumulate((sizes.get(p, 0) for p in range(last)), initial=start)
    offsets = F.expr("array(" + ", ".join(f"{n}L" for n in before) + ")")
    within = F.col("_position") - F.shiftleft(F.col("_part"), _PARTITION_BITS)
    return ranged.select(
        (F.get(offsets, F.col("_part").cast("int")) + within + 1).alias(name), *df.columns)
