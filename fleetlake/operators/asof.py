"""As-of lookup for long histories: no row meets more than the one version it takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetlake.sources.scratch import materialised


def last_before(facts: DataFrame, versions: DataFrame, key: str, day: str, start: str,
                attributes: list[str]) -> DataFrame:
    """``facts`` with the ``attributes`` of the last of ``versions`` of their key with ``start`` <= ``day``.

    Facts and versions are put in one order of (key, date), versions first, and cut into ranges; a key
    with any number of rows covers several. Within a range the last version is carried on. What it
    must begin with comes from a table of one row per range: the last version of the range's last
    key. So a task holds one range, whatever a key's share of the rows, and nothing is multiplied.
    Facts without key or date get nulls; of versions with equal key and start the greatest counts.
    """
    kept = facts.columns
    version = F.struct(*[F.col(a) for a in attributes])
    asked = facts.select(F.col(key).alias("_key"), F.col(day).cast("date").alias("_at"), F.lit(1).alias("_kind"),
                         F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_fact"))
    given = (versions.where(F.col(key).isNotNull() & F.col(start).isNotNull())
             .groupBy(F.col(key).alias("_key"), F.col(start).cast("date").alias("_at"))
             .agg(F.max(version).alias("_version")).withColumn("_kind", F.lit(0)))
    both = asked.unionByName(given, allowMissingColumns=True)
    order = ["_key", "_at", "_kind"]
    # Equal rows of a hot key and day are parted by a hash; the order among them does not matter.
    ranged = materialised(
        both.withColumn("_mix", F.xxhash64("_fact")).repartitionByRange(*order, "_mix")
        .withColumn("_range", F.spark_partition_id()), "as-of")
    within = Window.partitionBy("_range", "_key").orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = ranged.withColumn("_own", F.last("_version", ignorenulls=True).over(within))
    # One row a range: its last key, and the last version of that key in it.
    ends = ranged.groupBy("_range").agg(F.max("_key").alias("_key"), F.min("_key").alias("_first"))
    last = (ranged.where("_kind = 0").join(F.broadcast(ends.select("_range", F.col("_key").alias("_end"))), "_range")
            .where("_key = _end").groupBy("_range", "_key").agg(F.max_by("_version", "_at").alias("_last")))
    marks = ends.join(last, ["_range", "_key"], "left")
    # A range's first key goes on from earlier ranges that end with it; those have one row each.
    starts = ends.select("_range", F.col("_first").alias("_key"), F.lit(None).cast(
        marks.schema["_last"].dataType).alias("_last"), F.lit(0).alias("_mark"))
    enter = (marks.select("_range", "_key", "_last", F.lit(1).alias("_mark")).unionByName(starts)
             .withColumn("_enter", F.last("_last", ignorenulls=True).over(
                 Window.partitionBy("_key").orderBy("_range", "_mark").rowsBetween(Window.unboundedPreceding, -1)))
             .where("_mark = 0 and _enter is not null").select("_range", "_key", "_enter"))
    found = (carried.where("_kind = 1").join(F.broadcast(enter), ["_range", "_key"], "left")
             .withColumn("_found", F.when(F.col("_at").isNotNull(), F.coalesce("_own", "_enter"))))
    return found.select("_fact.*", *[F.col("_found")[a].alias(a) for a in attributes])
