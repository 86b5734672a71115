"""Slowly changing dimensions (type 2 and type 1) as set operations on keys."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.operators.asof import last_before
from fleetlake.operators.joins import is_small, lookup_join
from fleetlake.operators.surrogate import dense_key
from fleetlake.sources.scratch import materialised

DEFAULT_VALID_FROM = datetime.date(2020, 1, 1)
_KEPT, _CHANGED, _NEW = 0, 1, 2


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key. A reduce, so a key with many copies combines early."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(key, "_row.*").select(*df.columns))


def scd2_initial(incoming: DataFrame, key: str, sk: str, start_column: str,
                 default_start: datetime.date = DEFAULT_VALID_FROM) -> DataFrame:
    """First load: every key current, valid from its own start date."""
    numbered = dense_key(incoming, [key], sk)
    return numbered.withColumns({
        "valid_from": F.coalesce(F.col(start_column), F.lit(default_start)),
        "valid_to": F.lit(None).cast("date"),
        "is_current": F.lit(True)})


def scd2_merge(existing: DataFrame, incoming: DataFrame, key: str, sk: str,
               tracked: list[str], as_of: datetime.date, start_column: str) -> DataFrame:
    """Merge a batch of the state at ``as_of`` into a versioned dimension.

    ``as_of`` may lie anywhere: the version that holds it is compared with the batch. Where tracked
    columns differ (null-safe) that version ends at ``as_of`` and one from the batch takes the rest
    of its interval: up to the next version, or open and current if it was. A date before a key's
    first version puts a version in front of it, if they differ. So intervals of a key never overlap
    or run backwards, and a batch that comes late or again cannot undo a later one.
    Keys never seen before are added, valid from their start date or ``as_of``. Other history, keys
    absent from the batch and keys that no version holds at ``as_of`` (ended without a successor)
    stay. Surrogate keys continue after the largest one: changed keys first, then new keys, each in
    key order.
    """
    columns = existing.columns
    batch = one_row_per_key(incoming, key)
    attributes = [c for c in columns
                  if c in batch.columns and c not in (sk, "valid_from", "valid_to", "is_current")]
    day = F.lit(as_of)

    # Versions replaced on the day they began hold no date.
    held = F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))
    first = (existing.where(held).groupBy(F.col(key).alias("_f_key"))
             .agg(F.min(F.struct("valid_from", sk)).alias("_first")))
    old = existing.join(first, F.col(key) == F.col("_f_key"), "left").select(
        *[F.col(c).alias(f"_o_{c}") for c in columns], "_first")
    new = batch.select(*[F.col(c).alias(f"_n_{c}") for c in batch.columns])
    joined = old.join(new, F.col(f"_o_{key}") == F.col(f"_n_{key}"), "full_outer")

    known = F.col(f"_o_{key}").isNotNull()
    differs = reduce(lambda a, b: a | b, [
        ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in tracked])
    start, end, current = F.col("_o_valid_from"), F.col("_o_valid_to"), F.col("_o_is_current")
    candidate = known & F.col(f"_n_{key}").isNotNull() & differs
    changed = candidate & (start <= day) & ((end.isNull() & current) | (day < end))
    early = (candidate & (day < start) & (F.col("_first.valid_from") == start)
             & (F.col(f"_first.{sk}") == F.col(f"_o_{sk}")))

    fields = {f.name: f.dataType for f in existing.schema}

    def version(kind: int, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), *[
            values[c].cast(fields[c]).alias(c) for c in columns])

    kept = {c: F.col(f"_o_{c}") for c in columns}
    closed = {**kept, "valid_to": day, "is_current": F.lit(False)}
    null = F.lit(None)
    fresh = {c: F.col(f"_n_{c}") if c in attributes else null for c in columns}
    rest = {**fresh, "valid_from": day, "valid_to": end, "is_current": current}
    front = {**fresh, "valid_from": day, "valid_to": start, "is_current": F.lit(False)}
    addition = {**fresh, "valid_from": F.coalesce(F.col(f"_n_{start_column}"), day),
                "valid_to": null, "is_current": F.lit(True)}

    versions = materialised(joined.select(F.explode(
        F.when(changed, F.array(version(_KEPT, closed), version(_CHANGED, rest)))
        .when(early, F.array(version(_KEPT, kept), version(_CHANGED, front)))
        .when(~known, F.array(version(_NEW, addition)))
        .otherwise(F.array(version(_KEPT, kept)))).alias("_v")).select("_v.*"), "versions")

    last_sk = existing.agg(F.max(sk)).first()[0] or 0
    added = dense_key(versions.where(F.col("_kind") > _KEPT).drop(sk), ["_kind", key], sk, last_sk)
    return (versions.where(F.col("_kind") == _KEPT).select(*columns)
            .unionByName(added.select(*columns)))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def version_at(fact: DataFrame, dim: DataFrame, key: str, date_column: str,
               attributes: dict[str, str], limit: int | None = None) -> DataFrame:
    """Attributes of the dimension version valid on the date of each fact row.

    Intervals are half open (valid_from <= d < valid_to), so a change day has one match.
    ``attributes`` maps output name to dimension column. A dimension too large to broadcast is met
    range by range, so long histories and hot keys do not multiply.
    """
    if not is_small(dim.select(key, "valid_from", "valid_to", *dict.fromkeys(attributes.values())), limit):
        return version_at_ranges(fact, dim, key, date_column, attributes)
    lookup = dim.select(
        F.col(key), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        *[F.col(source).alias(name) for name, source in attributes.items()])
    day = F.col(date_column)
    inside = (day >= F.col("_from")) & (F.col("_to").isNull() | (day < F.col("_to")))
    return lookup_join(fact, lookup, on=[key], how="left", condition=inside,
                       limit=limit).drop("_from", "_to")


def version_at_ranges(fact: DataFrame, dim: DataFrame, key: str, date_column: str,
                      attributes: dict[str, str]) -> DataFrame:
    """``version_at`` for histories with many versions per key: each fact row meets one version, and a
    key that holds most rows is cut into ranges. Versions that hold no day are never valid."""
    held = dim.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    versions = held.select(F.col(key), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
                           *[F.col(source).alias(f"_a_{name}") for name, source in attributes.items()])
    found = last_before(fact, versions, key, date_column, "_from", ["_to", *[f"_a_{n}" for n in attributes]])
    valid = F.col("_to").isNull() | (F.col(date_column).cast("date") < F.col("_to"))
    return found.select(*fact.columns, *[F.when(valid, F.col(f"_a_{n}")).alias(n) for n in attributes])


def type1_upsert(existing: DataFrame, incoming: DataFrame, key: str, sk: str) -> DataFrame:
    """Overwrite attributes of known keys, append new ones, keep keys absent from the batch."""
    columns = existing.columns
    batch = one_row_per_key(incoming, key)
    old = existing.select(*[F.col(c).alias(f"_o_{c}") for c in columns])
    new = batch.select(*[F.col(c).alias(f"_n_{c}") for c in batch.columns])
    arrived = F.col(f"_n_{key}").isNotNull()
    merged = materialised(
        old.join(new, F.col(f"_o_{key}") == F.col(f"_n_{key}"), "full_outer").select(*[
            (F.when(arrived, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}"))
             if c != sk and c in batch.columns else F.col(f"_o_{c}")).alias(c)
            for c in columns]), "upsert")
    last_sk = existing.agg(F.max(sk)).first()[0] or 0
    added = dense_key(merged.where(F.col(sk).isNull()).drop(sk), [key], sk, last_sk)
    return merged.where(F.col(sk).isNotNull()).unionByName(added.select(*columns))
