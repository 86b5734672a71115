"""Cast raw text columns to their declared types; a bad value becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake import registry
from fleetlake.functions import text

# Accepted spellings of a boolean, trimmed and in any letter case.
TRUE_TEXTS = ("true", "1", "t", "yes")
FALSE_TEXTS = ("false", "0", "f", "no")


def to_boolean(c: Column) -> Column:
    word = F.lower(text.strip(c))
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)


def to_timestamp(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(text.strip(c), F.lit(fmt))


def cast_column(c: Column, column: registry.Column) -> Column:
    """Typed value of raw text ``c``. Whole numbers are 64 bit, as they are published."""
    kind = column.type.lower()
    if kind in ("integer", "long"):
        return text.to_long(c)
    if kind in ("double", "float"):
        return text.to_number(c)
    if kind == "boolean":
        return to_boolean(c)
    if kind == "date":
        return to_timestamp(c, column.format or registry.DATE_FORMAT).cast("date")
    if kind == "timestamp":
        return to_timestamp(c, column.format or registry.TIMESTAMP_FORMAT)
    return text.clean_string(c, column.nullable)


def cast_table(df: DataFrame, columns: tuple[registry.Column, ...]) -> DataFrame:
    """Cast the declared columns that are present in one projection; others pass through."""
    declared = {c.name: c for c in columns}
    return df.select(*[
        cast_column(F.col(n), declared[n]).alias(n) if n in declared else F.col(n)
        for n in df.columns])


def conform(df: DataFrame, gold_table: str) -> DataFrame:
    """Project to a Gold contract: its columns that exist, in its order and types."""
    kinds = {c.name: registry.spark_type(c.type) for c in registry.GOLD[gold_table]}
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in kinds.items() if n in df.columns])


def missing_required(df: DataFrame, gold_table: str) -> list[Column]:
    """One count per NOT NULL column of the contract, for ``agg`` or ``observe``."""
    return [F.count_if(F.col(c.name).isNull()).alias(f"null_{c.name}")
            for c in registry.GOLD[gold_table] if not c.nullable and c.name in df.columns]
