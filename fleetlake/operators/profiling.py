"""Column profiles of a table, from one shuffle over its distinct values.

A table is unpivoted to (column, value) cells which are counted per value. Counts combine
before the shuffle, so a value that fills most rows costs one row per task. Everything per
column is then an aggregate over distinct values, weighted by their counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake import registry
from fleetlake.functions import casting, text

# A text column with at most this many values is reported as an enum with its values.
ENUM_LIMIT = 25

# Date patterns a value may follow, and the name each is reported under.
DATE_PATTERNS = (
    (r"^\d{4}-\d{2}-\d{2}$", "YYYY-MM-DD"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "YYYY-MM-DD HH:MM:SS"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6}$", "YYYY-MM-DD HH:MM:SS.ffffff"),
)


def cells(df: DataFrame) -> DataFrame:
    """(column_name, value as text) for every cell."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column_name", "value")


def value_counts(df: DataFrame) -> DataFrame:
    return cells(df).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _pct(a: Column, b: Column) -> Column:
    return F.round(F.coalesce(text.safe_divide(a * 100.0, b), F.lit(0.0)), 2)


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: nulls, distinct values and duplicates over the non-null values."""
    present = F.col("value").isNotNull()
    per_column = value_counts(df).groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_values"))
    filled = F.col("row_count") - F.col("null_count")
    duplicates = filled - F.col("unique_values")
    return per_column.select(
        "column_name", "row_count", "null_count", _pct(F.col("null_count"), F.col("row_count"))
        .alias("null_pct"), "unique_values", duplicates.alias("duplicate_count"),
        _pct(duplicates, filled).alias("duplicate_pct"))


def column_profile_approx(df: DataFrame) -> DataFrame:
    """As ``column_profile`` with sketched distinct counts: one pass, no shuffle of values."""
    columns = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
        *[F.approx_count_distinct(c).alias(f"u_{c}") for c in columns])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"),
                 F.col(f"n_{c}").alias("null_count"), F.col(f"u_{c}").alias("unique_values"))
        for c in columns])))


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns and fully duplicated rows of a table.

    Duplicates are counted per distinct row: equal rows combine before the shuffle.
    """
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    totals = distinct.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                          F.count(F.lit(1)).alias("_distinct"))
    duplicates = F.col("row_count") - F.col("_distinct")
    return totals.select(
        F.lit(table).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        duplicates.alias("duplicate_rows"),
        _pct(duplicates, F.col("row_count")).alias("duplicate_pct"))


def _is_integer(c: Column) -> Column:
    return c.rlike(r"^[+-]?[0-9]+$")


def inferred_types(df: DataFrame, enum_limit: int = ENUM_LIMIT) -> DataFrame:
    """Type, enum size and date format that the non-null texts of each column agree on."""
    v = F.col("value")
    matches = {
        "_bool": F.lower(v).isin("true", "false"),
        "_int": _is_integer(v),
        "_num": text.to_number(v).isNotNull(),
        **{f"_d{i}": v.rlike(p) for i, (p, _) in enumerate(DATE_PATTERNS)},
    }
    per_column = value_counts(df).where(v.isNotNull()).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("unique_values"),
        *[F.bool_and(test).alias(name) for name, test in matches.items()],
        F.bool_and(matches["_d1"] | matches["_d2"]).alias("_ts"))
    kind = (F.when(F.col("_bool"), "BOOLEAN").when(F.col("_int"), "INTEGER")
            .when(F.col("_num"), "FLOAT / DECIMAL").when(F.col("_d0"), "DATE")
            .when(F.col("_d1"), "TIMESTAMP").when(F.col("_ts"), "TIMESTAMP (microsecond)")
            .when(F.col("unique_values") <= enum_limit,
                  F.format_string("VARCHAR (ENUM - %d values)", "unique_values"))
            .otherwise("VARCHAR / STRING"))
    fmt = (F.when(F.col("_d0"), DATE_PATTERNS[0][1]).when(F.col("_d1"), DATE_PATTERNS[1][1])
           .when(F.col("_ts"), DATE_PATTERNS[2][1]).otherwise("N/A"))
    return per_column.select("column_name", kind.alias("inferred_type"), fmt.alias("date_format"))


def type_shares(df: DataFrame, least: float = 0.9) -> DataFrame:
    """Per column the share of non-null rows that each candidate type reads, the narrowest type that
    reads ``least`` of them (else text), and the rows and distinct values it does not read.

    Unlike ``inferred_types`` a few bad values do not make a column text: they are its outliers.
    """
    v = F.col("value")
    tests = {"boolean": F.lower(v).isin("true", "false"), "integer": _is_integer(v),
             "number": text.to_number(v).isNotNull(), "date": v.rlike(DATE_PATTERNS[0][0]),
             "timestamp": v.rlike(DATE_PATTERNS[1][0]) | v.rlike(DATE_PATTERNS[2][0])}
    per_column = value_counts(df).where(v.isNotNull()).groupBy("column_name").agg(
        F.sum("n").alias("values"), F.count(F.lit(1)).alias("_distinct"),
        *[F.sum(F.when(test, F.col("n")).otherwise(0)).alias(f"_{k}") for k, test in tests.items()],
        *[F.count_if(test).alias(f"_{k}_distinct") for k, test in tests.items()])

    def chosen(value, otherwise):
        out = F.when(F.lit(False), otherwise)
        for k in tests:
            out = out.when(F.col(f"_{k}") >= F.col("values") * least, value(k))
        return out.otherwise(otherwise)

    return per_column.select(
        "column_name", "values",
        *[F.round(F.col(f"_{k}") / F.col("values"), 6).alias(f"{k}_share") for k in tests],
        chosen(lambda k: F.lit(k), F.lit("text")).alias("dominant_type"),
        chosen(lambda k: F.col("values") - F.col(f"_{k}"), F.lit(0)).cast("long").alias("outlier_rows"),
        chosen(lambda k: F.col("_distinct") - F.col(f"_{k}_distinct"), F.lit(0)).cast("long").alias("outlier_values"))


# Sketches of 2^14 registers: a relative standard error of 0.81 %.
HLL_LOG2 = 14
HLL_ERROR = 1.04 / 2 ** (HLL_LOG2 / 2)
KLL_K = 400
# Rank error of such a quantile sketch, in 99 of 100 cases (published bound 2.446 / k^0.943 for one rank).
KLL_ERROR = 2.446 / KLL_K ** 0.943


def sketched(df: DataFrame, batch: str, quantiles_of: list[str] = ()) -> DataFrame:
    """Mergeable profile state: a row per batch and column with rows, nulls, least and greatest value,
    and a sketch of its distinct values; of the numeric columns named, a sketch of their quantiles.

    Store it when a batch arrives; later profiles merge states and read no rows.
    """
    columns = [c for c in df.columns if c != batch]
    sizes = [F.count(F.lit(1)).alias("_rows")]
    sizes += [f.alias(f"{n}_{c}") for c in columns for n, f in (
        ("nulls", F.count_if(F.col(c).isNull())), ("least", F.min(F.col(c).cast("string"))),
        ("greatest", F.max(F.col(c).cast("string"))),
        ("distinct", F.hll_sketch_agg(F.col(c).cast("string"), HLL_LOG2)))]
    sizes += [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_K).alias(f"quantiles_{c}") for c in quantiles_of]
    wide = df.groupBy(batch).agg(*sizes)
    none = F.lit(None).cast("binary")
    return wide.select(batch, F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"nulls_{c}").alias("null_count"),
        F.col(f"least_{c}").alias("least"), F.col(f"greatest_{c}").alias("greatest"),
        F.col(f"distinct_{c}").alias("distinct_values"),
        (F.col(f"quantiles_{c}") if c in quantiles_of else none).alias("quantiles")) for c in columns])))


def merged_profile(states: DataFrame, ranks: tuple[float, ...] = (0.5,)) -> DataFrame:
    """Profile of all batches from their stored states: counts exact, distinct values and quantiles
    within HLL_ERROR (one standard deviation) and KLL_ERROR (rank)."""
    found = states.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct_values").alias("_distinct"), F.count("quantiles").alias("_sketched"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"))
    return found.select(
        "column_name", "row_count", "null_count", "least", "greatest",
        F.hll_sketch_estimate("_distinct").alias("unique_values"),
        *[F.when(F.col("_sketched") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(r)))
          .alias(f"q{round(r * 100)}") for r in ranks])


def enum_values(df: DataFrame, limit: int = ENUM_LIMIT) -> DataFrame:
    """(column, value, rows, distinct values) for columns of at most ``limit`` distinct non-null ones.

    One row per value: no list of values is ever built. A column with more values is one row
    without a value that tells how many there are.
    """
    counts = value_counts(df).where("value IS NOT NULL")
    per_column = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    # One row per column of the table, so the broadcast is bounded by the schema.
    listed = counts.join(F.broadcast(per_column.where(F.col("distinct_values") <= limit)), "column_name")
    return listed.select("column_name", "value", "n", "distinct_values").unionByName(
        per_column.where(F.col("distinct_values") > limit), allowMissingColumns=True)


def temporal_scope(df: DataFrame, columns: list[str]) -> DataFrame:
    """First and last value of each date or timestamp column, in one pass."""
    wide = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns
                    for n, f in (("lo", F.min), ("hi", F.max))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.to_date(f"lo_{c}").alias("first_date"),
                 F.to_date(f"hi_{c}").alias("last_date")) for c in columns])))


def invalid_values(df: DataFrame, columns: tuple[registry.Column, ...]) -> DataFrame:
    """Per declared column: texts that are present but do not cast to the declared type."""
    present = [c for c in columns if c.name in df.columns]
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~text.is_missing(F.col(c.name))
                     & casting.cast_column(F.col(c.name), c).isNull()).alias(c.name)
          for c in present])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("column_name"), F.lit(c.type).alias("declared_type"),
                 F.col(c.name).alias("invalid_count")) for c in present])))


def key_uniqueness(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Distinct keys and rows that share their key with another row."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_key_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(", ".join(key)).alias("key_columns"),
             "distinct_keys", "duplicate_key_rows")
