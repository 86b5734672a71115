"""Data-quality rules as one projection: flag, attribute, split, measure, gate."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from fleetlake import registry
from fleetlake.functions import casting, text
from fleetlake.operators.joins import is_small, lookup_join
from fleetlake.registry import Rule
from fleetlake.sources.scratch import materialised

PK_RULE = "pk_uniqueness"
REJECTION_COLUMNS = ("_record_pk", "_rejection_rule", "_rejection_reason", "_rejected_at")


class RejectionRateExceeded(Exception):
    """A table rejected more rows than the batch allows."""


# ------------------------------------------------------------------ predicates
def fails(rule: Rule) -> Column:
    """True where a raw text row breaks ``rule``. Never null. Not for sql_expression."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return text.is_blank(c)
    if rule.kind == "enum":
        allowed = [v.strip().lower() for v in rule.allowed]
        word = F.lower(text.strip(c))
        return ~text.is_missing(c) & ~F.coalesce(word.isin(*allowed), F.lit(False))
    if rule.kind == "range":
        number = text.to_number(c)
        outside = number.isNull()
        if rule.min is not None:
            outside = outside | (number < F.lit(float(rule.min)))
        if rule.max is not None:
            outside = outside | (number > F.lit(float(rule.max)))
        return F.coalesce(outside, F.lit(False)) & ~text.is_missing(c)
    raise ValueError(f"rule kind {rule.kind!r} has no column predicate")


def active_rules(rules: Iterable[Rule], columns: list[str], severity: str = "ERROR") -> list[Rule]:
    """Rules of one severity whose column is there; a rule on an absent column is skipped."""
    return [r for r in rules if r.severity == severity
            and (r.kind == "sql_expression" or r.column in columns)]


def resolvable(df: DataFrame, rules: list[Rule], columns: tuple[registry.Column, ...]) -> list[Rule]:
    """``rules`` without the SQL rules that name a column ``df`` does not have. Spark's own analysis
    tells; any other fault of an expression stays an error."""
    declared = {c.name: c for c in columns}
    typed = df.limit(0).select(*[
        (casting.cast_column(F.col(n), declared[n]) if n in declared else F.col(n)).alias(n) for n in df.columns])

    def known(rule: Rule) -> bool:
        try:
            return bool(typed.select(F.expr(rule.expression)).columns)
        except AnalysisException as error:
            if str(error.getCondition()).startswith("UNRESOLVED_COLUMN"):
                return False
            raise

    return [r for r in rules if r.kind != "sql_expression" or known(r)]


def _flag(rule: Rule) -> str:
    return f"_fails_{rule.id}"


def with_failure_flags(df: DataFrame, rules: list[Rule],
                       columns: tuple[registry.Column, ...]) -> DataFrame:
    """Add one boolean per rule.

    SQL rules see the typed values of the declared columns. The raw row rides along in a
    struct for that step; Catalyst folds the three projections into one.
    """
    if not rules:
        return df
    raw = df.columns
    expressions = [r for r in rules if r.kind == "sql_expression"]
    flagged = df.withColumns({_flag(r): fails(r) for r in rules if r.kind != "sql_expression"})
    if not expressions:
        return flagged
    flags = [c for c in flagged.columns if c not in raw]
    declared = {c.name: c for c in columns}
    typed = [casting.cast_column(F.col(n), declared[n]).alias(n) for n in raw if n in declared]
    carried = flagged.select(F.struct(*raw).alias("_raw"), *flags, *typed)
    checked = carried.withColumns({
        _flag(r): ~F.coalesce(F.expr(r.expression), F.lit(True)) for r in expressions})
    return checked.select("_raw.*", *[_flag(r) for r in rules])


# ------------------------------------------------------------- key uniqueness
def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row. Counts combine before the shuffle, so a hot key is cheap."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").select(*key, F.lit(True).alias("_duplicate")))


def mark_duplicates(df: DataFrame, key: list[str], duplicates: DataFrame | None = None) -> DataFrame:
    """Add ``_duplicate``: true on every row of a key that occurs twice or more.

    Null keys equal each other. No window: a window would gather a whole group in a task. Duplicate
    keys are few, but a plan sizes them like the table they are counted from. Where that is large they
    are written first, so that the join knows their real size and wide rows are not shuffled.
    """
    found = duplicate_keys(df, key) if duplicates is None else duplicates
    if duplicates is None and not is_small(found):
        found = materialised(found, "duplicate-keys")
    joined = lookup_join(df, found, on=key, how="left", null_safe=True)
    return joined.withColumn("_duplicate", F.coalesce("_duplicate", F.lit(False)))


# ------------------------------------------------------------------ evaluation
def annotate(
    df: DataFrame,
    rules: Iterable[Rule],
    key: list[str],
    columns: tuple[registry.Column, ...],
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """Add ``_rejection_rule`` and ``_rejection_reason``: the first failure of each row.

    Order: key uniqueness, then the rules as listed. Both are null on a valid row.
    """
    raw = df.columns
    rules = resolvable(df, active_rules(rules, raw), columns)
    checks: list[tuple[str, str, str]] = []
    work = with_failure_flags(df, rules, columns)
    if key and all(k in raw for k in key):
        work = mark_duplicates(work, key, duplicates)
        checks.append(("_duplicate", PK_RULE, f"Duplicate primary key ({', '.join(key)})"))
    checks += [(_flag(r), r.id, r.description) for r in rules]
    if not checks:
        nothing = F.lit(None).cast("string")
        return df.withColumns({"_rejection_rule": nothing, "_rejection_reason": nothing})
    return work.select(
        *raw,
        F.coalesce(*[F.when(F.col(flag), F.lit(id)) for flag, id, _ in checks])
        .alias("_rejection_rule"),
        F.coalesce(*[F.when(F.col(flag), F.lit(why)) for flag, _, why in checks])
        .alias("_rejection_reason"))


def annotate_table(df: DataFrame, table: str, duplicates: DataFrame | None = None) -> DataFrame:
    meta = registry.table(table)
    return annotate(df, registry.rules(table), list(meta.primary_key), meta.columns, duplicates)


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("_rejection_rule").isNull()).drop(
        "_rejection_rule", "_rejection_reason")


def quarantined_rows(annotated: DataFrame, key: list[str], batch_id: str,
                     rejected_at: Column | None = None) -> DataFrame:
    """Failing rows with their key text, rule, reason, time and the batch that rejected them. Key
    columns that are not there are left out of the key text."""
    raw = [c for c in annotated.columns
           if c not in ("_rejection_rule", "_rejection_reason", "_batch_id")]
    there = [k for k in key if k in raw]
    record = text.record_key(there) if there else F.lit(None).cast("string")
    when = F.current_timestamp() if rejected_at is None else rejected_at
    return annotated.where(F.col("_rejection_rule").isNotNull()).select(
        *raw, record.alias("_record_pk"), "_rejection_rule", "_rejection_reason",
        when.alias("_rejected_at"), F.lit(batch_id).alias("_batch_id"))


def evaluate_table(df: DataFrame, table: str, batch_id: str,
                   quarantine: bool = True) -> tuple[DataFrame, DataFrame]:
    """(typed-text valid rows, quarantined rows) of one raw table.

    With ``quarantine=False`` nothing is taken out: every row is valid.
    """
    annotated = annotate_table(df, table)
    rejected = quarantined_rows(annotated, registry.primary_key(table), batch_id)
    if not quarantine:
        return df, rejected.limit(0)
    return valid_rows(annotated), rejected


def warning_counts(df: DataFrame, rules: Iterable[Rule],
                   columns: tuple[registry.Column, ...]) -> DataFrame:
    """Failing rows per WARNING rule. Warnings never quarantine."""
    warnings = active_rules(rules, df.columns, severity="WARNING")
    if not warnings:
        return df.sparkSession.createDataFrame([], "rule_id string, failed_rows bigint")
    counts = with_failure_flags(df, warnings, columns).agg(
        *[F.count_if(_flag(r)).alias(r.id) for r in warnings])
    return counts.unpivot([], [r.id for r in warnings], "rule_id", "failed_rows")


# --------------------------------------------------------------------- metrics
def metric_columns() -> list[Column]:
    """Row counts of an annotated table, for ``agg`` or ``observe``."""
    failed = F.col("_rejection_rule").isNotNull()
    return [F.count(F.lit(1)).alias("total_records"),
            F.count_if(~failed).alias("valid_records"),
            F.count_if(failed).alias("quarantined_records")]


def table_metrics(annotated: DataFrame, table: str) -> DataFrame:
    """One row: counts, rejection rate (0 when empty) and quality score of a table."""
    return with_rates(annotated.agg(*metric_columns()).select(F.lit(table).alias("table_name"), "*"))


def with_rates(metrics: DataFrame) -> DataFrame:
    rate = text.divide_or_zero(
        F.col("quarantined_records") * 100.0, F.col("total_records"))
    return metrics.withColumn("rejection_rate_pct", rate).withColumn(
        "dq_score_pct", 100.0 - F.col("rejection_rate_pct"))


def batch_rollup(metrics: DataFrame) -> DataFrame:
    """Totals over all tables; the score is 100 for an empty batch."""
    return metrics.agg(
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("quarantined_records").alias("quarantined_records"),
    ).withColumn("dq_score_pct", F.coalesce(
        text.safe_divide(F.col("valid_records") * 100.0, F.col("total_records")), F.lit(100.0)))


def gate_breaches(metrics: DataFrame,
                  threshold_pct: float = registry.MAX_REJECTION_RATE_PCT) -> DataFrame:
    """Tables whose rejection rate is above (not at) the threshold."""
    return metrics.where(F.col("rejection_rate_pct") > threshold_pct).withColumn(
        "threshold_pct", F.lit(float(threshold_pct)))


def check_gate(table: str, total: int, quarantined: int,
               threshold_pct: float = registry.MAX_REJECTION_RATE_PCT) -> None:
    rate = quarantined * 100.0 / total if total else 0.0
    if rate > threshold_pct:
        raise RejectionRateExceeded(
            f"{table}: {rate:.2f}% of the rows are rejected, at most {threshold_pct:.2f}% may be")


# ---------------------------------------------------------------- foreign keys
def orphan_counts(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """Orphan values and rows for each declared foreign key of the named tables.

    Each child is scanned once for all its keys, and each parent once for all its children: the
    keys are unpivoted and counted per value (so a hot value is one row per task), and one anti
    join compares them with the keys of all parents.
    """
    links = [(n, fk) for n in names for fk in registry.foreign_keys(n)]
    counted = []
    for name in dict.fromkeys(n for n, _ in links):
        own = [fk for n, fk in links if n == name]
        optional = [fk.column for fk in own if fk.nullable]
        counted.append(
            tables[name].select(*[F.col(fk.column).cast("string") for fk in own])
            .unpivot([], [fk.column for fk in own], "fk_column", "fk_value")
            .where(F.col("fk_value").isNotNull() | ~F.col("fk_column").isin(optional))
            .select(F.lit(name).alias("table_name"), "fk_column", "fk_value"))
    spark = counted[0].sparkSession
    declared = spark.createDataFrame(
        [(n, fk.column, fk.parent_table, f"{fk.parent_table}.{fk.parent_column}") for n, fk in links],
        "table_name string, fk_column string, parent_table string, _parent string")
    # One row per declared key: bounded by the schema.
    values = (reduce(DataFrame.unionByName, counted).join(F.broadcast(declared), ["table_name", "fk_column"])
              .groupBy("table_name", "fk_column", "_parent", "fk_value").agg(F.count(F.lit(1)).alias("_rows")))
    parents = reduce(DataFrame.unionByName, [
        tables[t].select(F.lit(f"{t}.{c}").alias("_parent"), F.col(c).cast("string").alias("fk_value"))
        for t, c in dict.fromkeys((fk.parent_table, fk.parent_column) for _, fk in links)])
    found = values.join(parents, ["_parent", "fk_value"], "left_anti").groupBy("table_name", "fk_column").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("_rows").alias("orphan_rows"))
    return declared.join(found, ["table_name", "fk_column"], "left").select(
        "table_name", "fk_column", "parent_table",
        F.coalesce("orphan_keys", F.lit(0)).alias("orphan_keys"),
        F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"))
