"""Column helpers for dirty text. All are plain expressions, inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Texts a CSV reader takes for a missing value (exact match).
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Trimmed texts that mean "missing" to the rules and to the string cast.
MISSING_EXACT = ("", "nan", "None", "NULL")
MISSING_ANY_CASE = ("", "nan", "none", "null")

_WHITESPACE = " \t\n\r\f\x0b"
_NUMBER = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
_WHOLE = r"^\s*([+-]?[0-9]+)(?:\.0*)?\s*$"
_EXPONENT = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+)\s*$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITESPACE))


def csv_null(c: Column) -> Column:
    """Missing-value texts become null, everything else stays as read."""
    return F.when(~c.isin(*CSV_NULL_TOKENS), c)


def is_blank(c: Column) -> Column:
    """Null, or one of the exact missing texts after trimming. Never null."""
    return c.isNull() | strip(c).isin(*MISSING_EXACT)


def is_missing(c: Column) -> Column:
    """Null, or a missing text in any letter case. Never null."""
    return c.isNull() | F.lower(strip(c)).isin(*MISSING_ANY_CASE)


def clean_string(c: Column, nullable: bool) -> Column:
    text = strip(c)
    return F.when(~text.isin(*MISSING_EXACT), text) if nullable else text


def to_number(c: Column) -> Column:
    """Double of a plain decimal number, else null.

    Spark's own cast would also take '1d' or 'NaN'. No match extracts '', which casts to
    null: without a CASE the parse is one common subexpression wherever it is used.
    """
    return F.regexp_extract(c, _NUMBER, 1).try_cast("double")


def to_long(c: Column) -> Column:
    """Whole number, else null. '10.0' and '1e3' count, '10.5' does not; digits stay exact."""
    exponent = F.regexp_extract(c, _EXPONENT, 1).try_cast("double")
    return F.coalesce(F.regexp_extract(c, _WHOLE, 1).try_cast("bigint"),
                      F.when(exponent % 1 == 0, exponent.try_cast("bigint")))


def safe_divide(a: Column, b: Column) -> Column:
    """a / b as double; null when b is zero or null."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def divide_or_zero(a: Column, b: Column) -> Column:
    """a / b as double; 0 when b is zero or null, or a is null."""
    return F.coalesce(safe_divide(a, b), F.lit(0.0))


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def record_key(columns: list[str]) -> Column:
    """Key columns joined by '_'; a null part reads 'None'."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])
