"""Number parsers. Three rules exist side by side and differ on purpose."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelkit.functions.text import Col, as_col, let, missing_to_null, squeeze, strip

# try_cast alone would accept '1d' and 'nan', so the text has to look like a number first
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MINUS_SIGNS = "−–"
# a number that needs no cleaning, as most values are: read without binding a value, so inside generated code
PLAIN = r"^[+-]?\d{1,300}(?:\.\d{0,300})?\z"
DIGITS = r"^\d+\z"


def _number(text: Column) -> Column:
    return let(text, lambda t: F.when(t.rlike(NUMBER), t.try_cast("double")))


def _or_plain(c: Col, cleaned: Column) -> Column:
    s = as_col(c).cast("string")
    return F.when(s.rlike(PLAIN), s.try_cast("double")).otherwise(cleaned)


def strict_number(c: Col) -> Column:
    """'1,169' is missing."""
    return _or_plain(c, _number(strip(as_col(c).cast("string"))))


def comma_number(c: Col) -> Column:
    """'1,169' is 1169."""
    return _or_plain(c, _number(F.replace(strip(as_col(c).cast("string")), F.lit(","), F.lit(""))))


def any_minus_number(c: Col) -> Column:
    """Commas dropped; the minus sign and the en dash count as a minus."""
    return _or_plain(c, _number(F.translate(strip(as_col(c).cast("string")), MINUS_SIGNS + ",", "--")))


def comparable(c: Col) -> Column:
    """struct(num, txt): a number if it reads as one, else the cleaned text; both NULL when missing."""
    def of(p: Column) -> Column:
        return F.struct(p["num"].alias("num"), F.when(p["num"].isNull(), F.lower(squeeze(p["s"]))).alias("txt"))
    s = as_col(c).cast("string")
    cleaned = let(missing_to_null(s), lambda t: let(F.struct(t.alias("s"), any_minus_number(t).alias("num")), of))
    return F.when(s.rlike(PLAIN), F.struct(s.try_cast("double").alias("num"), F.lit(None).cast("string").alias("txt"))).otherwise(cleaned)


def same(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Null-safe equality of two comparable values: numbers within the tolerance, text exactly."""
    both = a["num"].isNotNull() & b["num"].isNotNull()
    neither = a["num"].isNull() & b["num"].isNull()
    return F.coalesce(
        F.when(both, F.abs(a["num"] - b["num"]) <= tolerance)
         .when(neither, a["txt"].eqNullSafe(b["txt"])), F.lit(False))


def tri_state(c: Col) -> Column:
    t = as_col(c).cast("string")
    cleaned = let(F.upper(strip(t)), lambda s: F.when(s == "TRUE", F.lit(True)).when(s == "FALSE", F.lit(False)))
    return F.when(t.isin("True", "TRUE"), F.lit(True)).when(t.isin("False", "FALSE"), F.lit(False)).otherwise(cleaned)


def int_text(c: Col) -> Column:
    """'65.0' -> '65'; missing -> NULL; anything else unchanged."""
    s = as_col(c).cast("string")
    return F.when(s.rlike(DIGITS), s).otherwise(F.regexp_replace(missing_to_null(s), r"^(-?\d+)\.0+$", "$1"))
