"""Text normalisers as Column expressions (no UDF, so they stay inside code generation)."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

Col = str | Column
SPACES = r"(?U)\s+"
# visible characters at both ends: nothing to trim
TRIMMED = r"^[!-~](?:[ -~]*[!-~])?\z"


def as_col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once.

    A Column used in several branches is copied into each of them; nested normalisers would then grow
    beyond what code generation accepts and repeat their regular expressions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Col) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Col) -> Column:
    """One blank for every run of white space, none at the ends."""
    return F.trim(F.regexp_replace(as_col(c), SPACES, " "))


def blank_to_null(c: Col) -> Column:
    s = as_col(c).cast("string")
    return F.when(s.rlike(TRIMMED), s).otherwise(F.nullif(strip(s), F.lit("")))


def missing_to_null(c: Col) -> Column:
    """NULL, blank and the text `nan` all mean missing."""
    return let(strip(c), lambda s: F.when((s != "") & (F.lower(s) != "nan"), s))


def found(c: Col, pattern: str, group: int = 0) -> Column:
    """First match of `pattern`, NULL when there is none."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a fixed literal table, NULL for an unknown key. The map folds to one constant."""
    def quoted(t: str) -> str:
        return "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.try_element_at(F.expr("map(" + ", ".join(quoted(x) for kv in table.items() for x in kv) + ")"), key)


def rule_chain(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Name of the first rule whose pattern is found in `c` (ordered when-chain)."""
    head, *rest = rules
    out = F.when(c.rlike(head[1]), F.lit(head[0]))
    out = reduce(lambda acc, r: acc.when(c.rlike(r[1]), F.lit(r[0])), rest, out)
    return out.otherwise(F.lit(default)) if default is not None else out


def title_case(c: Col) -> Column:
    """Capital at the start of every run of letters, also after an apostrophe or a hyphen."""
    runs = F.regexp_extract_all(as_col(c), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                             F.lower(F.substring(w, 2, 2147483647)))), "")


def label_key(c: Col) -> Column:
    """Lower-case letters and digits with single blanks: equal labels despite punctuation."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(as_col(c), F.lit(""))), "[^a-z0-9]+", " "))


def percent_text(part: Col, whole: Col) -> Column:
    """Share in percent with one decimal, `n/a` of nothing.

    Rounded half to even on the exact value of the double: a coarse part that is exact in decimal is split
    off, so the remainder keeps the digits that decide a near tie.
    """
    part, whole = as_col(part), as_col(whole)

    def rounded(v: Column) -> Column:
        coarse = F.floor(v * 1024) / 1024
        return F.bround(coarse.cast("decimal(14,10)") + (v - coarse).cast("decimal(30,26)"), 1).cast("string")
    share = let(F.try_divide(F.lit(100.0) * part, whole), rounded)
    return F.when(whole == 0, F.lit("n/a")).otherwise(F.concat(share, F.lit("%")))


def general_number_text(c: Col) -> Column:
    """Shortest text with six significant digits: 1.5 -> 1.5, 1e-05 stays exponential, 1234567 -> 1.23457e+06.

    A number whose shortest decimal form ends in a 5 right after the sixth digit is rounded up.
    """
    v = as_col(c).cast("double")

    def fixed(e: Column) -> Column:
        plain = reduce(lambda acc, p: acc.when(e["power"] == p, F.format_string(f"%.{5 - p}f", e["v"])),
                       range(-3, 6), F.when(e["power"] == -4, F.format_string("%.9f", e["v"])))
        return let(plain, lambda t: F.when(t.contains("."), F.regexp_replace(t, r"\.?0+$", "")).otherwise(t))

    def of(sci: Column) -> Column:
        return let(F.struct(v.alias("v"), F.regexp_extract(sci, r"e([+-]\d+)$", 1).cast("int").alias("power"),
                            F.regexp_replace(F.regexp_extract(sci, r"^(-?\d\.\d+)e", 1), r"\.?0+$", "").alias("digits"),
                            F.regexp_extract(sci, r"(e[+-]\d+)$", 1).alias("tail")),
                   lambda e: F.when((e["power"] < -4) | (e["power"] >= 6), F.concat(e["digits"], e["tail"])).otherwise(fixed(e)))
    return F.when(v == 0, F.lit("0")).otherwise(let(F.format_string("%.5e", v), of))
