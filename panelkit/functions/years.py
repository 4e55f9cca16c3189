"""Year labels: parsing, comparison form, tokens, effective year."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelkit.functions.text import Col, as_col, blank_to_null, found, let, squeeze

TWO_PART = r"(?i)^(?:FY\s?)?(\d{4})\s*[/-]\s*(\d{2}|\d{4})$"
ONE_PART = r"(?i)^(?:FY\s?)?(\d{4})$"
# labels as most are written: read without binding a value, so inside generated code
PLAIN = r"^(?:FY)?\d{4}\z"
PLAIN_TWO = r"^\d{4}[/-](?:\d{2}|\d{4})\z"


def _label_parts(t: Column) -> Column:
    """struct(t, a, b, one): the label, its first and second year, or its only year.

    A two-digit second part takes the first one's century.
    """
    two = F.struct(found(t, TWO_PART, 1).alias("a"), found(t, TWO_PART, 2).alias("b"))
    return let(two, lambda p: F.struct(
        t.alias("t"), p["a"].cast("int").alias("a"),
        F.when(F.length(p["b"]) == 4, p["b"]).otherwise(F.concat(F.substring(p["a"], 1, 2), p["b"])).cast("int").alias("b"),
        F.when(p["a"].isNull(), found(t, ONE_PART, 1)).alias("one")))


def _plain_parts(s: Column) -> tuple[Column, Column, Column]:
    """(year, first, second) of a plain label: its last four digits, and both years of a plain label of two parts."""
    second = F.when(F.length(s) == 9, F.substring(s, 6, 4)).otherwise(F.concat(F.substring(s, 1, 2), F.substring(s, 6, 2)))
    return F.substring(s, -4, 4).cast("int"), F.substring(s, 1, 4).cast("int"), second.cast("int")


def _cleaned(c: Col) -> Column:
    return let(squeeze(as_col(c).cast("string")), lambda s: F.when((s != "") & (F.lower(s) != "nan"), s))


def parse_year_label(c: Col) -> Column:
    """struct(kind, y0, y1, note); kind is single, range or invalid."""

    def out(kind: str, y0: Column, y1: Column, note: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), y0.cast("int").alias("y0"), y1.cast("int").alias("y1"), note.alias("note"))

    def noted(prefix: str, t: Column) -> Column:
        return F.concat(F.lit(prefix), t)

    none = F.lit(None)

    def inside(t: Column) -> Column:
        """A label that holds exactly one year somewhere in its text."""
        seen = F.array_distinct(F.regexp_extract_all(t, F.lit(r"\b(\d{4})\b"), F.lit(1)))
        return let(seen, lambda y: F.when(F.size(y) == 1, let(F.get(y, F.lit(0)).cast("int"), lambda n: out(
            "single", n, n, noted("extracted_from_text_", t)))).otherwise(out("invalid", none, none, noted("unparsed_", t))))

    def of(p: Column) -> Column:
        t, a, b = p["t"], p["a"], p["b"]
        one = p["one"].cast("int")
        return (
            F.when(t.isNull(), out("invalid", none, none, F.lit("missing")))
            .when(b - a == 1, out("single", b, b, noted("fiscal_year_end_of_", t)))
            .when(b > a, out("range", a, b, noted("multi_year_range_", t)))
            .when(a.isNotNull(), out("invalid", none, none, noted("unparsed_", t)))
            .when(p["one"].isNotNull(), out("single", one, one, F.when(F.upper(t).startswith("FY"), "fy_label").otherwise("")))
            .otherwise(inside(t)))
    s = as_col(c).cast("string")
    year, first, second = _plain_parts(s)
    return (
        F.when(s.rlike(PLAIN), out("single", year, year, F.when(s.startswith("FY"), "fy_label").otherwise("")))
        .when(s.rlike(PLAIN_TWO), F.when(second - first == 1, out("single", second, second, noted("fiscal_year_end_of_", s)))
              .when(second > first, out("range", first, second, noted("multi_year_range_", s))).otherwise(out("invalid", none, none, noted("unparsed_", s))))
        .otherwise(let(_cleaned(s), lambda t: let(_label_parts(t), of))))


def year_for_comparison(c: Col) -> Column:
    """Text two runs are compared on: the fiscal end year, the plain year, or the lower-case label."""
    s = as_col(c).cast("string")
    _, first, second = _plain_parts(s)
    return (
        F.when(s.rlike(PLAIN), F.substring(s, -4, 4))
        .when(s.rlike(PLAIN_TWO), F.when(second - first == 1, second.cast("string")).otherwise(s))
        .otherwise(let(_cleaned(s), lambda t: let(_label_parts(t), lambda p: F.when(p["b"] - p["a"] == 1, p["b"].cast("string"))
                                                  .when(p["a"].isNotNull(), F.lower(p["t"])).otherwise(F.coalesce(p["one"], F.lower(p["t"])))))))


def year_token(c: Col) -> Column:
    """A slash form anywhere beats a dash form, which beats a plain year."""
    s = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.coalesce(found(s, r"\b\d{4}/\d{2,4}\b"), found(s, r"\b\d{4}-\d{2,4}\b"), found(s, r"\b\d{4}\b"))


def leftmost_year_token(c: Col) -> Column:
    return found(F.coalesce(as_col(c).cast("string"), F.lit("")), r"\b\d{4}(?:[/-]\d{2,4})?\b")


def label_agreement(year: Col, label: Col) -> Column:
    """Yes / No / Unknown: do the chosen year and its column label carry the same token?"""
    both = F.struct(year_token(year).alias("y"), year_token(label).alias("l"))
    return let(both, lambda t: F.when(t["y"].isNull() | t["l"].isNull(), "Unknown").when(t["y"] == t["l"], "Yes").otherwise("No"))


def effective_label(columns: list[str], year_first: bool = True) -> Column:
    """The label of the year a row stands for. The two callers coalesce in opposite orders."""
    order = ["year", "last_actual_year"] if year_first else ["last_actual_year", "year"]
    have = [blank_to_null(c) for c in order if c in columns]
    return F.coalesce(*have, F.lit("")) if have else F.lit("")


def effective_year(label: Col) -> Column:
    """The single year, or the end of a range; NULL when unusable."""
    return parse_year_label(label)["y1"]


def batch_of_year(year: Col, first: int = 1996, last: int = 2026) -> Column:
    """Five-year publication batch: 1996-2000, 2001-2005, ..., 2016-2020, and 2021-2026 as the last."""
    y = as_col(year)
    start = F.lit(first) + F.floor((y - first) / 5) * 5
    return (F.when((y < first) | (y > last) | y.isNull(), "Other")
            .when(y >= last - 5, f"{last - 5}-{last}")
            .otherwise(F.concat_ws("-", start.cast("int").cast("string"), (start + 4).cast("int").cast("string"))))
