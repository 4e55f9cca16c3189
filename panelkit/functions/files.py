"""What a file name says."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelkit.functions.names import normalize_entity
from panelkit.functions.text import Col, as_col, found, let

DATED = r"^(.*?)_(\d{4}-\d{2}-\d{2})"
STEM = r"(?i)^(.+?_\d{4}-\d{2}-\d{2}(?:_CR\d{4}-\d+)?)(_.*)?\.pdf$"
METHODS = ["selected_pdf_direct", "selected_pdf_image_compressed",
           "pymupdf_pillow_table_crop_fallback", "pymupdf_pillow_visual_fallback"]     # best first


def base_name(path: Col) -> Column:
    return F.regexp_extract(as_col(path), r"([^/\\]*)$", 1)


def report_date(name: Col) -> Column:
    """The date alone of `<entity>_<yyyy-mm-dd>...`."""
    return F.try_to_date(found(name, DATED, 2), "yyyy-MM-dd")


def report_file(name: Col) -> Column:
    """struct(entity, date, year) of `<entity>_<yyyy-mm-dd>...`; NULL when the name has no date."""
    # a name may hold eight digits that are no calendar day; such a date is NULL, not an error
    return let(found(name, DATED, 2), lambda day: F.when(day.isNotNull(), F.struct(
        normalize_entity(F.regexp_extract(as_col(name), DATED, 1)).alias("entity"),
        F.try_to_date(day, "yyyy-MM-dd").alias("date"), F.substring(day, 1, 4).cast("int").alias("year"))))


def selected_name(name: Col) -> Column:
    """struct(stem, method, method_rank) of a selected-page file; NULL when it has no dated stem."""
    stem = found(name, STEM, 1)
    suffix = F.lower(F.regexp_extract(as_col(name), STEM, 2))
    rank = let(suffix, lambda s: F.when(s.contains("crop"), 2).when(s.contains("vision") | s.contains("visual"), 3)
               .when(s.contains("compress"), 1).otherwise(0))
    methods = F.array(*[F.lit(m) for m in METHODS])
    return let(F.struct(stem.alias("stem"), rank.alias("r")), lambda p: F.when(p["stem"].isNotNull(), F.struct(
        p["stem"].alias("stem"), F.element_at(methods, p["r"] + 1).alias("method"), p["r"].alias("method_rank"))))


def report_stem(name: Col) -> Column:
    """Report name without `_dsa.json` or `.pdf`."""
    return F.regexp_replace(as_col(name), r"(_dsa\.json|\.pdf)$", "")


def file_stem(name: Col) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(as_col(name), r"\.[^.]*$", "")


def json_name(pdf: Col) -> Column:
    return F.concat(file_stem(pdf), F.lit("_dsa.json"))
