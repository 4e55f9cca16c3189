"""Column layouts of the long tables, alignment to a layout, and the layout check."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelkit.functions import items as I
from panelkit.functions import numbers as N
from panelkit.functions.text import blank_to_null, strip

# --- fixed values: the column names and their order are the data format ---------------------------
REPORT_FACTS = [
    "json_file", "pdf_file_name", "country", "publication_date", "consultation_type", "report_title",
    "country_report_number", "table_found", "framework", "table_number", "table_title", "page_pdf", "page_printed",
]
YEAR_AUDIT = [
    "last_actual_year", "actual_column_label", "actual_column_status", "actual_column_header_verbatim",
    "latest_observation_year", "latest_observation_status", "actual_year_label_match",
    "column_header_selected_year", "column_header_selection_reason", "independent_audit_selected_year",
    "independent_audit_selection_reason", "independent_latest_observation_year",
    "independent_latest_observation_status", "actual_column_validation_status",
    "actual_column_validation_issues", "first_selected_year", "audited_selected_year",
    "manual_review_required", "column_header_audit_json", "independent_column_header_audit_json",
]
METHOD = ["confidence", "extraction_method"]
ITEM = ["top_category", "hierarchy_id", "level", "parent_label", "label_verbatim", "value"]
OUTCOME = ["failure_reason", "extraction_notes"]
PROVENANCE = ["source_round", "gapfill_run", "update_origin"]

ROUND_LAYOUT = REPORT_FACTS + YEAR_AUDIT + METHOD + ITEM + OUTCOME                # 43 columns
PREGAP_LAYOUT = ROUND_LAYOUT + PROVENANCE                                         # 46 columns
PANEL_LAYOUT = [("year" if c == "last_actual_year" else c) for c in PREGAP_LAYOUT]
LEGACY_LAYOUT = [                                                                  # 21 columns
    "json_file", "pdf_file_name", "country", "publication_date", "consultation_type", "report_title",
    "country_report_number", "framework", "table_number", "table_title", "page_pdf", "last_actual_year",
    "actual_column_label", "top_category", "hierarchy_id", "level", "parent_label", "label_verbatim", "value",
    "source_round", "gapfill_run",
]
REPORT_LEVEL = REPORT_FACTS + YEAR_AUDIT + METHOD + OUTCOME
# columns describing how a run chose its year: they say nothing about a value a person entered
SELECTION = [
    "actual_column_status", "actual_column_header_verbatim", "latest_observation_year", "latest_observation_status",
    "actual_year_label_match", "column_header_selected_year", "column_header_selection_reason",
    "independent_audit_selected_year", "independent_audit_selection_reason", "independent_latest_observation_year",
    "independent_latest_observation_status", "actual_column_validation_issues", "first_selected_year",
    "audited_selected_year", "independent_column_header_audit_json", "confidence", "failure_reason",
]
SOURCES = ["round1", "round2", "round3", "gapfill"]      # best first
# --------------------------------------------------------------------------------------------------


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly `columns`, in order, all text; what the input lacks becomes NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(c).cast("string") if c in present else F.lit(None).cast("string")).alias(c) for c in columns
    ])


def present_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Only the wanted columns that exist (Catalyst turns this into a pruned scan)."""
    return df.select(*[c for c in wanted if c in df.columns])


def to_pregap(df: DataFrame, source: str | None = None, run: str | None = None) -> DataFrame:
    """Any long table -> pre-gap-fill layout. A `year` column feeds an empty last_actual_year.

    With `source` every row is stamped with it (and with `run` when the source is gapfill); without it
    the rows keep their own provenance.
    """
    out = align(df, PREGAP_LAYOUT + (["year"] if "year" in df.columns else []))
    if "year" in out.columns:
        out = out.withColumn("last_actual_year", F.coalesce(blank_to_null("last_actual_year"), F.col("year"))).drop("year")
    for c in ("level", "page_pdf", "last_actual_year"):
        out = out.withColumn(c, N.int_text(c))
    if source is not None:
        out = out.withColumn("source_round", F.lit(source)) \
                 .withColumn("gapfill_run", F.lit(run if source == "gapfill" else None).cast("string"))
    return out


def to_panel(df: DataFrame) -> DataFrame:
    """Pre-gap-fill or panel rows -> panel layout: year = own year, else last_actual_year."""
    none = F.lit(None).cast("string")
    own = blank_to_null("year") if "year" in df.columns else none
    last = F.col("last_actual_year") if "last_actual_year" in df.columns else none
    return align(df.withColumn("year", N.int_text(F.coalesce(own, last))), PANEL_LAYOUT)


def union_layout(frames: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """UNION ALL of frames in one layout (missing columns become NULL)."""
    columns = columns or PREGAP_LAYOUT
    out = align(frames[0], columns)
    for f in frames[1:]:
        out = out.unionByName(align(f, columns))
    return out


def valid_item_id(c: str | Column) -> Column:
    return F.coalesce(strip(c).rlike(I.ITEM_ID), F.lit(False))


def layout_problems(df: DataFrame, year: str | None = None) -> DataFrame:
    """(problem, n_rows): malformed ids, a category that contradicts the id, repeated line items.

    Two aggregates, no window: the row checks are counted in one pass, duplicates by grouping on the key.
    """
    year = year or ("year" if "year" in df.columns else "last_actual_year")
    bad = ~valid_item_id("hierarchy_id")
    wrong = (~bad) & ~F.col("top_category").eqNullSafe(I.top_category("hierarchy_id"))
    rows = df.agg(F.count_if(bad).alias("bad_hierarchy_id"), F.count_if(wrong).alias("category_mismatch"))
    dup = (df.groupBy("json_file", year, "hierarchy_id").agg(F.count("*").alias("n"))
             .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_rows"))
             .select(F.lit("duplicate_key").alias("problem"), "n_rows"))
    return (rows.select(F.expr("stack(2, 'bad_hierarchy_id', bad_hierarchy_id, 'category_mismatch', category_mismatch)"
                               " as (problem, n_rows)"))
                .unionByName(dup))


def duplicate_items(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def column_problems(df: DataFrame) -> list[str]:
    """Driver-side check of the column list against the two layouts."""
    if df.columns in (PREGAP_LAYOUT, PANEL_LAYOUT):
        return []
    return [f"columns differ from both layouts: {df.columns}"]
