"""Put the pre-gap-fill panel together from a previous panel, round results and reviewed rows."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelkit.functions import items as I
from panelkit.functions.text import blank_to_null
from panelkit.operators.spread import split_join
from panelkit.schema import PREGAP_LAYOUT, REPORT_LEVEL, ROUND_LAYOUT, SELECTION, align, layout_problems, to_pregap, union_layout


@dataclass
class PanelBuild:
    rows: DataFrame
    problems: DataFrame
    duplicates: DataFrame
    several_sources: DataFrame


def build_panel(base: DataFrame | None, new_parts: list[DataFrame], dropped: DataFrame | None = None, remove_gapfill: bool = True,
                replace: bool = True) -> PanelBuild:
    """Previous rows (without gap fill) + new rows; a report in both is kept from one side only.

    replace=True keeps the new rows of such a report, else the previous ones. Reports dropped in review leave
    both sides. Everything is keyed on json_file by semi and anti joins; each side is joined once, with all that it loses. Without
    new parts the previous rows are only laid out.
    """
    new = union_layout(new_parts) if new_parts else to_pregap(base).limit(0)
    old = to_pregap(base) if base is not None else new.limit(0)
    if remove_gapfill:
        old = old.filter(~F.col("source_round").eqNullSafe(F.lit("gapfill")))
    problems = layout_problems(new)
    # one grouping over the reports of both sides instead of intersecting two distinct lists
    both = (old.select("json_file", F.lit(0).alias("w")).unionByName(new.select("json_file", F.lit(1).alias("w")))
            .groupBy("json_file").agg(F.min("w").alias("lo"), F.max("w").alias("hi")).filter("lo <> hi").select("json_file"))
    gone = [dropped.select("json_file")] if dropped is not None else []

    def without(rows: DataFrame, lists: list[DataFrame]) -> DataFrame:
        return rows.join(reduce(DataFrame.unionByName, lists).distinct(), "json_file", "left_anti") if lists else rows
    other = [(new if replace else old).select("json_file")] if new_parts else []
    old, new = without(old, gone + other if replace else gone), without(new, gone if replace else gone + other)
    several = new.select("json_file", "source_round").distinct().groupBy("json_file").agg(F.count("*").alias("n_sources")).filter("n_sources > 1")
    rows = union_layout([old.withColumn("update_origin", F.lit("previous")), new.withColumn("update_origin", F.lit("new"))])
    return PanelBuild(rows, problems, both, several)


def reviewed_rows(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Rows a person entered, in the pre-gap-fill layout.

    reviews: one row per report (json_file, status, last_actual_year, actual_column_label, page_pdf, note + report
    facts); items: (json_file, hierarchy_id, label_verbatim, value). The parent's label comes from a self join.
    """
    done = reviews.filter("status = 'reviewed'")
    own = [c for c in REPORT_LEVEL if c not in SELECTION and c in done.columns and c not in ("json_file", "last_actual_year", "actual_column_label")]
    note = F.col("note") if "note" in done.columns else F.lit(None).cast("string")
    head = done.select("json_file", "last_actual_year",
                       F.coalesce(blank_to_null("actual_column_label"), F.col("last_actual_year")).alias("actual_column_label"),
                       *[F.col(c) for c in own], note.alias("__note"))
    labels = items.select("json_file", F.col("hierarchy_id").alias("__p"), F.col("label_verbatim").alias("parent_label")) \
        .groupBy("json_file", "__p").agg(F.max("parent_label").alias("parent_label"))
    rows = items.withColumn("__p", I.parent_id("hierarchy_id")).join(labels, ["json_file", "__p"], "left")
    rows = split_join(rows, head, ["json_file"])
    fixed = {"table_found": "True", "extraction_method": "human_review", "actual_column_validation_status": "human_review",
             "manual_review_required": "No"}
    rows = rows.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumns({
        "extraction_notes": F.col("__note"), "top_category": I.top_category("hierarchy_id"),
        "level": I.level("hierarchy_id").cast("string"), "value": F.nullif("value", F.lit(""))})
    return to_pregap(align(rows, ROUND_LAYOUT), "round3")


def as_merged(df: DataFrame) -> DataFrame:
    """Any merged table with a source_round column, also the 21-column one, in the pre-gap-fill layout."""
    if "source_round" not in df.columns:
        raise ValueError("no source_round column: this is not a merged panel")
    return align(to_pregap(df), PREGAP_LAYOUT)
