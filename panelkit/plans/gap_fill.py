"""Find gaps, choose their sources, and write the filled panel."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from panelkit.functions.files import json_name
from panelkit.functions.items import CATEGORIES
from panelkit.operators import gaps as G, waterfall as W
from panelkit.operators.tree import flatten_tree, role_value
from panelkit.session import materialise
from panelkit.schema import PANEL_LAYOUT, to_panel, to_pregap, union_layout

FACTS = ["publication_date", "consultation_type", "report_title", "country_report_number"]


class GapCheck:
    """The tables of a gap search, each made when it is first asked for: a caller that needs the reports alone doesn't wait for
    spans and previews."""

    def __init__(self, rows: DataFrame, order: str, full_range: tuple[int, int] | None, panel_countries: DataFrame | None, already: DataFrame | None):
        self._rows, self._order, self._range, self._countries, self._already = rows, order, full_range, panel_countries, already

    @cached_property
    def usage(self) -> DataFrame:
        """What every report can be used for, before any is superseded: all that spans, causes, previews and sources ask for."""
        # one row per report feeds seven consumers: written once to the checkpoint folder, not computed seven times
        return materialise(G.report_table(self._rows, self._order, with_values=True).withColumn("report_status", G.usage_status()))

    @cached_property
    def kept(self) -> DataFrame:
        return materialise(G.kept_observations(self.usage))

    @cached_property
    def reports(self) -> DataFrame:
        return materialise(G.mark_superseded(self.usage, self.kept))

    @cached_property
    def gaps(self) -> DataFrame:
        rep, universe = self.usage, None
        if self._range is not None:
            universe = rep.select("country").filter(F.col("country").isNotNull() & (F.col("country") != G.MULTI_ENTITY))
            if self._countries is not None:
                universe = universe.unionByName(self._countries.select("country"))
            universe = universe.distinct()
        spans = G.span_ids(G.gap_spans(self.kept, "country", "year", self._range, universe), "country")
        spans = G.span_causes(spans, rep).withColumn("gap_span", G.span_label())
        years = materialise(G.gap_years(spans))
        return years.join(G.fill_preview(years, rep, "column_header_audit_json" in self._rows.columns), ["country", "gap_year"], "left")

    @cached_property
    def panel(self) -> DataFrame:
        return G.panel_skeleton(self.kept, self.gaps)

    @cached_property
    def children(self) -> DataFrame:
        return G.children_of_kept(self._rows, self.kept)

    @cached_property
    def to_fill(self) -> DataFrame:
        return G.drop_identified(self.gaps, self._already) if self._already is not None else self.gaps

def find_gaps(rows: DataFrame, order: str, full_range: tuple[int, int] | None = None, panel_countries: DataFrame | None = None,
              already: DataFrame | None = None) -> GapCheck:
    """Long rows -> report usage, kept observations, gap years with causes and preview, panel, children.

    `order` is the row's place in its file; `panel_countries` (country) adds entities without any report.
    """
    return GapCheck(rows, order, full_range, panel_countries, already)


def build_targets(gaps: DataFrame, inventory: DataFrame, documents: DataFrame, selected: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(targets, candidate map, skip list) of the gap years, against the documents that really exist."""
    targets = gaps.select("gap_id", "country", "gap_year", "gap_span", "primary_cause", F.col("fill_status").alias("audit_fill_status"),
                          F.col("preferred_source_report").alias("audit_expected_source_report"))
    skip = W.skip_list(inventory)
    cand = W.candidate_map(targets.select("gap_id", "country", "gap_year"), documents, skip)
    if selected is not None:
        cand = W.flag_cached(cand, selected)
    return W.target_flags(targets, cand), cand, skip


def values_long(resolution: DataFrame, answers: DataFrame) -> DataFrame:
    """Line items of the answers that filled a year. answers: (report, year, decomposition, ...)."""
    hit = resolution.filter("source_report is not null").select("country", F.col("gap_year").alias("year"), "gap_id",
                                                                F.col("source_report").alias("report"))
    a = hit.join(answers, ["report", "year"])
    return flatten_tree(a, "decomposition").withColumn("json_file", json_name("report")) \
        .withColumn("pdf_file_name", F.col("report")).withColumn("table_found", F.lit("TRUE"))


def values_wide(resolution: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per filled year with the six category values."""
    hit = resolution.filter("source_report is not null").select(
        "country", F.col("gap_year").alias("year"), "gap_id", "source_report", "source_offset_years", F.col("final_status").alias("resolution_status"))
    a = hit.join(answers.withColumnRenamed("report", "source_report"), ["source_report", "year"])
    return a.select(*hit.columns, *[role_value("decomposition", c).alias(c) for c in CATEGORIES])


def final_rows(long: DataFrame, run: str) -> DataFrame:
    """Filled line items in the panel layout, stamped as new rows of this gap-fill run."""
    return to_panel(to_pregap(long, "gapfill", run).withColumn("update_origin", F.lit("new")))


def write_ready_panel(base: DataFrame, new: DataFrame, order) -> DataFrame:
    """Pre-gap-fill rows (year = their last actual year) + gap-fill rows with the report facts the panel knows."""
    panel = to_panel(base)
    return union_layout([panel, W.fill_report_facts(new, panel, FACTS, order)], PANEL_LAYOUT)
