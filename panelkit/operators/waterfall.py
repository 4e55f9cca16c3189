"""Fill missing periods from later reports: ordered candidates, first acceptable answer wins.

The reference semantics are a loop over candidates. Here the whole cascade is set-based: the first end
point of every target (a resolved answer, or one that stops the search) is a minimum over its candidates.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.text import blank_to_null, found
from panelkit.operators import pick
from panelkit.operators.spread import number_within, split_join

# --- fixed values ----------------------------------------------------------------------------------
OFFSETS = (2, 3, 4)
RESOLVED = ["resolved", "resolved_with_warning"]
STOPS = ["api_error", "not_run"]
RETRY = ["unresolved", "unresolved_no_candidate_reports"]
# ---------------------------------------------------------------------------------------------------
TARGET = ["country", "gap_year"]


def candidate_reports(targets: DataFrame, reports: DataFrame, skip: DataFrame | None = None, offsets=OFFSETS) -> DataFrame:
    """Reports published 2, 3, 4 years after the missing year, as an exploded equi join.

    reports: one row per report with country, pdf_file_name, pub_year, report_date (+ anything else).
    """
    if skip is not None:
        reports = reports.join(skip.select("pdf_file_name").distinct(), "pdf_file_name", "left_anti")
    due = targets.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))) \
                 .withColumn("pub_year", F.col("gap_year") + F.col("offset"))
    return split_join(reports, due, ["country", "pub_year"])


def candidate_map(targets: DataFrame, reports: DataFrame, skip: DataFrame | None = None, offsets=OFFSETS) -> DataFrame:
    """Every target with its ranked candidates; a target without any keeps one row with rank NULL.

    A report's place among the reports of its own (country, publication year) is the same for every target, so
    it is computed once per report; a target adds the number of candidates of the earlier offsets.
    """
    own = [c for c in targets.columns if c not in TARGET]
    base = reports.select("country", "pdf_file_name", "pub_year", "report_date")
    if skip is not None:
        base = base.join(skip.select("pdf_file_name").distinct(), "pdf_file_name", "left_anti")
    placed = number_within(base, ["country", "pub_year"], [F.col("report_date").desc(), F.col("pdf_file_name").desc()], "place")
    per_year = placed.groupBy("country", "pub_year").agg(F.max("place").alias("n"))
    due = targets.select(*TARGET).distinct().withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))) \
        .withColumn("pub_year", F.col("gap_year") + F.col("offset"))
    sizes = due.join(per_year, ["country", "pub_year"])
    # at most one entry per offset and target
    before = sizes.groupBy(*TARGET).agg(F.collect_list(F.struct("offset", "n")).alias("sizes"))
    due = sizes.join(before, TARGET).withColumn("before", F.aggregate(
        F.filter("sizes", lambda s: s["offset"] < F.col("offset")), F.lit(0).cast("long"), lambda a, s: a + s["n"]))
    ranked = split_join(placed, due.select(*TARGET, "pub_year", "offset", "before"), ["country", "pub_year"]).select(
        *TARGET, (F.col("before") + F.col("place")).alias("rank"), F.col("pdf_file_name").alias("candidate_report"),
        F.col("offset").alias("offset_years"), F.col("report_date").alias("publication_date"))
    return targets.join(ranked, TARGET, "left").select(
        *[c for c in targets.columns if c in own], *TARGET, "rank", "candidate_report", "offset_years", "publication_date")


def target_flags(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds has_candidate_report and whether the preview promised a source that is not there."""
    has = candidates.filter("rank is not null").select(*TARGET).distinct().withColumn("__h", F.lit(True))
    out = targets.join(has, TARGET, "left").withColumn("has_candidate_report", F.coalesce("__h", F.lit(False))).drop("__h")
    return out.withColumn("audit_vs_real_candidate_mismatch",
                          F.coalesce(F.col("audit_fill_status") == "fillable_actual_column_visible", F.lit(False))
                          & ~F.col("has_candidate_report"))


def skip_list(inventory: DataFrame) -> DataFrame:
    """Reports that can never be a source, with the reason."""
    reason = F.when(F.col("report_status") == "no_table", "no table found in the report") \
        .when(F.col("report_status") == "excluded_non_country", "multi-country document")
    return inventory.select("pdf_file_name", reason.alias("reason")).filter("reason is not null")


def flag_cached(candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """Adds has_cached_selected_pdf: a selected-page file of the candidate's stem exists."""
    stems = selected.select(F.col("stem").alias("__stem")).distinct().withColumn("__c", F.lit(True))
    c = candidates.withColumn("__stem", F.regexp_replace("candidate_report", r"\.[^.]*$", ""))
    return (c.join(stems, "__stem", "left").withColumn("has_cached_selected_pdf", F.coalesce("__c", F.lit(False)))
            .drop("__stem", "__c"))


def target_statistics(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: gap years, without candidate, preview mismatches, candidates without cached pages."""
    t = targets.agg(F.count("*").alias("n_targets"), F.count_if(~F.col("has_candidate_report")).alias("n_no_candidate"),
                    F.count_if("audit_vs_real_candidate_mismatch").alias("n_mismatch"))
    uncached = F.count_if(~F.col("has_cached_selected_pdf")) if "has_cached_selected_pdf" in candidates.columns else F.lit(0)
    n = candidates.agg(F.count("*").alias("n_rows"), uncached.alias("n_uncached"))
    return t.select("*", n.select("n_rows").scalar().alias("n_candidate_rows"), n.select("n_uncached").scalar().alias("n_uncached"))


def dry_run(candidates: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """One row: distinct first choices, targets without candidate, first choices without cached pages."""
    c = flag_cached(candidates, selected) if selected is not None else candidates.withColumn("has_cached_selected_pdf", F.lit(False))
    first = F.when(F.col("rank") == 1, F.col("candidate_report"))
    # a report is first choice for many targets: one row per report before the distinct counts
    per = c.groupBy(first.alias("r")).agg(F.count_if(F.col("rank").isNull()).alias("none"), F.bool_or("has_cached_selected_pdf").alias("cached"))
    return per.agg(F.count("r").alias("first_wave_reports"), F.sum("none").alias("targets_without_candidate"),
                   F.count_if(F.col("r").isNotNull() & ~F.col("cached")).alias("first_wave_uncached"))


def resolve(candidates: DataFrame, outcomes: DataFrame, errors_are_open: bool = False) -> tuple[DataFrame, DataFrame]:
    """(resolution, attempts) of a ranked candidate map and the answers (report, year, status, ...).

    A missing answer counts as not run. `errors_are_open` treats a stored api_error the same way, as when results
    are rebuilt from saved answers only.
    """
    status = F.when(F.col("status").isin(STOPS), "not_run").otherwise(F.col("status")) if errors_are_open else F.col("status")
    extra = [c for c in ("errors", "warnings") if c in outcomes.columns]
    answers = outcomes.select(F.col("report").alias("candidate_report"), F.col("year").alias("gap_year"),
                              status.alias("status"), *extra)
    tried = candidates.filter("rank is not null").join(answers, ["candidate_report", "gap_year"], "left") \
        .withColumn("status", F.coalesce("status", F.lit("not_run")))
    ends = F.col("status").isin(RESOLVED + STOPS)
    keys = [c for c in candidates.columns if c not in ("rank", "candidate_report", "offset_years", "publication_date",
                                                       "has_cached_selected_pdf")]
    info = F.struct("rank", "status", "candidate_report", "offset_years", *extra)
    per = tried.groupBy(*TARGET).agg(
        F.min_by(info, F.when(ends, F.col("rank"))).alias("end"), F.max_by(info, "rank").alias("last"),
        F.count("*").alias("n_candidates"))
    attempts = (split_join(tried, per.select(*TARGET, F.col("end.rank").alias("__end")), TARGET)
                .filter(F.col("__end").isNull() | (F.col("rank") <= F.col("__end")))
                .select(*keys, F.col("rank").alias("attempt_no"), F.col("candidate_report").alias("report"),
                        F.col("offset_years").alias("offset"), "status", *extra))
    hit = F.col("end.status").isin(RESOLVED)
    tail = F.coalesce(F.col("end"), F.col("last"))
    final = (F.when(F.col("n_candidates").isNull(), "unresolved_no_candidate_reports").when(hit, F.col("end.status"))
             .when(F.col("end").isNotNull(), F.concat(F.lit("pending_"), F.col("end.status"))).otherwise("unresolved"))
    targets = candidates.select(*keys).distinct()
    hit = F.coalesce(hit, F.lit(False))
    resolution = targets.join(per, TARGET, "left").select(
        *keys, final.alias("final_status"), F.when(hit, F.col("end.candidate_report")).alias("source_report"),
        F.when(hit, F.col("end.offset_years")).alias("source_offset_years"),
        F.coalesce("end.rank", "n_candidates", F.lit(0)).alias("n_attempts"),
        F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
        F.when(~hit, tail["status"]).alias("last_failure_status"),
        *([F.when(~hit, tail["errors"]).alias("last_failure_detail")] if "errors" in extra else []),
        *([F.when(hit, F.col("end.warnings")).alias("warnings")] if "warnings" in extra else []))
    return resolution, attempts


def expectation_match(resolution: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds the preview's expectation and whether the report that filled the year is the expected one."""
    t = targets.select(*TARGET, "audit_fill_status", "audit_expected_source_report")
    both = F.col("source_report").isNotNull() & F.col("audit_expected_source_report").isNotNull()
    return resolution.join(t, TARGET, "left").withColumn(
        "source_matches_audit_expectation", F.when(both, F.col("source_report") == F.col("audit_expected_source_report")))


def fill_panel(panel: DataFrame, filled: DataFrame, values: list[str]) -> DataFrame:
    """GAP rows whose year was filled become FILLED with the source and its values; other rows stay as they are."""
    f = filled.select("country", "year", F.col("source_report").alias("__src"), *[F.col(v).alias(f"__{v}") for v in values],
                      F.lit(True).alias("__hit"))
    j = panel.join(f, ["country", "year"], "left")
    hit = (F.col("status") == "GAP") & F.coalesce("__hit", F.lit(False))
    changed = {"status": F.lit("FILLED"), "source_report": F.col("__src"), **{v: F.col(f"__{v}") for v in values}}
    return j.select(*[F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in panel.columns])


def fill_report_facts(rows: DataFrame, panel: DataFrame, facts: list[str], order: str | Column) -> DataFrame:
    """Blank report facts of gap-fill rows are taken from the same report's own rows in the panel."""
    order = F.col(order) if isinstance(order, str) else order
    known = (panel.filter(F.col("report_title").isNotNull()).groupBy("json_file")
             .agg(F.min_by(F.struct(*facts), order).alias("__k")))
    j = split_join(rows, known, ["json_file"], "left")
    return j.select(*[F.coalesce(blank_to_null(c), F.col(f"__k.{c}")).alias(c) if c in facts else F.col(c) for c in rows.columns])


def first_non_empty(frames: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """One row per key: all facts of the first source that knows the key (sources in order of trust)."""
    ranked = [f.select(key, F.lit(i).alias("__s"), *columns) for i, f in enumerate(frames)]
    return pick.smallest(reduce(DataFrame.unionByName, ranked), [key], [F.col("__s"), *[F.col(c) for c in columns]]).drop("__s")


def year_codes(panel: DataFrame, targets: DataFrame, resolution: DataFrame) -> DataFrame:
    """One code per country-year: o observed, g gap, x gap without candidate, f/w filled, u n e open."""
    t = targets.select("country", F.col("gap_year").alias("year"), "has_candidate_report")
    r = resolution.select("country", F.col("gap_year").alias("year"), "final_status")
    by_result = {"resolved": "f", "resolved_with_warning": "w", "unresolved": "u",
                 "unresolved_no_candidate_reports": "n", "pending_api_error": "e"}
    code = F.coalesce(*[F.when(F.col("final_status") == s, F.lit(c)) for s, c in by_result.items()],
                      F.when(F.col("final_status").isNotNull(), F.lit("g")))
    base = F.when(F.col("status") == "observed", "o").when(F.col("status") == "GAP", F.when(~F.col("has_candidate_report"), "x").otherwise("g")).otherwise(".")
    return (panel.select("country", "year", "status").join(t, ["country", "year"], "left").join(r, ["country", "year"], "left")
            .select("country", "year", F.coalesce(code, base).alias("code")))


def code_strings(codes: DataFrame, entity: str = "country", year: str = "year", code: str = "code") -> DataFrame:
    """One string per entity, a character per year in year order (bounded by the calendar)."""
    ordered = F.array_sort(F.collect_list(F.struct(year, code)))
    return codes.groupBy(entity).agg(F.array_join(F.transform(ordered, lambda s: s[code]), "").alias("codes"))


def target_subset(targets: DataFrame, countries: list[str] | None = None, first: int | None = None) -> DataFrame:
    """Only some countries, or the first n targets in (country, year) order (a pilot run)."""
    out = targets.filter(F.col("country").isin(countries)) if countries else targets
    return out.orderBy(*TARGET).limit(first) if first else out


def report_of_file(name: Column) -> Column:
    return found(name, r"^(.*)\.[^.]*$", 1)
