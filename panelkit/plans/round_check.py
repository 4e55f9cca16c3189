"""Compile a run's results to the long table, compare the runs of a round, summarise."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.text import title_case
from panelkit.functions.years import label_agreement
from panelkit.operators import compare
from panelkit.operators.tree import CATEGORIES, tree_rows
from panelkit.schema import ROUND_LAYOUT, to_pregap


def year_audit_fields(source: Column) -> dict[str, Column]:
    """The columns that record how a result chose its year."""
    audit, second = source["column_header_audit"], source["independent_column_header_audit"]
    check = source["actual_column_validation"]
    same = ["last_actual_year", "actual_column_label", "actual_column_status", "actual_column_header_verbatim",
            "latest_observation_year", "latest_observation_status", "independent_latest_observation_year",
            "independent_latest_observation_status"]
    keep_nulls = {"ignoreNullFields": "false"}
    return {
        **{c: source[c] for c in same},
        "actual_year_label_match": label_agreement(source["last_actual_year"], source["actual_column_label"]),
        "column_header_selected_year": audit["selected_year"], "column_header_selection_reason": audit["selection_reason"],
        "independent_audit_selected_year": second["selected_year"], "independent_audit_selection_reason": second["selection_reason"],
        "actual_column_validation_status": check["status"],
        "actual_column_validation_issues": F.to_json(F.coalesce(check["issues"], F.array().cast("array<string>"))),
        "first_selected_year": check["first_selected_year"], "audited_selected_year": check["audited_selected_year"],
        "manual_review_required": F.when(check["status"] == "manual_review", "Yes").otherwise("No"),
        "column_header_audit_json": F.to_json(audit, keep_nulls), "independent_column_header_audit_json": F.to_json(second, keep_nulls),
    }


def compile_results(results: DataFrame) -> DataFrame:
    """Result files -> the 43-column long table: one row per line item, one row for a result without a table.

    Everything is row-local: each file turns into its rows by one explode.
    """
    r, md, src = F.col("result"), F.col("result.report_metadata"), F.col("result.source")
    none = r["table_found"].eqNullSafe(F.lit(False))
    blank = F.array(F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (
        ("top_category", "string"), ("hierarchy_id", "string"), ("level", "int"), ("parent_label", "string"),
        ("label_verbatim", "string"), ("value", "string"))]))

    def either(c: str) -> Column:
        return F.coalesce(F.nullif(md[c], F.lit("")), src[c])
    facts = {
        "json_file": F.col("json_file"), "pdf_file_name": F.coalesce(F.nullif(r["pdf_file_name"], F.lit("")), md["pdf_file_name"]),
        "country": title_case(either("country")), "publication_date": either("publication_date"),
        "consultation_type": either("consultation_type"), "report_title": md["report_title"],
        "country_report_number": md["country_report_number"], "table_found": F.initcap(r["table_found"].cast("string")),
        **{c: src[c] for c in ("framework", "table_number", "table_title", "page_pdf", "page_printed", "confidence")},
        **year_audit_fields(src), "extraction_method": r["extraction_method"],
        "extraction_notes": F.when(none, r["extraction_notes"]), "failure_reason": F.when(none, r["failure_reason"]),
    }
    items = F.when(none, blank).otherwise(tree_rows(r["decomposition"], CATEGORIES))
    out = results.filter("error is null and has_tree").select(*[c.alias(n) for n, c in facts.items()], F.explode(items).alias("__i"))
    return out.select("*", "__i.*").drop("__i").select(*[F.col(c).cast("string").alias(c) for c in ROUND_LAYOUT])


@dataclass
class RoundCheck:
    """Everything a round check writes, as lazy tables."""
    comparison: compare.RunComparison
    summary: DataFrame
    matched: DataFrame
    diffs: DataFrame
    recheck: DataFrame
    counts: DataFrame
    diff_types: DataFrame


def check_round(rows: DataFrame, n_runs: int, errors: DataFrame | None = None, source_run: int = 1, reuse: bool = False,
                reports: DataFrame | None = None, keep: list[str] | None = None) -> RoundCheck:
    """Compare the stacked runs of a round and add the reports that failed in every run. reuse: the comparison is written
    once, with the rows of the source run, for callers that write several of the tables; keep: the columns of matched rows
    that they want (all). reports: as in `compare_runs`."""
    c = compare.compare_runs(rows, n_runs, reuse=reuse, reports=reports, source_run=source_run if reuse else None, keep=keep)
    summary = c.summary
    if errors is not None:
        summary = summary.unionByName(compare.failed_everywhere(errors, c.facts, n_runs))
    return RoundCheck(c, summary, c.source if reuse else compare.matched_rows(rows, c, source_run).select(*(keep or rows.columns)), c.diffs, compare.recheck_list(summary),
                      compare.group_counts(summary), compare.diff_type_counts(c.diffs))


def round_totals(summary: DataFrame, matched: DataFrame, diffs: DataFrame, recheck: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Totals that must agree between the tables of a round, as written or as just made: (check, left, right, ok).

    One aggregate per table, put together as rows of one small table, so that nothing is joined. `items` are the aligned lines
    of the comparison, where they are still at hand. A total that a table leaves null counts as 0.
    """
    group, category = F.col("group"), F.col("category")
    parts = [
        summary.agg(F.count("*").alias("reports"), F.count_distinct("json_file").alias("report_keys"), F.sum("rows_compared").alias("compared"),
                    F.sum("rows_matching").alias("matching"), F.sum("rows_differing").alias("differing"),
                    *[F.count_if(group == g).alias(g) for g in compare.GROUPS]),
        matched.agg(F.count("*").alias("matched_rows")),
        diffs.agg(F.count("*").alias("diff_rows"), F.count("diff_type").alias("typed_diffs")),
        recheck.agg(*[F.count_if(category == c).alias(c) for c in sorted(set(compare.RECHECK.values()))])]
    if items is not None:
        parts.append(items.agg(F.count("*").alias("items")))
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = one.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in one.columns])
    c = {n: F.col(n) for n in one.columns}
    left_over = c["reports"] - c["fully_match"] - c["no_table_in_all_runs"] - c["extraction_failed_in_all_runs"]
    checks = {
        "every report has one row": (c["report_keys"], c["reports"]),
        "the groups hold every report": (reduce(lambda a, b: a + b, [c[g] for g in compare.GROUPS]), c["reports"]),
        "disagreeing reports are listed": (c["category_a_disagreement"], left_over),
        "reports without a table are listed": (c["category_b_no_table_in_all_runs"], c["no_table_in_all_runs"]),
        "matching lines of the reports are the matched rows": (c["matching"], c["matched_rows"]),
        "differing lines of the reports are the differences": (c["differing"], c["diff_rows"]),
        "every compared line matches or differs": (c["compared"], c["matched_rows"] + c["diff_rows"]),
        "every difference has a cause": (c["typed_diffs"], c["diff_rows"]),
    }
    if items is not None:
        checks["every aligned line is compared"] = (c["items"], c["compared"])
    rows = [F.struct(F.lit(n).alias("check"), a.alias("left"), b.alias("right"), (a == b).alias("ok")) for n, (a, b) in checks.items()]
    return one.select(F.inline(F.array(*rows)))


def check_totals(totals: DataFrame) -> None:
    """Refuse a round whose totals disagree, with all that fail (`totals` has a row per check)."""
    failed = [f"{r['check']}: {r['left']} against {r['right']}" for r in totals.filter("not ok").collect()]
    if failed:
        raise ValueError("; ".join(failed))


def round_summary(check: RoundCheck) -> DataFrame:
    """One row of headline numbers, from the reports' own counts of lines."""
    return compare.headline(check.summary)


def ready_rows(matched: DataFrame, summary: DataFrame, source: str) -> DataFrame:
    """Matched rows of the fully matching reports, in the panel's pre-gap-fill layout."""
    full = summary.filter("group = 'fully_match'").select("json_file")
    return to_pregap(matched.join(full, "json_file", "left_semi"), source)
