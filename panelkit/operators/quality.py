"""Checks of one extracted answer or report. Every check is a Column: codes first, messages last."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions import items as I
from panelkit.functions.headers import ELIGIBLE, NOT_FINAL, answer_status, explicit_not_final, status_of
from panelkit.functions.items import CATEGORIES
from panelkit.functions.numbers import any_minus_number
from panelkit.functions.text import Col, as_col, blank_to_null, label_key, let, strip
from panelkit.functions.years import leftmost_year_token, parse_year_label
from panelkit.operators.gaps import audit_years
from panelkit.operators.pick import most_common
from panelkit.operators.tree import role_value

TOLERANCE = 0.25
MIN_ROWS_REREAD = 3


def _problem(condition: Column, code: str, message: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(code).alias("code"), message.alias("message")))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def _identity(total: Column, parts: list[Column], tolerance: float) -> tuple[Column, Column]:
    """(fails, sum of the parts); a missing part or total never fails."""
    s = parts[0]
    for p in parts[1:]:
        s = s + p
    return F.coalesce(F.abs(total - s) > tolerance, F.lit(False)), s


def role_values(tree: Col) -> Column:
    """struct of the six categories' own numbers."""
    return F.struct(*[role_value(tree, r).alias(r) for r in CATEGORIES])


def _identity_problems(v: Column, tolerance: float = TOLERANCE) -> Column:
    chg, chg_sum = _identity(v["change_in_debt"], [v["identified_flows"], v["residual"]], tolerance)
    idf, idf_sum = _identity(v["identified_flows"], [v["primary_balance"], v["automatic_debt_dynamics"],
                                                     v["other_identified_flows"]], 1.5 * tolerance)
    return F.array_compact(F.array(
        _problem(chg, "identity_change", _text("identity change_in_debt = identified_flows + residual fails: ",
                                               v["change_in_debt"], " vs ", F.round(chg_sum, 3))),
        _problem(idf, "identity_flows", _text("identity identified_flows = primary + automatic + other fails: ",
                                              v["identified_flows"], " vs ", F.round(idf_sum, 3)))))


def identity_problems(tree: Col, tolerance: float = TOLERANCE) -> Column:
    """array<struct(code, message)> of the two accounting identities."""
    return let(role_values(tree), lambda v: _identity_problems(v, tolerance))


def validate_target(target: Col, audit_columns: Col) -> Column:
    """struct(status, errors, warnings) of one answer for one target year.

    resolved when nothing is wrong; needs_independent_audit when only the answer's own column audit is missing
    or disagrees; otherwise rejected. An answer that is not extractable gets the status of its reason.
    """
    t = as_col(target)
    header = F.concat_ws(" ", F.coalesce(t["column_header_verbatim"], F.lit("")), F.coalesce(t["matched_year_label"], F.lit("")))

    def singles(cols: Column) -> Column:
        year = t["target_year"]
        return F.struct(F.filter(cols, lambda c: (c["kind"] == "single") & (c["y0"] == year)).alias("mine"),
                        F.filter(cols, lambda c: (c["kind"] == "single") & (c["y0"] < year) & c["status"].isin(NOT_FINAL)).alias("earlier"))
    # every fact is worked out once; the checks below only look at the facts
    facts = F.struct(
        t["target_year"].alias("year"), status_of(t["column_status"]).alias("status"), t["matched_year_label"].alias("label"),
        parse_year_label(t["matched_year_label"]).alias("parsed"), F.trim(header).alias("header"), explicit_not_final(header).alias("explicit"),
        let(audit_years(as_col(audit_columns)), singles).alias("audit"), role_values(t["decomposition"]).alias("values"))

    def verdict(f: Column) -> Column:
        year, status, mine, earlier = f["year"], f["status"], f["audit"]["mine"], f["audit"]["earlier"]
        mine_status, first = F.get(mine, F.lit(0))["status"], F.get(earlier, F.lit(0))
        one, eligible = F.size(mine) == 1, status.isin(ELIGIBLE)
        some_value = F.coalesce(*[f["values"][c] for c in CATEGORIES]).isNotNull()
        errors = F.array_compact(F.array(
            _problem(~eligible, "status", _text("column_status is '", F.when(status == "", "missing").otherwise(status), "', not actual/historical")),
            _problem(~((f["parsed"]["kind"] == "single") & f["parsed"]["y0"].eqNullSafe(year)), "label",
                     _text("matched_year_label '", f["label"], "' is not target year ", year)),
            _problem(f["explicit"].isNotNull(), "header_text", _text("header text is explicitly ", f["explicit"], ": ", f["header"])),
            _problem(~one, "audit_missing", _text("column audit lists ", F.size(mine), " single-year columns for ", year)),
            _problem(one & ~mine_status.isin(ELIGIBLE), "audit_status", _text("column audit says ", year, " is '", mine_status, "'")),
            _problem(F.size(earlier) > 0, "monotonic",
                     _text("year ", year, " is called actual but an earlier column (", first["label"], ") is ", first["status"])),
            _problem(~some_value, "no_values", F.lit("no numeric value found in any of the six decomposition roles"))))
        differs = F.coalesce(one & mine_status.isin(ELIGIBLE) & eligible & (mine_status != status), F.lit(False))
        warnings = F.concat(
            F.array_compact(F.array(F.when(differs, _text("column_status '", status, "' differs from audit status '", mine_status, "' (both eligible)")))),
            F.when(some_value, F.transform(_identity_problems(f["values"]), lambda p: p["message"])).otherwise(F.array().cast("array<string>")))

        def ranked(e: Column) -> Column:
            audit_only = F.forall(e, lambda x: x["code"].isin("audit_missing", "audit_status")) & eligible
            return F.struct(F.when(F.size(e) == 0, "resolved").when(audit_only, "needs_independent_audit").otherwise("rejected_not_actual").alias("status"),
                            e.alias("errors"), warnings.alias("warnings"))
        return let(errors, ranked)
    refused = F.struct(answer_status(t["not_extractable_reason"]).alias("status"),
                       F.array().cast("array<struct<code:string,message:string>>").alias("errors"), F.array().cast("array<string>").alias("warnings"))
    return F.when(F.coalesce(t["extractable"], F.lit(False)), let(facts, verdict)).otherwise(refused)


def audit_confirms(audit_columns: Col, year: Col) -> Column:
    """struct(confirmed, reason): is the year one single, actual or historical column of a second reading?"""
    year = as_col(year)

    def facts(cols: Column) -> Column:
        mine = F.filter(cols, lambda c: (c["kind"] == "single") & (c["y0"] == year))
        earlier = F.exists(cols, lambda c: (c["kind"] == "single") & F.coalesce(c["y0"] < year, F.lit(False)) & c["status"].isin(NOT_FINAL))
        return F.struct(F.size(mine).alias("n"), F.get(mine, F.lit(0))["status"].alias("status"), earlier.alias("earlier"))

    def verdict(f: Column) -> Column:
        ok = F.coalesce(f["status"].isin(ELIGIBLE), F.lit(False))
        reason = (F.when(f["n"] != 1, _text("independent audit lists ", f["n"], " single-year columns for ", year))
                  .when(~ok, _text("independent audit says ", year, " is '", f["status"], "'"))
                  .when(f["earlier"], F.lit("independent audit shows an earlier year that is estimate/projection"))
                  .otherwise(_text("independent audit confirms ", year, " as ", f["status"])))
        return F.struct(((f["n"] == 1) & ok & ~f["earlier"]).alias("confirmed"), reason.alias("reason"))
    return let(audit_years(as_col(audit_columns)), lambda cols: let(facts(cols), verdict))


# ---- self-check of a chosen column, and the second reading --------------------------------------------

def _selected(columns: Column) -> Column:
    """The one selected column of an audit, NULL when there is none or more than one."""
    sel = F.filter(columns, lambda c: F.coalesce(c["selected"], F.lit(False)))
    return F.when(F.size(sel) == 1, F.get(sel, F.lit(0)))


def selection_problems(source: Col, check_later: bool = True, token=leftmost_year_token) -> Column:
    """array<struct(code, message)>: does the chosen year agree with its label, its header and its own audit?

    check_later also looks for an eligible column further right. `token` reads a year out of a text.
    """
    s = as_col(source)
    audit = s["column_header_audit"]
    header = F.lower(F.concat_ws(" ", F.coalesce(s["actual_column_label"], F.lit("")),
                                 F.coalesce(s["actual_column_header_verbatim"], F.lit(""))))
    facts = F.struct(token(s["last_actual_year"]).alias("year"), token(s["actual_column_label"]).alias("label"),
                     s["actual_column_status"].alias("status"), explicit_not_final(header).alias("explicit"),
                     _selected(audit["columns"]).alias("chosen"), token(audit["selected_year"]).alias("selected"), audit["columns"].alias("columns"))

    def check(f: Column) -> Column:
        year, chosen, has = f["year"], f["chosen"], f["chosen"].isNotNull()
        audit_year = token(chosen["year_label"])
        problems = [
            _problem(year.isNull(), "no_year", F.lit("last_actual_year is missing or has no recognizable year")),
            _problem(f["label"].isNull(), "no_label", F.lit("actual_column_label is missing or has no recognizable year")),
            _problem(year != f["label"], "year_label", _text("last_actual_year ", year, " differs from actual_column_label ", f["label"])),
            _problem(~status_of(f["status"]).isin(ELIGIBLE), "status", _text(
                "actual_column_status is not eligible: ", F.coalesce(f["status"], F.lit("missing")))),
            _problem(f["explicit"].isNotNull(), "header_text", _text("selected header is explicitly ", f["explicit"])),
            _problem(~has, "not_one_selected", F.lit("column_header_audit must contain exactly one selected column")),
            _problem(has & ~status_of(chosen["status"]).isin(ELIGIBLE), "audit_status", _text(
                "selected audit column has ineligible status: ", F.coalesce(chosen["status"], F.lit("missing")))),
            _problem(has & (audit_year != year), "audit_year", _text("column_header_audit selects ", audit_year, ", last_actual_year is ", year)),
            _problem(has & (f["selected"] != year), "selected_year",
                     _text("column_header_audit selects ", f["selected"], ", last_actual_year is ", year)),
        ]
        if check_later:
            at = chosen["position"].try_cast("double")
            later = F.filter(f["columns"], lambda c: (F.coalesce(c["position"].try_cast("double"), F.lit(0.0)) > at)
                             & status_of(c["status"]).isin(ELIGIBLE))
            problems.append(_problem(has & (F.size(later) > 0), "later_column", _text(
                "column_header_audit lists later eligible column(s) not selected: ",
                F.array_join(F.transform(later, lambda c: c["year_label"]), ", "))))
        return F.array_compact(F.array(*problems))
    return let(facts, check)


def reconcile(first_year: Col, problems: Col, audit_columns: Col, checked: Col) -> Column:
    """struct(status, code, audited_year) of a first reading against an independent header audit.

    checked = the second reading took place. accepted, accepted_with_warning or manual_review.
    """
    first, ok = as_col(first_year), as_col(checked)
    facts = let(_selected(as_col(audit_columns)), lambda c: F.struct(
        F.size(as_col(problems)).alias("n"), leftmost_year_token(c["year_label"]).alias("audited"), status_of(c["status"]).alias("status")))
    return let(facts, lambda f: _reconciled(first, f["n"], f["audited"], f["status"], ok))


def _reconciled(first: Column, n: Column, audited: Column, status: Column, ok: Column) -> Column:
    confirmed = F.coalesce((audited == first) & status.isin(ELIGIBLE), F.lit(False))
    verdict = (F.when(~ok, F.when(n > 0, "manual_review").otherwise("accepted"))
               .when(confirmed, F.when(n > 0, "accepted_with_warning").otherwise("accepted")).otherwise("manual_review"))
    code = (F.when(~ok & (n > 0), "verification_not_completed").when(confirmed & ok & (n > 0), "same_year_confirmed")
            .when(ok & ~confirmed, F.when(first.isNotNull() & audited.isNotNull(), "other_year_selected")
                  .when(audited.isNull(), "no_eligible_year").otherwise("no_usable_first_year")))
    return F.struct(verdict.alias("status"), code.alias("code"), F.when(ok, audited).alias("audited_year"))


def numeric_reread(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Per report: rows of the second reading found in the first (equal label keys) and how many differ.

    first, second: (key, label_verbatim, value). A label that occurs twice in the first reading keeps its last
    value, so `first` may carry an `ord` column.
    """
    named = first.filter(F.coalesce("label_verbatim", F.lit("")) != "").withColumn("__l", label_key("label_verbatim"))
    order = F.col("ord") if "ord" in first.columns else F.col("value")
    a = named.groupBy(key, "__l").agg(F.max_by(F.struct(F.col("value").alias("first_value")), order).alias("a"))
    b = second.withColumn("__l", label_key("label_verbatim"))
    return b.join(a, [key, "__l"]).groupBy(key).agg(
        F.count("*").alias("rows_compared"), F.count_if(~F.col("a.first_value").eqNullSafe(F.col("value"))).alias("disagreements"))


def numeric_status(n_values: Col, checked: Col, year_confirmed: Col, compared: Col, disagreements: Col,
                   least: int = MIN_ROWS_REREAD) -> Column:
    passed = as_col(year_confirmed) & (F.coalesce(as_col(disagreements), F.lit(0)) == 0) & (F.coalesce(as_col(compared), F.lit(0)) >= least)
    return (F.when(as_col(n_values) < least, "manual_review").when(~as_col(checked), "not_completed")
            .when(F.coalesce(passed, F.lit(False)), "passed").otherwise("manual_review"))


# ---- rows a person entered ----------------------------------------------------------------------------

def review_problems(reviews: DataFrame, rows: DataFrame, key: str = "json_file") -> DataFrame:
    """One row per problem (key, code, hierarchy_id) of reviewed reports.

    reviews: (key, status, last_actual_year); rows: (key, hierarchy_id, label_verbatim, value). Entirely blank
    rows are ignored. Parents are looked up by an anti join, duplicates by grouping.
    """
    done = reviews.filter("status = 'reviewed'").select(key, "last_actual_year")
    r = (rows.join(done.select(key), key, "left_semi")
         .select(key, F.coalesce(strip("hierarchy_id"), F.lit("")).alias("hierarchy_id"),
                 F.coalesce(strip("label_verbatim"), F.lit("")).alias("label"), F.coalesce(strip("value"), F.lit("")).alias("value"))
         .filter("hierarchy_id <> '' or label <> '' or value <> ''"))
    valid = r.filter(F.col("hierarchy_id").rlike(I.ITEM_ID))

    def out(df: DataFrame, code: str, hid: str | None = "hierarchy_id") -> DataFrame:
        return df.select(key, F.lit(code).alias("code"), (F.col(hid) if hid else F.lit(None).cast("string")).alias("hierarchy_id"))

    parents = valid.select(key, "hierarchy_id", I.parent_id("hierarchy_id").alias("__p")).filter("__p is not null")
    ids = valid.select(key, F.col("hierarchy_id").alias("__p")).distinct()
    return (out(done.filter(blank_to_null("last_actual_year").isNull()), "no_year", None)
            .unionByName(out(r.filter(~F.col("hierarchy_id").rlike(I.ITEM_ID)), "bad_id"))
            .unionByName(out(valid.groupBy(key, "hierarchy_id").agg(F.count("*").alias("n")).filter("n > 1"), "duplicate_id"))
            .unionByName(out(valid.filter((F.col("value") != "") & any_minus_number("value").isNull()), "not_a_number"))
            .unionByName(out(parents.join(ids, [key, "__p"], "left_anti"), "no_parent"))
            .unionByName(out(done.join(valid.select(key).distinct(), key, "left_anti"), "no_rows", None)))


def review_queue(summary: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every report that did not fully match, with its review status (todo when there is none)."""
    todo = summary.filter("group <> 'fully_match'").select("json_file", "pdf_file_name", "country", "group", "rows_differing")
    return todo.join(reviews.select("json_file", F.col("status").alias("__s")), "json_file", "left") \
        .withColumn("status", F.coalesce("__s", F.lit("todo"))).drop("__s")


def queue_counts(queue: DataFrame) -> DataFrame:
    """(status, n) for todo and every review status, also those that do not occur."""
    states = ["todo", "reviewed", "no_table", "skipped", "dropped"]
    agg = queue.agg(*[F.count_if(F.col("status") == s).alias(s) for s in states])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in states])).alias("r")).select("r.*")


def template_items(rows: DataFrame, share: float = 0.3) -> DataFrame:
    """Line items found in at least `share` of the reports, with their most common label."""
    per = rows.groupBy("hierarchy_id", "json_file").agg(F.lit(1).alias("one"))
    n = per.select("json_file").distinct().agg(F.count("*").alias("n")).scalar()
    keep = per.groupBy("hierarchy_id").agg(F.count("*").alias("n_reports")).filter(F.col("n_reports") >= share * n)
    return keep.join(most_common(rows, ["hierarchy_id"], "label_verbatim", "label"), "hierarchy_id", "left") \
        .select("hierarchy_id", "n_reports", F.coalesce("label", F.lit("")).alias("label"))


def run_outcomes(outcomes: DataFrame) -> DataFrame:
    """(measure, item, n): totals, reasons for no table, methods, manual review, average seconds."""
    ok, found = F.col("status") == "ok", F.coalesce(F.col("table_found"), F.lit(False))
    total = outcomes.agg(
        F.count("*").alias("reports_processed"), F.count_if(ok & found).alias("tables_extracted"),
        F.count_if(ok & ~found).alias("no_table_found"), F.count_if(~ok).alias("failures"),
        F.count_if(ok & (F.col("validation_status") == "manual_review")).alias("manual_review"),
        F.round(F.avg("seconds"), 2).alias("average_seconds"))
    names = total.columns
    rows = total.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.lit(None).cast("string").alias("item"),
                                                     F.col(c).cast("double").alias("n")) for c in names])).alias("r")).select("r.*")

    def by(cond: Column, measure: str, item: Column) -> DataFrame:
        return outcomes.filter(cond).groupBy(item.alias("item")).agg(F.count("*").cast("double").alias("n")) \
            .select(F.lit(measure).alias("measure"), "item", "n")
    return rows.unionByName(by(ok & ~found, "no_table_reason", F.coalesce("failure_reason", F.lit("other")))) \
               .unionByName(by(ok, "method", F.col("extraction_method")))

