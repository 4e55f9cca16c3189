"""Missing periods of an entity: report usage, gap spans, causes, fill preview, panel, streaks.

The work per entity is brought to a calendar grain before entities meet: at most one row per (entity, year)
or (entity, date). Spans come from one sorted array of years per entity, which is bounded by the calendar.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from panelkit.functions.files import DATED, report_date
from panelkit.functions.headers import ELIGIBLE
from panelkit.functions.items import CATEGORIES
from panelkit.functions.names import normalize_entity
from panelkit.functions.numbers import comma_number
from panelkit.functions.text import Col, as_col, found
from panelkit.functions.years import effective_label, parse_year_label
from panelkit.operators import pick
from panelkit.operators.measures import Measure, set_counts
from panelkit.operators.spread import number_rows, running_totals, split_join
from panelkit.operators.waterfall import OFFSETS
from panelkit.session import materialise

MULTI_ENTITY = "Multi-Country Report"
MAX_LAG = 4
#: What a report's lines say of the report.
REPORT_FACTS = ["pdf_file_name", "table_found", "manual_review_required", "actual_column_validation_status", "source_round",
                "confidence", "framework", "column_header_audit_json"]

AUDIT_COLUMNS = T.ArrayType(T.StructType([
    T.StructField("position", T.StringType()), T.StructField("year_label", T.StringType()),
    T.StructField("group_label", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("status_basis", T.StringType()), T.StructField("selected", T.BooleanType())]))
AUDIT = T.StructType([T.StructField("columns", AUDIT_COLUMNS), T.StructField("selected_year", T.StringType()),
                      T.StructField("selection_reason", T.StringType())])


def audit_cell(c: Column) -> Column:
    """struct(kind, y0, y1, label, status, header) of one audited column."""
    y = parse_year_label(c["year_label"])
    return F.struct(y["kind"].alias("kind"), y["y0"].alias("y0"), y["y1"].alias("y1"), c["year_label"].alias("label"),
                    F.lower(F.trim(F.coalesce(F.nullif(c["status"], F.lit("")), F.lit("unknown")))).alias("status"),
                    c["group_label"].alias("header"))


def audit_years(columns: Column) -> Column:
    """array<struct(kind, y0, y1, label, status, header)> of an audited column list; never NULL."""
    kept = F.filter(columns, lambda c: c.isNotNull())
    return F.coalesce(F.transform(kept, audit_cell), F.array().cast(
        "array<struct<kind:string,y0:int,y1:int,label:string,status:string,header:string>>"))


def audit_from_json(c: Col) -> Column:
    return audit_years(F.from_json(as_col(c), AUDIT)["columns"])


# ---- one row per (report, year label) ----------------------------------------------------------------

def _is_top() -> Column:
    return F.col("level").cast("string").isin("0", "0.0") & F.col("top_category").isin(CATEGORIES)


def report_table(rows: DataFrame, order: str, with_values: bool = False) -> DataFrame:
    """Long rows -> one row per (json_file, effective year label) with the facts the gap work needs.

    Columns a slim file lacks get their default: table found, year certain, no audit. with_values adds the six
    category values in the same aggregate.
    """
    have = set(rows.columns)

    def text(c: str, default: str | None = None) -> Column:
        return F.col(c) if c in have else F.lit(default).cast("string")

    keys = ["json_file", "year_label"]
    tops = {c: F.col("top_category") == c for c in CATEGORIES} if with_values else {}
    base = rows.withColumn("__v", F.when(_is_top(), comma_number("value"))) if with_values else rows
    # the lines of a report agree in its facts, so they meet by them first, in hash tables of numbers alone: labels are read
    # and whole facts are sorted once per report, not once per line
    told = [c for c in dict.fromkeys(["json_file", "last_actual_year", "year", *REPORT_FACTS]) if c in have]
    place = {c: F.when(mine & F.col("__v").isNotNull(), F.col(order)) for c, mine in tops.items()}
    once = base.groupBy(*told).agg(F.min(order).alias("__at"), *[F.min_by("__v", p).alias(c) for c, p in place.items()],
                                   *[F.min(p).alias(f"__at_{c}") for c, p in place.items()])
    facts = once.withColumn("year_label", effective_label(rows.columns, year_first=False)).groupBy(*keys).agg(F.min_by(F.struct(
        F.col("pdf_file_name"), text("table_found", "TRUE").alias("table_found"),
        text("manual_review_required", "").alias("manual_review_required"),
        text("actual_column_validation_status", "").alias("actual_column_validation_status"),
        text("source_round").alias("source_round"), text("confidence").alias("confidence"),
        text("framework").alias("framework"), text("column_header_audit_json").alias("column_header_audit_json")), "__at").alias("f"),
        *[F.min_by(c, f"__at_{c}").alias(c) for c in tops])
    r = facts.select(*keys, "f.*", *tops).withColumns({"report_date": report_date("pdf_file_name"), "named": found("pdf_file_name", DATED, 1)}) \
        .withColumn("y", parse_year_label("year_label"))
    return r.select(
        *keys, "pdf_file_name", normalize_entity("named").alias("country"), "report_date", F.col("y.kind").alias("year_kind"), F.col("y.y0").alias("obs_year"),
        F.col("y.note").alias("year_parse_note"),
        (F.upper(F.coalesce("table_found", F.lit("TRUE"))) == "TRUE").alias("table_found"),
        F.coalesce((F.col("manual_review_required") == "Yes") | (F.col("actual_column_validation_status") == "manual_review"),
                   F.lit(False)).alias("year_uncertain"),
        F.coalesce(F.col("y.y0") > F.year("report_date"), F.lit(False)).alias("year_after_report_year"),
        "source_round", "confidence", "framework", "column_header_audit_json", *tops)


def top_values(rows: DataFrame, order: str) -> DataFrame:
    """(json_file, year label) x the six category values: first value of each top line item."""
    return (rows.filter(_is_top()).withColumn("year_label", effective_label(rows.columns, year_first=False))
            .withColumn("v", comma_number("value")).groupBy("json_file", "year_label")
            .pivot("top_category", CATEGORIES).agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.col(order)))))


def usage_status(max_lag: int = MAX_LAG) -> Column:
    """What a report can be used for; gap-fill rows may lag as far as they like, never be early."""
    lag = F.year("report_date") - F.col("obs_year")
    from_gapfill = F.lower(F.trim(F.coalesce("source_round", F.lit("")))) == "gapfill"
    return (F.when(F.col("country") == MULTI_ENTITY, "excluded_non_country")
            .when(~F.col("table_found"), "no_table")
            .when(F.col("year_kind") != "single", "table_but_year_unusable")
            .when((lag < 0) | (~from_gapfill & (lag >= max_lag)), "year_implausible_vs_report_date")
            .otherwise("observation"))


def kept_observations(reports: DataFrame, values: list[str] = CATEGORIES, tolerance: float = 1e-6) -> DataFrame:
    """The latest report per (entity, year) with its values, how many reports there were, and whether they agree.

    The agreement of all others with the kept one needs no join: the category is blank everywhere, or present
    everywhere and both extremes lie within the tolerance of the kept value.
    """
    obs = reports.filter("report_status = 'observation'")
    newest = F.struct("report_date", "pdf_file_name", "json_file", "year_label")
    kept = F.struct("json_file", "year_label", "pdf_file_name", "report_date", "year_uncertain", "year_parse_note",
                    "framework", *values)
    g = obs.groupBy("country", "obs_year").agg(
        F.count("*").alias("n_reports"), F.max_by(kept, newest).alias("k"),
        *[F.struct(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).alias(f"s_{v}") for v in values])
    agree = F.lit(True)
    for v in values:
        s, k = F.col(f"s_{v}"), F.col(f"k.{v}")
        near = (s["n"] == F.col("n_reports")) & (s["hi"] - k < tolerance) & (k - s["lo"] < tolerance)
        agree = agree & ((s["n"] == 0) | F.coalesce(near, F.lit(False)))
    return g.select("country", F.col("obs_year").alias("year"), "k.*", "n_reports",
                    F.when(F.col("n_reports") > 1, F.when(agree, "Yes").otherwise("No")).alias("values_agree"))


def mark_superseded(reports: DataFrame, kept: DataFrame) -> DataFrame:
    """report_status of observations that lost against a later report of the same entity and year."""
    k = kept.select("country", F.col("year").alias("obs_year"), F.struct("json_file", "year_label").alias("__k"))
    obs = reports.filter("report_status = 'observation'")
    rest = reports.filter("report_status <> 'observation'")
    lost = F.col("__k") != F.struct("json_file", "year_label")
    marked = split_join(obs, k, ["country", "obs_year"]).withColumn(
        "report_status", F.when(lost, "observation_superseded_by_later_report").otherwise(F.col("report_status"))).drop("__k")
    return marked.select(*reports.columns).unionByName(rest)


# ---- gap years and spans -----------------------------------------------------------------------------

def observed_years(df: DataFrame, entity: str, year: str) -> DataFrame:
    """One sorted array of distinct years per entity (bounded by the calendar, merged on the map side)."""
    return df.groupBy(entity).agg(F.array_sort(F.collect_set(year)).alias("ys"))


def gap_spans(df: DataFrame, entity: str, year: str, full_range: tuple[int, int] | None = None,
              universe: DataFrame | None = None) -> DataFrame:
    """(entity, span_start, span_end, span_length, prev_year, next_year) of consecutive missing years.

    Without `full_range` only years between an entity's own first and last observation can be missing. With it
    every missing year of the range counts, also for entities of `universe` that were never observed.
    """
    if full_range is not None and universe is not None:
        df = df.select(entity, year).unionByName(universe.select(entity, F.lit(None).cast("int").alias(year)))
    ys = observed_years(df, entity, year)
    if full_range is None:
        anchors = F.col("ys")
    else:
        lo, hi = full_range
        inside = F.filter("ys", lambda y: (y >= lo) & (y <= hi))
        anchors = F.array_sort(F.concat(F.array(F.lit(lo - 1), F.lit(hi + 1)), inside))
    spans = F.transform(F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(0))),
                        lambda y, i: F.struct((F.get("a", i) + 1).alias("span_start"), (y - 1).alias("span_end")))
    out = (ys.withColumn("a", anchors).filter(F.size("a") >= 2)
           .withColumn("s", F.explode(F.filter(spans, lambda s: s["span_start"] <= s["span_end"]))))
    start, end = F.col("s.span_start"), F.col("s.span_end")
    return out.select(
        entity, start.cast("int").alias("span_start"), end.cast("int").alias("span_end"),
        (end - start + 1).cast("int").alias("span_length"),
        F.array_max(F.filter("ys", lambda y: y < start)).cast("int").alias("prev_year"),
        F.array_min(F.filter("ys", lambda y: y > end)).cast("int").alias("next_year"))


def gap_years(spans: DataFrame, year: str = "gap_year") -> DataFrame:
    """One row per missing year of every span."""
    return spans.withColumn(year, F.explode(F.sequence("span_start", "span_end")))


def span_ids(spans: DataFrame, entity: str) -> DataFrame:
    """Adds gap_id: G0001, G0002, ... in (entity, start) order, numbered without a single-task sort."""
    return (number_rows(spans, [entity, "span_start"], "__no")
            .withColumn("gap_id", F.concat(F.lit("G"), F.when(F.col("__no") < 10000, F.lpad(F.col("__no").cast("string"), 4, "0"))
                                           .otherwise(F.col("__no").cast("string")))).drop("__no"))


def span_label(start: str = "span_start", end: str = "span_end") -> Column:
    return F.when(F.col(start) == F.col(end), F.col(start).cast("string")).otherwise(
        F.concat_ws("-", F.col(start).cast("string"), F.col(end).cast("string")))


def sums_between(spans: DataFrame, days: DataFrame, sums: list[str]) -> DataFrame:
    """(country, span_start) with, for each column of `sums`, two running totals over the days (country, report_date, sums) of
    all countries: c_from up to the span's prev_date and c_to before its next_date; open where null. Their difference is the sum
    over the days strictly between; where no day can lie between, it may be below 0.

    Spans and days are laid in one order, in which a date that closes a span comes before the day itself and one that opens
    it after; rows are as many as spans and days, whatever lies inside a span.
    """
    nothing = [F.lit(0).cast("long").alias(c) for c in sums]
    date_type = days.schema["report_date"].dataType

    def side(name: str, date: str, open_: int, rank: int) -> Column:
        return F.struct(F.lit(name).alias("side"), F.when(F.col(date).isNull(), open_).otherwise(0).alias("beyond"), F.col(date).cast(date_type).alias("report_date"), F.lit(rank).alias("rank"))
    asked = spans.select("country", "span_start", F.explode(F.array(side("from", "prev_date", -1, 2), side("to", "next_date", 1, 0))).alias("s")) \
        .select("country", "span_start", "s.*", *nothing)
    given = days.select("country", F.lit(None).cast(spans.schema["span_start"].dataType).alias("span_start"), F.lit(None).cast("string").alias("side"),
                        F.lit(0).alias("beyond"), "report_date", F.lit(1).alias("rank"), *[F.col(c).cast("long").alias(c) for c in sums])
    total = running_totals(given.unionByName(asked), ["country", "beyond", "report_date", "rank"], sums)
    return total.filter("side is not null").groupBy("country", "span_start").agg(
        *[F.max(F.when(F.col("side") == end, F.col(c))).alias(f"{c}_{end}") for c in sums for end in ("from", "to")])


def span_causes(spans: DataFrame, reports: DataFrame) -> DataFrame:
    """Adds the bounding reports, months between them, reports in between, and every cause in order.

    `reports` carries report_status after mark_superseded. Reports in between are counted per (entity, date)
    first, so an entity with very many reports still contributes at most one row per day.
    """
    obs = reports.filter("report_status in ('observation', 'observation_superseded_by_later_report')")
    facts = F.struct("pdf_file_name", "report_date", "year_uncertain")
    order = F.struct("report_date", "pdf_file_name", "json_file")
    bounds = obs.groupBy("country", F.col("obs_year").alias("year")).agg(
        F.max_by(facts, order).alias("latest"), F.min_by(facts, order).alias("earliest"))
    s = (spans.join(bounds.select("country", F.col("year").alias("prev_year"), F.col("latest").alias("prev")),
                    ["country", "prev_year"], "left")
         .join(bounds.select("country", F.col("year").alias("next_year"), F.col("earliest").alias("next")),
               ["country", "next_year"], "left"))
    per_day = reports.filter("report_date is not null and country is not null").groupBy("country", "report_date").agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("table_found") & (F.col("report_status") != "excluded_non_country")).alias("n_no_table"),
        F.count_if(F.col("report_status") == "table_but_year_unusable").alias("n_unusable"))
    # a bounding report without a date has nothing after or before it
    dated = (F.col("prev").isNull() | F.col("prev.report_date").isNotNull()) & (F.col("next").isNull() | F.col("next.report_date").isNotNull())
    bounded = s.filter((F.col("prev").isNotNull() | F.col("next").isNotNull()) & dated).select(
        "country", "span_start", F.col("prev.report_date").alias("prev_date"), F.col("next.report_date").alias("next_date"))
    sums = ["n", "n_no_table", "n_unusable"]
    between = sums_between(bounded, per_day, sums).select("country", "span_start", *[F.greatest(F.col(f"{c}_to") - F.col(f"{c}_from"), F.lit(0)).alias(c) for c in sums])
    s = s.join(between, ["country", "span_start"], "left")
    n, no_table, unusable = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "n_no_table", "n_unusable"))
    has_prev, has_next = F.col("prev").isNotNull(), F.col("next").isNotNull()
    never = F.col("prev_year").isNull() & F.col("next_year").isNull()
    both = has_prev & has_next
    causes = F.array_compact(F.array(
        F.when(never, "no_observation_in_panel").when(~has_prev, "before_first_observed_year"),
        F.when(~never & ~has_next, "after_last_observed_year"),
        F.when(both & (no_table > 0), "no_table_report_in_between"),
        F.when(both & (unusable > 0), "unusable_year_report_in_between"),
        F.when(both & (n == 0), "lag_between_consecutive_reports")))
    causes = F.when(F.size(causes) == 0, F.array(F.lit("other_reports_in_between"))).otherwise(causes)
    return (s.withColumn("causes", causes)
            .withColumn("n_reports_in_between", n)
            .withColumn("months_between_bounding_reports",
                        F.round(F.datediff("next.report_date", "prev.report_date") / 30.44, 1))
            .withColumn("prev_report", F.col("prev.pdf_file_name")).withColumn("next_report", F.col("next.pdf_file_name"))
            .withColumn("boundary_year_uncertain", F.coalesce(F.col("prev.year_uncertain"), F.lit(False))
                        | F.coalesce(F.col("next.year_uncertain"), F.lit(False)))
            .withColumn("primary_cause", F.get("causes", F.lit(0))).withColumn("all_causes", F.array_join("causes", "; "))
            .drop("prev", "next", "n", "n_no_table", "n_unusable", "causes"))


def reports_in_between(spans: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports themselves, one row each (country, span_start, pdf_file_name, report_date); spans carry the
    bounding reports' dates as prev_date / next_date. A span's days are a run of all days in order, found by its two ends;
    reports follow by equi join."""
    days = reports.filter("report_date is not null and country is not null").select("country", "report_date").distinct().withColumn("day", F.lit(1))
    bounded = spans.filter("prev_date is not null or next_date is not null").select("country", "span_start", "prev_date", "next_date")
    hit = sums_between(bounded, days, ["day"]).filter("day_to > day_from") \
        .select("span_start", F.explode(F.sequence(F.col("day_from") + 1, F.col("day_to"))).alias("day"))
    ordered = running_totals(days, ["country", "report_date"], ["day"])           # the same days in the same order
    return hit.join(ordered, "day").select("country", "span_start", "report_date").join(
        reports.select("country", "report_date", "pdf_file_name"), ["country", "report_date"])


def fill_preview(gaps: DataFrame, reports: DataFrame, has_audit: bool = True, offsets=OFFSETS) -> DataFrame:
    """(country, gap_year) + what the audited columns of the candidate reports promise.

    The candidates and their order are those of the waterfall. Statuses from best to worst: an actual column,
    preliminary or estimate, inside a merged range, projection, unknown, not visible.
    """
    if not has_audit:
        return gaps.select("country", "gap_year").distinct().select(
            "country", "gap_year", F.lit("preview_unavailable_no_audit_column").alias("fill_status"),
            *[F.lit(None).cast("string").alias(c) for c in ("preferred_source_report", "preferred_source_col_label",
                                                            "preferred_source_col_status")],
            F.lit(0).cast("long").alias("n_reports_actual_column_visible"))
    skip = reports.filter("report_status in ('no_table', 'excluded_non_country')").select("pdf_file_name").distinct()
    # a report name stands for its first row by date, as one report may own several years
    first = pick.smallest(reports.select("country", "pdf_file_name", F.year("report_date").alias("pub_year"), "report_date",
                                         "table_found", "json_file", "year_label", "column_header_audit_json"),
                          ["country", "pdf_file_name"], [F.col("report_date"), F.col("json_file"), F.col("year_label")])
    # a report is a candidate of one year per offset at most: they come as one row, so that its audit is read once, and of candidates alone
    due = gaps.select("country", "gap_year").distinct().select("country", "gap_year", F.explode(F.array(*[F.lit(o) for o in offsets])).alias("offset"))
    due = due.groupBy("country", (F.col("gap_year") + F.col("offset")).alias("pub_year")).agg(F.collect_list(F.struct("gap_year", "offset")).alias("due"))
    cands = split_join(first.filter("table_found").drop("table_found").join(skip, "pdf_file_name", "left_anti"), due, ["country", "pub_year"])
    # cells are read as rows of their own, not inside the array, where expressions are interpreted
    cells = (cands.select("country", "pdf_file_name", "report_date", "due", F.explode(F.from_json("column_header_audit_json", AUDIT)["columns"]).alias("raw"))
             .withColumn("c", audit_cell(F.col("raw"))).drop("raw").withColumn("d", F.explode("due")).select("*", "d.*").drop("due", "d")
             .withColumn("single", (F.col("c.kind") == "single") & (F.col("c.y0") == F.col("gap_year")))
             .withColumn("merged", (F.col("c.kind") == "range") & F.col("gap_year").between(F.col("c.y0"), F.col("c.y1")))
             .filter("single or merged"))
    status = F.col("c.status")
    actual = F.col("single") & status.isin(ELIGIBLE)
    prelim = F.col("single") & status.isin("preliminary", "estimate")
    pick_ = F.struct(F.col("pdf_file_name").alias("report"), F.col("c.label").alias("label"), status.alias("status"))
    # an actual column first, then the waterfall's order: small offset, late date, large name
    best_order = F.struct(F.when(actual, 0).otherwise(-1).alias("a"), (-F.col("offset")).alias("b"),
                          F.unix_date("report_date").alias("c"), F.col("pdf_file_name").alias("d"))
    agg = cells.groupBy("country", "gap_year").agg(
        F.count_if(actual).alias("n_actual"), F.count_if(prelim).alias("n_prelim"), F.count_if(F.col("merged")).alias("n_range"),
        F.count_if(F.col("single") & (status == "projection")).alias("n_proj"), F.count_if(F.col("single")).alias("n_single"),
        F.max_by(pick_, F.when(actual | prelim, best_order)).alias("p"),
        F.count_distinct(F.when(actual, F.col("pdf_file_name"))).alias("n_reports_actual_column_visible"))
    out = gaps.select("country", "gap_year").distinct().join(agg, ["country", "gap_year"], "left")
    yes = {k: F.coalesce(F.col(k), F.lit(0)) > 0 for k in ("n_actual", "n_prelim", "n_range", "n_proj", "n_single")}
    fill = (F.when(yes["n_actual"], "fillable_actual_column_visible").when(yes["n_prelim"], "only_preliminary_or_estimate")
            .when(yes["n_range"], "only_in_merged_range_column").when(yes["n_proj"], "only_projection")
            .when(yes["n_single"], "status_unknown").otherwise("not_visible_in_any_report"))
    return out.select("country", "gap_year", fill.alias("fill_status"), F.col("p.report").alias("preferred_source_report"),
                      F.col("p.label").alias("preferred_source_col_label"), F.col("p.status").alias("preferred_source_col_status"),
                      F.coalesce("n_reports_actual_column_visible", F.lit(0)).alias("n_reports_actual_column_visible"))


def panel_skeleton(kept: DataFrame, gaps: DataFrame, values: list[str] = CATEGORIES) -> DataFrame:
    """Observed and missing country-years with their provenance, one row each."""
    observed = kept.select(
        "country", "year", F.lit("observed").alias("status"), F.col("pdf_file_name").alias("source_report"),
        F.col("report_date").cast("string").alias("source_report_date"), F.col("n_reports").alias("n_reports_for_year"),
        F.col("values_agree").alias("duplicate_values_agree"), "year_uncertain",
        F.nullif("year_parse_note", F.lit("")).alias("year_parse_note"), *[F.col(v) for v in values])
    missing = gaps.select(
        "country", F.col("gap_year").alias("year"), F.lit("GAP").alias("status"), F.lit(0).cast("long").alias("n_reports_for_year"),
        *[F.col(c) for c in ("gap_id", "gap_span", "primary_cause", "fill_status", "preferred_source_report") if c in gaps.columns])
    return observed.unionByName(missing, allowMissingColumns=True)


def coverage_code(status: Col = "status", uncertain: Col = "year_uncertain") -> Column:
    return (F.when(as_col(status) == "GAP", "GAP").when(F.coalesce(as_col(uncertain), F.lit(False)), "O?").otherwise("O"))


def coverage_matrix(panel: DataFrame, entities: DataFrame, entity: str = "country") -> DataFrame:
    """Entity x year grid of codes from the panel's first to its last year, a row for every entity of `entities` as well.

    Only the two years reach the driver; with the list of years known, the pivot is one aggregate.
    """
    span = panel.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
    years = [] if span.first is None else list(range(int(span.first), int(span.last) + 1))
    grid = panel.groupBy(entity).pivot("year", years).agg(F.first(coverage_code())) if years else panel.select(entity).distinct()
    every = entities.select(entity).union(panel.select(entity)).distinct()
    return every.join(grid, entity, "left").select(entity, *[F.coalesce(F.col(str(y)), F.lit("")).alias(str(y)) for y in years])


def children_of_kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Line items of levels 1 to 3 of the observations that were kept."""
    child = (rows.withColumn("year_label", effective_label(rows.columns, year_first=False))
             .filter(F.col("level").cast("string").isin("1", "1.0", "2", "2.0", "3", "3.0"))
             .select(*[c for c in ("json_file", "year_label", "pdf_file_name", "top_category", "hierarchy_id", "level", "parent_label",
                                   "label_verbatim", "value") if c == "year_label" or c in rows.columns]))
    key = kept.select("json_file", "year_label", "country", "year")
    return split_join(child, key, ["json_file", "year_label"]).drop("json_file", "year_label")


def drop_identified(gaps: DataFrame, prior: DataFrame, entity: str = "country", year: str = "gap_year") -> DataFrame:
    """Gap years an earlier run already listed are left out (names compared normalised, without case)."""
    key = F.lower(normalize_entity(entity))
    seen = prior.select(key.alias("__k"), F.col(year).cast("int").alias(year)).distinct()
    return gaps.withColumn("__k", key).join(seen, ["__k", year], "left_anti").drop("__k").select(*gaps.columns)


def gap_statistics(reports: DataFrame, kept: DataFrame, gaps: DataFrame) -> DataFrame:
    """(measure, item, n): the counts that describe a gap run, as one long table; each input is read once."""
    one, n = F.lit(1), F.col("n")

    def total(name: str) -> Measure:
        return name, None, F.col(name)
    of_reports = set_counts(reports, {(): [("n_reports", None, n), total("n_year_after_report_year")], ("report_status",): [("status", F.col("report_status"), n)]},
                            {"n_year_after_report_year": F.count_if("year_after_report_year")})
    of_kept = set_counts(kept, {(): [("n_observed_country_years", None, n), *map(total, ("n_dup_country_years", "n_dup_values_disagree", "n_uncertain_obs"))]}, {
        "n_dup_country_years": F.count_if(F.col("n_reports") > 1), "n_dup_values_disagree": F.count_if(F.col("values_agree") == "No"),
        "n_uncertain_obs": F.count_if("year_uncertain")})
    spans = [("n_gap_spans", None, one), ("span_length", F.col("length"), one), ("cause_by_span", F.col("cause"), one)]
    sets = {(): [("n_gap_years", None, n)], ("country", "span_start"): spans, ("country",): [("n_countries_with_gap", None, one)]}
    if "fill_status" in gaps.columns:
        sets["fill_status",] = [("fill_status", F.col("fill_status"), n)]
    of_gaps = set_counts(gaps, sets, {"length": F.first("span_length"), "cause": F.first("primary_cause")})
    return of_reports.unionByName(of_kept).unionByName(of_gaps)


# ---- streaks -----------------------------------------------------------------------------------------

def run_pieces(df: DataFrame, entity: str, period: str, hit: Column, gaps_allowed: bool) -> DataFrame:
    """(entity, __part, run_start, run_end, run_length, __opens, __ends): the runs of rows with `hit` in each range of the
    order (entity, period), and whether a run begins with its range's first row or ends with its last.

    A long series lies in several ranges, none of which holds more than any other. The ranges are written once.
    """
    rows = df.select(entity, period, hit.alias("__hit")).repartitionByRange(entity, period).sortWithinPartitions(entity, period)
    rows = materialise(rows.withColumn("__place", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__place", 33))
    inside = Window.partitionBy("__part").orderBy("__place")
    goes_on = F.lag("__hit").over(inside) & F.col(entity).eqNullSafe(F.lag(entity).over(inside))
    if not gaps_allowed:
        goes_on &= F.col(period) == F.lag(period).over(inside) + 1
    begins = F.when(F.col("__hit") & ~F.coalesce(goes_on, F.lit(False)), 1).otherwise(0)
    runs = rows.withColumn("__run", F.sum(begins).over(inside)).filter("__hit").groupBy(entity, "__part", "__run").agg(
        F.min(period).alias("run_start"), F.max(period).alias("run_end"), F.count("*").alias("run_length"),
        F.min("__place").alias("__first"), F.max("__place").alias("__last"))
    sizes = rows.groupBy("__part").agg(F.max("__place").alias("__size"))          # one row per range
    sizes = sizes.withColumn("__nth", F.row_number().over(Window.orderBy("__part")))
    return runs.join(F.broadcast(sizes), "__part").select(
        entity, F.col("__nth").alias("__part"), "run_start", "run_end", "run_length",
        (F.col("__first") == F.shiftleft("__part", 33)).alias("__opens"), (F.col("__last") == F.col("__size")).alias("__ends"))


def zero_runs(df: DataFrame, entity: str, period: str, value: str, tolerance: float = 0.0, allow_missing: bool = False) -> DataFrame:
    """(entity, run_start, run_end, run_length) of consecutive periods whose value is zero.

    One row per (entity, period) is expected; `period` is an integer. With allow_missing a period without a
    row does not break a run. Series of any length are read range by range; runs that touch an edge of their range, two
    for each range at most, are joined to those across it.
    """
    pieces = materialise(run_pieces(df, entity, period, F.abs(value) <= tolerance, allow_missing))
    edge = F.col("__opens") | F.col("__ends")
    order = Window.orderBy("__part", F.col("__ends").cast("int"), "run_start")
    meets = F.col("__opens") & F.lag("__ends").over(order) & (F.col("__part") == F.lag("__part").over(order) + 1) & F.col(entity).eqNullSafe(F.lag(entity).over(order))
    if not allow_missing:
        meets &= F.col("run_start") == F.lag("run_end").over(order) + 1
    chain = F.sum(F.when(F.coalesce(meets, F.lit(False)), 0).otherwise(1)).over(order)
    out = [entity, "run_start", "run_end", "run_length"]
    joined = pieces.filter(edge).withColumn("__chain", chain).groupBy(entity, "__chain").agg(
        F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"), F.sum("run_length").alias("run_length"))
    return pieces.filter(~edge).select(*out).unionByName(joined.select(*out))


def streak_table(df: DataFrame, entity: str, period: str, value: str, min_run: int, tolerance: float = 0.0,
                 allow_missing: bool = False) -> DataFrame:
    """One row per entity: longest zero run (later end wins ties), long runs, first and last period, shares."""
    runs = zero_runs(df, entity, period, value, tolerance, allow_missing)
    best = runs.groupBy(entity).agg(
        F.max_by(F.struct("run_length", "run_start", "run_end"), F.struct("run_length", "run_end")).alias("b"),
        F.count_if(F.col("run_length") >= min_run).alias("n_long_runs"))
    zero = F.abs(value) <= tolerance
    base = df.groupBy(entity).agg(
        F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count("*").alias("n_reported"),
        F.count_if(zero).alias("n_zero"), F.max_by(zero, F.col(period)).alias("zero_in_latest"),
        F.array_sort(F.collect_set(F.when(~zero, F.col(period)))).alias("__nz"))
    return base.join(best, entity, "left").select(
        entity, F.coalesce("b.run_length", F.lit(0)).alias("longest_zero_run"), F.col("b.run_start").alias("longest_run_start"),
        F.col("b.run_end").alias("longest_run_end"), F.coalesce("n_long_runs", F.lit(0)).alias("n_long_runs"),
        "first_period", "last_period", "n_reported", "n_zero", (F.col("n_reported") - F.col("n_zero")).alias("n_nonzero"),
        (F.col("n_zero") / F.col("n_reported")).alias("share_zero"), "zero_in_latest",
        F.array_join(F.transform("__nz", lambda p: p.cast("string")), ", ").alias("nonzero_periods"))


def listed_by_group(table: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Entities in the panel and with a long run per group, plus a Total row (one rollup)."""
    listed = table.select(F.coalesce(group, F.lit("unclassified")).alias("group"), (F.col("n_long_runs") > 0).alias("l"))
    r = (listed.rollup("group").agg(F.grouping("group").alias("__t"), F.count("*").alias("countries_in_panel"),
                                    F.count_if("l").alias("countries_listed")))
    rank = F.when(F.col("__t") == 1, len(order) + 1).otherwise(pick.priority_rank("group", order))
    return (r.select(F.when(F.col("__t") == 1, "Total").otherwise(F.col("group")).alias("group"), "countries_in_panel",
                     "countries_listed", F.try_divide("countries_listed", "countries_in_panel").alias("share_listed"),
                     rank.alias("sort_key")))


def sort_by_group(df: DataFrame, group: str, order: list[str], then: list[str | Column]) -> DataFrame:
    """Groups in a fixed order, unknown and missing groups last."""
    return df.orderBy(pick.priority_rank(F.coalesce(group, F.lit("")), order), *then)
