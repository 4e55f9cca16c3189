"""Missing years of an entity: report usage, gaps, causes, preview, panel, streaks."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.items import CATEGORIES
from panelkit.operators import gaps as G, pick
from panelkit.operators.spread import number_rows
from panelkit.plans import gap_fill as P
from panelkit.session import materialise
from workload import roles as R
from workload.registry import query

RANGE = (1992, 2001)
VALUE_ID = {1: "change_in_debt", 2: "identified_flows", 3: "primary_balance", 4: "automatic_debt_dynamics", 5: "other_identified_flows", 6: "residual"}


def report_table(spark, sf, audit=False, reuse=False, labels=True):
    """(long rows, one row per report with its values and usage); reuse: written once for several consumers."""
    rows = R.long_rows(spark, sf, audit, labels)
    rep = G.report_table(rows, "row_no", with_values=True).withColumn("report_status", G.usage_status())
    return rows, materialise(rep) if reuse else rep


LBL = R.squeezed("last_actual_year")
# SQL: one row per report that has rows, its year, values and usage
USE = R.LONG + f""",
rep0 AS (SELECT DISTINCT k, country, json_file, pdf_file_name, report_date, pub_year, obs, last_actual_year, table_found = 'True' AS table_found, source_round, framework,
  manual_review_required = 'Yes' AS year_uncertain, {R.year_kind(LBL)} AS kind, {R.year_end(LBL, True)} AS obs_year FROM rws),
tv AS (SELECT k, {", ".join(f"max(CASE WHEN hierarchy_id = '{n}' THEN v END) AS {c}" for n, c in VALUE_ID.items())}
  FROM (SELECT k, hierarchy_id, {R.comma_num('value')} AS v FROM itm) GROUP BY 1),
rep AS (SELECT rep0.*, {", ".join(f"CASE WHEN table_found THEN {c} END AS {c}" for c in CATEGORIES)}, CASE WHEN NOT table_found THEN 'no_table' WHEN kind <> 'single' THEN 'table_but_year_unusable'
  WHEN pub_year - obs_year < 0 OR (source_round <> 'gapfill' AND pub_year - obs_year >= 4) THEN 'year_implausible_vs_report_date' ELSE 'observation' END AS st FROM rep0 LEFT JOIN tv USING (k)),
obs AS (SELECT *, row_number() OVER (PARTITION BY country, obs_year ORDER BY report_date DESC, pdf_file_name DESC) AS rn FROM rep WHERE st = 'observation'),
kept AS (SELECT * FROM obs WHERE rn = 1),
stat AS (SELECT rep.*, CASE WHEN rep.st = 'observation' AND rn > 1 THEN 'observation_superseded_by_later_report' ELSE rep.st END AS report_status FROM rep LEFT JOIN obs USING (k))"""


@query("report_usage", f"WITH {USE} SELECT json_file, country, CAST(report_date AS VARCHAR) AS report_date, obs_year, year_uncertain, obs_year > pub_year AS after, report_status FROM stat".replace(
    "obs_year > pub_year AS after", "coalesce(obs_year > pub_year, false) AS year_after_report_year"))
def report_usage(spark, sf):
    """What every report can be used for, with superseded observations marked."""
    _, rep = report_table(spark, sf, reuse=True)
    return G.mark_superseded(rep, G.kept_observations(rep)).select(
        "json_file", "country", F.col("report_date").cast("string").alias("report_date"), "obs_year", "year_uncertain", "year_after_report_year", "report_status")


AGREE = " AND ".join(f"bool_and(o.{c} IS NOT DISTINCT FROM kept.{c} OR coalesce(abs(o.{c} - kept.{c}) < 1e-6, false))" for c in CATEGORIES)


@query("report_latest_wins", f"""WITH {USE}, d AS (SELECT kept.k, count(*) AS n_reports, CASE WHEN count(*) > 1 THEN CASE WHEN {AGREE} THEN 'Yes' ELSE 'No' END END AS values_agree
  FROM kept JOIN obs o ON o.country = kept.country AND o.obs_year = kept.obs_year GROUP BY kept.k)
SELECT country, obs_year AS year, json_file, {", ".join(CATEGORIES)}, n_reports, values_agree FROM kept JOIN d USING (k)""")
def report_latest_wins(spark, sf):
    """Latest report per entity and year, how many there were and whether their values agree."""
    _, rep = report_table(spark, sf)
    return G.kept_observations(rep).select("country", "year", "json_file", *CATEGORIES, "n_reports", "values_agree")


@query("top_values_wide", f"""WITH {USE} SELECT json_file, {", ".join(CATEGORIES)} FROM rep WHERE table_found AND k IN (SELECT k FROM itm WHERE level = '0')""")
def top_values_wide(spark, sf):
    """The six category values of every report and year, long to wide."""
    return G.top_values(R.long_rows(spark, sf), "row_no").select("json_file", *CATEGORIES)


@query("superseded_reports", f"""WITH {USE} SELECT o.country, o.obs_year AS year, kept.json_file AS kept_report, o.json_file AS superseded_report FROM obs o JOIN kept USING (country, obs_year) WHERE o.rn > 1""")
def superseded_reports(spark, sf):
    """The reports behind every superseded list, one row each."""
    _, rep = report_table(spark, sf, reuse=True)
    kept = G.kept_observations(rep)
    lost = G.mark_superseded(rep, kept).filter("report_status = 'observation_superseded_by_later_report'").select("country", F.col("obs_year").alias("year"), F.col("json_file").alias("superseded_report"))
    return lost.join(kept.select("country", "year", F.col("json_file").alias("kept_report")), ["country", "year"])


INSIDE = """iv AS (SELECT country, obs_year AS y, lead(obs_year) OVER (PARTITION BY country ORDER BY obs_year) AS nx FROM kept),
spans AS (SELECT country, CAST(y + 1 AS INT) AS span_start, CAST(nx - 1 AS INT) AS span_end, CAST(nx - y - 1 AS INT) AS span_length, y AS prev_year, nx AS next_year FROM iv WHERE nx - y > 1)"""
FULL = f"""uni AS (SELECT DISTINCT country FROM rep UNION SELECT 'Customer ' || c_custkey FROM customer),
miss AS (SELECT country, y FROM uni, range({RANGE[0]}, {RANGE[1] + 1}) t(y) EXCEPT SELECT country, obs_year FROM kept),
isl AS (SELECT country, y, y - row_number() OVER (PARTITION BY country ORDER BY y) AS g FROM miss),
sp AS (SELECT country, CAST(min(y) AS INT) AS span_start, CAST(max(y) AS INT) AS span_end, CAST(count(*) AS INT) AS span_length FROM isl GROUP BY country, g),
spans AS (SELECT sp.*, (SELECT max(obs_year) FROM kept WHERE kept.country = sp.country AND obs_year < span_start) AS prev_year,
  (SELECT min(obs_year) FROM kept WHERE kept.country = sp.country AND obs_year > span_end) AS next_year FROM sp)"""


def kept_years(spark, sf):
    _, rep = report_table(spark, sf)
    return G.kept_observations(rep)


@query("gap_spans", f"WITH {USE}, {INSIDE} SELECT country, span_start, span_end, span_length, prev_year, next_year FROM spans")
def gap_spans(spark, sf):
    """Consecutive missing years between an entity's first and last observation."""
    return G.gap_spans(kept_years(spark, sf), "country", "year")


@query("gap_years_inside", f"WITH {USE}, {INSIDE} SELECT country, CAST(unnest(generate_series(span_start, span_end)) AS INT) AS gap_year FROM spans")
def gap_years_inside(spark, sf):
    return G.gap_years(G.gap_spans(kept_years(spark, sf), "country", "year")).select("country", F.col("gap_year").cast("int").alias("gap_year"))


def universe(spark, sf):
    return R.table(spark, sf, "customer").select(R.text("Customer ", F.col("c_custkey")).alias("country"))


@query("gap_years_full_range", f"WITH {USE}, {FULL} SELECT country, span_start, span_end, span_length, prev_year, next_year FROM spans")
def gap_years_full_range(spark, sf):
    """Every missing year of a fixed range, also for entities that were never observed."""
    _, rep = report_table(spark, sf, reuse=True)
    uni = rep.select("country").unionByName(universe(spark, sf)).distinct()
    return G.gap_spans(G.kept_observations(rep), "country", "year", RANGE, uni)


@query("gap_span_ids", f"""WITH {USE}, {INSIDE}, n AS (SELECT *, row_number() OVER (ORDER BY country, span_start) AS r FROM spans)
SELECT 'G' || CASE WHEN r < 10000 THEN lpad(CAST(r AS VARCHAR), 4, '0') ELSE CAST(r AS VARCHAR) END AS gap_id, country, span_start FROM n""")
def gap_span_ids(spark, sf):
    """Span ids in (entity, start) order."""
    return G.span_ids(G.gap_spans(kept_years(spark, sf), "country", "year"), "country").select("gap_id", "country", "span_start")


CAUSE = """bnd AS (SELECT s.*, p.pdf_file_name AS prev_report, p.report_date AS pd, p.year_uncertain AS pu, n.pdf_file_name AS next_report, n.report_date AS nd, n.year_uncertain AS nu FROM spans s
  LEFT JOIN (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY country, obs_year ORDER BY report_date DESC, pdf_file_name DESC) = 1) p ON p.country = s.country AND p.obs_year = prev_year
  LEFT JOIN (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY country, obs_year ORDER BY report_date, pdf_file_name) = 1) n ON n.country = s.country AND n.obs_year = next_year),
btw AS (SELECT b.country, span_start, count(st) AS n, count(*) FILTER (WHERE NOT table_found) AS nt, count(*) FILTER (WHERE st = 'table_but_year_unusable') AS nuu FROM bnd b
  LEFT JOIN rep r ON r.country = b.country AND (pd IS NOT NULL OR nd IS NOT NULL) AND (pd IS NULL OR r.report_date > pd) AND (nd IS NULL OR r.report_date < nd) GROUP BY 1, 2),
cau AS (SELECT b.*, n, list_filter([CASE WHEN pd IS NULL AND nd IS NULL THEN 'no_observation_in_panel' WHEN pd IS NULL THEN 'before_first_observed_year' END,
  CASE WHEN nd IS NULL AND NOT (pd IS NULL AND nd IS NULL) THEN 'after_last_observed_year' END, CASE WHEN pd IS NOT NULL AND nd IS NOT NULL AND nt > 0 THEN 'no_table_report_in_between' END,
  CASE WHEN pd IS NOT NULL AND nd IS NOT NULL AND nuu > 0 THEN 'unusable_year_report_in_between' END, CASE WHEN pd IS NOT NULL AND nd IS NOT NULL AND n = 0 THEN 'lag_between_consecutive_reports' END],
  lambda x : x IS NOT NULL) AS cs FROM bnd b JOIN btw USING (country, span_start)),
cause AS (SELECT *, CASE WHEN len(cs) = 0 THEN ['other_reports_in_between'] ELSE cs END AS cl FROM cau)"""
CAUSE_OUT = """SELECT country, span_start, span_end, prev_report, next_report, n AS n_reports_in_between, round((nd - pd) / 30.44, 1) AS months_between, cl[1] AS primary_cause, array_to_string(cl, '; ') AS all_causes,
  coalesce(pu, false) OR coalesce(nu, false) AS boundary_year_uncertain FROM cause"""


def causes(spark, sf, full=False):
    _, rep = report_table(spark, sf, reuse=True)
    kept = materialise(G.kept_observations(rep))
    rep = materialise(G.mark_superseded(rep, kept))
    spans = G.gap_spans(kept, "country", "year", RANGE, rep.select("country").unionByName(universe(spark, sf)).distinct()) if full else G.gap_spans(kept, "country", "year")
    return G.span_causes(spans, rep), rep, kept


CAUSE_COLUMNS = ["country", "span_start", "span_end", "prev_report", "next_report", "n_reports_in_between", "months_between_bounding_reports",
                 "primary_cause", "all_causes", "boundary_year_uncertain"]


@query("gap_causes", f"WITH {USE}, {INSIDE}, {CAUSE} {CAUSE_OUT}")
def gap_causes(spark, sf):
    """Why the years between two observations are missing."""
    return causes(spark, sf)[0].select(*CAUSE_COLUMNS).withColumnRenamed("months_between_bounding_reports", "months_between")


@query("gap_causes_full_range", f"WITH {USE}, {FULL}, {CAUSE} {CAUSE_OUT}")
def gap_causes_full_range(spark, sf):
    """The same for a fixed year range, with one-sided and empty spans."""
    return causes(spark, sf, True)[0].select(*CAUSE_COLUMNS).withColumnRenamed("months_between_bounding_reports", "months_between")


@query("reports_in_between", f"""WITH {USE}, {INSIDE}, {CAUSE} SELECT b.country, span_start, r.pdf_file_name FROM bnd b JOIN rep r ON r.country = b.country AND r.report_date > pd AND r.report_date < nd""")
def reports_in_between(spark, sf):
    _, rep = report_table(spark, sf, reuse=True)
    kept = G.kept_observations(rep)
    obs = rep.filter("report_status = 'observation'").groupBy("country", F.col("obs_year").alias("y")).agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
    spans = G.gap_spans(kept, "country", "year")
    spans = spans.join(obs.select("country", F.col("y").alias("prev_year"), F.col("hi").alias("prev_date")), ["country", "prev_year"]) \
        .join(obs.select("country", F.col("y").alias("next_year"), F.col("lo").alias("next_date")), ["country", "next_year"])
    return G.reports_in_between(spans, rep).select("country", "span_start", "pdf_file_name")


PREVIEW = """gy AS (SELECT country, unnest(generate_series(span_start, span_end)) AS gap_year FROM spans),
cnd AS (SELECT gy.country, gap_year, r.pub_year - gap_year AS off, r.* EXCLUDE (country) FROM gy JOIN rep r ON r.country = gy.country AND r.pub_year - gap_year BETWEEN 2 AND 4 WHERE table_found),
cell AS (SELECT *, gap_year - obs AS d FROM cnd WHERE gap_year - obs BETWEEN -3 AND 2),
sgl AS (SELECT country, gap_year, off, report_date, pdf_file_name, 'single' AS t, CASE WHEN d <= 0 THEN CASE WHEN k % 5 = 0 THEN 'preliminary' ELSE 'actual' END WHEN d = 1 THEN 'estimate' ELSE 'projection' END AS s, CAST(gap_year AS VARCHAR) AS label FROM cell
  UNION ALL SELECT country, gap_year, off, report_date, pdf_file_name, 'range', 'actual', (obs - 6) || '-' || (obs - 4) FROM cnd WHERE k % 31 = 5 AND gap_year BETWEEN obs - 6 AND obs - 4),
agg AS (SELECT country, gap_year, count(*) FILTER (WHERE t = 'single' AND s = 'actual') AS na, count(*) FILTER (WHERE t = 'single' AND s IN ('preliminary', 'estimate')) AS np, count(*) FILTER (WHERE t = 'range') AS nr,
  count(*) FILTER (WHERE s = 'projection') AS nj, count(DISTINCT pdf_file_name) FILTER (WHERE t = 'single' AND s = 'actual') AS nv FROM sgl GROUP BY 1, 2),
pref AS (SELECT * FROM sgl WHERE t = 'single' AND s <> 'projection' QUALIFY row_number() OVER (PARTITION BY country, gap_year ORDER BY CASE s WHEN 'actual' THEN 0 ELSE 1 END, off, report_date DESC, pdf_file_name DESC) = 1),
prv AS (SELECT gy.country, CAST(gy.gap_year AS INT) AS gap_year, CASE WHEN na > 0 THEN 'fillable_actual_column_visible' WHEN np > 0 THEN 'only_preliminary_or_estimate' WHEN nr > 0 THEN 'only_in_merged_range_column'
  WHEN nj > 0 THEN 'only_projection' ELSE 'not_visible_in_any_report' END AS fill_status, pref.pdf_file_name AS preferred_source_report, pref.label AS preferred_source_col_label, pref.s AS preferred_source_col_status,
  coalesce(nv, 0) AS n_reports_actual_column_visible FROM gy LEFT JOIN agg USING (country, gap_year) LEFT JOIN pref ON pref.country = gy.country AND pref.gap_year = gy.gap_year)"""


@query("gap_preview", f"WITH {USE}, {FULL}, {PREVIEW} SELECT * FROM prv")
def gap_preview(spark, sf):
    """What the audited columns of the reports published 2 to 4 years later promise for every gap year."""
    _, rep = report_table(spark, sf, audit=True, reuse=True)
    kept = materialise(G.kept_observations(rep).select("country", "year"))
    uni = rep.select("country").unionByName(universe(spark, sf)).distinct()
    gaps = G.gap_years(G.gap_spans(kept, "country", "year", RANGE, uni))
    return G.fill_preview(materialise(gaps), rep).withColumn("gap_year", F.col("gap_year").cast("int"))


@query("panel_skeleton", f"""WITH {USE}, {INSIDE}, n AS (SELECT country, obs_year, count(*) AS c FROM obs GROUP BY 1, 2)
SELECT country, obs_year AS year, 'observed' AS status, pdf_file_name AS source_report, c AS n_reports_for_year, year_uncertain, {", ".join(CATEGORIES)} FROM kept JOIN n USING (country, obs_year)
UNION ALL SELECT country, CAST(unnest(generate_series(span_start, span_end)) AS INT), 'GAP', NULL, 0, NULL, {", ".join("NULL" for _ in CATEGORIES)} FROM spans""")
def panel_skeleton(spark, sf):
    kept = materialise(kept_years(spark, sf))
    gaps = G.gap_years(G.gap_spans(kept, "country", "year")).withColumn("gap_year", F.col("gap_year").cast("int"))
    return G.panel_skeleton(kept, gaps).select("country", "year", "status", "source_report", "n_reports_for_year", "year_uncertain", *CATEGORIES)


@query("coverage_matrix", f"""WITH {USE}, {INSIDE}, c AS (SELECT country, obs_year AS y, CASE WHEN year_uncertain THEN 'O?' ELSE 'O' END AS code FROM kept
  UNION ALL SELECT country, unnest(generate_series(span_start, span_end)), 'GAP' FROM spans),
every AS (SELECT DISTINCT country FROM rep UNION SELECT 'Customer ' || c_custkey FROM customer), years AS (SELECT unnest(generate_series(min(y), max(y))) AS y FROM c)
SELECT every.country, CAST(years.y AS VARCHAR) AS year, coalesce(c.code, '') AS code FROM every CROSS JOIN years LEFT JOIN c ON c.country = every.country AND c.y = years.y""")
def coverage_matrix(spark, sf):
    """The whole grid, a row for each cell (the years that are columns follow from the data)."""
    _, rep = report_table(spark, sf, reuse=True)
    kept = materialise(G.kept_observations(rep))
    panel = G.panel_skeleton(kept, G.gap_years(G.gap_spans(kept, "country", "year")))
    grid = G.coverage_matrix(panel, rep.select("country").unionByName(universe(spark, sf)))
    return grid.unpivot("country", grid.columns[1:], "year", "code")


@query("children_of_kept", f"""WITH {USE} SELECT country, obs_year AS year, pdf_file_name, hierarchy_id, itm.label_verbatim, itm.value FROM kept JOIN itm USING (k) WHERE level = '1'""")
def children_of_kept(spark, sf):
    rows, rep = report_table(spark, sf)
    return G.children_of_kept(rows, G.kept_observations(rep)).select("country", "year", "pdf_file_name", "hierarchy_id", "label_verbatim", "value")


@query("drop_identified_gaps", f"""WITH {USE}, {INSIDE}, gy AS (SELECT country, unnest(generate_series(span_start, span_end)) AS g FROM spans)
SELECT country, CAST(g AS INT) AS gap_year FROM gy WHERE NOT (g % 2 = 0 AND country IN (SELECT 'Customer ' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))""")
def drop_identified_gaps(spark, sf):
    """Gap years an earlier run had already listed are not listed again (names compared without case)."""
    gaps = G.gap_years(G.gap_spans(kept_years(spark, sf), "country", "year")).select("country", F.col("gap_year").cast("int").alias("gap_year"))
    prior = R.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(R.text(" CUSTOMER ", F.col("c_custkey")).alias("country"), F.explode(F.sequence(F.lit(1990), F.lit(2002), F.lit(2))).alias("gap_year"))
    return G.drop_identified(gaps, prior)


@query("gap_statistics", f"""WITH {USE}, {INSIDE}, {CAUSE}, g AS (SELECT country, span_start, span_length FROM spans), d AS (SELECT country, obs_year, count(*) AS c FROM obs GROUP BY 1, 2),
ag AS (SELECT kept.k, CASE WHEN {AGREE} THEN 'Yes' ELSE 'No' END AS a, count(*) AS c FROM kept JOIN obs o ON o.country = kept.country AND o.obs_year = kept.obs_year GROUP BY kept.k)
SELECT 'n_reports' AS measure, NULL AS item, count(*) AS n FROM rep UNION ALL SELECT 'status', report_status, count(*) FROM stat GROUP BY 2 UNION ALL SELECT 'n_observed_country_years', NULL, count(*) FROM kept
UNION ALL SELECT 'n_dup_country_years', NULL, count(*) FROM d WHERE c > 1 UNION ALL SELECT 'n_dup_values_disagree', NULL, count(*) FROM ag WHERE a = 'No' AND c > 1 UNION ALL SELECT 'n_uncertain_obs', NULL, count(*) FROM kept WHERE year_uncertain
UNION ALL SELECT 'n_year_after_report_year', NULL, count(*) FROM rep WHERE obs_year > pub_year UNION ALL SELECT 'n_gap_years', NULL, CAST(sum(span_length) AS BIGINT) FROM spans UNION ALL SELECT 'n_gap_spans', NULL, count(*) FROM spans
UNION ALL SELECT 'n_countries_with_gap', NULL, count(DISTINCT country) FROM spans UNION ALL SELECT 'span_length', CAST(span_length AS VARCHAR), count(*) FROM spans GROUP BY 2
UNION ALL SELECT 'cause_by_span', cl[1], count(*) FROM cause GROUP BY 2""")
def gap_statistics(spark, sf):
    spans, rep, kept = causes(spark, sf)
    return G.gap_statistics(rep, kept, G.gap_years(spans))


@query("find_gaps_plan", f"""WITH {USE}, {FULL}, {CAUSE}, {PREVIEW}, n AS (SELECT *, row_number() OVER (ORDER BY country, span_start) AS r FROM cause)
SELECT 'G' || CASE WHEN r < 10000 THEN lpad(CAST(r AS VARCHAR), 4, '0') ELSE CAST(r AS VARCHAR) END AS gap_id, n.country, gap_year, CASE WHEN span_start = span_end THEN CAST(span_start AS VARCHAR) ELSE span_start || '-' || span_end END AS gap_span,
  cl[1] AS primary_cause, fill_status, preferred_source_report FROM n JOIN prv ON prv.country = n.country AND gap_year BETWEEN span_start AND span_end""")
def find_gaps_plan(spark, sf):
    """The whole gap search in one plan: usage, spans, ids, causes and preview of every gap year of a fixed range."""
    check = P.find_gaps(R.long_rows(spark, sf, audit=True), "row_no", RANGE, universe(spark, sf))
    return check.to_fill.select("gap_id", "country", F.col("gap_year").cast("int").alias("gap_year"), "gap_span", "primary_cause", "fill_status", "preferred_source_report")


# ---- streaks -----------------------------------------------------------------------------------------------

def daily(spark, sf):
    """Per user and day: value of purchases (0 without one), with the user's group."""
    e = R.table(spark, sf, "events")
    day = F.unix_date(F.to_date("ts"))
    d = e.groupBy(F.col("user_id").alias("user"), day.alias("day")).agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("value"))
    return d.withColumn("grp", R.case(F.lit(None).cast("string"), (F.col("user") % 4 == 0, F.lit("AE")), (F.col("user") % 4 == 1, F.lit("EM")), (F.col("user") % 4 == 2, F.lit("LIC"))))


DAILY = """dly AS (SELECT user_id AS usr, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS day, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS value,
  CASE user_id % 4 WHEN 0 THEN 'AE' WHEN 1 THEN 'EM' WHEN 2 THEN 'LIC' END AS grp FROM events GROUP BY 1, 2, 4),
isl AS (SELECT usr, day, day - row_number() OVER (PARTITION BY usr ORDER BY day) AS g FROM dly WHERE value = 0),
runs AS (SELECT usr, min(day) AS run_start, max(day) AS run_end, count(*) AS run_length FROM isl GROUP BY usr, g)"""
SKIP = """num AS (SELECT usr, day, value, row_number() OVER (PARTITION BY usr ORDER BY day) AS i FROM dly),
isl2 AS (SELECT usr, day, i - row_number() OVER (PARTITION BY usr ORDER BY day) AS g FROM num WHERE value = 0),
runs2 AS (SELECT usr, min(day) AS run_start, max(day) AS run_end, count(*) AS run_length FROM isl2 GROUP BY usr, g)"""


@query("zero_runs", f"WITH {DAILY} SELECT usr AS user, run_start, run_end, run_length FROM runs WHERE run_length >= 3")
def zero_runs(spark, sf):
    """Runs of at least three days without a purchase; a day without any event breaks a run."""
    return G.zero_runs(daily(spark, sf), "user", "day", "value").filter("run_length >= 3")


@query("zero_runs_missing_allowed", f"WITH {DAILY}, {SKIP} SELECT usr AS user, run_start, run_end, run_length FROM runs2 WHERE run_length >= 3")
def zero_runs_missing_allowed(spark, sf):
    return G.zero_runs(daily(spark, sf), "user", "day", "value", allow_missing=True).filter("run_length >= 3")


TABLE_SQL = """tb AS (SELECT usr, any_value(grp) AS grp, min(day) AS first_period, max(day) AS last_period, count(*) AS n_reported, count(*) FILTER (WHERE value = 0) AS n_zero, arg_max(value = 0, day) AS zero_in_latest,
  string_agg(CASE WHEN value <> 0 THEN CAST(day AS VARCHAR) END, ', ' ORDER BY day) AS nz FROM dly GROUP BY 1),
lg AS (SELECT usr, count(*) FILTER (WHERE run_length >= 4) AS n_long_runs FROM runs GROUP BY 1),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY usr ORDER BY run_length DESC, run_end DESC) = 1)"""


@query("zero_streaks", f"""WITH {DAILY}, {TABLE_SQL} SELECT usr AS user, coalesce(run_length, 0) AS longest_zero_run, run_start AS longest_run_start, run_end AS longest_run_end, coalesce(n_long_runs, 0) AS n_long_runs,
  first_period, last_period, n_reported, n_zero, n_reported - n_zero AS n_nonzero, n_zero / n_reported AS share_zero, zero_in_latest, coalesce(nz, '') AS nonzero_periods FROM tb LEFT JOIN best USING (usr) LEFT JOIN lg USING (usr)""")
def zero_streaks(spark, sf):
    return G.streak_table(daily(spark, sf), "user", "day", "value", 4)


@query("streaks_by_group_rollup", f"""WITH {DAILY}, {TABLE_SQL}, a AS (SELECT coalesce(grp, 'unclassified') AS g, coalesce(n_long_runs, 0) > 0 AS l FROM tb LEFT JOIN lg USING (usr))
SELECT CASE WHEN grouping(g) = 1 THEN 'Total' ELSE g END AS "group", count(*) AS countries_in_panel, count(*) FILTER (WHERE l) AS countries_listed, count(*) FILTER (WHERE l) / count(*) AS share_listed,
  CASE WHEN grouping(g) = 1 THEN 4 WHEN g = 'AE' THEN 0 WHEN g = 'EM' THEN 1 WHEN g = 'LIC' THEN 2 ELSE 3 END AS sort_key FROM a GROUP BY ROLLUP (g)""")
def streaks_by_group(spark, sf):
    d = daily(spark, sf)
    info = d.groupBy("user").agg(F.first("grp").alias("grp"))
    return G.listed_by_group(G.streak_table(d, "user", "day", "value", 4).join(info, "user"), "grp", ["AE", "EM", "LIC"])


@query("sorted_streak_list", f"""WITH {DAILY}, {TABLE_SQL} SELECT usr AS user, grp, coalesce(run_length, 0) AS longest_zero_run, row_number() OVER (ORDER BY CASE grp WHEN 'AE' THEN 0 WHEN 'EM' THEN 1 WHEN 'LIC' THEN 2 ELSE 3 END, coalesce(run_length, 0) DESC, usr) AS place
  FROM tb LEFT JOIN best USING (usr)""")
def sorted_streak_list(spark, sf):
    """All entities in the list's order: groups in their fixed order, longest streaks first; the place is counted over it."""
    d = daily(spark, sf)
    info = d.groupBy("user").agg(F.first("grp").alias("grp"))
    t = G.streak_table(d, "user", "day", "value", 4).join(info, "user").select("user", "grp", "longest_zero_run")
    rank = pick.priority_rank(F.coalesce("grp", F.lit("")), ["AE", "EM", "LIC"])
    placed = number_rows(t, [rank, F.desc("longest_zero_run"), F.col("user")], "place")
    return G.sort_by_group(placed, "grp", ["AE", "EM", "LIC"], [F.desc("longest_zero_run"), "user"]).withColumn("place", F.col("place").cast("long"))
