"""Coverage database, availability, conflicts, browsing."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.operators import coverage as C, pick
from panelkit.operators.waterfall import target_subset
from panelkit.plans.analysis import country_year_panel
from panelkit.session import materialise, use_checkpoint_dir
from workload import roles as R
from workload.registry import query

YEARS = (1992, 2001)
IDS = ["1", "2", "3", "4", "5", "5.1", "6"]
LBL = R.squeezed("last_actual_year")
VALS = R.LONG + f""",
vals AS (SELECT lower(country) AS country_key, country, hierarchy_id, value, source_round, gapfill_run, json_file, row_no, pdf_file_name, {R.year_end(LBL)} AS ey, {R.strict_num('value')} AS v FROM rws),
val AS (SELECT * FROM vals WHERE ey IS NOT NULL AND v IS NOT NULL)"""


def values(spark, sf, ids=None, keep=()):
    return C.load_values(R.long_rows(spark, sf), ids, keep)


@query("load_values", f"WITH {VALS} SELECT country_key, country AS country_label, hierarchy_id, ey AS effective_year, v AS value_num, source_round FROM val WHERE hierarchy_id IN ('5', '6')")
def load_values(spark, sf):
    """Rows with a usable year (a range counts as its end) and a strict number."""
    return values(spark, sf, ["5", "6"]).select("country_key", "country_label", "hierarchy_id", "effective_year", "value_num", "source_round")


BEST = f"""best AS (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY hierarchy_id, country_key, ey ORDER BY {R.PRIORITY.format('source_round')}, json_file, row_no) = 1)"""


@query("priority_pick", f"WITH {VALS}, {BEST} SELECT country, country_key, ey AS year, v AS value, source_round FROM best WHERE hierarchy_id = '5'")
def priority_pick(spark, sf):
    """One value per entity and year: best source first."""
    return country_year_panel(R.long_rows(spark, sf), "5", [F.col("json_file"), F.col("row_no")], None, ["json_file", "row_no"])


@query("priority_pick_by_run", f"""WITH {VALS} SELECT country_key, ey AS year, min(CASE source_round WHEN 'round1' THEN 'a round1' WHEN 'round2' THEN 'b round2' WHEN 'round3' THEN 'c round3' ELSE 'd gapfill:' || gapfill_run END)[3:] AS source_tag
  FROM val WHERE hierarchy_id = '6' GROUP BY 1, 2""")
def priority_pick_by_run(spark, sf):
    """Best source per entity and year, gap fill split by run."""
    return pick.source_by_run(values(spark, sf, ["6"]).withColumnRenamed("effective_year", "year"), ["country_key", "year"])


@query("value_sources", f"""WITH {VALS}, {BEST} SELECT hierarchy_id, country_key, ey AS year, CASE source_round WHEN 'round1' THEN 'Round 1' WHEN 'round2' THEN 'Round 2' WHEN 'round3' THEN 'Round 3' ELSE 'Gap fill' END AS source FROM best""")
def value_sources(spark, sf):
    return C.value_sources(values(spark, sf))


@query("most_common_label", f"""WITH {R.LONG}, c AS (SELECT hierarchy_id, label_verbatim AS label, count(*) AS n FROM rws WHERE label_verbatim IS NOT NULL GROUP BY 1, 2)
SELECT hierarchy_id, label FROM c QUALIFY row_number() OVER (PARTITION BY hierarchy_id ORDER BY n DESC, label) = 1""")
def most_common_label(spark, sf):
    return pick.most_common(R.long_rows(spark, sf), ["hierarchy_id"], "label_verbatim", "label")


@query("majority_vote", """WITH c AS (SELECT user_id, event_type, count(*) AS n, max(event_id) AS reached FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS majority FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, reached) = 1""")
def majority_vote(spark, sf):
    """Most frequent value per key; of equally frequent ones the first to reach that count."""
    return pick.majority(R.table(spark, sf, "events"), ["user_id"], "event_type", "event_id")


DICT = f"""lc AS (SELECT hierarchy_id, label_verbatim AS l, count(*) AS n FROM rws WHERE label_verbatim IS NOT NULL GROUP BY 1, 2), rk AS (SELECT *, row_number() OVER (PARTITION BY hierarchy_id ORDER BY n DESC, l) AS r FROM lc),
tp AS (SELECT hierarchy_id, any_value(top_category) AS top_category, CAST(any_value(level) AS INT) AS level, count(*) AS n_rows FROM rws WHERE hierarchy_id IS NOT NULL GROUP BY 1),
dic AS (SELECT 'h' || replace(hierarchy_id, '.', '_') || '_' || CASE WHEN contains(hierarchy_id, '.') THEN replace((SELECT l FROM rk WHERE rk.hierarchy_id = tp.hierarchy_id AND r = 1), ' ', '_') ELSE top_category END AS "column", hierarchy_id, level, top_category,
  (SELECT string_agg(l, ' | ' ORDER BY r) FROM rk WHERE rk.hierarchy_id = tp.hierarchy_id AND r <= 3) AS most_common_labels, n_rows FROM tp)"""


@query("indicator_dictionary", f"WITH {R.LONG}, {DICT} SELECT * FROM dic")
def indicator_dictionary(spark, sf):
    """One row per line-item id: column name, level, category, three most common labels, rows."""
    return C.indicators(R.long_rows(spark, sf))


GRID = f"grd AS (SELECT DISTINCT lower(country) AS country_key, CAST(y AS INT) AS year FROM rws, range({YEARS[0]}, {YEARS[1] + 1}) t(y))"
DB = f"""{VALS}, {GRID}, ry AS (SELECT DISTINCT lower(country) AS country_key, pub_year AS year FROM rpt), ty AS (SELECT DISTINCT lower(country) AS country_key, pub_year AS year FROM rws WHERE source_round <> 'gapfill')"""


def coverage(spark, sf, items=IDS):
    rows = R.long_rows(spark, sf)
    reports = R.reports(spark, sf).select(F.lower("country").alias("country_key"), F.col("pub_year").alias("year"))
    return C.coverage_map(rows, *YEARS, reports, items, F.when(F.col("source_round") != "gapfill", F.col("pub_year")))


COLUMNS = [("h" + h.replace(".", "_"), h) for h in IDS]


@query("coverage_db", f"""WITH {DB}, p AS (SELECT country_key, ey, {", ".join(f"bool_or(hierarchy_id = '{h}') AS {c}" for c, h in COLUMNS)} FROM val GROUP BY 1, 2)
SELECT grd.country_key, grd.year, CASE WHEN ry.year IS NULL THEN 'No' ELSE 'Yes' END AS has_staff_report, CASE WHEN ty.year IS NULL THEN 'No' ELSE 'Yes' END AS has_dsa_table,
  {", ".join(f"CASE WHEN p.{c} THEN 'Yes' ELSE 'No' END AS {c}" for c, _ in COLUMNS)} FROM grd LEFT JOIN ry USING (country_key, year) LEFT JOIN ty USING (country_key, year) LEFT JOIN p ON p.country_key = grd.country_key AND p.ey = grd.year""")
def coverage_db(spark, sf):
    """Entity x year grid: has a report, has a table, has a value per line item."""
    return C.coverage_wide(coverage(spark, sf), COLUMNS)


@query("coverage_item_totals", f"""WITH {VALS}, {BEST}, b AS (SELECT * FROM best WHERE ey BETWEEN {YEARS[0]} AND {YEARS[1]}), i(h) AS (VALUES {", ".join(f"('{h}')" for h in IDS)})
SELECT 'h' || replace(h, '.', '_') AS "column", h AS hierarchy_id, count(hierarchy_id) AS country_years_with_value, {", ".join(f"count(*) FILTER (WHERE source_round = '{r}') AS n_{r}" for r in C.PRIORITY)}
FROM i LEFT JOIN b ON hierarchy_id = h GROUP BY h""")
def coverage_item_totals(spark, sf):
    """Country-years with a value of every item, and from which source."""
    return C.item_totals(coverage(spark, sf), COLUMNS)


WIDE_SQL = f"""p AS (SELECT country_key, ey, bool_or(hierarchy_id = '5') AS h5 FROM val GROUP BY 1, 2), cov AS (SELECT grd.*, CASE WHEN ry.year IS NULL THEN 'No' ELSE 'Yes' END AS rep, CASE WHEN h5 THEN 'Yes' ELSE 'No' END AS h5
  FROM grd LEFT JOIN ry USING (country_key, year) LEFT JOIN p ON p.country_key = grd.country_key AND p.ey = grd.year)"""


@query("coverage_by_year_counts", f"""WITH {DB}, {WIDE_SQL} SELECT year, count(*) AS n_entities, count(*) FILTER (WHERE rep = 'Yes') AS n_has_staff_report, count(*) FILTER (WHERE h5 = 'Yes') AS n_h5 FROM cov GROUP BY 1""")
def coverage_by_year_counts(spark, sf):
    return C.yes_by_year(C.coverage_wide(coverage(spark, sf, ["5"]), [("h5", "5")]), ["has_staff_report", "h5"])


@query("coverage_strings", f"""WITH {DB}, {BEST}, p AS (SELECT country_key, ey, CASE source_round WHEN 'round1' THEN '1' WHEN 'round2' THEN '2' WHEN 'round3' THEN '3' ELSE 'g' END AS c FROM best WHERE hierarchy_id = '5')
SELECT grd.country_key, string_agg(coalesce(c, '0'), '' ORDER BY year) AS h5 FROM grd LEFT JOIN p ON p.country_key = grd.country_key AND p.ey = grd.year GROUP BY 1""")
def coverage_strings(spark, sf):
    """A character per year: which source a line item's value came from."""
    return C.compact_strings(C.sources_wide(coverage(spark, sf, ["5"]), [("h5", "5")]), ["h5"], C.SOURCE_CODES)


@query("browse_coverage", f"WITH {DB}, {WIDE_SQL} SELECT country_key, year, rep AS has_staff_report, h5 FROM cov WHERE contains(country_key, '7') AND year = 1997 AND country_key IN (SELECT country_key FROM cov WHERE rep = 'Yes')")
def browse_coverage(spark, sf):
    return C.browse_coverage(C.coverage_wide(coverage(spark, sf, ["5"]), [("h5", "5")]), " 7", 1997, True).select("country_key", "year", "has_staff_report", "h5")


@query("reports_per_year", f"WITH {R.REPORTS} SELECT pub_year AS year, count(*) AS n_reports, count(DISTINCT country) AS n_entities FROM rpt GROUP BY 1")
def reports_per_year(spark, sf):
    return C.reports_per_year(R.reports(spark, sf).select(F.col("country").alias("country_key"), F.col("pub_year").alias("year")))


@query("year_table", f"""WITH {VALS}, a AS (SELECT pub_year AS year, count(*) AS n_reports, count(DISTINCT country) AS n_entities FROM rpt GROUP BY 1), b AS (SELECT ey AS year, count(DISTINCT country_key) AS n_with_data FROM val WHERE hierarchy_id = '5' GROUP BY 1)
SELECT year, coalesce(n_reports, 0) AS n_reports, coalesce(n_entities, 0) AS n_entities, n_with_data FROM a FULL JOIN b USING (year)""")
def year_table(spark, sf):
    """Per year: reports, entities with reports, entities with data."""
    reports = R.reports(spark, sf).select(F.col("country").alias("country_key"), F.col("pub_year").alias("year"))
    return C.year_table(reports, values(spark, sf, ["5"]))


@query("coverage_by_year", f"""WITH {VALS}, g AS (SELECT hierarchy_id, ey, country_key, count(*) AS n, max(v) - min(v) AS d FROM val GROUP BY 1, 2, 3)
SELECT hierarchy_id, ey AS year, count(*) AS n_countries_available, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_countries_with_duplicate_rows, count(*) FILTER (WHERE n > 1 AND d > 0.05) AS n_countries_with_conflicting_values FROM g GROUP BY 1, 2""")
def coverage_by_year(spark, sf):
    return C.coverage_by_year(values(spark, sf))


@query("duplicate_conflicts", f"""WITH {VALS}, g AS (SELECT country_key, ey, count(*) AS n, max(v) - min(v) AS d FROM val WHERE hierarchy_id = '6' GROUP BY 1, 2 HAVING count(*) > 1)
SELECT country_key, ey AS effective_year, country AS country_label, v AS value_num, CASE WHEN source_round = 'gapfill' THEN 'gapfill_' || gapfill_run ELSE source_round END AS source, n AS n_rows, d > 0.05 AS conflicting FROM val JOIN g USING (country_key, ey) WHERE hierarchy_id = '6'""")
def duplicate_conflicts(spark, sf):
    """Every row of a country-year that has several, with the conflict flag."""
    return C.duplicate_detail(values(spark, sf, ["6"])).drop("hierarchy_id")


# ---- availability ----------------------------------------------------------------------------------------------
TARGETS = """tg AS (SELECT lower(country) AS country_key, CAST(obs + 1 AS INT) AS year, CASE k % 9 WHEN 0 THEN 'resolved' WHEN 1 THEN 'unresolved' WHEN 2 THEN 'pending_api_error' WHEN 3 THEN 'unresolved_no_candidate_reports' WHEN 4 THEN 'resolved_with_warning' ELSE 'pending_not_run' END AS s,
  'run' || (k % 2 + 1) AS r, 'G' || k AS gap_id FROM rpt), tgb AS (SELECT * FROM tg QUALIFY row_number() OVER (PARTITION BY country_key, year ORDER BY CASE s WHEN 'resolved' THEN 0 WHEN 'resolved_with_warning' THEN 0 WHEN 'unresolved' THEN 1
  WHEN 'pending_api_error' THEN 2 WHEN 'unresolved_no_candidate_reports' THEN 3 ELSE 4 END, r, s, gap_id) = 1)"""


def targets(spark, sf):
    r, k = R.reports(spark, sf), F.col("k") % 9
    status = R.case(F.lit("pending_not_run"), (k == 0, F.lit("resolved")), (k == 1, F.lit("unresolved")), (k == 2, F.lit("pending_api_error")), (k == 3, F.lit("unresolved_no_candidate_reports")), (k == 4, F.lit("resolved_with_warning")))
    res = r.select("country", (F.col("obs") + 1).alias("gap_year"), status.alias("final_status"), R.text("run", F.col("k") % 2 + 1).alias("gapfill_run"), R.text("G", F.col("k")).alias("gap_id"))
    return C.best_targets(res, ["run1", "run2"])


@query("best_targets", f"WITH {R.REPORTS}, {TARGETS} SELECT country_key, year, s AS final_status, r AS gapfill_run, gap_id FROM tgb")
def best_targets(spark, sf):
    """One row per target listed by several runs: the most informative status, then the oldest run."""
    return targets(spark, sf)


CELLS = f"""{VALS}, {GRID}, {TARGETS}, src AS (SELECT country_key, ey, min(CASE source_round WHEN 'round1' THEN 'a round1' WHEN 'round2' THEN 'b round2' WHEN 'round3' THEN 'c round3' ELSE 'd gapfill:' || gapfill_run END)[3:] AS tag FROM val WHERE hierarchy_id = '6' GROUP BY 1, 2),
ob AS (SELECT DISTINCT country_key, ey FROM vals JOIN rpt USING (json_file) WHERE rpt.source_round <> 'gapfill' AND ey IS NOT NULL),
cel AS (SELECT grd.*, tag, tgb.s, tgb.r, gap_id, CASE WHEN tag IS NOT NULL THEN NULL WHEN tgb.s IS NULL THEN CASE WHEN ob.ey IS NULL THEN 'not_gap_candidate' ELSE 'report_exists_field_missing' END WHEN tgb.s LIKE 'resolved%' THEN 'gapfill_resolved_but_field_missing' ELSE tgb.s END AS why
  FROM grd LEFT JOIN src ON src.country_key = grd.country_key AND src.ey = grd.year LEFT JOIN ob ON ob.country_key = grd.country_key AND ob.ey = grd.year LEFT JOIN tgb ON tgb.country_key = grd.country_key AND tgb.year = grd.year)"""


def cells(spark, sf):
    rows = R.long_rows(spark, sf)
    return C.availability(C.year_grid(C.universe(rows), *YEARS), C.load_values(rows, ["6"]), C.observed_reports(rows), targets(spark, sf))


@query("availability_breakdown", f"""WITH {CELLS} SELECT year, count(*) AS total_countries, count(tag) AS n_available, count(why) AS n_unavailable, count(*) FILTER (WHERE tag = 'round1') AS n_round1, count(*) FILTER (WHERE tag = 'round2') AS n_round2,
  count(*) FILTER (WHERE tag = 'round3') AS n_round3, count(*) FILTER (WHERE tag LIKE 'gapfill%') AS n_gapfill, {", ".join(f"count(*) FILTER (WHERE tag = 'gapfill:{r}') AS n_gapfill_run_{r}" for r in ("run1", "run2"))},
  {", ".join(f"count(*) FILTER (WHERE why = '{r}') AS n_unavail_{r}" for r in C.REASONS)}, count(*) FILTER (WHERE why = 'pending_not_run') AS n_unavail_other,
  {", ".join(f"count(*) FILTER (WHERE why IS NOT NULL AND r = '{r}') AS n_unavail_gap_target_run_{r}" for r in ("run1", "run2"))} FROM cel GROUP BY 1""")
def availability_breakdown(spark, sf):
    """Per year: available by source, unavailable by exclusive reasons."""
    return C.availability_by_year(cells(spark, sf), ["run1", "run2"])


@query("source_table", f"""WITH {CELLS} SELECT year, count(*) AS total_countries, count(*) FILTER (WHERE tag = 'round1') AS n_round1, count(*) FILTER (WHERE tag = 'round2') AS n_round2, count(*) FILTER (WHERE tag = 'round3') AS n_round3,
  count(*) FILTER (WHERE tag LIKE 'gapfill%') AS n_gapfill, count(why) AS n_unavailable FROM cel GROUP BY 1""")
def source_table(spark, sf):
    return C.source_table(cells(spark, sf))


@query("unavailable_detail", f"WITH {CELLS} SELECT country_key, year, r AS gapfill_run, gap_id, why AS reason FROM cel WHERE tag IS NULL")
def unavailable_detail(spark, sf):
    return C.unavailable(cells(spark, sf))


@query("no_later_report", f"""WITH {CELLS}, py AS (SELECT DISTINCT lower(country) AS country_key, pub_year AS y FROM rpt), l AS (SELECT cel.country_key, year, EXISTS (SELECT 1 FROM py WHERE py.country_key = cel.country_key AND y BETWEEN year + 1 AND year + 2) AS later FROM cel WHERE tag IS NULL)
SELECT year, count(*) AS n_unavailable, count(*) FILTER (WHERE later) AS n_later, count(*) FILTER (WHERE NOT later) AS n_no_later, year + 2 > (SELECT max(y) FROM py) AS partial FROM l GROUP BY 1""")
def no_later_report(spark, sf):
    """Unavailable cells with and without a report in the next two years."""
    reports = R.reports(spark, sf).select(F.lower("country").alias("country_key"), F.col("pub_year").alias("year"))
    return C.later_report_by_year(materialise(cells(spark, sf)), reports, 2)


# ---- panel statistics ----------------------------------------------------------------------------------------------
@query("panel_stats", f"""WITH {R.LONG} SELECT 'rows' AS measure, CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM rws UNION ALL SELECT 'reports', NULL, count(DISTINCT json_file) FROM rws UNION ALL SELECT 'countries', NULL, count(DISTINCT country) FROM rws
UNION ALL SELECT 'country_years', NULL, count(*) FROM (SELECT DISTINCT country, last_actual_year FROM rws) UNION ALL SELECT 'source', source_round, count(*) FROM rws GROUP BY 2""")
def panel_stats(spark, sf):
    return C.panel_stats(R.long_rows(spark, sf), "last_actual_year")


@query("source_by_year", f"""WITH {R.LONG}, f AS (SELECT country, last_actual_year AS y, source_round FROM rws WHERE regexp_matches(last_actual_year, '^\\d{{4}}$') QUALIFY row_number() OVER (PARTITION BY country, last_actual_year ORDER BY row_no) = 1)
SELECT y AS year, source_round, count(*) AS n FROM f GROUP BY 1, 2""".replace("\\\\", "\\"))
def source_by_year(spark, sf):
    return C.source_by_year(R.long_rows(spark, sf), "last_actual_year", [F.col("row_no")])


@query("browse_panel", f"""WITH {R.LONG} SELECT json_file, hierarchy_id, value FROM rws WHERE contains(lower(country), 'customer 1') AND source_round = 'round1' AND NOT contains(coalesce(hierarchy_id, ''), '.') ORDER BY row_no OFFSET 100 LIMIT 50""")
def browse_panel(spark, sf):
    """One page of filtered rows in a stable order."""
    return C.browse_panel(R.long_rows(spark, sf), ["row_no"], country="Customer 1", source="round1", top_only=True, page=2, size=50).select("json_file", "hierarchy_id", "value")


@query("panel_page", f"""WITH {R.LONG}, n AS (SELECT json_file, hierarchy_id, value, row_number() OVER (ORDER BY country, row_no) AS position FROM rws WHERE source_round = 'round1')
SELECT * FROM n WHERE position > 1200 AND position <= 1250""")
def panel_page(spark, sf):
    """A late page out of the panel's rows written by position."""
    path = f"{use_checkpoint_dir(spark)}/pages-{uuid.uuid4().hex}"
    C.write_positions(C.panel_subset(R.long_rows(spark, sf), source="round1"), ["country", "row_no"], path)
    return C.page_at(spark.read.parquet(path), 24, 50).select("json_file", "hierarchy_id", "value", "position")


@query("panel_next_page", f"""WITH {R.LONG} SELECT json_file, hierarchy_id, value FROM rws WHERE source_round = 'round1' AND row_no > 4000 ORDER BY row_no LIMIT 50""")
def panel_next_page(spark, sf):
    """The page after the last row that a reader has seen."""
    return C.browse_panel(R.long_rows(spark, sf), ["row_no"], size=50, after=(4000,), source="round1").select("json_file", "hierarchy_id", "value")


@query("target_subset", f"WITH {R.REPORTS}, t AS (SELECT DISTINCT country, obs AS gap_year FROM rpt WHERE country IN ('Customer 1', 'Customer 2', 'Customer 30')) SELECT * FROM t ORDER BY country, gap_year LIMIT 12")
def subset(spark, sf):
    """A pilot run: some entities, the first targets in order."""
    return target_subset(R.reports(spark, sf).select("country", F.col("obs").alias("gap_year")).distinct(), ["Customer 1", "Customer 2", "Customer 30"], 12)
