"""Gap years filled from later reports, and the steps that are repeated between runs."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.items import CATEGORIES
from panelkit.operators import gaps as G, tree as T, waterfall as W
from panelkit.plans import gap_fill as P
from panelkit.session import materialise
from panelkit.streaming import incremental as S
from workload import roles as R
from workload.q_gaps import INSIDE, USE, report_table
from workload.registry import query

GAPS = f"""{USE}, {INSIDE}, tgt AS (SELECT country, CAST(unnest(generate_series(span_start, span_end)) AS INT) AS gap_year FROM spans),
cnd AS (SELECT t.country, t.gap_year, row_number() OVER (PARTITION BY t.country, t.gap_year ORDER BY r.pub_year - t.gap_year, r.report_date DESC, r.pdf_file_name DESC) AS rank, r.pdf_file_name AS candidate_report,
  CAST(r.pub_year - t.gap_year AS INT) AS offset_years, r.report_date, r.k FROM tgt t JOIN rpt r ON r.country = t.country AND r.pub_year - t.gap_year BETWEEN 2 AND 4 WHERE r.k % 23 <> 0 OR r.k NOT IN (SELECT k FROM rep WHERE st = 'no_table')),
cmap AS (SELECT t.*, rank, candidate_report, offset_years, CAST(report_date AS VARCHAR) AS publication_date, k FROM tgt t LEFT JOIN cnd USING (country, gap_year))"""


def gap_targets(spark, sf):
    """(targets, documents, reports without table, report table)."""
    _, rep = report_table(spark, sf, reuse=True, labels=False)
    targets = materialise(G.gap_years(G.gap_spans(G.kept_observations(rep), "country", "year")).select("country", F.col("gap_year").cast("int").alias("gap_year")))
    docs = R.reports(spark, sf).select("country", "pdf_file_name", "pub_year", "report_date", "k")
    return targets, docs, W.skip_list(rep), rep


def candidates(spark, sf):
    targets, docs, skip, _ = gap_targets(spark, sf)
    return W.candidate_map(targets, docs, skip)


def shown(c):
    return c.select("country", "gap_year", "rank", "candidate_report", "offset_years", F.col("publication_date").cast("string").alias("publication_date"))


@query("candidate_map", f"WITH {GAPS} SELECT country, gap_year, rank, candidate_report, offset_years, publication_date FROM cmap")
def candidate_map(spark, sf):
    """Ranked candidate reports of every gap year; a year without any keeps one row."""
    return shown(candidates(spark, sf))


STATUS = """CASE WHEN hash7 = 0 THEN 'resolved' WHEN hash7 = 1 THEN 'resolved_with_warning' WHEN hash7 = 2 THEN 'api_error' WHEN hash7 = 3 THEN NULL ELSE 'rejected_not_actual' END"""
ANSWERS = f"""ans AS (SELECT *, {STATUS.replace('hash7', '((k * 31 + gap_year) % 11)')} AS s FROM cmap WHERE rank IS NOT NULL)"""


def answers(spark, sf, cand, docs):
    """One saved answer per candidate: resolved, rejected, failed, or none at all."""
    h = (F.col("k") * 31 + F.col("gap_year")) % 11
    status = R.case(F.lit("rejected_not_actual"), (h == 0, F.lit("resolved")), (h == 1, F.lit("resolved_with_warning")), (h == 2, F.lit("api_error")), (h == 3, F.lit(None).cast("string")))
    a = cand.filter("rank is not null").join(docs.select(F.col("pdf_file_name").alias("candidate_report"), "k"), "candidate_report")
    return a.select(F.col("candidate_report").alias("report"), F.col("gap_year").alias("year"), status.alias("status"),
                    R.text("detail ", F.col("k")).alias("errors"), F.when(h == 1, "check").alias("warnings")).filter("status is not null")


RESOLVE = f"""{ANSWERS}, out AS (SELECT *, coalesce(s, 'not_run') AS st2 FROM ans),
fe AS (SELECT country, gap_year, min(rank) FILTER (WHERE st2 IN ('resolved', 'resolved_with_warning', 'api_error', 'not_run')) AS fin, max(rank) AS mx FROM out GROUP BY 1, 2),
att AS (SELECT out.* FROM out JOIN fe USING (country, gap_year) WHERE fin IS NULL OR rank <= fin),
lst AS (SELECT * FROM att QUALIFY row_number() OVER (PARTITION BY country, gap_year ORDER BY rank DESC) = 1),
res AS (SELECT t.country, t.gap_year, CASE WHEN l.st2 IS NULL THEN 'unresolved_no_candidate_reports' WHEN l.st2 IN ('resolved', 'resolved_with_warning') THEN l.st2 WHEN l.st2 IN ('api_error', 'not_run') THEN 'pending_' || l.st2
  ELSE 'unresolved' END AS final_status, CASE WHEN l.st2 LIKE 'resolved%' THEN l.candidate_report END AS source_report, CASE WHEN l.st2 LIKE 'resolved%' THEN l.offset_years END AS source_offset_years,
  coalesce(l.rank, 0) AS n_attempts, coalesce(mx, 0) AS n_candidates, CASE WHEN l.st2 NOT LIKE 'resolved%' THEN l.st2 END AS last_failure_status,
  CASE WHEN l.st2 NOT LIKE 'resolved%' AND l.s IS NOT NULL THEN 'detail ' || l.k END AS last_failure_detail, CASE WHEN l.st2 LIKE 'resolved%' AND (l.k * 31 + l.gap_year) % 11 = 1 THEN 'check' END AS warnings
  FROM tgt t LEFT JOIN lst l USING (country, gap_year) LEFT JOIN fe USING (country, gap_year))"""


def cascade(spark, sf):
    targets, docs, skip, rep = gap_targets(spark, sf)
    cand = materialise(W.candidate_map(targets, docs, skip))
    saved = answers(spark, sf, cand, docs)
    resolution, attempts = W.resolve(cand, saved)
    return targets, docs, rep, cand, saved, resolution, attempts


@query("waterfall_resolution", f"WITH {GAPS}, {RESOLVE} SELECT * FROM res")
def waterfall_resolution(spark, sf):
    """First acceptable candidate wins; an error or a missing answer stops the search; otherwise the next one."""
    return cascade(spark, sf)[5]


@query("waterfall_attempts", f"""WITH {GAPS}, {RESOLVE} SELECT country, gap_year, rank AS attempt_no, candidate_report AS report, offset_years AS "offset", st2 AS status FROM att""")
def waterfall_attempts(spark, sf):
    return cascade(spark, sf)[6].select("country", "gap_year", "attempt_no", "report", "offset", "status")


@query("waterfall_saved_answers_only", f"""WITH {GAPS}, {RESOLVE} SELECT final_status, count(*) AS n FROM (SELECT replace(final_status, 'api_error', 'not_run') AS final_status FROM res) GROUP BY 1""")
def waterfall_saved(spark, sf):
    """Rebuilt from saved answers only: a stored error is open again."""
    t = cascade(spark, sf)
    return W.resolve(t[3], t[4], errors_are_open=True)[0].groupBy("final_status").agg(F.count("*").alias("n"))


FLAGS = """flg AS (SELECT country, gap_year, CASE WHEN gap_year % 2 = 0 THEN 'fillable_actual_column_visible' ELSE 'only_projection' END AS audit_fill_status, EXISTS (SELECT 1 FROM cnd WHERE cnd.country = tgt.country AND cnd.gap_year = tgt.gap_year) AS has_candidate_report FROM tgt)"""


@query("target_flags", f"""WITH {GAPS}, {FLAGS} SELECT *, audit_fill_status = 'fillable_actual_column_visible' AND NOT has_candidate_report AS audit_vs_real_candidate_mismatch FROM flg""")
def target_flags(spark, sf):
    targets, docs, skip, _ = gap_targets(spark, sf)
    t = targets.withColumn("audit_fill_status", F.when(F.col("gap_year") % 2 == 0, "fillable_actual_column_visible").otherwise("only_projection"))
    return W.target_flags(t, W.candidate_map(targets, docs, skip))


SELECTED = "k IN (SELECT k FROM rpt WHERE framework <> 'SRDSF')"


@query("dry_run", f"""WITH {GAPS}, f AS (SELECT DISTINCT candidate_report, k FROM cmap WHERE rank = 1)
SELECT (SELECT count(*) FROM f) AS first_wave_reports, (SELECT count(*) FROM cmap WHERE rank IS NULL) AS targets_without_candidate, (SELECT count(*) FROM f WHERE NOT {SELECTED}) AS first_wave_uncached""")
def dry_run(spark, sf):
    """First choices, targets without a candidate, and first choices whose pages are not at hand."""
    targets, docs, skip, _ = gap_targets(spark, sf)
    selected = R.reports(spark, sf).filter("framework <> 'SRDSF'").select("stem")
    return W.dry_run(W.candidate_map(targets, docs, skip), selected)


@query("target_statistics", f"""WITH {GAPS}, {FLAGS} SELECT (SELECT count(*) FROM tgt) AS n_targets, (SELECT count(*) FROM flg WHERE NOT has_candidate_report) AS n_no_candidate,
  (SELECT count(*) FROM flg WHERE NOT has_candidate_report AND gap_year % 2 = 0) AS n_mismatch, (SELECT count(*) FROM cmap) AS n_candidate_rows, (SELECT count(*) FROM cmap WHERE rank IS NULL OR NOT {SELECTED}) AS n_uncached""")
def target_statistics(spark, sf):
    targets, docs, skip, _ = gap_targets(spark, sf)
    t = targets.withColumn("audit_fill_status", F.when(F.col("gap_year") % 2 == 0, "fillable_actual_column_visible").otherwise("only_projection"))
    cand = materialise(W.flag_cached(W.candidate_map(targets, docs, skip), R.reports(spark, sf).filter("framework <> 'SRDSF'").select("stem")))
    return W.target_statistics(W.target_flags(t, cand), cand)


@query("expectation_match", f"""WITH {GAPS}, {RESOLVE}, c1 AS (SELECT country, gap_year, candidate_report FROM cmap WHERE rank = 1)
SELECT res.country, res.gap_year, source_report, candidate_report AS audit_expected_source_report, CASE WHEN source_report IS NOT NULL AND candidate_report IS NOT NULL THEN source_report = candidate_report END AS source_matches_audit_expectation
FROM res LEFT JOIN c1 USING (country, gap_year)""")
def expectation_match(spark, sf):
    """Was the year filled from the report the preview expected (here: the first candidate)?"""
    t = cascade(spark, sf)
    first = t[3].filter("rank = 1").select("country", "gap_year", F.col("candidate_report").alias("audit_expected_source_report"))
    targets = t[0].join(first, ["country", "gap_year"], "left").withColumn("audit_fill_status", F.lit(None).cast("string"))
    return W.expectation_match(t[5], targets).select("country", "gap_year", "source_report", "audit_expected_source_report", "source_matches_audit_expectation")


# ---- filled panel ---------------------------------------------------------------------------------------------
FILL = f"""fil AS (SELECT res.country, res.gap_year, source_report, {", ".join(f"CAST((k + {n}) % 100 AS DOUBLE) / 4 AS {c}" for n, c in enumerate(CATEGORIES))} FROM res JOIN rpt ON source_report = pdf_file_name)"""


def answer_trees(spark, sf):
    """(report, decomposition): a small tree per report, its values derived from the key."""
    r, k = R.reports(spark, sf), F.col("k")

    def node(n, c):
        value = ((k + n) % 100 / 4).cast("string")
        kids = F.when(k % 3 == 0, F.array(F.struct(R.text("child of ", c).alias("label_verbatim"), k.cast("string").alias("value"))))
        return F.struct(F.lit(c).alias("label_verbatim"), value.alias("value"), kids.alias("children")).alias(c)
    tree = F.struct(*[node(n, c) for n, c in enumerate(CATEGORIES)])
    return r.select(F.col("pdf_file_name").alias("report"), F.from_json(F.to_json(tree), T.tree_type(CATEGORIES)).alias("decomposition"))


@query("filled_panel", f"""WITH {GAPS}, {RESOLVE}, {FILL}
SELECT country, obs_year AS year, 'observed' AS status, pdf_file_name AS source_report, {", ".join(CATEGORIES)} FROM kept
UNION ALL SELECT tgt.country, tgt.gap_year, CASE WHEN source_report IS NULL THEN 'GAP' ELSE 'FILLED' END, source_report, {", ".join(CATEGORIES)} FROM tgt LEFT JOIN fil USING (country, gap_year)""")
def filled_panel(spark, sf):
    """GAP rows whose year was filled become FILLED with the source and its values."""
    targets, docs, rep, cand, saved, resolution, _ = cascade(spark, sf)
    panel = G.panel_skeleton(G.kept_observations(rep), targets).select("country", "year", "status", "source_report", *CATEGORIES)
    trees = resolution.filter("source_report is not null").select(F.col("source_report").alias("report"), F.col("gap_year").alias("year")).join(answer_trees(spark, sf), "report")
    wide = P.values_wide(resolution.withColumn("gap_id", F.lit(None).cast("string")), trees)
    return W.fill_panel(panel, wide, CATEGORIES)


LONG_OUT = ", ".join(f"({n}, '{c}')" for n, c in enumerate(CATEGORIES))


@query("gapfill_rows", f"""WITH {GAPS}, {RESOLVE}, src AS (SELECT res.country, res.gap_year, rpt.* EXCLUDE (country) FROM res JOIN rpt ON source_report = pdf_file_name),
lv AS (SELECT src.*, n, c FROM src, (VALUES {LONG_OUT}) t(n, c)),
itf AS (SELECT json_file, CAST(gap_year AS VARCHAR) AS year, c AS top_category, CAST(n + 1 AS VARCHAR) AS hierarchy_id, '0' AS level, NULL AS parent_label, c AS label_verbatim, CAST(CAST((k + n) % 100 AS DOUBLE) / 4 AS VARCHAR) AS value, 'gapfill' AS source_round, 'r9' AS gapfill_run, 'new' AS update_origin FROM lv
  UNION ALL SELECT json_file, CAST(gap_year AS VARCHAR), c, (n + 1) || '.1', '1', c, 'child of ' || c, CAST(k AS VARCHAR), 'gapfill', 'r9', 'new' FROM lv WHERE k % 3 = 0) SELECT * FROM itf""")
def gapfill_rows(spark, sf):
    """Filled line items in the panel layout, ready to append."""
    resolution = cascade(spark, sf)[5].withColumn("gap_id", F.lit(None).cast("string"))
    trees = resolution.filter("source_report is not null").select(F.col("source_report").alias("report"), F.col("gap_year").alias("year")).join(answer_trees(spark, sf), "report")
    long = P.values_long(resolution, trees)
    return P.final_rows(long, "r9").select("json_file", "year", "top_category", "hierarchy_id", "level", "parent_label", "label_verbatim", "value", "source_round", "gapfill_run", "update_origin")


@query("gap_status_codes", f"""WITH {GAPS}, {RESOLVE} SELECT country, obs_year AS year, 'o' AS code FROM kept
UNION ALL SELECT country, gap_year, CASE final_status WHEN 'resolved' THEN 'f' WHEN 'resolved_with_warning' THEN 'w' WHEN 'unresolved' THEN 'u' WHEN 'unresolved_no_candidate_reports' THEN 'n' WHEN 'pending_api_error' THEN 'e' ELSE 'g' END FROM res""")
def gap_status_codes(spark, sf):
    targets, docs, rep, cand, _, resolution, _ = cascade(spark, sf)
    panel = G.panel_skeleton(G.kept_observations(rep), targets)
    flags = W.target_flags(targets.withColumn("audit_fill_status", F.lit("")), cand)
    return W.year_codes(panel, flags, resolution)


@query("gap_status_strings", f"""WITH {GAPS}, c AS (SELECT country, obs_year AS y, 'o' AS code FROM kept UNION ALL SELECT country, gap_year, CASE WHEN EXISTS (SELECT 1 FROM cnd WHERE cnd.country = tgt.country AND cnd.gap_year = tgt.gap_year) THEN 'g' ELSE 'x' END FROM tgt)
SELECT country, string_agg(code, '' ORDER BY y) AS codes FROM c GROUP BY 1""")
def gap_status_strings(spark, sf):
    """One character per year and entity before anything was filled."""
    targets, docs, skip, rep = gap_targets(spark, sf)
    panel = G.panel_skeleton(G.kept_observations(rep), targets)
    flags = W.target_flags(targets.withColumn("audit_fill_status", F.lit("")), W.candidate_map(targets, docs, skip))
    none = targets.select("country", "gap_year").withColumn("final_status", F.lit("")).limit(0)
    return W.code_strings(W.year_codes(panel, flags, none))


# ---- repeated runs -----------------------------------------------------------------------------------------------
@query("remaining_targets", f"WITH {GAPS}, {RESOLVE} SELECT country, gap_year FROM res WHERE final_status NOT LIKE 'resolved%'")
def remaining_targets(spark, sf):
    t = cascade(spark, sf)
    return S.remaining_targets(t[0], t[5])


@query("retry_selection", f"""WITH {GAPS}, {RESOLVE}, clr AS (SELECT DISTINCT candidate_report, gap_year FROM att JOIN res USING (country, gap_year) WHERE final_status IN ('unresolved', 'unresolved_no_candidate_reports'))
SELECT candidate_report AS report, gap_year AS year, s AS status, EXISTS (SELECT 1 FROM clr WHERE clr.candidate_report = ans.candidate_report AND clr.gap_year = ans.gap_year) AS cleared FROM ans WHERE s IS NOT NULL""")
def retry_selection(spark, sf):
    """Saved answers of unresolved targets are cleared, all others stay."""
    t = cascade(spark, sf)
    kept, cleared = S.answers_to_keep(t[4].select("report", "year", "status"), t[5], t[6])
    return kept.withColumn("cleared", F.lit(False)).unionByName(cleared.withColumn("cleared", F.lit(True)))


@query("merge_saved_answers", """WITH a AS (SELECT 'conv_' || conv_id AS report, CAST(turn // 2 AS INT) AS year, role, turn, length(text) AS n FROM conversations)
SELECT report, year, role, CAST(n AS INT) AS n FROM a QUALIFY row_number() OVER (PARTITION BY report, year ORDER BY CASE role WHEN 'system' THEN 1 ELSE 0 END DESC, turn DESC) = 1""")
def merge_saved_answers(spark, sf):
    """One answer per (report, year): this run's own beats all, else the newest run's."""
    c = R.table(spark, sf, "conversations")
    a = c.select(R.text("conv_", F.col("conv_id")).alias("report"), F.floor(F.col("turn") / 2).cast("int").alias("year"), "role", "turn", F.length("text").alias("n"))
    return S.merge_answers(a, F.col("role") == "system", "turn").select("report", "year", "role", "n")


@query("remaining_reports", f"""WITH {R.REPORTS} SELECT pdf_file_name FROM rpt WHERE framework <> 'MAC_DSA'""")
def remaining_reports(spark, sf):
    r = R.reports(spark, sf)
    return S.remaining_reports(r.select("pdf_file_name"), r.filter("framework = 'MAC_DSA'").select("json_file"))


@query("listed_reports", f"""WITH {R.REPORTS} SELECT stem, true AS found FROM rpt WHERE framework = 'LIC_DSF' UNION ALL SELECT 'gone_' || stem, false FROM rpt WHERE source_round = 'round3'""")
def listed_reports(spark, sf):
    """Reports of a list that exist, and the listed ones that do not."""
    r = R.reports(spark, sf)
    wanted = r.filter("framework = 'LIC_DSF'").select("stem").unionByName(r.filter("source_round = 'round3'").select(R.text("gone_", F.col("stem")).alias("stem")))
    have, missing = S.listed_reports(r.select("pdf_file_name"), wanted)
    return have.select(F.regexp_replace("pdf_file_name", r"\.pdf$", "").alias("stem"), F.lit(True).alias("found")).unionByName(missing.withColumn("found", F.lit(False)))


@query("append_run", f"""WITH {R.LONG} SELECT source_round, gapfill_run, count(*) AS n FROM (SELECT source_round, gapfill_run FROM rws WHERE source_round <> 'gapfill' OR gapfill_run = 'run1'
  UNION ALL SELECT 'gapfill', 'run2' FROM rws WHERE gapfill_run = 'run2') GROUP BY ALL""")
def append_run(spark, sf):
    """A run's rows appended to a panel that does not hold them yet."""
    rows = R.long_rows(spark, sf)
    new = rows.filter("gapfill_run = 'run2'").drop("source_round", "gapfill_run").withColumn("year", F.col("obs"))
    old = rows.filter(~F.coalesce(F.col("gapfill_run") == "run2", F.lit(False)))
    return S.append_run(old, new, "run2").groupBy("source_round", "gapfill_run").agg(F.count("*").alias("n"))


@query("fill_report_facts", f"""WITH {R.LONG}, kn AS (SELECT json_file, any_value(report_title) AS t FROM rws WHERE report_title IS NOT NULL GROUP BY 1)
SELECT rws.json_file, hierarchy_id, CASE WHEN source_round = 'gapfill' THEN t ELSE 'own title' END AS report_title FROM rws LEFT JOIN kn USING (json_file)""")
def fill_report_facts(spark, sf):
    """Blank facts of new rows come from the same report's rows in the panel."""
    rows = R.long_rows(spark, sf)
    new = rows.withColumn("report_title", F.when(F.col("source_round") == "gapfill", " ").otherwise("own title"))
    out = W.fill_report_facts(new, rows, ["report_title"], "row_no")
    return out.select("json_file", "hierarchy_id", "report_title")


@query("report_facts_fallback", f"""WITH {R.REPORTS} SELECT json_file, CASE WHEN framework = 'LIC_DSF' THEN 'a' WHEN source_round = 'round1' THEN 'b' ELSE 'c' END AS origin, CASE WHEN framework = 'LIC_DSF' THEN framework WHEN source_round = 'round1' THEN report_title ELSE country END AS fact FROM rpt""")
def report_facts_fallback(spark, sf):
    """Facts of a report from the first source that knows it."""
    r = R.reports(spark, sf)
    a = r.filter("framework = 'LIC_DSF'").select("json_file", F.lit("a").alias("origin"), F.col("framework").alias("fact"))
    b = r.filter("source_round = 'round1'").select("json_file", F.lit("b").alias("origin"), F.col("report_title").alias("fact"))
    return W.first_non_empty([a, b, r.select("json_file", F.lit("c").alias("origin"), F.col("country").alias("fact"))], "json_file", ["origin", "fact"])
