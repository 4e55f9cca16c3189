"""Three readings of the same reports, compared line by line."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelkit.operators import compare as C
from panelkit.plans import round_check as RC
from panelkit.session import materialise, use_checkpoint_dir
from panelkit.sources import sinks as SK
from workload import roles as R
from workload.registry import query


def comparison(spark, sf):
    # the facts of reports are told without the labels of their lines
    return C.compare_runs(R.runs(spark, sf), 3, reports=R.runs(spark, sf, labels=False))


def _f(col, r):
    return f"max(CASE WHEN run_no = {r} THEN {col} END)"


VAL = R.minus_num("v")
# SQL: report facts per run by conditional aggregation (every run's rows of a report carry the same facts)
CMP = R.RUNS + f""",
fact AS (SELECT json_file, any_value(pdf_file_name) AS pdf_file_name, any_value(country) AS country, {", ".join(
    f"max(CASE WHEN run_no = {r} THEN 1 ELSE 0 END) AS p{r}, {_f('table_found', r)} AS tf{r}, {_f('yr', r)} AS y{r}" for r in (1, 2, 3))}
  FROM (SELECT *, {R.year_norm(R.squeezed('last_actual_year'))} AS yr FROM run) GROUP BY 1),
grp AS (SELECT *, CASE WHEN p1 + p2 + p3 < 3 THEN 'missing_in_run' WHEN tf1 <> tf2 OR tf1 <> tf3 THEN 'table_found_differs' WHEN tf1 = 'False' THEN 'no_table_in_all_runs'
  WHEN y1 IS DISTINCT FROM y2 OR y1 IS DISTINCT FROM y3 THEN 'last_actual_year_differs' END AS rg FROM fact),
val AS (SELECT *, {VAL} AS num, CASE WHEN ({VAL}) IS NULL THEN lower(v) END AS txt FROM (SELECT *, trim(value) AS v FROM run WHERE hierarchy_id IS NOT NULL)),
it AS (SELECT json_file, hierarchy_id, {", ".join(f"{_f('top_category', r)} AS t{r}, {_f('label_verbatim', r)} AS l{r}, {_f('num', r)} AS n{r}, {_f('txt', r)} AS x{r}, {_f('value', r)} AS raw{r}, {_f('1', r)} AS i{r}" for r in (1, 2, 3))}
  FROM val GROUP BY 1, 2),
pr AS (SELECT it.*, grp.* EXCLUDE (json_file), {", ".join(
    f"coalesce(CASE WHEN n{a} IS NOT NULL AND n{b} IS NOT NULL THEN abs(n{a} - n{b}) <= 1e-9 WHEN n{a} IS NULL AND n{b} IS NULL THEN x{a} IS NOT DISTINCT FROM x{b} END, false) AS s{a}{b}" for a, b in ((1, 2), (1, 3), (2, 3)))}
  FROM it JOIN grp USING (json_file) WHERE rg IS DISTINCT FROM 'no_table_in_all_runs'),
al AS (SELECT *, CASE WHEN i1 IS NULL OR i2 IS NULL OR i3 IS NULL THEN 'missing_row' WHEN t1 <> t2 OR t1 <> t3 THEN 'category' WHEN NOT s12 OR NOT s13 THEN 'value' END AS rt FROM pr),
smr AS (SELECT grp.*, coalesce(c, 0) AS rows_compared, coalesce(m, 0) AS rows_matching, coalesce(c - m, 0) AS rows_differing,
  coalesce(rg, CASE WHEN coalesce(c - m, 0) = 0 THEN 'fully_match' ELSE 'partial_match' END) AS grp
  FROM grp LEFT JOIN (SELECT json_file, count(*) AS c, count(*) FILTER (WHERE rt IS NULL AND rg IS NULL) AS m FROM al GROUP BY 1) USING (json_file))"""


@query("compare_runs_summary", f"""WITH {CMP} SELECT json_file, pdf_file_name, country, grp AS "group", CASE WHEN grp = 'fully_match' THEN 'No' ELSE 'Yes' END AS needs_check,
  {" || '|' || ".join(f"CASE p{r} WHEN 1 THEN 'yes' ELSE 'no' END" for r in (1, 2, 3))} AS runs_present, {" || '|' || ".join(f"coalesce(tf{r}, '')" for r in (1, 2, 3))} AS table_found_by_run,
  {" || '|' || ".join(f"coalesce(y{r}, '')" for r in (1, 2, 3))} AS last_actual_year_by_run, rows_compared, rows_matching, rows_differing, '' AS error_by_run FROM smr""")
def compare_runs_summary(spark, sf):
    return comparison(spark, sf).summary


PAIRS = ((1, 2), (1, 3), (2, 3))
PAIR_SQL = {(a, b): f"((i{a} IS NULL) = (i{b} IS NULL) AND (i{a} IS NULL OR s{a}{b}))" for a, b in PAIRS}


@query("compare_runs_diffs", f"""WITH {CMP} SELECT json_file || '||' || hierarchy_id AS key, json_file, hierarchy_id, pdf_file_name, country, coalesce(t1, t2, t3) AS top_category,
  l1 AS label_run1, l2 AS label_run2, l3 AS label_run3, n1 AS value_run1, n2 AS value_run2, n3 AS value_run3,
  {", ".join(f"CASE WHEN x{r} IS NOT NULL THEN trim(raw{r}) END AS text_run{r}" for r in (1, 2, 3))}, {", ".join(f"{PAIR_SQL[p]} AS run{p[0]}_run{p[1]}_match" for p in PAIRS)},
  {" AND ".join(PAIR_SQL.values())} AS all_match, CASE WHEN (n1 IS NOT NULL)::INT + (n2 IS NOT NULL)::INT + (n3 IS NOT NULL)::INT >= 2 THEN greatest(n1, n2, n3) - least(n1, n2, n3) END AS max_abs_diff,
  coalesce(rg, rt) AS diff_type FROM al WHERE rg IS NOT NULL OR rt IS NOT NULL""")
def compare_runs_diffs(spark, sf):
    return comparison(spark, sf).diffs


@query("compare_runs_matched", f"""WITH {CMP} SELECT run.json_file, run.hierarchy_id, run.label_verbatim, run.value FROM run JOIN al USING (json_file, hierarchy_id) WHERE run_no = 1 AND rg IS NULL AND rt IS NULL""")
def compare_runs_matched(spark, sf):
    # reports agree or not without the labels of their lines
    agree = C.compare_runs(R.runs(spark, sf, labels=False), 3)
    return C.matched_rows(R.runs(spark, sf), agree).select("json_file", "hierarchy_id", "label_verbatim", "value")


GROUP_VALUES = ", ".join(f"('{g}')" for g in C.GROUPS)


@query("report_group_counts", f"""WITH {CMP}, g AS (SELECT * FROM (VALUES {GROUP_VALUES}) t(g)), n AS (SELECT g, count(grp) AS n_reports FROM g LEFT JOIN smr ON g = grp GROUP BY 1)
SELECT g AS "group", n_reports, printf('%.1f', 100.0 * n_reports / (SELECT sum(n_reports) FROM n)) || '%' AS share FROM n""")
def report_group_counts(spark, sf):
    return C.group_counts(comparison(spark, sf).summary)


@query("diff_type_counts", f"""WITH {CMP}, d AS (SELECT coalesce(rg, rt) AS diff_type, count(*) AS n_rows FROM al WHERE rg IS NOT NULL OR rt IS NOT NULL GROUP BY 1)
SELECT diff_type, n_rows, printf('%.1f', 100.0 * n_rows / (SELECT sum(n_rows) FROM d)) || '%' AS share FROM d""")
def diff_type_counts(spark, sf):
    return C.diff_type_counts(comparison(spark, sf).diffs)


ERROR_SQL = """err AS (SELECT r AS run_no, replace(stem, 'Customer', 'Lost') AS stem, CASE WHEN (k + r) % 3 = 0 THEN ' ' ELSE 'error ' || (k % 10) END AS message FROM rpt, (VALUES (1), (2), (3)) t(r) WHERE source_round = 'round3' AND (k + r) % 2 = 0
  UNION ALL SELECT 1, stem, 'late' FROM rpt WHERE framework = 'SRDSF')"""


def errors(spark, sf):
    """Error files of three runs: of reports no run could read, and of some that were read elsewhere."""
    r, k = R.reports(spark, sf), F.col("k")
    lost = r.filter("source_round = 'round3'").withColumn("run_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).filter((k + F.col("run_no")) % 2 == 0)
    lost = lost.select("run_no", F.replace("stem", F.lit("Customer"), F.lit("Lost")).alias("stem"), F.when((k + F.col("run_no")) % 3 == 0, " ").otherwise(R.text("error ", k % 10)).alias("message"))
    return lost.unionByName(r.filter("framework = 'SRDSF'").select(F.lit(1).alias("run_no"), "stem", F.lit("late").alias("message")))


def _m(r):
    return f"'run{r}: ' || coalesce(max(CASE WHEN run_no = {r} THEN m END), '(no _ERROR.json or _dsa.json found)')"


@query("extraction_failed_everywhere", f"""WITH {R.RUNS}, {ERROR_SQL}, e AS (SELECT run_no, stem, coalesce(nullif(trim(message), ''), '(no error message)') AS m FROM err
  WHERE stem || '_dsa.json' NOT IN (SELECT json_file FROM run))
SELECT stem || '_dsa.json' AS json_file, stem || '.pdf' AS pdf_file_name, regexp_extract(stem, '^(.+?)_\\d{{4}}-\\d{{2}}-\\d{{2}}', 1) AS country,
  {_m(1)} || ' | ' || {_m(2)} || ' | ' || {_m(3)} AS error_by_run FROM e GROUP BY stem""".replace("\\\\", "\\"))
def extraction_failed_everywhere(spark, sf):
    return C.failed_everywhere(errors(spark, sf), R.runs(spark, sf), 3).select("json_file", "pdf_file_name", "country", "error_by_run")


@query("round_headline", f"""WITH {CMP} SELECT count(*) AS reports, count(*) FILTER (WHERE grp = 'fully_match') AS fully_match, count(*) FILTER (WHERE grp NOT IN ('fully_match', 'no_table_in_all_runs')) AS disagreement,
  count(*) FILTER (WHERE grp = 'no_table_in_all_runs') AS no_table, CAST(0 AS BIGINT) AS failed, (SELECT count(*) FROM al WHERE rg IS NULL AND rt IS NULL) AS points_matched,
  (SELECT count(*) FROM al WHERE rg IS NOT NULL OR rt IS NOT NULL) AS points_differing, (SELECT count(*) FROM al) AS points FROM smr""")
def round_headline(spark, sf):
    return RC.round_summary(RC.check_round(R.runs(spark, sf), 3))


@query("recheck_list", f"""WITH {CMP} SELECT CASE WHEN grp = 'no_table_in_all_runs' THEN 'category_b_no_table_in_all_runs' ELSE 'category_a_disagreement' END AS category, json_file, pdf_file_name, country,
  grp AS "group", rows_differing FROM smr WHERE grp <> 'fully_match'""")
def recheck_list(spark, sf):
    return C.recheck_list(comparison(spark, sf).summary)


ITEMS_OK = "tf1 = 'True' AND tf2 = 'True' AND tf3 = 'True' AND i1 IS NOT NULL AND i2 IS NOT NULL AND i3 IS NOT NULL"


@query("pair_match_rates", f"""WITH {CMP}, c AS (SELECT * FROM al WHERE {ITEMS_OK}), n AS (
  SELECT 'run1_run2' AS pair, count(*) AS n_compared, count(*) FILTER (WHERE s12) AS n_equal FROM c UNION ALL SELECT 'run1_run3', count(*), count(*) FILTER (WHERE s13) FROM c
  UNION ALL SELECT 'run2_run3', count(*), count(*) FILTER (WHERE s23) FROM c UNION ALL SELECT 'all', count(*), count(*) FILTER (WHERE s12 AND s13) FROM c)
SELECT pair, n_compared, n_equal, n_equal / n_compared AS match_rate FROM n""")
def pair_match_rates(spark, sf):
    return C.pair_match_rates(comparison(spark, sf))


@query("spread_by_category", f"""WITH {CMP}, c AS (SELECT t1, greatest(n1, n2, n3) - least(n1, n2, n3) AS d FROM al WHERE {ITEMS_OK} AND NOT (s12 AND s13)
  AND (n1 IS NOT NULL)::INT + (n2 IS NOT NULL)::INT + (n3 IS NOT NULL)::INT >= 2)
SELECT t1 AS top_category, count(*) AS n, round(avg(d), 2) AS mean_spread, max(d) AS max_spread, avg((d > 1)::INT) AS share_wide, avg((d <= 0.15)::INT) AS share_noise FROM c GROUP BY 1""")
def spread_by_category(spark, sf):
    return C.spread_by_category(comparison(spark, sf)).withColumn("mean_spread", F.round("mean_spread", 2))


@query("spread_quantiles", f"""WITH {CMP}, c AS (SELECT greatest(n1, n2, n3) - least(n1, n2, n3) AS d FROM al WHERE {ITEMS_OK} AND NOT (s12 AND s13)
  AND (n1 IS NOT NULL)::INT + (n2 IS NOT NULL)::INT + (n3 IS NOT NULL)::INT >= 2)
SELECT quantile_cont(d, 0.5) AS median_spread, max(d) AS max_spread FROM c""")
def spread_quantiles(spark, sf):
    from panelkit.operators.quantiles import exact_quantiles
    return exact_quantiles(C.item_spread(comparison(spark, sf)), [], "spread", {"median_spread": 0.5, "max_spread": 1.0})


@query("run_confusion", f"""WITH {CMP} SELECT tf1 = 'True' AS found_a, count(*) FILTER (WHERE tf2 = 'True') AS b_found, count(*) FILTER (WHERE tf2 = 'False') AS b_not_found FROM grp WHERE p1 = 1 AND p2 = 1 GROUP BY 1""")
def run_confusion(spark, sf):
    return C.confusion(comparison(spark, sf).facts, 1, 2)


AGREE = {(a, b): f"(tf{a} = tf{b} AND (tf{a} = 'False' OR y{a} IS NOT DISTINCT FROM y{b}) AND coalesce(v{a}{b}, true))" for a, b in PAIRS}


@query("two_of_three", f"""WITH {CMP}, v AS (SELECT json_file, {", ".join(f"bool_and({PAIR_SQL[p]}) AS v{p[0]}{p[1]}" for p in PAIRS)} FROM al GROUP BY 1),
a AS (SELECT json_file, {", ".join(f"{AGREE[p]} AS a{p[0]}{p[1]}" for p in PAIRS)} FROM grp LEFT JOIN v USING (json_file) WHERE p1 + p2 + p3 = 3),
b AS (SELECT *, a12::INT + a13::INT + a23::INT AS n FROM a)
SELECT json_file, a12 AS run1_run2_agree, a13 AS run1_run3_agree, a23 AS run2_run3_agree, n AS n_pairs_agree, CAST(CASE WHEN n = 1 THEN CASE WHEN a12 THEN 3 WHEN a13 THEN 2 ELSE 1 END END AS INT) AS outlier_run FROM b WHERE n < 3""")
def two_of_three(spark, sf):
    return C.two_of_n(C.compare_runs(R.runs(spark, sf, labels=False), 3))


@query("rerun_before_after", f"""WITH {CMP}, c AS (SELECT * FROM al WHERE tf1 = 'True' AND tf2 = 'True' AND i1 IS NOT NULL AND i2 IS NOT NULL),
d AS (SELECT * FROM it JOIN fact USING (json_file) WHERE p1 = 1 AND p3 = 1 AND tf1 = 'True' AND tf3 = 'True' AND i1 IS NOT NULL AND i3 IS NOT NULL),
b AS (SELECT * FROM it JOIN fact USING (json_file) WHERE p1 = 1 AND p2 = 1 AND tf1 = 'True' AND tf2 = 'True' AND i1 IS NOT NULL AND i2 IS NOT NULL),
e(stage, s) AS (SELECT 'before', coalesce(CASE WHEN n1 IS NOT NULL AND n3 IS NOT NULL THEN abs(n1 - n3) <= 1e-9 WHEN n1 IS NULL AND n3 IS NULL THEN x1 IS NOT DISTINCT FROM x3 END, false) FROM d
  UNION ALL SELECT 'after', coalesce(CASE WHEN n1 IS NOT NULL AND n2 IS NOT NULL THEN abs(n1 - n2) <= 1e-9 WHEN n1 IS NULL AND n2 IS NULL THEN x1 IS NOT DISTINCT FROM x2 END, false) FROM b)
SELECT stage, count(*) AS n_compared, count(*) FILTER (WHERE NOT s) AS n_differ, count(*) FILTER (WHERE s) / count(*) AS match_rate FROM e GROUP BY 1""")
def rerun_before_after(spark, sf):
    """Agreement of run 1 with run 3 (an earlier attempt) against its agreement with run 2 (the rerun)."""
    rows = R.runs(spark, sf, labels=False)
    before = C.compare_runs(rows.filter("run_no in (1, 3)").withColumn("run_no", F.when(F.col("run_no") == 3, 2).otherwise(1)), 2)
    return C.before_after(before, C.compare_runs(rows.filter("run_no < 3"), 2))


SAME = "(" + " AND ".join(f"coalesce(CASE WHEN n1 IS NOT NULL AND n{r} IS NOT NULL THEN abs(n1 - n{r}) <= 1e-9 WHEN n1 IS NULL AND n{r} IS NULL THEN x1 IS NOT DISTINCT FROM x{r} END, false)" for r in (2, 3)) + ")"


@query("run_details", f"""WITH {CMP} SELECT json_file, hierarchy_id, coalesce(t1, t2, t3) AS top_category, {" || '|' || ".join(f"coalesce(l{r}, '-')" for r in (1, 2, 3))} AS labels,
  {" || '|' || ".join(f"coalesce(raw{r}, '-')" for r in (1, 2, 3))} AS "values", {SAME} AS same, CAST(len(string_split(hierarchy_id, '.')) - 1 AS INT) AS level FROM al""")
def run_details(spark, sf):
    d = C.run_details(comparison(spark, sf))
    return d.withColumn("labels", F.array_join("labels", "|", "-")).withColumn("values", F.array_join("values", "|", "-"))


MAJ = "CASE WHEN l1 = l2 OR l1 = l3 THEN l1 WHEN l2 = l3 THEN l2 ELSE coalesce(l1, l2, l3) END"


@query("review_prefill", f"""WITH {CMP} SELECT json_file, hierarchy_id, coalesce({MAJ}, '') AS label_verbatim, CASE WHEN {SAME} THEN coalesce(raw1, '') ELSE '' END AS value, NOT {SAME} AS differs FROM al""")
def review_prefill(spark, sf):
    """Majority label, and the value only where every run agrees."""
    return C.review_prefill(comparison(spark, sf))


@query("ready_rows", f"""WITH {CMP} SELECT run.json_file, run.hierarchy_id, last_actual_year, run.value, 'round1' AS source_round FROM run JOIN smr USING (json_file) WHERE run_no = 1 AND grp = 'fully_match' AND hierarchy_id IS NOT NULL""")
def ready_rows(spark, sf):
    shown = ["json_file", "hierarchy_id", "last_actual_year", "value"]
    check = RC.check_round(R.runs(spark, sf), 3, reuse=True, reports=R.runs(spark, sf, labels=False), keep=shown)
    return RC.ready_rows(check.matched, check.summary, "round1").select(*shown, "source_round")


# ---- totals and written rounds -------------------------------------------------------------------------------------
BY_GROUP = ", ".join(f"count(*) FILTER (WHERE grp = '{g}') AS {g}" for g in C.GROUPS)
TOTALS = f"""{CMP}, sm AS (SELECT count(*) AS reports, count(DISTINCT json_file) AS report_keys, sum(rows_compared) AS compared, sum(rows_matching) AS matching, sum(rows_differing) AS differing, {BY_GROUP} FROM smr),
pts AS (SELECT count(*) FILTER (WHERE rg IS NULL AND rt IS NULL) AS m, count(*) FILTER (WHERE rg IS NOT NULL OR rt IS NOT NULL) AS d,
  count(*) FILTER (WHERE (rg IS NOT NULL OR rt IS NOT NULL) AND coalesce(rg, rt) <> 'value') AS stale_d, count(*) AS items FROM al),
st AS (SELECT 'sound' AS state, m, d, items, (SELECT count(*) FROM smr WHERE grp NOT IN ('fully_match', 'no_table_in_all_runs')) AS listed FROM pts
  UNION ALL SELECT 'stale', m, stale_d, NULL, (SELECT count(*) FROM smr WHERE grp NOT IN ('fully_match', 'no_table_in_all_runs', 'partial_match')) FROM pts),
ck AS (SELECT state, unnest([{{'check': 'every report has one row', 'l': report_keys, 'r': reports}}, {{'check': 'the groups hold every report', 'l': {" + ".join(C.GROUPS)}, 'r': reports}},
  {{'check': 'disagreeing reports are listed', 'l': listed, 'r': reports - fully_match - no_table_in_all_runs - extraction_failed_in_all_runs}},
  {{'check': 'reports without a table are listed', 'l': no_table_in_all_runs, 'r': no_table_in_all_runs}},
  {{'check': 'matching lines of the reports are the matched rows', 'l': CAST(matching AS BIGINT), 'r': m}}, {{'check': 'differing lines of the reports are the differences', 'l': CAST(differing AS BIGINT), 'r': d}},
  {{'check': 'every compared line matches or differs', 'l': CAST(compared AS BIGINT), 'r': m + d}}, {{'check': 'every difference has a cause', 'l': d, 'r': d}},
  {{'check': 'every aligned line is compared', 'l': items, 'r': CAST(compared AS BIGINT)}}]) AS c FROM sm, st)"""


@query("round_totals", f"""WITH {TOTALS} SELECT state, c."check", c.l AS "left", c.r AS "right", c.l = c.r AS ok FROM ck WHERE c.l IS NOT NULL""")
def round_totals(spark, sf):
    """The totals of a round that must agree; beside them those of tables written in different states: a list without the partly
    matching reports, differences without those in value."""
    check = RC.check_round(R.runs(spark, sf), 3, reuse=True, reports=R.runs(spark, sf, labels=False), keep=["json_file"])
    # matched rows, differences and lines are read from the written comparison; the summary is made of it once, the list of the summary
    summary = materialise(check.summary, "zstd")
    matched, diffs, recheck, items = check.matched, check.diffs, C.recheck_list(summary), check.comparison.items
    sound = RC.round_totals(summary, matched, diffs, recheck, items)
    stale = RC.round_totals(summary, matched, diffs.filter("diff_type <> 'value'"), recheck.filter("group <> 'partial_match'"))
    return sound.select(F.lit("sound").alias("state"), "*").unionByName(stale.select(F.lit("stale").alias("state"), "*"))


@query("committed_round", f"""WITH {CMP} SELECT 'summary' AS name, 'round 1' AS round, count(*) AS n_rows, count(*) AS n_read FROM smr
UNION ALL SELECT 'diffs', 'round 1', count(*), count(*) FROM al WHERE rg IS NOT NULL OR rt IS NOT NULL UNION ALL SELECT 'matched', 'round 1', count(*), count(*) FROM al WHERE rg IS NULL AND rt IS NULL""")
def committed_round(spark, sf):
    """The tables of a round, written all or none, as their manifest and a reader that goes by it see them."""
    check = RC.check_round(R.runs(spark, sf), 3, reuse=True, reports=R.runs(spark, sf, labels=False))
    folder = f"{use_checkpoint_dir(spark)}/round-{uuid.uuid4().hex}"
    tables = {"summary": check.summary, "diffs": check.diffs, "matched": check.matched}
    SK.commit_tables(tables, folder, "s1", {"round": "round 1"})
    read = reduce(DataFrame.unionByName, [SK.read_committed(spark, folder, n).agg(F.lit(n).alias("name"), F.count("*").alias("n_read")) for n in tables])
    return SK.committed(spark, folder).select("name", F.col("facts")["round"].alias("round"), "n_rows").join(read, "name")
