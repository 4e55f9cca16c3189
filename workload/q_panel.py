"""Panel building, layout and review checks, answers and second readings, file inventories."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit import schema as L
from panelkit.functions.files import base_name
from panelkit.operators import coverage as C, quality as Q
from panelkit.operators.gaps import AUDIT
from panelkit.operators.tree import tree_type
from panelkit.plans import gap_fill as P, panel_build as B, panel_store as PS
from panelkit.session import materialise, use_checkpoint_dir
from panelkit.sources import inventory as V
from workload import roles as R
from workload.registry import query

# ---- merging ---------------------------------------------------------------------------------------------------


def parts(spark, sf, reuse=False):
    """(previous panel, new rows of rounds 1 and 2, dropped reports): the reports of rounds 1 and 2 are on both sides
    where the previous panel has them. reuse: both sides are read from rows that are made once."""
    rows = R.long_rows(spark, sf).filter("hierarchy_id is not null")
    rows = materialise(L.present_columns(rows, L.PREGAP_LAYOUT), "zstd") if reuse else rows
    old = rows.filter("framework <> 'MAC_DSA'").withColumn("value", R.text("old ", F.col("value")))
    r1 = L.to_pregap(rows.filter("source_round = 'round1'"), "round1")
    r2 = L.to_pregap(rows.filter("source_round = 'round2'"), "round2")
    return old, [r1, r2], R.reports(spark, sf).filter("framework = 'SRDSF' and source_round = 'round2'").select("json_file")


MERGE = f"""{R.LONG}, itmr AS (SELECT * FROM rws WHERE hierarchy_id IS NOT NULL AND NOT (framework = 'SRDSF' AND source_round = 'round2')), nw AS (SELECT * FROM itmr WHERE source_round IN ('round1', 'round2')),
od AS (SELECT * FROM itmr WHERE framework <> 'MAC_DSA' AND source_round <> 'gapfill')"""
M_COLS = "json_file, hierarchy_id, last_actual_year, {v} AS value, source_round, '{o}' AS update_origin"


@query("build_panel_merge", f"""WITH {MERGE} SELECT {M_COLS.format(v='value', o='new')} FROM nw UNION ALL SELECT {M_COLS.format(v="'old ' || value", o='previous')} FROM od WHERE json_file NOT IN (SELECT json_file FROM nw)""")
def build_panel_merge(spark, sf):
    """Previous rows without gap fill + new rows; new rows replace a report that is on both sides; dropped reports leave."""
    old, new, dropped = parts(spark, sf)
    return B.build_panel(old, new, dropped).rows.select("json_file", "hierarchy_id", "last_actual_year", "value", "source_round", "update_origin")


@query("build_panel_keep_previous", f"""WITH {MERGE} SELECT {M_COLS.format(v='value', o='new')} FROM nw WHERE json_file NOT IN (SELECT json_file FROM od) UNION ALL SELECT {M_COLS.format(v="'old ' || value", o='previous')} FROM od""")
def build_panel_keep_previous(spark, sf):
    old, new, dropped = parts(spark, sf)
    return B.build_panel(old, new, dropped, replace=False).rows.select("json_file", "hierarchy_id", "last_actual_year", "value", "source_round", "update_origin")


def bucketed(spark, panel, buckets=16):
    """The panel laid out in buckets, in a folder of its own."""
    folder = f"{use_checkpoint_dir(spark)}/panel-{uuid.uuid4().hex}"
    PS.create(panel, folder, buckets)
    return folder


@query("panel_update_in_buckets", f"""WITH {MERGE} SELECT {M_COLS.format(v='value', o='new')} FROM nw UNION ALL SELECT {M_COLS.format(v="'old ' || value", o='previous')} FROM od WHERE json_file NOT IN (SELECT json_file FROM nw)""")
def panel_update_in_buckets(spark, sf):
    """The merge of `build_panel_merge` on a panel in buckets: laid out without its gap fill, then updated where the reports are."""
    old, new, dropped = parts(spark, sf, reuse=True)
    folder = bucketed(spark, B.build_panel(old, []).rows)
    PS.update(spark, folder, new, dropped, stamp="u1")
    return PS.read(spark, folder).select("json_file", "hierarchy_id", "last_actual_year", "value", "source_round", "update_origin")


@query("panel_append_in_buckets", f"""WITH {R.LONG} SELECT json_file, hierarchy_id, value, source_round, gapfill_run FROM rws WHERE framework <> 'MAC_DSA'
UNION ALL SELECT json_file, hierarchy_id, value, 'gapfill', 'r9' FROM rws WHERE framework = 'MAC_DSA'""")
def panel_append_in_buckets(spark, sf):
    """Lines of one framework appended as a gap-fill run, read with the panel they were appended to."""
    rows = R.long_rows(spark, sf)
    folder = bucketed(spark, L.to_panel(rows.filter("framework <> 'MAC_DSA'")))
    PS.append(spark, folder, P.final_rows(rows.filter("framework = 'MAC_DSA'"), "r9"), "r9")
    return PS.read(spark, folder).select("json_file", "hierarchy_id", "value", "source_round", "gapfill_run")


@query("duplicate_reports", f"""WITH {MERGE.replace(" AND NOT (framework = 'SRDSF' AND source_round = 'round2')", '')} SELECT json_file FROM nw INTERSECT SELECT json_file FROM od""")
def duplicate_reports(spark, sf):
    """Reports that are in the previous panel and among the new rows."""
    old, new, _ = parts(spark, sf)
    return B.build_panel(old, new).duplicates


@query("ready_overview", f"""WITH {R.LONG} SELECT source_round AS source, count(*) AS rows, count(DISTINCT json_file) AS reports FROM rws WHERE source_round IN ('round1', 'round2', 'round3') GROUP BY 1""")
def ready_overview(spark, sf):
    rows = R.long_rows(spark, sf)
    return C.overview({s: rows.filter(F.col("source_round") == s) for s in ("round1", "round2", "round3")}).select("source", "rows", "reports")


@query("ready_overview_with_review", f"""WITH {R.LONG}, st AS (SELECT count(*) AS total, count(*) FILTER (WHERE k % 6 IN (0, 1, 2, 3, 4)) AS reviewed FROM rpt WHERE source_round = 'round3'),
r(source) AS (VALUES ('round1'), ('round2'), ('round3'), ('round4'))
SELECT source, count(json_file) AS rows, count(DISTINCT json_file) AS reports, CASE WHEN source = 'round3' THEN any_value(st.reviewed) END AS reviewed, CASE WHEN source = 'round3' THEN any_value(st.total) END AS total
FROM r LEFT JOIN rws ON source_round = source, st GROUP BY source""")
def ready_overview_with_review(spark, sf):
    """Rows and reports that are ready per source, also of one that has none, and how far the review is."""
    rows = R.long_rows(spark, sf)
    queue = R.reports(spark, sf).filter("source_round = 'round3'").select(F.coalesce(review_state(), F.lit("todo")).alias("status"))
    return C.overview({s: rows.filter(F.col("source_round") == s) for s in ("round1", "round2", "round3", "round4")}, queue)


RAW = """raw AS (SELECT l_orderkey AS k, 'r' || l_orderkey AS json_file, CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN '7.' || l_linenumber WHEN l_suppkey % 3 = 0 THEN l_linenumber || '.' || (l_suppkey % 4 + 1)
  ELSE CAST(l_linenumber AS VARCHAR) END AS hid, l_linenumber AS ln, l_returnflag AS rf, l_partkey AS pk, CAST(year(l_shipdate) AS VARCHAR) AS yr, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS q FROM lineitem)"""


def raw_items(spark, sf):
    """Line items before aggregation: repeated ids, malformed ids, wrong categories."""
    k, s, ln = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber")
    hid = R.case(ln.cast("string"), (k % 31 == 0, F.lit(None).cast("string")), (k % 29 == 0, R.text("7.", ln)), (s % 3 == 0, R.text(ln, ".", s % 4 + 1)))
    top = R.case(F.element_at(F.array(*[F.lit(c) for c in L.I.CATEGORIES], F.lit("none")), ln), (F.col("l_partkey") % 50 == 0, F.lit("residual")))
    return R.table(spark, sf, "lineitem").select(R.text("r", k).alias("json_file"), hid.alias("hierarchy_id"), top.alias("top_category"),
                                                 F.year(F.to_date("l_shipdate")).cast("string").alias("year"), F.col("l_quantity").cast("int").cast("string").alias("value"), k.alias("k"),
                                                 F.col("l_partkey").alias("pk"))


TOPS = "CASE WHEN pk % 50 = 0 THEN 'residual' ELSE ['" + "', '".join(L.I.CATEGORIES) + "', 'none'][ln] END"


@query("layout_check", f"""WITH {RAW}, v AS (SELECT *, coalesce(regexp_matches(hid, '^[1-6](\\.\\d+)*$'), false) AS ok, {TOPS} AS top FROM raw),
d AS (SELECT count(*) AS n FROM v GROUP BY json_file, yr, hid HAVING count(*) > 1)
SELECT 'bad_hierarchy_id' AS problem, count(*) FILTER (WHERE NOT ok) AS n_rows FROM v UNION ALL SELECT 'category_mismatch', count(*) FILTER (WHERE ok AND top IS DISTINCT FROM {R.CATEGORY_OF.format('hid')}) FROM v
UNION ALL SELECT 'duplicate_key', CAST(coalesce(sum(n), 0) AS BIGINT) FROM d""".replace("\\\\", "\\"))
def layout_check(spark, sf):
    return L.layout_problems(raw_items(spark, sf), "year")


@query("duplicate_items", f"WITH {RAW} SELECT json_file, hid AS hierarchy_id, count(*) AS n_rows FROM raw GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_items(spark, sf):
    return L.duplicate_items(raw_items(spark, sf), ["json_file", "hierarchy_id"])


@query("panel_layout", f"""WITH {R.LONG}, t AS (SELECT json_file, hierarchy_id, CASE WHEN k % 4 = 0 THEN ' ' WHEN k % 4 = 1 THEN obs || '.0' END AS yr, last_actual_year AS l, level || '.0' AS lv FROM rws)
SELECT json_file, hierarchy_id, coalesce(nullif(trim(regexp_replace(yr, '\\.0$', '')), ''), l) AS year, regexp_replace(lv, '\\.0$', '') AS level, CAST(NULL AS VARCHAR) AS framework FROM t""".replace("\\\\", "\\"))
def panel_layout(spark, sf):
    """Rows brought to the panel layout: own year before the last actual one, whole numbers without a fraction."""
    k = F.col("k")
    rows = R.long_rows(spark, sf).withColumn("year", R.case(F.lit(None).cast("string"), (k % 4 == 0, F.lit(" ")), (k % 4 == 1, R.text(F.col("obs"), ".0")))) \
        .withColumn("level", R.text(F.col("level"), ".0")).drop("framework")
    return L.to_panel(rows).withColumn("level", L.N.int_text("level")).select("json_file", "hierarchy_id", "year", "level", "framework")


# ---- review ----------------------------------------------------------------------------------------------------
STATE = "CASE CAST(k % 6 AS INT) WHEN 0 THEN 'reviewed' WHEN 1 THEN 'no_table' WHEN 2 THEN 'skipped' WHEN 3 THEN 'dropped' WHEN 4 THEN 'reviewed' END"


def review_state():
    k = F.col("k")
    return R.case(F.lit(None).cast("string"), (k % 6 == 0, F.lit("reviewed")), (k % 6 == 1, F.lit("no_table")), (k % 6 == 2, F.lit("skipped")), (k % 6 == 3, F.lit("dropped")), (k % 6 == 4, F.lit("reviewed")))


@query("review_validation", f"""WITH {RAW}, rv AS (SELECT o_orderkey AS k, 'r' || o_orderkey AS json_file, CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE '2015' END AS y FROM orders WHERE {STATE.replace('k %', 'o_orderkey %')} = 'reviewed'),
r AS (SELECT json_file, coalesce(hid, '') AS h, CASE WHEN pk % 17 = 0 THEN 'abc' ELSE q END AS v FROM raw JOIN rv USING (json_file)), vld AS (SELECT * FROM r WHERE regexp_matches(h, '^[1-6](\\.\\d+)*$')),
p AS (SELECT json_file, h, regexp_replace(h, '\\.[^.]*$', '') AS par FROM vld WHERE contains(h, '.'))
SELECT json_file, 'no_year' AS code, NULL AS hierarchy_id FROM rv WHERE trim(y) = '' UNION ALL SELECT json_file, 'bad_id', h FROM r WHERE NOT regexp_matches(h, '^[1-6](\\.\\d+)*$')
UNION ALL SELECT json_file, 'duplicate_id', h FROM vld GROUP BY 1, 3 HAVING count(*) > 1 UNION ALL SELECT json_file, 'not_a_number', h FROM vld WHERE v = 'abc'
UNION ALL SELECT json_file, 'no_parent', h FROM p WHERE NOT EXISTS (SELECT 1 FROM vld WHERE vld.json_file = p.json_file AND vld.h = p.par) UNION ALL SELECT json_file, 'no_rows', NULL FROM rv WHERE json_file NOT IN (SELECT json_file FROM vld)""".replace("\\\\", "\\"))
def review_validation(spark, sf):
    """Problems of rows a person entered, one row each."""
    o = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    reviews = o.select(R.text("r", F.col("k")).alias("json_file"), review_state().alias("status"), F.when(F.col("k") % 9 == 0, " ").otherwise("2015").alias("last_actual_year"))
    rows = raw_items(spark, sf).withColumn("value", F.when(F.col("pk") % 17 == 0, "abc").otherwise(F.col("value"))).withColumn("label_verbatim", F.lit(""))
    return Q.review_problems(reviews, rows)


@query("reviewed_rows", f"""WITH {R.LONG}, d AS (SELECT * FROM rws WHERE {STATE} = 'reviewed' AND hierarchy_id IS NOT NULL)
SELECT d.json_file, d.country, last_actual_year, CASE WHEN k % 5 = 0 THEN 'col ' || k ELSE last_actual_year END AS actual_column_label, d.hierarchy_id, {R.CATEGORY_OF.format('d.hierarchy_id')} AS top_category, CASE WHEN contains(d.hierarchy_id, '.') THEN '1' ELSE '0' END AS level,
  p.lv AS parent_label, d.label_verbatim, d.value, 'human_review' AS extraction_method, 'note ' || k AS extraction_notes, CAST(NULL AS VARCHAR) AS confidence, 'round3' AS source_round
FROM d LEFT JOIN (SELECT json_file AS pj, hierarchy_id AS ph, label_verbatim AS lv FROM d) p ON pj = d.json_file AND ph = regexp_replace(d.hierarchy_id, '\\.[^.]*$', '') AND contains(d.hierarchy_id, '.')""".replace("\\\\", "\\"))
def reviewed_rows(spark, sf):
    """Reviewed rows in the panel's layout; the parent's label comes from the same report."""
    r = R.reports(spark, sf).select("*", review_state().alias("status"), F.when(F.col("k") % 5 == 0, R.text("col ", F.col("k"))).otherwise(" ").alias("actual_column_label"), R.text("note ", F.col("k")).alias("note"))
    items = R.long_rows(spark, sf).filter(review_state() == "reviewed").filter("hierarchy_id is not null").select("json_file", "hierarchy_id", "label_verbatim", "value")
    return B.reviewed_rows(r.withColumn("confidence", F.lit("high")), items).select(
        "json_file", "country", "last_actual_year", "actual_column_label", "hierarchy_id", "top_category", "level", "parent_label", "label_verbatim", "value", "extraction_method", "extraction_notes", "confidence", "source_round")


@query("review_queue_counts", f"""WITH {R.REPORTS}, q AS (SELECT coalesce({STATE}, 'todo') AS s FROM rpt WHERE table_found = 'False' OR k % 2 = 0) SELECT status, (SELECT count(*) FROM q WHERE s = status) AS n FROM (VALUES ('todo'), ('reviewed'), ('no_table'), ('skipped'), ('dropped')) t(status)""")
def review_queue_counts(spark, sf):
    r = R.reports(spark, sf)
    group = F.when(F.col("table_found") == "False", "no_table_in_all_runs").when(F.col("k") % 2 == 0, "partial_match").otherwise("fully_match")
    summary = r.select("json_file", "pdf_file_name", "country", group.alias("group"), F.lit(1).alias("rows_differing"))
    reviews = r.select("json_file", review_state().alias("status")).filter("status is not null")
    return Q.queue_counts(Q.review_queue(summary, reviews))


# ---- answers, self-check, second reading -------------------------------------------------------------------------
def sources(spark, sf):
    """A source record per order: chosen year, label, status, header audit with one, none or two selected columns."""
    o = R.reports(spark, sf).select("k", "obs", "stem")
    k, obs = F.col("k"), F.col("obs")

    def cell(pos, year, status, selected):
        return F.struct(F.lit(pos).cast("string").alias("position"), year.cast("string").alias("year_label"), F.lit(None).cast("string").alias("group_label"), status.alias("status"),
                        F.lit(None).cast("string").alias("status_basis"), selected.alias("selected"))
    late = F.when(k % 9 == 0, "Actual").otherwise("projection")
    prior = F.when(k % 19 == 0, "estimate").otherwise("actual")
    cols = F.array(cell(1, obs - 1, prior, k % 11 == 0), cell(2, obs, F.when(k % 13 == 0, "Estimate").when(k % 17 == 0, "historical").otherwise("actual"), k % 7 > 0), cell(3, obs + 1, late, F.lit(False)))
    audit = F.struct(F.when(k % 23 > 0, cols).alias("columns"), F.when(k % 5 == 0, obs - 1).otherwise(obs).cast("string").alias("selected_year"), F.lit(None).cast("string").alias("selection_reason")).cast(AUDIT)
    header = R.case(R.text("Actual ", obs), (k % 14 == 0, R.text("Proj. ", obs)), (k % 14 == 1, R.text("prel ", obs)))
    return o.select("k", "obs", F.struct(F.when(k % 29 > 0, obs.cast("string")).alias("last_actual_year"), R.text(F.when(k % 8 == 0, obs + 1).otherwise(obs), " col").alias("actual_column_label"),
                    F.when(k % 12 == 0, "projection").when(k % 12 == 1, None).otherwise("Actual ").alias("actual_column_status"), header.alias("actual_column_header_verbatim"), audit.alias("column_header_audit")).alias("source"))


SELF = """s AS (SELECT k, obs, k % 23 > 0 AS has_cols, CASE WHEN k % 23 = 0 THEN 0 ELSE (k % 11 = 0)::INT + (k % 7 > 0)::INT END AS nsel, CASE WHEN k % 7 > 0 THEN obs ELSE obs - 1 END AS cy,
  CASE WHEN k % 7 > 0 THEN CASE WHEN k % 13 = 0 THEN 'estimate' WHEN k % 17 = 0 THEN 'historical' ELSE 'actual' END ELSE CASE WHEN k % 19 = 0 THEN 'estimate' ELSE 'actual' END END AS cs, CASE WHEN k % 7 > 0 THEN 2 ELSE 1 END AS pos,
  CASE WHEN k % 29 > 0 THEN obs END AS yr, CASE WHEN k % 8 = 0 THEN obs + 1 ELSE obs END AS ly, CASE WHEN k % 5 = 0 THEN obs - 1 ELSE obs END AS sy FROM rpt),
chk AS (SELECT *, array_to_string(list_filter([CASE WHEN yr IS NULL THEN 'no_year' END, CASE WHEN yr <> ly THEN 'year_label' END, CASE WHEN k % 12 IN (0, 1) THEN 'status' END, CASE WHEN k % 14 IN (0, 1) THEN 'header_text' END,
  CASE WHEN nsel <> 1 THEN 'not_one_selected' END, CASE WHEN nsel = 1 AND cs = 'estimate' THEN 'audit_status' END, CASE WHEN nsel = 1 AND cy <> yr THEN 'audit_year' END, CASE WHEN nsel = 1 AND sy <> yr THEN 'selected_year' END,
  CASE WHEN nsel = 1 AND (k % 9 = 0 OR (pos = 1 AND k % 13 <> 0)) THEN 'later_column' END], lambda x : x IS NOT NULL), '|') AS codes FROM s)"""


@query("self_check", f"WITH {R.REPORTS}, {SELF} SELECT k, codes FROM chk")
def self_check(spark, sf):
    """Codes of what is wrong with a chosen year, its label, header and audit."""
    return sources(spark, sf).withColumn("p", Q.selection_problems("source")).select("k", F.array_join(F.transform("p", lambda x: x["code"]), "|").alias("codes"))


@query("second_reading", f"""WITH {R.REPORTS}, {SELF}, a AS (SELECT *, codes <> '' AS bad, k % 3 > 0 AS done, CASE WHEN k % 4 = 0 THEN obs + 1 ELSE obs END AS ay, CASE WHEN k % 10 = 0 THEN 'projection' ELSE 'actual' END AS ast FROM chk),
b AS (SELECT *, coalesce(ay = yr AND ast = 'actual', false) AS conf FROM a)
SELECT k, CASE WHEN NOT done THEN CASE WHEN bad THEN 'manual_review' ELSE 'accepted' END WHEN conf THEN CASE WHEN bad THEN 'accepted_with_warning' ELSE 'accepted' END ELSE 'manual_review' END AS status,
  CASE WHEN NOT done AND bad THEN 'verification_not_completed' WHEN conf AND done AND bad THEN 'same_year_confirmed' WHEN done AND NOT conf THEN CASE WHEN yr IS NOT NULL THEN 'other_year_selected' ELSE 'no_usable_first_year' END END AS code,
  CASE WHEN done THEN CAST(ay AS VARCHAR) END AS audited_year FROM b""")
def second_reading(spark, sf):
    """The first reading against an independent header audit."""
    k, obs = F.col("k"), F.col("obs")
    cols = F.array(F.struct(F.lit("1").alias("position"), F.when(k % 4 == 0, obs + 1).otherwise(obs).cast("string").alias("year_label"), F.lit(None).cast("string").alias("group_label"),
                            F.when(k % 10 == 0, "projection").otherwise("actual").alias("status"), F.lit(None).cast("string").alias("status_basis"), F.lit(True).alias("selected")))
    d = sources(spark, sf).withColumn("p", Q.selection_problems("source"))
    return d.withColumn("r", Q.reconcile(F.col("source.last_actual_year"), "p", cols, k % 3 > 0)).select("k", "r.*")


@query("numeric_reread", f"""WITH {R.LONG}, f AS (SELECT k, trim(regexp_replace(lower(label_verbatim), '[^a-z0-9]+', ' ', 'g')) AS key, arg_max(value, row_no) AS v FROM rws WHERE hierarchy_id IS NOT NULL GROUP BY 1, 2),
s AS (SELECT k, trim(regexp_replace(lower(label_verbatim), '[^a-z0-9]+', ' ', 'g')) AS key, CASE WHEN row_no % 9 = 0 THEN '1' ELSE value END AS v2 FROM rws WHERE hierarchy_id IS NOT NULL AND top_category <> 'residual')
SELECT k, count(*) AS rows_compared, count(*) FILTER (WHERE v IS DISTINCT FROM v2) AS disagreements, CASE WHEN count(*) < 3 OR count(*) FILTER (WHERE v IS DISTINCT FROM v2) > 0 THEN 'manual_review' ELSE 'passed' END AS status FROM s JOIN f USING (k, key) GROUP BY 1""")
def numeric_reread(spark, sf):
    """A second reading of the values: labels are matched loosely, differing values counted."""
    rows = R.long_rows(spark, sf).filter("hierarchy_id is not null")
    first = rows.select("k", "label_verbatim", "value", F.col("row_no").alias("ord"))
    second = rows.filter("top_category <> 'residual'").select("k", F.upper("label_verbatim").alias("label_verbatim"), F.when(F.col("row_no") % 9 == 0, "1").otherwise(F.col("value")).alias("value"))
    return Q.numeric_reread(first, second, "k").withColumn("status", Q.numeric_status(F.lit(9), F.lit(True), F.lit(True), "rows_compared", "disagreements"))


TREE6 = [("change_in_debt", 0), ("identified_flows", 1), ("primary_balance", 2), ("automatic_debt_dynamics", 3), ("other_identified_flows", 4), ("residual", 5)]


def target_tree():
    """Values that satisfy both identities for most keys, blank for every seventh."""
    k = F.col("k")
    v = {"primary_balance": k % 10, "automatic_debt_dynamics": k % 3, "other_identified_flows": F.lit(1)}
    v["identified_flows"] = v["primary_balance"] + v["automatic_debt_dynamics"] + v["other_identified_flows"] + F.when(k % 5 == 0, 2).otherwise(0)
    v["residual"] = k % 4
    v["change_in_debt"] = v["identified_flows"] + v["residual"] - F.when(k % 6 == 0, 3).otherwise(0)
    leaf = lambda c: F.struct(F.lit(c).alias("label_verbatim"), F.when(k % 7 > 0, v[c].cast("string")).alias("value"), F.lit(None).cast("array<variant>").alias("children")).alias(c)
    return F.struct(*[leaf(c) for c, _ in TREE6]).cast(tree_type([c for c, _ in TREE6]))


@query("identity_check", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE array_to_string(list_filter([CASE WHEN o_orderkey % 6 = 0 THEN 'identity_change' END, CASE WHEN o_orderkey % 5 = 0 THEN 'identity_flows' END], lambda x : x IS NOT NULL), '|') END AS codes FROM orders""")
def identity_check(spark, sf):
    o = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return o.select("k", F.array_join(F.transform(Q.identity_problems(target_tree()), lambda p: p["code"]), "|").alias("codes"))


@query("validate_answers", f"""WITH {R.REPORTS}, s AS (SELECT k, obs, k % 4 <> 3 AS ext, CASE WHEN k % 12 = 0 THEN 'projection' WHEN k % 12 = 1 THEN '' ELSE 'actual' END AS st, k % 8 = 0 AS badlabel, k % 14 IN (0, 1) AS hdr,
  CASE WHEN k % 23 = 0 THEN 0 ELSE 1 END AS nm, CASE WHEN k % 13 = 0 THEN 'estimate' WHEN k % 17 = 0 THEN 'historical' ELSE 'actual' END AS ms, k % 23 > 0 AND k % 19 = 0 AS mono, k % 7 = 0 AS nov FROM rpt),
e AS (SELECT *, list_filter([CASE WHEN st NOT IN ('actual') THEN 'status' END, CASE WHEN badlabel THEN 'label' END, CASE WHEN hdr THEN 'header_text' END, CASE WHEN nm = 0 THEN 'audit_missing' END, CASE WHEN nm = 1 AND ms = 'estimate' THEN 'audit_status' END,
  CASE WHEN mono THEN 'monotonic' END, CASE WHEN nov THEN 'no_values' END], lambda x : x IS NOT NULL) AS c FROM s)
SELECT k, CASE WHEN NOT ext THEN CASE WHEN k % 5 = 0 THEN 'year_not_in_table' ELSE 'not_extracted' END WHEN len(c) = 0 THEN 'resolved' WHEN len(list_filter(c, lambda x : x NOT IN ('audit_missing', 'audit_status'))) = 0 THEN 'needs_independent_audit' ELSE 'rejected_not_actual' END AS status,
  CASE WHEN ext THEN array_to_string(c, '|') ELSE '' END AS codes, CASE WHEN ext THEN (nm = 1 AND ms = 'historical' AND st = 'actual')::INT + CASE WHEN nov THEN 0 ELSE (k % 6 = 0)::INT + (k % 5 = 0)::INT END ELSE 0 END AS n_warnings FROM e""")
def validate_answers(spark, sf):
    """Status, error codes and number of warnings of one answer per report."""
    d, k, obs = sources(spark, sf), F.col("k"), F.col("obs")
    target = F.struct(obs.alias("target_year"), (k % 4 != 3).alias("extractable"), F.when(k % 5 == 0, "year_not_in_table").alias("not_extractable_reason"), F.col("source.actual_column_status").alias("column_status"),
                      F.when(k % 8 == 0, obs + 1).otherwise(obs).cast("string").alias("matched_year_label"), F.col("source.actual_column_header_verbatim").alias("column_header_verbatim"), target_tree().alias("decomposition"))
    d = d.withColumn("t", target).withColumn("v", Q.validate_target("t", F.col("source.column_header_audit.columns")))
    return d.select("k", "v.status", F.array_join(F.transform("v.errors", lambda e: e["code"]), "|").alias("codes"), F.size("v.warnings").alias("n_warnings"))


@query("audit_confirms", f"""WITH {R.REPORTS} SELECT k, k % 23 > 0 AND k % 13 <> 0 AND k % 19 <> 0 AS confirmed FROM rpt""")
def audit_confirms(spark, sf):
    return sources(spark, sf).select("k", Q.audit_confirms(F.col("source.column_header_audit.columns"), "obs")["confirmed"].alias("confirmed"))


@query("run_outcomes", f"""WITH {R.REPORTS}, o AS (SELECT k % 37 <> 0 AS ok, table_found = 'True' AS f, framework, k % 60 AS sec, manual_review_required = 'Yes' AS mr, CASE WHEN k % 2 = 0 THEN 'pages_unreadable' END AS why FROM rpt)
SELECT measure, CAST(NULL AS VARCHAR) AS item, CAST(n AS DOUBLE) AS n FROM (SELECT 'reports_processed' AS measure, count(*) AS n FROM o UNION ALL SELECT 'tables_extracted', count(*) FROM o WHERE ok AND f UNION ALL SELECT 'no_table_found', count(*) FROM o WHERE ok AND NOT f
  UNION ALL SELECT 'failures', count(*) FROM o WHERE NOT ok UNION ALL SELECT 'manual_review', count(*) FROM o WHERE ok AND mr UNION ALL SELECT 'average_seconds', round(avg(sec), 2) FROM o)
UNION ALL SELECT 'no_table_reason', coalesce(why, 'other'), CAST(count(*) AS DOUBLE) FROM o WHERE ok AND NOT f GROUP BY 2 UNION ALL SELECT 'method', framework, CAST(count(*) AS DOUBLE) FROM o WHERE ok GROUP BY 2""")
def run_outcomes(spark, sf):
    r, k = R.reports(spark, sf), F.col("k")
    return Q.run_outcomes(r.select(F.when(k % 37 == 0, "error").otherwise("ok").alias("status"), (F.col("table_found") == "True").alias("table_found"), F.when(k % 2 == 0, "pages_unreadable").alias("failure_reason"),
                                   F.col("framework").alias("extraction_method"), F.when(F.col("manual_review_required") == "Yes", "manual_review").otherwise("accepted").alias("validation_status"), (k % 60).alias("seconds")))


@query("template_items", f"""WITH {R.LONG}, n AS (SELECT count(DISTINCT json_file) AS t FROM rws WHERE hierarchy_id IS NOT NULL), c AS (SELECT hierarchy_id, count(DISTINCT json_file) AS n_reports FROM rws WHERE hierarchy_id IS NOT NULL GROUP BY 1),
l AS (SELECT hierarchy_id, label_verbatim AS label FROM (SELECT hierarchy_id, label_verbatim, count(*) AS c FROM rws GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY hierarchy_id ORDER BY c DESC, label_verbatim) = 1)
SELECT hierarchy_id, n_reports, label FROM c JOIN l USING (hierarchy_id), n WHERE n_reports >= 0.4 * t""")
def template_items(spark, sf):
    """Line items of at least 40 % of the reports with their most common label."""
    return Q.template_items(R.long_rows(spark, sf).filter("hierarchy_id is not null"), 0.4)


# ---- inventories of file names ---------------------------------------------------------------------------------------
def listing(spark, sf):
    """File paths as an inventory lists them, one or two per report."""
    r, k = R.reports(spark, sf), F.col("k")
    batch = R.text(F.col("pub_year") - F.col("pub_year") % 5, "s")
    name = F.when(k % 40 == 0, R.text("notes ", k, ".pdf")).otherwise(F.col("pdf_file_name"))
    two = F.when(k % 10 == 0, F.array(batch, F.lit("extra"))).otherwise(F.array(batch))
    f = r.select("k", "framework", "source_round", name.alias("name"), F.explode(two).alias("b")).withColumn("path", R.text("/data/in/", F.when(F.col("k") % 33 == 0, "").otherwise(R.text(F.col("b"), "/")), F.col("name")))
    return f.select("k", "framework", "source_round", "path", base_name("path").alias("name"), (F.col("k") % 1000).alias("size"), F.lit(None).cast("timestamp").alias("modified"))


LIST = f"""{R.REPORTS}, fl AS (SELECT k, country, pub_year, name, CASE WHEN k % 33 = 0 THEN '' ELSE b || '/' END || name AS rel, CASE WHEN k % 33 = 0 THEN name ELSE b END AS batch FROM (
  SELECT k, country, pub_year, CASE WHEN k % 40 = 0 THEN 'notes ' || k || '.pdf' ELSE pdf_file_name END AS name, unnest(CASE WHEN k % 10 = 0 THEN [(pub_year - pub_year % 5) || 's', 'extra'] ELSE [(pub_year - pub_year % 5) || 's'] END) AS b FROM rpt))"""


@query("document_inventory", f"""WITH {LIST} SELECT name AS pdf_file_name, min(batch) AS batch, any_value(lower(country)) AS entity_key, any_value(pub_year) AS year FROM fl WHERE k % 40 <> 0 GROUP BY 1""")
def document_inventory(spark, sf):
    """One row per document name with entity, batch and year; a name in two batches counts once."""
    return V.document_inventory(listing(spark, sf), "/data/in")[0].select("pdf_file_name", "batch", "entity_key", "year")


@query("unparsed_documents", f"""WITH {LIST} SELECT batch, '/data/in/' || rel AS path FROM fl WHERE k % 40 = 0""")
def unparsed_documents(spark, sf):
    return V.document_inventory(listing(spark, sf), "/data/in")[1]


@query("batch_file_counts", f"""WITH {LIST} SELECT CASE WHEN k % 33 <> 0 THEN batch END AS batch, count(*) AS n_files FROM fl GROUP BY 1""")
def batch_file_counts(spark, sf):
    return V.batch_counts(listing(spark, sf), "/data/in")


@query("report_key_setops", f"""WITH {LIST}, a AS (SELECT DISTINCT name FROM fl WHERE k IN (SELECT k FROM rpt WHERE framework <> 'SRDSF')), b AS (SELECT DISTINCT name FROM fl WHERE k IN (SELECT k FROM rpt WHERE source_round <> 'round1'))
SELECT name, 'both' AS found_in FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT name, 'only_a' FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT name, 'only_b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def report_key_setops(spark, sf):
    f = listing(spark, sf)
    return V.folder_difference(f.filter("framework <> 'SRDSF'"), f.filter("source_round <> 'round1'"))


def run_files(spark, sf):
    """Result, error and page files of several rounds and runs."""
    r, k = R.reports(spark, sf), F.col("k")
    batch = R.text("b", F.col("ck") % 40)
    run = R.text("round", k % 2 + 1, "_202", F.col("ck") % 4, "0101_run", k % 3 + 1)
    out = r.select("k", batch.alias("b"), run.alias("run"), F.when(k % 5 == 0, "_ERROR.json").otherwise("_dsa.json").alias("end"), "stem")
    return out.withColumn("path", R.text("/out/", F.col("b"), "/", F.col("run"), "/selected_pdf_pages/", F.col("stem"), "_pages_3.pdf")).withColumn("name", base_name("path")).withColumn("size", k % 1000)


@query("selected_folders", f"""WITH {R.REPORTS}, f AS (SELECT DISTINCT 'b' || (ck % 40) AS batch, k % 2 + 1 AS rd, ck % 4 AS st, k % 3 + 1 AS rn FROM rpt)
SELECT batch, batch || '/round' || rd || '_202' || st || '0101_run' || rn || '/selected_pdf_pages' AS dir FROM f QUALIFY row_number() OVER (PARTITION BY batch ORDER BY rd, rn, st DESC) = 1""")
def selected_folders(spark, sf):
    """One page folder per batch: lowest round, then run, then the latest stamp."""
    return V.selected_folders(run_files(spark, sf), "/out")


@query("index_selected_pages", f"""WITH {R.REPORTS}, f AS (SELECT k, stem, 'b' || (ck % 40) AS batch, k % 2 + 1 AS rd, ck % 4 AS st, k % 3 + 1 AS rn FROM rpt), b AS (SELECT DISTINCT batch, rd, st, rn FROM f QUALIFY row_number() OVER (PARTITION BY batch ORDER BY rd, rn, st DESC) = 1),
r AS (SELECT *, row_number() OVER (ORDER BY batch) - 1 AS dir_rank FROM b) SELECT regexp_extract(f.stem, '^(.+?_\\d{{4}}-\\d{{2}}-\\d{{2}})', 1) AS stem, 'selected_pdf_direct' AS method, CAST(dir_rank AS INT) AS dir_rank, f.stem || '_pages_3.pdf' AS name FROM f JOIN r USING (batch, rd, st, rn)""".replace("\\\\", "\\"))
def index_selected_pages(spark, sf):
    files = run_files(spark, sf)
    return V.index_selected(files, "/out", V.selected_folders(files, "/out"))[0].select("stem", "method", F.col("dir_rank").cast("int").alias("dir_rank"), "name")


@query("choose_selected_pages", f"""WITH {R.REPORTS}, f AS (SELECT country AS stem, k AS name, k % 7 AS dir_rank, k % 4 AS method_rank, k % 1000 AS size, framework = 'SRDSF' AND source_round = 'round3' AS sent FROM rpt), t AS (SELECT stem, name, 'timing' AS source FROM f WHERE sent QUALIFY row_number() OVER (PARTITION BY stem ORDER BY dir_rank, name) = 1)
SELECT * FROM t UNION ALL SELECT stem, name, 'filename' FROM (SELECT * FROM f WHERE size <= 700 AND stem NOT IN (SELECT stem FROM t) QUALIFY row_number() OVER (PARTITION BY stem ORDER BY dir_rank, method_rank, name) = 1)""")
def choose_selected_pages(spark, sf):
    """The file recorded as sent, else the best folder and method under a size limit."""
    from panelkit.operators.pages import choose_selected
    k = F.col("k")
    f = R.reports(spark, sf).select(F.col("country").alias("stem"), k.alias("name"), (k % 7).cast("string").alias("dir"), (k % 7).alias("dir_rank"), (k % 4).alias("method_rank"), (k % 1000).alias("size"),
                                    "framework", "source_round")
    return choose_selected(f, f.filter("framework = 'SRDSF' and source_round = 'round3'"), 700).select("stem", "name", "source")


@query("run_catalogue", f"""WITH {R.REPORTS}, f AS (SELECT CASE WHEN k % 6 = 0 THEN NULL ELSE k % 3 + 1 END AS run, '202' || (ck % 4) || '0101' AS version, k % 6 = 0 AND k % 12 = 0 AND ck % 4 > 0 AS chk FROM rpt)
SELECT version, bool_or(chk) AS has_check, array_to_string(list_sort(list_distinct(list(run) FILTER (WHERE run IS NOT NULL))), '|') AS runs, CAST(count(DISTINCT run) AS INT) AS n_runs FROM f GROUP BY 1""")
def run_catalogue(spark, sf):
    """Versions of a round from folder names: which runs exist and whether they were checked."""
    r, k = R.reports(spark, sf), F.col("k")
    version = R.text("202", F.col("ck") % 4, "0101")
    folder = F.when(k % 6 == 0, R.text("round1_check_", version)).otherwise(R.text("round1_", version, "_run", k % 3 + 1))
    file = F.when((k % 12 == 0) & (F.col("ck") % 4 > 0), "round1_check_report_summary_x.csv").otherwise(F.col("json_file"))
    files = r.select(R.text("/out/", folder, "/", file).alias("path"), file.alias("name"))
    return V.run_catalogue(files, "/out", "round1").withColumn("runs", F.array_join(F.transform("runs", lambda x: x.cast("string")), "|"))


@query("run_progress", f"""WITH {R.REPORTS}, f AS (SELECT k % 3 + 1 AS run, country AS stem, k % 5 <> 0 AS done FROM rpt), s AS (SELECT run, stem, bool_or(done) AS done FROM f GROUP BY 1, 2)
SELECT CAST(run AS INT) AS run, count(*) FILTER (WHERE done) AS n_done, count(*) FILTER (WHERE NOT done) AS n_errors FROM s GROUP BY 1""")
def run_progress(spark, sf):
    """Per run: reports with a result, and reports with nothing but an error."""
    k = F.col("k")
    files = R.reports(spark, sf).select("k", R.text(F.col("country"), F.when(k % 5 == 0, "_ERROR.json").otherwise("_dsa.json")).alias("name"))
    return V.run_progress(files, (k % 3 + 1).cast("int"))


@query("version_catalogue", f"""WITH {R.REPORTS} SELECT CASE WHEN k % 3 = 2 THEN 'other' WHEN k % 3 = 0 THEN 'gapfill' ELSE 'pregapfill' END AS kind, CASE WHEN k % 3 < 2 THEN 'v' || (ck % 50) END AS version, count(*) AS n FROM rpt GROUP BY 1, 2""")
def version_catalogue(spark, sf):
    k = F.col("k")
    name = R.case(R.text("final_", k, ".csv"), (k % 3 == 0, R.text("panel_gapfill_v", F.col("ck") % 50, ".csv")), (k % 3 == 1, R.text("panel_pregapfill_v", F.col("ck") % 50, ".csv")))
    files = R.reports(spark, sf).select(name.alias("name"), k.alias("size"), F.col("report_date").alias("modified"))
    return V.version_catalogue(files).groupBy("kind", "version").agg(F.count("*").alias("n"))


@query("latest_output", f"""WITH {R.REPORTS}, f AS (SELECT CASE WHEN k % 3 = 0 THEN 'gapfill' ELSE 'pregapfill' END AS kind, 'v' || (ck % 50) AS version, k FROM rpt WHERE k % 3 < 2)
SELECT kind, version, k AS size FROM f ORDER BY version DESC, kind, k DESC LIMIT 1""")
def latest_output(spark, sf):
    """The newest version: gap-filled if there is one."""
    k = F.col("k")
    name = R.case(R.text("final_", k, ".csv"), (k % 3 == 0, R.text("panel_gapfill_v", F.col("ck") % 50, ".csv")), (k % 3 == 1, R.text("panel_pregapfill_v", F.col("ck") % 50, ".csv")))
    files = R.reports(spark, sf).select(name.alias("name"), k.alias("size"), F.timestamp_seconds(k).alias("modified"))
    return V.latest_output(V.version_catalogue(files)).select("kind", "version", "size")


@query("gap_run_flags", f"""WITH {R.REPORTS}, s AS (SELECT DISTINCT country AS stamp FROM rpt) SELECT stamp, stamp IN (SELECT country FROM rpt WHERE framework = 'SRDSF') AS identified, stamp IN (SELECT country FROM rpt WHERE source_round = 'gapfill') AS filled FROM s""")
def gap_run_flags(spark, sf):
    r = R.reports(spark, sf).select("framework", "source_round", F.col("country").alias("stamp"))
    return V.gap_runs(r.select("stamp").distinct(), r.filter("framework = 'SRDSF'"), r.filter("source_round = 'gapfill'"))


@query("report_list", """SELECT DISTINCT 'rep ' || conv_id || '_' || turn AS stem, CASE WHEN turn % 2 = 0 THEN 'cat_a' ELSE 'cat_b' END AS category FROM conversations WHERE turn % 3 < 2""")
def report_list(spark, sf):
    """Report names found in nested JSON texts; descriptive fields are not taken for names."""
    from panelkit.sources.readers import report_list as read
    c, t = R.table(spark, sf, "conversations"), F.col("turn")
    name = R.text("rep ", F.col("conv_id"), "_", t)
    entry = F.when(t % 2 == 0, F.to_json(F.struct(R.text(name, "_dsa.json").alias("json_file"), F.lit("x").alias("note")))).otherwise(F.to_json(F.struct(F.lit(1).alias("json_file"), R.text(name, ".pdf").alias("report"))))
    group = F.when(t % 2 == 0, "cat_a").otherwise("cat_b")
    # lists in lists and groups in lists, up to seven deep; every third object lists its reports under a key that is not followed
    deep = (F.col("conv_id") % 8).cast("int")
    nested = R.text(F.repeat(F.lit('[{"group":"g","reports":['), deep), entry, F.repeat(F.lit("]}]"), deep))
    text = R.text('{"meta":{"round":"r1"},"', group, '":{"description":"d","count":1,"', F.when(t % 3 < 2, "reports").otherwise("others"), '":[', nested, "]}}")
    return read(c.select(text.alias("t")), "t").select("stem", "category")


