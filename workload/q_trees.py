"""Nested results flattened: a document is a report, its lines the children, their sentences one level deeper."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.items import CATEGORIES, ROLES
from panelkit.operators import tree as T
from panelkit.operators.spread import dealt
from panelkit.plans.round_check import compile_results
from panelkit.sources.readers import ANSWER, extraction_schema
from workload import roles as R
from workload.registry import query

ROLE_COUNT = len(ROLES)


NEST = 9    # sentences under one another


def _json_trees(spark, sf):
    """(doc_id, tree JSON): the lines of a text under the role its number points to; whole texts, row-local.

    Role r holds the lines with (line number mod 7) = r. A line's children are its 1st, 10th, 19th ... sentence; each
    other sentence is the child of the one before it, so that the depth varies with the text, up to ten levels.
    """
    d = dealt(R.table(spark, sf, "documents").select("doc_id", "n_chars", "text")).select("doc_id", "n_chars", F.split("text", "\n").alias("lines"))
    numbered = F.transform("lines", lambda x, i: F.struct(i.alias("i"), x.alias("x")))

    def text(s):
        quoted = F.to_json(F.array(s))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)

    def node(label, value, kids):
        return R.text('{"label_verbatim":', label, ',"value":', F.coalesce(R.text('"', value.cast("string"), '"'), F.lit("null")), ',"children":[', kids, "]}")

    def line(s):
        x = s["x"]
        sentences = F.split(x, r"\. ")
        starts = F.sequence(F.lit(1), F.size(sentences), F.lit(NEST))
        chain = F.transform(starts, lambda a: F.aggregate(
            F.reverse(F.slice(sentences, a, NEST)), F.lit(""), lambda kid, t: node(text(t), F.when(F.length(t) % 3 > 0, F.length(t)), kid)))
        return node(text(x), F.when(F.length(x) % 5 > 0, F.length(x)), F.array_join(chain, ","))
    parts = []
    for n, role in enumerate(ROLES):
        mine = F.filter(numbered, lambda s: s["i"] % ROLE_COUNT == n)
        # a role without lines is absent from the tree
        parts.append(F.when(F.size(mine) > 0, R.text(f'"{role}":', node(F.lit(f'"{role}"'), F.size(mine) * 10 + n, F.array_join(F.transform(mine, line), ",")))))
    return d.select("doc_id", "n_chars", R.text("{", F.concat_ws(",", *parts), "}").alias("tree"))


def trees(spark, sf):
    return _json_trees(spark, sf).select("doc_id", F.from_json("tree", T.tree_type()).alias("tree"))


TREE_SQL = """ln AS (SELECT doc_id, CAST(u.i - 1 AS INT) AS i, u.x FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(x, i)),
rl AS (SELECT *, CAST(i % 7 AS INT) AS role, row_number() OVER (PARTITION BY doc_id, i % 7 ORDER BY i) AS pos FROM ln),
names AS (SELECT * FROM (VALUES (0,'debt_level'),(1,'change_in_debt'),(2,'identified_flows'),(3,'primary_balance'),(4,'automatic_debt_dynamics'),(5,'other_identified_flows'),(6,'residual')) t(role, cat)),
top AS (SELECT doc_id, role, count(*) AS n FROM rl GROUP BY 1, 2),
sn AS (SELECT rl.*, v.s, v.j FROM rl, unnest(string_split(x, '. ')) WITH ORDINALITY AS v(s, j)),
flat AS (SELECT doc_id, role, cat AS top_category, CAST(role AS VARCHAR) AS hierarchy_id, 0 AS level, NULL AS parent_label, cat AS label_verbatim, CAST(n * 10 + role AS VARCHAR) AS value
    FROM top JOIN names USING (role)
  UNION ALL SELECT doc_id, role, cat, role || '.' || pos, 1, cat, x, CASE WHEN length(x) % 5 > 0 THEN CAST(length(x) AS VARCHAR) END FROM rl JOIN names USING (role)
  UNION ALL SELECT doc_id, role, cat, role || '.' || pos || '.' || ((j - 1) // 9 + 1) || repeat('.1', CAST((j - 1) % 9 AS INT)), 2 + (j - 1) % 9,
    CASE WHEN j % 9 = 1 THEN x ELSE lag(s) OVER (PARTITION BY doc_id, i ORDER BY j) END, s, CASE WHEN length(s) % 3 > 0 THEN CAST(length(s) AS VARCHAR) END FROM sn JOIN names USING (role))"""


@query("flatten_tree", f"WITH {TREE_SQL} SELECT doc_id, top_category, hierarchy_id, CAST(level AS INT) AS level, parent_label, label_verbatim, value FROM flat WHERE role > 0")
def flatten_tree(spark, sf):
    """Six roles in fixed order; the seventh is read but never flattened."""
    return T.flatten_tree(trees(spark, sf), "tree")


@query("count_filled_nodes", f"""WITH {TREE_SQL}, c AS (SELECT doc_id, CAST(sum(CASE WHEN label_verbatim <> '' THEN 1 ELSE 0 END) AS INT) AS n_labelled,
  CAST(sum(CASE WHEN label_verbatim <> '' AND value <> '' THEN 1 ELSE 0 END) AS INT) AS n_values FROM flat GROUP BY 1)
SELECT doc_id, n_labelled, n_values, n_labelled = 0 OR n_values < 3 OR n_values / n_labelled < 0.45 AS needs_retry FROM c""")
def count_filled_nodes(spark, sf):
    d = T.node_counts(trees(spark, sf), "tree")
    return d.select("doc_id", "n_labelled", "n_values", T.needs_legibility_retry(F.lit(True), F.lit(None).cast("string"), "n_values", "n_labelled").alias("needs_retry"))


@query("wide_role_values", f"""WITH {TREE_SQL} SELECT doc_id, """ + ", ".join(
    f"CAST(max(CASE WHEN role = {n} THEN value END) AS DOUBLE) AS {c}" for n, c in enumerate(CATEGORIES, 1)) + " FROM flat WHERE level = 0 GROUP BY 1")
def wide_role_values(spark, sf):
    return T.wide_values(trees(spark, sf), "tree")


@query("tree_level_counts", f"WITH {TREE_SQL} SELECT CAST(level AS INT) AS level, count(*) AS n FROM flat WHERE role > 0 GROUP BY 1")
def tree_level_counts(spark, sf):
    """Line items on each level: as many levels as the texts have."""
    return T.level_counts(trees(spark, sf), "tree")


# ---- compiled results ---------------------------------------------------------------------------------------

def results(spark, sf):
    """Result files as the reader returns them: every eleventh has no table, every thirteenth no tree, every seventeenth is broken."""
    d, k = _json_trees(spark, sf), F.col("doc_id")
    y = F.lit(2000) + k % 20
    status = R.case(F.lit("accepted"), (k % 6 == 0, F.lit("manual_review")))
    audit = F.struct(F.array(F.struct((y - 1).cast("string").alias("year_label"), F.lit("actual").alias("status"), F.lit(True).alias("selected"))).alias("columns"),
                     (y - 1).cast("string").alias("selected_year"))
    source = F.struct(R.text("COUNTRY D'", k % 9).alias("country"), R.text(y, "-05-06").alias("publication_date"), R.text(y - 1, F.when(k % 4 == 0, "/").otherwise(""), F.when(
        k % 4 == 0, F.lpad((y % 100).cast("string"), 2, "0")).otherwise("")).alias("last_actual_year"), R.text("Act. ", y - 1).alias("actual_column_label"),
        F.when(k % 5 > 0, F.lit("MAC_DSA")).alias("framework"), audit.alias("column_header_audit"), F.struct(status.alias("status")).alias("actual_column_validation"))
    meta = F.struct(F.when(k % 3 == 0, R.text("doc d'", k, " x")).alias("country"), F.when(k % 2 == 0, R.text("Report ", k)).alias("report_title"))
    head = F.to_json(F.struct(meta.alias("report_metadata"), source.alias("source"), (k % 11 > 0).alias("table_found"), R.text("doc_", k, ".pdf").alias("pdf_file_name"),
                              F.when(k % 11 == 0, "no table").alias("failure_reason"), F.lit("note").alias("extraction_notes")))
    body = F.when(k % 13 > 0, R.text(",\"decomposition\":", F.col("tree"))).otherwise(F.lit(""))
    whole = R.text(F.regexp_replace(head, r"\}$", ""), body, "}")
    t = d.select(R.text("doc_", k, "_dsa.json").alias("json_file"), F.when(k % 17 == 0, F.substring(whole, 2, 2147483647)).otherwise(whole).alias("text"))
    return t.select("json_file", F.from_json("text", extraction_schema()).alias("result"), F.coalesce(F.array_contains(F.json_object_keys("text"), "decomposition"), F.lit(False)).alias("has_tree"),
                    F.when(F.json_object_keys("text").isNull(), "not a readable JSON object").alias("error"))


COMPILE_SQL = TREE_SQL + """,
f AS (SELECT doc_id AS k, 2000 + doc_id % 20 AS y FROM documents WHERE doc_id % 13 > 0 AND doc_id % 17 > 0),
src AS (SELECT k, 'doc_' || k || '_dsa.json' AS json_file, 'doc_' || k || '.pdf' AS pdf_file_name, CASE WHEN k % 3 = 0 THEN 'Doc D''' || k || ' X' ELSE 'Country D''' || (k % 9) END AS country,
  y || '-05-06' AS publication_date, CASE WHEN k % 2 = 0 THEN 'Report ' || k END AS report_title, CASE WHEN k % 11 > 0 THEN 'True' ELSE 'False' END AS table_found,
  CASE WHEN k % 5 > 0 THEN 'MAC_DSA' END AS framework, (y - 1) || CASE WHEN k % 4 = 0 THEN '/' || lpad(CAST(y % 100 AS VARCHAR), 2, '0') ELSE '' END AS last_actual_year,
  CASE WHEN k % 4 = 0 THEN 'No' ELSE 'Yes' END AS actual_year_label_match, CAST(y - 1 AS VARCHAR) AS column_header_selected_year,
  CASE WHEN k % 6 = 0 THEN 'Yes' ELSE 'No' END AS manual_review_required, CASE WHEN k % 11 = 0 THEN 'no table' END AS failure_reason, CASE WHEN k % 11 = 0 THEN 'note' END AS extraction_notes FROM f)"""
COMPILED = ["json_file", "pdf_file_name", "country", "publication_date", "report_title", "table_found", "framework", "last_actual_year", "actual_year_label_match",
            "column_header_selected_year", "manual_review_required", "failure_reason", "extraction_notes"]
ITEMS = ["top_category", "hierarchy_id", "level", "parent_label", "label_verbatim", "value"]


@query("compile_results", f"""WITH {COMPILE_SQL} SELECT {', '.join(COMPILED)}, top_category, hierarchy_id, CAST(level AS VARCHAR) AS level, parent_label, label_verbatim, value
  FROM src JOIN flat ON doc_id = k WHERE k % 11 > 0 AND role > 0
UNION ALL SELECT {', '.join(COMPILED)}, NULL, NULL, NULL, NULL, NULL, NULL FROM src WHERE k % 11 = 0""")
def compiled(spark, sf):
    """Result trees to the long table: line items, one row for a result without a table; unreadable and foreign files skipped."""
    return compile_results(results(spark, sf)).select(*COMPILED, *ITEMS)


@query("unreadable_results", """SELECT 'doc_' || doc_id || '_dsa.json' AS json_file, 'not a readable JSON object' AS error FROM documents WHERE doc_id % 17 = 0""")
def unreadable(spark, sf):
    from panelkit.sources.readers import bad_files
    return bad_files(results(spark, sf))


# ---- saved answers ---------------------------------------------------------------------------------------------

@query("spread_answers", """SELECT 'conv_' || conv_id AS stem, CAST(2000 + turn AS INT) AS year, CASE WHEN role = 'assistant' THEN 'resolved' ELSE 'rejected_not_actual' END AS status,
  CAST(length(text) AS VARCHAR) AS notes FROM conversations""")
def spread_answers(spark, sf):
    """map{year -> answer} of every report to one row per (report, year). A turn is one answer's own map, so no
    conversation is gathered."""
    c = R.table(spark, sf, "conversations")
    one = F.to_json(F.create_map((F.col("turn") + 2000).cast("string"), F.struct(
        F.when(F.col("role") == "assistant", "resolved").otherwise("rejected_not_actual").alias("status"), F.length("text").cast("string").alias("notes"))))
    d = c.select(R.text("conv_", F.col("conv_id")).alias("stem"), F.from_json(one, f"map<string,{ANSWER.simpleString()}>").alias("per_target"))
    return T.spread_map(d, "per_target", "year", "answer").select("stem", F.col("year").cast("int").alias("year"), "answer.status", "answer.notes")
