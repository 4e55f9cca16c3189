"""Scalar normalisers and parsers over the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import files, headers, items as I, names, numbers as N, text as X, years as Y
from panelkit.operators import stats as S
from workload import roles as R
from workload.registry import query

# ---- names ---------------------------------------------------------------------------------------------
RAW_NAME_SQL = """
raw AS (SELECT c_custkey, CASE CAST(c_custkey % 10 AS INT)
  WHEN 0 THEN 'The ' || n_name WHEN 1 THEN 'Republic of ' || n_name WHEN 2 THEN 'St.' || n_name
  WHEN 3 THEN 'Kingdom of the Netherlands – ' || CASE c_custkey % 3 WHEN 0 THEN 'Aruba' WHEN 1 THEN 'the Netherlands' ELSE 'Curaçao' END
  WHEN 4 THEN 'Republic of Turkey' WHEN 5 THEN n_name || ' — ' || c_mktsegment
  WHEN 6 THEN 'People’s Republic of China-' || CASE c_custkey % 3 WHEN 0 THEN 'Hong Kong' ELSE 'Macao' END
  WHEN 7 THEN '  ' || lower(n_name) || ' ' WHEN 8 THEN 'COTE D’IVOIRE' ELSE n_name END AS raw
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def raw_names(spark, sf):
    c, n = R.table(spark, sf, "customer"), R.table(spark, sf, "nation")
    k, m = F.col("c_custkey"), F.col("c_custkey") % 10
    d = c.join(n, c.c_nationkey == n.n_nationkey)
    third = F.col("c_custkey") % 3
    return d.select("c_custkey", "c_mktsegment", "n_name", R.case(
        F.col("n_name"), (m == 0, R.text("The ", F.col("n_name"))), (m == 1, R.text("Republic of ", F.col("n_name"))),
        (m == 2, R.text("St.", F.col("n_name"))),
        (m == 3, R.text("Kingdom of the Netherlands – ", R.case(F.lit("Curaçao"), (third == 0, F.lit("Aruba")), (third == 1, F.lit("the Netherlands"))))),
        (m == 4, F.lit("Republic of Turkey")), (m == 5, R.text(F.col("n_name"), " — ", F.col("c_mktsegment"))),
        (m == 6, R.text("People’s Republic of China-", F.when(third == 0, "Hong Kong").otherwise("Macao"))),
        (m == 7, R.text("  ", F.lower("n_name"), " ")), (m == 8, F.lit("COTE D’IVOIRE"))).alias("raw"), k.alias("k")).drop("k")


NORM_SQL = r"""
s1 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(replace(trim(raw), '’', ''''), '\bSt\.(\S)', 'St. \1', 'g'), '[–—]+', '-', 'g'),
  '\s*-\s*', '-', 'g') AS s0 FROM raw),
s2 AS (SELECT *, regexp_replace(s0, '(?i)^the\s+', '') AS s FROM s1),
nrm AS (SELECT *, CASE WHEN lower(s) LIKE 'people''s republic of china-%' THEN CASE WHEN lower(s) LIKE '%hong kong%' THEN 'Hong Kong SAR, China'
    ELSE 'Macao SAR, China' END
  WHEN lower(s) LIKE 'kingdom of the netherlands-%' THEN CASE regexp_replace(substr(lower(s), 28), '^the\s+', '') WHEN 'netherlands' THEN 'Netherlands'
    WHEN 'aruba' THEN 'Aruba' ELSE 'Curaçao and Sint Maarten' END
  WHEN lower(s) = 'cote d''ivoire' THEN 'Côte d''Ivoire' WHEN lower(s) = 'republic of turkey' THEN 'Türkiye'
  WHEN lower(s) LIKE 'republic of %' THEN trim(substr(s, 13)) ELSE s END AS name FROM s2)"""


@query("normalize_entity", f"WITH {RAW_NAME_SQL}, {NORM_SQL} SELECT c_custkey, name, lower(name) AS entity_key FROM nrm")
def normalize_entity(spark, sf):
    return raw_names(spark, sf).select("c_custkey", names.normalize_entity("raw").alias("name"), names.entity_key("raw").alias("entity_key"))


@query("entity_labels", f"""WITH {RAW_NAME_SQL}, {NORM_SQL}, n AS (SELECT lower(name) AS key, name, count(*) AS c FROM nrm GROUP BY 1, 2)
SELECT key, name AS label FROM n QUALIFY row_number() OVER (PARTITION BY key ORDER BY c DESC, name) = 1""")
def entity_labels(spark, sf):
    """One display spelling per case-insensitive key: the most common normalised one."""
    from panelkit.operators.pick import most_common
    d = raw_names(spark, sf).select(names.normalize_entity("raw").alias("name")).withColumn("key", F.lower("name"))
    return most_common(d, ["key"], "name", "label")


LOOSE = r"lower(replace(regexp_replace(replace(replace(replace(trim(raw), '’', ''''), '–', '-'), '—', '-'), '\s+', ' ', 'g'), ' - ', '-'))"


@query("loose_name_classification", f"""WITH {RAW_NAME_SQL}, {NORM_SQL}, d AS (SELECT DISTINCT raw, {LOOSE} AS k, {LOOSE.replace('trim(raw)', 'trim(name)')} AS nk FROM nrm),
codes AS (SELECT lower(n_name) AS k, min(n_nationkey) AS code FROM nation GROUP BY 1),
c AS (SELECT raw, coalesce(a.code, b.code) AS code FROM d LEFT JOIN codes a ON a.k = d.k LEFT JOIN codes b ON b.k = nk)
SELECT raw, CAST(code AS INT) AS code, r_name AS region, CASE WHEN code IS NULL THEN 'name not in the code list' END AS problem
FROM c LEFT JOIN nation ON code = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def loose_name_classification(spark, sf):
    """Names -> code by loose key, else by the normalised name's -> group columns; unmatched names keep NULL and a problem."""
    n, r = R.table(spark, sf, "nation"), R.table(spark, sf, "region")
    raw = raw_names(spark, sf)
    groups = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("code"), F.col("r_name").alias("region"))
    cls = S.classify(raw, n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code")), groups, "raw")
    issues = S.classification_issues(cls, "region", "raw").select("raw", "problem")
    return cls.join(issues, "raw", "left").select("raw", "code", "region", "problem")


@query("title_and_label_keys", r"""SELECT p_partkey, list_aggregate(list_transform(regexp_extract_all(t, '([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)', 1),
  lambda w : upper(w[1]) || lower(w[2:])), 'string_agg', '') AS title, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) AS label_key
FROM (SELECT p_partkey, upper(p_name) || ' d''' || p_type || '-' || p_brand AS t FROM part)""")
def title_and_label_keys(spark, sf):
    p = R.table(spark, sf, "part")
    t = R.text(F.upper("p_name"), " d'", F.col("p_type"), "-", F.col("p_brand"))
    return p.select("p_partkey", X.title_case(t).alias("title"), X.label_key(t).alias("label_key"))


@query("union_and_region_filter", f"""WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Euro-Area ' || c_mktsegment WHEN 1 THEN 'Cluster report ' || c_name
  WHEN 2 THEN 'West African Economic and Monetary Union 2019' ELSE c_name END AS s FROM customer)
SELECT c_custkey, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) SIMILAR TO '(euro area|central african economic and monetary community|eastern caribbean currency union|west african economic and monetary union).*' AS is_union,
  regexp_matches(s, '{names.REGIONAL}') AS is_regional FROM t""")
def union_and_region_filter(spark, sf):
    c, m = R.table(spark, sf, "customer"), F.col("c_custkey") % 4
    s = R.case(F.col("c_name"), (m == 0, R.text("Euro-Area ", F.col("c_mktsegment"))), (m == 1, R.text("Cluster report ", F.col("c_name"))),
               (m == 2, F.lit("West African Economic and Monetary Union 2019")))
    return c.select("c_custkey", names.is_union(s).alias("is_union"), names.is_regional(s).alias("is_regional"))


@query("split_reports", f"""WITH {R.REPORTS}, p AS (SELECT DISTINCT lower('Customer ' || c_custkey) AS key FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT kept_as, count(*) AS n FROM (SELECT CASE WHEN k % 19 = 0 THEN 'regional' WHEN p.key IS NULL THEN 'outside_panel' ELSE 'kept' END AS kept_as
  FROM rpt LEFT JOIN p ON lower(rpt.country) = p.key) GROUP BY 1""")
def split_reports(spark, sf):
    """Regional reports, reports of entities outside the panel, kept reports."""
    r = R.reports(spark, sf).select(F.when(F.col("k") % 19 == 0, R.text("Cluster ", F.col("country"))).otherwise(F.col("country")).alias("entity_raw"), "country")
    r = r.withColumn("entity_key", F.lower("country"))
    ent = R.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.lower(R.text("Customer ", F.col("c_custkey"))).alias("entity_key"))
    return names.split_reports(r, ent).groupBy("kept_as").agg(F.count("*").alias("n"))


# ---- years -----------------------------------------------------------------------------------------------
LABEL_SQL = """lab AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, CASE CAST(o_orderkey % 12 AS INT) WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR)
  WHEN 1 THEN (year(o_orderdate) - 1) || '/' || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') WHEN 2 THEN 'FY ' || year(o_orderdate)
  WHEN 3 THEN '  fy' || year(o_orderdate) || ' - ' || (year(o_orderdate) + 1) WHEN 4 THEN (year(o_orderdate) - 4) || '-' || year(o_orderdate)
  WHEN 5 THEN 'Est.  ' || year(o_orderdate) WHEN 6 THEN year(o_orderdate) || ' or ' || (year(o_orderdate) + 1) WHEN 7 THEN 'nan' WHEN 8 THEN '' WHEN 9 THEN NULL
  WHEN 10 THEN year(o_orderdate) || '/' || (year(o_orderdate) - 2) ELSE 'Avg. ' || (year(o_orderdate) - 1) || '/' || (year(o_orderdate) % 100 + 100) END AS raw FROM orders)"""


def labels(spark, sf):
    y, m = F.year(F.to_date("o_orderdate")), F.col("o_orderkey") % 12
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), R.case(
        R.text("Avg. ", y - 1, "/", y % 100 + 100), (m == 0, y.cast("string")), (m == 1, R.text(y - 1, "/", F.lpad((y % 100).cast("string"), 2, "0"))),
        (m == 2, R.text("FY ", y)), (m == 3, R.text("  fy", y, " - ", y + 1)), (m == 4, R.text(y - 4, "-", y)), (m == 5, R.text("Est.  ", y)),
        (m == 6, R.text(y, " or ", y + 1)), (m == 7, F.lit("nan")), (m == 8, F.lit("")), (m == 9, F.lit(None).cast("string")),
        (m == 10, R.text(y, "/", y - 2))).alias("raw"))


@query("parse_year_label", f"""WITH {LABEL_SQL}, t AS (SELECT k, {R.squeezed('raw')} AS t FROM lab)
SELECT k, {R.year_kind('t')} AS kind, {R.year_end('t', True)} AS y0, {R.year_end('t')} AS y1,
  CASE WHEN t IS NULL THEN 'missing' WHEN regexp_matches(t, '{R.TWO}') THEN CASE {R.year_kind('t')} WHEN 'single' THEN 'fiscal_year_end_of_' WHEN 'range' THEN 'multi_year_range_'
    ELSE 'unparsed_' END || t WHEN regexp_matches(t, '{R.ONE}') THEN CASE WHEN upper(t) LIKE 'FY%' THEN 'fy_label' ELSE '' END
    WHEN {R.year_kind('t')} = 'single' THEN 'extracted_from_text_' || t ELSE 'unparsed_' || t END AS note FROM t""")
def parse_year_label(spark, sf):
    return labels(spark, sf).select("k", Y.parse_year_label("raw").alias("p")).select("k", "p.*")


SLASH, DASH, PLAIN = r"\b\d{4}/\d{2,4}\b", r"\b\d{4}-\d{2,4}\b", r"\b\d{4}\b"
TOKEN = f"coalesce(nullif(regexp_extract(r, '{SLASH}'), ''), nullif(regexp_extract(r, '{DASH}'), ''), nullif(regexp_extract(r, '{PLAIN}'), ''))"


@query("year_tokens", rf"""WITH {LABEL_SQL}, t AS (SELECT k, y, coalesce(raw, '') AS r, {R.squeezed('raw')} AS t FROM lab), u AS (SELECT k, y, {R.year_norm('t')} AS comparison,
  {TOKEN} AS token, nullif(regexp_extract(r, '\b\d{{4}}(?:[/-]\d{{2,4}})?\b'), '') AS leftmost FROM t)
SELECT k, comparison, token, leftmost, CASE WHEN token IS NULL THEN 'Unknown' WHEN token = CAST(y AS VARCHAR) THEN 'Yes' ELSE 'No' END AS agreement FROM u""")
def year_tokens(spark, sf):
    year = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.year(F.to_date("o_orderdate")).cast("string").alias("y"))
    return labels(spark, sf).join(year, "k").select(
        "k", Y.year_for_comparison("raw").alias("comparison"), Y.year_token("raw").alias("token"),
        Y.leftmost_year_token("raw").alias("leftmost"), Y.label_agreement("y", "raw").alias("agreement"))


@query("effective_year_orders", f"""WITH {R.REPORTS}, t AS (SELECT k, CASE WHEN source_round = 'gapfill' THEN ' ' || (obs - 2) || ' ' WHEN k % 3 = 0 THEN '' END AS year,
  last_actual_year AS l FROM rpt), u AS (SELECT k, coalesce(nullif(trim(year), ''), nullif(trim(l), ''), '') AS a, coalesce(nullif(trim(l), ''), nullif(trim(year), ''), '') AS b FROM t)
SELECT k, a AS year_first, b AS last_actual_first, {R.year_end(R.squeezed('a'))} AS effective_year FROM u""")
def effective_year_orders(spark, sf):
    r = R.reports(spark, sf)
    d = r.select("k", F.when(F.col("source_round") == "gapfill", R.text(" ", F.col("obs") - 2, " ")).when(F.col("k") % 3 == 0, "").alias("year"), "last_actual_year")
    a, b = Y.effective_label(d.columns, True), Y.effective_label(d.columns, False)
    return d.select("k", a.alias("year_first"), b.alias("last_actual_first"), Y.effective_year(a).alias("effective_year"))


@query("publication_batches", f"""WITH {R.REPORTS}, t AS (SELECT CAST(pub_year + (k % 7) * 4 AS INT) AS y FROM rpt)
SELECT CASE WHEN y BETWEEN 2021 AND 2026 THEN '2021-2026' WHEN y BETWEEN 2016 AND 2020 THEN '2016-2020' WHEN y BETWEEN 2011 AND 2015 THEN '2011-2015'
  WHEN y BETWEEN 2006 AND 2010 THEN '2006-2010' WHEN y BETWEEN 2001 AND 2005 THEN '2001-2005' WHEN y BETWEEN 1996 AND 2000 THEN '1996-2000' ELSE 'Other' END AS batch,
  count(*) AS n FROM t GROUP BY 1""")
def publication_batches(spark, sf):
    r = R.reports(spark, sf).select((F.col("pub_year") + (F.col("k") % 7) * 4).cast("int").alias("y"))
    return r.groupBy(Y.batch_of_year("y").alias("batch")).agg(F.count("*").alias("n"))


# ---- numbers -----------------------------------------------------------------------------------------------
NUM_SQL = r"""num AS (SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS ln, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CASE CAST((l_orderkey + l_linenumber) % 12 AS INT)
  WHEN 0 THEN CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 1000 AS VARCHAR) || ',' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
  WHEN 1 THEN '−' || CAST(round(l_extendedprice) AS BIGINT) WHEN 2 THEN ' –' || CAST(round(l_quantity) AS BIGINT) || '.5 ' WHEN 3 THEN 'nan' WHEN 4 THEN 'n.a.'
  WHEN 5 THEN CAST(round(l_quantity) AS BIGINT) || 'd' WHEN 6 THEN CAST(round(l_quantity) AS BIGINT) || 'e2' WHEN 7 THEN '' WHEN 8 THEN CAST(round(l_quantity) AS BIGINT) || '.00'
  WHEN 9 THEN 'See  NOTE ' || CAST(l_linenumber AS VARCHAR) WHEN 10 THEN '-' || CAST(round(l_quantity) AS BIGINT) ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) END AS raw FROM lineitem)"""


def number_texts(spark, sf):
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    c, q, p = F.round(F.col("l_extendedprice") * 100).cast("long"), F.round("l_quantity").cast("long"), F.round("l_extendedprice").cast("long")
    m = (k + ln) % 12
    return R.table(spark, sf, "lineitem").select(k.alias("k"), ln.cast("int").alias("ln"), R.case(
        c.cast("string"), (m == 0, R.text(F.floor(c / 1000), ",", F.lpad((c % 1000).cast("string"), 3, "0"))), (m == 1, R.text("−", p)),
        (m == 2, R.text(" –", q, ".5 ")), (m == 3, F.lit("nan")), (m == 4, F.lit("n.a.")), (m == 5, R.text(q, "d")), (m == 6, R.text(q, "e2")),
        (m == 7, F.lit("")), (m == 8, R.text(q, ".00")), (m == 9, R.text("See  NOTE ", ln)), (m == 10, R.text("-", q))).alias("raw"))


@query("number_parsers", f"""WITH {NUM_SQL} SELECT k, ln, {R.strict_num('raw')} AS strict, {R.comma_num('raw')} AS comma, {R.minus_num('raw')} AS any_minus FROM num""")
def number_parsers(spark, sf):
    return number_texts(spark, sf).select("k", "ln", N.strict_number("raw").alias("strict"), N.comma_number("raw").alias("comma"), N.any_minus_number("raw").alias("any_minus"))


@query("comparable_values", rf"""WITH {NUM_SQL}, t AS (SELECT k, ln, CASE WHEN trim(raw) <> '' AND lower(trim(raw)) <> 'nan' THEN trim(raw) END AS s FROM num),
u AS (SELECT k, ln, s, {R.minus_num('s')} AS n FROM t), v AS (SELECT *, CASE WHEN n IS NULL THEN lower(trim(regexp_replace(s, '\s+', ' ', 'g'))) END AS x FROM u)
SELECT k, ln, n AS num, x AS txt, CASE WHEN n IS NOT NULL THEN abs(n - ln) <= 1e-9 ELSE s IS NOT NULL AND x = 'see note ' || ln END AS same_as_line,
  n IS NULL AND x IS NULL AS same_as_missing, coalesce(nullif(regexp_extract(s, '^(-?\d+)\.0+$', 1), ''), s) AS int_text,
  CASE WHEN k % 3 = 0 THEN true WHEN k % 3 = 1 THEN false END AS flag FROM v""")
def comparable_values(spark, sf):
    d = number_texts(spark, sf).withColumn("v", N.comparable("raw"))
    other = F.when(F.col("v.num").isNotNull(), F.col("ln").cast("string")).otherwise(R.text("SEE NOTE ", F.col("ln")))
    d = d.withColumn("o", N.comparable(other)).withColumn("none", N.comparable(F.lit(None).cast("string")))
    flag = R.case(F.lit("?"), (F.col("k") % 3 == 0, F.lit(" true")), (F.col("k") % 3 == 1, F.lit("FALSE")))
    return d.select("k", "ln", "v.num", "v.txt", N.same(F.col("v"), F.col("o")).alias("same_as_line"),
                    N.same(F.col("v"), F.col("none")).alias("same_as_missing"), N.int_text("raw").alias("int_text"), N.tri_state(flag).alias("flag"))


@query("number_texts", r"""SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS ln, printf('%g', x) AS general, CASE WHEN CAST(l_linenumber AS INT) % 3 = 0 THEN 'n/a'
  ELSE printf('%.1f', 100.0 * CAST(l_quantity AS INT) / 64) || '%' END AS share
FROM (SELECT *, CASE l_orderkey % 4 WHEN 0 THEN l_quantity * 1000 WHEN 1 THEN l_quantity / 1048576 WHEN 2 THEN l_quantity * 10000000 ELSE l_discount END AS x FROM lineitem)""")
def number_texts_query(spark, sf):
    m, q = F.col("l_orderkey") % 4, F.col("l_quantity")
    x = R.case(F.col("l_discount"), (m == 0, q * 1000), (m == 1, q / 1048576), (m == 2, q * 10000000))
    whole = F.when(F.col("l_linenumber") % 3 == 0, 0).otherwise(64)
    return R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("int").alias("ln"), X.general_number_text(x).alias("general"),
                                                 X.percent_text(F.col("l_quantity").cast("int"), whole).alias("share"))


# ---- items, headers, file names ------------------------------------------------------------------------------
@query("item_ids", f"""WITH t AS (SELECT DISTINCT CASE WHEN l_orderkey % 17 = 0 THEN 'x.' ELSE '' END || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_suppkey % 2 = 0 THEN '.' || (l_suppkey % 13) ELSE '' END
  || CASE WHEN l_suppkey % 4 = 0 THEN '.' || (l_partkey % 3 + 1) ELSE '' END AS hid FROM lineitem)
SELECT hid, regexp_matches(hid, '^[1-6](\\.\\d+)*$') AS valid, {R.CATEGORY_OF.format('hid')} AS top_category, CAST(len(string_split(hid, '.')) - 1 AS INT) AS level,
  CASE WHEN contains(hid, '.') THEN regexp_replace(hid, '\\.[^.]*$', '') END AS parent,
  list_aggregate(list_transform(string_split(hid, '.'), lambda p : coalesce(TRY_CAST(p AS INT), 1000000)), 'string_agg', '|') AS sort_key FROM t""".replace("\\\\", "\\"))
def item_ids(spark, sf):
    from panelkit.schema import valid_item_id
    s = F.col("l_suppkey")
    hid = R.text(F.when(F.col("l_orderkey") % 17 == 0, "x.").otherwise(""), F.col("l_linenumber"), F.when(s % 2 == 0, R.text(".", s % 13)).otherwise(""),
                 F.when(s % 4 == 0, R.text(".", F.col("l_partkey") % 3 + 1)).otherwise(""))
    d = R.table(spark, sf, "lineitem").select(hid.alias("hid")).distinct()
    return d.select("hid", valid_item_id("hid").alias("valid"), I.top_category("hid").alias("top_category"), I.level("hid").alias("level"),
                    I.parent_id("hid").alias("parent"), F.array_join(F.transform(I.sort_key("hid"), lambda p: p.cast("string")), "|").alias("sort_key"))


SLUG_SQL = r"""t1 AS (SELECT p_partkey, p_partkey % 30 || CASE WHEN p_partkey % 2 = 0 THEN '. ' ELSE ' ' END || CASE WHEN p_partkey % 3 = 0 THEN 'of which: ' WHEN p_partkey % 3 = 1 THEN 'o/w ' ELSE '' END
  || p_name || ' (' || p_size || '+1) ' || p_type || ' ' || p_brand || ' contribution ' || p_size || '/' AS raw FROM part),
t2 AS (SELECT p_partkey, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(raw), '\b\d+/', ' ', 'g'), '\([^)]*\)', ' ', 'g'), '^\s*\d+\.?\s+', ''),
  '^\s*(?:of which|o/w)\s*:?\s*', '') AS a FROM t1),
t3 AS (SELECT p_partkey, regexp_replace(regexp_replace(a, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS b FROM t2),
t4 AS (SELECT p_partkey, CASE WHEN length(b) > 40 THEN CASE WHEN contains(substr(b, 1, 41), '_') THEN regexp_replace(substr(b, 1, 41), '_[^_]*$', '') ELSE substr(b, 1, 41) END ELSE b END AS c FROM t3)"""


@query("slug_labels", f"""WITH {SLUG_SQL} SELECT p_partkey, coalesce(nullif(regexp_replace(c, '^_+|_+$', '', 'g'), ''), 'item') AS slug FROM t4""")
def slug_labels(spark, sf):
    k = F.col("p_partkey")
    raw = R.text(k % 30, F.when(k % 2 == 0, ". ").otherwise(" "), R.case(F.lit(""), (k % 3 == 0, F.lit("of which: ")), (k % 3 == 1, F.lit("o/w "))), F.col("p_name"),
                 " (", F.col("p_size"), "+1) ", F.col("p_type"), " ", F.col("p_brand"), " contribution ", F.col("p_size"), "/")
    return R.table(spark, sf, "part").select("p_partkey", I.slug(raw).alias("slug"))


@query("header_status", r"""WITH t AS (SELECT o_orderkey AS k, year(o_orderdate) || ' ' || CASE CAST(o_orderkey % 10 AS INT) WHEN 0 THEN 'Proj.' WHEN 1 THEN 'Prel.' WHEN 2 THEN 'Est' WHEN 3 THEN 'Actual' WHEN 4 THEN 'historical data'
  WHEN 5 THEN 'Estimated projection' WHEN 6 THEN 'medium-term  projections' WHEN 7 THEN 'outturn' WHEN 8 THEN 'estimates' ELSE '' END AS s FROM orders)
SELECT k, CASE WHEN regexp_matches(lower(s), '\bprel\b|\bpreliminary\b|\bprovisional\b') THEN 'preliminary' WHEN regexp_matches(lower(s), '\best\b|\bestimate\b|\bestimated\b') THEN 'estimate'
  WHEN regexp_matches(lower(s), '\bproj\b|\bprojection\b|\bprojections\b|\bforecast\b') THEN 'projection' WHEN regexp_matches(lower(s), '\bactual\b|\boutturn\b|\bfinal\b') THEN 'actual'
  WHEN regexp_matches(lower(s), '\bhistorical\b|\bhistory\b') THEN 'historical' ELSE 'unknown' END AS status,
  CASE k % 5 WHEN 0 THEN 'year_not_in_table' WHEN 1 THEN 'merged_range_only' WHEN 2 THEN 'rejected_not_actual' ELSE 'not_extracted' END AS answer_status FROM t""")
def header_status(spark, sf):
    k, y = F.col("o_orderkey"), F.year(F.to_date("o_orderdate"))
    words = ["Proj.", "Prel.", "Est", "Actual", "historical data", "Estimated projection", "medium-term  projections", "outturn", "estimates", ""]
    s = R.text(y, " ", F.element_at(F.array(*[F.lit(w) for w in words]), (k % 10 + 1).cast("int")))
    reason = R.case(F.lit("something else"), (k % 5 == 0, F.lit("year_not_in_table")), (k % 5 == 1, F.lit("year_only_in_merged_range")), (k % 5 == 2, F.lit("column_is_estimate")))
    return R.table(spark, sf, "orders").select(k.alias("k"), headers.header_status(s).alias("status"), headers.answer_status(reason).alias("answer_status"))


RULES = [("rings", "ring|gear"), ("bolts", "bolt"), ("reds", "red|small")]
CATEGORY_SQL = """CASE WHEN regexp_matches(lower({0}), 'small bolt') THEN 'Other' WHEN regexp_matches(lower({0}), 'ring|gear') THEN 'rings' WHEN regexp_matches(lower({0}), 'bolt') THEN 'bolts'
  WHEN regexp_matches(lower({0}), 'red|small') THEN 'reds' ELSE 'Other' END"""


@query("label_categories", f"""SELECT p_partkey, {CATEGORY_SQL.format("p_name")} AS category, CASE WHEN p_partkey % 9 = 0 THEN 'No sub-item reported' WHEN p_partkey % 9 = 1 THEN 'Debt relief / restructuring / arrears'
  WHEN p_partkey % 9 = 2 THEN 'Contingent liab. / bank recap / SOE' ELSE 'Other / unspecified' END AS driver FROM part""")
def label_categories(spark, sf):
    k = F.col("p_partkey")
    driver = R.case(R.text("size ", F.col("p_size")), (k % 9 == 0, F.lit(None).cast("string")), (k % 9 == 1, F.lit("HIPC Relief")), (k % 9 == 2, F.lit("State-owned privatization")))
    return R.table(spark, sf, "part").select("p_partkey", headers.label_category("p_name", RULES, "small bolt").alias("category"),
                                             headers.driver_category(driver).alias("driver"))


SUFFIX = ["_pages_5_8.pdf", "_CR2019-283_page_6_table_crop_fallback.pdf", "_visual.PDF", "_compressed_2.pdf", ".pdf", ".txt"]


@query("report_file_names", rf"""WITH {R.REPORTS}, t AS (SELECT k, country, report_date, CASE WHEN k % 13 = 0 THEN 'notes ' || k || '.pdf' ELSE country || '_' || report_date ||
  CASE CAST(k % 6 AS INT) WHEN 0 THEN '{SUFFIX[0]}' WHEN 1 THEN '{SUFFIX[1]}' WHEN 2 THEN '{SUFFIX[2]}' WHEN 3 THEN '{SUFFIX[3]}' WHEN 4 THEN '{SUFFIX[4]}' ELSE '{SUFFIX[5]}' END END AS name FROM rpt)
SELECT k, CASE WHEN k % 13 <> 0 THEN country END AS entity, CASE WHEN k % 13 <> 0 THEN CAST(report_date AS VARCHAR) END AS pub_date, CASE WHEN k % 13 <> 0 THEN CAST(year(report_date) AS INT) END AS pub_year,
  CASE WHEN k % 13 <> 0 AND k % 6 <> 5 THEN country || '_' || report_date || CASE WHEN k % 6 = 1 THEN '_CR2019-283' ELSE '' END END AS stem,
  CASE WHEN k % 13 <> 0 THEN CASE CAST(k % 6 AS INT) WHEN 1 THEN 'pymupdf_pillow_table_crop_fallback' WHEN 2 THEN 'pymupdf_pillow_visual_fallback' WHEN 3 THEN 'selected_pdf_image_compressed'
    WHEN 5 THEN NULL ELSE 'selected_pdf_direct' END END AS method FROM t""")
def report_file_names(spark, sf):
    r, k = R.reports(spark, sf), F.col("k")
    end = F.element_at(F.array(*[F.lit(s) for s in SUFFIX]), (k % 6 + 1).cast("int"))
    d = r.select("k", F.when(k % 13 == 0, R.text("notes ", k, ".pdf")).otherwise(R.text(F.col("country"), "_", F.col("report_date"), end)).alias("name"))
    d = d.withColumn("r", files.report_file("name")).withColumn("s", files.selected_name("name"))
    return d.select("k", "r.entity", F.col("r.date").cast("string").alias("pub_date"), F.col("r.year").alias("pub_year"), "s.stem", "s.method")
