"""Distributions by group, weights, trimming, tails and contributions over entity-year values."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.headers import label_category
from panelkit.operators import coverage as C, pick, stats as S
from panelkit.operators.quantiles import exact_quantiles
from panelkit.plans import analysis as A
from panelkit.session import materialise
from workload import roles as R
from workload.q_coverage import BEST, VALS
from workload.q_functions import CATEGORY_SQL, RULES
from workload.registry import query

GROUPS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PNL = f"""{VALS}, {BEST}, pnl AS (SELECT country_key, ey AS year, v AS value, c_mktsegment AS grp, abs(c_acctbal) + 1 AS w, json_file, best.source_round FROM best JOIN customer ON country_key = 'customer ' || c_custkey WHERE hierarchy_id = '5')"""


def panel(spark, sf):
    p = A.country_year_panel(R.long_rows(spark, sf), "5", [F.col("json_file"), F.col("row_no")], None, ["json_file", "row_no"])
    c = R.table(spark, sf, "customer").select(R.text("customer ", F.col("c_custkey")).alias("country_key"), F.col("c_mktsegment").alias("grp"), (F.abs("c_acctbal") + 1).alias("w"))
    return p.join(c, "country_key")


def r4(*names):
    """Rounding that both engines carry out with the same arithmetic."""
    return [(F.floor(F.col(n) * 100 + 0.5) / 100).alias(n) for n in names]


def q4(*names):
    return ", ".join(f"floor({n} * 100 + 0.5) / 100 AS {n}" for n in names)


Q = ", ".join(f"quantile_cont(value, {p}) AS {n}" for n, p in S.QUANTILES.items())
STAT = f"""count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, avg((value = 0)::INT) AS share_zero, avg((value > 0)::INT) AS share_positive, avg((value < 0)::INT) AS share_negative, {Q}"""
ROUNDED = ["mean", "std", *S.QUANTILES]
PLAIN = ["n", "min", "max", "share_zero", "share_positive", "share_negative"]


@query("group_year_stats", f"WITH {PNL}, s AS (SELECT year, grp, {STAT} FROM pnl GROUP BY 1, 2) SELECT year, grp, {', '.join(PLAIN)}, {q4(*ROUNDED)} FROM s")
def group_year_stats(spark, sf):
    """Mean, median, spread, percentiles, extremes and signs per year and group."""
    return S.group_stats(materialise(panel(spark, sf)), ["year", "grp"], "value").select("year", "grp", *PLAIN, *r4(*ROUNDED))


@query("overall_stats", f"WITH {PNL}, s AS (SELECT grp, {STAT} FROM pnl GROUP BY 1) SELECT grp, {', '.join(PLAIN)}, {q4(*ROUNDED)} FROM s")
def overall_stats(spark, sf):
    return S.group_stats(materialise(panel(spark, sf)), ["grp"], "value").select("grp", *PLAIN, *r4(*ROUNDED))


@query("line_item_quantiles", f"WITH s AS (SELECT l_returnflag AS rf, l_linestatus AS ls, {', '.join(f'quantile_cont(l_extendedprice, {p}) AS {n}' for n, p in S.QUANTILES.items())} FROM lineitem GROUP BY 1, 2) SELECT rf, ls, {q4(*S.QUANTILES)} FROM s")
def line_item_quantiles(spark, sf):
    """Exact quantiles of all line items by group."""
    li = R.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"), "l_extendedprice")
    return exact_quantiles(li, ["rf", "ls"], "l_extendedprice", S.QUANTILES).select("rf", "ls", *r4(*S.QUANTILES))


def _g(g):
    return f"CAST(count(*) FILTER (WHERE grp = '{g}') AS BIGINT) AS {g}"


@query("group_count_wide", f"WITH {PNL} SELECT year, {', '.join(_g(g) for g in GROUPS)} FROM pnl GROUP BY 1")
def group_count_wide(spark, sf):
    """year x group table of one statistic."""
    stats = panel(spark, sf).groupBy("year", "grp").agg(F.count("*").alias("n"))
    return S.by_period_wide(stats, "year", "grp", GROUPS, "n").na.fill(0)


@query("weighted_mean", f"WITH {PNL}, s AS (SELECT year, grp, sum(value * w) / sum(w) AS weighted_mean, count(*) AS n FROM pnl GROUP BY 1, 2) SELECT year, grp, n, {q4('weighted_mean')} FROM s")
def weighted_mean(spark, sf):
    return S.weighted_mean(panel(spark, sf), ["year", "grp"], "value", "w").select("year", "grp", "n", *r4("weighted_mean"))


@query("weight_shares", f"""WITH p AS (SELECT c_mktsegment AS grp, c_nationkey AS nation, sum(CAST(round(abs(c_acctbal) * 100) AS BIGINT)) AS w FROM customer GROUP BY 1, 2), t AS (SELECT *, w / sum(w) OVER (PARTITION BY grp) AS share, row_number() OVER (PARTITION BY grp ORDER BY w DESC, nation) AS rank FROM p)
SELECT grp, nation, CAST(rank AS INT) AS rank, share FROM t WHERE rank <= 4""")
def weight_shares(spark, sf):
    """The four entities with the largest share of their group's weight."""
    c = R.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("grp"), F.col("c_nationkey").alias("nation"), F.round(F.abs("c_acctbal") * 100).cast("long").alias("w"))
    return S.weight_shares(c, "grp", "nation", "w")


BOUNDS = "bnd AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM pnl)"


@query("trimmed_stats", f"WITH {PNL}, {BOUNDS}, s AS (SELECT year, grp, count(*) AS n, avg(value) AS mean FROM pnl, bnd WHERE value BETWEEN lo AND hi GROUP BY 1, 2) SELECT year, grp, n, {q4('mean')} FROM s")
def trimmed_stats(spark, sf):
    """Group means without the pooled tails."""
    kept, _ = S.trim(materialise(panel(spark, sf)), "value", 0.01, 0.99)
    return kept.groupBy("year", "grp").agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select("year", "grp", "n", *r4("mean"))


@query("trimmed_out", f"WITH {PNL}, {BOUNDS} SELECT country_key, year, value FROM pnl, bnd WHERE value NOT BETWEEN lo AND hi")
def trimmed_out(spark, sf):
    return S.trim(materialise(panel(spark, sf)), "value", 0.01, 0.99)[1].select("country_key", "year", "value")


@query("series_volatility", f"WITH {PNL}, s AS (SELECT year, grp, avg(value) AS m FROM pnl GROUP BY 1, 2), t AS (SELECT grp, stddev_samp(m) AS sd, avg(m) AS mean FROM s GROUP BY 1) SELECT grp, {q4('sd', 'mean')} FROM t")
def series_volatility(spark, sf):
    m = panel(spark, sf).groupBy("year", "grp").agg(F.avg("value").alias("m"))
    return S.volatility(m, ["grp"], "m").select("grp", *r4("sd", "mean"))


@query("carry_forward", f"""WITH s AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT * FROM s UNION ALL SELECT nation, CAST(y AS INT), n FROM s, range(2002, 2005) t(y) WHERE year = (SELECT max(year) FROM s)""")
def carry_forward(spark, sf):
    """The last year of a series repeated for the years after it."""
    o, c = R.table(spark, sf, "orders"), R.table(spark, sf, "customer")
    s = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation"), F.year(F.to_date("o_orderdate")).alias("year")).agg(F.count("*").alias("n"))
    return S.carry_forward(s, "nation", "year", 2004)


# ---- tail ------------------------------------------------------------------------------------------------------------
CHOSEN = f"""{PNL}, thr AS (SELECT quantile_cont(value, 0.95) AS t FROM pnl), top AS (SELECT pnl.* FROM pnl, thr WHERE value >= t)"""


def chosen(spark, sf, reuse=False):
    """(loaded values, the chosen value of line 5 per entity and year). reuse: values are written once, for callers that read them
    beside the choice: each reader would carry the plan that loads them, with its shuffles and broadcasts, along."""
    kept = ["json_file", "row_no", "label_verbatim"]
    v = C.load_values(R.long_rows(spark, sf), None, kept)
    if reuse:
        v = materialise(v.select("country_key", "effective_year", "hierarchy_id", "value_num", "source_round", *kept), "zstd")
    five = pick.by_priority(v.filter("hierarchy_id = '5'"), ["country_key", "effective_year"], "source_round", C.PRIORITY, [F.col("json_file"), F.col("row_no")])
    c = R.table(spark, sf, "customer").select(R.text("customer ", F.col("c_custkey")).alias("country_key"), F.col("c_mktsegment").alias("grp"))
    return v, five.select("country_key", F.col("effective_year").alias("year"), F.col("value_num").alias("value"), "json_file", "source_round").join(c, "country_key")


@query("tail_top5", f"""WITH {CHOSEN}, cp AS (SELECT json_file, ey, {", ".join(f"max(CASE WHEN hierarchy_id = '{h}' THEN v END) AS h{h}" for h in ("1", "3", "4"))} FROM val GROUP BY 1, 2),
sb AS (SELECT json_file, ey, label_verbatim AS l, v FROM (SELECT val.*, label_verbatim FROM val JOIN rws USING (json_file, row_no) WHERE val.hierarchy_id = '5.1')),
o AS (SELECT country_key, year, grp, value, h1, h3, h4, l AS largest_subitem, sb.v AS subitem_value, CASE WHEN l IS NULL THEN 'No sub-item reported' ELSE 'Other / unspecified' END AS driver, value / nullif(h1, 0) AS share_of_change
  FROM top LEFT JOIN cp ON cp.json_file = top.json_file AND cp.ey = year LEFT JOIN sb ON sb.json_file = top.json_file AND sb.ey = year) SELECT * EXCLUDE (share_of_change), {q4('share_of_change')} FROM o""")
def tail_top5(spark, sf):
    """The top five percent with companions of the same report, the largest sub-item and its driver."""
    v, five = chosen(spark, sf, reuse=True)
    t = A.tail_anatomy(materialise(five), v, "value", "5", {"1": "h1", "3": "h3", "4": "h4"}, "row_no")
    return t.select("country_key", "year", "grp", "value", "h1", "h3", "h4", "largest_subitem", "subitem_value", "driver", *r4("share_of_change"))


@query("over_representation", f"""WITH {CHOSEN}, a AS (SELECT grp, count(*) / (SELECT count(*) FROM pnl) AS ss FROM pnl GROUP BY 1), b AS (SELECT grp, count(*) / (SELECT count(*) FROM top) AS sp FROM top GROUP BY 1)
SELECT grp, coalesce(sp, 0) AS share_part, ss AS share_sample, coalesce(sp, 0) / ss AS ratio FROM a LEFT JOIN b USING (grp)""")
def over_representation(spark, sf):
    five = materialise(chosen(spark, sf)[1])
    return S.over_representation(five, S.tail(five, "value"), "grp")


@query("group_by_framework", f"""WITH {R.REPORTS} SELECT c_mktsegment AS grp, {", ".join(f"count(*) FILTER (WHERE framework = '{f}') AS {f}" for f in ("LIC_DSF", "MAC_DSA", "SRDSF"))} FROM rpt JOIN customer ON ck = c_custkey GROUP BY 1""")
def group_by_framework(spark, sf):
    c = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("ck"), F.col("c_mktsegment").alias("grp"))
    return S.crosstab(R.reports(spark, sf).join(c, "ck"), "grp", "framework", ["LIC_DSF", "MAC_DSA", "SRDSF"])


@query("group_membership", f"""WITH {R.REPORTS}, fw AS (SELECT country, framework, count(*) AS n FROM rpt GROUP BY 1, 2), m AS (SELECT country, framework AS main_framework FROM fw QUALIFY row_number() OVER (PARTITION BY country ORDER BY n DESC, framework) = 1)
SELECT country, CASE c_mktsegment WHEN 'BUILDING' THEN 'AE' WHEN 'MACHINERY' THEN 'LIDC' ELSE 'EMMIE' END AS grp, main_framework FROM m JOIN customer ON country = 'Customer ' || c_custkey""")
def group_membership(spark, sf):
    """Groups from membership lists with a default, and the framework used most."""
    k = F.col("c_custkey")
    members = R.table(spark, sf, "customer").filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select(
        R.text("Customer ", k).alias("country"), F.when(F.col("c_mktsegment") == "BUILDING", "AE").otherwise("LIDC").alias("grp"))
    names = R.reports(spark, sf)
    return S.membership(names.select("country").distinct(), members, "EMMIE", "country").join(pick.most_common(names, ["country"], "framework", "main_framework"), "country")


# ---- contributions ------------------------------------------------------------------------------------------------------
NAMED = [n for n, _ in RULES]
ITEMS = NAMED + ["Other"]
CTB = f"""{VALS}, li AS (SELECT val.*, label_verbatim, {CATEGORY_SQL.format('label_verbatim')} AS cat FROM val JOIN rws USING (json_file, row_no) WHERE val.hierarchy_id IN ('5', '5.1')),
rpc AS (SELECT country_key, json_file, source_round, ey AS year, max(CASE WHEN hierarchy_id = '5' THEN v END) AS total, {", ".join(f"coalesce(sum(CASE WHEN hierarchy_id = '5.1' AND cat = '{n}' THEN v END), 0) AS {n}" for n in NAMED)} FROM li GROUP BY 1, 2, 3, 4),
rp AS (SELECT *, total - {" - ".join(NAMED)} AS Other FROM rpc WHERE total IS NOT NULL),
cy AS (SELECT country_key, year, avg(total) AS total, {", ".join(f"avg({n}) AS {n}" for n in ITEMS)}, count(*) AS n_reports FROM rp GROUP BY 1, 2),
cg AS (SELECT cy.*, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS grp FROM cy LEFT JOIN customer ON country_key = 'customer ' || c_custkey)"""


def contribution(spark, sf):
    groups = R.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(R.text("customer ", F.col("c_custkey")).alias("country_key"), F.col("c_mktsegment").alias("grp"))
    # the placeholder exclusion of the default rules has its counterpart in the query's own rules
    return A.contributions(R.long_rows(spark, sf), "5", groups, "grp", [("Other", "small bolt"), *RULES], NAMED, order="row_no")


@query("contribution_reports", f"WITH {CTB} SELECT country_key, json_file, year, total, {', '.join(ITEMS)} FROM rp")
def contribution_reports(spark, sf):
    """Per report: the total, the sum of each named category, and what is left."""
    return contribution(spark, sf).reports.select("country_key", "json_file", "year", "total", *ITEMS)


@query("contribution_country_years", f"WITH {CTB} SELECT country_key, year, n_reports, {q4('total', *ITEMS)} FROM cy")
def contribution_country_years(spark, sf):
    return contribution(spark, sf).country_years.select("country_key", "year", "n_reports", *r4("total", *ITEMS))


SHARES = f"""{", ".join(f"sum(abs({n})) AS gross_{n}, sum({n}) / count(*) AS net_mean_{n}, count(*) FILTER (WHERE abs({n}) > 1e-9) AS n_nonzero_{n}" for n in ITEMS)}"""
GROSS = " + ".join(f"gross_{n}" for n in ITEMS)
SH_OUT = ", ".join(f"round(gross_{n} / ({GROSS}), 6) AS share_{n}, floor(gross_{n} / 100) AS gross_{n}, floor(net_mean_{n} * 10) / 10 AS net_mean_{n}, n_nonzero_{n}" for n in ITEMS)


@query("contribution_shares", f"""WITH {CTB}, s AS (SELECT 'All' AS g, count(DISTINCT country_key) AS n_entities, count(*) AS n_entity_periods, {SHARES} FROM cg UNION ALL SELECT grp, count(DISTINCT country_key), count(*), {SHARES} FROM cg WHERE grp IS NOT NULL GROUP BY 1)
SELECT g AS "group", n_entities, n_entity_periods, {SH_OUT} FROM s""")
def contribution_shares(spark, sf):
    """Gross share, gross sum, net mean and non-zero count per item: for all entities and for each group."""
    s = contribution(spark, sf).shares
    return s.select("group", "n_entities", "n_entity_periods", *[c for n in ITEMS for c in (
        F.round(f"share_{n}", 6).alias(f"share_{n}"), F.floor(F.col(f"gross_{n}") / 100).cast("double").alias(f"gross_{n}"),
        (F.floor(F.col(f"net_mean_{n}") * 10) / 10).alias(f"net_mean_{n}"), F.col(f"n_nonzero_{n}"))])


@query("contribution_balance", f"WITH {CTB} SELECT max(abs(total - ({' + '.join(ITEMS)}))) < 1e-6 AS balanced FROM cy")
def contribution_balance(spark, sf):
    return contribution(spark, sf).balance.select((F.col("max_error") < 1e-6).alias("balanced"))


def _lg(g):
    cond = f"coalesce(c_mktsegment, 'unclassified') = '{g}'"
    return f"count(*) FILTER (WHERE {cond}) AS n_rows_{g}, count(*) FILTER (WHERE {cond} AND v <> 0) AS n_nonzero_{g}, coalesce(sum(abs(v)) FILTER (WHERE {cond}), 0) AS gross_{g}"


@query("label_check", f"""WITH {CTB} SELECT cat AS category, label_verbatim AS label, {_lg('MACHINERY')}, {_lg('FURNITURE')}, {_lg('unclassified')}, sum(abs(v)) AS gross_total FROM li LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON country_key = 'customer ' || c_custkey
WHERE hierarchy_id = '5.1' GROUP BY 1, 2""")
def label_check(spark, sf):
    """Every sub-item label with its category, and how much it carries in each group."""
    v = C.load_values(R.long_rows(spark, sf), ["5.1"], ["label_verbatim"])
    g = R.table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(R.text("customer ", F.col("c_custkey")).alias("country_key"), F.col("c_mktsegment").alias("grp"))
    v = v.join(g, "country_key", "left").withColumn("category", label_category("label_verbatim", RULES, "small bolt")).withColumnRenamed("label_verbatim", "label")
    return S.label_check(v, "category", "label", "grp", ["MACHINERY", "FURNITURE"])
