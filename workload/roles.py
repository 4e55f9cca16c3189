"""The given tables in the roles the operators expect, and the same derivations as SQL.

An order is a report, its customer the entity, its date the publication date; the lines of an order are the
line items. Irregular labels, spellings and values are derived from keys by integer arithmetic, so that both
engines see the same text. Every table is used whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.items import CATEGORIES


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(*parts) -> Column:
    return F.concat(*[(F.lit(p) if isinstance(p, str) else p.cast("string")) for p in parts])


def case(default, *pairs) -> Column:
    out = F.when(pairs[0][0], pairs[0][1])
    for cond, value in pairs[1:]:
        out = out.when(cond, value)
    return out.otherwise(default)


# ---- reports ------------------------------------------------------------------------------------------

def orders(spark: SparkSession, sf: str) -> DataFrame:
    """What a report is told from: key, customer, day, priority and status of its order."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"), F.to_date("o_orderdate").alias("report_date"),
                                             F.col("o_orderpriority").alias("pr"), F.col("o_orderstatus").alias("st"))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    return tell_reports(orders(spark, sf))


def tell_reports(rows: DataFrame) -> DataFrame:
    """The facts of a report, from its order's columns; other columns of the rows go along."""
    more = [c for c in rows.columns if c not in ("k", "ck", "report_date", "pr", "st")]
    k, year = F.col("k"), F.year("report_date")
    obs = year - 1 - case(F.lit(0), (k % 41 == 0, F.lit(4)), (k % 3 == 0, F.lit(1)))
    d = rows.select("k", "ck", text("Customer ", F.col("ck")).alias("country"), "report_date", year.alias("pub_year"), obs.alias("obs"), "pr", "st", *more)
    k, obs = F.col("k"), F.col("obs")
    stem = text(F.col("country"), "_", F.col("report_date"), "_", k)
    label = case(obs.cast("string"), (k % 31 == 5, text(obs - 3, "-", obs)),
                 (k % 7 == 0, text(obs - 1, "/", F.lpad((obs % 100).cast("string"), 2, "0"))), (k % 7 == 1, text("FY", obs)),
                 (k % 47 == 3, F.lit("n/a")))
    source = case(F.lit("round1"), (F.col("pr") == "2-HIGH", "round2"), (F.col("pr") == "3-MEDIUM", "round3"), (F.col("pr") == "4-NOT SPECIFIED", "gapfill"))
    return d.select(
        "k", "ck", "country", "report_date", "pub_year", "obs", stem.alias("stem"), text(stem, "_dsa.json").alias("json_file"),
        text(stem, ".pdf").alias("pdf_file_name"), F.when(k % 23 == 0, "False").otherwise("True").alias("table_found"),
        label.alias("last_actual_year"), source.alias("source_round"),
        F.when(source == "gapfill", text("run", k % 2 + 1)).alias("gapfill_run"),
        F.when(k % 29 == 0, "Yes").otherwise("No").alias("manual_review_required"),
        case(F.lit("LIC_DSF"), (F.col("st") == "O", "MAC_DSA"), (F.col("st") == "P", "SRDSF")).alias("framework"),
        F.when(k % 4 != 0, text("Report ", k)).alias("report_title"), *more)


REPORTS = r"""
rpt0 AS (SELECT o_orderkey AS k, o_custkey AS ck, 'Customer ' || o_custkey AS country, CAST(o_orderdate AS DATE) AS report_date,
  CAST(year(o_orderdate) AS INT) AS pub_year,
  CAST(year(o_orderdate) - 1 - CASE WHEN o_orderkey % 41 = 0 THEN 4 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS obs,
  o_orderpriority AS pr, o_orderstatus AS st FROM orders),
rpt AS (SELECT k, ck, country, report_date, pub_year, obs, country || '_' || report_date || '_' || k AS stem,
  country || '_' || report_date || '_' || k || '_dsa.json' AS json_file, country || '_' || report_date || '_' || k || '.pdf' AS pdf_file_name,
  CASE WHEN k % 23 = 0 THEN 'False' ELSE 'True' END AS table_found,
  CASE WHEN k % 31 = 5 THEN (obs - 3) || '-' || obs WHEN k % 7 = 0 THEN (obs - 1) || '/' || lpad(CAST(obs % 100 AS VARCHAR), 2, '0')
       WHEN k % 7 = 1 THEN 'FY' || obs WHEN k % 47 = 3 THEN 'n/a' ELSE CAST(obs AS VARCHAR) END AS last_actual_year,
  CASE pr WHEN '2-HIGH' THEN 'round2' WHEN '3-MEDIUM' THEN 'round3' WHEN '4-NOT SPECIFIED' THEN 'gapfill' ELSE 'round1' END AS source_round,
  CASE WHEN pr = '4-NOT SPECIFIED' THEN 'run' || (k % 2 + 1) END AS gapfill_run,
  CASE WHEN k % 29 = 0 THEN 'Yes' ELSE 'No' END AS manual_review_required,
  CASE st WHEN 'O' THEN 'MAC_DSA' WHEN 'P' THEN 'SRDSF' ELSE 'LIC_DSF' END AS framework,
  CASE WHEN k % 4 <> 0 THEN 'Report ' || k END AS report_title FROM rpt0)"""


# ---- line items ---------------------------------------------------------------------------------------

def lines(spark: SparkSession, sf: str, labels: bool = True) -> DataFrame:
    """One row per order and line number, with what `item_columns` are told from: cents and label (a part's name). labels=False leaves
    labels null, for what is told per report alone and doesn't ask for them."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ln"), "l_extendedprice", "l_partkey")
    # without labels, lines meet their order next: they are dealt by it, once
    li = (li if labels else li.repartition("k")).groupBy("k", "ln").agg(
        F.round(F.sum("l_extendedprice") * 100).cast("long").alias("cents"), F.min("l_partkey").alias("p_partkey"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("label_verbatim"))
    named = li.join(part, "p_partkey", "left") if labels else li.withColumn("label_verbatim", F.lit(None).cast("string"))
    return named.select("k", "ln", "cents", "label_verbatim")


def item_columns() -> list[Column]:
    """Hierarchy id, category, level, label, value text and place of a line."""
    k, ln, n = F.col("k"), F.col("ln"), F.col("cents")
    m = k + ln
    value = case(n.cast("string"), (m % 37 == 0, F.lit("n.a.")), (m % 11 == 0, F.lit("0.0")), (m % 5 == 0, text("-", n)),
                 (m % 13 == 0, text(F.floor(n / 1000), ",", F.lpad((n % 1000).cast("string"), 3, "0"))))
    hid = F.when(ln == 7, "5.1").otherwise(ln.cast("string"))
    top = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), F.when(ln == 7, 5).otherwise(ln))
    return [hid.alias("hierarchy_id"), top.alias("top_category"), F.when(ln == 7, "1").otherwise("0").alias("level"),
            F.col("label_verbatim"), value.alias("value"), (k * 10 + ln).alias("row_no")]


ITEMS = r"""
itm0 AS (SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS ln, CAST(round(sum(l_extendedprice) * 100) AS BIGINT) AS cents,
  min(l_partkey) AS pk FROM lineitem GROUP BY 1, 2),
itm AS (SELECT k, ln, cents, CASE WHEN ln = 7 THEN '5.1' ELSE CAST(ln AS VARCHAR) END AS hierarchy_id,
  CASE ln WHEN 1 THEN 'change_in_debt' WHEN 2 THEN 'identified_flows' WHEN 3 THEN 'primary_balance' WHEN 4 THEN 'automatic_debt_dynamics'
    WHEN 6 THEN 'residual' ELSE 'other_identified_flows' END AS top_category,
  CASE WHEN ln = 7 THEN '1' ELSE '0' END AS level, p_name AS label_verbatim,
  CASE WHEN (k + ln) % 37 = 0 THEN 'n.a.' WHEN (k + ln) % 11 = 0 THEN '0.0' WHEN (k + ln) % 5 = 0 THEN '-' || cents
       WHEN (k + ln) % 13 = 0 THEN CAST(cents // 1000 AS VARCHAR) || ',' || lpad(CAST(cents % 1000 AS VARCHAR), 3, '0')
       ELSE CAST(cents AS VARCHAR) END AS value, k * 10 + ln AS row_no FROM itm0 LEFT JOIN part ON pk = p_partkey)"""

ITEM_COLUMNS = ["hierarchy_id", "top_category", "level", "label_verbatim", "value", "row_no"]


def long_rows(spark: SparkSession, sf: str, audit: bool = False, labels: bool = True) -> DataFrame:
    """Reports with their line items; a report without a table keeps one row."""
    r = reports(spark, sf)
    li = lines(spark, sf, labels)
    if audit:
        # an audit is made once per report
        r = r.withColumn("column_header_audit_json", audit_json())
        found = r.filter("table_found = 'True'").join(li, "k")
    else:
        # numbers meet before texts are made of them
        found = tell_reports(orders(spark, sf).join(li, "k")).filter("table_found = 'True'")
    found = found.select(*r.columns, *item_columns())
    none = r.filter("table_found = 'False'").select("*", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ITEM_COLUMNS[:-1]],
                                                     (F.col("k") * 10).alias("row_no"))
    return found.unionByName(none)


LONG = REPORTS + "," + ITEMS + r""",
rws AS (SELECT rpt.*, hierarchy_id, top_category, level, label_verbatim, value, row_no FROM rpt JOIN itm USING (k) WHERE table_found = 'True'
  UNION ALL SELECT rpt.*, NULL, NULL, NULL, NULL, NULL, k * 10 FROM rpt WHERE table_found = 'False')"""


def audit_json() -> Column:
    """Header audit of a report: obs-3 .. obs actual, obs+1 estimate, obs+2 projection; sometimes a merged range."""
    obs, k = F.col("obs"), F.col("k")

    def cell(label: Column, status: str | Column) -> Column:
        return F.struct(label.cast("string").alias("year_label"), (F.lit(status) if isinstance(status, str) else status).alias("status"))
    single = F.transform(F.sequence(F.lit(-3), F.lit(2)), lambda d: cell(
        obs + d, F.when(d <= 0, F.when(k % 5 == 0, "Preliminary").otherwise("actual")).when(d == 1, "estimate").otherwise("projection")))
    merged = F.when(k % 31 == 5, F.array(cell(text(obs - 6, "-", obs - 4), "actual"))).otherwise(F.array().cast("array<struct<year_label:string,status:string>>"))
    return F.to_json(F.struct(F.concat(single, merged).alias("columns")))


# ---- runs ---------------------------------------------------------------------------------------------

def runs(spark: SparkSession, sf: str, labels: bool = True) -> DataFrame:
    """Three readings of the same reports: run 3 lacks some reports and misreads some years and values, run 2
    drops some line items and misses some tables."""
    rows = long_rows(spark, sf, labels=labels).select("k", "json_file", "pdf_file_name", "country", "obs", "table_found", "last_actual_year", "top_category",
                                       "hierarchy_id", "label_verbatim", "value", "row_no")
    r = rows.withColumn("run_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    run, k, ln = F.col("run_no"), F.col("k"), F.col("row_no") % 10
    m = k * 7 + ln
    no_table = (run == 2) & (k % 67 == 0)
    gone = ((run == 3) & (k % 89 == 0)) | ((run == 2) & (m % 97 == 0) & F.col("hierarchy_id").isNotNull())
    r = r.filter(~gone)
    value = case(F.col("value"), ((run == 3) & (m % 101 == 0) & F.col("value").rlike("^[0-9]+$"), text("1", F.col("value"))),
                 ((run == 2) & (m % 2 == 0) & F.col("value").rlike("^[0-9]+$"), text(F.col("value"), ".0")))
    out = r.withColumns({
        "table_found": F.when(no_table, "False").otherwise(F.col("table_found")),
        "last_actual_year": F.when((run == 3) & (k % 53 == 0), (F.col("obs") - 1).cast("string")).otherwise(F.col("last_actual_year")),
        "value": value,
        "label_verbatim": F.when((run == 2) & (m % 3 == 0), F.upper("label_verbatim")).otherwise(F.col("label_verbatim")),
        "top_category": F.when((run == 3) & (m % 103 == 0) & F.col("hierarchy_id").isNotNull(), F.lit("residual")).otherwise(F.col("top_category"))})
    item = ["top_category", "hierarchy_id", "label_verbatim", "value"]
    return out.withColumns({c: F.when(~no_table_of(), F.col(c)) for c in item}).drop("obs")


def no_table_of() -> Column:
    return (F.col("run_no") == 2) & (F.col("k") % 67 == 0)


RUNS = LONG + r""",
run0 AS (SELECT rws.*, r AS run_no, k * 7 + row_no % 10 AS m, r = 2 AND k % 67 = 0 AS nt FROM rws, (VALUES (1), (2), (3)) t(r)
  WHERE NOT (r = 3 AND k % 89 = 0) AND NOT (r = 2 AND (k * 7 + row_no % 10) % 97 = 0 AND hierarchy_id IS NOT NULL)),
run AS (SELECT k, json_file, pdf_file_name, country, run_no, row_no, CASE WHEN nt THEN 'False' ELSE table_found END AS table_found,
  CASE WHEN run_no = 3 AND k % 53 = 0 THEN CAST(obs - 1 AS VARCHAR) ELSE last_actual_year END AS last_actual_year,
  CASE WHEN nt THEN NULL WHEN run_no = 3 AND m % 103 = 0 AND hierarchy_id IS NOT NULL THEN 'residual' ELSE top_category END AS top_category,
  CASE WHEN NOT nt THEN hierarchy_id END AS hierarchy_id,
  CASE WHEN nt THEN NULL WHEN run_no = 2 AND m % 3 = 0 THEN upper(label_verbatim) ELSE label_verbatim END AS label_verbatim,
  CASE WHEN nt THEN NULL WHEN run_no = 3 AND m % 101 = 0 AND regexp_matches(value, '^[0-9]+$') THEN '1' || value
       WHEN run_no = 2 AND m % 2 = 0 AND regexp_matches(value, '^[0-9]+$') THEN value || '.0' ELSE value END AS value FROM run0)"""


# ---- SQL expressions ----------------------------------------------------------------------------------
TWO = r"(?i)^(?:FY\s?)?(\d{4})\s*[/-]\s*(\d{2}|\d{4})$"
ONE = r"(?i)^(?:FY\s?)?(\d{4})$"
NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def squeezed(t: str) -> str:
    s = rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"
    return f"CASE WHEN {s} <> '' AND lower({s}) <> 'nan' THEN {s} END"


def year_ab(t: str) -> tuple[str, str]:
    first, second = f"regexp_extract({t}, '{TWO}', 1)", f"regexp_extract({t}, '{TWO}', 2)"
    return (f"TRY_CAST({first} AS INT)",
            f"TRY_CAST(CASE WHEN length({second}) = 4 THEN {second} ELSE substr({first}, 1, 2) || {second} END AS INT)")


def year_kind(t: str) -> str:
    a, b = year_ab(t)
    return (f"CASE WHEN {t} IS NULL THEN 'invalid' WHEN {a} IS NOT NULL AND {b} - {a} = 1 THEN 'single' WHEN {a} IS NOT NULL AND {b} > {a} THEN 'range' "
            f"WHEN {a} IS NOT NULL THEN 'invalid' WHEN regexp_matches({t}, '{ONE}') THEN 'single' "
            rf"WHEN len(list_distinct(regexp_extract_all({t}, '\b(\d{{4}})\b', 1))) = 1 THEN 'single' ELSE 'invalid' END")


def year_end(t: str, start: bool = False) -> str:
    a, b = year_ab(t)
    return (f"CASE WHEN {t} IS NULL THEN NULL WHEN {a} IS NOT NULL AND {b} - {a} = 1 THEN {b} WHEN {a} IS NOT NULL AND {b} > {a} THEN {a if start else b} "
            f"WHEN {a} IS NOT NULL THEN NULL WHEN regexp_matches({t}, '{ONE}') THEN TRY_CAST(regexp_extract({t}, '{ONE}', 1) AS INT) "
            rf"WHEN len(list_distinct(regexp_extract_all({t}, '\b(\d{{4}})\b', 1))) = 1 THEN TRY_CAST(regexp_extract({t}, '\b(\d{{4}})\b', 1) AS INT) END")


def year_norm(t: str) -> str:
    a, b = year_ab(t)
    return (f"CASE WHEN {a} IS NOT NULL AND {b} - {a} = 1 THEN CAST({b} AS VARCHAR) WHEN {a} IS NOT NULL THEN lower({t}) "
            f"WHEN regexp_matches({t}, '{ONE}') THEN regexp_extract({t}, '{ONE}', 1) ELSE lower({t}) END")


def number(t: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '{NUM}') THEN TRY_CAST({t} AS DOUBLE) END"


def strict_num(c: str) -> str:
    return number(f"trim({c})")


def comma_num(c: str) -> str:
    return number(f"replace(trim({c}), ',', '')")


def minus_num(c: str) -> str:
    return number(f"replace(replace(replace(trim({c}), ',', ''), '−', '-'), '–', '-')")


CATEGORY_OF = "CASE split_part({0}, '.', 1) " + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in enumerate(CATEGORIES, 1)) + " END"
PRIORITY = "CASE {0} WHEN 'round1' THEN 0 WHEN 'round2' THEN 1 WHEN 'round3' THEN 2 WHEN 'gapfill' THEN 3 ELSE 4 END"
