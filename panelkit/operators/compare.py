"""Line-by-line comparison of repeated runs.

Runs arrive stacked in one table with a run number. One aggregate per report makes its facts; the rows meet them in the one
shuffle that carries lines, and the lines of all runs are lined up in columns where they then are.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.functions.numbers import comparable, same, tri_state
from panelkit.functions.text import percent_text, strip
from panelkit.functions.years import year_for_comparison
from panelkit.operators.pick import majority_of
from panelkit.session import materialise

# --- fixed values: the groups of reports and the categories of the re-check list --------------------
GROUPS = ["fully_match", "partial_match", "table_found_differs", "last_actual_year_differs",
          "missing_in_run", "extraction_failed_in_all_runs", "no_table_in_all_runs"]
RECHECK = {
    "partial_match": "category_a_disagreement", "table_found_differs": "category_a_disagreement",
    "last_actual_year_differs": "category_a_disagreement", "missing_in_run": "category_a_disagreement",
    "no_table_in_all_runs": "category_b_no_table_in_all_runs",
    "extraction_failed_in_all_runs": "category_c_extraction_failed_in_all_runs",
}
SUMMARY_COLUMNS = ["json_file", "pdf_file_name", "country", "group", "needs_check", "runs_present",
                   "table_found_by_run", "last_actual_year_by_run", "rows_compared", "rows_matching",
                   "rows_differing", "error_by_run"]
# ----------------------------------------------------------------------------------------------------


@dataclass
class RunComparison:
    """Lazy results: one row per report, the reports on which all runs agree, the lined-up lines, those beside their report's facts
    (`items`, without reports that have no table in any run), one summary row per report, differing rows, and matched keys; `source`: full
    rows of the matched keys, where a written comparison was asked to keep them."""
    n_runs: int
    facts: DataFrame
    agreed: DataFrame
    lines: DataFrame
    items: DataFrame
    summary: DataFrame
    diffs: DataFrame
    matched: DataFrame
    source: DataFrame | None = None


def key_hash(*keys: str) -> Column:
    """An integer that leads a grouping by long texts: sorts compare it, not texts that begin alike."""
    return F.hash(*keys).alias("__h")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def align_reports(rows: DataFrame, n: int, run: str, order: str, names: bool = True) -> DataFrame:
    """One row per report: file and country, its facts in every run (f<r>, of the first row of the run) and the report-level group.
    names=False leaves out file and country, which decide nothing."""
    named = ["pdf_file_name", "country"] if names else []
    told = [*named, "table_found", "last_actual_year"]
    runs = range(1, n + 1)
    # the lines of a report agree in its facts, mostly in all runs, so they meet by them first, in hash tables of numbers alone; what
    # is left moves as it is: partial results, with the facts of every run, would be wider than the rows they are made of
    once = rows.groupBy("json_file", *told).agg(*[F.min(F.when(F.col(run) == r, F.col(order))).alias(f"__at{r}") for r in runs])
    # normalised once for all runs that agree, and before the last aggregate: a filter on the group would otherwise be pushed below
    # the normalised columns, with a copy of them for each mention
    once = once.select("json_file", *named, tri_state("table_found").alias("found"), year_for_comparison("last_actual_year").alias("year"), *[f"__at{r}" for r in runs])
    once = once.repartition("json_file").select("json_file", key_hash("json_file"), F.struct(*named, "found", "year").alias("fact"), *[f"__at{r}" for r in runs])
    first = once.groupBy("__h", "json_file").agg(*[F.min_by("fact", f"__at{r}").alias(f"f{r}") for r in runs])
    facts = first.select("json_file", *[F.coalesce(*[F.col(f"f{r}")[c] for r in runs]).alias(c) for c in named], *[
        F.when(F.col(f"f{r}").isNotNull(), F.struct(F.col(f"f{r}.found").alias("found"), F.col(f"f{r}.year").alias("year"))).alias(f"f{r}") for r in runs])
    f = [F.col(f"f{r}") for r in range(1, n + 1)]
    present = _all([x.isNotNull() for x in f])
    found_same = _all([x["found"].isNotNull() & (x["found"] == f[0]["found"]) for x in f])
    year_same = _all([x["year"].eqNullSafe(f[0]["year"]) for x in f[1:]])
    return facts.withColumn("report_group", (
        F.when(~present, "missing_in_run")
        .when(~found_same, "table_found_differs")
        .when(~f[0]["found"], "no_table_in_all_runs")
        .when(~year_same, "last_actual_year_differs")))


def align_items(rows: DataFrame, n: int, run: str, order: str) -> DataFrame:
    """One row per (report, line item): the item in every run (the last row of a run wins), as val<r> (null: not in the run),
    top<r> and told<r>.

    Values are read before they meet, once per row; what a caller doesn't ask for (categories, texts) is left out of the
    exchange, as each has an aggregate of its own.
    """
    kept = {"val": comparable("value"), "top": F.col("top_category"), "told": F.struct(F.col("label_verbatim").alias("label"), F.col("value").alias("raw"))}
    rows = rows.filter(F.col("top_category").isNotNull()).select("json_file", "hierarchy_id", run, order, key_hash("json_file", "hierarchy_id"), *[c.alias(k) for k, c in kept.items()])
    items = rows.groupBy("__h", "json_file", "hierarchy_id").agg(*[
        F.max_by(k, F.when(F.col(run) == r, F.col(order))).alias(f"{k}{r}") for r in range(1, n + 1) for k in kept]).drop("__h")
    return items.withColumn("row_type", _row_type(n))


def _unless(c: Column, like: Column) -> Column:
    """The value in a struct, or null where it is that of another column."""
    return F.when(~c.eqNullSafe(like), F.struct(c.alias("v")))


def _or_else(c: Column, like: Column) -> Column:
    """The value that `_unless` told."""
    return F.when(c.isNotNull(), c["v"]).otherwise(like)


def _row_type(n: int) -> Column:
    """Why the runs differ in a line: missing_row, category or value; null where they agree."""
    runs = range(1, n + 1)
    present = _all([F.col(f"val{r}").isNotNull() for r in runs])
    one_top = _all([F.col(f"top{r}") == F.col("top1") for r in runs[1:]])
    one_value = _all([same(F.col("val1"), F.col(f"val{r}")) for r in runs[1:]])
    return F.when(~present, "missing_row").when(~one_top, "category").when(~one_value, "value")


def line_up(rows: DataFrame, facts: DataFrame, n: int, run: str, order: str, source_run: int | None = None, keep: list[str] = ()) -> DataFrame:
    """Rows beside their report's facts with the line of every run (top<r>, val<r>, told<r>, row_type as in `align_items`): one row
    per line (`is_line`), one for a report without lines, and with source_run every row of that run (`is_source`), whose columns `keep`
    are under `own` unless they are the line's.

    Rows move once and are lined up by windows where they met their report. Hot reports are spread: where one was cut, adaptive
    execution deals its rows anew, by line. Of other runs than the source only what is compared goes along.
    """
    runs = range(1, n + 1)
    line = ["hierarchy_id", "top_category", order, run, "label_verbatim", "value"]
    from_source = F.lit(False) if source_run is None else F.col(run) == source_run
    rest = [c for c in keep if c not in ("json_file", *line)]
    # a struct meets reports without a name too
    key = [F.xxhash64("json_file").alias("__h"), F.struct("json_file").alias("__k")]
    # what only the source has comes last, in one piece: the rows of a report then begin alike and take few bytes
    moved = rows.select(*key, *line, *([F.when(from_source, F.struct(*rest)).alias("__rest")] if rest else []))
    # one short row per report: held in a hash table, it spares the lines a sort
    met = moved.join(facts.select(*key, *facts.columns[1:]).hint("shuffle_hash"), ["__h", "__k"])
    met = met.withColumns({"__val": comparable("value"), "__told": F.struct(F.col("label_verbatim").alias("label"), F.col("value").alias("raw"))})
    place = Window.partitionBy("__h", "__k", "hierarchy_id").orderBy(F.col("top_category").isNull(), run)
    whole = place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = {f"{k}{r}": F.max_by(c, F.when(F.col("top_category").isNotNull() & (F.col(run) == r), F.col(order))).over(whole)
            for r in runs for k, c in (("val", "__val"), ("__top", "top_category"), ("told", "__told"))}
    out = met.withColumns({**last, "__at": F.row_number().over(place)})
    named = F.col("__k.json_file").isNotNull()
    out = out.withColumn("is_source", F.coalesce(from_source & F.col("hierarchy_id").isNotNull() & named, F.lit(False)))
    out = out.filter((F.col("__at") == 1) | F.col("is_source"))
    at = {"label_verbatim": "__told.label", "value": "__told.raw", **{c: f"__rest.{c}" for c in rest}}
    own = [F.col(at.get(c, c)).alias(c) for c in keep if c not in ("json_file", "hierarchy_id")]
    return out.select(
        F.col("__k.json_file").alias("json_file"), "hierarchy_id", ((F.col("__at") == 1) & F.col("top_category").isNotNull()).alias("is_line"), "is_source",
        *[F.col(f"val{r}") for r in runs], *[F.col(f"__top{r}").alias(f"top{r}") for r in runs], *[F.col(f"told{r}") for r in runs],
        *facts.columns[1:], *([F.when(F.col("is_source"), F.struct(*own)).alias("own")] if own else [])).withColumn("row_type", _row_type(n))


def compare_runs(rows: DataFrame, n_runs: int, run: str = "run_no", order: str = "row_no", reuse: bool = False, reports: DataFrame | None = None,
                 source_run: int | None = None, keep: list[str] | None = None) -> RunComparison:
    """Compare `n_runs` (>= 2) stacked runs; `order` is the row's place in its run. reuse: lines are lined up beside their report's facts and
    written once, for callers that write several of the tables; with source_run the rows of that run go along, as `matched_rows` returns them,
    or those of their columns that a caller wants to keep.
    reports: the same rows to read the facts of reports from, where they can be had without what only lines need (labels)."""
    if n_runs < 2:
        raise ValueError("at least two runs are needed")
    cols = ["json_file", "pdf_file_name", "country", "table_found", "last_actual_year", "top_category",
            "hierarchy_id", "label_verbatim", "value", run, order]
    reports, full, rows = (rows if reports is None else reports).select(*cols), rows, rows.select(*cols)
    facts = align_reports(reports, n_runs, run, order)
    runs = range(1, n_runs + 1)
    no_table = F.col("report_group").eqNullSafe(F.lit("no_table_in_all_runs"))
    is_match = F.col("row_type").isNull() & F.col("report_group").isNull()
    f = [F.col(f"f{r}") for r in runs]
    # booleans are written True / False
    shown = [F.coalesce(F.initcap(x["found"].cast("string")), F.lit("")) for x in f]
    told = {"runs_present": F.concat_ws("|", *[F.when(x.isNotNull(), "yes").otherwise("no") for x in f]),
            "table_found_by_run": F.concat_ws("|", *shown), "last_actual_year_by_run": F.concat_ws("|", *[F.coalesce(x["year"], F.lit("")) for x in f])}
    source = None
    if reuse:
        keep = [] if source_run is None else full.columns if keep is None else keep
        # what repeats another column of its row is written once: values are read from the texts again, runs and the source's own
        # columns tell where they differ from run 1 and from the line
        lined = line_up(full, facts, n_runs, run, order, source_run, keep).drop(*[f"val{r}" for r in runs])
        like = {"pdf_file_name": F.col("pdf_file_name"), "country": F.col("country")}
        if source_run in runs:
            like |= {"top_category": F.col(f"top{source_run}"), "label_verbatim": F.col(f"told{source_run}.label"), "value": F.col(f"told{source_run}.raw")}
        apart = {f"told{r}": F.when(F.col(f"told{r}").isNotNull(), F.struct(*[_unless(F.col(f"told{r}")[k], F.col("told1")[k]).alias(k) for k in ("label", "raw")])) for r in runs[1:]}
        if "own" in lined.columns:
            apart["own"] = F.when(F.col("is_source"), F.struct(*[(_unless(F.col("own")[c], like[c]) if c in like else F.col("own")[c]).alias(c) for c in lined.schema["own"].dataType.names]))
        lined = materialise(lined.withColumns(apart), "zstd")
        lined = lined.withColumns({f"told{r}": F.when(F.col(f"told{r}").isNotNull(), F.struct(*[_or_else(F.col(f"told{r}")[k], F.col("told1")[k]).alias(k) for k in ("label", "raw")])) for r in runs[1:]})
        read = lined.withColumns({f"val{r}": F.when(F.col(f"told{r}").isNotNull(), comparable(F.col(f"told{r}.raw"))) for r in runs}).drop("own")
        facts = lined.select(*facts.columns).distinct()
        agreed = lined.filter(F.col("report_group").isNull() & F.col("json_file").isNotNull()).select("json_file").distinct()
        items = read.filter("is_line").select("json_file", "hierarchy_id", *[f"{k}{r}" for r in runs for k in ("val", "top", "told")], "row_type")
        aligned = read.filter("is_line and json_file is not null")
        a_line = F.col("is_line") & F.col("json_file").isNotNull()
        # one row per report: grouped by what is shown of it, in hash tables of numbers alone
        per = lined.withColumns(told).groupBy("json_file", "pdf_file_name", "country", "report_group", *told).agg(
            F.count_if(a_line).alias("n_rows"), F.count_if(a_line & F.col("row_type").isNull()).alias("n_equal"))
        if source_run is not None:
            def own(c: str) -> Column:
                return F.col(c) if c in ("json_file", "hierarchy_id") else _or_else(F.col("own")[c], like[c]) if c in like else F.col("own")[c]
            source = lined.filter(F.col("is_source") & is_match).select(*[own(c).alias(c) for c in keep])
    else:
        agreed = align_reports(reports, n_runs, run, order, names=False).filter(F.col("report_group").isNull()).select("json_file")
        items = align_items(rows, n_runs, run, order)
        aligned = line_up(rows, facts, n_runs, run, order).filter("is_line and json_file is not null")
        # the report's own counts need no facts, so they are reduced to one row per report before the join
        counts = items.groupBy("json_file").agg(F.count("*").alias("n_rows"), F.count_if(F.col("row_type").isNull()).alias("n_equal"))
        per = facts.join(counts, "json_file", "left").withColumns(told)
    aligned = aligned.filter(~no_table)
    n_rows = F.when(no_table, 0).otherwise(F.coalesce("n_rows", F.lit(0)))
    n_match = F.when(F.col("report_group").isNull(), F.coalesce("n_equal", F.lit(0))).otherwise(0)
    group = F.coalesce(F.col("report_group"), F.when(n_rows == n_match, "fully_match")
                       .otherwise("partial_match"))
    summary = per.select(
        "json_file", "pdf_file_name", "country", group.alias("group"), F.when(group == "fully_match", "No").otherwise("Yes").alias("needs_check"),
        "runs_present", "table_found_by_run", "last_actual_year_by_run",
        n_rows.alias("rows_compared"), n_match.alias("rows_matching"), (n_rows - n_match).alias("rows_differing"),
        F.lit("").alias("error_by_run"))

    matched = aligned.filter(is_match).select("json_file", "hierarchy_id")
    return RunComparison(n_runs, facts, agreed, items, aligned, summary, _diff_rows(aligned.filter(~is_match), n_runs), matched, source)


def _pair_ok(a: Column, b: Column) -> Column:
    """Both present and equal, or both absent."""
    return (a.isNotNull() == b.isNotNull()) & (a.isNull() | same(a, b))


def _diff_rows(aligned: DataFrame, n: int) -> DataFrame:
    x = {r: F.col(f"val{r}") for r in range(1, n + 1)}
    pairs = {(a, b): _pair_ok(x[a], x[b]) for a, b in combinations(x, 2)}
    nums = F.filter(F.array(*[x[r]["num"] for r in x]), lambda v: v.isNotNull())
    return aligned.select(
        F.concat_ws("||", "json_file", "hierarchy_id").alias("key"), "json_file", "hierarchy_id",
        "pdf_file_name", "country",
        F.coalesce(*[F.col(f"top{r}") for r in x]).alias("top_category"),
        *[F.col(f"told{r}.label").alias(f"label_run{r}") for r in x],
        *[x[r]["num"].alias(f"value_run{r}") for r in x],
        *[F.when(x[r]["txt"].isNotNull(), strip(F.col(f"told{r}.raw"))).alias(f"text_run{r}") for r in x],
        *[ok.alias(f"run{a}_run{b}_match") for (a, b), ok in pairs.items()],
        _all(list(pairs.values())).alias("all_match"),
        F.when(F.size(nums) >= 2, F.array_max(nums) - F.array_min(nums)).alias("max_abs_diff"),
        F.coalesce(F.col("report_group"), F.col("row_type")).alias("diff_type"))


def matched_rows(rows: DataFrame, comparison: RunComparison, source_run: int = 1, run: str = "run_no", order: str = "row_no") -> DataFrame:
    """Full rows of the source run whose key matched in every run; `rows` are those of all compared runs.

    Rows move once: they meet the reports on which the runs agree (semi join, hot reports spread), and the lines of a report are
    lined up by windows where they then are. Only where a hot report was cut, adaptive execution deals its rows anew, by line.
    Of the other runs only what is compared goes along.
    """
    runs = range(1, comparison.n_runs + 1)
    is_source = F.col(run) == source_run
    compared = ["json_file", "hierarchy_id", "top_category", order, run, "value"]
    told = [F.when(is_source, F.col(c)).alias(c) for c in rows.columns if c not in compared]
    lines = rows.filter(F.col("hierarchy_id").isNotNull() & (is_source | F.col(run).isin(*runs))).select(*compared[:-2], *told, *compared[-2:])
    key = F.xxhash64("json_file")
    # one short row per report: held in a hash table, it spares the lines a sort
    agreed = comparison.agreed.withColumn("__h", key).hint("shuffle_hash")
    lines = lines.withColumn("__h", key).join(agreed, ["__h", "json_file"], "left_semi")
    val = comparable("value")
    lines = lines.withColumn("__val", val).withColumns({"__num": F.col("__val.num"), "__txt": F.col("__val.txt"), "value": F.when(is_source, F.col("value"))}).drop("__val")
    line = Window.partitionBy("__h", "json_file", "hierarchy_id")
    last = {f"__{c}{r}": F.max_by(source, F.when(F.col("top_category").isNotNull() & (F.col(run) == r), F.col(order))).over(line)
            for r in runs for c, source in (("top", "top_category"), ("n", "__num"), ("t", "__txt"))}
    tops = [F.col(f"__top{r}") for r in runs]
    vals = [{"num": F.col(f"__n{r}"), "txt": F.col(f"__t{r}")} for r in runs]
    equal = _all([t == tops[0] for t in tops[1:]]) & _all([same(vals[0], v) for v in vals[1:]])
    return lines.withColumns(last).filter(is_source & equal).select(*rows.columns)


def failed_everywhere(errors: DataFrame, known: DataFrame, n_runs: int) -> DataFrame:
    """Reports with an error file and no result in any run. errors: (run_no, stem, message)."""
    message = F.coalesce(F.nullif(strip("message"), F.lit("")), F.lit("(no error message)"))
    e = errors.withColumn("json_file", F.concat(F.col("stem"), F.lit("_dsa.json"))).withColumn("message", message)
    e = e.join(known.select("json_file").distinct(), "json_file", "left_anti")
    per = e.groupBy("json_file", "stem").agg(*[
        F.max(F.when(F.col("run_no") == r, F.col("message"))).alias(f"m{r}") for r in range(1, n_runs + 1)])
    texts = [F.concat(F.lit(f"run{r}: "), F.coalesce(F.col(f"m{r}"), F.lit("(no _ERROR.json or _dsa.json found)")))
             for r in range(1, n_runs + 1)]
    blank = "|".join([""] * n_runs)
    return per.select(
        "json_file", F.concat(F.col("stem"), F.lit(".pdf")).alias("pdf_file_name"),
        F.nullif(F.regexp_extract("stem", r"^(.+?)_\d{4}-\d{2}-\d{2}", 1), F.lit("")).alias("country"),
        F.lit("extraction_failed_in_all_runs").alias("group"), F.lit("Yes").alias("needs_check"),
        F.lit("|".join(["no"] * n_runs)).alias("runs_present"), F.lit(blank).alias("table_found_by_run"),
        F.lit(blank).alias("last_actual_year_by_run"),
        *[F.lit(0).cast("long").alias(c) for c in ("rows_compared", "rows_matching", "rows_differing")],
        F.concat_ws(" | ", *texts).alias("error_by_run"))


def group_counts(summary: DataFrame) -> DataFrame:
    """All seven groups with their count and share, also those that do not occur."""
    agg = summary.agg(F.count("*").alias("total"), *[F.count_if(F.col("group") == g).alias(g) for g in GROUPS])
    rows = F.array(*[F.struct(F.lit(g).alias("group"), F.col(g).alias("n_reports")) for g in GROUPS])
    return (agg.select("total", F.explode(rows).alias("r")).select("r.*", "total")
            .select("group", "n_reports", percent_text("n_reports", "total").alias("share")))


def diff_type_counts(diffs: DataFrame) -> DataFrame:
    """Differing rows by cause, with their share (total over the few causes, not over the rows)."""
    by = diffs.groupBy("diff_type").agg(F.count("*").alias("n_rows"))
    total = by.agg(F.sum("n_rows").alias("t")).scalar()
    return by.withColumn("total", total).select("diff_type", "n_rows", percent_text("n_rows", "total").alias("share"))


def headline(summary: DataFrame) -> DataFrame:
    """One row of totals: reports by outcome, data points matched and differing."""
    c = {g: F.count_if(F.col("group") == g) for g in GROUPS}
    disagree = F.count("*") - c["fully_match"] - c["no_table_in_all_runs"] - c["extraction_failed_in_all_runs"]
    return summary.agg(
        F.count("*").alias("reports"), c["fully_match"].alias("fully_match"), disagree.alias("disagreement"),
        c["no_table_in_all_runs"].alias("no_table"), c["extraction_failed_in_all_runs"].alias("failed"),
        *[F.coalesce(F.sum(f"rows_{n}"), F.lit(0)).alias(f"points_{name}") for n, name in (("matching", "matched"), ("differing", "differing"))]) \
        .withColumn("points", F.col("points_matched") + F.col("points_differing"))


def recheck_list(summary: DataFrame) -> DataFrame:
    """Reports to read again with their category, one row per report (the list's JSON form is a sink)."""
    from panelkit.functions.text import lookup
    return (summary.withColumn("category", lookup(RECHECK, F.col("group"))).filter(F.col("category").isNotNull())
            .select("category", "json_file", "pdf_file_name", "country", "group", "rows_differing"))


# ---- agreement statistics over several runs ---------------------------------------------------------

def _found_everywhere(n: int) -> Column:
    return _all([F.coalesce(F.col(f"f{r}")["found"], F.lit(False)) for r in range(1, n + 1)])


def _filled_everywhere(n: int) -> Column:
    """The line is in every run, not blank on all sides."""
    x = [F.col(f"val{r}") for r in range(1, n + 1)]
    some = reduce(lambda a, b: a | b, [c["num"].isNotNull() | c["txt"].isNotNull() for c in x])
    return _all([c.isNotNull() for c in x]) & some


def comparable_items(comparison: RunComparison) -> DataFrame:
    """Aligned items of reports whose table every run found, not blank on all sides."""
    n = comparison.n_runs
    return comparison.items.filter(_found_everywhere(n) & _filled_everywhere(n))


def pair_match_rates(comparison: RunComparison) -> DataFrame:
    """Per pair of runs: rows compared, rows equal, rate; plus the pair `all`. Lines are counted per report before they meet its facts."""
    n = comparison.n_runs
    x = {r: F.col(f"val{r}") for r in range(1, n + 1)}
    tests = {f"run{a}_run{b}": same(x[a], x[b]) for a, b in combinations(x, 2)}
    tests["all"] = _all([same(x[1], x[r]) for r in list(x)[1:]])
    per = comparison.lines.filter(_filled_everywhere(n)).groupBy("json_file").agg(F.count("*").alias("n"), *[F.count_if(t).alias(k) for k, t in tests.items()])
    found = comparison.facts.filter(_found_everywhere(n)).select("json_file")
    agg = per.join(found, "json_file").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *tests)])
    rows = F.array(*[F.struct(F.lit(k).alias("pair"), F.col(k).alias("n_equal")) for k in tests])
    return (agg.select("n", F.explode(rows).alias("p"))
            .select("p.pair", F.col("n").alias("n_compared"), "p.n_equal", F.try_divide("p.n_equal", "n").alias("match_rate")))


def item_spread(comparison: RunComparison) -> DataFrame:
    """Differing comparable items with the spread (max - min) of their numbers."""
    n = comparison.n_runs
    x = [F.col(f"val{r}") for r in range(1, n + 1)]
    differ = ~_all([same(x[0], c) for c in x[1:]])
    nums = F.filter(F.array(*[c["num"] for c in x]), lambda v: v.isNotNull())
    return (comparable_items(comparison).filter(differ & (F.size(nums) >= 2))
            .select("json_file", "hierarchy_id", F.col("top1").alias("top_category"),
                    (F.array_max(nums) - F.array_min(nums)).alias("spread")))


def spread_by_category(comparison: RunComparison, wide: float = 1.0, noise: float = 0.15) -> DataFrame:
    """Per category: n, mean and largest spread, share above `wide`, share at most `noise`."""
    return item_spread(comparison).groupBy("top_category").agg(
        F.count("*").alias("n"), F.avg("spread").alias("mean_spread"), F.max("spread").alias("max_spread"),
        F.avg((F.col("spread") > wide).cast("int")).alias("share_wide"),
        F.avg((F.col("spread") <= noise).cast("int")).alias("share_noise"))


def confusion(facts: DataFrame, a: int = 1, b: int = 2) -> DataFrame:
    """How often run a and run b say table / no table."""
    left, right = F.col(f"f{a}")["found"], F.col(f"f{b}")["found"]
    return (facts.filter(F.col(f"f{a}").isNotNull() & F.col(f"f{b}").isNotNull())
            .groupBy(left.alias("found_a")).agg(F.count_if(right).alias("b_found"), F.count_if(~right).alias("b_not_found")))


def two_of_n(comparison: RunComparison) -> DataFrame:
    """Per report with a disagreement: which pairs agree completely, and the single outlier run if there is one. Lines are reduced
    to one row per report before they meet its facts."""
    n = comparison.n_runs
    x = {r: F.col(f"val{r}") for r in range(1, n + 1)}
    pairs = list(combinations(range(1, n + 1), 2))
    rows = comparison.lines.groupBy("json_file").agg(*[
        F.bool_and(_pair_ok(x[a], x[b])).alias(f"v{a}_{b}") for a, b in pairs])
    full = _all([F.col(f"f{r}").isNotNull() for r in range(1, n + 1)])
    out = comparison.facts.filter(full).join(rows, "json_file", "left")
    no_table = F.col("report_group").eqNullSafe(F.lit("no_table_in_all_runs"))
    flags = {}
    for a, b in pairs:
        fa, fb = F.col(f"f{a}"), F.col(f"f{b}")
        year = fa["year"].eqNullSafe(fb["year"]) | ~F.coalesce(fa["found"], F.lit(False))
        flags[(a, b)] = fa["found"].eqNullSafe(fb["found"]) & year & (no_table | F.coalesce(F.col(f"v{a}_{b}"), F.lit(True)))
    n_ok = reduce(lambda p, q: p + q, [c.cast("int") for c in flags.values()])
    # with exactly one agreeing pair out of three runs, the run outside the pair is the outlier
    outlier = F.coalesce(*[F.when((n_ok == 1) & flags[(a, b)], F.lit(next(r for r in range(1, n + 1) if r not in (a, b))))
                           for a, b in pairs]) if n == 3 else F.lit(None).cast("int")
    return out.select("json_file", *[c.alias(f"run{a}_run{b}_agree") for (a, b), c in flags.items()],
                      n_ok.alias("n_pairs_agree"), outlier.alias("outlier_run")).filter(F.col("n_pairs_agree") < len(pairs))


def before_after(before: RunComparison, after: RunComparison) -> DataFrame:
    """Agreement of the same reports in an earlier and a later comparison, side by side."""
    def measure(c: RunComparison, name: str) -> DataFrame:
        r = pair_match_rates(c).filter("pair = 'all'")
        return r.select(F.lit(name).alias("stage"), "n_compared", (F.col("n_compared") - F.col("n_equal")).alias("n_differ"), "match_rate")
    return measure(before, "before").unionByName(measure(after, "after"))


def run_details(comparison: RunComparison) -> DataFrame:
    """Every report's line items with each run's label and value, and whether they are all the same."""
    n = comparison.n_runs
    runs = range(1, n + 1)
    return comparison.items.select(
        "json_file", "hierarchy_id", F.coalesce(*[F.col(f"top{r}") for r in runs]).alias("top_category"),
        F.array(*[F.col(f"told{r}.label") for r in runs]).alias("labels"), F.array(*[F.col(f"told{r}.raw") for r in runs]).alias("values"),
        _all([same(F.col("val1"), F.col(f"val{r}")) for r in runs[1:]]).alias("same"),
        (F.size(F.split("hierarchy_id", "[.]")) - 1).alias("level"))


def review_prefill(comparison: RunComparison) -> DataFrame:
    """Starting rows for a person: the majority label, and the value only where all runs agree."""
    n = comparison.n_runs
    runs = range(1, n + 1)
    equal = _all([same(F.col("val1"), F.col(f"val{r}")) for r in runs[1:]])
    return comparison.items.select(
        "json_file", "hierarchy_id", F.coalesce(majority_of([F.col(f"told{r}.label") for r in runs]), F.lit("")).alias("label_verbatim"),
        F.when(equal, F.coalesce("told1.raw", F.lit(""))).otherwise(F.lit("")).alias("value"), (~equal).alias("differs"))
