"""What keeps whole jobs linear: steps that many consumers share are computed once, and lines meet in hash tables."""
from pyspark.sql import functions as F

from panelkit.operators import compare as C, gaps as G
from panelkit.operators.quantiles import exact_quantiles
from panelkit.plans import round_check as R
from panelkit.session import INITIAL_PARTITIONS, tune
from test_compare import COLUMNS, run_rows

LINES = "json_file string, pdf_file_name string, last_actual_year string, top_category string, level string, value string, row_no long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    """Report x with two spellings of its year and lines out of order, report y with one line."""
    head = ("x_dsa.json", "X_2001-05-01.pdf")
    return spark.createDataFrame([
        (*head, "2000", "residual", "0", "n.a.", 1), (*head, " 2000", "residual", "0", "2,000", 2), (*head, "2000", "residual", "0", "3", 3),
        (*head, "2000", "residual", "1", "7", 0), (*head, "2000", "primary_balance", "0", "4", 5), ("y_dsa.json", "Y_2001-05-01.pdf", None, "residual", "0", "1", 9)], LINES)


def test_lines_of_a_report_meet_in_hash_tables(spark):
    rep = G.report_table(lines(spark), "row_no", with_values=True)
    got = {r["json_file"]: (r["year_label"], r["residual"], r["primary_balance"], r["pdf_file_name"]) for r in rep.collect()}
    assert got == {"x_dsa.json": ("2000", 2000.0, 4.0, "X_2001-05-01.pdf"), "y_dsa.json": ("", 1.0, None, "Y_2001-05-01.pdf")}
    assert " HashAggregate(keys=[json_file" in plan(rep).replace("*(1)", "").replace("- ", " ")


def test_facts_of_runs_meet_in_hash_tables(spark):
    facts = C.align_reports(spark.createDataFrame(run_rows(), COLUMNS), 3, "run_no", "row_no")
    assert "HashAggregate(keys=[json_file" in plan(facts)
    assert facts.count() == 8


def test_a_written_comparison_is_read_back(spark):
    rows = spark.createDataFrame(run_rows(), COLUMNS)
    lazy, check = R.check_round(rows, 3), R.check_round(rows, 3, reuse=True)
    for a, b in ((lazy.summary, check.summary), (lazy.diffs, check.diffs), (lazy.comparison.matched, check.comparison.matched)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert "ExistingRDD" in plan(a) and "ExistingRDD" not in plan(b)


def test_headline_needs_the_summary_alone(spark):
    rows = spark.createDataFrame(run_rows(), COLUMNS)
    check = R.check_round(rows, 3)
    h = R.round_summary(check)
    assert "Subquery" not in plan(h)
    r = h.first()
    assert (r["points_matched"], r["points_differing"]) == (check.comparison.matched.count(), check.diffs.count())
    empty = R.round_summary(R.check_round(rows.limit(0), 3)).first()
    assert (empty["reports"], empty["points_matched"], empty["points"]) == (0, 0, 0)


def test_quantiles_compute_their_input_once(spark):
    df = spark.range(1, 1002).select((F.col("id") % 100).cast("double").alias("v"))
    q = exact_quantiles(df, [], "v", {"m": 0.5, "top": 1.0})
    assert "Range (" not in plan(q)
    assert tuple(q.first()) == (49.0, 99.0)


def test_shuffles_of_panel_queries_start_fine(spark):
    few = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        fine = tune(spark, fine=True)
        df = fine.range(100000).groupBy((F.col("id") % 1000).alias("k")).count()
        assert df.count() == 1000
        assert int(fine.conf.get(INITIAL_PARTITIONS)) > 100 > int(few)
        assert f", {fine.conf.get(INITIAL_PARTITIONS)})" in plan(df)
    finally:
        tune(spark)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
