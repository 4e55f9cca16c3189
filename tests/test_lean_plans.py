"""What a step reads, normalises and sends: each value once, and nothing that its result doesn't need."""
import datetime
import re

from pyspark.sql import functions as F

from panelkit.operators import compare as C, gaps, waterfall
from panelkit.plans import gap_fill, panel_build
from test_compare import COLUMNS, run_rows
from test_scale import LINES, plan
from workload import roles

DATA = "/root/testdata/sf0.001"


def test_runs_meet_without_texts_that_are_not_asked_for(spark):
    c = C.compare_runs(spark.createDataFrame(run_rows(), COLUMNS), 3)
    for df in (C.two_of_n(c), C.pair_match_rates(c)):
        sent = [x for x in plan(df).splitlines() if "Exchange" in x or "Aggregate" in x]
        assert sent and not any("label" in x or "top_category" in x for x in sent)


def test_reports_and_lines_are_reduced_before_they_meet(spark):
    c = C.compare_runs(spark.createDataFrame(run_rows(), COLUMNS), 3)
    for df in (C.two_of_n(c), C.pair_match_rates(c)):
        assert not re.search(r"Join.*hierarchy_id", plan(df)) and "xxhash64(json_file" not in plan(df)
    assert {r["json_file"] for r in C.two_of_n(c).collect()} <= {r["json_file"] for r in c.facts.collect()}


def test_values_are_normalised_once(spark):
    c = C.compare_runs(spark.createDataFrame(run_rows(), COLUMNS), 3)
    # one cleaning of values, one of years and one of found, however often a filter mentions them: a copy for each mention made 116
    assert plan(c.matched).count("transform(") <= 6


def test_a_search_makes_what_is_asked_for(spark, monkeypatch):
    made = []
    monkeypatch.setattr(gap_fill, "materialise", lambda df: made.append(df.columns) or df)
    rows = spark.createDataFrame([("x_dsa.json", "X_2001-05-01.pdf", "2000", "residual", "0", "1", 1, "FALSE"),
                                  ("y_dsa.json", "Y_2001-05-01.pdf", "2000", "residual", "0", "1", 2, "TRUE")], LINES + ", table_found string")
    check = gap_fill.find_gaps(rows, "row_no")
    assert made == []
    assert [r["pdf_file_name"] for r in waterfall.skip_list(check.usage).collect()] == ["X_2001-05-01.pdf"] and len(made) == 1
    assert {r["json_file"]: r["report_status"] for r in check.reports.collect()} == {"x_dsa.json": "no_table", "y_dsa.json": "observation"}


def test_audits_are_read_once_per_candidate(spark):
    audit = '{"columns": [{"year_label": "2000", "status": "actual"}, {"year_label": "1998-2001", "status": ""}, null]}'
    reports = spark.createDataFrame([("C", "C_2003-01-01.pdf", datetime.date(2003, 1, 1), True, "c", "2002", audit, "observation")],
                                    "country string, pdf_file_name string, report_date date, table_found boolean, json_file string, year_label string, column_header_audit_json string, report_status string")
    gaps_ = spark.createDataFrame([("C", y) for y in (1999, 2000, 2001, 2002)], "country string, gap_year int")
    preview = gaps.fill_preview(gaps_, reports)
    got = {r["gap_year"]: (r["fill_status"], r["preferred_source_report"], r["n_reports_actual_column_visible"]) for r in preview.collect()}
    assert got == {1999: ("only_in_merged_range_column", None, 0), 2000: ("fillable_actual_column_visible", "C_2003-01-01.pdf", 1),
                   2001: ("only_in_merged_range_column", None, 0), 2002: ("not_visible_in_any_report", None, 0)}
    # the audit is opened before a report's years are told apart: the years' explosion lies above the audit's
    p = plan(preview)
    assert p.index("explode(due") < p.index("explode(from_json")


def test_reports_need_no_names_of_parts(spark):
    rows, bare = roles.long_rows(spark, DATA), roles.long_rows(spark, DATA, labels=False)
    assert rows.columns == bare.columns and "p_partkey" in plan(rows) and "p_partkey" not in plan(bare)
    assert gaps.report_table(rows, "row_no", with_values=True).exceptAll(gaps.report_table(bare, "row_no", with_values=True)).isEmpty()


def test_a_panel_side_is_joined_once(spark):
    row = "json_file string, hierarchy_id string, value string, source_round string"
    old = spark.createDataFrame([("a", "1", "o", "round1"), ("b", "1", "o", "round1"), ("c", "1", "o", "gapfill"), (None, "1", "o", "round1"), ("d", "1", "o", "round1")], row)
    new = spark.createDataFrame([("b", "1", "n", "round2"), ("d", "1", "n", "round2"), ("e", "1", "n", "round2"), (None, "1", "n", "round2")], row)
    gone = spark.createDataFrame([("d",), ("d",)], "json_file string")

    def kept(build):
        return sorted((str(r["json_file"]), r["value"]) for r in build.rows.collect())
    both = panel_build.build_panel(old, [new], gone)
    assert kept(both) == [("None", "n"), ("None", "o"), ("a", "o"), ("b", "n"), ("e", "n")]
    assert kept(panel_build.build_panel(old, [new], gone, replace=False)) == [("None", "n"), ("None", "o"), ("a", "o"), ("b", "o"), ("e", "n")]
    assert kept(panel_build.build_panel(old, [])) == [("None", "o"), ("a", "o"), ("b", "o"), ("d", "o")]
    assert plan(both.rows).count("LeftAnti") == 2 and "LeftAnti" not in plan(panel_build.build_panel(old, []).rows)


def test_matched_rows_move_once(spark):
    rows = spark.createDataFrame(run_rows(), COLUMNS)
    sent = [x for x in plan(C.matched_rows(rows, C.compare_runs(rows, 3)).select("json_file", "value")).splitlines() if "Exchange hashpartitioning" in x]
    # lines once, reports on which the runs agree three times: by facts, by name, beside the lines
    assert len(sent) == 4 and not any("hierarchy_id" in x for x in sent)
    wide = plan(roles.long_rows(spark, DATA))
    join = wide[wide.index("SortMergeJoin [k#"):] if "SortMergeJoin [k#" in wide else wide[wide.index("HashJoin [k#"):]
    assert "other_identified_flows" not in join


def test_a_written_round_is_read_from_one_table(spark, monkeypatch):
    from panelkit.plans import round_check
    made = []
    monkeypatch.setattr(C, "materialise", lambda df, compression="snappy", write=C.materialise: made.append((df, compression)) or write(df, compression))
    check = round_check.check_round(spark.createDataFrame(run_rows(), COLUMNS), 3, reuse=True)
    assert [(m[1], "own" in m[0].columns) for m in made] == [("zstd", True)]
    # rows of the source run come from it: they aren't moved anew
    assert "Exchange" not in plan(check.matched) and "ExistingRDD" not in plan(check.matched) and "Exchange" not in plan(check.diffs)


def test_facts_of_reports_need_no_names_of_parts(spark):
    rows = roles.runs(spark, DATA)
    facts, lean = [C.compare_runs(rows, 3, reports=r).facts for r in (rows, roles.runs(spark, DATA, labels=False))]
    assert "p_partkey" in plan(facts) and "p_partkey" not in plan(lean) and facts.exceptAll(lean).isEmpty() and lean.exceptAll(facts).isEmpty()
    # lines without labels are dealt once, by their order
    bare = plan(roles.long_rows(spark, DATA, labels=False))
    assert "hashpartitioning(k#" in bare and "ln#" not in "".join(x for x in bare.splitlines() if "Exchange hashpartitioning" in x)


def test_totals_write_the_comparison_and_its_summary_alone(spark, monkeypatch):
    from workload import q_compare
    made = []

    def note(df, *how, write=q_compare.materialise):
        made.append(df.columns)
        return write(df, *how)
    monkeypatch.setattr(q_compare, "materialise", note)
    monkeypatch.setattr(C, "materialise", note)
    got = q_compare.round_totals(spark, DATA)
    assert [c[:2] for c in made] == [["json_file", "hierarchy_id"], ["json_file", "pdf_file_name"]]
    assert got.filter("state = 'sound' and not ok").isEmpty() and not got.filter("state = 'stale' and not ok").isEmpty()


def test_lines_move_once(spark):
    """Lines of all runs move in one exchange, as they are: not lined up on the way, nor again to meet their report's facts."""
    c = C.compare_runs(spark.createDataFrame(run_rows(), COLUMNS), 3)
    for df in (C.run_details(c), c.diffs, C.review_prefill(c)):
        sent = [x for x in plan(df).splitlines() if "Exchange hashpartitioning" in x]
        # lines, and the reports three times: by facts, by name, beside the lines
        assert len(sent) == 4 and not any("hierarchy_id" in x for x in sent)


def test_a_loaded_value_is_not_made_for_each_mention(spark):
    """A filter on year and number stays above where they are made: the plan doesn't grow with the making of the label."""
    from panelkit.operators import coverage
    sizes = [len(plan(coverage.load_values(roles.long_rows(spark, DATA).withColumn("last_actual_year", label)))) for label in
             (F.col("last_actual_year"), F.concat(F.trim("last_actual_year"), F.lit("")))]
    assert max(sizes) < 150_000 and sizes[1] - sizes[0] < 2_000
    odd = spark.createDataFrame([("C", "5", "1", None, "2001"), ("C", "5", "x", "2001", None), ("C", "5", "2", " ", "1999-2001"), (None, "5", "2", "2001", None), ("C", "5", "3", "n/a", "2001")],
                                "country string, hierarchy_id string, value string, year string, last_actual_year string")
    assert sorted((r["effective_year"], r["value_num"]) for r in coverage.load_values(odd).collect()) == [(2001, 1.0), (2001, 2.0)]


def test_a_tail_reads_written_values(spark):
    from workload import q_stats
    v, five = q_stats.chosen(spark, DATA, reuse=True)
    assert "lineitem" not in plan(v) and "lineitem" not in plan(five) and len(plan(q_stats.tail_top5(spark, DATA))) < 100_000
    lazy = q_stats.chosen(spark, DATA)[1]
    assert "lineitem" in plan(lazy) and lazy.exceptAll(five).isEmpty() and five.exceptAll(lazy).isEmpty() and not five.isEmpty()
