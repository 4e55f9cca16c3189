"""Gap finding and the waterfall on small hand-made tables, and against a plain loop."""
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import gaps as G, waterfall as W
from panelkit.plans import gap_fill as P
from panelkit.streaming import incremental as S

ROW = "json_file string, pdf_file_name string, table_found string, last_actual_year string, source_round string, level string, top_category string, value string, hierarchy_id string, label_verbatim string, row_no long"


def rows(spark, reports, extra=None):
    """reports: (name, year label, value[, source[, found]]) -> long rows with one line item each."""
    out = []
    for i, r in enumerate(reports):
        name, year, value, source, found = (*r, *("round1", "TRUE")[len(r) - 3:])
        out.append((f"{name}_dsa.json", f"{name}.pdf", found, year, source, "0", "change_in_debt", value, "1", "Change", i))
    return spark.createDataFrame(out, ROW)


def test_one_report_may_own_two_years(spark):
    d = rows(spark, [("France_2017-03-01", "2017", "1"), ("France_2021-03-01", "2021", "11.0")])
    d = d.withColumn("year", F.lit(None).cast("string")).unionByName(
        rows(spark, [("France_2021-03-01", None, "21.0", "gapfill")]).withColumn("year", F.lit("2019")))
    check = P.find_gaps(d, "row_no")
    panel = {r["year"]: (r["status"], r["change_in_debt"]) for r in check.panel.collect()}
    assert panel == {2017: ("observed", 1.0), 2019: ("observed", 21.0), 2021: ("observed", 11.0), 2018: ("GAP", None), 2020: ("GAP", None)}


def test_slim_layout_without_audit(spark):
    d = rows(spark, [("Ruritania_2011-01-01", "2010", "1"), ("Ruritania_2013-01-01", "2012", "2")])
    g = P.find_gaps(d, "row_no").gaps.collect()
    assert [(r["gap_year"], r["fill_status"], r["primary_cause"], r["gap_id"]) for r in g] == [
        (2011, "preview_unavailable_no_audit_column", "lag_between_consecutive_reports", "G0001")]


def test_full_range_excludes_known_gaps_and_counts_old_gap_fill(spark):
    d = rows(spark, [("Freedonia_2011-01-01", "2010", "1"), ("Freedonia_2013-01-01", "2012", "2"), ("Freedonia_2015-01-01", "2014", "3"),
                     ("Freedonia_2017-06-01", "2013", "9", "gapfill"), ("Sylvania_2016-01-01", "n/a", "1")])
    known = spark.createDataFrame([("FREEDONIA", 2011)], "country string, gap_year int")
    check = P.find_gaps(d, "row_no", (2008, 2016), None, known)
    got = sorted((r["country"], r["gap_year"]) for r in check.to_fill.collect())
    assert [y for c, y in got if c == "Freedonia"] == [2008, 2009, 2015, 2016]
    assert [y for c, y in got if c == "Sylvania"] == list(range(2008, 2017))
    panel = {(r["country"], r["year"]): r["status"] for r in check.panel.collect()}
    assert panel[("Freedonia", 2011)] == "GAP" and panel[("Freedonia", 2013)] == "observed"
    causes = {(r["country"], r["gap_year"]): r["all_causes"] for r in check.gaps.collect()}
    assert causes[("Freedonia", 2008)] == "before_first_observed_year" and causes[("Freedonia", 2016)] == "after_last_observed_year"
    assert causes[("Sylvania", 2010)] == "no_observation_in_panel"


def test_usage_status_and_agreement(spark):
    d = rows(spark, [("A_2018-01-01", "2016", "1.0"), ("A_2018-05-01", "2016", "1.0000001"), ("B_2018-01-01", "2016", "1"), ("B_2018-05-01", "2016", "2"),
                     ("C_2020-01-01", "2016", "1"), ("D_2018-01-01", "2019", "1"), ("E_2018-01-01", "2014-2016", "1"), ("F_2018-01-01", "2016", "1", "round1", "False"),
                     ("G_2020-01-01", "2016", "1", "gapfill"), ("Multi-Country Report_2018-01-01", "2016", "1")])
    check = P.find_gaps(d, "row_no")
    st = {r["pdf_file_name"][:-4]: r["report_status"] for r in check.reports.collect()}
    assert st == {"A_2018-01-01": "observation_superseded_by_later_report", "A_2018-05-01": "observation", "B_2018-01-01": "observation_superseded_by_later_report",
                  "B_2018-05-01": "observation", "C_2020-01-01": "year_implausible_vs_report_date", "D_2018-01-01": "year_implausible_vs_report_date",
                  "E_2018-01-01": "table_but_year_unusable", "F_2018-01-01": "no_table", "G_2020-01-01": "observation", "Multi-Country Report_2018-01-01": "excluded_non_country"}
    assert {r["country"]: r["values_agree"] for r in check.kept.collect()} == {"A": "Yes", "B": "No", "G": None}


REPORTS = [("A", "2018-03-01"), ("A", "2018-11-05"), ("A", "2019-06-01"), ("A", "2020-06-01"), ("B", "2019-01-01"), ("B", "2020-01-01"), ("C", "2019-01-01"), ("C", "2020-01-01"), ("D", "2018-01-01")]
TARGETS = [("G1", "A", 2016), ("G2", "B", 2016), ("G3", "B", 2017), ("G4", "C", 2016), ("G5", "D", 2016), ("G6", "E", 2010)]


@pytest.fixture(scope="module")
def cascade(spark):
    docs = spark.createDataFrame([(f"{c}_{d}.pdf", c, d, int(d[:4])) for c, d in REPORTS], "pdf_file_name string, country string, d string, pub_year int") \
        .withColumn("report_date", F.to_date("d"))
    targets = spark.createDataFrame(TARGETS, "gap_id string, country string, gap_year int")
    cands = W.candidate_map(targets, docs)
    outcomes = spark.createDataFrame([
        ("A_2018-11-05.pdf", 2016, "rejected_not_actual"), ("A_2018-03-01.pdf", 2016, "resolved"), ("B_2019-01-01.pdf", 2016, "resolved"), ("B_2019-01-01.pdf", 2017, "year_not_in_table"),
        ("B_2020-01-01.pdf", 2017, "resolved"), ("C_2019-01-01.pdf", 2016, "rejected_not_actual"), ("C_2020-01-01.pdf", 2016, "resolved"), ("D_2018-01-01.pdf", 2016, "api_error")],
        "report string, year int, status string")
    return targets, cands, outcomes, W.resolve(cands, outcomes)


def test_candidate_order(cascade):
    a = sorted((r["rank"], r["candidate_report"], r["offset_years"]) for r in cascade[1].filter("country = 'A'").collect())
    assert a == [(1, "A_2018-11-05.pdf", 2), (2, "A_2018-03-01.pdf", 2), (3, "A_2019-06-01.pdf", 3), (4, "A_2020-06-01.pdf", 4)]
    e = cascade[1].filter("country = 'E'").collect()
    assert len(e) == 1 and e[0]["rank"] is None and e[0]["gap_id"] == "G6"


def test_waterfall(cascade):
    res = {r["gap_id"]: (r["final_status"], r["source_report"]) for r in cascade[3][0].collect()}
    # the first target of B tries its only earlier report first; B 2017 moves on to the next year's report
    assert res == {"G1": ("resolved", "A_2018-03-01.pdf"), "G2": ("resolved", "B_2019-01-01.pdf"), "G3": ("resolved", "B_2020-01-01.pdf"), "G4": ("resolved", "C_2020-01-01.pdf"),
                   "G5": ("pending_api_error", None), "G6": ("unresolved_no_candidate_reports", None)}
    tries = {r["gap_id"]: r["n"] for r in cascade[3][1].groupBy("gap_id").agg(F.count("*").alias("n")).collect()}
    assert tries == {"G1": 2, "G2": 1, "G3": 2, "G4": 2, "G5": 1}
    again = {r["gap_id"]: r["final_status"] for r in W.resolve(cascade[1], cascade[2], errors_are_open=True)[0].collect()}
    assert again["G5"] == "pending_not_run"


def test_retry_and_resume(cascade):
    targets, _, outcomes, (res, att) = cascade
    assert {r["gap_id"] for r in S.remaining_targets(targets, res).collect()} == {"G5", "G6"}
    kept, cleared = S.answers_to_keep(outcomes, res, att)
    assert cleared.count() == 0 and kept.count() == outcomes.count()


def test_waterfall_equals_a_loop(spark):
    rnd = random.Random(5)
    states = ["resolved", "resolved_with_warning", "rejected_not_actual", "year_not_in_table", "api_error", None]
    cand, out, want = [], [], {}
    for t in range(200):
        n = rnd.randint(0, 5)
        final = "unresolved" if n else "unresolved_no_candidate_reports"
        if not n:
            cand.append((f"c{t}", 2000, None, None))
        for k in range(1, n + 1):
            s = rnd.choice(states)
            cand.append((f"c{t}", 2000, k, f"r{t}_{k}"))
            if s:
                out.append((f"r{t}_{k}", 2000, s))
            if final == "unresolved" and (s or "not_run") in W.RESOLVED + W.STOPS:
                final = s if s in W.RESOLVED else f"pending_{s or 'not_run'}"
        want[f"c{t}"] = final
    c = spark.createDataFrame(cand, "country string, gap_year int, rank long, candidate_report string").withColumn("offset_years", F.lit(2)).withColumn("publication_date", F.lit(None).cast("date"))
    res = W.resolve(c, spark.createDataFrame(out, "report string, year int, status string"))[0]
    assert {r["country"]: r["final_status"] for r in res.collect()} == want


def test_fill_panel_leaves_observed_rows_alone(spark):
    panel = spark.createDataFrame([("A", 2016, "GAP", None, None), ("A", 2017, "observed", "x.pdf", 3.0), ("B", 2016, "GAP", None, None)], "country string, year int, status string, source_report string, v double")
    filled = spark.createDataFrame([("A", 2016, "a.pdf", 1.5), ("A", 2017, "b.pdf", 9.0)], "country string, year int, source_report string, v double")
    got = sorted(tuple(r) for r in W.fill_panel(panel, filled, ["v"]).collect())
    assert got == [("A", 2016, "FILLED", "a.pdf", 1.5), ("A", 2017, "observed", "x.pdf", 3.0), ("B", 2016, "GAP", None, None)]


def test_append_is_refused_twice(spark):
    panel = spark.createDataFrame([("a", "round1", "2010"), ("b", "gapfill", "2011")], "json_file string, source_round string, last_actual_year string")
    new = spark.createDataFrame([("c", 2012)], "json_file string, year int")
    out = S.append_run(panel, new, "r2", "r1", 1)
    assert {(r["json_file"], r["gapfill_run"], r["last_actual_year"]) for r in out.collect()} == {("a", None, "2010"), ("b", "r1", "2011"), ("c", "r2", "2012")}
    with pytest.raises(ValueError):
        S.append_run(out, new, "r2")
    with pytest.raises(ValueError):
        S.append_run(panel, new, "r2", "r1", 5)


def test_zero_runs(spark):
    d = spark.createDataFrame([("a", y, v) for y, v in [(2001, 0.0), (2002, 0.0), (2003, 1.0), (2005, 0.0), (2007, 0.0), (2008, -0.0)]] + [("b", 2001, 5.0)], "e string, y int, v double")
    assert sorted((r["run_start"], r["run_end"], r["run_length"]) for r in G.zero_runs(d, "e", "y", "v").collect()) == [(2001, 2002, 2), (2005, 2005, 1), (2007, 2008, 2)]
    assert sorted((r["run_start"], r["run_end"], r["run_length"]) for r in G.zero_runs(d, "e", "y", "v", allow_missing=True).collect()) == [(2001, 2002, 2), (2005, 2008, 3)]
    t = {r["e"]: r for r in G.streak_table(d, "e", "y", "v", 2).collect()}
    assert (t["a"]["longest_run_start"], t["a"]["n_long_runs"], t["a"]["zero_in_latest"]) == (2007, 2, True) and t["b"]["longest_zero_run"] == 0
