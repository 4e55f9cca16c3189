"""Run comparison: eight reports that differ in one way each, over three runs."""
import pytest
from pyspark.sql import functions as F

from panelkit.operators import compare as C
from panelkit.plans import round_check as R

BASE = [("1", "change_in_debt", "1.5"), ("2", "identified_flows", "0.5"), ("3", "primary_balance", "-0.3"),
        ("3.1", "primary_balance", "20.1"), ("6", "residual", "1.0")]
COLUMNS = ("json_file string, pdf_file_name string, country string, table_found string, last_actual_year string, confidence string, "
           "top_category string, hierarchy_id string, level string, parent_label string, label_verbatim string, value string, run_no int, row_no long")


def report(name, run, items=BASE, year="2016", found="True", conf="high"):
    head = (f"{name}_dsa.json", f"{name}.pdf", name, found, year, conf)
    if found == "False":
        return [(*head, None, None, None, None, None, None, run)]
    return [(*head, top, hid, str(hid.count(".")), None, f"label {hid}", value, run) for hid, top, value in items]


def change(items, **new):
    return [(h, t, new.get("v" + h.replace(".", "_"), v)) for h, t, v in items]


AUTO = [*BASE[:4], ("4", "automatic_debt_dynamics", "0.1"), ("4.1", "automatic_debt_dynamics", "1"), ("4.2", "automatic_debt_dynamics", "2"), BASE[4]]
AUTO_EXTRA = [*BASE[:4], ("4", "automatic_debt_dynamics", "0.1"), ("4.1", "automatic_debt_dynamics", "1"), ("4.2", "automatic_debt_dynamics", "9"),
              ("4.3", "automatic_debt_dynamics", "2"), BASE[4]]
A = [*BASE, ("6.1", "residual", "0.0")]


def run_rows():
    rows = []
    rows += report("A", 1, A) + report("A", 2, change(A, v1="1.50"), conf="low") + report("A", 3, change(A, v6_1="-0.0"))
    rows += report("B", 1) + report("B", 2) + report("B", 3, change(BASE, v3_1="9.9"))
    rows += report("C", 1, AUTO) + report("C", 2, AUTO_EXTRA) + report("C", 3, AUTO)
    rows += report("D", 1) + report("D", 2) + report("D", 3, year="2015")
    rows += report("E", 1) + report("E", 2, found="False") + report("E", 3)
    rows += report("F", 1) + report("F", 2)
    rows += [r for n in (1, 2, 3) for r in report("G", n, found="False")]
    rows += report("H", 1, year="2012/13") + report("H", 2, year="2013") + report("H", 3, year="FY2013")
    return [(*r, i) for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(run_rows(), COLUMNS).cache()


@pytest.fixture(scope="module")
def three(rows):
    return C.compare_runs(rows, 3)


def groups(summary):
    return {r["pdf_file_name"][:-4]: r["group"] for r in summary.collect()}


def test_groups(three):
    assert groups(three.summary) == {
        "A": "fully_match", "B": "partial_match", "C": "partial_match", "D": "last_actual_year_differs", "E": "table_found_differs",
        "F": "missing_in_run", "G": "no_table_in_all_runs", "H": "fully_match"}
    s = {r["country"]: r for r in three.summary.collect()}
    assert s["E"]["table_found_by_run"] == "True|False|True" and s["F"]["runs_present"] == "yes|yes|no"
    assert s["H"]["last_actual_year_by_run"] == "2013|2013|2013" and s["G"]["rows_compared"] == 0
    assert (s["C"]["rows_compared"], s["C"]["rows_matching"], s["C"]["rows_differing"]) == (9, 7, 2)


def test_matched_and_differing_rows_cover_everything(three):
    matched = {}
    for r in three.matched.collect():
        matched.setdefault(r["json_file"][0], set()).add(r["hierarchy_id"])
    assert matched["A"] == {h for h, _, _ in A} and matched["B"] == {"1", "2", "3", "6"}
    assert matched["C"] == {"1", "2", "3", "3.1", "4", "4.1", "6"} and len(matched["H"]) == 5 and set(matched) == set("ABCH")
    d = {(r["country"], r["hierarchy_id"]): r for r in three.diffs.collect()}
    assert d[("B", "3.1")]["diff_type"] == "value" and abs(d[("B", "3.1")]["max_abs_diff"] - 10.2) < 1e-9
    assert d[("C", "4.2")]["diff_type"] == "value" and d[("C", "4.3")]["diff_type"] == "missing_row"
    assert len([k for k in d if k[0] == "D"]) == 5 and all(d[k]["all_match"] for k in d if k[0] == "D")
    assert d[("F", "1")]["value_run3"] is None and not d[("F", "1")]["all_match"]
    assert not [k for k in d if k[0] == "G"]
    for r in three.summary.filter("rows_compared > 0").collect():
        n = len(matched.get(r["country"], ())) + len([k for k in d if k[0] == r["country"]])
        assert n == r["rows_compared"]


def test_two_runs_only(rows):
    two = C.compare_runs(rows.filter("run_no < 3"), 2)
    assert groups(two.summary)["B"] == "fully_match" and groups(two.summary)["F"] == "fully_match"


def test_matched_rows_come_from_the_source_run(rows, three):
    m = C.matched_rows(rows, three)
    assert m.filter("run_no <> 1").count() == 0 and m.count() == three.matched.count()


def test_matched_rows_are_all_rows_of_a_matched_key(spark):
    """A repeated id gives all its rows, one without a category too; rows without a key and of other runs give none."""
    twice = [*BASE, ("1", "change_in_debt", "7"), ("2", None, "4"), (None, "residual", "1"), ("9", None, "1")]
    stacked = [(*r, i) for i, r in enumerate(report("T", 1, [x for x in twice if x[0]]) + report("T", 2, change(BASE, v1="7.0")) + report("T", 9, [("5", "other", "1")]))]
    keyless = [(*r[:7], None, *r[8:]) for r in stacked[:1]] + [(None, *r[1:]) for r in stacked[:1]]
    df = spark.createDataFrame(stacked + keyless, COLUMNS)
    for reuse in (False, True):
        c = C.compare_runs(df, 2, reuse=reuse)
        got = C.matched_rows(df, c)
        assert got.columns == df.columns
        assert sorted((r["hierarchy_id"], str(r["top_category"]), r["value"], r["label_verbatim"], r["row_no"]) for r in got.collect()) == [
            ("1", "change_in_debt", "1.5", "label 1", 0), ("1", "change_in_debt", "7", "label 1", 5), ("2", "None", "4", "label 2", 6),
            ("2", "identified_flows", "0.5", "label 2", 1), ("3", "primary_balance", "-0.3", "label 3", 2),
            ("3.1", "primary_balance", "20.1", "label 3.1", 3), ("6", "residual", "1.0", "label 6", 4)]
        # the plain way: a join with the matched keys
        plain = df.filter("run_no = 1").join(c.matched, ["json_file", "hierarchy_id"], "left_semi").select(df.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        second = C.matched_rows(df, c, source_run=2).collect()
        assert {(r["hierarchy_id"], r["value"]) for r in second} == {("1", "7.0"), ("2", "0.5"), ("3", "-0.3"), ("3.1", "20.1"), ("6", "1.0")}


def test_matched_rows_of_a_hot_report_are_spread(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        i = F.col("id") % 20000
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(i % 3 == 0, i.cast("string")).otherwise("hot").alias("json_file"), F.lit("p").alias("pdf_file_name"), F.lit("c").alias("country"), F.lit("True").alias("table_found"),
            F.lit("2016").alias("last_actual_year"), F.lit("residual").alias("top_category"), i.cast("string").alias("hierarchy_id"), F.sha2(i.cast("string"), 256).alias("label_verbatim"),
            F.when((F.col("id") >= 40000) & (i % 100 == 1), "8").otherwise("7").alias("value"), (F.col("id") / 20000).cast("int").alias("run_at"), F.col("id").alias("row_no"))
        rows = rows.withColumn("run_no", F.col("run_at") + 1).drop("run_at")
        out = C.matched_rows(rows, C.compare_runs(rows, 3))
        got = out.collect()
        assert len(got) == 19800 and {r["row_no"] for r in got} == {i for i in range(20000) if i % 100 != 1}
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_failed_everywhere_and_totals(spark, rows):
    errors = spark.createDataFrame([(1, "Z_2016-01-01", "boom"), (3, "Z_2016-01-01", " "), (1, "A", "late"), (2, "W", "x")], "run_no int, stem string, message string")
    check = R.check_round(rows, 3, errors)
    s = {r["pdf_file_name"]: r for r in check.summary.collect()}
    assert len(s) == 10 and s["Z_2016-01-01.pdf"]["country"] == "Z" and s["W.pdf"]["country"] is None
    assert s["Z_2016-01-01.pdf"]["error_by_run"] == "run1: boom | run2: (no _ERROR.json or _dsa.json found) | run3: (no error message)"
    totals = R.round_totals(check.summary, check.matched, check.diffs, check.recheck, check.comparison.items)
    assert all(r["ok"] for r in totals.collect()) and totals.count() == 9
    R.check_totals(totals)
    # tables of different states: a list without one report, differences without one line, a report twice
    stale = R.round_totals(check.summary.unionByName(check.summary.limit(1)), check.matched, check.diffs.limit(1), check.recheck.filter("group <> 'partial_match'"))
    failed = {r["check"] for r in stale.filter("not ok").collect()}
    assert {"every report has one row", "disagreeing reports are listed", "differing lines of the reports are the differences"} <= failed
    assert "reports without a table are listed" not in failed or check.summary.first()["group"] == "no_table_in_all_runs"
    with pytest.raises(ValueError, match="every report has one row: 10 against 11"):
        R.check_totals(stale)
    empty = R.round_totals(*[t.limit(0) for t in (check.summary, check.matched, check.diffs, check.recheck)]).collect()
    assert {(r["left"], r["right"], r["ok"]) for r in empty} == {(0, 0, True)}
    h = R.round_summary(check).collect()[0]
    assert (h["reports"], h["fully_match"], h["disagreement"], h["no_table"], h["failed"]) == (10, 2, 5, 1, 2)
    assert h["points_matched"] == check.comparison.matched.count() and h["points_differing"] == check.diffs.count()
    ready = R.ready_rows(check.matched, check.summary, "round1")
    assert {r["json_file"] for r in ready.select("json_file").distinct().collect()} == {"A_dsa.json", "H_dsa.json"}
    assert ready.columns[-3:] == ["source_round", "gapfill_run", "update_origin"] and len(ready.columns) == 46


def test_null_table_found_everywhere_is_a_difference(spark):
    rows = [(*r, i) for i, r in enumerate(report("N", 1, found=None) + report("N", 2, found=None))]
    assert groups(C.compare_runs(spark.createDataFrame(rows, COLUMNS), 2).summary) == {"N": "table_found_differs"}


def test_last_row_of_a_repeated_id_wins(spark):
    twice = [*BASE, ("1", "change_in_debt", "7")]
    rows = [(*r, i) for i, r in enumerate(report("T", 1, twice) + report("T", 2, change(BASE, v1="7")))]
    assert groups(C.compare_runs(spark.createDataFrame(rows, COLUMNS), 2).summary) == {"T": "fully_match"}


def test_agreement_statistics(three):
    rates = {r["pair"]: (r["n_compared"], r["n_equal"]) for r in C.pair_match_rates(three).collect()}
    # comparable: A 6 + B 5 + C 8 (4.3 is missing somewhere) + D 5 + H 5
    assert rates == {"run1_run2": (29, 28), "run1_run3": (29, 28), "run2_run3": (29, 27), "all": (29, 27)}
    spread = {r["top_category"]: (r["n"], round(r["max_spread"], 6)) for r in C.spread_by_category(three).collect()}
    assert spread == {"primary_balance": (1, 10.2), "automatic_debt_dynamics": (1, 7.0)}
    two = {r["json_file"][0]: r["outlier_run"] for r in C.two_of_n(three).collect()}
    assert two == {"B": 3, "C": 2, "D": 3, "E": 2}
    conf = {r["found_a"]: (r["b_found"], r["b_not_found"]) for r in C.confusion(three.facts).collect()}
    assert conf == {True: (6, 1), False: (0, 1)}


def test_review_prefill(three):
    rows = {(r["json_file"][0], r["hierarchy_id"]): r for r in C.review_prefill(three).collect()}
    assert rows[("B", "3.1")]["value"] == "" and rows[("B", "3.1")]["differs"]
    assert rows[("B", "1")]["value"] == "1.5" and rows[("B", "1")]["label_verbatim"] == "label 1"


def test_a_written_comparison_agrees_with_a_lazy_one(spark):
    """Written once or computed table by table: the same rows, also of repeated ids, reports without lines or name, and other runs."""
    more = [*report("T", 1, [*BASE, ("1", "change_in_debt", "7"), ("2", None, "4"), ("9", None, "1")]), *report("T", 2, change(BASE, v1="7.0")), *report("T", 3, change(BASE, v1="7")),
            *report("T", 9, [("5", "other", "1")]), *report("U", 1, [("1", None, "1")]), *report("V", 2, found="False")]
    named = [*run_rows(), *[(*r, 1000 + i) for i, r in enumerate(more)]]
    nameless = [(None, *r[1:-1], 2000 + i) for i, r in enumerate(run_rows()[:8])] + [(*r[:7], None, *r[8:-1], 3000 + i) for i, r in enumerate(run_rows()[:3])]
    df = spark.createDataFrame(named + nameless, COLUMNS)
    told = df.withColumn("label_verbatim", F.lit(None).cast("string"))
    lazy = R.check_round(df, 3)
    tables = [("summary", lambda c: c.summary), ("diffs", lambda c: c.diffs), ("matched", lambda c: c.matched), ("keys", lambda c: c.comparison.matched),
              ("facts", lambda c: c.comparison.facts), ("agreed", lambda c: c.comparison.agreed.filter("json_file is not null")), ("recheck", lambda c: c.recheck),
              ("lines", lambda c: c.comparison.lines), ("items", lambda c: c.comparison.items.select(*lazy.comparison.items.drop("is_line", "is_source").columns)),
              ("details", lambda c: C.run_details(c.comparison)), ("rates", lambda c: C.pair_match_rates(c.comparison)), ("two", lambda c: C.two_of_n(c.comparison))]
    for kept in (R.check_round(df, 3, reuse=True), R.check_round(df, 3, reuse=True, reports=told), R.check_round(df, 3, reports=told)):
        for name, of in tables:
            a, b = of(lazy), of(kept)
            assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    assert [r["json_file"] for r in lazy.summary.filter("json_file is null").collect()] == [None] and lazy.matched.filter("json_file is null").isEmpty()


def test_lines_of_a_hot_report_are_spread(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        i = F.col("id") % 20000
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(i % 3 == 0, i.cast("string")).otherwise("hot").alias("json_file"), F.lit("p").alias("pdf_file_name"), F.lit("c").alias("country"), F.lit("True").alias("table_found"),
            F.lit("2016").alias("last_actual_year"), F.lit("residual").alias("top_category"), i.cast("string").alias("hierarchy_id"), F.sha2(i.cast("string"), 256).alias("label_verbatim"),
            F.when((F.col("id") >= 40000) & (i % 100 == 1), "8").otherwise("7").alias("value"), ((F.col("id") / 20000).cast("int") + 1).alias("run_no"), F.col("id").alias("row_no"))
        out = C.run_details(C.compare_runs(rows, 3))
        got = out.collect()
        assert len(got) == 20000 and sum(not r["same"] for r in got) == 200 and all(r["labels"] == [r["labels"][0]] * 3 for r in got)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def made_of(df):
    """The folder of the table that a frame reads."""
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_what_repeats_another_column_is_written_once(spark):
    """Columns of the source and of later runs are told where they differ; every one of them is read back, from any source run."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate([*report("T", 1, [*BASE, ("1", "change_in_debt", "7")]), *report("T", 2, change(BASE, v1="7.0")), *report("T", 3, change(BASE, v1="7"))])], COLUMNS)
    df = df.withColumn("label_verbatim", F.when(F.col("run_no") == 3, None).otherwise(F.col("label_verbatim"))).withColumn("country", F.when(F.col("row_no") != 2, F.col("country")))
    for source in (1, 2, 3):
        lazy, kept = [R.check_round(df, 3, source_run=source, reuse=reuse) for reuse in (False, True)]
        assert lazy.matched.count() >= 5 and sorted(map(str, lazy.matched.collect())) == sorted(map(str, kept.matched.collect()))
        assert sorted(map(str, C.run_details(lazy.comparison).collect())) == sorted(map(str, C.run_details(kept.comparison).collect()))
    own = spark.read.parquet(made_of(R.check_round(df, 3, reuse=True).matched)).filter("is_source").select("own.*", "told3.*")
    assert {r["value"] is None for r in own.filter("row_no <> 0").collect()} == {True} and own.filter("raw is null").count() >= 4


def test_only_wanted_columns_of_the_source_run_are_written(rows, spark):
    shown = ["json_file", "hierarchy_id", "confidence", "value"]
    lazy, some = R.check_round(rows, 3), R.check_round(rows, 3, reuse=True, keep=shown)
    assert some.matched.columns == shown
    written = spark.read.parquet(made_of(some.matched))
    assert [f.name for f in written.schema["own"].dataType] == ["confidence", "value"]
    assert "own" not in spark.read.parquet(made_of(R.check_round(rows, 3, reuse=True, keep=["json_file"]).matched)).columns
    want = sorted(map(str, R.ready_rows(lazy.matched, lazy.summary, "round1").select(*shown, "source_round").collect()))
    assert want and want == sorted(map(str, R.ready_rows(some.matched, some.summary, "round1").select(*shown, "source_round").collect()))
    assert R.check_round(rows, 3, reuse=True, keep=["json_file"]).matched.count() == R.check_round(rows, 3, keep=["json_file"]).matched.count() == lazy.matched.count()
