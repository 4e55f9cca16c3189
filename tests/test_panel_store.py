"""Panels in buckets and tables that are written all or none."""
import os

import pytest
from pyspark.sql import functions as F

from panelkit.plans import panel_build as B, panel_store as PS
from panelkit.schema import PREGAP_LAYOUT, align, to_pregap
from panelkit.sources import sinks as SK


def rows_of(spark, reports, value, source="round1", run=None):
    d = spark.createDataFrame([(r, str(h), f"{value} {h}") for r in reports for h in (1, 2)], "json_file string, hierarchy_id string, value string")
    return to_pregap(d, source, run) if run else to_pregap(d, source)


def files(folder):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{folder}/rows") for f in fs if f.endswith(".parquet")}


def bucket(path):
    return int(path.split("bucket=")[1].split("/")[0])


def content(spark, folder):
    return sorted(map(tuple, PS.read(spark, folder).select("json_file", "hierarchy_id", "value", "source_round", "gapfill_run").collect()), key=repr)


REPORTS = [f"r{n}" for n in range(300)]


@pytest.fixture
def panel(spark, tmp_path):
    folder = str(tmp_path / "panel")
    PS.create(B.build_panel(rows_of(spark, [*REPORTS, None], "old"), [rows_of(spark, [], "x")]).rows, folder, 32)
    return folder


def test_an_update_rewrites_its_own_buckets_only(spark, panel):
    before = files(panel)
    ids = ["r7", "r8", "fresh"]
    touched = {r["b"] for r in spark.createDataFrame([(i,) for i in [*ids, "r9"]], "i string").select(PS.bucket_of("i", 32).alias("b")).collect()}
    built = PS.update(spark, panel, [rows_of(spark, ids, "new")], dropped=rows_of(spark, ["r9"], "x"), stamp="u1")
    after = files(panel)
    assert {f for f in before if bucket(f) not in touched} == {f for f in after if bucket(f) not in touched}
    assert not {f for f in before if bucket(f) in touched} & after and len(touched) < 5
    assert {r["json_file"] for r in built.duplicates.collect()} == {"r7", "r8"}
    want = B.build_panel(rows_of(spark, [*REPORTS, None], "old"), [rows_of(spark, ids, "new")], rows_of(spark, ["r9"], "x")).rows
    assert content(spark, panel) == sorted(map(tuple, want.select("json_file", "hierarchy_id", "value", "source_round", "gapfill_run").collect()), key=repr)
    with pytest.raises(ValueError, match="u1"):
        PS.update(spark, panel, [rows_of(spark, ids, "new")], stamp="u1")
    assert [(r["stamp"], set(r["touched"])) for r in PS.updates(spark, panel).collect()] == [("u1", touched)]
    assert {r["value"] for r in PS.read_reports(spark, panel, ["r7", "none"]).collect()} == {"new 1", "new 2"}


def test_an_update_that_broke_off_is_run_again(spark, panel, monkeypatch):
    def broken(*_):
        raise RuntimeError("lost")
    new = rows_of(spark, ["r1", "r2", "r3"], "fill").withColumn("year", F.lit("2001"))
    start = content(spark, panel)
    with monkeypatch.context() as m:
        m.setattr(PS, "_record", broken)
        with pytest.raises(RuntimeError):
            PS.append(spark, panel, new, "g1")
    PS.append(spark, panel, new, "g1")
    added = [("r%d" % n, str(h), f"fill {h}", "gapfill", "g1") for n in (1, 2, 3) for h in (1, 2)]
    assert content(spark, panel) == sorted(start + added, key=repr)
    with pytest.raises(ValueError, match="g1"):
        PS.append(spark, panel, new, "g1")
    with monkeypatch.context() as m:                    # before anything is replaced
        m.setattr(PS, "_write_buckets", broken)
        with pytest.raises(RuntimeError):
            PS.update(spark, panel, [rows_of(spark, ["r4"], "new")])
    assert content(spark, panel) == sorted(start + added, key=repr)


def test_dropping_every_report_of_a_bucket_empties_it(spark, tmp_path):
    folder = str(tmp_path / "p")
    PS.create(B.build_panel(rows_of(spark, ["a"], "old"), [rows_of(spark, [], "x")]).rows, folder, 4)
    PS.update(spark, folder, [rows_of(spark, [], "x")], dropped=rows_of(spark, ["a"], "x"))
    assert content(spark, folder) == [] and files(folder) == set()
    with pytest.raises(Exception):
        PS.create(align(rows_of(spark, ["a"], "old"), PREGAP_LAYOUT), folder, 4)
    with pytest.raises(ValueError, match="bucket"):
        PS.create(rows_of(spark, ["a"], "x").withColumn("bucket", F.lit(1)), str(tmp_path / "q"), 4)


def test_a_bucket_that_holds_most_rows_is_several_files(spark, tmp_path):
    d = spark.range(200_000).select(F.lit("hot").alias("json_file"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        PS.create(d.repartition(20), str(tmp_path / "p"), 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(tmp_path / "p")) > 4 and PS.read(spark, str(tmp_path / "p")).distinct().count() == 200_000


def test_a_run_is_written_whole_or_not_at_all(spark, tmp_path):
    folder, good = str(tmp_path), spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        SK.commit_tables({"a": good, "b": bad}, folder, "s1")
    assert SK.committed(spark, folder).count() == 0 and len(SK.uncommitted(spark, folder, ["a", "b"])) >= 1
    with pytest.raises(ValueError, match="no committed table"):
        SK.read_committed(spark, folder, "a")
    SK.commit_tables({"a": good, "b": spark.range(5)}, folder, "s1", {"round": "1"})
    SK.commit_tables({"a": spark.range(0)}, folder, "s2")
    assert SK.read_committed(spark, folder, "a").count() == 0 and SK.read_committed(spark, folder, "a", "s1").count() == 3 and SK.read_committed(spark, folder, "b").count() == 5
    assert sorted((r["stamp"], r["name"], r["n_rows"]) for r in SK.committed(spark, folder).collect()) == [("s1", "a", 3), ("s1", "b", 5), ("s2", "a", 0)]
    with pytest.raises(ValueError, match="already written"):
        SK.commit_tables({"a": good}, folder, "s1")
    for path in SK.uncommitted(spark, folder, ["a", "b"]):
        SK.remove(spark, path)
    assert SK.uncommitted(spark, folder, ["a", "b"]) == [] and SK.read_committed(spark, folder, "a", "s1").count() == 3


def test_lists_records_and_exports_are_read_back(spark, tmp_path):
    from panelkit.sources import readers as RD
    lists = spark.createDataFrame([("category_a_disagreement", "a_dsa.json", 'x "q", y'), ("category_a_disagreement", "b_dsa.json", None), ("category_b_no_table_in_all_runs", "c_dsa.json", "z")],
                                  "category string, json_file string, country string")
    SK.write_report_lists(lists, str(tmp_path / "lists"))
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "lists")).select("category", "json_file", "country").collect())) == sorted(map(tuple, lists.collect()))
    texts = spark.read.text(str(tmp_path / "lists"))
    assert {r["stem"] for r in RD.report_list(texts, "value").collect()} <= {"a", "b", "c"}
    with pytest.raises(Exception):
        SK.write_report_lists(lists, str(tmp_path / "lists"))
    rows = [("a", 'two\nlines, "q"', "1.50"), ("b", None, ""), ("c", "\\", " x ")]
    SK.write_csv(spark.createDataFrame(rows, "json_file string, label string, value string"), str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"', quote='"').orderBy("json_file").collect()
    assert [(r["json_file"], r["label"]) for r in back] == [(a, b) for a, b, _ in rows] and back[0]["value"] == "1.50"
    record = SK.run_record("s1", spark.range(3).agg(F.count("*").alias("n_rows")), round="1").collect()
    assert len(record) == 1 and (record[0]["stamp"], record[0]["round"], record[0]["n_rows"]) == ("s1", "1", 3)


def test_folders_are_ranked_in_batch_order(spark):
    from panelkit.sources import inventory as V
    files = spark.createDataFrame([(f"/o/{b}/d/{n}", n, 1) for b in ("b2", "b10", "b1") for n in ("notes.txt", "odd.pdf")], "path string, name string, size bigint")
    folders = spark.createDataFrame([(b, f"{b}/d") for b in ("b2", "b10", "b1")], "batch string, dir string")
    indexed, ignored = V.index_selected(files, "/o", folders)
    found = indexed.select("dir", "name").unionByName(ignored.select("dir", "name")).collect()
    assert sorted((r["dir"], r["name"]) for r in found) == [(f"{b}/d", "odd.pdf") for b in ("b1", "b10", "b2")]


def test_report_inventory_and_list_sizes(spark):
    from panelkit.sources import inventory as V, readers as RD
    files = spark.createDataFrame([("/b2/Chad_2016-01-02_CR1.pdf", "Chad_2016-01-02_CR1.pdf"), ("/b1/x/Chad_2016-01-02_CR1.pdf", "Chad_2016-01-02_CR1.pdf"), ("/b1/notes.pdf", "notes.pdf")], "path string, name string")
    got = V.report_inventory(files).collect()
    assert [(r["pdf_file_name"], r["path"], r["country"], r["pub_year"]) for r in got] == [("Chad_2016-01-02_CR1.pdf", "/b1/x/Chad_2016-01-02_CR1.pdf", "Chad", 2016)]
    lists = spark.createDataFrame([("a", ["x", "y"]), ("a", []), ("b", ["z"])], "category string, reports array<string>")
    assert {r["category"]: r["n_reports"] for r in RD.list_sizes(lists).collect()} == {"a": 2, "b": 1}


def test_an_update_moves_rows_once(spark, tmp_path):
    """Merged in pieces of buckets: the rows of build_panel, without a join, laid out as they are written."""
    old = B.build_panel(rows_of(spark, [*REPORTS, None], "old"), []).rows
    old = old.unionByName(to_pregap(rows_of(spark, ["r5", "g1"], "fill", "gapfill", "g")))
    new, gone = rows_of(spark, ["r7", "r8", "r8", "fresh", "r9", "late", None], "new"), spark.createDataFrame([("r9",), ("r10",), ("late",), (None,), ("none",)], "json_file string")

    def shown(df):
        return sorted(map(str, df.select(PREGAP_LAYOUT).collect()))
    for replace in (True, False):
        for dropped in (gone, None):
            want = shown(B.build_panel(old, [new], dropped, remove_gapfill=False, replace=replace).rows)
            for pieces in (1, 7):
                got = PS._merged(old, new, dropped, replace, 16, pieces)
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange") == 1 and "Join" not in plan
                assert shown(got) == want and got.filter(~F.col("bucket").eqNullSafe(PS.bucket_of("json_file", 16))).isEmpty()
    folder = str(tmp_path / "p")
    PS.create(old, folder, 4)
    PS.update(spark, folder, [new], gone)
    assert len(files(folder)) <= 4 * 4 and not [f for f in files(folder) if bucket(f) not in range(4)]
    assert SK.size_of(spark, f"{folder}/rows") > SK.size_of(spark, f"{folder}/rows/bucket=1") > 0 == SK.size_of(spark, f"{folder}/nothing")
