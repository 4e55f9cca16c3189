"""Answer validation, coverage counts, sources, pages and readers on small inputs."""
import json
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit import schema as L
from panelkit.operators import coverage as C, pages as PG, quality as Q, stats as ST, tree as T
from panelkit.operators.gaps import AUDIT_COLUMNS
from panelkit.plans.round_check import compile_results
from panelkit.sources import inventory as V, readers as RD, sinks as SK

TREE = {"change_in_debt": "1.0", "identified_flows": "0.5", "primary_balance": "0.2", "automatic_debt_dynamics": "0.2", "other_identified_flows": "0.1", "residual": "0.5"}
GOOD = {"target_year": 2016, "extractable": True, "not_extractable_reason": None, "column_status": "actual", "matched_year_label": "2016", "column_header_verbatim": "2016", "tree": TREE}
AUDIT = [("2015", "actual"), ("2016", "actual"), ("2017", "actual"), ("2018", "projection")]


def validate(spark, cases):
    target = "struct<target_year:int,extractable:boolean,not_extractable_reason:string,column_status:string,matched_year_label:string,column_header_verbatim:string,decomposition:" + T.tree_type().simpleString() + ">"
    out = []
    for n, (change, audit) in enumerate(cases):
        t = {**GOOD, **change}
        tree = t.pop("tree")
        t["decomposition"] = {k: {"label_verbatim": k, "value": v} for k, v in tree.items()}
        out.append((n, json.dumps(t), json.dumps([{"year_label": y, "status": s} for y, s in audit])))
    d = spark.createDataFrame(out, "n int, t string, a string")
    d = d.select("n", F.from_json("t", target).alias("t"), F.from_json("a", AUDIT_COLUMNS).alias("a"))
    return [r["v"] for r in d.select("n", Q.validate_target("t", F.col("a")).alias("v")).orderBy("n").collect()]


def test_validate_target(spark):
    codes = lambda v: [e["code"] for e in v["errors"]]
    r = validate(spark, [({}, AUDIT), ({"column_status": "projection", "column_header_verbatim": "Proj. 2016"}, AUDIT), ({"column_header_verbatim": "Prel. 2016"}, AUDIT), ({}, [("2015", "actual")]),
                         ({}, [("2016", "estimate")]), ({}, [("2015", "projection"), ("2016", "actual")]), ({"matched_year_label": "2017"}, AUDIT), ({"matched_year_label": "2015/16"}, AUDIT),
                         ({"tree": {k: None for k in TREE}}, AUDIT), ({"extractable": False, "not_extractable_reason": "year_only_in_merged_range"}, AUDIT), ({"tree": {**TREE, "change_in_debt": "5.0"}}, AUDIT),
                         ({"extractable": None}, AUDIT), ({"column_status": "historical"}, AUDIT)])
    assert [v["status"] for v in r] == ["resolved", "rejected_not_actual", "rejected_not_actual", "needs_independent_audit", "needs_independent_audit", "rejected_not_actual", "rejected_not_actual", "resolved",
                                       "rejected_not_actual", "merged_range_only", "resolved", "not_extracted", "resolved"]
    assert "header_text" in codes(r[2]) and codes(r[3]) == ["audit_missing"] and codes(r[4]) == ["audit_status"] and "monotonic" in codes(r[5]) and codes(r[8]) == ["no_values"]
    assert r[10]["warnings"] == ["identity change_in_debt = identified_flows + residual fails: 5.0 vs 1.0"] and len(r[12]["warnings"]) == 1


def test_audit_confirms(spark):
    audits = [AUDIT, [("2016", "estimate")], [("2015", "projection"), ("2016", "actual")], []]
    d = spark.createDataFrame([(i, json.dumps([{"year_label": y, "status": s} for y, s in a])) for i, a in enumerate(audits)], "i int, a string")
    got = d.select("i", Q.audit_confirms(F.from_json("a", AUDIT_COLUMNS), F.lit(2016)).alias("c")).orderBy("i").collect()
    assert [r["c"]["confirmed"] for r in got] == [True, False, False, False]


PANEL = [("A", "5", "1.0", None, "2017", "round1", None), ("A", "5", "1.5", None, "2017", "round2", None), ("a", "5", "2", None, "2018", "round1", None), ("B", "5", "3", None, "2017/18", "round3", None),
         ("A", "5", "2.01", None, "2018", "gapfill", "r1"), ("B", "6", "4", None, "2018", "round1", None), ("C", "5", "1,169", None, "2018", "round1", None), ("D", "5", "7", "2016", "2019", "gapfill", "r2")]


def test_coverage_counts(spark):
    rows = spark.createDataFrame(PANEL, "country string, hierarchy_id string, value string, year string, last_actual_year string, source_round string, gapfill_run string")
    v = C.load_values(rows, ["5"])
    by = {r["year"]: tuple(r)[2:] for r in C.coverage_by_year(v).collect()}
    assert by == {2016: (1, 1, 0, 0), 2017: (1, 2, 1, 1), 2018: (2, 3, 1, 0)}
    assert {r["country_label"] for r in v.collect()} == {"A", "B", "D"}
    res = spark.createDataFrame([("B", 2017, "unresolved", "r1"), ("B", 2017, "resolved", "r2"), ("C", 2017, "pending_not_run", "r1"), ("D", 2018, "unresolved_no_candidate_reports", "r1")],
                                "country string, gap_year int, final_status string, gapfill_run string")
    t = C.best_targets(res, ["r1", "r2"])
    grid = C.year_grid(C.universe(rows), 2016, 2018)
    cells = C.availability(grid, v, C.observed_reports(rows), t)
    for r in C.availability_by_year(cells, ["r1", "r2"]).collect():
        reasons = sum(r[f"n_unavail_{x}"] for x in C.REASONS) + r["n_unavail_other"]
        assert r["total_countries"] == 4 and r["n_available"] + r["n_unavailable"] == 4 and reasons == r["n_unavailable"]
        if r["year"] == 2017:
            assert r["n_unavail_gapfill_resolved_but_field_missing"] == 1 and r["n_unavail_other"] == 1 and r["n_round1"] == 1
        if r["year"] == 2016:
            assert r["n_gapfill_run_r2"] == 1
    assert C.pick_indicators([("h5_other", "5"), ("h3_1_x", "3.1")], ["H5", "h3 1"]) == ["h5_other", "h3_1_x"]
    with pytest.raises(ValueError):
        C.pick_indicators([("h5_other", "5")], "h9")


def test_layout(spark):
    d = spark.createDataFrame([("a", "5.1", "other_identified_flows"), ("a", "5.1", "other_identified_flows"), ("b", "7", "x"), ("c", "1", "residual"), ("d", None, None)], "json_file string, hierarchy_id string, top_category string")
    full = L.to_pregap(d, "gapfill", "r1")
    assert full.columns == L.PREGAP_LAYOUT and len(L.ROUND_LAYOUT) == 43 and len(L.LEGACY_LAYOUT) == 21 and L.column_problems(full) == [] and L.column_problems(d)
    assert {r["problem"]: r["n_rows"] for r in L.layout_problems(full).collect()} == {"bad_hierarchy_id": 2, "category_mismatch": 1, "duplicate_key": 2}
    assert L.to_panel(full).columns == L.PANEL_LAYOUT


def test_contribution_all_holds_unclassified_entities(spark):
    cy = spark.createDataFrame([("a", "AE", 1.0, -2.0), ("b", None, 3.0, 0.0), ("a", "AE", 0.0, 1.0)], "e string, g string, x double, Other double")
    s = {r["group"]: r for r in ST.contribution_shares(cy, "g", ["x", "Other"], "e").collect()}
    assert s["All"]["gross_x"] == 4.0 and s["AE"]["gross_x"] == 1.0 and s["All"]["n_entities"] == 2
    assert all(np.isclose(r["share_x"] + r["share_Other"], 1) for r in s.values())


def test_pages(spark):
    text = {1: "contents", 2: "Public debt sustainability framework", 3: "CONTRIBUTION to  change in public debt; identified debt-creating flows; residual 1 2", 4: "annex", 5: "baseline scenario", 6: "end"}
    p = spark.createDataFrame([("d", n, t) for n, t in text.items()], "doc string, page_no int, text string")
    k = PG.keyword_pages(p, "doc").collect()
    assert [(r["page_no"], r["score"], r["start_page"], r["end_page"], r["likely_image_based"]) for r in k] == [(3, 16 + 8 + 12 + 3 + 2 + 12 + 10, 1, 5, True)]
    c = PG.context_text(p, "doc", 10_000, first=1, last=1, around=0).collect()[0]["context"]
    assert c == "PDF file: d\n" + "".join(f"\n\n--- PAGE {n} ---\n{text[n]}" for n in (1, 2, 3, 5, 6))
    assert PG.context_text(p, "doc", 40, first=1, last=1, around=0).collect()[0]["context"] == c[:40]


def test_context_is_whole(spark):
    """Every page of the context, past any length that a reader may cut at, and a cut only where the caller asks for one."""
    p = spark.createDataFrame([("d", n, f"page {n} " + "x" * 3000) for n in range(1, 301)] + [("e", 1, None), ("e", 2, "b")], "doc string, page_no int, text string")
    rows = PG.context_long(p, "doc", first=300, last=1, around=0).collect()
    d = sorted((r for r in rows if r["doc"] == "d"), key=lambda r: r["page_no"])
    whole = "PDF file: d\n" + "".join(f"\n\n--- PAGE {n} ---\npage {n} " + "x" * 3000 for n in range(1, 301))
    assert len(whole) > 900_000 and "PDF file: d\n" + "".join(r["text"] for r in d) == whole
    assert all(whole[r["start"] :].startswith(r["text"]) for r in d)
    assert sorted((r["page_no"], r["text"]) for r in rows if r["doc"] == "e") == [(1, None), (2, "\n\n--- PAGE 2 ---\nb")]
    with pytest.raises(TypeError):
        PG.context_text(p, "doc", first=300)


def node(label, value, *children):
    return {"label_verbatim": label, "value": value, "children": list(children)}


def test_read_and_compile(spark, tmp_path):
    good = {"report_metadata": {"country": "CÔTE D'IVOIRE"}, "source": {"last_actual_year": "2016", "actual_column_label": "Act. 2016", "column_header_audit": {"columns": [{"year_label": "2016", "selected": True}], "selected_year": "2016"}},
            "table_found": True, "pdf_file_name": "a.pdf", "decomposition": {"debt_level": node("Debt", "50"), "primary_balance": node("Primary", "1.50", node("Revenue", "3"), None, node("Spending", None, node("Interest", "2"))), "residual": node("Residual", "0")}}
    files = {"a_dsa.json": json.dumps(good), "b_dsa.json": json.dumps({"table_found": False, "failure_reason": "none", "decomposition": None}), "c_dsa.json": json.dumps({"table_found": True}),
             "d_dsa.json": json.dumps(good)[:-20], "e.json": "{}", "f_ERROR.json": json.dumps({"error": " boom "})}
    for name, body in files.items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    results = RD.read_extractions(spark, str(tmp_path))
    assert [r["json_file"] for r in RD.bad_files(results).collect()] == ["d_dsa.json"]
    out = compile_results(results).collect()
    rows = {r["hierarchy_id"]: r for r in out if r["json_file"] == "a_dsa.json"}
    assert list(rows) == ["3", "3.1", "3.3", "3.3.1", "6"] and rows["3.3.1"]["parent_label"] == "Spending" and rows["3"]["value"] == "1.50"
    assert rows["3"]["country"] == "Côte D'Ivoire" and rows["3"]["actual_year_label_match"] == "Yes" and rows["3.1"]["level"] == "1"
    none = [r for r in out if r["json_file"] == "b_dsa.json"]
    assert len(none) == 1 and none[0]["failure_reason"] == "none" and none[0]["hierarchy_id"] is None and len(out) == 6
    err = RD.read_errors(spark, {1: str(tmp_path)}).collect()
    assert [(r["run_no"], r["stem"], r["message"]) for r in err] == [(1, "f", "boom")]


def test_csv_and_sinks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿json_file,pdf_file_name,table_found,last_actual_year,top_category,hierarchy_id,label_verbatim,value\na,b,True,2016,residual,6,"two\nlines, ""q""",1.50\n', encoding="utf-8")
    r = RD.read_run(spark, str(tmp_path / "r.csv")).collect()
    assert r[0]["json_file"] == "a" and r[0]["label_verbatim"] == 'two\nlines, "q"' and r[0]["value"] == "1.50"
    (tmp_path / "s.csv").write_text("a,b\nNA,\n", encoding="utf-8")
    assert tuple(RD.read_sparse(spark, str(tmp_path / "s.csv"), ["a", "b"]).collect()[0]) == ("NA", None)
    with pytest.raises(ValueError):
        RD.read_run(spark, str(tmp_path / "s.csv"))
    d = spark.range(3)
    SK.write_stamped(d, str(tmp_path), "t", "s1")
    with pytest.raises(Exception):
        SK.write_stamped(d, str(tmp_path), "t", "s1")
    assert SK.exists(spark, str(tmp_path / "t")) and not SK.exists(spark, str(tmp_path / "u"))
    reg = SK.TableRegistry()
    reg.add("ids", lambda: d)
    assert reg.names() == ["ids"] and reg.table("ids").count() == 3


def test_inventory(spark, tmp_path):
    for name in ("b1/Haiti_2020-04-20_CR2020-123.pdf", "b2/Haiti_2020-04-20_CR2020-123.pdf", "b2/notes.pdf", "b2/The Gambia_2019-01-01.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    files = V.list_files(spark, str(tmp_path), "*.pdf")
    docs, unparsed = V.document_inventory(files, str(tmp_path))
    assert sorted((r["entity_key"], r["batch"], r["year"]) for r in docs.collect()) == [("gambia", "b2", 2019), ("haiti", "b1", 2020)] and unparsed.count() == 1
    assert {r["batch"]: r["n_files"] for r in V.batch_counts(files, str(tmp_path)).collect()} == {"b1": 1, "b2": 3}
    f = V.fingerprint(spark, str(tmp_path / "b2/notes.pdf")).collect()[0]
    assert f["size_bytes"] == 1 and f["sha256_16"] == "2d711642b726b044"


def test_report_list(spark):
    texts = [json.dumps({"meta": {"x": 1}, "category_a": {"description": "d", "reports": [{"json_file": "a_dsa.json", "country": "c"}, "b.pdf"]}, "category_b": {"reports": ["c.pdf"]}}), json.dumps(["b", "e.pdf"])]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {(r["stem"]) for r in RD.report_list(d, "t").collect()} == {"a", "b", "c", "e"}
    assert {(r["stem"]) for r in RD.report_list(d.limit(1), "t", "category_b").collect()} == {"c"}


def test_report_list_of_any_nesting(spark):
    deep = {"reports": ["deep.pdf"]}
    for n in range(9):
        deep = {"reports": [{"group": n, "reports": [[deep], 7, None]}]}
    texts = [{"reports": [{"group": "x", "reports": ["a.pdf"]}]}, [["b.pdf"], "c.pdf"], {"top": deep}, {"json_file": 5, "report": "d.pdf", "x": {"reports": ["no.pdf"]}}, "e.pdf", {"notes": ["f.pdf"]}]
    d = spark.createDataFrame([(json.dumps(t),) for t in texts], "t string")
    assert {(r["stem"], r["category"]) for r in RD.report_list(d, "t").collect()} == {("a", None), ("b", None), ("c", None), ("deep", "top"), ("d", None)}
    with pytest.raises(Exception, match="no top-level key"):
        RD.report_list(d, "t", "absent").collect()


def test_tree_of_any_depth(spark):
    tree = {"label_verbatim": "leaf", "value": 12.5, "children": ["text", None, {"label_verbatim": "last [", "value": "1e3"}]}
    for n in range(20):
        tree = {"label_verbatim": f'say "[{n}]"', "value": str(n), "children": [None, tree]}
    text = json.dumps({"residual": tree, "primary_balance": {"label_verbatim": None, "value": None, "children": "none"}})
    d = spark.createDataFrame([(1, text), (2, "{}"), (3, None)], "k int, t string").select("k", F.from_json("t", T.tree_type()).alias("tree"))
    rows = {r["hierarchy_id"]: r for r in T.flatten_tree(d, "tree").collect()}
    assert len(rows) == 23 and {r["k"] for r in rows.values()} == {1}
    leaf = next(r for r in rows.values() if r["label_verbatim"] == "leaf")
    last = next(r for r in rows.values() if r["label_verbatim"] == "last [")
    assert leaf["hierarchy_id"] == "6" + 20 * ".2" and leaf["level"] == 20 and leaf["parent_label"] == 'say "[0]"' and leaf["value"] == "12.5"
    assert last["hierarchy_id"] == leaf["hierarchy_id"] + ".3" and last["parent_label"] == "leaf" and last["value"] == "1e3"


@pytest.mark.parametrize("depth", [1, 2, 17, 200])
def test_tree_walk_beside_recursion(spark, depth):
    """Rows of a bushy tree and of a chain as plain recursion gives them, with lists and quotes in labels and foreign lists in nodes."""
    def grown(n, wide):
        kids = [grown(n - 1, wide - 1), "x", {"children": [], "label_verbatim": f'\\\\" [[ {n}', "value": None}] if n else []
        return {"label_verbatim": f"[{n}\\n\\u00e9", "value": str(n) if n % 2 else n, "notes": [[[n]]], "children": kids * (2 if wide > 0 and n else 1)}

    def walked(node, hid, level, parent):
        value = node.get("value")
        out = [(hid, level, parent, node["label_verbatim"], None if value is None else str(value))]
        for i, kid in enumerate(node["children"], 1):
            if isinstance(kid, dict):
                out += walked(kid, f"{hid}.{i}", level + 1, node["label_verbatim"])
        return out
    sys.setrecursionlimit(5000)
    tree = {"primary_balance": grown(min(depth, 6), 3), "residual": grown(depth, 0)}
    d = spark.createDataFrame([(json.dumps(tree),)], "t string").select(F.from_json("t", T.tree_type()).alias("tree"))
    got = d.select(F.explode(T.tree_rows("tree")).alias("r")).select("r.hierarchy_id", "r.level", "r.parent_label", "r.label_verbatim", "r.value").collect()
    assert list(map(tuple, got)) == walked(tree["primary_balance"], "3", 0, None) + walked(tree["residual"], "6", 0, None)


def test_stream_compile(spark, tmp_path):
    from panelkit.streaming.incremental import stream_compile
    src = tmp_path / "in"
    src.mkdir()
    body = json.dumps({"table_found": True, "decomposition": {"residual": node("Residual", "0")}})
    (src / "a_dsa.json").write_text(body)
    args = (spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"))
    stream_compile(*args).awaitTermination()
    (src / "b_dsa.json").write_text(body)
    (src / "c_dsa.json").write_text(body[:-5])
    stream_compile(*args).awaitTermination()
    assert {r["json_file"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a_dsa.json", "b_dsa.json"}
    assert [r["json_file"] for r in spark.read.parquet(str(tmp_path / "out_errors")).collect()] == ["c_dsa.json"]


def test_runs_are_numbered_in_file_order(spark, tmp_path):
    from panelkit.sources import readers as RD
    paths = []
    for name in ("b", "a"):
        p = tmp_path / f"{name}.csv"
        p.write_text("json_file,value\n" + "".join(f"{name},{i}\n" for i in range(2000)), encoding="utf-8")
        paths.append(str(p))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        run = RD.read_run(spark, paths, required=["json_file"], multi_line=False, numbered=True)
        rows = RD.stack_runs([run, run]).orderBy("run_no", "row_no").select("run_no", "json_file", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in rows] == [(n, f, str(i)) for n in (1, 2) for f in ("b", "a") for i in range(2000)]


def test_saved_answers_and_lookup(spark, tmp_path):
    from panelkit.sources import readers as RD
    (tmp_path / "r1_gapfill.json").write_text('{"per_target": {"2001": {"status": "resolved", "errors": ["e"]}, "x": {"status": "api_error"}}}')
    (tmp_path / "bad_gapfill.json").write_text("{")
    rows = {(r.stem, r.year, r.answer.status) for r in RD.read_answers(spark, str(tmp_path)).collect()}
    assert rows == {("r1", 2001, "resolved"), ("r1", None, "api_error")}
    (tmp_path / "l.csv").write_text("n,c\nA,1\nB,\n")
    assert [tuple(r) for r in RD.read_lookup(spark, str(tmp_path / "l.csv"), {"n": "name", "c": "code"}, "n string, c int").orderBy("name").collect()] == [("A", 1), ("B", None)]


def test_intermediate_tables_are_cleared(spark):
    import os

    from panelkit.session import alone, clear_tables, discard, materialise

    clear_tables(spark)
    one, two = materialise(spark.range(5)), materialise(spark.range(7))
    path = lambda t: t.table_path.removeprefix("file:")
    discard(one)
    assert not os.path.exists(path(one)) and two.count() == 7
    three = alone(lambda: materialise(two.where("id > 2")).where("id > 3"))
    assert three.count() == 3 and clear_tables(spark) == 2 and not os.path.exists(path(two)) and clear_tables(spark) == 0
