"""Counts of one pass and coverage as bits, beside plain Python."""
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import coverage as C
from panelkit.operators.measures import set_counts


def counts(df):
    return {(r["measure"], r["item"]): r["n"] for r in df.collect()}


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation")


def test_set_counts(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("b", None, "x"), (None, None, None), ("a", 2, "x")]
    d = spark.createDataFrame(data, "k string, v int, s string")
    sets = {(): [("rows", None, F.col("n")), ("most", None, F.col("top"))], ("k",): [("keys", None, F.when(F.col("k").isNotNull(), 1))], ("k", "v"): [("pairs", None, F.lit(1)), ("pairs_of", F.col("k"), F.lit(1))],
            ("s",): [("by_s", F.col("s"), F.col("n"))]}
    got = counts(set_counts(d, sets, {"top": F.max("v")}))
    assert got == {("rows", None): 5, ("most", None): 2, ("keys", None): 2, ("pairs", None): 4, ("pairs_of", "a"): 2, ("pairs_of", "b"): 1, ("pairs_of", None): 1, ("by_s", "x"): 3, ("by_s", "y"): 1, ("by_s", None): 1}
    assert counts(set_counts(d.limit(0), sets, {"top": F.max("v")})) == {("rows", None): 0, ("most", None): 0, ("keys", None): 0, ("pairs", None): 0}
    assert counts(set_counts(d, {(): [("rows", None, F.col("n"))]})) == {("rows", None): 5}
    with pytest.raises(ValueError):
        set_counts(d, {("k", "v"): [], ("v", "k"): []})


def test_panel_statistics_read_their_panel_once(spark, tmp_path):
    cols = "json_file string, pdf_file_name string, country string, year string, source_round string, update_origin string"
    d = spark.createDataFrame([("a", "Chad_2016-01-01_x.pdf", "z", "2016", "round1", None), ("a", "Chad_2016-01-01_x.pdf", "z", None, "round1", "new"), (None, None, None, None, None, "new")], cols)
    d.write.parquet(str(tmp_path / "p"))
    stats = C.panel_stats(spark.read.parquet(str(tmp_path / "p")))
    assert scans(stats) == 1
    assert counts(stats) == {("rows", None): 3, ("reports", None): 1, ("countries", None): 1, ("country_years", None): 3, ("source", "round1"): 2, ("source", ""): 1, ("origin", "new"): 2, ("origin", ""): 1}


def test_overview_with_review(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "json_file string")
    queue = spark.createDataFrame([("todo",), ("reviewed",), ("skipped",)], "status string")
    got = {r["source"]: tuple(r)[1:] for r in C.overview({"round1": rows, "round2": rows.limit(0)}, queue).collect()}
    assert got == {"round1": (4, 2, None, None), "round2": (0, 0, None, None), "round3": (0, 0, 2, 3)}
    assert {r["source"]: tuple(r)[1:] for r in C.overview({"round1": rows}).collect()} == {"round1": (4, 2, None, None)}


def test_coverage_map_beside_plain_python(spark, tmp_path):
    """More items than a word holds, sources that are not listed or missing, spellings of one name, labels that are ranges or no years."""
    rnd = random.Random(5)
    items = [f"1.{i}" for i in range(1, 31)]
    data = [(rnd.choice(["Chad", " chad", "CHAD", "Haiti", "St. Lucia", None]), rnd.choice([*items, "9", None]), rnd.choice(["1", "2.5", "n/a", " ", None]), rnd.choice(["2001", "2002", "2001/02", "2010", "x", None]),
             rnd.choice(["round1", "round2", "round3", "gapfill", "draft", None]), rnd.choice([2001, 2003, None])) for _ in range(3000)] + [("Empty", None, None, None, None, None)]
    spark.createDataFrame(data, "country string, hierarchy_id string, value string, last_actual_year string, source_round string, pub int").write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    reports = spark.createDataFrame([("chad", 2002), ("chad", 2002), ("nowhere", 2001), ("haiti", 1990), (None, 2001)], "country_key string, year int")
    cover = C.coverage_map(rows, 2000, 2003, reports, items, F.col("pub"))
    columns = [(f"c{i}", i) for i in items]
    wide = {(r["country_key"], r["year"]): r.asDict() for r in C.coverage_wide(cover, columns).collect()}
    best = {(r["country_key"], r["year"]): r.asDict() for r in C.sources_wide(cover, columns).collect()}
    order, years = ["round1", "round2", "round3", "gapfill"], {"2001": 2001, "2002": 2002, "2001/02": 2002, "2010": 2010}
    have, tables = {}, set()
    for country, item, value, label, source, pub in data:
        if country is not None:
            key = country.strip().lower()
            tables.add((key, pub))
            if item in items and value in ("1", "2.5") and label in years:
                have.setdefault((key, years[label], item), []).append(order.index(source) if source in order else 4)
    keys = {(c, y) for c in ("chad", "haiti", "st. lucia", "empty") for y in range(2000, 2004)}
    assert set(wide) == set(best) == keys
    names = ["Round 1", "Round 2", "Round 3", "Gap fill", "Other"]
    for c, y in keys:
        w, b = wide[c, y], best[c, y]
        assert (w["has_staff_report"], w["has_dsa_table"]) == ("Yes" if (c, y) == ("chad", 2002) else "No", "Yes" if (c, y) in tables else "No")
        for i in items:
            got = have.get((c, y, i))
            assert w[f"c{i}"] == ("Yes" if got else "No") and b[f"c{i}"] == (names[min(got)] if got else "")
    totals = {r["hierarchy_id"]: r.asDict() for r in C.item_totals(cover, columns).collect()}
    for i in items:
        found = [min(v) for (c, y, h), v in have.items() if h == i and 2000 <= y <= 2003]
        assert totals[i]["country_years_with_value"] == len(found) and [totals[i][f"n_{s}"] for s in order] == [found.count(k) for k in range(4)]
    assert scans(C.coverage_wide(cover, columns)) == 1 and "Join" not in C.coverage_wide(cover, columns)._jdf.queryExecution().optimizedPlan().toString()
    empty = C.coverage_map(rows.limit(0), 2000, 2003, reports.limit(0), [], None)
    assert C.coverage_wide(empty, []).collect() == []
