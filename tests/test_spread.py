"""Skewed joins, distributed numbering, running sums and exact quantiles against plain Python."""
import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators import pick, spread
from panelkit.operators.quantiles import exact_quantiles


def test_split_join_equals_a_plain_join(spark):
    rnd = random.Random(1)
    big = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 3, None]), i) for i in range(500)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, big.join(small, "k", how).collect()))
        assert plain == sorted(map(str, spread.split_join(big, small, ["k"], how).collect())), how


def test_a_hot_key_is_split_even_next_to_an_aggregate(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        big = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        small = big.groupBy("k").agg(F.max("v").alias("m"))
        out = spread.split_join(big, small, ["k"]).groupBy("k").agg(F.count("*").alias("n"), F.max("m").alias("m"))
        assert out.filter("k = 7").collect()[0]["n"] == 20001
        out = spread.split_join(big, small, ["k"])
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_number_rows_is_a_global_order(spark):
    rnd = random.Random(2)
    vals = [(rnd.choice("aaab"), rnd.randint(0, 10**6)) for _ in range(700)]
    df = spark.createDataFrame(vals, "k string, v int").repartition(5)
    out = spread.number_rows(df, ["k", "v"], "n").orderBy("n").collect()
    assert [(r["k"], r["v"]) for r in out] == sorted(vals) and [r["n"] for r in out] == list(range(1, 701))
    within = spread.number_within(df.distinct(), ["k"], [F.col("v").desc()], "rank").collect()
    for k in "ab":
        mine = sorted({v for x, v in vals if x == k}, reverse=True)
        assert [r["v"] for r in sorted((r for r in within if r["k"] == k), key=lambda r: r["rank"])] == mine


def test_running_sum(spark):
    df = spark.createDataFrame([("a", i, i % 7) for i in range(1, 60)], "k string, p int, v int")
    out = {r["p"]: r["s"] for r in spread.running_sum(df, "k", "p", "v", "s", block=8).collect()}
    total = 0
    for i in range(1, 60):
        total += i % 7
        assert out[i] == total


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"n": rng.normal(0, 5, 400), "z": np.zeros(50), "one": np.array([3.25]), "two": np.array([-1.0, 4.0]),
              "mix": np.concatenate([np.zeros(30), rng.lognormal(0, 4, 91), -rng.lognormal(1, 3, 60)])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("n", None)], "g string, v double")
    probs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.77, "e": 0.95, "f": 1.0}
    for r in exact_quantiles(df, ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert np.isclose(r[name], np.quantile(groups[r["g"]], p), rtol=1e-12, atol=1e-12), (r["g"], name)
    pooled = exact_quantiles(df, [], "v", probs).collect()[0]
    everything = np.concatenate(list(groups.values()))
    assert all(np.isclose(pooled[n], np.quantile(everything, p)) for n, p in probs.items())


def test_quantiles_of_odd_and_close_values(spark):
    """NaN is missing, infinite values lie at the ends, a NULL group is a group, and a crowded cell is cut again."""
    from panelkit.operators.quantiles import NARROWER, value_cell
    from panelkit.operators.stats import group_stats
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", v) for v in (inf, -inf, 1.0, nan, 2.0)] + [(None, 3.0), ("b", inf), ("c", nan)], "g string, v double")
    got = {r["g"]: (r["lo"], r["mid"], r["hi"]) for r in exact_quantiles(df, ["g"], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).collect()}
    assert got == {"a": (-inf, 1.5, inf), None: (3.0, 3.0, 3.0), "b": (inf, inf, inf)}
    assert {r["g"]: r["median"] for r in group_stats(df, ["g"], "v").collect()} == {"a": 1.5, None: 3.0, "b": inf, "c": None}
    close = spark.range(1_000_000).select((F.lit(5.0) + F.col("id") / 1e9).alias("v"))
    q = exact_quantiles(close, [], "v", {"q": 0.25}).collect()[0]["q"]
    assert abs(q - (5.0 + 249_999.75e-9)) < 1e-12
    assert close.groupBy(value_cell(F.col("v"), NARROWER)).count().agg(F.max("count")).collect()[0][0] < 2_000


def test_picks(spark):
    df = spark.createDataFrame([("k", "round2", 1.0, "b"), ("k", "round1", 2.0, "b"), ("k", "round1", 3.0, "a"), ("q", "other", 4.0, "a"), ("q", "gapfill", 5.0, "z")],
                               "k string, s string, v double, t string")
    got = {r["k"]: r["v"] for r in pick.by_priority(df, ["k"], "s", ["round1", "round2", "round3", "gapfill"], [F.col("t")]).collect()}
    assert got == {"k": 3.0, "q": 5.0}
    assert [r["t"] for r in pick.most_common(df, ["k"], "t").orderBy("k").collect()] == ["b", "a"]
    labels = spark.createDataFrame([("x", c) for c in "aaabbcccdd"] + [("x", None)], "k string, l string")
    assert pick.most_common_n(labels, ["k"], "l", 3, "top").collect()[0]["top"] == "a | c | b"
    order = spark.createDataFrame([("x", v, i) for i, v in enumerate(["a", "b", "b", "a", None])], "k string, v string, i int")
    assert pick.majority(order, ["k"], "v", "i").collect()[0]["majority"] == "b"
    wide = spark.createDataFrame([("a", "b", "b"), ("a", None, "b"), (None, None, None), ("a", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in wide.select(pick.majority_of([F.col("x"), F.col("y"), F.col("z")])).collect()] == ["b", "a", None, "a"]
    runs = spark.createDataFrame([("c", "gapfill", "r2"), ("c", "gapfill", "r1"), ("d", "round3", None), ("d", "gapfill", "r1"), ("e", "odd", None)], "k string, source_round string, gapfill_run string")
    assert {r["k"]: r["source_tag"] for r in pick.source_by_run(runs, ["k"]).collect()} == {"c": "gapfill:r1", "d": "round3", "e": "unknown"}


def test_intervals_by_running_totals(spark):
    """Counts and lists of the days strictly inside spans, open ones and empty ones too, beside a scan of all days; one entity
    with 10,000 spans and 10,000 days yields no more rows than both on the way."""
    import datetime
    import random

    from panelkit.operators import gaps as G

    rng = random.Random(3)
    day = lambda n: datetime.date(1990, 1, 1) + datetime.timedelta(n)
    days = [(c, day(n), rng.randrange(4)) for c in "abcd" for n in rng.sample(range(400), 60)] + [("d", None, 1)]
    spans = [(c, k, rng.choice([None, day(rng.randrange(400))]), rng.choice([None, day(rng.randrange(400))])) for c in "abcde" for k in range(40)]
    spans = [x for x in spans if x[2] or x[3]]
    d = spark.createDataFrame(days, "country string, report_date date, n long").filter("report_date is not null")
    s = spark.createDataFrame(spans, "country string, span_start int, prev_date date, next_date date")
    got = {(r.country, r.span_start): max(r.n_to - r.n_from, 0) for r in G.sums_between(s, d, ["n"]).collect()}
    inside = lambda x: [(t, n) for c, t, n in days if t and c == x[0] and (not x[2] or t > x[2]) and (not x[3] or t < x[3])]
    assert got == {x[:2]: sum(n for _, n in inside(x)) for x in spans}
    reports = d.withColumn("pdf_file_name", F.concat("country", F.col("report_date").cast("string")))
    listed = G.reports_in_between(s, reports).select("country", "span_start", "report_date").collect()
    assert sorted(map(tuple, listed)) == sorted((*x[:2], t) for x in spans for t, _ in inside(x))

    n = 10_000
    many = spark.range(n).select(F.lit("x").alias("country"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("report_date"), F.lit(1).cast("long").alias("n"))
    wide = spark.range(n).select(F.lit("x").alias("country"), F.col("id").cast("int").alias("span_start"), F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") / 2).cast("int")).alias("prev_date"),
                                 F.date_add(F.lit("1900-01-01").cast("date"), (F.lit(n) - F.col("id") / 2).cast("int")).alias("next_date"))
    out = G.sums_between(wide, many, ["n"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and out.agg(F.sum(F.col("n_to") - F.col("n_from"))).first()[0] == sum(n - i // 2 - 1 - (i + 1) // 2 if i else n - 1 for i in range(n))


def test_runs_across_ranges(spark):
    """Zero runs of series cut into many ranges beside a walk over each series: one entity with most of the rows, missing
    periods, null values, an entity without a name, runs longer than a range and series that end at an edge."""
    from panelkit.operators import gaps as G

    rng = random.Random(7)
    series = {"hot": [(p, 0.0 if 100 < p < 900 or rng.random() < 0.7 else 1.0) for p in range(2000) if rng.random() < 0.97], "zero": [(p, 0.0) for p in range(700)],
              None: [(p, rng.choice([0.0, None, 2.0])) for p in range(50)], "one": [(5, 0.0)], "last": [(p, float(p < 90)) for p in range(100)]}
    df = spark.createDataFrame([(e, p, v) for e, rows in series.items() for p, v in rows], "e string, p int, v double")

    def walked(allow):
        out = []
        for e, rows in series.items():
            run = []
            for p, v in sorted(rows):
                if run and (v != 0 or not allow and p != run[-1] + 1):
                    out.append((e, run[0], run[-1], len(run)))
                    run = []
                if v == 0:
                    run.append(p)
            if run:
                out.append((e, run[0], run[-1], len(run)))
        return sorted(out, key=str)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for ranges in (1, 3, 16):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            for allow in (False, True):
                assert sorted(map(tuple, G.zero_runs(df, "e", "p", "v", 0.0, allow).collect()), key=str) == walked(allow), (ranges, allow)
        pieces = G.run_pieces(df, "e", "p", F.col("v") == 0, True)
        per_range = [r["n"] for r in pieces.groupBy("__part").agg(F.sum("run_length").alias("n")).collect()]
        assert len(per_range) >= 12 and max(per_range) < df.count() / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert G.zero_runs(df.where("false"), "e", "p", "v").count() == 0


def test_pages_by_position(spark, tmp_path):
    """Pages by position and by the last key beside offset paging, ties and nulls included; a page's rows come from few files."""
    from panelkit.operators import coverage as C

    rng = random.Random(11)
    rows = [(rng.choice([None, "a", "b", "c"]), k, f"v{k}", "r1" if k % 3 else "r2") for k in range(1000)]
    df = spark.createDataFrame(rows, "country string, n int, v string, source_round string").repartition(5)
    order, path = ["country", "n"], str(tmp_path / "pages")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        C.write_positions(df, order, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    index, last = spark.read.parquet(path), None
    for page in range(0, 11):
        want = [r["v"] for r in C.browse_panel(df, order, page, 97).collect()]
        got = C.page_at(index, page, 97)
        assert [r["v"] for r in got.collect()] == want
        if want:
            assert got.select("position", F.input_file_name().alias("f")).select("f").distinct().count() <= 2
        if last is not None:
            assert [r["v"] for r in C.browse_panel(df, order, size=97, after=last).collect()] == want
        if want:
            n = int(want[-1][1:])
            last = (rows[n][0], n)
    assert "GreaterThan(position" in C.page_at(index, 10, 97)._jdf.queryExecution().executedPlan().toString()
    only = [r["v"] for r in C.browse_panel(df, order, size=20, after=("b", 500), source="r2").collect()]
    assert only == [v for _, _, v in sorted((c, n, v) for c, n, v, s in rows if c and s == "r2" and (c, n) > ("b", 500))[:20]]
