"""Distributions by group, weights, trimming, tails, contribution shares."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.headers import label_category
from panelkit.functions.names import loose_key, normalize_entity
from panelkit.operators import pick
from panelkit.operators.quantiles import exact_quantiles

QUANTILES = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def classify(names: DataFrame, codes: DataFrame, groups: DataFrame, name: str = "country") -> DataFrame:
    """name -> code (by loose key, else by the normalised name's) -> group columns.

    codes: (name, code); groups: (code, ...). Sizes decide how the lookups are joined.
    """
    c = pick.smallest(codes.filter("code is not null").select(loose_key("name").alias("__k"), F.col("code").cast("int").alias("code")),
                      ["__k"], [F.col("code")])
    g = groups.filter("code is not null").withColumn("code", F.col("code").cast("int"))
    g = pick.smallest(g, ["code"], [F.col(x) for x in g.columns if x != "code"])
    n = names.select(name).filter(F.col(name).isNotNull()).distinct()
    n = n.withColumn("__k", loose_key(name)).withColumn("__n", loose_key(normalize_entity(name)))
    direct = c.withColumnRenamed("code", "__c1")
    normal = c.select(F.col("__k").alias("__n"), F.col("code").alias("__c2"))
    return (n.join(direct, "__k", "left").join(normal, "__n", "left")
            .withColumn("code", F.coalesce("__c1", "__c2")).drop("__k", "__n", "__c1", "__c2").join(g, "code", "left"))


def classification_issues(classified: DataFrame, group: str, name: str = "country") -> DataFrame:
    """Entities without a code, or whose code has no group."""
    return classified.filter(F.col("code").isNull() | F.col(group).isNull()).select(
        name, "code", F.when(F.col("code").isNull(), "name not in the code list").otherwise(f"code has no {group}").alias("problem"))


def membership(names: DataFrame, members: DataFrame, default: str, name: str = "iso3") -> DataFrame:
    """Group of an entity from membership lists (name, grp), with a default group."""
    return names.join(members, name, "left").withColumn("grp", F.coalesce("grp", F.lit(default)))


def trim_bounds(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """One row: the two pooled quantiles."""
    return exact_quantiles(df, [], value, {"lo": low, "hi": high})


def trim(df: DataFrame, value: str, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) rows: inside and outside the pooled quantile bounds. NULL values are in neither."""
    b = trim_bounds(df, value, low, high)
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    inside = F.col(value).between(lo, hi)
    return df.filter(inside), df.filter(~inside)


def group_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, mean, median, sd (n - 1), percentiles, extremes and shares of zero / positive / negative per group; NULL is a group."""
    v = F.col(value)
    base = df.filter(v.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg((v == 0).cast("int")).alias("share_zero"), F.avg((v > 0).cast("int")).alias("share_positive"),
        F.avg((v < 0).cast("int")).alias("share_negative"))
    # NULL groups meet too; a group of NaN alone has no quantile
    q = exact_quantiles(df, by, value, QUANTILES).withColumnsRenamed({c: f"__{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return base.join(q, same, "left").select(*base.columns, *QUANTILES)


def by_period_wide(stats: DataFrame, period: str, group: str, groups: list[str], measure: str) -> DataFrame:
    """period x group table of one statistic."""
    return stats.groupBy(period).pivot(group, groups).agg(F.first(measure))


def weighted_mean(df: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean over rows that have both numbers."""
    ok = df.filter(F.col(value).isNotNull() & F.col(weight).isNotNull())
    return ok.groupBy(*by).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("weighted_mean"), F.count("*").alias("n"))


def weight_shares(df: DataFrame, group: str, entity: str, weight: str, top: int = 4) -> DataFrame:
    """The entities with the largest share of their group's weight (a top-k report)."""
    from pyspark.sql import Window
    per = df.filter(F.col(weight).isNotNull()).groupBy(group, entity).agg(F.sum(weight).alias("w"))
    total = per.groupBy(group).agg(F.sum("w").alias("t"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("w"), entity))
    lead = per.withColumn("rank", rank).filter(F.col("rank") <= top)
    return lead.join(total, group).select(group, entity, "rank", F.try_divide("w", "t").alias("share"))


def carry_forward(series: DataFrame, key: str, year: str, upto: int) -> DataFrame:
    """Rows of the last year of the whole series repeated for every later year up to `upto`."""
    last = series.agg(F.max(year).alias("y")).scalar()
    ext = (series.withColumn("__last", last).filter(F.col(year) == F.col("__last"))
           .withColumn(year, F.explode(F.when(F.col("__last") < upto, F.sequence(F.col("__last") + 1, F.lit(upto).cast("int")))))
           .drop("__last"))
    return series.unionByName(ext.select(*series.columns))


def volatility(series: DataFrame, by: list[str], value: str) -> DataFrame:
    """Standard deviation and mean over the periods of a series."""
    return series.groupBy(*by).agg(F.stddev_samp(value).alias("sd"), F.avg(value).alias("mean"))


# ---- tail -----------------------------------------------------------------------------------------------

def tail(df: DataFrame, value: str, p: float = 0.95) -> DataFrame:
    """Rows at or above the pooled p-quantile."""
    t = exact_quantiles(df, [], value, {"q": p}).select("q").scalar()
    return df.filter(F.col(value) >= t)


def companions(rows: DataFrame, keys: list[str], ids: dict[str, str], order: str | Column) -> DataFrame:
    """Values of other line items of the same report and year, one column each (first value in `order`)."""
    return rows.filter(F.col("hierarchy_id").isin(list(ids))).groupBy(*keys).agg(*[
        F.min_by("value_num", F.when(F.col("hierarchy_id") == h, order if isinstance(order, Column) else F.col(order))).alias(n)
        for h, n in ids.items()])


def largest_subitem(rows: DataFrame, keys: list[str], parent: str) -> DataFrame:
    """Direct child of `parent` with the largest absolute value per report and year (smallest id wins ties)."""
    sub = rows.filter(F.col("hierarchy_id").rlike(rf"^{parent}\.\d+$"))
    return sub.groupBy(*keys).agg(F.min_by(F.struct(F.col("label_verbatim").alias("largest_subitem"), F.col("value_num").alias("subitem_value")),
                                           F.struct(-F.abs("value_num"), F.col("hierarchy_id"))).alias("s")).select(*keys, "s.*")


def over_representation(sample: DataFrame, part: DataFrame, group: str) -> DataFrame:
    """Share of each group in a part of the sample against its share in the whole sample."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        c = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
        return c.select(group, F.try_divide("n", c.agg(F.sum("n").alias("t")).scalar()).alias(name))
    return shares(sample, "share_sample").join(shares(part, "share_part"), group, "left").select(
        group, F.coalesce("share_part", F.lit(0.0)).alias("share_part"), "share_sample",
        F.try_divide(F.coalesce("share_part", F.lit(0.0)), "share_sample").alias("ratio"))


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of row x column for an explicit list of column values."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


# ---- contributions ----------------------------------------------------------------------------------------

def report_contributions(rows: DataFrame, report: list[str], total_id: str, named: list[str], rules=None,
                         order: str | Column = "hierarchy_id") -> DataFrame:
    """Per report: the total, each named category's sum, and Other = total - named. Reports without a total are left out.

    One aggregate for all of it: the total and the sums are conditional.
    """
    rows = rows.filter(F.col("hierarchy_id").rlike(rf"^{total_id}(\.\d+)?$"))
    is_total = F.col("hierarchy_id") == total_id
    cat = label_category("label_verbatim", rules)
    total = F.min_by("value_num", F.when(is_total, order if isinstance(order, Column) else F.col(order)))
    g = rows.groupBy(*report).agg(total.alias("total"), *[
        F.coalesce(F.sum(F.when(~is_total & (cat == n), F.col("value_num"))), F.lit(0.0)).alias(n) for n in named])
    other = F.col("total")
    for n in named:
        other = other - F.col(f"`{n}`")
    return g.filter("total is not null").withColumn("Other", other)


def average_reports(reports: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Mean over the reports of one entity and year, and how many there were."""
    return reports.groupBy(*keys).agg(*[F.avg(f"`{c}`").alias(c) for c in columns], F.count("*").alias("n_reports"))


def contribution_shares(cy: DataFrame, group: str, items: list[str], entity: str, all_name: str = "All") -> DataFrame:
    """Gross share, gross sum, net mean and non-zero count of every item: for all rows and for each group.

    Grouping sets give both levels in one pass; the grand total holds unclassified entities as well. Entities are
    reduced to one row per entity and group first, so that the distinct count needs no expansion.
    """
    q = [f"`{i}`" for i in items]
    per = cy.groupBy(entity, group).agg(
        F.count("*").alias("__n"), *[F.sum(F.abs(F.col(c))).alias(f"g{k}") for k, c in enumerate(q)],
        *[F.sum(c).alias(f"s{k}") for k, c in enumerate(q)], *[F.count_if(F.abs(F.col(c)) > 1e-9).alias(f"z{k}") for k, c in enumerate(q)])
    r = per.rollup(group).agg(
        F.grouping(group).alias("__t"), F.count("*").alias("n_entities"), F.sum("__n").alias("n_entity_periods"),
        *[F.sum(f"g{k}").alias(f"g{k}") for k in range(len(q))], *[F.sum(f"s{k}").alias(f"s{k}") for k in range(len(q))],
        *[F.sum(f"z{k}").alias(f"z{k}") for k in range(len(q))])
    gross = F.lit(0.0)
    for k in range(len(q)):
        gross = gross + F.col(f"g{k}")
    return r.filter((F.col("__t") == 1) | F.col(group).isNotNull()).select(
        F.when(F.col("__t") == 1, all_name).otherwise(F.col(group)).alias("group"), "n_entities", "n_entity_periods",
        *[F.try_divide(f"g{k}", gross).alias(f"share_{i}") for k, i in enumerate(items)],
        *[F.col(f"g{k}").alias(f"gross_{i}") for k, i in enumerate(items)],
        *[F.try_divide(f"s{k}", "n_entity_periods").alias(f"net_mean_{i}") for k, i in enumerate(items)],
        *[F.col(f"z{k}").alias(f"n_nonzero_{i}") for k, i in enumerate(items)])


def balance_error(cy: DataFrame, total: str, items: list[str]) -> DataFrame:
    """Largest absolute difference between the total and the sum of its items."""
    s = F.lit(0.0)
    for i in items:
        s = s + F.col(f"`{i}`")
    return cy.agg(F.max(F.abs(s - F.col(total))).alias("max_error"))


def label_check(rows: DataFrame, category: str, label: str, group: str, groups: list[str], value: str = "value_num") -> DataFrame:
    """Per category and label: rows, non-zero rows and gross sum of every group, and the gross total."""
    g = F.coalesce(group, F.lit("unclassified"))
    names = [*groups, "unclassified"]
    aggs = []
    for n in names:
        mine = g == n
        aggs += [F.count_if(mine).alias(f"n_rows_{n}"), F.count_if(mine & (F.col(value) != 0)).alias(f"n_nonzero_{n}"),
                 F.coalesce(F.sum(F.when(mine, F.abs(value))), F.lit(0.0)).alias(f"gross_{n}")]
    return rows.groupBy(category, label).agg(*aggs, F.sum(F.abs(value)).alias("gross_total"))
