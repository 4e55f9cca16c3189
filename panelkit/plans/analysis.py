"""Analyses over the finished panel: one value per country-year, groups, streaks, contributions, tails."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.functions.headers import FLOW_RULES, driver_category
from panelkit.functions.names import entity_key
from panelkit.operators import coverage as C, gaps as G, pick, stats as S


def country_year_panel(rows: DataFrame, item: str, ties: list[Column], years: tuple[int, int] | None = None, keep: list[str] = ()) -> DataFrame:
    """One value per entity and year of one line item: best source first, then `ties` (smallest wins)."""
    v = C.load_values(rows, [item], keep).withColumn("country_key", entity_key("country"))
    best = pick.by_priority(v, ["country_key", "effective_year"], "source_round", C.PRIORITY, ties)
    # one row per year is left of every entity, so its years fit one row; the label is the most common one among them
    row = F.struct(F.col("effective_year").alias("year"), F.col("value_num").alias("value"), "source_round", F.col("country_label").alias("l"))
    per = best.groupBy("country_key").agg(F.collect_list(row).alias("ys"))
    counted = F.transform(F.array_distinct("ys.l"), lambda l: F.named_struct(
        F.lit("n"), -F.size(F.filter("ys.l", lambda x: x == l)), F.lit("l"), l))
    out = per.select("country_key", F.array_min(counted)["l"].alias("country"), F.explode("ys").alias("y")) \
        .select("country", "country_key", "y.year", "y.value", "y.source_round")
    return out.filter(F.col("year").between(*years)) if years else out


def with_groups(panel: DataFrame, codes: DataFrame, groups: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """(panel with code and group columns, entities that could not be classified)."""
    cls = S.classify(panel, codes, groups)
    return panel.join(cls, "country", "left"), S.classification_issues(cls, group)


@dataclass
class StreakReport:
    table: DataFrame
    runs: DataFrame
    by_group: DataFrame


def zero_streak_report(panel: DataFrame, info: DataFrame, group: str, order: list[str], min_run: int, **options) -> StreakReport:
    """Entities with long runs of zeros: table, the runs, and counts per group with a total."""
    table = G.streak_table(panel, "country", "year", "value", min_run, **options).join(info, "country", "left")
    runs = G.zero_runs(panel, "country", "year", "value", **options).filter(F.col("run_length") >= min_run).join(info, "country", "left")
    return StreakReport(table, runs, G.listed_by_group(table, group, order))


@dataclass
class Contributions:
    reports: DataFrame
    country_years: DataFrame
    shares: DataFrame
    balance: DataFrame


def contributions(rows: DataFrame, total_id: str, groups: DataFrame, group: str, rules=None, named: list[str] | None = None,
                  years: tuple[int, int] | None = None, order: str = "hierarchy_id") -> Contributions:
    """Sub-items by label category: per report, averaged per country-year, shares for all and for each group.

    groups: (country_key, <group>).
    """
    named = named or [n for n, _ in (rules or FLOW_RULES)]
    items = [*named, "Other"]
    v = C.load_values(rows, None, ["json_file", "label_verbatim", *([order] if order != "hierarchy_id" else [])])
    v = v.withColumn("country_key", entity_key("country")).withColumnRenamed("effective_year", "year")
    if years:
        v = v.filter(F.col("year").between(*years))
    rep = S.report_contributions(v, ["country_key", "json_file", "source_round", "year"], total_id, named, rules, order)
    cy = S.average_reports(rep, ["country_key", "year"], ["total", *items]).join(groups, "country_key", "left")
    return Contributions(rep, cy, S.contribution_shares(cy, group, items, "country_key"), S.balance_error(cy, "total", items))


@dataclass
class StylizedFacts:
    simple: DataFrame
    weighted: DataFrame
    simple_trimmed: DataFrame
    weighted_trimmed: DataFrame
    dropped: DataFrame


def stylized_facts(panel: DataFrame, value: str, weight: str, group: str, low: float = 0.01, high: float = 0.99) -> StylizedFacts:
    """Mean, median and weighted mean per year and group, for all values and without the pooled tails."""
    kept, dropped = S.trim(panel.filter(F.col(value).isNotNull()), value, low, high)
    by = ["year", group]
    return StylizedFacts(S.group_stats(panel, by, value), S.weighted_mean(panel, by, value, weight),
                         S.group_stats(kept, by, value), S.weighted_mean(kept, by, value, weight), dropped)


def tail_anatomy(panel: DataFrame, rows: DataFrame, value: str, parent: str, companions: dict[str, str], order, p: float = 0.95) -> DataFrame:
    """Rows in the top tail with companions of the same report, the largest sub-item, its driver and the share of change.

    panel: (country_key, year, json_file, <value>); rows: loaded values with json_file, label_verbatim.
    """
    keys = ["json_file", "year"]
    r = rows.withColumnRenamed("effective_year", "year") if "effective_year" in rows.columns else rows
    top = S.tail(panel, value, p)
    out = top.join(S.companions(r, keys, companions, order), keys, "left").join(S.largest_subitem(r, keys, parent), keys, "left")
    change = next(iter(companions.values()))
    return out.withColumn("driver", driver_category("largest_subitem")).withColumn("share_of_change", F.try_divide(value, change))
