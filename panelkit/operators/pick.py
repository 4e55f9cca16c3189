"""Keep one row per key.

Every pick is an aggregate (max_by / min_by over a struct), not a window: partial aggregation on the map
side leaves at most one row per key and task before the shuffle, so a key that holds a third of all rows
costs no more than any other.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _best(df: DataFrame, keys: list[str], order: list[Column], fn) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(fn(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def largest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the largest `order` per key (NULL is smallest)."""
    return _best(df, keys, order, F.max_by)


def smallest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the smallest `order` per key (NULL is smallest)."""
    return _best(df, keys, order, F.min_by)


def priority_rank(source: str | Column, priority: list[str]) -> Column:
    """Position in the priority list, unknown values last."""
    source = F.col(source) if isinstance(source, str) else source
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), source)
    return F.when(rank > 0, rank - 1).otherwise(F.lit(len(priority))).cast("int")


def by_priority(df: DataFrame, keys: list[str], source: str, priority: list[str], ties: list[Column]) -> DataFrame:
    """Source priority pick; `ties` (smallest wins) settle rows of the same source."""
    return smallest(df, keys, [priority_rank(source, priority), *ties])


def source_tag(source: str, run: str) -> Column:
    """Source with the gap-fill run split out: gapfill:<run>."""
    return F.when((F.col(source) == "gapfill") & (F.coalesce(F.col(run), F.lit("")) != ""),
                  F.concat(F.lit("gapfill:"), F.col(run))).otherwise(F.col(source))


def source_by_run(df: DataFrame, keys: list[str], source: str = "source_round", run: str = "gapfill_run",
                  priority: list[str] = ("round1", "round2", "round3", "gapfill")) -> DataFrame:
    """(keys, source_tag): best source per key, gap-fill runs in order of their name (oldest first)."""
    tagged = df.select(*keys, source, source_tag(source, run).alias("source_tag"))
    rank = priority_rank(source, list(priority))
    known = F.when(rank < len(priority), F.struct(rank, F.col("source_tag")))
    return tagged.groupBy(*keys).agg(
        F.coalesce(F.min_by("source_tag", known), F.lit("unknown")).alias("source_tag"))


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent value per key; ties go to the smallest value."""
    return (value_counts(df, keys, value).groupBy(*keys)
            .agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(name or value)))


def most_common_n(df: DataFrame, keys: list[str], value: str, n: int, name: str, separator: str = " | ") -> DataFrame:
    """The n most frequent values per key, joined in rank order (a top-n report).

    collect_top_n keeps n values per task, so no group is gathered whole.
    """
    counts = value_counts(df, keys, value)
    ranked = F.struct((-F.col("n")).alias("o"), F.col(value).alias("v"))
    top = F.slice(F.array_sort(F.flatten(F.collect_list("part"))), 1, n)
    # first level: split every key's values over 64 cells and keep n of each cell; second level: merge the cells
    cells = (counts.select(*keys, ranked.alias("r"), F.pmod(F.xxhash64(value), F.lit(64)).alias("cell")))
    per_cell = top_n_by_cell(cells, [*keys, "cell"], "r", n)
    return per_cell.groupBy(*keys).agg(F.array_join(F.transform(top, lambda s: s["v"]), separator).alias(name))


def top_n_by_cell(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """(keys, part): the n smallest `order` structs of every cell, as an array of at most n entries.

    Ranking with a limit is cut to n rows per key in every task before the shuffle (window group limit).
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(order)
    return (df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
            .groupBy(*keys).agg(F.collect_list(order).alias("part")))


def majority(df: DataFrame, keys: list[str], value: str, position: str, name: str = "majority") -> DataFrame:
    """Most frequent non-null value per key; of equally frequent ones the first to reach that count."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count("*").alias("n"), F.max(position).alias("reached")))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col("reached"))).alias(name))


def majority_of(values: list[Column]) -> Column:
    """The same rule over a fixed list of columns of one row (the runs of one line item)."""
    arr = F.array(*values)
    # count of each position's value, and where that value occurs last
    scored = F.transform(arr, lambda v: F.struct(
        (-F.size(F.filter(arr, lambda o: o == v))).alias("n"),
        F.aggregate(F.sequence(F.lit(1), F.lit(len(values))), F.lit(0),
                    lambda acc, i: F.when(F.element_at(arr, i) == v, i).otherwise(acc)).alias("reached"),
        v.alias("v")))
    return F.get(F.array_sort(F.filter(scored, lambda s: s["v"].isNotNull())), F.lit(0))["v"]


def per_key_duplicates(df: DataFrame, keys: list[str], value: str, tolerance: float = 0.05) -> DataFrame:
    """Keys with several rows: row count, smallest and largest value, conflict flag."""
    return (df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))
            .filter("n_rows > 1")
            .withColumn("conflicting", (F.col("max_value") - F.col("min_value")) > tolerance))
