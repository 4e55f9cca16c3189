"""Many counts of a table in one pass: one aggregate over grouping sets, of which all measures are made."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A measure of a grouping set's rows: (name, item it is counted by or None, what a row of the set adds to it).
Measure = tuple[str, Column | None, Column]


def set_counts(df: DataFrame, sets: dict[tuple[str, ...], list[Measure]], aggregates: dict[str, Column] | None = None) -> DataFrame:
    """(measure, item, n) of all measures of all sets, from one scan and one exchange of its partial results.

    Every set is grouped by its columns; a row of it holds `n` (its number of rows) and the `aggregates`, and adds to each of
    the set's measures: 1 counts distinct keys, `n` counts rows. The set without columns holds the table's own totals.
    A measure without an item is there, with 0, for an empty table too; a row that adds null adds nothing.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    if len({frozenset(s) for s in sets}) < len(sets):
        raise ValueError("two grouping sets hold the same columns")
    own = {"n": F.count("*"), **(aggregates or {})}
    names = {c: f"__k{i}" for i, c in enumerate(columns)}
    # the grouped columns go by names of their own, so that an aggregate may read a column that some set groups by
    keyed = df.select("*", *[F.col(c).alias(k) for c, k in names.items()])
    if columns:
        grouped = keyed.groupingSets([[F.col(names[c]) for c in s] for s in sets], *[F.col(k) for k in names.values()]) \
            .agg(F.grouping_id().alias("__set"), *[a.alias(n) for n, a in own.items()])
    else:
        grouped = keyed.agg(F.lit(0).cast("long").alias("__set"), *[a.alias(n) for n, a in own.items()])
    out, zero = F.lit(None).cast("array<struct<measure:string,item:string,n:bigint>>"), []
    for s, measures in sets.items():
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        adds = F.array(*[F.struct(F.lit(m).alias("measure"), (F.lit(None) if item is None else item).cast("string").alias("item"), n.cast("long").alias("n"))
                         for m, item, n in measures])
        out = F.when(F.col("__set") == number, adds).otherwise(out)
        zero += [(m, None, 0) for m, item, _ in measures if item is None]
    rows = grouped.select(*[F.col(k).alias(c) for c, k in names.items()], "__set", *own).select(F.inline(out)).filter("n is not null")
    if zero:
        rows = rows.unionByName(df.sparkSession.createDataFrame(zero, "measure string, item string, n bigint"))
    return rows.groupBy("measure", "item").agg(F.sum("n").alias("n"))
