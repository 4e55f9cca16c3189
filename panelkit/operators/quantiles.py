"""Exact interpolated quantiles for groups of any size.

The built-in exact `percentile` keeps every distinct value of a group in one task's memory. Here the values
are counted into ordered cells first: the cell of a value is a fixed monotone function of the value, so no
sampling and no second look at the data is needed to agree on it. The cell counts (a few thousand per group)
tell in which cell each wanted position lies; those cells are counted again by 65,536 narrower ones, and only the
narrow cells that hold a wanted position are then sorted.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialise

CELLS_PER_E = 64      # cells per factor e; each cell spans about 1.6 % of a value
NARROWER = 1 << 16    # narrow cells per cell


def value_cell(v: Column, narrower: int = 1) -> Column:
    """Monotone integer cell of a number; zero and both infinities have their own cells."""
    size = F.floor(F.log(F.abs(v)) * (CELLS_PER_E * narrower)) + 100_000 * narrower
    size = F.when(F.abs(v) == float("inf"), F.lit(200_000 * narrower)).otherwise(size)
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("long")


def _places(name: str, h: Column) -> Column:
    return F.transform(F.array(F.floor(h), F.ceil(h)), lambda k: F.struct(F.lit(name).alias("q"), h.alias("h"), k.alias("__k")))


def _wanted(cells: DataFrame, key: list[str], cell: str) -> DataFrame:
    """Per cell that holds a wanted place: __before (values below it) and __want (its places). cells: key, cell, __c (values
    in it), __from (values below the key's first cell), __want (places sought under the key)."""
    along = Window.partitionBy(*key).orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("__from") + F.sum("__c").over(along)
    held = cells.withColumn("__upto", upto).withColumn("__before", F.col("__upto") - F.col("__c"))
    held = held.withColumn("__want", F.filter("__want", lambda w: (w["__k"] >= F.col("__before")) & (w["__k"] < F.col("__upto"))))
    return held.filter(F.size("__want") > 0).select(*key, cell, "__before", "__want")


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """by + one column per name in `probs`: quantile with linear interpolation between neighbours.

    NULL and NaN are ignored; infinite values lie at the ends. A group without a value is not in the result.
    """
    v = F.col(value).cast("double")
    keys = [F.struct(F.col(c)).alias(c) for c in by] or [F.struct(F.lit(0)).alias("__all")]      # a struct joins NULL groups too
    key = by or ["__all"]
    base = df.select(*keys, (v + F.lit(0.0)).alias("__v")).filter("__v is not null and not isnan(__v)")
    # written once: three steps read the counts, whatever they were computed from
    counted = materialise(base.groupBy(*key, "__v").agg(F.count("*").alias("__n")).withColumn("__cell", value_cell(F.col("__v"))))

    cells = counted.groupBy(*key, "__cell").agg(F.sum("__n").alias("__c")).withColumn("__total", F.sum("__c").over(Window.partitionBy(*key)))
    # the two neighbouring order statistics of every quantile, each in exactly one cell
    places = F.flatten(F.array(*[_places(n, F.lit(float(p)) * (F.col("__total") - 1)) for n, p in probs.items()]))
    wide = _wanted(cells.withColumn("__from", F.lit(0)).withColumn("__want", places), key, "__cell")
    within = counted.join(wide, [*key, "__cell"]).withColumn("__narrow", value_cell(F.col("__v"), NARROWER))
    # all wanted positions of one cell in one row, so the cell's values are not repeated
    cells = within.groupBy(*key, "__cell", "__narrow").agg(F.sum("__n").alias("__c"), F.first("__before").alias("__from"), F.first("__want").alias("__want"))
    narrow = _wanted(cells, [*key, "__cell"], "__narrow")
    in_cell = Window.partitionBy(*key, "__cell", "__narrow").orderBy("__v")
    hits = (within.select(*key, "__cell", "__narrow", "__v", "__n").join(narrow, [*key, "__cell", "__narrow"])
            .withColumn("__hi", F.col("__before") + F.sum("__n").over(in_cell))
            .withColumn("__lo", F.col("__hi") - F.col("__n"))
            .withColumn("__w", F.explode(F.filter("__want", lambda w: (w["__k"] >= F.col("__lo")) & (w["__k"] < F.col("__hi"))))))
    out = []
    for name in probs:
        mine = F.col("__w.q") == name
        low = F.max(F.when(mine & (F.col("__w.__k") == F.floor("__w.h")), F.col("__v")))
        high = F.max(F.when(mine & (F.col("__w.__k") == F.ceil("__w.h")), F.col("__v")))
        part = F.max(F.when(mine, F.col("__w.h") - F.floor("__w.h")))
        # equal neighbours need no interpolation, which infinite ones do not allow
        out.append(F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part).alias(name))
    return hits.groupBy(*key).agg(*out).select(*[F.col(c)[c].alias(c) for c in by], *probs)
