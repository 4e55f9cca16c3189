"""Work that has to stay balanced when one key holds a large share of the rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialise

#: Session setting: tasks over which `dealt` deals the rows of a scan. Unset: the files' own splits.
SCAN_TASKS = "panelkit.scan.tasks"


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly over as many tasks as the session names, for files that can't be split as finely as the
    work on their rows needs; unchanged where it names none."""
    tasks = df.sparkSession.conf.get(SCAN_TASKS, None)
    return df.repartition(int(tasks)) if tasks else df


def split_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join whose hot keys adaptive execution can split, whatever the inputs were computed from.

    A side that was just aggregated on the join key arrives already partitioned by it, and then the planner adds
    no exchange that could be split at run time: all rows of a hot key would meet in one task. Joining on the key
    and its hash asks for a fresh exchange of both sides; a partition that turns out too large is cut by its map
    outputs and the matching part of `small` is read by every piece. Nothing is computed twice and nothing is
    replicated unless a key really is hot. `small` holds few rows per key. The hash comes first, so that sorts compare
    numbers, not keys that begin alike.
    """
    key = F.xxhash64(*[F.col(c) for c in on])
    return big.withColumn("__h", key).join(small.withColumn("__h", key), ["__h", *on], how).drop("__h")


def number_rows(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Exact 1, 2, 3, ... over the whole table in the given order, without one task seeing all rows.

    Rows are range-partitioned by the order columns, sorted and numbered inside their partition; the partition
    offsets come from one row per partition. The numbered rows are materialised once, because range
    boundaries are sampled and must not differ between the two uses.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    # the id grows by one along a partition's rows; its upper bits are the partition
    place = F.monotonically_increasing_id()
    parts = materialise(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__place", place))
    part = F.shiftright("__place", 33)
    parts = parts.withColumns({"__part": part, "__in": F.col("__place") - F.shiftleft(part, 33) + 1}).drop("__place")
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))      # one row per partition
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (parts.join(F.broadcast(before), "__part")
            .withColumn(name, F.col("__before") + F.col("__in"))
            .drop("__part", "__in", "__before"))


def number_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """row_number() per key for keys of any size: global position minus the position the key starts at."""
    rows = number_rows(df, [*[F.col(k) for k in keys], *order], "__pos")
    start = rows.groupBy(*keys).agg(F.min("__pos").alias("__start"))
    return (split_join(rows, start, keys).withColumn(name, (F.col("__pos") - F.col("__start") + 1).cast("long"))
            .drop("__pos", "__start"))


def running_sum(df: DataFrame, key: str, position: str, value: str, name: str, block: int = 1000) -> DataFrame:
    """Running sum of `value` per key along an integer position, in blocks.

    Block totals are summed first (one row per block), so no task walks a whole key row by row.
    """
    rows = df.withColumn("__block", F.floor(F.col(position) / block))
    totals = rows.groupBy(key, "__block").agg(F.sum(value).alias("__total"))
    before = totals.select(key, "__block", (F.sum("__total").over(
        Window.partitionBy(key).orderBy("__block")) - F.col("__total")).alias("__before"))
    inside = F.sum(value).over(Window.partitionBy(key, "__block").orderBy(position))
    return (rows.withColumn("__in", inside).join(before, [key, "__block"])
            .withColumn(name, F.col("__before") + F.col("__in")).drop("__block", "__in", "__before"))


def running_totals(df: DataFrame, order: list[str | Column], sums: list[str]) -> DataFrame:
    """Each of the columns `sums` as its running total over the whole table in the given order.

    As in `number_rows`, no task sees more than its range of the order: totals run inside a range partition, and what lies
    before it comes from one row per partition.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = materialise(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__place", F.monotonically_increasing_id()))
    parts = parts.withColumn("__part", F.shiftright("__place", 33))
    whole = parts.groupBy("__part").agg(*[F.sum(c).alias(c) for c in sums])        # one row per partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select("__part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums])
    inside = Window.partitionBy("__part").orderBy("__place")
    return (parts.withColumns({c: F.sum(c).over(inside) for c in sums}).join(F.broadcast(before), "__part")
            .withColumns({c: F.col(c) + F.col(f"__before_{c}") for c in sums})
            .drop("__part", "__place", *[f"__before_{c}" for c in sums]))
