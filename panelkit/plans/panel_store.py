"""A large panel laid out in hash buckets of its reports, of which an update reads and rewrites only those it touches.

Layout: <folder>/rows/bucket=<n> holds the rows as Parquet, <folder>/layout one row with the number of buckets, which never
changes, <folder>/updates one row per finished update, written last.

An update writes whole buckets by dynamic partition overwrite. It replaces reports (or the rows of its own stamp), so an
update that broke off halfway is simply run again: buckets that were already replaced come out the same. One update at a
time; readers that must not see some buckets before and some after it read between updates.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from panelkit.plans.panel_build import PanelBuild, build_panel
from panelkit.schema import to_pregap, union_layout
from panelkit.session import discard, materialise
from panelkit.sources.sinks import children, exists, remove, size_of
from panelkit.streaming.incremental import append_run

BUCKET = "bucket"
#: Bytes of Parquet in a piece of a bucket, which an update sorts and writes as one file; in memory its rows take many times that.
PIECE_BYTES = 4 << 20


def bucket_of(report: str | Column, buckets: int) -> Column:
    """The bucket of a report; rows without one share a bucket."""
    return F.pmod(F.xxhash64(report), F.lit(buckets)).cast("int")


def create(panel: DataFrame, folder: str, buckets: int) -> None:
    """Lay out a panel; a folder that already holds one is an error. Choose about one bucket per 0.5 to 1 GB of Parquet.

    Every column but the bucket is kept as it is; a panel with a column of that name is an error.
    """
    if buckets < 1:
        raise ValueError("a panel needs at least one bucket")
    if BUCKET in panel.columns:
        raise ValueError(f"the panel has a column {BUCKET!r} of its own")
    spark = panel.sparkSession
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(panel.schema.json()).alias("columns")) \
        .write.mode("errorifexists").parquet(f"{folder}/layout")
    _write_buckets(panel, folder, buckets)


def layout(spark: SparkSession, folder: str) -> tuple[int, StructType]:
    """(number of buckets, schema of the rows)."""
    row = spark.read.parquet(f"{folder}/layout").first()
    return row["buckets"], StructType.fromJson(json.loads(row["columns"]))


def read(spark: SparkSession, folder: str, touched: list[int] | None = None) -> DataFrame:
    """The panel's rows, or those of some buckets only (a partition filter: other folders are not opened)."""
    schema = layout(spark, folder)[1]
    if not exists(spark, f"{folder}/rows"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema, StructField(BUCKET, IntegerType())])).parquet(f"{folder}/rows")
    return (rows if touched is None else rows.filter(F.col(BUCKET).isin(touched))).drop(BUCKET)


def read_reports(spark: SparkSession, folder: str, reports: list[str]) -> DataFrame:
    """The rows of a few named reports, from their buckets alone."""
    n = layout(spark, folder)[0]
    touched = spark.createDataFrame([(r,) for r in reports], "json_file string").select(bucket_of("json_file", n).alias("b")).distinct()
    return read(spark, folder, [r["b"] for r in touched.collect()]).filter(F.col("json_file").isin(reports))


def update(spark: SparkSession, folder: str, new_parts: list[DataFrame], dropped: DataFrame | None = None, replace: bool = True,
           stamp: str | None = None) -> PanelBuild:
    """`build_panel` over the buckets of the new and dropped reports; all others keep their files.

    Gap-fill rows of reports that are neither replaced nor dropped stay: taking a run back concerns the whole panel. The rows
    of a touched bucket get their `update_origin` anew; in an untouched one it tells of the update that wrote it. With a stamp
    the update is recorded, and refused once it is. Returns what build_panel says of the touched buckets, the rows read from
    the panel.
    """
    _refuse_known(spark, folder, stamp)
    buckets, schema = layout(spark, folder)
    # the new rows are read for their buckets, for reports on both sides and as rows: they are made once
    new, dropped = materialise(union_layout(new_parts), "zstd"), materialise(dropped.select("json_file").distinct()) if dropped is not None else None
    touched = _touched([new, *([dropped] if dropped is not None else [])], buckets)
    old = read(spark, folder, touched)
    built = build_panel(old, [new], dropped, remove_gapfill=False, replace=replace)
    # found before the panel changes: afterwards every new report is in it
    built.duplicates = materialise(built.duplicates)
    there = sum(size_of(spark, f"{folder}/rows/{BUCKET}={b}") for b in touched) + size_of(spark, new.table_path)
    pieces = max(1, -(-there // (PIECE_BYTES * max(1, len(touched)))))
    before = {b: _files(spark, folder, b) for b in touched}
    # the rows come from the very folders that are replaced: an overwrite by partition leaves them alone until all tasks are done
    _write_buckets(_merged(old, new, dropped, replace, buckets, pieces).select(*[F.col(f.name).cast(f.dataType) for f in schema], BUCKET), folder, buckets)
    for b in touched:
        if _files(spark, folder, b) == before[b]:       # not written anew: no row is left of it
            remove(spark, f"{folder}/rows/{BUCKET}={b}")
    spark.catalog.refreshByPath(f"{folder}/rows")
    _record(spark, folder, stamp, touched)
    built.rows = read(spark, folder, touched)
    return built


def _merged(old: DataFrame, new: DataFrame, dropped: DataFrame | None, replace: bool, buckets: int, pieces: int) -> DataFrame:
    """The rows of `build_panel` with their bucket. Rows move once, to a piece of their bucket, where those of both sides and the dropped
    reports meet; so the pieces are written as they are, while joins would leave rows of every bucket in every task."""
    rows = union_layout([to_pregap(old).withColumn("update_origin", F.lit("previous")), union_layout([new]).withColumn("update_origin", F.lit("new"))])
    if dropped is not None:
        rows = rows.unionByName(dropped.select("json_file", F.lit("dropped").alias("update_origin")), allowMissingColumns=True)
    rows = rows.withColumns({BUCKET: bucket_of("json_file", buckets), "__piece": F.pmod(F.hash("json_file"), F.lit(pieces))}).repartition(BUCKET, "__piece")
    report, side = Window.partitionBy(BUCKET, "__piece", "json_file"), F.col("update_origin")
    loser, winner = ("previous", "new") if replace else ("new", "previous")
    flags = {"__gone": F.max(side == "dropped").over(report), "__won": F.max(side == winner).over(report)}
    # rows without a report are on no list
    stays = F.col("json_file").isNull() | ~(F.col("__gone") | (F.col("__won") & (side == loser)))
    return rows.withColumns(flags).filter((side != "dropped") & stays).drop("__piece", *flags)


def append(spark: SparkSession, folder: str, new_rows: DataFrame, stamp: str) -> list[int]:
    """Append a gap-fill run to the buckets of its reports and record its stamp; a recorded stamp is refused.

    Rows with this stamp in the touched buckets are left from a run that broke off, and go. Returns the touched buckets.
    """
    _refuse_known(spark, folder, stamp)
    buckets, schema = layout(spark, folder)
    if "gapfill_run" not in schema.names:
        raise ValueError("the panel has no gapfill_run column to tell runs by")
    touched = _touched([new_rows], buckets)
    old = read(spark, folder, touched).filter(~F.col("gapfill_run").eqNullSafe(F.lit(stamp)))
    _replace(spark, folder, append_run(old, new_rows, stamp).select(schema.names), touched, buckets)
    _record(spark, folder, stamp, touched)
    return touched


def updates(spark: SparkSession, folder: str) -> DataFrame:
    """Finished updates: stamp, touched buckets, time."""
    if not exists(spark, f"{folder}/updates"):
        return spark.createDataFrame([], "stamp string, touched array<int>, created timestamp")
    return spark.read.parquet(f"{folder}/updates")


def _files(spark: SparkSession, folder: str, bucket: int) -> set[str]:
    """The files of a bucket; every write names its own."""
    return set(children(spark, f"{folder}/rows/{BUCKET}={bucket}/*"))


def _touched(rows: list[DataFrame], buckets: int) -> list[int]:
    """Buckets of the rows' reports: at most the panel's number of buckets, whatever the number of rows."""
    found = [r.select(bucket_of("json_file", buckets).alias("b")).distinct() for r in rows]
    return sorted({r["b"] for f in found for r in f.collect()})


def _write_buckets(rows: DataFrame, folder: str, buckets: int) -> None:
    """Replace the buckets that occur in `rows`. Rebalancing gives a bucket few files and cuts one that holds a large share; rows that
    come with their bucket lie by it already."""
    keyed = rows if BUCKET in rows.columns else rows.withColumn(BUCKET, bucket_of("json_file", buckets)).hint("rebalance", BUCKET)
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(f"{folder}/rows"))


def _replace(spark: SparkSession, folder: str, rows: DataFrame, touched: list[int], buckets: int) -> None:
    """Write the touched buckets; those that no row is left of are deleted, as an overwrite leaves them alone."""
    # written apart first: the rows come from the very folders that are replaced, and a lost task must not read replaced ones
    ready = materialise(rows, "zstd")
    _write_buckets(ready, folder, buckets)
    left = {r["b"] for r in ready.select(bucket_of("json_file", buckets).alias("b")).distinct().collect()}
    for b in set(touched) - left:
        remove(spark, f"{folder}/rows/{BUCKET}={b}")
    discard(ready)
    spark.catalog.refreshByPath(f"{folder}/rows")


def _refuse_known(spark: SparkSession, folder: str, stamp: str | None) -> None:
    if stamp is not None and updates(spark, folder).filter(F.col("stamp") == stamp).limit(1).count():
        raise ValueError(f"update {stamp} is already in the panel")


def _record(spark: SparkSession, folder: str, stamp: str | None, touched: list[int]) -> None:
    if stamp is not None:
        row = spark.createDataFrame([(stamp, touched)], "stamp string, touched array<int>")
        row.coalesce(1).withColumn("created", F.current_timestamp()).write.mode("append").parquet(f"{folder}/updates")
