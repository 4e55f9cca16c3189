"""Steps that are run again and again on growing data.

There is no stream to read from in this domain: results arrive as files, and every step is an idempotent batch
keyed on (entity, period) or (report, period). New result files may also be picked up by Structured Streaming,
which only feeds the same batch operator.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.files import report_stem
from panelkit.operators import pick
from panelkit.operators.waterfall import RESOLVED, RETRY, TARGET
from panelkit.plans.round_check import compile_results
from panelkit.sources.readers import bad_files, parse_results


def remaining_targets(targets: DataFrame, resolution: DataFrame) -> DataFrame:
    """Targets an earlier run did not resolve."""
    done = resolution.filter(F.col("final_status").isin(RESOLVED)).select(*TARGET).distinct()
    return targets.join(done, TARGET, "left_anti")


def remaining_reports(reports: DataFrame, finished: DataFrame, name: str = "pdf_file_name") -> DataFrame:
    """Reports without a finished result."""
    done = finished.select(report_stem("json_file").alias("__stem")).distinct()
    return reports.withColumn("__stem", report_stem(name)).join(done, "__stem", "left_anti").drop("__stem")


def listed_reports(reports: DataFrame, wanted: DataFrame, name: str = "pdf_file_name") -> tuple[DataFrame, DataFrame]:
    """(reports that are on the list, listed stems that do not exist)."""
    stems = wanted.select(F.col("stem").alias("__stem")).distinct()
    have = reports.withColumn("__stem", report_stem(name))
    return have.join(stems, "__stem", "left_semi").drop("__stem"), \
        stems.join(have.select("__stem").distinct(), "__stem", "left_anti").withColumnRenamed("__stem", "stem")


def merge_answers(answers: DataFrame, own: Column, run_time: str, run: str | None = None) -> DataFrame:
    """One answer per (report, year): this run's own beats all, else the newest run's, of equal times the last run name."""
    order = [own.cast("int"), F.col(run_time), *([F.col(run)] if run else [])]
    return pick.largest(answers, ["report", "year"], order)


def answers_to_keep(answers: DataFrame, resolution: DataFrame, attempts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, cleared): answers tried for targets that stayed unresolved are cleared, all others are left alone."""
    open_ = resolution.filter(F.col("final_status").isin(RETRY)).select(*TARGET).distinct()
    tried = attempts.join(open_, TARGET, "left_semi").select("report", F.col("gap_year").alias("year")).distinct()
    return answers.join(tried, ["report", "year"], "left_anti"), answers.join(tried, ["report", "year"], "left_semi")


def append_run(panel: DataFrame, new_rows: DataFrame, stamp: str, prior_stamp: str | None = None, prior_count: int | None = None) -> DataFrame:
    """Panel + the rows of a gap-fill run; refuses a stamp that is already there.

    A panel from before runs were labelled gets `prior_stamp` on its gap-fill rows, if their number is the one expected.
    """
    if "gapfill_run" not in panel.columns:
        n = panel.filter("source_round = 'gapfill'").count()
        if n and n != prior_count:
            raise ValueError(f"the panel has {n} gap-fill rows, {prior_count} were expected; they cannot be labelled {prior_stamp}")
        panel = panel.withColumn("gapfill_run", F.when(F.col("source_round") == "gapfill", F.lit(prior_stamp)))
    if panel.filter(F.col("gapfill_run") == stamp).limit(1).count():
        raise ValueError(f"run {stamp} is already in the panel")
    own = {"source_round": F.lit("gapfill"), "gapfill_run": F.lit(stamp)}
    if "last_actual_year" in panel.columns and "year" in new_rows.columns:
        own["last_actual_year"] = F.col("year").cast("string")
    have = new_rows.withColumns(own)
    return panel.unionByName(have.select(*[
        (F.col(c) if c in have.columns else F.lit(None)).cast(panel.schema[c].dataType).alias(c) for c in panel.columns]))


def stream_compile(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern: str = "*_dsa.json", errors: str | None = None):
    """Compile new result files as they arrive: a file stream into the batch operator, appended as Parquet.

    Files that cannot be read go to `errors` (default: `out` with "_errors" added). Each micro-batch is written under its
    own id, so a repeated batch replaces itself.
    """
    files = (spark.readStream.option("pathGlobFilter", pattern).option("wholetext", True).text(folder)
             .select(F.col("_metadata.file_name").alias("json_file"), F.col("value").alias("text")))

    def write(batch: DataFrame, batch_id: int) -> None:
        results = parse_results(batch)
        compile_results(results).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        bad_files(results).write.mode("overwrite").parquet(f"{errors or out + '_errors'}/batch={batch_id}")
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
