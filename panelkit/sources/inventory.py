"""What lies in a folder: names, sizes and times only. File contents are read for fingerprints alone."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.functions.files import base_name, report_file, selected_name
from panelkit.functions.names import entity_key
from panelkit.functions.text import found
from panelkit.operators import pick
from panelkit.operators.spread import number_rows


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, name, parent, size, modified); the content column is pruned, so no file is opened."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(folder))
    # a scan path is written as a URI, so %20 and the like are decoded
    path = F.try_url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    return df.select(path.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")) \
        .withColumn("name", base_name("path")).withColumn("parent", F.regexp_extract("path", r"([^/\\]*)[/\\][^/\\]*$", 1))


def below(root: str) -> Column:
    """Path of a file relative to the folder `root`."""
    return F.substring_index("path", root.rstrip("/") + "/", -1)


def document_inventory(files: DataFrame, root: str, batches: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, unparsed): one row per file name with entity, key, batch, publication year; names without a date apart.

    A name found in several batches counts once (first batch in name order).
    """
    f = files.filter(~F.col("name").startswith("~$")).withColumn("batch", F.split_part(below(root), F.lit("/"), F.lit(1)))
    if batches:
        f = f.filter(F.col("batch").isin(batches))
    raw = found("name", r"^(.+?)_\d{4}-\d{2}-\d{2}", 1)
    docs = pick.smallest(f.select("name", "batch", "path", "size"), ["name"], [F.col("batch"), F.col("path")])
    docs = docs.withColumn("entity_raw", raw)
    parsed = docs.filter("entity_raw is not null").select(
        F.col("name").alias("pdf_file_name"), "batch", "entity_raw", entity_key("entity_raw").alias("entity_key"),
        F.substring(found("name", r"^.+?_(\d{4}-\d{2}-\d{2})", 1), 1, 4).cast("int").alias("year"))
    return parsed, f.filter(raw.isNull()).select("batch", "path")


def report_inventory(files: DataFrame) -> DataFrame:
    """Every dated report below a folder, whatever batch it lies in: one row per name."""
    one = pick.smallest(files.select("name", "path"), ["name"], [F.col("path")]).withColumn("r", report_file("name"))
    return one.filter("r is not null").select(F.col("name").alias("pdf_file_name"), "path", F.col("r.entity").alias("country"),
                                              F.col("r.date").alias("report_date"), F.col("r.year").alias("pub_year"))


ROUND_RUN = r"^round(\d+)_(\d{4,8})_run(\d+)$"


def selected_folders(files: DataFrame, root: str, folder: str = "selected_pdf_pages") -> DataFrame:
    """One selected-page folder per batch: the direct one, else lowest round, lowest run, latest stamp."""
    rel = below(root)
    f = files.select(rel.alias("rel")).withColumn("batch", F.split_part("rel", F.lit("/"), F.lit(1)))
    second, third = F.split_part("rel", F.lit("/"), F.lit(2)), F.split_part("rel", F.lit("/"), F.lit(3))
    direct = second == folder
    run = second.rlike(ROUND_RUN) & (third == folder)
    c = f.filter(direct | run).select(
        "batch", F.when(direct, F.lit(folder)).otherwise(F.concat_ws("/", second, third)).alias("dir"), direct.alias("direct"),
        *[found(second, ROUND_RUN, g).cast("int").alias(n) for g, n in ((1, "round_no"), (2, "stamp"), (3, "run_no"))]).distinct()
    return pick.smallest(c, ["batch"], [~F.col("direct"), F.col("round_no"), F.col("run_no"), -F.col("stamp")]) \
        .select("batch", F.concat_ws("/", "batch", "dir").alias("dir"))


def index_selected(files: DataFrame, root: str, folders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(indexed, ignored) files of the chosen folders: stem, method and folder rank; names without a stem apart."""
    rel = below(root)
    f = files.withColumn("dir", F.regexp_replace(rel, r"/[^/]*$", "")).filter(F.lower("name").endswith(".pdf"))
    # one folder per batch
    ranked = number_rows(folders.select("batch", "dir"), ["batch", "dir"]).select("dir", (F.col("position") - 1).alias("dir_rank"))
    f = f.join(ranked, "dir").withColumn("s", selected_name("name"))
    return (f.filter("s is not null").select("s.stem", "s.method", "s.method_rank", "dir", "dir_rank", "name", "size"),
            f.filter("s is null").select("dir", "name"))


def batch_counts(files: DataFrame, root: str) -> DataFrame:
    """Files per batch folder; files directly under the root count as outside any batch (NULL)."""
    rel = below(root)
    return files.groupBy(F.when(rel.contains("/"), F.split_part(rel, F.lit("/"), F.lit(1))).alias("batch")).agg(F.count("*").alias("n_files"))


def version_catalogue(files: DataFrame, pattern: str = r"^panel_(pregapfill|gapfill)_([A-Za-z0-9_\-]+)\.(?:csv|parquet)$") -> DataFrame:
    """Outputs with the kind and version their name says; other files have kind `other`."""
    return files.select("name", F.coalesce(found("name", pattern, 1), F.lit("other")).alias("kind"),
                        found("name", pattern, 2).alias("version"), "size", "modified")


def newest_first(catalogue: DataFrame) -> DataFrame:
    return catalogue.orderBy(F.coalesce("version", F.lit("")).desc(), F.desc("modified"))


def latest_output(catalogue: DataFrame, kind: str | None = None) -> DataFrame:
    """One row: the newest file of a kind; without a kind, gap-filled before pre-gap-fill of the top version."""
    if kind:
        return newest_first(catalogue.filter(F.col("kind") == kind)).limit(1)
    rank = pick.priority_rank("kind", ["gapfill", "pregapfill", "other"])
    return catalogue.orderBy(F.coalesce("version", F.lit("")).desc(), F.when(F.col("version").isNotNull(), rank), F.desc("modified")).limit(1)


def run_catalogue(files: DataFrame, root: str, round_name: str) -> DataFrame:
    """Versions of a round seen in folder names: run numbers, and whether they were checked; newest first."""
    folder = F.split_part(below(root), F.lit("/"), F.lit(1))
    # a check counts once its report summary is there, as an unfinished one leaves other files behind
    f = files.select(folder.alias("d"), F.col("name").rlike("_report_summary_.*").alias("summary")) \
        .filter(~F.col("d").contains("_incomplete_"))
    check, run = found("d", rf"^{round_name}_check_(.+)$", 1), rf"^{round_name}_(.+)_run(\d+)$"
    v = f.select(F.coalesce(check, found("d", run, 1)).alias("version"), (check.isNotNull() & F.col("summary")).alias("checked"),
                 F.when(check.isNull(), found("d", run, 2).cast("int")).alias("run")).filter("version is not null")
    return v.groupBy("version").agg(F.bool_or("checked").alias("has_check"), F.array_sort(F.collect_set("run")).alias("runs")) \
        .withColumn("n_runs", F.size("runs")).orderBy(F.desc("version"))


def run_progress(files: DataFrame, run: Column) -> DataFrame:
    """Per run: reports with a result, and reports with only an error."""
    f = files.select(run.alias("run"), F.regexp_replace("name", r"_(dsa|ERROR)\.json$", "").alias("stem"),
                     F.col("name").endswith("_dsa.json").alias("done")).filter(F.col("name").rlike(r"_(dsa|ERROR)\.json$"))
    per = f.groupBy("run", "stem").agg(F.bool_or("done").alias("done"))
    return per.groupBy("run").agg(F.count_if("done").alias("n_done"), F.count_if(~F.col("done")).alias("n_errors"))


def gap_runs(catalogue: DataFrame, identified: DataFrame, filled: DataFrame) -> DataFrame:
    """Gap runs (stamp) with flags: targets exist, resolution exists."""
    i = identified.select("stamp").distinct().withColumn("__i", F.lit(True))
    f = filled.select("stamp").distinct().withColumn("__f", F.lit(True))
    return (catalogue.join(i, "stamp", "left").join(f, "stamp", "left")
            .withColumn("identified", F.coalesce("__i", F.lit(False))).withColumn("filled", F.coalesce("__f", F.lit(False))).drop("__i", "__f"))


def fingerprint(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Size, time and a short SHA-256 of each file, hashed where the file is read."""
    df = spark.read.format("binaryFile").load(path)
    return df.select(base_name("path").alias("name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"),
                     F.substring(F.sha2("content", 256), 1, 16).alias("sha256_16"))


def folder_difference(a: DataFrame, b: DataFrame, key: str = "name") -> DataFrame:
    """Keys of two folders with where they are: both, only_a or only_b (one grouping, no set operators needed)."""
    u = a.select(key, F.lit(1).alias("w")).unionByName(b.select(key, F.lit(2).alias("w")))
    g = u.groupBy(key).agg(F.min("w").alias("lo"), F.max("w").alias("hi"))
    return g.select(key, F.when(F.col("lo") != F.col("hi"), "both").when(F.col("lo") == 1, "only_a").otherwise("only_b").alias("found_in"))
