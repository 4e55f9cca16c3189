"""Read extraction results, run tables, report lists, saved answers and lookup tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelkit.functions.files import report_stem
from panelkit.operators.gaps import AUDIT
from panelkit.operators.tree import tree_type
from panelkit.schema import string_schema

RUN_REQUIRED = ["json_file", "pdf_file_name", "table_found", "last_actual_year", "top_category", "hierarchy_id",
                "label_verbatim", "value"]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def extraction_schema() -> T.StructType:
    """One extraction result: report facts, source facts with both header audits, the tree of values."""
    validation = T.StructType([*_strings("status", "first_selected_year", "audited_selected_year"),
                               T.StructField("issues", T.ArrayType(T.StringType()))])
    source = T.StructType([
        *_strings("country", "publication_date", "consultation_type", "framework", "table_number", "table_title", "page_pdf",
                  "page_printed", "last_actual_year", "actual_column_label", "actual_column_status",
                  "actual_column_header_verbatim", "latest_observation_year", "latest_observation_status",
                  "independent_latest_observation_year", "independent_latest_observation_status", "confidence"),
        T.StructField("column_header_audit", AUDIT), T.StructField("independent_column_header_audit", AUDIT),
        T.StructField("actual_column_validation", validation)])
    meta = T.StructType(_strings("pdf_file_name", "country", "publication_date", "consultation_type", "report_title",
                                 "country_report_number"))
    return T.StructType([
        T.StructField("report_metadata", meta), T.StructField("source", source), T.StructField("table_found", T.BooleanType()),
        T.StructField("decomposition", tree_type()),
        *_strings("pdf_file_name", "extraction_method", "extraction_notes", "failure_reason")])


def read_extractions(spark: SparkSession, folder: str | list[str], pattern: str = "*_dsa.json") -> DataFrame:
    """One row per result file: json_file, result (struct), has_tree, error.

    A file that is no JSON object gets an error instead of failing the read.
    """
    raw = spark.read.option("pathGlobFilter", pattern).option("wholetext", True).text(folder)
    return parse_results(raw.select(F.col("_metadata.file_name").alias("json_file"), F.col("value").alias("text")))


def parse_results(files: DataFrame) -> DataFrame:
    """json_file, result, has_tree, error of whole files (json_file, text), in a batch or in a stream."""
    raw = files.select("json_file", F.regexp_replace("text", "^﻿", "").alias("text"))
    # the key list alone does not parse what follows it, so a cut-off file shows only in the full parse
    schema = T.StructType([*extraction_schema().fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    keys = F.json_object_keys("text")
    bad = keys.isNull() | F.col("r._bad").isNotNull()
    return (raw.withColumn("r", parsed)
            .select("json_file", F.col("r").alias("result"),
                    F.coalesce(F.array_contains(keys, "decomposition"), F.lit(False)).alias("has_tree"),
                    F.when(bad, F.lit("not a readable JSON object")).alias("error")))


def bad_files(results: DataFrame) -> DataFrame:
    """(json_file, error) of the files that could not be read."""
    return results.filter("error is not null").select("json_file", "error")


def read_run(spark: SparkSession, path: str | list[str], required: list[str] = RUN_REQUIRED, columns: list[str] | None = None, multi_line: bool = True,
             numbered: bool = False) -> DataFrame:
    """A run's table: all text, multi-line fields, byte-order mark tolerated, required columns checked.

    A file with line breaks inside fields is read by one task. Without such fields, `multi_line=False` lets a large file
    be split. `numbered` adds row_no, which sorts rows by file of the list, then by place in the file, however files were
    cut and packed into tasks.

    Only the header line is read to learn the columns; nothing is inferred from the data. Files of a list are
    combined by column name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    out = None
    for n, p in enumerate(paths):
        cols = columns or csv_header(spark, p)
        missing = [c for c in required if c not in cols]
        if missing:
            raise ValueError(f"{p} lacks the columns {missing}")
        df = spark.read.schema(string_schema(cols)).csv(p, header=True, multiLine=multi_line, quote='"', escape='"', enforceSchema=True)
        if numbered:
            # within one piece of a file the id grows along the rows
            df = df.withColumn("row_no", F.struct(F.lit(n).alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                                                  F.monotonically_increasing_id().alias("id")))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line."""
    names = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False).columns
    return [n.lstrip("﻿") for n in names]


def read_sparse(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """CSV whose text 'NA' is a value and only an empty field is missing; `multi_line` as in `read_run`."""
    df = spark.read.schema(string_schema(columns)).csv(path, header=True, multiLine=multi_line, escape='"', nullValue="", emptyValue="")
    return df.select(*[F.nullif(c, F.lit("")).alias(c) for c in columns])


def stack_runs(frames: list[DataFrame]) -> DataFrame:
    """Runs under one another with run_no and the row's place in its own run (row_no).

    Frames of `read_run(numbered=True)` bring a row_no in file order; rows of others are numbered as they come.
    """
    out = None
    for n, df in enumerate(frames, start=1):
        f = df.withColumn("run_no", F.lit(n))
        f = f if "row_no" in df.columns else f.withColumn("row_no", F.monotonically_increasing_id())
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def read_errors(spark: SparkSession, folders: dict[int, str], pattern: str = "*_ERROR.json") -> DataFrame:
    """(run_no, stem, message) of every run's error files."""
    out = None
    for run, folder in folders.items():
        raw = spark.read.option("pathGlobFilter", pattern).option("wholetext", True).text(folder)
        readable = F.json_object_keys("value").isNotNull()
        e = raw.select(F.lit(run).alias("run_no"), F.regexp_replace("_metadata.file_name", r"_ERROR\.json$", "").alias("stem"),
                       F.when(readable, F.trim(F.get_json_object("value", "$.error"))).otherwise(
                           F.concat(F.lit("(could not read "), F.col("_metadata.file_name"), F.lit(")"))).alias("message"))
        out = e if out is None else out.unionByName(e)
    return out


_LISTED = T.StructType([T.StructField("rows", T.ArrayType(T.StructType([
    T.StructField("category", T.StringType()), T.StructField("ord", T.IntegerType()), T.StructField("v", T.VariantType())]))),
    T.StructField("done", T.IntegerType())])


def report_list(texts: DataFrame, text: str, category: str | None = None) -> DataFrame:
    """Distinct (stem, category, ord) listed in JSON texts of any nesting; ord is the place in the entry's own list.

    A list entry is a name, an object naming its report (json_file, else report), or a list or object of further entries.
    Of an object without a name only the list called `reports` and nested objects are followed, so that descriptive fields
    are never taken for names. With `category`, only that key of each text's top object is read; a text without it is an
    error. A text that is no JSON lists nothing.
    """
    v = F.try_parse_json(F.col(text))
    if category:
        top = F.try_variant_get(v, "$", "map<string,variant>")
        absent = F.raise_error(F.concat(F.lit(f"category {category} is no top-level key of "), F.left(F.col(text), F.lit(80))))
        v = F.when(F.coalesce(F.map_contains_key(top, category), F.lit(False)), F.try_element_at(top, F.lit(category))).otherwise(absent.cast("variant"))
    start = F.struct(F.array(F.struct(F.lit(category).cast("string").alias("category"), F.lit(0).alias("ord"), v.alias("v"))).alias("rows"), F.lit(0).alias("done"))
    # every level needs a bracket of its own, so there are no more levels than opening brackets
    steps = F.length(F.regexp_replace(text, r"[^\[{]+", ""))
    steps = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    rows = F.aggregate(steps, start.cast(_LISTED), _listed)["rows"]
    entry = texts.select(F.posexplode(rows).alias("pos", "e")).select(
        "e.category", "e.ord", F.coalesce(F.when(F.col("pos") > 0, _text_of(F.col("e.v"))), _name(F.col("e.v"))).alias("name"))
    return entry.filter("name is not null").select(report_stem("name").alias("stem"), "category", "ord").groupBy("stem").agg(
        F.min_by("category", F.struct("category", "ord")).alias("category"), F.min("ord").alias("ord"))


def _listed(state: Column, _step: Column) -> Column:
    """The next level: what the entries added by the last step list."""
    rows, done = state["rows"], state["done"]
    new = F.flatten(F.transform(F.slice(rows, done + 1, F.size(rows) - done), _below))
    return F.when(F.size(rows) == done, state).otherwise(F.struct(F.concat(rows, new).alias("rows"), F.size(rows).alias("done")).cast(_LISTED))


def _below(e: Column) -> Column:
    none = F.array().cast(_LISTED["rows"].dataType)

    def place(category: Column, n: Column, v: Column) -> Column:
        return F.struct(category.alias("category"), n.alias("ord"), v.alias("v"))
    members = F.transform(F.try_variant_get(e["v"], "$", "array<variant>"), lambda m, i: place(e["category"], i, m))
    fields = F.filter(F.map_entries(F.try_variant_get(e["v"], "$", "map<string,variant>")), lambda f: (
        (f["key"] == "reports") & F.try_variant_get(f["value"], "$", "array<variant>").isNotNull())
        | F.try_variant_get(f["value"], "$", "map<string,variant>").isNotNull())
    inner = F.transform(fields, lambda f: place(
        F.when(F.try_variant_get(f["value"], "$", "array<variant>").isNotNull(), e["category"]).otherwise(F.coalesce(e["category"], f["key"])), F.lit(0), f["value"]))
    return F.coalesce(members, F.when(_name(e["v"]).isNull(), inner), none)


def _text_of(v: Column) -> Column:
    """The text of a variant that is a text, else NULL."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _name(v: Column) -> Column:
    return F.coalesce(*[_text_of(F.try_variant_get(v, f"$.{key}", "variant")) for key in ("json_file", "report")])


def list_sizes(lists: DataFrame) -> DataFrame:
    """Reports per category and in all. lists: (category, reports array)."""
    return lists.groupBy("category").agg(F.sum(F.size("reports")).alias("n_reports"))


ANSWER = T.StructType([*_strings("status", "column_status", "matched_year_label", "column_header_verbatim", "notes"),
                       T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("warnings", T.ArrayType(T.StringType())),
                       T.StructField("decomposition", tree_type())])


def read_answers(spark: SparkSession, folder: str | list[str], pattern: str = "*_gapfill.json") -> DataFrame:
    """Saved answers, one row per (report stem, year): stem, year, modified, answer struct."""
    raw = (spark.read.option("pathGlobFilter", pattern).option("wholetext", True).text(folder)
           .select(F.regexp_replace("_metadata.file_name", r"_gapfill\.json$", "").alias("stem"),
                   F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("path"), "value"))
    schema = T.StructType([T.StructField("per_target", T.MapType(T.StringType(), ANSWER))])
    return (raw.withColumn("j", F.from_json("value", schema))
            .select("stem", "modified", "path", F.explode("j.per_target").alias("year", "answer"))
            .withColumn("year", F.col("year").try_cast("int")))


def read_lookup(spark: SparkSession, path: str, columns: dict[str, str], schema: str) -> DataFrame:
    """A lookup table (CSV or Parquet) with renamed columns."""
    df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, schema=schema)
    return df.withColumnsRenamed(columns).select(*columns.values())
