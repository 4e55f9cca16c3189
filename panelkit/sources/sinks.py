"""Write tables: stamped, never over an existing one, and several tables of a run all or none."""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_stamped(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """Parquet under <folder>/<name>/stamp=<stamp>; an existing stamp is an error."""
    path = f"{folder}/{name}/stamp={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with header (an export; Parquet is the working format)."""
    df.write.mode("errorifexists").csv(path, header=True, escape='"', quote='"')


MANIFEST = "stamp string, attempt string, name string, path string, n_rows bigint, columns string, facts map<string,string>"


def commit_tables(tables: dict[str, DataFrame], folder: str, stamp: str, facts: dict[str, str] | None = None) -> DataFrame:
    """Write the named tables of a run (what a workbook's sheets hold), all of them or none, and return their manifest rows.

    Every call writes into folders of its own attempt; the manifest, one file with a row per table, is written last, and
    readers go by it alone. A run that broke off is written anew under the same stamp; a committed stamp is refused. Should
    two writers commit one stamp at once, the attempt with the least id is the one that all readers take.
    """
    if not tables:
        raise ValueError("a run without tables can't be committed")
    spark = next(iter(tables.values())).sparkSession
    if committed(spark, folder).filter(F.col("stamp") == stamp).limit(1).count():
        raise ValueError(f"run {stamp} is already written to {folder}")
    attempt, rows = uuid.uuid4().hex, []
    for name, df in tables.items():
        path = f"{name}/stamp={stamp}/attempt={attempt}"
        df.write.mode("errorifexists").parquet(f"{folder}/{path}")
        rows.append((stamp, attempt, name, path, spark.read.schema(df.schema).parquet(f"{folder}/{path}").count(), df.schema.json(), facts or {}))
    out = spark.createDataFrame(rows, MANIFEST)
    out.coalesce(1).withColumn("created", F.current_timestamp()).write.mode("append").parquet(f"{folder}/manifest")
    return out


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows of all committed runs: one per stamp and table."""
    schema = StructType.fromDDL(MANIFEST + ", created timestamp")
    if not exists(spark, f"{folder}/manifest"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{folder}/manifest")
    first = rows.groupBy("stamp").agg(F.min("attempt").alias("attempt"))
    return rows.join(first, ["stamp", "attempt"], "left_semi")


def read_committed(spark: SparkSession, folder: str, name: str, stamp: str | None = None) -> DataFrame:
    """A table of a committed run: of the given stamp, else of the last one in the order of stamps that holds the table."""
    rows = committed(spark, folder).filter(F.col("name") == name)
    found = (rows.filter(F.col("stamp") == stamp) if stamp is not None else rows.orderBy(F.desc("stamp"))).limit(1).collect()
    if not found:
        raise ValueError(f"no committed table {name!r}" + (f" of run {stamp}" if stamp is not None else "") + f" in {folder}")
    return spark.read.schema(StructType.fromJson(json.loads(found[0]["columns"]))).parquet(f"{folder}/{found[0]['path']}")


def uncommitted(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Folders of attempts that no manifest names: what broken runs left behind, for `remove` while no writer is at work."""
    kept = {f"{r['name']}/{r['stamp']}/{r['attempt']}" for r in committed(spark, folder).select("name", "stamp", "attempt").collect()}
    out = []
    for name in names:
        for path in children(spark, f"{folder}/{name}/stamp=*/attempt=*"):
            stamp, attempt = path.split("/stamp=")[-1].split("/attempt=")
            if f"{name}/{stamp}/{attempt}" not in kept:
                out.append(path)
    return sorted(out)


def write_report_lists(lists: DataFrame, path: str) -> None:
    """Re-check list as JSON lines, one report per line, one folder per category: every task writes what it has."""
    lists.write.mode("errorifexists").partitionBy("category").json(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, files = _hadoop(spark, path)
    return files.exists(p)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder; 0 where there is none."""
    p, files = _hadoop(spark, path)
    return files.getContentSummary(p).getLength() if files.exists(p) else 0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    p, files = _hadoop(spark, path)
    files.delete(p, True)


def children(spark: SparkSession, pattern: str) -> list[str]:
    p, files = _hadoop(spark, pattern)
    return [str(s.getPath().toString()) for s in files.globStatus(p) or []]


def run_record(stamp: str, measures: DataFrame, **facts: str) -> DataFrame:
    """One row: the stamp, fixed facts and the measures of a run (an aggregate's single row)."""
    return measures.select(F.lit(stamp).alias("stamp"), *[F.lit(v).alias(k) for k, v in facts.items()],
                           F.current_timestamp().alias("created"), "*")


class TableRegistry:
    """Named tables of a session, for exporting any intermediate result by name."""

    def __init__(self) -> None:
        self._builders = {}

    def add(self, name: str, builder) -> None:
        self._builders[name] = builder

    def names(self) -> list[str]:
        return sorted(self._builders)

    def table(self, name: str) -> DataFrame:
        if name not in self._builders:
            raise KeyError(f"no table {name!r}; there are {self.names()}")
        return self._builders[name]()

    def export(self, name: str, folder: str, stamp: str) -> str:
        return write_stamped(self.table(name), folder, name, stamp)
