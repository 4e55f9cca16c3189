"""Session settings the operators rely on, and the one place where lineage is cut."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. Adaptive execution re-plans joins from measured sizes and splits hot join keys;
# forceOptimizeSkewedJoin keeps that split even when a later step groups by the same key.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Shuffle partitions that adaptive execution starts from, for each core: it merges those that turn out small, but can't cut
#: those that many keys share, so a number fixed by the session would let a task's sorts grow with the tables.
FINE_PARTITIONS = 32
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes to which adaptive execution merges the small ones: a task also sorts and sends what it makes of them, such as a row for
#: each of three runs, which takes many times their compressed size and is spilled where it doesn't fit.
MERGED, MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"


def tune(spark: SparkSession, fine: bool = False) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created. fine: shuffles start from many partitions, and stay finer."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if fine:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), FINE_PARTITIONS * cores)))
        spark.conf.set(MERGED, MERGED_BYTES)
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
        if spark.conf.get(MERGED, None) == MERGED_BYTES:
            spark.conf.unset(MERGED)
    return spark


def local_session(app: str = "panelkit", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("panelkit.scan.tasks", cores if cores.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no call-site capture for every column expression: large plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder checkpoints go to: the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local
    folder would not survive the loss of an executor, so that is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="panelkit-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


#: Folders of the intermediate tables that this process has written and not cleared.
_TABLES: list[str] = []


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write `df` as Parquet to the checkpoint folder and read it back: one evaluation, of which every consumer reads its own columns.

    The table stays until `discard` is called with what this returns, or `clear_tables` at the end of a job.
    """
    path = f"{use_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _TABLES.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    if path in _TABLES:
        _TABLES.remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialise` returned, once nothing that is still to run reads them: what was computed from them
    has been written itself, so a lost executor doesn't need them either."""
    for t in tables:
        _delete(t.sparkSession, t.table_path)


def alone(make: Callable[[], DataFrame]) -> DataFrame:
    """What `make` returns, written, without the tables that were written on the way (by this thread alone)."""
    before = len(_TABLES)
    out = materialise(make())
    for path in _TABLES[before:-1]:
        _delete(out.sparkSession, path)
    return out


def clear_tables(spark: SparkSession) -> int:
    """Delete all intermediate tables of this process; frames that read them can't be run any more. How many there were."""
    found = list(_TABLES)
    for path in found:
        _delete(spark, path)
    return len(found)
