"""Shared helpers: reading tables, writing an intermediate table once, Arrow text buffers."""
import ctypes
import functools
import inspect
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import materialise, tune

#: Rows and bytes of one Arrow batch: what a Python worker holds at once beside one text.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
_SHIPPED: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession | None = None) -> SparkSession:
    """Give the Python workers this package, and Arrow batches so small that long texts don't pile up in one."""
    spark = tune(spark or SparkSession.active())
    sc = spark.sparkContext
    if _SHIPPED.get("app") != sc.applicationId:
        import panelkit

        root = Path(panelkit.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="panelkit-")) / "panelkit.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(archive))
        _SHIPPED["app"] = sc.applicationId
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back; lineage ends there."""
    return materialise(df, compression)


def let_go() -> None:
    """Give the memory that this process holds and does not use back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc's
    if trim:
        trim(0)


def lean(work: Callable) -> Callable:
    """`work` (of rows, of columns or of a group) in a Python worker that lets go of its memory afterwards: an executor has more
    workers than run at once and they take turns, so what one kept at its task's end all of them would keep at the same time."""
    if inspect.isgeneratorfunction(work):
        def out(*args):
            yield from work(*args)
            let_go()
    else:
        def out(*args):
            result = work(*args)
            let_go()
            return result
    out = functools.wraps(work)(out)
    out.__signature__ = inspect.signature(work)                     # Spark counts a group function's arguments
    return out


def texts_of(column: pa.Array) -> list[str]:
    """Texts as str; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and each text's start (n + 1 offsets). Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = column.buffers()[2]
    size = int(offsets[-1] - offsets[0])
    body = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.empty(0, np.uint8)
    return body, offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer text is a block of its own."""
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        out.append((a, min(b, n)))
        a = min(b, n)
    return out


def held_out(doc_id) -> F.Column:
    """Rows whose labels no classifier learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
