"""Training order: fixed-stride shards of token sequences in the order of a keyed permutation.

Tokens of the documents of an input partition follow one another and are cut into sequences of equal length. Sequences are
numbered without a gap (offsets of partitions, whose number is bounded), and a keyed Feistel network with cycle-walking
maps each number to its global slot; it is a permutation for any key and any number of sequences, with an inverse. A range
of slots is a shard: one file of records of equal size, written in order of slots by Spark's writer, so that training reads
it sequentially and resumes at any slot by arithmetic.
"""
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, mix64, prepare, texts_of, written
from panelkit.llm.word_tokens import encoder, forget

LENGTH, PER_SHARD, ROUNDS = 2048, 4096, 6


def _halves(n: int) -> int:
    """Bits of half a block that can number n things."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(right: np.ndarray, key: int, r: int, mask: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(right + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1342543DE82EF95) % 2**64)) & mask


def slot_of(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of sequences in an order of n: Feistel rounds, repeated while the result is n or more."""
    half = _halves(n)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(index).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> bits, out[walking] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ _round(right, key, r, mask)
        out[walking] = left << bits | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def index_of(slot: np.ndarray, n: int, key: int) -> np.ndarray:
    """The inverse of slot_of."""
    half = _halves(n)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(slot).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> bits, out[walking] & mask
        for r in reversed(range(ROUNDS)):
            left, right = right ^ _round(left, key, r, mask), left
        out[walking] = left << bits | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def stride(length: int = LENGTH) -> int:
    """Bytes of a record: count and checksum of its ids, `length` 16-bit ids (zero-filled), a line feed."""
    return 8 + 2 * length + 1


def record(ids: np.ndarray, length: int = LENGTH) -> bytes:
    body = ids.astype("<u2").tobytes()
    return np.array([len(ids), zlib.crc32(body)], "<u4").tobytes() + body + bytes(2 * (length - len(ids)))


def read_record(raw: bytes) -> np.ndarray:
    n, crc = np.frombuffer(raw, "<u4", 2).tolist()
    ids = np.frombuffer(raw, "<u2", n, 8)
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a record's checksum doesn't agree")
    return ids


def texts_by_row(batch: pa.RecordBatch, rows: int = 100):
    """(id, text) of every row; the texts of some rows at a time are made, not those of the batch."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield from zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True)


def write_shards(docs: DataFrame, vocabulary: str, path: str, key: int, end: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Write the shards under path (shard=N folders of one file each) and return slot, shard, position (in the shard),
    n_tokens and pieces (doc_id, start: the document's tokens before, length) of every sequence.

    A document is its ids and the id `end`; null and empty texts are `end` alone. All ids must be below 65,536. Every row is
    a document, repeated rows too; only the last sequence of an input partition may be short. Columns other than doc_id and
    text are not read. An empty table writes nothing and gives no rows. Lost tasks are done again alike, since sequences
    depend on the rows of their input partition only and the numbered table is read from shared storage.
    """
    prepare(docs.sparkSession)
    piece = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32())])
    names = ["__part", "__at", "n_tokens", "pieces", "z"]

    def cut(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        encode, squeeze = encoder(vocabulary).encode, zstandard.ZstdCompressor(level=3).compress
        held, size, pieces = [], 0, []

        def take(rows):
            nonlocal held, size, pieces, at
            rows.append((part, at, size, pieces, squeeze(np.concatenate(held).tobytes())))
            at, held, size, pieces = at + 1, [], 0, []

        for b in batches:
            rows: list[tuple] = []
            for doc, t in texts_by_row(b):
                ids = np.append(np.frombuffer(encode(t), "<u4"), end).astype("<u2")
                start = 0
                while start < len(ids):
                    n = min(length - size, len(ids) - start)
                    held.append(ids[start : start + n])
                    pieces.append({"doc_id": doc, "start": start, "length": n})
                    size, start = size + n, start + n
                    if size == length:
                        take(rows)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        if size:
            rows = []
            take(rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        forget()

    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(piece), pa.binary()]
    cuts = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean(cut), "__part int, __at long, n_tokens int, pieces array<struct<doc_id: long, start: long, length: int>>, z binary"))
    counts = sorted((r["__part"], r.n) for r in cuts.groupBy("__part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in counts)
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = docs.sparkSession.createDataFrame(starts or [(0, 0)], "__part int, __before long")          # one row for each input partition
    numbered = cuts.join(F.broadcast(offsets), "__part")

    def slots(index: pa.Array) -> pa.Array:
        return pa.array(slot_of(index.to_numpy(), total, key))

    def records(body: pa.Array) -> pa.Array:
        forget()
        z = zstandard.ZstdDecompressor()
        return pa.array([record(np.frombuffer(z.decompress(b), "<u2"), length) for b in body.to_pylist()], pa.binary())

    slotted = numbered.withColumn("slot", F.arrow_udf(lean(slots), "long")(F.col("__before") + F.col("__at")))
    shards = max(1, -(-total // per_shard))
    shard = F.floor(F.col("slot") / per_shard).cast("int")
    dealt = slotted.select("slot", shard.alias("shard"), "z").repartitionById(shards, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", "slot").select("shard", F.arrow_udf(lean(records), "binary")("z").cast("string").alias("value"))
    ordered.write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(path)
    return slotted.select("slot", shard.alias("shard"), (F.col("slot") % per_shard).cast("int").alias("position"), "n_tokens", "pieces")


def read_shards(spark, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """slot, n_tokens, ids_crc32 (of the 16-bit ids) of every record, read from the files; a shard must be one file of whole records."""
    prepare(spark)
    size = stride(length)

    def told(file: str, raw: pa.Scalar) -> pa.RecordBatch:
        shard = int(file.rsplit("shard=", 1)[1].split("/", 1)[0])
        view = memoryview(raw.as_buffer())              # no copy of the file
        if len(view) % size:
            raise ValueError(f"{file}: not a whole number of records")
        ids = [read_record(view[at : at + size]) for at in range(0, len(view), size)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(ids)) + shard * per_shard), pa.array([len(i) for i in ids], pa.int32()), pa.array([zlib.crc32(i) for i in ids], pa.int64())],
            ["slot", "n_tokens", "ids_crc32"])

    def slots(batches):
        forget()
        for b in batches:
            found = [told(file, raw) for file, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True)]
            del b                                       # a file isn't held while the next one comes
            yield from found

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return files.select("path", "content").mapInArrow(lean(slots), "slot long, n_tokens int, ids_crc32 long")
