"""Importance resampling towards a target distribution: hashed n-gram weights scored in arrays, the best by a distributed quickselect.

Words are found by a byte table and their checksums by one table step for each byte place, for all words of a batch at once.
Checksums of two and three words follow from those of the words alone, as a checksum is linear: that of a string followed
by another is the first one's, carried over as many bytes as the second has, plus the second's. Counts of all buckets are
summed over both tables; a document's weight is a difference of running sums of its features' gains.
"""
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import prepare, row_blocks, utf8, written
from panelkit.operators.spread import number_rows

BUCKETS, WIDEST, LEAST_WORDS, SHARE = 10_000, 3, 20, 5
#: Random pivots of one round of the selection; what is open shrinks by about this factor.
PIVOTS = 15
#: Bytes of text whose words are held at once, and the length up to which carrying over a word is one table step.
HELD, SHORT = 4 << 20, 64
#: Lower case of each byte if it is one of a word (0-9, a-z, A-Z, 128 and more), else 0.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _carries() -> np.ndarray:
    """[n, k, b]: what byte b at place k of a checksum becomes after n bytes of zeros."""
    out = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(1, SHORT + 1):
            out[n, k] = out[n - 1, k] >> 8 ^ _CRC[out[n - 1, k] & 255]
    return out


_CARRY = _carries()


def carried(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums carried over so many zero bytes each."""
    left = lengths
    while True:
        n = np.minimum(left, SHORT)
        crc = _CARRY[n, 0, crc & 255] ^ _CARRY[n, 1, crc >> 8 & 255] ^ _CARRY[n, 2, crc >> 16 & 255] ^ _CARRY[n, 3, crc >> 24]
        left = left - n
        if not left.any():
            return crc


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of all words, and each text's number of words, in texts one after another."""
    low = _LOWER[body]
    inside = low > 0
    before = np.zeros(len(body), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(body)]] = False
    after = np.zeros(len(body), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return low, starts, ends, np.diff(np.searchsorted(starts, offsets))


def checksums(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every word."""
    lengths = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    open_ = np.flatnonzero(lengths <= SHORT)
    for k in range(SHORT):
        open_ = open_[lengths[open_] > k]
        if not len(open_):
            break
        crc[open_] = _CRC[(crc[open_] ^ low[starts[open_] + k]) & 255] ^ crc[open_] >> 8
    crc = ~crc
    for i in np.flatnonzero(lengths > SHORT).tolist():
        crc[i] = zlib.crc32(low[starts[i] : ends[i]])
    return crc


_GAP = np.uint32(zlib.crc32(b" "))


def features(body: np.ndarray, offsets: np.ndarray, widest: int = WIDEST, buckets: int = BUCKETS):
    """The buckets of all runs of 1 to `widest` words, run length by run length, each with its text's place; and each text's number of words."""
    low, starts, ends, counts = words(body, offsets)
    crc, lengths = checksums(low, starts, ends), ends - starts
    text = np.repeat(np.arange(len(counts)), counts)
    out, run = [], crc
    for n in range(1, widest + 1):
        if n > 1:
            to = slice(n - 1, None)
            spaced = carried(np.full(len(crc[to]), _GAP), lengths[to]) ^ crc[to]
            run = carried(run[: len(spaced)], lengths[to] + 1) ^ spaced
        same = text[: len(run)] == text[n - 1 :] if n > 1 else np.ones(len(run), bool)
        out.append(((run[same] % np.uint32(buckets)).astype(np.int64), text[: len(run)][same]))
    return out, counts


def _blocks(column: pa.Array):
    """Rows a to b of a column of texts with their bytes and offsets, about HELD bytes at a time."""
    body, offsets = utf8(column)
    for a, b in row_blocks(offsets, HELD):
        yield a, b, body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts; each task hands on one number for each bucket."""
    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, body, offsets in _blocks(batch.column(0)):
                for found, _ in features(body, offsets, buckets=buckets)[0]:
                    total += np.bincount(found, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():    # one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold logarithms of the smoothed ratio of target to source, rounded down."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + n) / ((x + 1.0) * (t + n)))) for x, y in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise of an id, in thousandths, rounded down; without an id, that of an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_FACTS = pa.struct([("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("noise", pa.int64())])


def weights(gain: np.ndarray, doc_id: Column, text: Column, seed: int) -> Column:
    """struct<n_words, n_features, weight, noise> of each text."""
    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long, noise: long>")
    def scored(ids: pa.Array, texts: pa.Array) -> pa.Array:
        n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
        for a, b, body, offsets in _blocks(texts):
            runs, n_words[a:b] = features(body, offsets, buckets=len(gain))
            for found, place in runs:
                sums = np.concatenate([[0], np.cumsum(gain[found])])
                edges = np.searchsorted(place, np.arange(b - a + 1))
                weight[a:b] += np.diff(sums[edges])
                n_features[a:b] += np.diff(edges)
        made = [n_words, n_features, weight, [noise(i, seed) for i in ids.to_pylist()]]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in made], fields=list(_FACTS))

    return scored(doc_id, text)


def kth_key(rows: DataFrame, key: list[str], k: int, pivots: int = PIVOTS, seed: int = 0) -> tuple:
    """The k-th least of the distinct composite keys (columns without nulls), by quickselect.

    Each round draws random rows that are still open as pivots, and counts, in one pass, the rows before, at and between
    them. That tells exactly which interval holds the k-th key; the next round goes on there, until the key is a pivot.
    Only pivots and counts come to the driver, however many rows tie in the first columns.
    """
    this, least, most = F.struct(*key), None, None
    kinds = [rows.schema[c].dataType for c in key]
    at = lambda p: F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(key, p, kinds, strict=True)])
    before, round_no = 0, 0
    while True:
        open_ = rows
        for bound, side in ((least, "gt"), (most, "lt")):
            if bound is not None:                           # the first column alone can be pushed down to the scan
                first = F.col(key[0])
                open_ = open_.where((first >= bound[0]) & (this > at(bound)) if side == "gt" else (first <= bound[0]) & (this < at(bound)))
        drawn = open_.select(*key).orderBy(F.xxhash64(F.lit(seed + round_no), *key), *key).limit(pivots).collect()
        drawn = sorted(set(map(tuple, drawn)))
        # 2 i: between pivots i - 1 and i; 2 i + 1: pivot i itself
        cell = sum((F.when(this > at(p), 2).when(this == at(p), 1).otherwise(0) for p in drawn), F.lit(0))
        found = {r.cell: r.n for r in open_.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}       # at most 2 pivots + 1 rows
        for c in range(2 * len(drawn) + 1):
            if before + found.get(c, 0) >= k:
                break
            before += found.get(c, 0)
        if c % 2:
            return drawn[c // 2]
        least, most = drawn[c // 2 - 1] if c else least, drawn[c // 2] if c // 2 < len(drawn) else most
        round_no += 1


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs (doc_id, text), weighted towards the texts of `target`.

    Of the N documents with `least_words` words or more, the floor(share * N / 100) with the highest scores are drawn and
    ranked; ties go to the smaller id, ids before none, and then to the place in the input, so repeated rows have ranks of their own. Null and empty
    texts have no features and weight 0. Other columns are not read. An empty table gives no rows; an empty target
    weighs by the documents alone. Texts of any length are scored whole.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(counts(docs, buckets), counts(target, buckets))
    facts = weights(gain, F.col("doc_id"), F.col("text"), seed)
    keys = {"__worst": -F.col("score"), "__none": F.col("doc_id").isNull().cast("int"), "__id": F.coalesce("doc_id", F.lit(0)), "__place": F.monotonically_increasing_id()}
    rows = written(docs.select("doc_id", facts.alias("f")).select("doc_id", "f.n_words", "f.n_features", "f.weight", (F.col("f.weight") + F.col("f.noise")).alias("score")).withColumns(keys))
    able = rows.where(F.col("n_words") >= least_words)
    k = share * able.count() // 100
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    lost = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*out, lost)
    last = kth_key(able, list(keys), k, seed=seed)
    drawn = (F.col("n_words") >= least_words) & (F.struct(*keys) <= F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(keys, last, strict=True)]))
    ranked = number_rows(rows.where(drawn), list(keys), "rank")
    return ranked.select(*out, F.col("rank").cast("long")).unionByName(rows.where(~drawn).select(*out, lost))
