"""Cost-balanced packing: sequences of a fixed capacity with nearly equal attention cost and no padding.

A piece of n tokens costs 6 w n + n^2 (w: the model's width): what its projections and its attention to itself take, in units
of 4 w operations a layer. As many sequences are opened as the tokens fill to the last place; pieces go, dearest first, to the
cheapest sequence with room for them. A piece that fits nowhere any more is cut to fill the largest room. What remains below a
sequence is packed with that of other blocks, and in the end into sequences of powers of two, which need no padding.
"""
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.byte_tokens import byte_tokens
from panelkit.llm.common import prepare, texts_of, written

SIZE, WIDTH = 1024, 768
#: Pieces that one task packs.
BLOCK = 1 << 15


def cost(length, width: int = WIDTH):
    """Linear and quadratic cost of a piece; numbers, arrays or columns."""
    return 6 * width * length + length * length


def balanced(lengths: list[int], rooms: list[int], width: int = WIDTH) -> list[list[tuple[int, int, int]]]:
    """Pieces (index, start, length) of each sequence, for lengths that fill all rooms exactly.

    Lengths go down, so a sequence without room for the present one waits until the length has come down to its room; the
    cheapest of the others is the head of a heap. Where none has room, the rest of a cut piece takes its turn by its length.
    """
    pieces: dict[int, list[tuple[int, int]]] = {}           # (index, start) by length
    for i in range(len(lengths) - 1, -1, -1):
        pieces.setdefault(lengths[i], []).append((i, 0))
    waiting: dict[int, list[tuple[int, int]]] = {}          # heaps of (cost, sequence) by room
    for k, room in enumerate(rooms):
        waiting.setdefault(room, []).append((0, k))
    ready: list[tuple[int, int]] = []
    left, out = list(rooms), [[] for _ in rooms]
    for n in range(max([*lengths, *rooms], default=0), 0, -1):
        for held in waiting.pop(n, ()):
            heapq.heappush(ready, held)
        while pieces.get(n):
            i, start = pieces[n].pop()
            while ready and left[ready[0][1]] < n:
                held = heapq.heappop(ready)
                if left[held[1]]:
                    heapq.heappush(waiting.setdefault(left[held[1]], []), held)
            if ready:
                paid, k = ready[0]
                put = n
                heapq.heapreplace(ready, (paid + cost(n, width), k))
            else:                                           # every room is smaller than the piece
                put = max(waiting)
                k = heapq.heappop(waiting[put])[1]
                if not waiting[put]:
                    del waiting[put]
                pieces.setdefault(n - put, []).append((i, start + put))
            out[k].append((i, start, put))
            left[k] -= put
    return out


def rooms_of(tokens: int, size: int, last: bool) -> list[int]:
    """Rooms for so many tokens: full sequences, then one for what remains, or sequences of powers of two at the last."""
    whole, rest = divmod(tokens, size)
    return [size] * whole + ([1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1] if last else [rest] * (rest > 0))


def tokens_of(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = 0) -> DataFrame:
    """doc_id, __row, doc_tokens, whole (checksums of the full pieces that a document begins with), tail (the other ids, as
    little-endian unsigned 16-bit numbers) and tail_crc32 of every document; checksums are of 32-bit ids."""
    prepare(docs.sparkSession)
    stop = np.array([end], "<u2").tobytes()
    kind = pa.struct([("doc_tokens", pa.int64()), ("whole", pa.list_(pa.int64())), ("tail", pa.binary()), ("tail_crc32", pa.int64())])

    @F.arrow_udf("doc_tokens long, whole array<long>, tail binary, tail_crc32 long")
    def encoded(texts: pa.Array) -> pa.Array:
        encode, out = byte_tokens(vocabulary).encode, []
        for t in texts_of(texts):
            ids = np.frombuffer(encode(t) + stop, "<u2")
            cut = len(ids) // size * size
            out.append({"doc_tokens": len(ids), "whole": [_crc(ids[a : a + size]) for a in range(0, cut, size)], "tail": ids[cut:].tobytes(), "tail_crc32": _crc(ids[cut:])})
        return pa.array(out, kind)

    return docs.select("doc_id", F.monotonically_increasing_id().alias("__row"), encoded(F.col("text")).alias("t")).select("doc_id", "__row", "t.*")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _crc_within(tail: pa.Array, start: pa.Array, length: pa.Array) -> pa.Array:
    return pa.array([_crc(np.frombuffer(t, "<u2", n, 2 * a)) for t, a, n in zip(tail.to_pylist(), start.to_pylist(), length.to_pylist(), strict=True)], pa.int64())


def place(pieces: DataFrame, size: int = SIZE, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """`pieces` (any columns, `start` and `length` from 1 to size) cut and placed: start and length of each part, sequence_id, offset.

    Pieces are dealt at random into blocks. What a block has below a full sequence, less than `size` tokens, is packed
    in the next round with that of the others, until one block is left. Other columns go along with every part; they must
    not be called sequence_id, offset, or begin with `__`.
    """
    prepare(pieces.sparkSession)
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long, __left boolean"

    def packer(round_no: int, last: bool):
        def packed(t: pa.Table) -> pa.Table:
            lengths, starts = t["length"].to_pylist(), t["start"].to_pylist()
            rooms, at = rooms_of(sum(lengths), size, last), t["__block"][0].as_py()
            rows = []
            for k, parts in enumerate(balanced(lengths, rooms, width)):
                offset = 0
                for i, start, n in parts:
                    rows.append((i, starts[i] + start, n, (round_no << 56) | (at << 24) | k, offset, not last and rooms[k] < size))
                    offset += n
            taken, start, n, seq, offset, left = (list(c) for c in zip(*rows, strict=True))
            out = t.select(columns).take(pa.array(taken, pa.int64()))
            for name, values, to in (("start", start, pa.int64()), ("length", n, pa.int64())):
                out = out.set_column(columns.index(name), name, pa.array(values, to))
            return out.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).append_column("__left", pa.array(left, pa.bool_()))

        return packed

    done, round_no, open_ = [], 0, written(pieces)
    while True:
        blocks = max(1, -(-open_.count() // block))
        round_no += 1
        dealt = open_.withColumn("__block", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_no)), F.lit(blocks)))
        got = written(dealt.groupBy("__block").applyInArrow(packer(round_no, blocks == 1), schema))
        done.append(got.where("not __left").drop("__left"))
        if blocks == 1:
            break
        open_ = got.where("__left").select(columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def cost_balanced_packing(docs: DataFrame, vocabulary: str, size: int = SIZE, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Pack all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    Each document is its ids and the id 0; null and empty texts are that id alone. A document longer than a sequence begins
    with full pieces, each a sequence of its own; the rest is packed by cost and cut only where no room is left for it whole.
    All sequences are full but at most one of each power of two, so none needs padding. Repeated rows and null ids give
    pieces of their own. An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    encoded = written(tokens_of(docs, vocabulary, size))
    facts = ["doc_id", "doc_tokens"]
    whole = encoded.select(*facts, F.posexplode("whole").alias("__k", "ids_crc32")).select(
        *facts, (F.col("__k").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    tails = encoded.select("__row", *facts, "tail_crc32", (F.octet_length("tail") / 2).cast("long").alias("length")).where("length > 0")
    parts = place(tails.select(F.col("__row").alias("row"), *facts, "tail_crc32", F.col("length").alias("tail_tokens"), F.lit(0).cast("long").alias("start"), "length"), size, width, block)
    uncut = F.col("length") == F.col("tail_tokens")
    at = (F.col("doc_tokens") - F.col("tail_tokens") + F.col("start")).alias("start")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    as_they_were = parts.where(uncut).select(*facts, at, "length", F.col("tail_crc32").alias("ids_crc32"), "sequence_id", "offset")
    cut = parts.where(~uncut).join(encoded.select(F.col("__row").alias("row"), "tail"), "row")
    cut = cut.select(*facts, at, "length", F.arrow_udf(_crc_within, "long")("tail", "start", "length").alias("ids_crc32"), "sequence_id", "offset")
    return whole.select(*out).unionByName(as_they_were.select(*out)).unionByName(cut.select(*out))
