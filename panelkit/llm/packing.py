"""Best-fit packing with a swap-based local search.

Documents become pieces of at most `size` tokens. Pieces are dealt at random into blocks of bounded size; each block is
packed best-fit decreasing, then a local search exchanges pieces between underfull sequences (a move, one for one, two
for one, one for two), always raising the sum of squared fills, until no sequence has one left or no fewer sequences are
possible. What is still underfull in a block is dealt anew with that of other blocks. Only (id, length, checksum) rows are shuffled, never texts.
"""
import bisect
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, prepare, texts_of, written
from panelkit.llm.word_tokens import encoder, forget

SIZE = 2048
#: Pieces that one task packs, rounds of dealing leftovers anew, and the fill from which a sequence is left as it is.
BLOCK, ROUNDS, FULL = 1 << 15, 4, 0.995


def best_fit(lengths, size: int) -> list[list[int]]:
    """Best-fit decreasing: indexes of the pieces of each sequence. A bit set finds the tightest room at once."""
    rooms: dict[int, list[int]] = {}
    mask, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fitting = mask >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = size, len(bins)
            bins.append([i])
        left = room - n
        if left:
            rooms.setdefault(left, []).append(at)
            mask |= 1 << left
    return bins


class _Rooms:
    """For strings of pieces (by their summed length) in underfull sequences: the least sufficient room beside them.

    near[g, s] is the least room, g - s or more, of a sequence that holds pieces of length s, so what g could be given for
    is one row. It is kept up to date in place.
    """

    def __init__(self, size: int):
        kind = np.int32 if size < 1 << 14 else np.int64
        self.none = 4 * size
        self.near = np.full((size + 1, size + 1), self.none, kind)
        self.down = np.arange(size, 0, -1, dtype=kind)
        self.held: dict[tuple[int, int], dict[int, None]] = {}
        self.mask = [0] * (size + 1)                       # the rooms beside each length, as bits

    def put(self, s: int, room: int, k: int) -> None:
        held = self.held.setdefault((s, room), {})
        if not held:
            before = max((self.mask[s] & ((1 << room) - 1)).bit_length() - 1, 0)
            self.near[s + before + 1 : s + room + 1, s] = room
            self.mask[s] |= 1 << room
        held[k] = None

    def drop(self, s: int, room: int, k: int) -> None:
        held = self.held[s, room]
        del held[k]
        if not held:
            del self.held[s, room]
            self.mask[s] ^= 1 << room
            before = max((self.mask[s] & ((1 << room) - 1)).bit_length() - 1, 0)
            after = self.mask[s] >> room
            self.near[s + before + 1 : s + room + 1, s] = room + (after & -after).bit_length() - 1 if after else self.none

    def best(self, g: int, lacking: int) -> tuple[int, int, int]:
        """The gain, length and room of the best exchange for pieces of length g out of a sequence that lacks so much."""
        if g < 2:
            return 0, 0, 0
        moved = self.down[-(g - 1) :]
        row = self.near[g, 1:g]
        gain = moved * (lacking + moved - row)
        at = int(gain.argmax())
        return int(gain[at]), at + 1, int(row[at])


class _Search:
    """Underfull sequences by the lengths in them; every accepted step raises the sum of squared fills."""

    def __init__(self, bins: list[list[int]], size: int):
        self.size = size
        self.bins = {k: sorted(b) for k, b in enumerate(bins)}
        self.fill = {k: sum(b) for k, b in self.bins.items()}
        self.one, self.two = _Rooms(size), _Rooms(size)
        self.rooms: dict[int, dict[int, None]] = {}
        self.mask = 0
        for k in self.bins:
            self.enter(k)

    def enter(self, k: int) -> None:
        """Sequence k may receive pieces from now on; a full one can't."""
        room = self.size - self.fill[k]
        if not room:
            return
        for n in set(self.bins[k]):
            self.one.put(n, room, k)
        for s in {x + y for x, y in combinations(self.bins[k], 2)}:
            self.two.put(s, room, k)
        self.rooms.setdefault(room, {})[k] = None
        self.mask |= 1 << room

    def leave(self, k: int) -> None:
        room = self.size - self.fill[k]
        if not room:
            return
        for n in set(self.bins[k]):
            self.one.drop(n, room, k)
        for s in {x + y for x, y in combinations(self.bins[k], 2)}:
            self.two.drop(s, room, k)
        del self.rooms[room][k]
        if not self.rooms[room]:
            del self.rooms[room]
            self.mask ^= 1 << room

    def swap(self, a: int, give: tuple, b: int, take: tuple) -> None:
        """Sequence a, which has left, hands `give` to b and gets `take`."""
        self.leave(b)
        for x, y, moved in ((a, b, give), (b, a, take)):
            for n in moved:
                self.bins[x].remove(n)
                bisect.insort(self.bins[y], n)
            self.fill[x] -= sum(moved)
            self.fill[y] += sum(moved)
        self.enter(b)

    def step(self, a: int) -> bool:
        """A move out of sequence a, or the exchange that gains most, if there is one."""
        mine, lacking = self.bins[a], self.size - self.fill[a]
        single = dict.fromkeys(reversed(mine))
        for n in single:                                   # a move into the tightest room
            fits = self.mask >> n
            if fits:
                room = n + (fits & -fits).bit_length() - 1
                if lacking + n > room:
                    self.swap(a, (n,), next(iter(self.rooms[room])), ())
                    return True
        best = (0, 0, 0)
        for g, give in {**{x + y: (x, y) for x, y in combinations(mine, 2)}, **{n: (n,) for n in single}}.items():
            found = self.one.best(g, lacking)              # one or two of mine for one of theirs
            if found[0] > best[0]:
                best, given = found, give
        if best[0]:
            self.swap(a, given, next(iter(self.one.held[best[1:]])), best[1:2])
            return True
        for n in single:                                   # one of mine for two of one of theirs
            found = self.two.best(n, lacking)
            if found[0] > best[0]:
                best, given = found, (n,)
        if best[0]:
            b = next(iter(self.two.held[best[1:]]))
            self.swap(a, given, b, next(two for two in combinations(self.bins[b], 2) if sum(two) == best[1]))
        return best[0] > 0

    def run(self, least: int) -> list[list[int]]:
        """Pass over all underfull sequences, emptiest first, until a pass changes nothing or only `least` are left."""
        changed = True
        while changed and len(self.bins) > least:
            changed = False
            for a in sorted(self.fill, key=self.fill.get):
                if a not in self.bins or self.fill[a] == self.size:
                    continue
                self.leave(a)
                while self.bins[a] and self.step(a):
                    changed = True
                if self.bins[a]:
                    self.enter(a)
                else:
                    del self.bins[a], self.fill[a]
                    if len(self.bins) <= least:
                        break
        return list(self.bins.values())


def pack_block(lengths, size: int = SIZE) -> list[list[int]]:
    """Sequences of a bounded list of lengths, each a list of indexes. Memory grows with the square of `size`."""
    bins = best_fit(lengths, size)
    least = -(-sum(lengths) // size)
    if len(bins) <= least:
        return bins
    full = [b for b in bins if sum(lengths[i] for i in b) == size]
    rest = [b for b in bins if sum(lengths[i] for i in b) < size]
    pool: dict[int, list[int]] = {}                        # pieces of a length stand for one another
    for b in rest:
        for i in b:
            pool.setdefault(lengths[i], []).append(i)
    found = _Search([[lengths[i] for i in b] for b in rest], size).run(least - len(full))
    return full + [[pool[n].pop() for n in b] for b in found]


def pieces_of(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each document's ids and the end id."""
    prepare(docs.sparkSession)
    stop = np.array([end], "<u4").tobytes()

    def pieces(texts: pa.Array, encode) -> pa.Array:
        out = []
        for t in texts_of(texts):
            ids = encode(t) + stop
            out.append([
                {"piece": k, "start": at // 4, "length": min(len(ids) - at, 4 * size) // 4, "ids_crc32": zlib.crc32(ids[at : at + 4 * size])}
                for k, at in enumerate(range(0, len(ids), 4 * size))
            ])
        kind = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        return pa.array(out, pa.list_(kind))

    @F.arrow_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    @lean
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pieces(texts, encoder(vocabulary).encode)
        forget()

    return docs.select("doc_id", F.explode(cut(F.col("text"))).alias("p")).select("doc_id", "p.*")


def pack(pieces: DataFrame, size: int = SIZE, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """`pieces` (any columns, `length` from 1 to size) with sequence_id and offset.

    Every row is a piece of its own, repeated rows as well. Columns sequence_id, offset and those beginning with `__`
    must not be among the given ones.
    """
    prepare(pieces.sparkSession)
    columns = pieces.columns
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long, __left boolean"

    def packer(round_no: int, blocks: int):
        def packed(t: pa.Table) -> pa.Table:
            lengths = t["length"].to_pylist()
            at = t["__block"][0].as_py()
            order, seq, offset, left = [], [], [], []
            for k, b in enumerate(pack_block(lengths, size)):
                place = 0
                for i in b:
                    order.append(i)
                    seq.append((round_no << 56) | (at << 24) | k)
                    offset.append(place)
                    place += lengths[i]
                left += [blocks > 1 and round_no < rounds and place < FULL * size] * len(b)
            t = t.select(columns).take(pa.array(order, pa.int64()))
            return t.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).append_column("__left", pa.array(left, pa.bool_()))

        return packed

    pieces = written(pieces)
    done = [pieces.where(F.col("length") >= size).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    open_ = pieces.where(F.col("length") < size)
    for round_no in range(1, rounds + 1):
        n = open_.count()
        if not n:
            break
        blocks = -(-n // block)
        dealt = open_.withColumn("__block", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_no)), F.lit(blocks)))
        got = written(dealt.groupBy("__block").applyInArrow(lean(packer(round_no, blocks)), out_schema))
        done.append(got.where("not __left").drop("__left"))
        open_ = got.where("__left").select(columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def best_fit_packing(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone, a piece of length 1. Only documents longer than a sequence are cut, however
    long they are. Repeated rows and null ids give pieces of their own; ties go by place. An empty table gives no rows.
    Columns other than doc_id and text are not read.
    """
    return pack(pieces_of(docs, vocabulary, size), size)
