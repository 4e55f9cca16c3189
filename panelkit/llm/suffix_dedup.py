"""Suffix-array dedup: bytes covered by a string of a given length that also starts elsewhere.

1. Anchors. Every window of LENGTH bytes names the place of its least k-gram hash; equal windows name the same place.
   Windows that share an anchor form a context, about 1.5 contexts to 400 bytes. Only (gram, digest) rows are shuffled.
2. Contexts whose whole text occurs twice are repeated as they are. What is left are contexts that share an anchor but
   differ: the ends of repeated passages.
3. For those, the suffixes at the anchor are sorted, rightwards and leftwards, by a mergesort whose comparisons find the
   common extension by binary search over prefix polynomial hashes, and verify it byte by byte. Adjacent common
   extensions decide for every window whether another one equals it.

A group of copies collapses in step 2 (counts are added up before the shuffle). An anchor with more than GROUP differing
contexts goes another, equally exact way: its windows are counted by digest, spread over all tasks.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, mix64, prepare, row_blocks, utf8, written
from panelkit.llm.rolling import Prefix
from panelkit.operators.spread import split_join
from panelkit.session import discard

LENGTH = 400
#: Bytes of a gram; with it, an anchor is chosen among LENGTH - GRAM + 1 places.
GRAM = 100
#: Differing contexts of one anchor that a task sorts.
GROUP = 20_000
#: Bytes scanned, and bytes of contexts sorted, at once.
SCANNED, SORTED = 1 << 20, 4 << 20
#: Bytes verified, and places of contexts in both orders counted, at once.
VERIFIED, COUNTED = 1 << 18, 1 << 18


def anchors(body: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Text number, gram hash, first and last window start, and place of every anchor in a block of texts."""
    n = len(body)
    empty = np.empty(0, np.int64)
    ends = offsets[1:]
    if n < length or not (np.diff(offsets) >= length).any():
        return empty, empty.astype(np.uint64), empty, empty, empty
    width = length - gram + 1
    hashes = mix64(Prefix(body).grams(gram))
    bits = np.uint64(n.bit_length())
    value = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)      # ties go to the leftmost place
    padded = np.full(-(-len(value) // width) * width + width, np.uint64(2**64 - 1))
    padded[: len(value)] = value
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    place = (np.minimum(back[:m], ahead[width - 1 : width - 1 + m]) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    change = np.zeros(n + 1, np.int64)
    long = np.diff(offsets) >= length
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, ends[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(change)[:m] > 0)
    place = place[starts]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    at = place[first]
    return np.searchsorted(offsets, starts[first], "right") - 1, hashes[at], starts[first], starts[last], at


class Suffixes:
    """Contexts one after another in a byte array, each with an anchor; extensions from the anchor in one direction."""

    def __init__(self, body: np.ndarray, start: np.ndarray, end: np.ndarray, anchor: np.ndarray, left: bool, exact: bool = False):
        self.body, self.anchor, self.left, self.exact = body, anchor, left, exact
        self.room = anchor - start if left else end - anchor
        self.hashes = None if exact else Prefix(body)

    def bytes_at(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The byte k steps from the anchor, or -1 beyond the context."""
        at = self.anchor[i] - 1 - k if self.left else self.anchor[i] + k
        ok = k < self.room[i]
        return np.where(ok, self.body[np.where(ok, at, 0)].astype(np.int16), np.int16(-1))

    def same(self, i: np.ndarray, j: np.ndarray, k: np.ndarray) -> np.ndarray:
        a, b = self.anchor[i], self.anchor[j]
        return self.hashes.of(a - k, a) == self.hashes.of(b - k, b) if self.left else self.hashes.of(a, a + k) == self.hashes.of(b, b + k)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes i and j, by binary search over hashes (or byte by byte)."""
        high = np.minimum(self.room[i], self.room[j])
        low = np.zeros_like(high)
        if self.exact:
            going = np.arange(len(i))
            while len(going):
                step = low[going]
                a, b = self.bytes_at(i[going], step), self.bytes_at(j[going], step)
                going = going[(a == b) & (a >= 0)]
                low[going] += 1
            return low
        while True:
            going = low < high
            if not going.any():
                return low
            middle = (low + high + 1) >> 1
            equal = self.same(i, j, np.where(going, middle, 0))
            low = np.where(going & equal, middle, low)
            high = np.where(going & ~equal, middle - 1, high)

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        k = self.common(i, j)
        a, b = self.bytes_at(i, k), self.bytes_at(j, k)
        return (a < b) | ((a == b) & or_equal)

    def verified(self, i: np.ndarray, j: np.ndarray, k: np.ndarray) -> bool:
        """Whether suffixes i and j really agree on k bytes each."""
        for x, y in row_blocks(np.concatenate([[0], np.cumsum(k)]), VERIFIED):
            n = k[x:y]
            own = np.repeat(np.arange(x, y), n)
            step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            if (self.bytes_at(i[own], step) != self.bytes_at(j[own], step)).any():
                return False
        return True

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within runs of equal `group` (given in order): bottom-up mergesort.

        A level merges neighbouring sorted runs of all groups at once: an element's place is its own rank plus its rank in
        the other run, found by binary search.
        """
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([first, [n]]))
        base, m = np.repeat(first, size), np.repeat(size, size)
        run = 1
        while run < (size.max() if n else 0):
            at = np.flatnonzero(m > run)
            inner = at - base[at]
            block = inner // run
            right = block % 2 == 1
            low = base[at] + (block ^ 1) * run
            high = np.minimum(low + run, base[at] + m[at])
            low = np.minimum(low, high)
            other = low.copy()
            while True:
                going = np.flatnonzero(low < high)
                if not len(going):
                    break
                middle = (low[going] + high[going]) >> 1
                before = self.less(order[middle], order[at[going]], right[going])
                low[going[before]] = middle[before] + 1
                high[going[~before]] = middle[~before]
            to = base[at] + (block & ~1) * run + inner % run + (low - other)
            merged = order.copy()
            merged[to] = order[at]
            order = merged
            run *= 2
        return order


def repeated_windows(body, start, end, anchor, first, last, group, length: int = LENGTH, exact: bool = False):
    """For contexts given in order of `group`: (context, low, high) ranges of window starts that another context holds too.

    first and last are each context's least and greatest window start; all are places in body.
    """
    n = len(start)
    here = np.concatenate([[False], group[1:] == group[:-1]])
    ranks = {}
    for left in (False, True):
        s = Suffixes(body, start, end, anchor, left, exact)
        order = s.sort(group)
        common = np.zeros(n, np.int64)
        j = np.flatnonzero(here)
        common[j] = s.common(order[j - 1], order[j])
        if not exact and not s.verified(order[j - 1], order[j], common[j]):
            return repeated_windows(body, start, end, anchor, first, last, group, length, exact=True)
        ranks[left] = order, common
    (by_right, right), (by_left, left) = ranks[False], ranks[True]
    least, most = anchor - last, anchor - first            # how far left of its anchor a window may begin
    heads = np.flatnonzero(~here)
    sizes = np.diff(np.concatenate([heads, [n]]))
    who, low, high = [], [], []
    two = heads[sizes == 2]
    for k in (0, 1):                                       # one pair: the window fits between both extensions
        c = two + k
        a, b = np.maximum(least[c], length - right[two + 1]), np.minimum(most[c], left[two + 1])
        ok = a <= b
        who.append(c[ok])
        low.append(anchor[c[ok]] - b[ok])
        high.append(anchor[c[ok]] - a[ok])
    for h, m in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        c = slice(h, h + m)
        r, f = right[c], left[c]
        bottom, top = int(least[c].min()), int(most[c].max())
        steps = np.unique(np.concatenate([[bottom], length - r[1:], f[1:] + 1]))
        steps = steps[(steps >= bottom) & (steps <= top)]  # between steps, the same contexts agree
        until = np.concatenate([steps[1:] - 1, [top]])
        some = max(1, COUNTED // m)                        # a step's contexts meet each other only
        for y in range(0, len(steps), some):
            step = steps[y : y + some]
            one = np.empty((len(step), m), np.int64)
            other = np.empty((len(step), m), np.int64)
            one[:, by_right[c] - h] = np.cumsum(r[None, :] < length - step[:, None], axis=1)
            other[:, by_left[c] - h] = np.cumsum(f[None, :] < step[:, None], axis=1)
            key = (np.arange(len(step))[:, None] * (m + 1) + one) * (m + 1) + other
            _, where, count = np.unique(key.ravel(), return_inverse=True, return_counts=True)
            again = (count[where.ravel()] > 1).reshape(key.shape)
            t, x = np.nonzero(again)
            x, t = x + h, t + y
            a, b = np.maximum(steps[t], least[x]), np.minimum(until[t], most[x])
            ok = a <= b
            who.append(x[ok])
            low.append(anchor[x[ok]] - b[ok])
            high.append(anchor[x[ok]] - a[ok])
    return np.concatenate(who), np.concatenate(low), np.concatenate(high)


def _anchor_rows(length: int, gram: int):
    def rows(batches):
        for batch in batches:
            body, offsets = utf8(batch.column(2))
            for x, y in row_blocks(offsets, SCANNED):
                part = body[offsets[x] : offsets[y]]
                raw = part.tobytes()
                text, key, a, b, at = anchors(part, offsets[x : y + 1] - offsets[x], length, gram)
                digests = np.frombuffer(b"".join(
                    hashlib.blake2b(raw[i : j + length], digest_size=16).digest() for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.int64).reshape(-1, 2)
                origin = offsets[x : y + 1][text] - offsets[x]
                take = pa.array(text + x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(key.astype(np.int64)), pa.array(digests[:, 0].copy()),
                     pa.array(digests[:, 1].copy()), pa.array(a - origin), pa.array((at - a).astype(np.int32)), pa.array((b - a).astype(np.int32))],
                    ["__d", "__id", "key", "x1", "x2", "a", "la", "lb"])

    return rows


def _context_rows(length: int):
    """The text of every context that has to be sorted, one row for each."""
    def rows(batches):
        for batch in batches:
            bodies = batch.column(2)
            out = {k: [] for k in ("__d", "__id", "key", "m", "a", "la", "lb", "single", "body")}
            for i, found in enumerate(batch.column(3).to_pylist()):
                wanted = [x for x in found or () if x["chosen"]]
                if not wanted:
                    continue
                raw = (bodies[i].as_py() or "").encode()
                d, doc = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for x in wanted:
                    out["__d"].append(d)
                    out["__id"].append(doc)
                    for k in ("key", "m", "a", "la", "lb"):
                        out[k].append(x[k])
                    out["single"].append(x["c"] == 1)
                    out["body"].append(raw[x["a"] : x["a"] + x["lb"] + length])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("__d", pa.int64()), ("__id", pa.int64()), ("key", pa.int64()), ("m", pa.int64()), ("a", pa.int64()), ("la", pa.int32()),
                ("lb", pa.int32()), ("single", pa.bool_()), ("body", pa.binary())]))

    return rows


def _sorted_rows(length: int):
    """Repeated window ranges of contexts that arrive ordered by key; a key's contexts are handled together."""
    def ranges(t: pa.Table):
        body, offsets = utf8(t["body"])
        a, la, lb, key = (t[c].to_numpy() for c in ("a", "la", "lb", "key"))
        start, end = offsets[:-1], offsets[1:]
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        who, low, high = repeated_windows(body, start, end, start + la, start, start + lb, group, length)
        ok = t["single"].to_numpy(zero_copy_only=False)[who]
        who, low, high = who[ok], low[ok], high[ok]
        take = pa.array(who)
        return pa.RecordBatch.from_arrays(
            [t["__d"].combine_chunks().take(take), t["__id"].combine_chunks().take(take), pa.array(low - start[who] + a[who]), pa.array(high - start[who] + a[who])],
            ["__d", "__id", "low", "high"])

    def rows(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < SORTED:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            key = t["key"].to_numpy()
            cut = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])      # the last key may go on
            if cut:
                yield ranges(t.slice(0, cut).combine_chunks())
            rest = pa.Table.from_batches(t.slice(cut).to_batches(), t.schema)
            held, size = rest.to_batches(), rest.nbytes if cut else 0
        if held:
            yield ranges(pa.Table.from_batches(held).combine_chunks())

    return rows


def _window_rows(length: int):
    """All windows of a crowded anchor's contexts, by digest."""
    def rows(batches):
        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(("__d", "__id", "key", "a", "la", "lb", "single", "body"))}
            for i, raw in enumerate(cols["body"]):
                n = cols["lb"][i] + 1
                h = np.frombuffer(b"".join(hashlib.blake2b(raw[k : k + length], digest_size=16).digest() for k in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols["__d"][i]] * n, pa.int64()), pa.array([cols["__id"][i]] * n, pa.int64()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()),
                     pa.array(np.arange(n) + cols["a"][i]), pa.array([cols["single"][i]] * n, pa.bool_())], ["__d", "__id", "h1", "h2", "at", "single"])

    return rows


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a list of [from, to) ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _of_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """`rows` with the facts of their (__d, __id), where there are any; a null id meets a null id."""
    key = F.struct("__id")
    return split_join(rows.withColumn("__key", key), facts.withColumn("__key", key).drop("__id"), ["__d", "__key"], "left").drop("__key")


def suffix_dedup(docs: DataFrame, keep: list[str], text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """docs' columns `keep` and a struct `removal`: n_bytes, n_removed, n_spans, spans, kept (binary), kept_sha256.

    Texts are UTF-8 bytes; null is empty. A byte goes if a string of `length` bytes that also starts elsewhere, in this
    row or any other, covers it; strings are judged on the input. Repeated rows are copies of one another, so texts of
    `length` bytes or more go whole; shorter texts stay. Null ids are allowed. Columns outside `keep`, text and doc_id are
    not read; `keep` must not hold a column named `removal` or beginning with `__`. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("__text"), F.col(doc_id).cast("long").alias("__id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("__d"))
    own = rows.select("__d", "__id", "__text").where(F.octet_length("__text") >= length)
    found = written(own.mapInArrow(lean(_anchor_rows(length, gram)), "__d long, __id long, key long, x1 long, x2 long, a long, la int, lb int"))
    twice = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    open_ = written(split_join(found, twice, ["key"], "left_semi"))
    discard(found)
    context = ["key", "x1", "x2", "la", "lb"]
    contexts = written(open_.groupBy(*context).agg(F.count("*").alias("c"), F.min(F.struct("__d", "__id", "a")).alias("__one")))
    many = contexts.groupBy("key").agg(F.count("*").alias("m"))
    facts = split_join(contexts, many, ["key"]).where("c > 1 or m > 1")
    told = split_join(open_, facts, context).select(
        "__d", "__id", F.struct("key", "a", "la", "lb", "c", "m", ((F.col("m") > 1) & F.struct("__d", "__id", "a").eqNullSafe(F.col("__one"))).alias("chosen")).alias("x"))
    # a set: repeated rows have the same contexts, so what is held is bounded by the text's own length
    per_doc = told.groupBy("__d", "__id").agg(F.collect_set("x").alias("__found"), F.count("*").alias("__all")) \
        .select("__d", "__id", "__found", (F.col("__all") > F.size("__found")).alias("__repeated"))
    joined = written(_of_rows(rows, per_doc))
    discard(open_)
    hit = joined.where("__found is not null")
    # repeated rows give the body of a context once
    again = hit.where("__repeated").where(F.exists("__found", lambda x: x["chosen"])).dropDuplicates(["__d", "__id"])
    bodies = written(hit.where("not __repeated").unionByName(again).select("__d", "__id", "__text", "__found").mapInArrow(lean(_context_rows(length)), "__d long, __id long, key long, m long, a long, la int, lb int, single boolean, body binary"))
    normal = bodies.where(F.col("m") <= group).drop("m")
    parts = normal.repartition("key").sortWithinPartitions("key").mapInArrow(lean(_sorted_rows(length)), "__d long, __id long, low long, high long")
    windows = bodies.where(F.col("m") > group).drop("m").mapInArrow(lean(_window_rows(length)), "__d long, __id long, h1 long, h2 long, at long, single boolean")
    common = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    crowded = windows.where("single").join(common, ["h1", "h2"]).select("__d", "__id", F.col("at").alias("low"), F.col("at").alias("high"))
    ranges = parts.unionByName(crowded).groupBy("__d", "__id").agg(F.collect_list(F.struct("low", "high")).alias("__ranges"))

    def removed(body: pa.Array, found: pa.Array, more: pa.Array) -> pa.Array:
        out = []
        for t, fs, rs in zip(body.to_pylist(), found.to_pylist(), more.to_pylist(), strict=True):
            raw = (t or "").encode()
            runs = merged([(f["a"], f["a"] + f["lb"] + length) for f in fs or () if f["c"] > 1] + [(r["low"], r["high"] + length) for r in rs or ()])
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            out.append({"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(runs), "spans": [{"start": a, "end": b} for a, b in runs],
                        "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary()), ("kept_sha256", pa.string())]))

    kind = "n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string"
    changed = _of_rows(hit, ranges).select(*keep, F.arrow_udf(lean(removed), kind)("__text", "__found", "__ranges").alias("removal"))
    body = F.coalesce(F.col("__text"), F.lit("")).cast("binary")
    same = joined.where("__found is null").select(*keep, F.struct(
        F.octet_length(body).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.lit(None).cast("array<struct<start: bigint, end: bigint>>").alias("spans"), body.alias("kept"), F.sha2(body, 256).alias("kept_sha256")).alias("removal"))
    return changed.unionByName(same)
