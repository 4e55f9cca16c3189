"""Byte-level BPE with vectorised pre-tokenisation.

Code points become classes by one table lookup. Where a contraction may begin depends on what stands before it, which
is a finite automaton with four states; every character is a transition function (four 2-bit targets in a byte), and
because composing functions is associative, a blocked scan gives the state at every place without a loop over
characters and without a regular expression. Slices between boundaries are merged once and cached.
"""
import base64
import functools
import hashlib
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.llm.common import prepare, row_blocks, texts_of

OTHER, LETTER, NUMBER, WHITE, SPACE, END = range(6)
#: Stands between texts; valid texts hold no surrogate.
_MARK = "\ud800"
#: Entries of the slice cache of a Python worker, characters scanned at once, and characters of a lane of the scan.
CACHED, SCANNED, LANE = 700_000, 2 << 20, 256
#: The characters with the Unicode property White_Space but for the space.
_WHITE = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States: 0 a contraction may begin, 1 it may not (in punctuation or after a space), 2 and 3: one and two letters of a
# contraction are still to come. Functions: the target of state s in bits 2s and 2s + 1.
_IDENTITY = 0b11100100


def _function(from_free: int, from_bound: int) -> int:
    return from_free | from_bound << 2 | 0 << 4 | 2 << 6


_KEEP, _BIND, _ONE, _TWO, _RESET = _function(0, 0), _function(1, 1), _function(2, 1), _function(3, 1), 0
_BY_CLASS = np.array([_BIND, _KEEP, _KEEP, _KEEP, _BIND, _RESET], np.uint8)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point; composition of any two functions (first, then second)."""
    classes = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            classes[cp] = LETTER
        elif kind == "N":
            classes[cp] = NUMBER
    classes[_WHITE] = WHITE
    classes[32] = SPACE
    classes[ord(_MARK)] = END
    first, second = np.divmod(np.arange(65536), 256)
    both = np.zeros(65536, np.int64)
    for s in range(4):
        both |= (second >> 2 * (first >> 2 * s & 3) & 3) << 2 * s
    return classes, both.astype(np.uint8)


def _states_before(f: np.ndarray) -> np.ndarray:
    """The automaton's state before each character, from state 0: a blocked scan by composition."""
    compose = _tables()[1]
    n = len(f)
    lanes = -(-n // LANE)
    if lanes <= 1:
        state, out = 0, np.empty(n, np.uint8)
        for i, x in enumerate(f.tolist()):
            out[i] = state
            state = x >> 2 * state & 3
        return out
    grid = np.full(lanes * LANE, _IDENTITY, np.uint8)
    grid[:n] = f
    grid = np.ascontiguousarray(grid.reshape(lanes, LANE).T)
    so_far = np.full(lanes, _IDENTITY, np.uint16)
    before = np.empty((LANE, lanes), np.uint8)
    for c in range(LANE):
        before[c] = so_far
        so_far = compose[so_far << 8 | grid[c]].astype(np.uint16)
    start = _states_before(so_far.astype(np.uint8))
    return ((before >> 2 * start[None, :]) & 3).T.reshape(-1)[:n]


def boundaries(points: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens among code points; texts are separated and ended by the mark, itself a slice."""
    kind = _tables()[0][points]
    n = len(points)
    ahead = np.concatenate([points[1:], np.zeros(2, points.dtype)])
    one, two = ahead[:n], ahead[1 : n + 1]
    f = _BY_CLASS[kind]
    quote = points == 39
    single = quote & ((one == 115) | (one == 116) | (one == 109) | (one == 100))
    double = quote & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
    f = np.where(single, np.uint8(_ONE), np.where(double, np.uint8(_TWO), f))
    state = _states_before(f)
    begins = (single | double) & (state == 0)
    inside = state >= 2
    after = np.zeros(n, bool)                               # right after a contraction's last letter
    after[1:] = state[:-1] == 2
    was = np.concatenate([[END], kind[:-1]]).astype(np.uint8)
    blank, was_blank = (kind == WHITE) | (kind == SPACE), (was == WHITE) | (was == SPACE)
    follows = np.concatenate([kind[1:], [END]])
    next_text = (follows != WHITE) & (follows != SPACE) & (follows != END)
    start = np.where(blank, ~was_blank | next_text, (kind != was) & (was != SPACE))
    start |= after | begins | (kind == END) | (was == END)
    start &= ~inside
    return np.flatnonzero(start)


class ByteEncoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for b, i in self.ranks.items():
            self.bytes[i] = b
        self.names = [str(i) for i in range(len(self.bytes))]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.cache: dict[str, bytes] = {}

    def merge(self, body: bytes) -> list[int]:
        """Ids of one slice: the adjacent pair of least rank is joined, leftmost first, until none is known."""
        ranks = self.ranks
        if body in ranks:
            return [ranks[body]]
        if len(body) > 48:
            return self._merge_long(body)
        parts = [body[i : i + 1] for i in range(len(body))]
        scores = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            least = min(scores)
            if least == 1 << 40:
                break
            i = scores.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 40)
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 40)
        return [ranks[p] for p in parts]

    def _merge_long(self, body: bytes) -> list[int]:
        """The same with a heap and links, for slices of any length."""
        ranks, n = self.ranks, len(body)
        end = list(range(1, n + 1))                         # end of the part that begins here; 0: none does
        before = list(range(-1, n))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(body[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if not end[i] or end[i] >= n or not end[end[i]] or end[end[i]] - i != size:
                continue
            j = end[i]
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                k = end[end[i]]
                if (r := ranks.get(body[i:k])) is not None:
                    heapq.heappush(heap, (r, i, k - i))
            if before[i] >= 0:
                k = before[i]
                if (r := ranks.get(body[k : end[i]])) is not None:
                    heapq.heappush(heap, (r, k, end[i] - k))
        out, i = [], 0
        while i < n:
            out.append(ranks[body[i : end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, texts scanned together in blocks."""
        out: list[np.ndarray] = []
        cache = self.cache
        sizes = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        for a, b in row_blocks(sizes, SCANNED):
            joined = _MARK.join(texts[a:b]) + _MARK
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = boundaries(points)
            cuts = [*starts.tolist(), len(points)]
            slices = [joined[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
            for s in set(slices).difference(cache):
                cache[s] = b"" if s == _MARK else np.array(self.merge(s.encode()), "<u4").tobytes()
            ids = list(map(cache.__getitem__, slices))
            at = np.searchsorted(starts, sizes[a : b + 1] - sizes[a]).tolist()
            out += [np.frombuffer(b"".join(ids[x:y]), "<u4") for x, y in zip(at, at[1:], strict=False)]
            if len(cache) > CACHED:
                cache.clear()
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token begins, and the length of the whole: n + 1 numbers."""
        return np.concatenate([[0], np.cumsum(self.sizes[ids])])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


@functools.cache
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each Python worker and vocabulary."""
    return ByteEncoder(path)


def byte_tokens(text: Column, vocabulary: str) -> Column:
    """A struct of ids and byte offsets (one more than ids) for a text column; null is the empty text, without tokens."""

    prepare()

    @F.arrow_udf("ids array<int>, offsets array<long>")
    def tokens(texts: pa.Array) -> pa.Array:
        e = byte_encoder(vocabulary)
        ids = e.encode(texts_of(texts))
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.list_(pa.int32())), pa.array([e.offsets(i) for i in ids], pa.list_(pa.int64()))], ["ids", "offsets"])

    return tokens(text)


def round_trip(text: Column, vocabulary: str) -> Column:
    """Encode, then decode the ids: n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256.

    Null and empty texts have no tokens. Each text is encoded whole and on its own, so repeated rows agree, and the other
    columns are not read. An empty table gives no rows.
    """

    prepare()

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        e = byte_encoder(vocabulary)
        n, names, decoded = [], [], []
        for ids in e.encode(texts_of(texts)):
            n.append(len(ids))
            names.append(hashlib.sha256(" ".join(map(e.names.__getitem__, ids.tolist())).encode()).hexdigest())
            decoded.append(hashlib.sha256(e.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(names, pa.string()), pa.array(decoded, pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
