"""Quality rules by compression bands.

Repetitive text compresses too well and noise too badly. A text's zstandard ratio (bytes by compressed bytes) must
lie in a band that depends on its length; then its fixed chunks are compressed one by one, and a text with too many
chunks outside the band of their own length is rejected as well, so that a long text cannot hide a repetitive half.
"""
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.llm.common import lean, prepare, texts_of

#: log2 of the bytes, least and greatest ratio of ordinary text there; linear in between, constant outside.
BANDS = [
    (4, 0.35, 1.30), (5, 0.50, 1.40), (6, 0.65, 1.70), (7, 0.80, 2.20), (8, 0.95, 2.25), (9, 1.10, 2.35), (10, 1.20, 2.45),
    (11, 1.25, 2.55), (12, 1.28, 2.65), (13, 1.30, 2.75), (14, 1.30, 2.85), (15, 1.30, 2.95), (16, 1.30, 3.10), (18, 1.30, 3.40),
]
LEVEL = 3
CHUNK = 4096
#: A text is rejected when more than this share of its chunks is outside their band.
BAD_CHUNKS = 0.25
MIN_WORDS = 50
MAX_REPEAT = 50
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks int, n_bad_chunks int, kept boolean"
)


def in_band(n_bytes: int, ratio: float, bands=BANDS) -> bool:
    at = np.log2(max(n_bytes, 1))
    size, low, high = zip(*bands, strict=True)
    return bool(np.interp(at, size, low) <= ratio <= np.interp(at, size, high))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more; all its places count."""
    n = len(words)
    if n < 4:
        return 0
    number = dict(zip(words, range(n), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * n + ids[1:]
    if n >= 1 << 21:                       # three ids no longer fit 63 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def duplicate_lines(body: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = body.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += 1
        elif not line.isspace() and line:
            seen.add(line)
    return n


def measure(text: str, bands=BANDS, chunk: int = CHUNK, level: int = LEVEL, z=None) -> tuple:
    """One text's statistics and verdict, in the order of SCHEMA."""
    body = text.encode("utf-8", "surrogatepass")
    words = body.split()                   # bytes split exactly at 0x20 and 0x09 to 0x0D
    n = len(words)
    word_chars = len(text) - (len(body) - len(body.translate(None, SPACE)))
    n_symbols = len(body) - len(body.translate(None, SYMBOLS))
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT * n
    z = z or zstandard.ZstdCompressor(level=level)
    ratio = len(body) / len(z.compress(body)) if body else 0.0
    n_chunks = -(-len(body) // chunk)
    whole = bool(body) and in_band(len(body), ratio, bands)
    if n_chunks > 1:
        bad = 0
        for at in range(0, len(body), chunk):
            part = body[at : at + chunk]
            bad += not in_band(len(part), len(part) / len(z.compress(part)), bands)
    else:
        bad = int(bool(body) and not whole)
    kept = not failed and whole and bad <= BAD_CHUNKS * n_chunks
    return n, word_chars, n_symbols, duplicate_lines(body), repeat, failed, ratio, n_chunks, bad, kept


def _measured(texts: pa.Array) -> pa.Array:
    z = zstandard.ZstdCompressor(level=LEVEL)
    rows = [measure(t, z=z) for t in texts_of(texts)]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int32(), pa.int32(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def quality_bands(text: Column) -> Column:
    """A struct of SCHEMA for a text column.

    Null and empty texts have no word: base_failed, not kept, ratio 0. Repeated rows are judged one by one and alike;
    an empty table gives none. Other columns of the table are never read, so their names cannot clash. A text of any
    length is compressed whole, chunk by chunk.
    """
    prepare()
    return F.arrow_udf(lean(_measured), SCHEMA)(text)
