"""Weighted word shingles of many texts at once, as 64-bit numbers."""
import numpy as np

from panelkit.llm.common import mix64
from panelkit.llm.rolling import Prefix

WORDS = 5
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0xD1342543DE82EF95)


def shingles(body: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and weight (how often the text holds it), ordered by text and shingle.

    Words are runs of bytes other than white space. A text with fewer words than a shingle has one shingle of them all; a
    text without words has none.
    """
    n = len(body)
    blank = _IS_SPACE[body]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True                                    # a text's start or end also ends a word
    first = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | edge[:n])) if n else np.empty(0, np.int64)
    last = np.flatnonzero(~blank & (np.concatenate([blank[1:], [True]]) | edge[1:])) + 1 if n else np.empty(0, np.int64)
    empty = np.empty(0, np.int64)
    if not len(first):
        return empty, empty.astype(np.uint64), empty
    word = mix64(Prefix(body).of(first, last) ^ (last - first).astype(np.uint64) * _ODD)
    text = np.searchsorted(offsets, first, "right") - 1
    heads = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    count = np.diff(np.concatenate([heads, [len(text)]]))
    total = np.zeros(len(word), np.uint64)
    left = np.repeat(heads + count, count) - np.arange(len(word))          # words from here to the text's end
    for k in range(words):
        at = np.minimum(np.arange(len(word)) + k, len(word) - 1)
        total = np.where(left > k, mix64(total + word[at] + np.uint64(k + 1)), total)
    starts = (left >= words) | (np.arange(len(word)) == np.repeat(heads, count)) & (np.repeat(count, count) < words)
    text, total = text[starts], total[starts]
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (total[1:] != total[:-1])]))
    return text[new], total[new], np.diff(np.concatenate([new, [len(text)]]))
