"""Token ids of a lower-casing word BPE, by the tokenizers library, with a cache of space-free pieces.

The vocabulary's rules never look across white space, so a text's ids are those of its space-separated pieces one after
another. Pieces are split into words and given to the library's model once, then remembered. Texts with characters
where library versions could differ, or with a special token's string, are encoded whole by the library.
"""
import os
import re
from array import array

import numpy as np
import regex

#: Space, printable ASCII, Latin-1 and Latin Extended but for U+0085, U+00A0, U+00AD and U+0130: stable under NFC.
_UNUSUAL = re.compile("[^\t\n\x0b\x0c\r -~\xa1-\xac\xae-įı-ɏ]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Entries of the caches; beyond that, words and pieces are encoded without being kept. A piece that is not kept costs
#: little as long as its words are.
CACHED_WORDS, CACHED_PIECES = 300_000, 100_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of words and of space-free pieces: a piece that is one lower-case word is found under that word, at the first look."""

    def __init__(self, word):
        self.word, self.words, self.pieces = word, CACHED_WORDS, CACHED_PIECES

    def __missing__(self, piece: str) -> bytes:
        low = piece.lower()
        if low.isalpha():
            parts = (low,)
        elif low[:-1].isalpha() and low[-1] in ".,;:!?":
            parts = (low[:-1], low[-1])
        else:
            parts = _WORD.findall(low)
        if len(parts) == 1 and parts[0] == piece:
            ids = self.word(piece)
            if self.words:
                self.words -= 1
                self[piece] = ids
            return ids
        ids = b"".join([self[p] for p in parts])
        if self.pieces:
            self.pieces -= 1
            self[piece] = ids
        return ids


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model, self.letters = self.library.model, _byte_letters()
        self.known = _Known(self._word)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if _UNUSUAL.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, text.split()))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Let go of what this worker's encoders remember: at the end of a task, or for a step that needs the memory."""
    for e in _ENCODERS.values():
        e.known = _Known(e._word)
