"""Token ids of a byte-level BPE vocabulary file of the tokenizers library.

The file's ids are in the order of its merges, so they are ranks, and a rank encoder gives the same ids several times faster
and without a cache. Texts with a special token's string, or with white space longer than the encoder's expression can step
back over, are encoded by the library itself.
"""
import os
import re
from array import array

import numpy as np

#: The vocabulary's pattern without needless steps back.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Characters of white space that are left to the library.
LONG = 20_000
_LONG_BLANK = re.compile(rf"\s{{{LONG}}}")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte = {ord(c): b for b, c in _byte_letters().items()}
        ranks = {t.translate(byte).encode("latin1"): i for t, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 16-bit numbers."""
        if any(s in text for s in self.special) or len(text) >= LONG and _LONG_BLANK.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        return array("H", self.ranked(text)).tobytes()


_ENCODERS: dict[str, ByteTokens] = {}


def byte_tokens(path: str) -> ByteTokens:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteTokens(path)
    return _ENCODERS[path]
