"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the sorted spans of its turns are intersected
with the sorted spans of its tokens by binary search. Control strings are tokens of their own, so a turn's span and its
tokens begin and end together. Control strings inside texts are escaped, reversibly: a backslash is doubled, and a
control string gets a backslash after its first character.
"""
import functools
import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import prepare

BEGIN, ROLE, TEXT, STOP = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (BEGIN, STOP, ROLE, TEXT)
#: Characters after which a long conversation is encoded and handed on; always at the end of a turn, where a control
#: string separates tokens anyway, so the tokens are those of the whole.
BLOCK = 1 << 20
_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in (*CONTROL, "<|endoftext|>")))
_UNESCAPE = re.compile(r"\\(.?)", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


@functools.cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROL])
    return t


def render(turns: list[tuple[str, str]], begin: bool = True) -> tuple[str, np.ndarray]:
    """The text of (role, text) turns, and the [start, end) span of every turn's text in it."""
    parts, spans, at = [BEGIN] if begin else [], [], len(BEGIN) if begin else 0
    for role, text in turns:
        head, body = f"{ROLE}{escape(role)}{TEXT}", escape(text)
        at += len(head)
        spans.append((at, at + len(body)))
        at += len(body) + len(STOP)
        parts += (head, body, STOP)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def token_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the sorted spans: two binary searches for each span."""
    change = np.zeros(len(offsets) + 1, np.int64)
    spans = spans[spans[:, 0] < spans[:, 1]]
    np.add.at(change, np.searchsorted(offsets[:, 0], spans[:, 0], "left"), 1)
    np.add.at(change, np.searchsorted(offsets[:, 1], spans[:, 1], "right"), -1)
    return np.cumsum(change[:-1]) > 0


def encode(text: str, spans: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, character offsets and mask of a rendered text."""
    e = _tokenizer(path).encode(text, add_special_tokens=False)
    offsets = np.fromiter(itertools.chain.from_iterable(e.offsets), np.int64, 2 * len(e)).reshape(-1, 2)
    return np.array(e.ids, np.int32), offsets, token_mask(offsets, spans)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays), kind))


def _arrays(lists: pa.Array) -> list[np.ndarray]:
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in itertools.pairwise(ends.tolist())]


def turns_of(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text, read back."""
    out = []
    for turn in rendered.removeprefix(BEGIN).split(STOP)[:-1]:
        role, _, text = turn.removeprefix(ROLE).partition(TEXT)
        out.append((unescape(role), unescape(text)))
    return out


def masked_texts(rendered: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text under each run of masked tokens, unescaped."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [unescape(rendered[offsets[a, 0] : offsets[b - 1, 1]]) for a, b in zip(edges[::2], edges[1::2], strict=True)]


BLOCKS = "conv_id long, block int, n_turns int, rendered string, ids array<int>, starts array<long>, ends array<long>, loss array<boolean>"


def format_conversations(rows: DataFrame, vocabulary: str, loss_role: str = "assistant", block: int = BLOCK) -> DataFrame:
    """Rendered and encoded conversations, from rows conv_id, turn, role, text: BLOCKS, ordered by conversation and block
    within a partition, a conversation in one partition. Short conversations are one block.

    Turns go by turn, then role and text (so ties and repeated rows have a place; all are kept), null turns first. Null
    roles and texts are empty; rows without conv_id are one conversation. Other columns are not read. An empty table gives
    no rows. A conversation of any length passes block by block, never whole.
    """
    prepare(rows.sparkSession)
    kind = pa.schema([("conv_id", pa.int64()), ("block", pa.int32()), ("n_turns", pa.int32()), ("rendered", pa.string()), ("ids", pa.list_(pa.int32())),
                      ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("loss", pa.list_(pa.bool_()))])

    def formatted(batches):
        conv, number, turns, size, out = object(), 0, [], 0, []

        def close():
            text, spans = render(turns, number == 0)
            own = np.array([r == loss_role for r, _ in turns], bool)
            ids, offsets, mask = encode(text, spans[own], vocabulary)
            out.append((conv, number, len(turns), text, ids, offsets[:, 0], offsets[:, 1], mask))

        def batch():
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([_lists(c, f.type.value_type) if pa.types.is_list(f.type) else pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], schema=kind)

        for b in batches:
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if turns and (c != conv or size >= block):
                    close()
                    number, turns, size = number + 1 if c == conv else 0, [], 0
                elif c != conv:
                    number = 0
                conv = c
                turns.append((role or "", text or ""))
                size += len(role or "") + len(text or "")
            if out:
                yield batch()
                out.clear()
        if turns:
            close()
            yield batch()

    ordered = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(formatted, BLOCKS)


def read_back(blocks: DataFrame) -> DataFrame:
    """Digests of each conversation, from the rendered text, offsets and masks alone (blocks as format_conversations gives
    them): conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens."""
    def digests(batches):
        conv, state = object(), None

        def row():
            return [conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5], state[6]]

        def batch(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for b in batches:
            out = []
            cols = [b.column(b.schema.get_field_index(n)) for n in ("conv_id", "block", "rendered", "starts", "ends", "loss")]
            cols = [_arrays(c) if pa.types.is_list(c.type) else c.to_pylist() for c in cols]
            for c, k, text, starts, ends, loss in zip(*cols, strict=True):
                if k == 0:
                    if state:
                        out.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                turns = turns_of(text)
                state[0] += len(turns)
                for role, body in turns:
                    state[1].update(f"{role}\n{body}\n".encode())
                mask = loss
                for t in masked_texts(text, np.stack([starts, ends], axis=1), mask):
                    state[2] += len(t)
                    state[3].update(t.encode())
                state[4] += len(text)
                state[5] += len(mask)
                state[6] += int(mask.sum())
            if out:
                yield batch(out)
        if state:
            yield batch([row()])

    return blocks.mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long")
