"""Cost-balanced packing: ids beside the library, whole coverage, no padding, balance, and edge cases."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import cost_packing as cp
from panelkit.llm import packing
from panelkit.llm.byte_tokens import LONG, ByteTokens

BYTE = P.path("byte_bpe_50k.json")


def test_ids_as_the_library():
    own, rng = ByteTokens(BYTE), random.Random(4)
    texts = ["".join(rng.choice("aB'sé ½9\n\t\r\x0b!?İΣ́😀ßtrevmldll'\x00\x7f~²ªɏŒ <|>\x85\xa0\x1c١中") for _ in range(rng.randrange(30))) for _ in range(5000)]
    for t in [*texts, "x <|endoftext|> y", "a" + " " * LONG + "b", "a" + "\n " * LONG + "b", "", "I'll we've 'S"]:
        assert np.frombuffer(own.encode(t), "<u2").tolist() == own.library.encode(t, add_special_tokens=False).ids


def dearest_first(lengths, rooms):
    """The rule itself, for lengths that always find a room: the cheapest sequence with room, the first of equals."""
    left, paid, out = list(rooms), [0] * len(rooms), [[] for _ in rooms]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        able = [k for k in range(len(rooms)) if left[k] >= lengths[i]]
        if not able:
            return None
        k = min(able, key=lambda k: (paid[k], k))
        out[k].append((i, 0, lengths[i]))
        left[k] -= lengths[i]
        paid[k] += cp.cost(lengths[i])
    return out


def test_rule():
    rng, same = random.Random(5), 0
    for _ in range(300):
        lengths = [rng.choice([1, 1, 2, 3, 8]) for _ in range(rng.randrange(1, 30))]
        rooms = cp.rooms_of(sum(lengths), 8, True)
        got, want = cp.balanced(lengths, rooms), dearest_first(lengths, rooms)
        assert [sum(n for *_, n in b) for b in got] == rooms
        covered = defaultdict(list)
        for i, start, n in (x for b in got for x in b):
            covered[i].append((start, n))
        for i, parts in covered.items():
            parts.sort()
            assert [a for a, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist() and sum(n for _, n in parts) == lengths[i]
        assert len(covered) == len(lengths)
        if want:
            same += 1
            assert Counter(tuple(sorted(n for *_, n in b)) for b in got) == Counter(tuple(sorted(n for *_, n in b)) for b in want)
    assert same > 50
    assert cp.rooms_of(0, 8, True) == [] and cp.rooms_of(21, 8, True) == [8, 8, 4, 1] and cp.rooms_of(21, 8, False) == [8, 8, 5]
    lengths = [min(int(rng.expovariate(1 / 300)) + 1, 1023) for _ in range(20_000)]
    bins = cp.balanced(lengths, cp.rooms_of(sum(lengths), 1024, True))
    costs = np.array([sum(cp.cost(n) for *_, n in b) for b in bins if sum(n for *_, n in b) == 1024])
    tightest = np.array([sum(cp.cost(lengths[i]) for i in b) for b in packing.best_fit(lengths, 1024)])
    assert costs.std() < tightest.std() and costs.max() < 1.1 * costs.mean() and costs.min() > 0.95 * costs.mean()


ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "no id here"), (4, "same text"), (4, "same text"), (5, "same text"), (6, "word " * 30_000), (7, "é😀 ́ \x00 <|endoftext|>")]


@pytest.mark.parametrize("block", [1 << 15, 50])
def test_packed(spark, block):
    rng = random.Random(6)
    docs = ODD + [(100 + i, " ".join(rng.choice(["ab", "the", "ü", "x."]) for _ in range(rng.randrange(90)))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("sequence_id", F.lit(1))
    rows = cp.cost_balanced_packing(df, BYTE, 64, block=block).collect()
    library, want, texts = Tokenizer.from_file(BYTE), Counter(), Counter((d, t or "") for d, t in docs)
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
    for (d, t), n in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        own = [r for r in parts[d] if r.doc_tokens == len(ids)]
        assert sum(r.length for r in own) == n * len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
        times = np.zeros(len(ids), int)
        for r in own:
            times[r.start : r.start + r.length] += 1
        assert (times == n).all()
        want[d] += n * len(ids)
    assert {d: sum(r.length for r in p) for d, p in parts.items()} == want
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    fills = []
    for places in inside.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
        fills.append(sum(n for _, n in places))
    short = [f for f in fills if f != 64]
    assert max(fills) == 64 and len(set(short)) == len(short) and all(f & (f - 1) == 0 for f in short)


def test_no_documents(spark):
    assert cp.cost_balanced_packing(spark.createDataFrame([], "doc_id long, text string"), BYTE).count() == 0
