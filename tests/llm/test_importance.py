"""Importance resampling beside plain Python: features, weights, the selection among ties, and edge cases."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkit.llm import importance
from panelkit.llm.common import utf8


def buckets_of(text, n_buckets=10_000):
    body = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", body)
    return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % n_buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(docs, target):
    """doc_id, n_features, weight, score, rank by the definition."""
    source, wanted = Counter(), Counter()
    for _, t in docs:
        source.update(buckets_of(t)[1])
    for t in target:
        wanted.update(buckets_of(t)[1])
    s, t = sum(source.values()), sum(wanted.values())
    rows = []
    for i, text in docs:
        n, found = buckets_of(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1.0) * (s + 10000) / ((source[b] + 1.0) * (t + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((n, i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: 5 * len(able) // 100])}
    return Counter((i, f, w, x, drawn.get(id(r))) for r in rows for _, i, f, w, x in [r])


def test_features():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aBé 9.\n-zZ`{@[ſ") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["x" * 200 + " b " + "y" * 64 + " c " + "z" * 65 + "é", "", "one", ". .", "q" * 200_000]
    runs, n_words = importance.features(*utf8(pa.array(texts)))
    for k, text in enumerate(texts):
        n, want = buckets_of(text)
        got = [b for found, place in runs for b in found[place == k].tolist()]
        assert n_words[k] == n and got == want


def test_resample(spark):
    rng = random.Random(2)
    words = ["ab", "Cd", "é", "the", "x9", "long" * 30, "ﬀ", "Ünder"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(1000, 1060)] + [(5000, "tie " * 25)] * 40 + [(None, "tie " * 25)] * 40 + [(6000, None), (6001, ""), (6002, " \n"), (6003, "word " * 100_000)]
    target = [None, "", "the x9 é", "ab ab ab Cd"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(0))
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    got = Counter(map(tuple, importance.resample(df, bench).select(columns).collect()))
    assert got == resampled(docs, target)
    assert Counter(map(tuple, importance.resample(df, bench.where("false")).select(columns).collect())) == resampled(docs, [])
    assert importance.resample(df.where("false"), bench).count() == 0
    few = importance.resample(df.where("doc_id < 15"), bench).collect()                      # nothing to draw
    assert few and all(r["rank"] is None for r in few)


@pytest.mark.parametrize("pivots", [1, 2, 15])
def test_kth_among_ties(spark, pivots):
    rng = random.Random(3)
    keys = [(rng.choice([1, 1, 1, 1, 2, 5]), i) for i in range(400)]
    df = spark.createDataFrame(keys, "a long, b long")
    for k in (1, 2, 199, 320, 400):
        assert importance.kth_key(df, ["a", "b"], k, pivots, seed=k) == sorted(keys)[k - 1]
