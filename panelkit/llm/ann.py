"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample of vectors is cut into parts of equal size that keep neighbours together. A small
network learns from it in which part a vector's neighbours lie; every row is stored in its most probable part, and a query
visits as many of its most probable parts as the sample needs for the wanted recall. What it meets there is ranked by the
exact inner product in double precision.
"""
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import prepare, written

K = 20
#: Distinct vectors from which partitions are learned (fewer are searched exactly).
FEW = 256
#: Most rows that a part is to hold, most parts, sampled vectors for each part and at most, neighbours in the graph.
PART, MOST_PARTS, PER_PART, SAMPLE, DEGREE = 4096, 256, 512, 16384, 10
#: Recall that the sample must reach with the parts visited.
RECALL = 0.97
#: Vectors and queries that meet in one task.
BLOCK, QUERIES = 1 << 15, 8192


def graph(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """The nearest rows of each row by inner product, block by block."""
    n = len(x)
    degree = min(degree, n - 1)
    out = np.empty((n, degree), np.int64)
    for a in range(0, n, 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, degree - 1, axis=1)[:, :degree] if degree else 0
    return out


def balanced_parts(near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Equal parts of a neighbour graph (parts: a power of two): repeated halving along the graph's smoothest vector, then
    exchanges across each cut that keep the balance and cut fewer edges."""
    n = len(near)
    rng = np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    sources = np.repeat(np.arange(n), near.shape[1])
    targets = near.ravel()
    degree = np.bincount(sources, minlength=n) + np.bincount(targets, minlength=n)

    def pull(v, inside):
        out = np.zeros(n)
        np.add.at(out, sources[inside], v[targets[inside]])
        np.add.at(out, targets[inside], v[sources[inside]])
        return out

    width = 1
    while width < parts:
        inside = label[sources] == label[targets]
        v = rng.standard_normal(n)
        for _ in range(40):                                  # smooth within every present part at once
            v = 0.5 * v + 0.5 * pull(v, inside) / np.maximum(degree, 1)
            size = np.maximum(np.bincount(label, minlength=width), 1)
            v -= (np.bincount(label, v, minlength=width) / size)[label]
            v /= np.sqrt(np.bincount(label, v * v, minlength=width) / size + 1e-300)[label]
        order = np.lexsort((v, label))
        rank = np.empty(n, np.int64)
        size = np.bincount(label, minlength=width)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        side = (rank >= size[label] // 2).astype(np.int64)
        for _ in range(8):                                   # pairs that both want to change sides change
            gain = pull(1.0 - 2.0 * side, inside) * (2 * side - 1)
            flip = np.zeros(n, bool)
            for p in range(width):
                zero = np.flatnonzero((label == p) & (side == 0))
                one = np.flatnonzero((label == p) & (side == 1))
                zero, one = zero[np.argsort(-gain[zero])], one[np.argsort(-gain[one])]
                m = min(len(zero), len(one))
                good = gain[zero[:m]] + gain[one[:m]] > 2
                take = int(np.argmin(good)) if not good.all() else m
                flip[zero[: take // 2]] = flip[one[: take // 2]] = True
            if not flip.any():
                break
            side[flip] ^= 1
        label = 2 * label + side
        width *= 2
    return label


@dataclass
class Router:
    """A network with one hidden layer over centred vectors; logits of the parts."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) * self.scale @ self.w1 + self.b1) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 40, seed: int = 7) -> Router:
    """target: for each row, how its neighbours (and itself) spread over the parts."""
    rng = np.random.default_rng(seed)
    d, p = x.shape[1], target.shape[1]
    mean = x.mean(axis=0)
    scale = 1 / max(float((x - mean).std()), 1e-12)
    z = (x - mean) * scale
    params = [rng.standard_normal((d, hidden)) / np.sqrt(d), np.zeros(hidden), rng.standard_normal((hidden, p)) / np.sqrt(hidden), np.zeros(p)]
    m, v = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), 256):
            i = order[a : a + 256]
            h = np.tanh(z[i] @ params[0] + params[1])
            s = h @ params[2] + params[3]
            s = np.exp(s - s.max(axis=1, keepdims=True))
            g = (s / s.sum(axis=1, keepdims=True) - target[i]) / len(i)
            back = (g @ params[2].T) * (1 - h * h)
            t += 1
            for k, grad in enumerate((z[i].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                params[k] = params[k] - 0.01 * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Router(mean, scale, *params)


@dataclass
class Index:
    router: Router | None
    parts: int
    visited: int


def build(sample: np.ndarray, parts: int, k: int = K, recall: float = RECALL) -> Index:
    """Graph, parts, router, and how many parts a query has to visit for the recall, all from the sample."""
    if parts <= 1 or len(sample) < 4 * parts:
        return Index(None, 1, 1)
    near = graph(sample)
    label = balanced_parts(near, parts)
    spread = np.zeros((len(sample), parts))
    np.add.at(spread, (np.repeat(np.arange(len(sample)), near.shape[1]), label[near].ravel()), 1.0)
    spread[np.arange(len(sample)), label] += near.shape[1] / 2
    router = train_router(sample, spread / spread.sum(axis=1, keepdims=True))
    logits = router.logits(sample)
    home = logits.argmax(axis=1)
    probe = np.arange(0, len(sample), max(1, len(sample) // 1024))
    rank = np.empty((len(probe), parts), np.int64)
    order = np.argsort(-logits[probe], axis=1)
    rank[np.arange(len(probe))[:, None], order] = np.arange(parts)
    k = min(k, len(sample) - 1)
    s = sample[probe] @ sample.T
    s[np.arange(len(probe)), probe] = -np.inf
    true = np.argpartition(-s, k - 1, axis=1)[:, :k]
    needed = np.sort(rank[np.arange(len(probe))[:, None], home[true]].ravel())
    return Index(router, parts, int(needed[min(int(np.ceil(recall * len(needed))), len(needed)) - 1]) + 1)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def usable(rows: DataFrame) -> DataFrame:
    """id and v of the vectors that take part: not null or empty, all components finite, one of them not zero."""
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0))


def part_size(n: int) -> int:
    """Rows that a part of n distinct vectors is to hold: eight times their root, so that several parts come of a few hundred."""
    return min(PART, 8 * math.isqrt(n)) if n >= FEW else FEW


def nearest(rows: DataFrame, every: int, k: int = K, part: int | None = None, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k nearest other rows found.

    rows: vec_id and embedding (an array of numbers); other columns are not read. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, and if lengths differ only those of the commonest length do. Equal
    vectors are one entry with the k + 1 least of their ids, which is all that an answer can name of them; scores are
    computed for each pair in the same way, so equal vectors tie and the smaller id goes first. Rows repeated with the same
    id count once. `part` is the rows a part is to hold; without it, it follows from the number of vectors. Only with fewer
    than FEW distinct vectors, or one part, the search is exact. An empty table gives no rows.
    """
    spark = prepare(rows.sparkSession)
    flat = usable(rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")))
    size = flat.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    flat = written(flat.where(F.size("v") == (size[0].d if size else 1)))
    few = Window.partitionBy("v").orderBy("id")
    first = flat.withColumn("__n", F.dense_rank().over(few)).where(F.col("__n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    entries = written(first)
    n = entries.count()
    part = part or part_size(n)
    parts = 1
    while parts < MOST_PARTS and parts * part < n:
        parts *= 2
    wanted = min(SAMPLE, PER_PART * parts)
    sample = entries.orderBy(F.xxhash64("v")).limit(wanted).select("v").toArrow() if parts > 1 else None
    index = build(_matrix(sample["v"]), parts, k, recall) if parts > 1 else Index(None, 1, 1)

    def routed(top: int):
        def choose(v: pa.Array) -> pa.Array:
            if index.router is None:
                return pa.array([[0]] * len(v), pa.list_(pa.int32()))
            order = np.argsort(-index.router.logits(_matrix(v)), axis=1, kind="stable")[:, :top]
            return pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))

        return F.arrow_udf(choose, "array<int>")

    stored = written(entries.select("v", "ids", routed(1)("v").getItem(0).alias("part")))
    queries = written(flat.where(F.col("id") % every == 0).select("id", "v", F.explode(routed(index.visited)("v")).alias("part")))
    # blocks of a part and of its queries: their numbers follow from the counts, at most `parts` of each
    held = {r.part: r.n for r in stored.groupBy("part").agg(F.count("*").alias("n")).collect()}
    asked = {r.part: r.n for r in queries.groupBy("part").agg(F.count("*").alias("n")).collect()}

    def pieces(counts: dict, most: int):
        known = spark.createDataFrame([(p, max(1, -(-c // most))) for p, c in counts.items()] or [(0, 1)], "part int, pieces int")
        return F.broadcast(known)

    stored = stored.join(pieces(held, BLOCK), "part").withColumn("block", F.pmod(F.xxhash64("v"), "pieces").cast("int")).drop("pieces")
    stored = stored.join(pieces(asked, QUERIES), "part").select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("chunk")).drop("pieces")
    queries = queries.join(pieces(asked, QUERIES), "part").withColumn("chunk", F.pmod(F.xxhash64("id"), "pieces").cast("int")).drop("pieces")
    queries = queries.join(pieces(held, BLOCK), "part").select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("block")).drop("pieces")

    def ranked(q: pa.Table, s: pa.Table) -> pa.Table:
        out = [], [], []
        if q.num_rows and s.num_rows:
            x, y = _matrix(q["v"]), _matrix(s["v"])
            names = s["ids"].to_pylist()
            mine = q["id"].to_pylist()
            top = min(k + 1, len(y))                         # the query's own entry may be one of them
            for a in range(0, len(x), 256):
                dots = x[a : a + 256] @ y.T
                edge = -np.partition(-dots, top - 1, axis=1)[:, top - 1]
                slack = 1e-9 * (1 + np.abs(edge))
                for i, row in enumerate(dots):
                    close = np.flatnonzero(row >= edge[i] - slack[i])
                    exact = (y[close] * x[a + i]).sum(axis=1)
                    found = sorted((-s_, name) for s_, j in zip(exact.tolist(), close.tolist(), strict=True) for name in names[j] if name != mine[a + i])[:k]
                    out[0].extend([mine[a + i]] * len(found))
                    out[1].extend(name for _, name in found)
                    out[2].extend(-s_ for s_, _ in found)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    key = ["part", "block", "chunk"]
    found = queries.groupBy(*key).cogroup(stored.groupBy(*key)).applyInArrow(ranked, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
