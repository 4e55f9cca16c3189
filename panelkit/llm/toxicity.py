"""Toxicity by a subsequence string kernel and a support vector machine with Nyström landmarks.

Two words are alike when they share letter triples in order, gaps allowed at a price (a gap-weighted subsequence kernel,
normalised), so a word with letters inserted, left out or changed stays near its original. Landmarks are words that
labelled toxic sentences use far more often than clean ones. A sentence is described by its best match with every
landmark, mapped by the Nyström factor of the landmarks' kernel; a linear machine with squared hinge loss separates
sentences. A document's label holds for its worst sentence, which training finds anew in every round; its score is the
calibrated margin of that sentence.
"""
import functools
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import prepare, texts_of, written

#: Price of a gap, least similarity that counts, and the window that longer words are cut into (half overlapping).
DECAY, LEAST, WINDOW = 0.6, 0.45, 24
#: Labelled documents of each class to learn from (a bounded sample by hash of the id), and landmarks.
SAMPLE, LANDMARKS = 6000, 96
#: Least documents, least ratio of toxic to clean rates, and greatest likeness of two landmarks.
LEAST_DOCS, LEAST_RATIO, TOO_ALIKE = 3, 6.0, 0.92
#: Words remembered by a Python worker.
CACHED = 600_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_SPACED = re.compile(r"(?<!\S)(?:\w[^\w\n]{1,2}){3,}\w(?!\w)")


def plain(word: str) -> str:
    """Letters and digits of a word: signs put between letters go."""
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def joined_letters(text: str) -> list[str]:
    """Words whose letters are written apart."""
    return [plain(m) for m in _SPACED.findall(text)]


@functools.cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] - 2).astype(float)


def _features(word: str) -> dict[str, float]:
    at, price = _triples(len(word))
    out: dict[str, float] = {}
    for (i, j, k), w in zip(at.tolist(), price.tolist(), strict=True):
        key = word[i] + word[j] + word[k]
        out[key] = out.get(key, 0.0) + w
    return out


class Matcher:
    """Similarities of words to landmarks."""

    def __init__(self, landmarks: tuple[str, ...]):
        feats = [_features(z) for z in landmarks]
        self.letters = {c: i + 1 for i, c in enumerate(sorted({c for z in landmarks for c in z}))}
        self.size = size = len(self.letters) + 1
        codes = sorted({k for f in feats for k in f})
        self.row = np.zeros(size**3, np.int32)               # 0: no landmark has this triple
        self.weights = np.zeros((len(codes) + 1, len(landmarks)))
        for r, key in enumerate(codes, 1):
            a, b, c = (self.letters[x] for x in key)
            self.row[(a * size + b) * size + c] = r
        at = {key: r for r, key in enumerate(codes, 1)}
        for m, f in enumerate(feats):
            norm = np.sqrt(sum(v * v for v in f.values()))
            for key, v in f.items():
                self.weights[at[key], m] = v / norm
        self.most = self.weights.max(axis=1) if len(landmarks) else np.zeros(1)
        self.vectors: list[np.ndarray] = []
        self.known: dict[str, int] = {}

    def similar(self, words: list[str]) -> dict[str, np.ndarray]:
        """Words of 3 to WINDOW characters with a similarity of LEAST or more, and all their similarities."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        out = {}
        for n, same in by_size.items():
            at, price = _triples(n)
            least = np.sqrt((price * price).sum())           # no self-similarity is less
            for k in range(0, len(same), 4096):
                part = same[k : k + 4096]
                chars = np.array([[self.letters.get(c, 0) for c in w] for w in part], np.int64)
                rows = self.row[(chars[:, at[:, 0]] * self.size + chars[:, at[:, 1]]) * self.size + chars[:, at[:, 2]]]
                bound = (self.most[rows] * price).sum(axis=1) / least
                for i in np.flatnonzero(bound >= LEAST).tolist():
                    hit = rows[i] > 0
                    dots = price[hit] @ self.weights[rows[i][hit]]
                    if dots.max() / least < LEAST:
                        continue
                    own = np.sqrt(sum(v * v for v in _features(part[i]).values()))
                    if (v := dots / own).max() >= LEAST:
                        out[part[i]] = np.where(v >= LEAST, v, 0.0)
        return out

    def look_up(self, tokens: set[str]) -> dict[str, np.ndarray]:
        """Those of the tokens that resemble a landmark."""
        new = tokens.difference(self.known)
        fresh: dict[str, np.ndarray] = {}
        if new:
            words: dict[str, list[str]] = {}
            for t in new:
                w = plain(t)
                if len(w) >= 3:
                    words[t] = [w] if len(w) <= WINDOW else [w[i : i + WINDOW] for i in range(0, max(len(w) - WINDOW // 2, 1), WINDOW // 2)]
            found = self.similar(list({x for ws in words.values() for x in ws if len(x) >= 3}))
            for t, ws in words.items():
                vs = [found[x] for x in ws if x in found]
                if vs:
                    fresh[t] = np.max(vs, axis=0)
            if len(self.known) < CACHED:
                for t in new:
                    if t in fresh:
                        self.vectors.append(fresh[t])
                        self.known[t] = len(self.vectors) - 1
                    else:
                        self.known[t] = -1
        out = {t: self.vectors[k] for t in tokens if (k := self.known.get(t, -1)) >= 0}
        return out | fresh

    def sentences(self, text: str) -> np.ndarray:
        """Best matches of every sentence that resembles a landmark, one row each."""
        low = text.lower()
        apart = joined_letters(low) if text else []
        found = self.look_up(set(low.split()) | set(apart))
        if not found:
            return np.zeros((0, self.weights.shape[1]))
        out = []
        for s in _SENTENCE.split(low):
            own = [found[t] for t in {*s.split(), *joined_letters(s)} if t in found]
            if own:
                out.append(np.max(own, axis=0))
        return np.array(out).reshape(-1, self.weights.shape[1])


@functools.lru_cache(maxsize=4)
def matcher(landmarks: tuple[str, ...]) -> Matcher:
    return Matcher(landmarks)


@dataclass
class Model:
    landmarks: tuple[str, ...]
    map: np.ndarray            # Nyström factor
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, vectors: np.ndarray) -> float:
        """Of the worst sentence; sentences that resemble nothing have the margin `bias`."""
        return max([self.bias, *(vectors @ self.map @ self.weights + self.bias).tolist()]) if len(vectors) else self.bias

    def score(self, text: str) -> float:
        m = self.margin(matcher(self.landmarks).sentences(text)) if self.landmarks else self.bias
        return float(1 / (1 + np.exp(-(self.slope * m + self.shift))))


def choose_landmarks(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> tuple[str, ...]:
    """Words of (word, toxic documents, clean documents) that are much commoner in toxic ones, no two nearly the same."""
    scored = []
    for w, t, c in rows:
        rate, other = (t + 0.5) / (n_toxic + 1), (c + 0.5) / (n_clean + 1)
        if t >= LEAST_DOCS and rate >= LEAST_RATIO * other and 3 <= len(w) <= WINDOW:
            scored.append((-t * np.log(rate / other), w))
    out: list[str] = []
    norms: list[dict[str, float]] = []
    for _, w in sorted(scored):
        f = _features(w)
        size = np.sqrt(sum(v * v for v in f.values()))
        f = {k: v / size for k, v in f.items()}
        if all(sum(v * g.get(k, 0.0) for k, v in f.items()) < TOO_ALIKE for g in norms):
            out.append(w)
            norms.append(f)
        if len(out) == LANDMARKS:
            break
    return tuple(out)


def nystrom(landmarks: tuple[str, ...]) -> np.ndarray:
    m = matcher(landmarks)
    k = np.zeros((len(landmarks), len(landmarks)))
    for j, w in enumerate(landmarks):
        rows = [(m.row[(m.letters[a] * m.size + m.letters[b]) * m.size + m.letters[c]], v) for (a, b, c), v in _features(w).items()]
        own = np.sqrt(sum(v * v for _, v in rows))
        k[j] = sum(v * m.weights[r] for r, v in rows) / own
    value, vector = np.linalg.eigh((k + k.T) / 2)
    good = value > 1e-6
    return vector[:, good] / np.sqrt(value[good])


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Primal squared-hinge machine by Newton steps; y is -1 or 1."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * cost.sum())
    penalty[-1] = 1e-9
    for _ in range(50):
        on = y * (z @ w) < 1
        a = z[on] * cost[on, None]
        new = np.linalg.solve(a.T @ z[on] + np.diag(penalty), a.T @ y[on])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def train(docs: list[tuple[int, np.ndarray]], landmarks: tuple[str, ...]) -> Model:
    """From (label, matching sentences) of documents."""
    y = np.array([t for t, _ in docs], float)
    if not len(y) or y.min() == y.max() or not landmarks:
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model((), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    factor = nystrom(landmarks)
    mapped = [v @ factor if len(v) else np.zeros((1, factor.shape[1])) for _, v in docs]
    clean = np.concatenate([m for m, t in zip(mapped, y, strict=True) if t == 0])
    witness = [m[np.argmax((m * m).sum(axis=1))] for m, t in zip(mapped, y, strict=True) if t == 1]
    for _ in range(4):
        x = np.vstack([clean, np.array(witness)])
        side = np.concatenate([-np.ones(len(clean)), np.ones(len(witness))])
        cost = np.concatenate([np.full(len(clean), 1 / len(clean)), np.full(len(witness), 1 / len(witness))])
        w, b = svm(x, side, cost)
        witness = [m[np.argmax(m @ w)] for m, t in zip(mapped, y, strict=True) if t == 1]
    model = Model(landmarks, factor, w, b, 1.0, 0.0)
    margin = np.array([model.margin(v) for _, v in docs])
    slope, shift = 1.0, 0.0                                   # calibration: logistic regression on the margin
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        q = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - target) * margin).sum() + 1e-3 * slope, (p - target).sum()])
        h = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        d *= min(1.0, 2.0 / max(np.abs(d).max(), 1e-12))
        slope, shift = slope - d[0], shift - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return Model(landmarks, factor, w, b, float(max(slope, 1e-3)), float(shift))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """labels: doc_id and label (0 or 1) of the rows to learn from. At most `sample` documents of each class are used, those
    with the least hash of their id; their texts stay on the executors, which return word counts (the best few thousand
    words) and sentence vectors."""
    prepare(docs.sparkSession)
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = labels.where("label = 1").orderBy(order).limit(sample).union(labels.where("label = 0").orderBy(order).limit(sample))
    chosen = written(chosen)                                  # at most 2 x sample rows, so it may be broadcast
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text"))

    def words(batches):
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                own = sorted({w for x in t.lower().split() if len(w := plain(x)) >= 3})
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([y] * len(own), pa.int32())], ["w", "y"])

    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    counts = rows.mapInArrow(words, "w string, y int").groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    lift = (F.col("t") + 0.5) / (n_toxic + 1) / ((F.col("c") + 0.5) / (n_clean + 1))
    best = counts.where((F.col("t") >= LEAST_DOCS) & (lift >= LEAST_RATIO)).orderBy((-F.col("t") * F.log(lift)).asc(), "w").limit(4000).collect()
    landmarks = choose_landmarks([(r.w, r.t, r.c) for r in best], n_toxic, n_clean)

    def vectors(batches):
        m = matcher(landmarks)
        for b in batches:
            got = [m.sentences(t).astype(np.float32) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.unique(g, axis=0).tobytes() if len(g) else b"" for g in got], pa.binary())], ["y", "v"])

    got = rows.mapInArrow(vectors, "y int, v binary").collect() if landmarks else rows.select(F.col("label").alias("y"), F.lit(b"").alias("v")).collect()
    width = max(len(landmarks), 1)
    return train([(r.y, np.frombuffer(bytes(r.v), np.float32).astype(float).reshape(-1, width)) for r in got], landmarks)


def toxicity(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1.

    Whole texts are read. Null and empty texts score as a sentence that resembles nothing. Rows are scored one by one, so
    repeats and ties agree; other columns are not read. A model without labels, or with one class only, gives its smoothed
    rate to every row.
    """
    prepare()

    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in texts_of(texts)], pa.float64())

    return F.arrow_udf(scores, "double")(text)
