"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Every document becomes a short vector of transformed statistics. Class means and covariances come from sums that Spark
adds up over all labelled rows; covariances are shrunk towards a scaled identity (oracle approximating shrinkage) and
factored once. A score is the difference of two Mahalanobis log-densities.
"""
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, prepare, texts_of, written

#: Least shrinkage, and what is added to every variance.
LEAST_SHRINK, RIDGE = 0.01, 1e-3


def statistics(text: str) -> list[float]:
    """Transformed statistics of one text: logarithms of sizes, square roots of shares."""
    n = max(len(text), 1)
    words = text.split()
    k = max(len(words), 1)
    distinct = len(set(words))
    same = sum(map(str.__eq__, words, words[1:])) if k > 1 else 0
    lower = text.lower()
    upper = sum(map(str.isupper, words))
    lines = text.split("\n")
    symbols = sum(map(text.count, "#*$%&<>@^~=+{}[]\\/"))
    stops = sum(map(text.count, ".,;:?"))
    bars, bangs = text.count("|"), text.count("!")
    digits = sum(map(text.count, "0123456789"))
    letters = len(set(lower))
    chars = sum(map(len, words))
    longest = max(map(len, words), default=0)
    short = sum(1 for w in words if len(w) <= 3)
    titled = sum(map(str.istitle, words))
    root = np.sqrt
    return [
        np.log1p(len(text)), np.log1p(k), chars / k / 10, np.log1p(longest), root(distinct / k), root(same / k), root(upper / k),
        root(titled / k), root(short / k), root(symbols / n), root(stops / n), root(bars / n), root(bangs / n), root(digits / n),
        root(len(lines) / k), len(set(lines)) / len(lines), np.log1p(letters), root((len(text) - chars) / n),
    ]


N_STATISTICS = len(statistics(""))


def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([[float(x) for x in statistics(t)] for t in texts_of(texts)], pa.list_(pa.float64()))


def document_statistics(text: Column) -> Column:
    """The statistics of a text column; null counts as the empty text."""
    prepare()
    return F.arrow_udf(lean(_statistics), "array<double>")(text)


@dataclass
class Model:
    """Class means and inverted Cholesky factors, one per class 0 and 1; `constant` when a class has no labels."""

    means: np.ndarray
    inverse_factors: np.ndarray
    log_parts: np.ndarray
    constant: float | None = None

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.inverse_factors[c].T
            logs.append(self.log_parts[c] - 0.5 * (z * z).sum(axis=1))
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; asinh keeps far rows apart where a plain logistic would round to 1."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.arcsinh(self.log_odds(x))))


def shrunk(cov: np.ndarray, n: float) -> np.ndarray:
    """Oracle approximating shrinkage of a covariance towards its mean variance."""
    d = len(cov)
    trace, square = np.trace(cov), (cov * cov).sum()
    top, bottom = (1 - 2 / d) * square + trace**2, (n + 1 - 2 / d) * (square - trace**2 / d)
    alpha = 1.0 if bottom <= 0 else min(1.0, max(LEAST_SHRINK, top / bottom))
    return (1 - alpha) * cov + (alpha * trace / d + RIDGE) * np.eye(d)


def fit(rows: DataFrame, features: str = "features", label: str = "label") -> Model:
    """Fit on all rows with label 0 or 1. Only sums leave the executors: 2 x (1 + d + d x d) numbers."""
    d = N_STATISTICS

    def sums(batches):
        total = {}
        for b in batches:
            x = np.array(b.column(0).to_pylist(), float).reshape(-1, d)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = np.hstack([np.ones((int((y == c).sum()), 1)), x[y == c]])
                total[c] = total.get(c, 0) + own.T @ own
        if total:
            at = np.arange((d + 1) ** 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(total), len(at)), pa.int32()), pa.array(np.tile(at, len(total)), pa.int32()),
                 pa.array(np.concatenate([total[c].ravel() for c in total]), pa.float64())], ["c", "at", "v"])

    used = rows.select(features, F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    got = used.mapInArrow(lean(sums), "c int, at int, v double").groupBy("c", "at").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((2, (d + 1) ** 2))
    for r in got:
        m[r.c, r.at] = r.v
    m = m.reshape(2, d + 1, d + 1)
    n = m[:, 0, 0]
    if not n.all():
        return Model(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), 0.5 if not n.any() else float(n[1] > 0))
    means, factors, logs = [], [], []
    for c in (0, 1):
        mean = m[c, 0, 1:] / n[c]
        lower = np.linalg.cholesky(shrunk(m[c, 1:, 1:] / n[c] - np.outer(mean, mean), n[c]))
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(n[c] / n.sum()) - np.log(np.diag(lower)).sum())
    return Model(np.array(means), np.array(factors), np.array(logs))


def score(model: Model, features: Column) -> Column:
    """The quality score of a feature column, by a model that holds a few matrices."""

    @F.arrow_udf("double")
    @lean
    def scored(x: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array(x.to_pylist(), float).reshape(-1, N_STATISTICS)))

    return scored(features)


def quality_scores(docs: DataFrame, labels: DataFrame, keep) -> DataFrame:
    """docs' columns `keep` and a column `score`; labels: doc_id and label, of the rows to learn from.

    Null and empty texts have the statistics of the empty text. Labels other than 0 and 1, or for unknown documents, are
    left out; several labels of one document all count. Without labels every score is 0.5, with one class only it is that
    class. Rows are scored one by one, so repeats and ties agree. Columns other than doc_id, text and `keep` are not read;
    a column of docs named `score` or `features` must not be among `keep`.
    """
    rows = written(docs.select(*keep, F.col("doc_id").alias("__id"), document_statistics(F.col("text")).alias("features")))
    learn = rows.select("__id", "features").join(labels.select(F.col("doc_id").alias("__id"), "label"), "__id")
    return rows.select(*keep, score(fit(learn), F.col("features")).alias("score"))
