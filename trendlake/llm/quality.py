"""Quality classifier: regularised quadratic discriminant analysis.

Each document is reduced to a few transformed statistics of its whole text.
Per class, mean and covariance come from moments summed over all labelled
training rows; the covariance is shrunk towards its diagonal and towards the
pooled one. The score is the logistic of the difference of the two Gaussian
log densities: Mahalanobis distances by Cholesky factors computed once.

Defined results: a null text counts as empty; an empty text is scored by its
(all zero) statistics; labels other than 0 and 1, or null, are not learned
from; without both classes among the training rows every score is the share of
label 1 there (0.5 without any); repeated rows are scored each; an empty table
gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, ship

FEATURES = ("log_words", "word_length", "upper", "symbols", "digits", "spaces", "distinct",
            "echo", "line_repeats", "sentences", "symbol_words", "top_word", "bars", "bangs")
TO_DIAGONAL, TO_POOLED, RIDGE = 0.1, 0.1, 1e-2

# Character classes of the first 256 code points; those beyond count as letters.
_LETTER, _DIGIT, _SPACE, _SYMBOL = range(4)
_CLASS = np.array([_LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit()
                   else _SPACE if chr(c).isspace() else _SYMBOL for c in range(256)] + [_LETTER])


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_CLASS[np.minimum(codes, 256)], minlength=4)
    lowered = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    upper = int((codes != lowered).sum()) if len(codes) == len(lowered) else sum(map(str.isupper, text))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    echo = sum(a == b for a, b in zip(words, words[1:]))
    lines = text.split("\n")
    odd = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,")
    ends = sum(1 for w in words if w[-1] == ".")
    chars = len(codes)
    root = lambda x: math.sqrt(max(x, 0.0))
    return [math.log1p(n), math.log1p((chars - int(kinds[_SPACE])) / n),
            root(upper / max(1, int(kinds[_LETTER]))), root(int(kinds[_SYMBOL]) / chars),
            root(int(kinds[_DIGIT]) / chars), root(int(kinds[_SPACE]) / chars),
            math.log1p(len(counts)) / math.log1p(n), root(echo / n),
            root(1 - len(set(lines)) / len(lines)), root(ends / n), root(odd / n),
            root(max(counts.values()) / n), root(text.count("|") / n), root(text.count("!") / n)]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc`` and ``x`` (array of double)."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc", "x"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc {id_type}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means and inverse Cholesky factors of both classes."""
    offset: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None   # inverse lower factors
    log_norms: tuple[float, float]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        z = (x - self.offset) / self.scale
        density = [norm - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
                   for mean, factor, norm in zip(self.means, self.factors, self.log_norms)]
        margin = density[1] - density[0]
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label (column ``y``): count, sum and sum of outer products of ``x``,
    summed by Spark; what reaches the driver is of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y = np.array(batch.column(0).to_pylist())
            x = np.array(batch.column(1).to_pylist(), dtype=float)
            one = np.hstack([np.ones((len(x), 1)), x])
            for label in (0, 1):
                part = one[y == label]
                total[label] = total.get(label, 0) + part.T @ part
        for label, m in total.items():
            flat = np.asarray(m).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()),
                 pa.array(flat)], names=["y", "i", "v"])

    summed = (rows.select("y", "x").mapInArrow(run, "y int, i int, v double")
              .groupBy("y", "i").agg(F.sum("v").alias("v")).collect())
    d = len(FEATURES) + 1
    out = {}
    for label in (0, 1):
        m = np.zeros(d * d)
        for r in summed:
            if r.y == label:
                m[r.i] = r.v
        m = m.reshape(d, d)
        out[label] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


def fit(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> Discriminant:
    """Fit on all rows of ``labels`` (already restricted to training rows)."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("y"))
    m = moments(stats.join(known, "doc"))
    n = [m[k][0] for k in (0, 1)]
    d = len(FEATURES)
    if min(n) < 2:
        prior = n[1] / sum(n) if sum(n) else 0.5
        return Discriminant(np.zeros(d), np.ones(d), None, None, (0.0, 0.0), prior)
    total = sum(n)
    offset = (m[0][1] + m[1][1]) / total
    spread = np.diag(m[0][2] + m[1][2]) / total - offset ** 2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    scale[scale < 1e-5] = 1.0
    means, covariances = [], []
    for k in (0, 1):
        mean = m[k][1] / n[k]
        covariance = m[k][2] / n[k] - np.outer(mean, mean)
        means.append((mean - offset) / scale)
        covariances.append(covariance / np.outer(scale, scale))
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / total
    factors, norms = [], []
    for k in (0, 1):
        c = (1 - TO_POOLED) * covariances[k] + TO_POOLED * pooled
        c = (1 - TO_DIAGONAL) * c + TO_DIAGONAL * np.diag(np.diag(c)) + RIDGE * np.eye(d)
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.solve(lower, np.eye(d)))
        norms.append(math.log(n[k] / total) - float(np.log(np.diag(lower)).sum()))
    return Discriminant(offset, scale, tuple(means), tuple(factors), tuple(norms), n[1] / total)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``stats`` with a column ``score`` in place of ``x``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema if f.name != "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            rest = [n for n in batch.schema.names if n != "x"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in rest), pa.array(model.scores(x))], names=[*rest, "score"])

    return stats.mapInArrow(run, f"{kinds}, score double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", modulus: int = 3,
             held_out: int = 1, threshold: float = 0.5, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Fit on the labelled rows of the other folds, score every document.
    Columns: id, ``held_out``, ``score``, ``predicted``."""
    stats = materialize(document_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, labels.where(fold(id_col, modulus) != held_out), label_col, id_col)
    return (score(stats, model)
            .select(F.col("doc").alias(id_col), (fold("doc", modulus) == held_out).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
