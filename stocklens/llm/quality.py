"""Quality scores by regularised quadratic discriminant analysis of document statistics.

Each whole text gives a short vector of statistics (lengths, shares of kinds of characters, repetition,
entropy), logarithms and square roots so that a class is closer to normal. Class means and covariances
come from sums over all labelled training rows, added up map-side, so what reaches the driver has
a fixed size. A class covariance is shrunk towards the pooled variances and given a floor; its
Cholesky factor is inverted once and cached in the model. A score is the logistic of the
log-density difference (Mahalanobis terms, log-determinants, log-priors).

Nulls and ties: a null text counts as empty and is scored; labels with a null doc_id or quality are left
out; repeated label rows count each. Without rows of both classes every score is 0.5.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import FOLD, held_out, staged, table, utf8

SHRINK, FLOOR, THRESHOLD = 0.1, 2e-3, 0.7
SYMBOLS = b"#$%&*+=@^~_<>{}[]/\\"


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of one text."""
    data = text or b""
    n = len(data)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    ws = data.translate(FOLD).split()
    lines = data.split(b"\n")
    k = len(ws)
    met = Counter(ws)
    repeated = n - sum(map(len, set(lines))) - len(lines) + 1 if len(lines) > 1 else 0
    share = count[count > 0] / max(n, 1)

    def part(x: float, of: float) -> float:
        return math.sqrt(max(x, 0) / (of + 5.0))

    return [math.log1p(k), math.log1p(n / (k + 1)), part(count[65:91].sum(), n), part(sum(int(count[c]) for c in SYMBOLS), n),
            part(count[124], n), part(count[33] + count[63], n), part(count[48:58].sum(), n), part(count[46] + count[44], n),
            part(count[10], n), part(count[128:].sum(), n), math.log1p(len(met)) / math.log(k + 2) if k else 0.0,
            part(sum(map(eq, ws, ws[1:])), k), part(max(met.values(), default=1) - 1, k), part(repeated, n + 200),
            float(-(share * np.log(share)).sum()), math.log1p(max(map(len, met), default=0)),
            part(sum(1 for w in ws if len(w) < 4), k)]


SIZE = len(statistics(b"a"))


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of each row's whole text."""
    def rows(batches):
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return documents.select(F.col("doc_id").cast("long"), utf8(F.col("text"))).mapInArrow(rows, "doc_id long, x array<double>")


class Discriminant:
    """Class densities from counts, sums and sums of products."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float = SHRINK, floor: float = FLOOR):
        self.classes = []
        moments = {c: m for c, m in moments.items() if m[0] >= 2}
        if set(moments) != {0, 1}:
            return
        total = sum(m[0] for m in moments.values())
        spread = {c: np.maximum(xx / n - np.outer(x / n, x / n), -1e30) for c, (n, x, xx) in moments.items()}
        pooled = sum(moments[c][0] / total * np.diag(spread[c]) for c in moments)
        for c in (0, 1):
            n, x, _ = moments[c]
            cov = (1 - shrink) * spread[c] + shrink * np.diag(pooled) + floor * np.eye(len(x))
            chol = np.linalg.cholesky(cov)
            self.classes.append((x / n, np.linalg.inv(chol).T, -np.log(np.diag(chol)).sum() + math.log(n / total)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.classes or not len(x):
            return np.full(len(x), 0.5)
        low, high = (c - 0.5 * (((x - mean) @ inv) ** 2).sum(axis=1) for mean, inv, c in self.classes)
        return 1 / (1 + np.exp(np.clip(low - high, -60, 60)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Model of the label from rows of ``stats`` (doc_id, x) that are in ``labels``."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("y"))
    rows = stats.join(known, F.col("doc_id") == F.col("_id")).select("y", "x")

    def sums(batches):
        got = {}
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), float).reshape(len(y), -1)
            for c in np.unique(y).tolist():
                z = x[y == c]
                mine = np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
                got[c] = got[c] + mine if c in got else mine
        for c, v in got.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(v), pa.int32()), pa.array(range(len(v)), pa.int32()), pa.array(v)],
                                             names=["y", "i", "v"])

    total = rows.mapInArrow(sums, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    moments = {}
    for c in {r.y for r in total}:
        v = np.array([r.v for r in sorted((r for r in total if r.y == c), key=lambda r: r.i)])
        d = (math.isqrt(4 * len(v) - 3) - 1) // 2
        moments[c] = (v[0], v[1:1 + d], v[1 + d:].reshape(d, d))
    return Discriminant(moments)


def score(stats: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of each row of ``stats``."""
    def rows(batches):
        for batch in batches:
            p = model(np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(rows, "doc_id long, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    stats = staged(document_statistics(table(spark, sf_dir, "documents")), "statistics")
    model = fit(stats.where(~held_out(F.col("doc_id"), 4, 2)), table(spark, sf_dir, "labels"))
    return score(stats, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
