"""Operator 8: quality classifier, a regularised quadratic discriminant on document statistics."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, materialise, table, texts

FOLDS, THRESHOLD = 5, 0.3
SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL, TEMPERATURE = 0.2, 0.05, 4.0

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGIT = b"0123456789"
_MARKS = b".,;:'()-?\""
_SPACE = b" \t\n\r\x0b\x0c"
_OTHER = bytes(c for c in range(0x21, 0x7F) if c not in _UPPER + _LOWER + _DIGIT + _MARKS)
FEATURES = ("n_words", "word_length", "upper", "digits", "marks", "symbols", "non_ascii", "distinct_words", "top_word",
            "repeated_neighbours", "symbol_words", "upper_words", "line_words", "repeated_lines", "compression")


def statistics(raw: bytes) -> list[float]:
    """Transformed statistics of one whole text (UTF-8); log and log-odds scales make them nearer to normal."""
    def share(part: float, whole: float) -> float:
        return float(np.log((part + 0.5) / (whole - part + 0.5)))

    n = len(raw)

    def count(chars: bytes) -> int:
        return n - len(raw.translate(None, chars))

    words = raw.split()
    w = len(words)
    upper, lower, digits, marks, symbols, space = map(count, (_UPPER, _LOWER, _DIGIT, _MARKS, _OTHER, _SPACE))
    wide = n - upper - lower - digits - marks - symbols - space
    kinds = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    packed = sum(len(zlib.compress(raw[i:i + 65536], 1)) for i in range(0, n, 65536))
    return [
        float(np.log1p(w)), float(np.log((n - space + 1) / (w + 1))), share(upper, upper + lower), share(digits, n),
        share(marks, n), share(symbols, n), share(max(wide, 0), n),
        share(len(kinds), w) / (1 + float(np.log1p(w))), share(max(kinds.values(), default=0), w),
        share(sum(a == b for a, b in zip(words, words[1:])), w),
        share(sum(1 for k in words if k[-1] in _OTHER), w), share(sum(map(bytes.isupper, words)), w),
        float(np.log((w + 1) / (len(lines) + 1))), share(len(lines) - len(set(lines)), len(lines)),
        float(np.log((packed + 8) / (n + 8)))]


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): statistics of every whole text, of any length; a NULL text counts as empty.

    Repeated rows stay separate rows; an empty table gives no rows. Only doc_id and text are read."""
    def run(batches):
        for batch in batches:
            rows = [statistics(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])
    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances (cached) and their log-determinants."""
    prior: float                    # log odds of class 1
    centre: np.ndarray
    scale: np.ndarray
    means: tuple
    factors: tuple                  # inverse Cholesky factors
    halves: tuple                   # half log-determinants
    temperature: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: logistic of the log-density difference plus the prior's log odds."""
        z = (x - self.centre) / self.scale
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - h for m, f, h in zip(self.means, self.factors, self.halves)]
        odds = (density[1] - density[0]) / self.temperature + self.prior
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def fit(labelled: DataFrame, to_pooled: float = SHRINK_TO_POOLED, to_diagonal: float = SHRINK_TO_DIAGONAL,
        temperature: float = TEMPERATURE) -> Discriminant | float:
    """Discriminant from (x, label); Spark adds class counts, sums and products, a few hundred numbers.

    Each class covariance is shrunk to the pooled one and then to its diagonal.
    With one class (or none) only, a constant score is returned: 1, 0 or 0.5.
    """
    d = len(FEATURES)

    def run(batches):
        acc = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(-1, d)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                acc[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(acc.tolist(), pa.list_(pa.float64()))],
                                         names=["label", "sums"])

    rows = (labelled.mapInArrow(run, "label int, sums array<double>").select("label", F.posexplode("sums").alias("i", "v"))
            .groupBy("label", "i").agg(F.sum("v").alias("v")).collect())
    sums = np.zeros((2, 1 + d + d * d))
    for r in rows:
        sums[r["label"], r["i"]] = r["v"]
    n = sums[:, 0]
    if min(n) < 2:
        return 0.5 if n.sum() == 0 else float(n[1] > n[0])
    means = [sums[k, 1:1 + d] / n[k] for k in (0, 1)]
    covs = [sums[k, 1 + d:].reshape(d, d) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    centre = (sums[0, 1:1 + d] + sums[1, 1:1 + d]) / n.sum()
    pooled = (covs[0] * n[0] + covs[1] * n[1]) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    unit = np.outer(scale, scale)
    factors, halves = [], []
    for cov in covs:
        s = ((1 - to_pooled) * cov + to_pooled * pooled) / unit
        s = (1 - to_diagonal) * s + to_diagonal * np.diag(np.maximum(np.diag(s), 1e-3)) + 1e-4 * np.eye(d)
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        halves.append(float(np.log(np.diag(lower)).sum()))
    return Discriminant(float(np.log(n[1] / n[0])), centre, scale, tuple((m - centre) / scale for m in means),
                        tuple(factors), tuple(halves), temperature)


def score(feats: DataFrame, fitted: Discriminant | float) -> DataFrame:
    """(doc_id, score) of every row of ``feats``."""
    def run(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
            out = np.full(len(x), fitted) if isinstance(fitted, float) else fitted.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])
    return feats.mapInArrow(run, "doc_id long, score double")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of an id with several rows count once each; NULL ids and NULL labels teach nothing."""
    feats = materialise(features(table(spark, sf_dir, "documents")), "features")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    fitted = fit(feats.where(fold("doc_id", FOLDS) != 0).join(labels, "doc_id").select("x", "label"))
    out = score(feats, fitted)
    return out.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
