"""Operator 5: language ID with hyperdimensional letter n-gram profiles.

Every letter has a random +-1 vector. An n-gram's vector is the product (the
binding) of its letters' vectors, each rotated by its place in the n-gram; a
text's vector is the sum (the bundle) over its n-grams, and a language's
prototype is the sum over its training texts. Texts go to the language of the
largest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, frugal, table, texts

DIMENSIONS, MAX_LABELS, SLICE_CHARS = 1024, 1024, 1 << 19
FOLDS = 5
# Texts in scripts and languages that were not learnt score up to 0.075 (a cosine of random vectors is 0.03 wide), texts of
# learnt ones from 0.09 on; only with so many letters is a low score told from chance.
MIN_SCORE, MIN_LETTERS = 0.08, 32
KINDS_AT_ONCE = 1 << 12               # n-gram vectors held at once: 32 MB for any alphabet


class Letters:
    """Random vectors of letters, made when first seen; the same on every worker.

    Letters are lower-cased code points for which ``str.isalpha`` holds. All
    others are one gap symbol (row 0), runs of which count once.
    """

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.row_of = np.full(0x110000, -1, dtype=np.int32)
        self.vectors = np.empty((0, dimensions), dtype=np.int8)
        self._append([0x20])
        self.row_of[0x20] = 0

    def _append(self, points) -> None:
        new = [np.random.default_rng([p, self.dimensions]).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1 for p in points]
        self.vectors = np.concatenate([self.vectors, np.array(new, dtype=np.int8).reshape(-1, self.dimensions)])
        # an n-gram's letters are rotated by 2, 1 and 0 places
        self.rotated = [np.roll(self.vectors, k, axis=1) for k in (2, 1, 0)]

    def rows(self, points: np.ndarray) -> np.ndarray:
        out = self.row_of[points]
        if (out < 0).any():
            letters = []
            for p in np.unique(points[out < 0]):
                if chr(p).isalpha():
                    self.row_of[p] = len(self.vectors) + len(letters)
                    letters.append(int(p))
                else:
                    self.row_of[p] = 0
            if letters:
                self._append(letters)
            out = self.row_of[points]
        return out

    def ngram_vectors(self, codes: np.ndarray, base: int) -> np.ndarray:
        first, second, third = codes // (base * base), codes // base % base, codes % base
        return (self.rotated[0][first] * self.rotated[1][second] * self.rotated[2][third]).astype(np.float32)


_LETTERS: dict[int, Letters] = {}


def letters(dimensions: int) -> Letters:
    if dimensions not in _LETTERS:
        _LETTERS[dimensions] = Letters(dimensions)
    return _LETTERS[dimensions]


def grouped_counts(group: np.ndarray, code: np.ndarray, groups: int, base: int):
    """(group, code, count) of the distinct pairs, ordered; codes below ``base`` cubed.

    A pair is counted as one number. Where an alphabet is so large that the number would pass 64 bits, the codes are
    first numbered by themselves."""
    if groups * base ** 3 < 1 << 62:
        key, count = np.unique(group * base ** 3 + code, return_counts=True)
        return key // base ** 3, key % base ** 3, count
    kinds, place = np.unique(code, return_inverse=True)
    key, count = np.unique(group * len(kinds) + place, return_counts=True)
    return key // len(kinds), kinds[key % len(kinds)], count


def ngram_counts(values: list[str], table_: Letters):
    """(owner, code, count, base): trigram counts of each text, ordered by owner (the index in ``values``)."""
    joined = " ".join(v.lower() for v in values)
    points = np.frombuffer((" " + joined + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(v.lower()) + 1 for v in values], dtype=np.int64)
    rows = table_.rows(points)
    owner = np.concatenate([[0], np.repeat(np.arange(len(values)), lengths)])
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:] != 0) | (rows[:-1] != 0)
    rows, owner = rows[keep].astype(np.int64), owner[keep]
    base = len(table_.vectors)
    if len(rows) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), base
    code = (rows[:-2] * base + rows[1:-1]) * base + rows[2:]
    # a gap between two texts lies in the middle of no n-gram
    inside = (rows[1:-1] != 0) | (owner[:-2] == owner[2:])
    text_of = np.where(rows[1:-1] != 0, owner[1:-1], owner[:-2])[inside]
    return *grouped_counts(text_of, code[inside], len(values), base), base


def slices(values: list[str], limit: int = SLICE_CHARS):
    """Consecutive index ranges of about ``limit`` characters; a longer text is one of its own."""
    start = size = 0
    for i, v in enumerate(values):
        if size and size + len(v) > limit:
            yield start, i
            start, size = i, 0
        size += len(v)
    if start < len(values):
        yield start, len(values)


def text_vectors(values: list[str], table_: Letters) -> np.ndarray:
    """One bundled vector per text; zero if it has no letter."""
    out = np.zeros((len(values), table_.dimensions), dtype=np.float32)
    owner, code, count, base = ngram_counts(values, table_)
    if not len(owner):
        return out
    kinds, place = np.unique(code, return_inverse=True)
    ends = np.searchsorted(owner, np.arange(len(values) + 1))
    step = KINDS_AT_ONCE
    for at in range(0, len(kinds), step):
        vectors = table_.ngram_vectors(kinds[at:at + step], base)
        for i in range(len(values)):
            mine = slice(ends[i], ends[i + 1])
            rows, counts = place[mine], count[mine]
            if len(kinds) > step:
                here = (rows >= at) & (rows < at + step)
                rows, counts = rows[here], counts[here]
            out[i] += counts.astype(np.float32) @ vectors[rows - at]
    return out


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, max_labels: int = MAX_LABELS) -> dict[str, np.ndarray]:
    """Prototype of each non-NULL ``lang`` of ``docs``: exact integer sums over all rows.

    Tasks bundle their own rows and send one vector per label; Spark adds them.
    What reaches the driver is labels x dimensions numbers; more than
    ``max_labels`` labels is an error.
    """
    def run(batches):
        table_, sums = letters(dimensions), {}
        for batch in batches:
            values, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for a, b in slices(values):
                names = sorted(set(langs[a:b]))
                label = np.array([names.index(x) for x in langs[a:b]], dtype=np.int64)
                owner, code, count, base = ngram_counts(values[a:b], table_)
                kinds, place = np.unique(code, return_inverse=True)
                for at in range(0, len(kinds), KINDS_AT_ONCE):
                    vectors = table_.ngram_vectors(kinds[at:at + KINDS_AT_ONCE], base).astype(np.float64)
                    here = (place >= at) & (place < at + KINDS_AT_ONCE)
                    of_kind, of_label = place[here] - at, label[owner[here]]
                    total = np.bincount(of_label * len(vectors) + of_kind, count[here], len(names) * len(vectors))
                    more = np.rint(total.reshape(len(names), -1) @ vectors).astype(np.int64)
                    for k in np.unique(of_label):
                        sums[names[k]] = sums.get(names[k], 0) + more[k]
            if len(sums) > max_labels:
                raise ValueError(f"more than {max_labels} languages")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
            names=["lang", "sums"])

    rows = (texts(docs.where("lang IS NOT NULL"), "lang").mapInArrow(run, "lang string, sums array<bigint>")
            .select("lang", F.posexplode("sums").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v")).limit(max_labels + 1).collect())
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} languages")
    return {r["lang"]: np.array([x["v"] for x in r["v"]], dtype=np.float64) for r in sorted(rows, key=lambda r: r["lang"])}


def predict(values: list[str], names: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Label and cosine (0 to 1) of each text; ``und`` and 0 without a letter or without prototypes."""
    labels, scores = [], []
    table_ = letters(prototypes.shape[1])
    for a, b in slices(values):
        vectors = text_vectors(values[a:b], table_)
        norms = np.linalg.norm(vectors, axis=1)
        cosine = vectors @ prototypes.T / np.maximum(norms, 1e-9)[:, None] if names else np.zeros((b - a, 1))
        best = cosine.argmax(axis=1)
        none = np.array([not any(map(str.isalpha, v)) for v in values[a:b]]) | (not names)
        labels += ["und" if z else names[k] for z, k in zip(none, best)]
        scores.append(np.where(none, 0.0, np.clip(cosine[np.arange(b - a), best], 0.0, 1.0)))
    return labels, np.concatenate(scores) if scores else np.empty(0)


def _unit(prototypes: dict[str, np.ndarray], dimensions: int):
    names = list(prototypes)
    matrix = np.array([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-9) for k in names], dtype=np.float32)
    return names, matrix.reshape(len(names), dimensions)


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, lang_pred, score), one row per document; texts of any length are read whole, NULL as empty (``und``).

    Repeated rows stay separate rows; an empty table gives no rows. Only doc_id and text are read."""
    names, matrix = _unit(prototypes, dimensions)

    def run(batches):
        for batch in batches:
            labels, scores = predict(batch.column("text").to_pylist(), names, matrix)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float = MIN_SCORE,
                    dimensions: int = DIMENSIONS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``docs`` without the documents that language ID rejects, all columns as they are, whatever their names.

    Rejected: no letter at all (also NULL and empty texts), or ``min_letters`` letters or more and a cosine below
    ``min_score`` with every language. Repeated rows stay or go together; an empty table stays empty.
    """
    names, matrix = _unit(prototypes, dimensions)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            values = [t or "" for t in batch.column("text").to_pylist()]
            labels, scores = predict(values, names, matrix)
            keep = [k != "und" and (s >= min_score or sum(map(str.isalpha, t)) < min_letters) for k, s, t in zip(labels, scores, values)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(frugal(run), docs.schema).select(*columns)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = learn(docs.where(fold("doc_id", FOLDS) != 0))
    return identify(docs, prototypes).select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "lang_pred", "score")
