"""Operator 11: hard-negative mining with rotated one-bit codes.

Every vector is kept beside ``LEVELS`` one-bit codes. Level k turns what is left
of the vector by a random rotation and keeps the signs of the result (the code:
a unit vector u of +-1/sqrt(P)), the alignment (the inner product with u) and the
rest, which is orthogonal to u and goes to the next level. With the anchor turned
the same way,

    <x, a> = sum_k alignment_k * <u_k, a_k> + <rest, a_L>,

where <u_k, a_k> comes from popcounts of the code against the bit planes of the
quantised anchor, and the last term is at most |rest| * |a| (Cauchy-Schwarz). So
each pair has an interval that surely holds its score. Intervals that cannot
reach the result are discarded; the integer vectors of the others are multiplied.

The anchors are a stated query set. They are dealt out in blocks, and every block
of rows meets every block of anchors: an equality join on a lane number, each
side in blocks of bounded size, nothing of which passes through the driver.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

LEVELS, PLANES, SEED = 6, 6, 20_240_611
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 256
PAIRS_AT_ONCE = 1 << 16
SCALE = 256
LONGEST_SCORE = 1 << 55               # a hundred times a score fits 64 bits

BLOCK = "block long, n int, ids binary, labels binary, vectors binary, codes binary, alignments binary, rests binary"
ANCHORS = "n int, ids binary, labels binary, vectors binary, bounds binary"


# ---- rotation and codes (numpy, inside tasks) ----

def _signs(size: int, level: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, level]).integers(0, 2, (2, size)) * 2.0 - 1.0


def rotate(x: np.ndarray, level: int) -> np.ndarray:
    """Rows of ``x`` (a power of two wide) under the level's random rotation: twice random signs, then Hadamard."""
    size = x.shape[1]
    for signs in _signs(size, level):
        x = x * signs
        step = 1
        while step < size:
            halves = x.reshape(len(x), -1, 2, step)
            x = np.concatenate([halves[:, :, :1] + halves[:, :, 1:], halves[:, :, :1] - halves[:, :, 1:]], axis=2).reshape(len(x), size)
            step *= 2
        x = x / np.sqrt(size)
    return x


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes [n, levels, words], alignments [n, levels], norm of the rest [n]) of integer vectors."""
    size = max(64, 1 << max(0, x.shape[1] - 1).bit_length())
    rest = np.zeros((len(x), size))
    rest[:, :x.shape[1]] = x
    codes, alignments = [], []
    for level in range(LEVELS):
        rest = rotate(rest, level)
        positive = rest >= 0
        alignment = np.abs(rest).sum(axis=1) / np.sqrt(size)
        rest = rest - np.where(positive, 1.0, -1.0) * (alignment / np.sqrt(size))[:, None]
        codes.append(_bits(positive))
        alignments.append(alignment)
    return np.stack(codes, axis=1), np.stack(alignments, axis=1), np.sqrt((rest * rest).sum(axis=1))


def estimate(codes: np.ndarray, alignments: np.ndarray, rests: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, half width) [n, anchors] of intervals that hold every inner product, by popcounts and Cauchy-Schwarz."""
    words = codes.shape[2]
    size = words * 64
    turned = np.zeros((len(anchors), size))
    turned[:, :anchors.shape[1]] = anchors
    length = np.sqrt((turned * turned).sum(axis=1))
    centre = np.zeros((len(codes), len(anchors)))
    half = rests[:, None] * length[None, :]
    for level in range(LEVELS):
        turned = rotate(turned, level)
        low = turned.min(axis=1)
        step = (turned.max(axis=1) - low) / (2 ** PLANES - 1)
        step[step == 0] = 1.0
        quantised = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        error = turned - (low[:, None] + step[:, None] * quantised)
        error = np.sqrt((error * error).sum(axis=1))
        code = codes[:, level, :]
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        total = np.zeros(centre.shape, np.int32)
        for plane in range(PLANES):
            bits = _bits((quantised >> plane) & 1 == 1)
            for word in range(words):
                total += np.bitwise_count(code[:, word, None] & bits[None, :, word]).astype(np.int32) << plane
        plus = low[None, :] * ones[:, None] + step[None, :] * total                 # sum of the components under set bits
        whole = low * size + step * quantised.sum(axis=1)
        centre += alignments[:, level, None] * (2.0 * plus - whole[None, :]) / np.sqrt(size)
        half += alignments[:, level, None] * error[None, :]
    norms = np.sqrt((alignments * alignments).sum(axis=1) + rests * rests)
    return centre, half + 1e-9 * norms[:, None] * length[None, :] + 1e-6            # floating-point rounding


def _scores(x: np.ndarray, rows: np.ndarray, anchors: np.ndarray, columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        out[part] = np.einsum("ij,ij->i", x[rows[part]], anchors[columns[part]])
    return out


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of each group by score descending, id ascending."""
    order = np.lexsort((ids, -score, group))
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < n]


# ---- blocks ----

def _vectors(column, size: int) -> np.ndarray:
    """[n, size] integers of a list column, shorter lists filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), size), np.int64)
    inside = np.arange(size)[None, :] < lengths[:, None]
    out[inside] = lists.flatten().to_numpy(zero_copy_only=False)
    if len(out) and size * int(np.abs(out).max()) ** 2 >= LONGEST_SCORE:
        raise ArithmeticError("components too large: scores would not fit 64 bits")
    return out


def _pack_rows(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x, ids = _vectors(part["x"], size), part["vec_id"].to_numpy()
                codes, alignments, rests = encode(x)
                row = (int(ids[0]), len(ids), ids.tobytes(), part["label"].to_numpy().tobytes(), x.tobytes(), codes.tobytes(),
                       alignments.tobytes(), rests.tobytes())
                yield pa.RecordBatch.from_pylist([dict(zip(("block", "n", "ids", "labels", "vectors", "codes", "alignments", "rests"), row))],
                                                 pa.schema([("block", pa.int64()), ("n", pa.int32())] + [
                                                     (c, pa.binary()) for c in ("ids", "labels", "vectors", "codes", "alignments", "rests")]))
    return pack


def _pack_anchors(size: int, positives: int):
    """Blocks of anchors; ``bounds`` holds the positive scores, as many as there are and then a mark below every score."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ANCHORS):
                part = batch.slice(at, BLOCK_ANCHORS)
                bounds = np.full((part.num_rows, positives), -LONGEST_SCORE, np.int64)
                lists = part["scores"]
                inside = np.arange(positives)[None, :] < lists.value_lengths().to_numpy(zero_copy_only=False)[:, None]
                bounds[inside] = lists.flatten().to_numpy(zero_copy_only=False)
                row = (part.num_rows, part["vec_id"].to_numpy().tobytes(), part["label"].to_numpy().tobytes(),
                       _vectors(part["x"], size).tobytes(), bounds.tobytes())
                yield pa.RecordBatch.from_pylist([dict(zip(("n", "ids", "labels", "vectors", "bounds"), row))], pa.schema(
                    [("n", pa.int32())] + [(c, pa.binary()) for c in ("ids", "labels", "vectors", "bounds")]))
    return pack


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Block pairs of a joined batch: (ids, labels, vectors, codes, alignments, rests) of rows, (ids, labels, vectors, bounds) of anchors."""
    for batch in batches:
        for i in range(batch.num_rows):
            def read(name, kind=np.int64):
                return np.frombuffer(batch[name][i].as_buffer(), kind)
            n, m = batch["n"][i].as_py(), batch["a_n"][i].as_py()
            yield ((read("ids"), read("labels"), read("vectors").reshape(n, -1), read("codes", np.uint64).reshape(n, LEVELS, -1),
                    read("alignments", np.float64).reshape(n, LEVELS), read("rests", np.float64)),
                   (read("a_ids"), read("a_labels"), read("a_vectors").reshape(m, -1), read("a_bounds").reshape(m, -1)))


def near_candidates(rows, anchors, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one label (row, anchor) that may be among the anchor's first ``wanted`` of this block."""
    centre, half = estimate(*rows[3:], anchors[2])
    same = (rows[1][:, None] == anchors[1][None, :]) & (rows[0][:, None] != anchors[0][None, :])
    low = np.where(same, centre - half, -np.inf)
    floor = np.partition(low, len(low) - wanted, axis=0)[len(low) - wanted] if len(low) >= wanted else np.full(low.shape[1], -np.inf)
    return np.nonzero(same & (centre + half >= floor[None, :]))


def far_candidates(rows, anchors, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels whose interval meets the window of at least one positive."""
    centre, half = estimate(*rows[3:], anchors[2])
    bounds = anchors[3].astype(np.float64)
    real = anchors[3] > -LONGEST_SCORE
    least = np.where(real, np.floor(bounds * low / high) - 1, np.inf).min(axis=1)
    most = np.where(real, bounds, -np.inf).max(axis=1)
    other = rows[1][:, None] != anchors[1][None, :]
    return np.nonzero(other & (centre + half >= least[None, :]) & (centre - half <= most[None, :]))


def _mine_positives(wanted: int):
    def mine(batches):
        for rows, anchors in _pairs(batches):
            i, j = near_candidates(rows, anchors, wanted)
            score = _scores(rows[2], i, anchors[2], j)
            top = _first(j, score, rows[0][i], wanted)
            yield pa.RecordBatch.from_arrays([pa.array(anchors[0][j[top]]), pa.array(rows[0][i[top]]), pa.array(score[top])],
                                             ["anchor_id", "other_id", "score"])
    return mine


def _mine_negatives(wanted: int, low: int, high: int):
    def mine(batches):
        for rows, anchors in _pairs(batches):
            i, j = far_candidates(rows, anchors, low, high)
            score = _scores(rows[2], i, anchors[2], j)
            for place in range(anchors[3].shape[1]):
                bound = anchors[3][j, place]
                inside = np.flatnonzero((bound > -LONGEST_SCORE) & (low * bound <= high * score) & (score <= bound))
                top = inside[_first(j[inside], score[inside], rows[0][i[inside]], wanted)]
                yield pa.RecordBatch.from_arrays([pa.array(anchors[0][j[top]]), pa.array(np.full(len(top), place + 1, np.int32)),
                                                  pa.array(rows[0][i[top]]), pa.array(score[top])],
                                                 ["anchor_id", "place", "other_id", "score"])
    return mine


# ---- Spark ----

def usable(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, x): integer components floor(scale * x) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & good)
    rows = rows.withColumn("x", F.transform("x", lambda v: F.floor(v * scale)))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


def _meet(index: DataFrame, anchors: DataFrame, lanes: int) -> DataFrame:
    """Every block of the index beside every block of anchors: the anchors are dealt to all lanes, a block lies in one."""
    dealt = anchors.select(*[F.col(c).alias("a_" + c) for c in anchors.columns],
                           F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    placed = index.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).repartition(lanes, "lane")
    return placed.join(dealt, "lane").drop("lane")


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         lanes: int | None = None) -> DataFrame:
    """Hard negatives of the anchors among (vec_id, label, x); see ``usable``.

    An anchor's positives are its first ``positives`` other rows of its label by
    (score descending, vec_id). Per anchor and positive, returns the first
    ``negatives`` rows of other labels with low/high of the positive's score or
    more, and no more than it: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Ties go to the smaller vec_id. Of rows that repeat a vec_id, the one of the
    smallest (label, vector) takes part. Vectors of unequal length are filled up
    with zeros, an empty one is all zeros. Components so large that a score could
    pass 2^55 raise ArithmeticError. An anchor without positives, or a positive
    without negatives, gives no row; an empty table gives no rows.
    """
    spark = rows.sparkSession
    lanes = lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(rows, "negatives-rows")
    size = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 0)
    index = materialise(rows.select("vec_id", "label", "x").mapInArrow(_pack_rows(size), BLOCK), "negatives-index")
    chosen = rows.where(anchor).select("vec_id", "label", "x")
    none = F.array().cast("array<bigint>")
    asked = chosen.withColumn("scores", none).mapInArrow(_pack_anchors(size, positives), ANCHORS)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = _meet(index, asked, lanes).mapInArrow(_mine_positives(positives), "anchor_id long, other_id long, score long")
    near = materialise(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "negatives-positives")

    lists = near.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda s: s["score"]).alias("scores"))
    asked = chosen.join(lists, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "x", "scores")
    asked = asked.mapInArrow(_pack_anchors(size, positives), ANCHORS)
    far = _meet(index, asked, lanes).mapInArrow(_mine_negatives(negatives, low, high), "anchor_id long, place int, other_id long, score long")
    first = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
    far = far.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    found = near.select("anchor_id", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(found, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth of ``embeddings``, against all of them."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)
