"""Operator 7: SimHash near-duplicates through pivot distance tables.

Fingerprints are built by numpy inside Arrow batches; everything after that is
DataFrame work on 64-bit integers:

1. equal fingerprints collapse to one row (copies never form pairs);
2. each fingerprint gets a table row of Hamming distances to the pivots, a
   fixed set of reference fingerprints;
3. candidates share two of ``max_bits + 2`` bit blocks (fingerprints within
   ``max_bits`` bits always do) and the cell of their first pivot distance or a
   neighbouring one;
4. a candidate pair is discarded when any coordinate of its pivot rows differs
   by more than ``max_bits`` (triangle inequality), and survivors are verified
   bit by bit.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, materialise, table, texts, unboxed
from .components import connected_components

SHINGLE_WORDS, MAX_BITS, PIVOTS = 3, 3, 16


def simhash(text: str, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit majority fingerprint of the XXH64 hashes (seed 42) of the word shingles; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):          # bounded memory for very long texts
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, *extra: Column) -> DataFrame:
    """(doc_id, fp, extra ...): one row per document, fp as signed 64-bit integer; ``extra``: named long columns of (doc_id, text)."""
    rows = texts(docs).select("doc_id", "text", *extra)
    carried = ["doc_id", *rows.columns[2:]]

    def run(batches):
        for batch in batches:
            fps = np.array([simhash(t, width) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), *map(batch.column, carried)], names=["fp", *carried])
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ["fp", *carried])).select("doc_id", "fp", *carried[1:])


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: zero, then half-ones patterns from a fixed seed (signed 64-bit)."""
    rng = np.random.default_rng(7)
    out = [0]
    for _ in range(count - 1):
        bits = np.zeros(64, dtype=np.uint8)
        bits[rng.permutation(64)[:32]] = 1
        out.append(int(np.packbits(bits, bitorder="little").view("<i8")[0]))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def pivot_distances(fp: Column, count: int) -> list[Column]:
    return [F.bit_count(fp.bitwiseXOR(F.lit(p))) for p in pivots(count)]


def link_pairs(fps: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b), a < b: every pair of different values of ``fps.fp`` within ``max_bits`` bits.

    The join key is the value of two bit blocks and a cell of the first pivot
    distance. The left side enters its own cell only, the right side every cell
    its distance +- max_bits touches (two at most), so no pair is lost and none
    is found twice for one block pair.
    """
    n_blocks, cell = max_bits + 2, 4 * max_bits + 4
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n_blocks)]
    keys = F.array(*[F.struct(F.lit(k).cast("int").alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[j]))).alias("key"))
                     for k, (i, j) in enumerate(combinations(range(n_blocks), 2))])
    # the table: pivot distances (0-64) as one byte string per fingerprint
    rows = fps.select("fp", F.array(*pivot_distances(F.col("fp"), n_pivots)).alias("d"))
    near = F.col("d")[0]
    lower = F.floor(near / cell).cast("int")
    left = rows.select("fp", "d", lower.alias("cell"), F.explode(keys).alias("s")).select(
        F.col("fp").alias("a"), F.col("d").alias("da"), "cell", "s.k", "s.key")
    touched = F.sequence(F.floor((near - max_bits) / cell).cast("int"), F.floor((near + max_bits) / cell).cast("int"))
    right = rows.select("fp", "d", F.explode(keys).alias("s"), touched.alias("cells")).select(
        F.col("fp").alias("b"), F.col("d").alias("db"), "s.k", "s.key", F.explode("cells").alias("cell"))
    far = F.lit(False)
    for i in range(n_pivots):
        far = far | (F.abs(F.col("da")[i] - F.col("db")[i]) > max_bits)
    pairs = left.join(right, ["k", "key", "cell"]).where(F.col("a") < F.col("b")).where(~far)
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id linked, the document itself included.

    Empty and NULL texts have fingerprint zero and are linked like any other.
    Equal rows stay separate rows. A NULL doc_id never names a component
    unless every id of the component is NULL. An empty table gives no rows.
    """
    fps = materialise(fingerprints(docs, width), "fps")
    roots = _components(fps, max_bits)
    ids = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    named = roots.join(ids, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first, component) of every value of ``fps.fp``; first: its smallest doc_id."""
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    comps = connected_components(link_pairs(distinct, max_bits))
    return distinct.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, all columns kept: the smallest doc_id (NULL last), then text hash.

    Rows of one id, or without an id, are told apart by their texts; of rows equal in both one stays. Empty and NULL
    texts are one component. Other columns may have any name; an empty table stays empty.
    """
    fps = materialise(fingerprints(docs, width, F.xxhash64("text").alias("text_hash")), "fps")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    keep = fps.join(_components(fps, max_bits).select("fp", "component"), "fp").groupBy("component").agg(F.min(place).alias("p"))
    keep = keep.select(F.col("p.doc_id").alias("_keep"), F.col("p.text_hash").alias("_keep_hash"))
    kept = boxed(docs).join(keep, F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_keep_hash")), "left_semi")
    # equal texts have one component: rows of one id and text are copies
    return unboxed(kept.dropDuplicates(["_id", "_hash"]), docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
