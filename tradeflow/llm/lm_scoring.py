"""Operator 1: language-model scoring from a log-frequency Bloom filter.

Bigram counts of the training texts are quantised on a logarithmic scale. An
n-gram of level q enters the filter q times, as (n-gram, 1) ... (n-gram, q); a
count is read back by probing 1, 2, ... until a probe misses. The filter also
holds the count and the number of distinct followers of each history, so a
worker computes smoothed probabilities from membership probes alone.

The filter is laid out in buckets. All entries of one history lie in one bucket;
a very frequent history is spread over ``SALTS`` parts by the following word.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, fold, frugal, give_back, materialise, table, texts

FOLDS, HELD_OUT = 7, 2
END = b"\n"                      # the end token; no word holds white space
EXACT_LEVELS, BASE, TOP_LEVEL = 4, 1.25, 160
HASHES, BITS_PER_ENTRY = 4, 8
HOT, SALTS = 512, 64             # histories with a share over 1/HOT are hot: HOT of them at most
HEAD = 1 << 17                   # words with a share over 1/HEAD have their exact counts broadcast: HEAD of them at most
BUCKET_TOKENS = 1 << 21          # training tokens per bucket of the filter
SEGMENT_BYTES = 128 << 20        # largest single broadcast
TASK_TOKENS = 1 << 20            # tokens a task holds before it sends their bigrams
SCORE_TOKENS = 1 << 19           # tokens scored at once
HELD_KEYS = 1 << 18              # words, and bigrams, whose counts a task holds for its next texts; others are looked up again
COUNT_WORDS = 1 << 18            # different words a task holds before it sends their counts
_U64 = np.uint64


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space, then the end token."""
    return [*raw.lower().split(), END]


def hash_words(words: list[bytes]) -> np.ndarray:
    """XXH64 with seed 42, the same as Spark's ``xxhash64`` of one column."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: exact up to EXACT_LEVELS, then logarithmic; 0 for 0."""
    c = np.maximum(counts, 1).astype(np.float64)
    log = EXACT_LEVELS + np.floor(np.log(c / EXACT_LEVELS) / np.log(BASE) + 1e-9).astype(np.int64)
    return np.where(counts <= EXACT_LEVELS, counts, np.minimum(np.maximum(log, EXACT_LEVELS), TOP_LEVEL)).astype(np.int64)


#: Count that stands for each level: the geometric middle of its range.
LEVEL_VALUES = np.array([k if k < EXACT_LEVELS else EXACT_LEVELS * BASE ** (k - EXACT_LEVELS + (0.5 if k > EXACT_LEVELS else 0))
                         for k in range(TOP_LEVEL + 1)], dtype=np.float64)


class Vocabulary:
    """Codes and hashes of the words of one stretch of texts."""

    def __init__(self):
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__     # a new word has the next number
        self.parts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, raw: bytes) -> None:
        words = words_of(raw)
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), dtype=np.int32, count=len(words)))
        self.lengths.append(len(words))
        self.size += len(words)

    def stream(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(codes of all tokens, their histories, words); the history of a first word is the end token."""
        codes = np.concatenate(self.parts)
        histories = np.empty_like(codes)
        histories[1:] = codes[:-1]
        histories[0] = self.codes[END]
        return codes, histories, list(self.codes)


def bigram_parts(history: np.ndarray, following: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(history part, follower) of bigrams, given word hashes: a hot history has SALTS parts, by follower."""
    salt = np.where(hot, mix(following) % _U64(SALTS) + _U64(1), _U64(0))
    return mix(history + salt * _U64(0x9E3779B97F4A7C15)), mix(following ^ _U64(0xA5A5A5A5A5A5A5A5))


def pack_key(part: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """36 bits of the history part, whose top bits are the bucket, and 28 of the follower."""
    return (part & _U64(0xFFFFFFFFF0000000)) | (follower >> _U64(36))


# --- the filter -----------------------------------------------------------------------------------------------------

def _bits(keys: np.ndarray, level: int, kind: int, size: int | np.ndarray, k: int) -> np.ndarray:
    """Bit number of the ``k``-th hash of entry (key, kind, level) in a bucket of ``size`` bits."""
    seed = (kind << 56) + level * 0x9E3779B97F4A7C15 + k * 0xD6E8FEB86659FD93
    hashed, size = mix(keys + _U64(seed % (1 << 64))), np.asarray(size, dtype=np.uint64)
    if size.size and int(size.max()) >> 32:
        return hashed % size
    return (hashed >> _U64(32)) * size >> _U64(32)         # the upper half as a share of the size


BIGRAM, COUNT, FOLLOWERS = 1, 2, 3


def build_bucket(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, int, list[int]]:
    """(bits, entries, [bigrams of count 1, of count 2]) of one bucket from its distinct bigram keys and counts."""
    part = keys >> _U64(28)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(keys) else np.empty(0, np.int64)
    histories = part[starts]
    totals = np.add.reduceat(counts, starts) if len(keys) else np.empty(0, np.int64)
    followers = np.diff(np.concatenate([starts, [len(keys)]]))
    groups = [(keys, levels(counts), BIGRAM), (histories, levels(totals), COUNT), (histories, levels(followers), FOLLOWERS)]
    entries = int(sum(q.sum() for _, q, _ in groups))
    size = max(64, (entries * BITS_PER_ENTRY + 7) // 8 * 8)
    bits = np.zeros(size, dtype=bool)
    for own, q, kind in groups:
        for level in range(1, int(q.max(initial=0)) + 1):
            mine = own[q >= level]
            for k in range(HASHES):
                bits[_bits(mine, level, kind, size, k)] = True
    return np.packbits(bits, bitorder="little").tobytes(), entries, [int((counts == 1).sum()), int((counts == 2).sum())]


class Segment:
    """Consecutive buckets of the filter: number of the first, bytes of each, all bits."""

    def __init__(self, first: int, lengths: list[int], raw: bytes):
        self.first = first
        self.sizes = np.array(lengths, dtype=np.uint64) * _U64(8)
        self.offsets = np.cumsum([0, *lengths]).astype(np.uint64)[:-1] * _U64(8)
        self.bits = np.frombuffer(raw, dtype=np.uint8)

    def holds(self, buckets: np.ndarray) -> np.ndarray:
        return (buckets >= self.first) & (buckets < self.first + len(self.sizes))

    def counts(self, keys: np.ndarray, buckets: np.ndarray, kind: int) -> np.ndarray:
        """Estimated counts of ``keys``: probes of levels 1, 2, ... go on for the keys that were members so far."""
        found = np.zeros(len(keys), dtype=np.int64)
        alive = np.arange(len(keys))
        local = (buckets - self.first).astype(np.int64)
        sizes, offsets = self.sizes[local], self.offsets[local]
        for level in range(1, TOP_LEVEL + 1):
            for k in range(HASHES):
                at = offsets[alive] + _bits(keys[alive], level, kind, sizes[alive], k)
                alive = alive[(self.bits[(at >> _U64(3)).astype(np.int64)] >> (at & _U64(7)).astype(np.uint8)) & 1 == 1]
            if not len(alive):
                break
            found[alive] = level
        return LEVEL_VALUES[found]


# --- gathering from the corpus --------------------------------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): exact counts of all tokens; tasks add up their own first."""
    def run(batches):
        def out(counts):
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                              names=["word", "n"])
        counts: Counter = Counter()
        for batch in batches:
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                counts.update(words_of(raw))
                if len(counts) > COUNT_WORDS:
                    yield out(counts)
                    counts.clear()
        yield out(counts)
    return texts(docs).mapInArrow(frugal(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bigram_payloads(docs: DataFrame, hot: set[bytes], bucket_bits: int) -> DataFrame:
    """(bucket, keys, counts): per task and bucket the distinct bigram keys and their counts, as arrays of bytes."""
    def run(batches):
        def out(vocabulary: Vocabulary):
            codes, histories, words = vocabulary.stream()
            hashes = hash_words(words)
            is_hot = np.fromiter((w in hot for w in words), dtype=bool, count=len(words))
            part, follower = bigram_parts(hashes[histories], hashes[codes], is_hot[histories])
            keys, counts = np.unique(pack_key(part, follower), return_counts=True)
            bucket = (keys >> _U64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(keys), np.int64)
            numbers, starts = np.unique(bucket, return_index=True)
            ends = [*starts[1:], len(keys)]
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array([keys[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                 pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)], pa.binary())],
                names=["bucket", "keys", "counts"])
        vocabulary = Vocabulary()
        for batch in batches:
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                vocabulary.add(raw)
                if vocabulary.size >= TASK_TOKENS:
                    yield out(vocabulary)
                    vocabulary = Vocabulary()
        if vocabulary.size:
            yield out(vocabulary)
    return texts(docs).mapInArrow(frugal(run), "bucket int, keys binary, counts binary")


def build_filter(payloads: DataFrame) -> DataFrame:
    """(bucket, bits, entries, ones, twos): one row per bucket. A bucket's payloads hold about BUCKET_TOKENS keys at most."""
    def run(frame):
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in frame["keys"]])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in frame["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        bits, entries, rare = build_bucket(keys[starts], np.add.reduceat(counts, starts))
        frame = frame.iloc[:1][["bucket"]].copy()
        frame["bits"], frame["entries"], frame["ones"], frame["twos"] = [bits], entries, rare[0], rare[1]
        del keys, counts, order, starts
        give_back()                                     # the worker lives on beside the next stage
        return frame
    return payloads.groupBy("bucket").applyInPandas(run, "bucket int, bits binary, entries long, ones long, twos long")


def segments(rows: DataFrame, limit: int = SEGMENT_BYTES):
    """Broadcasts of the filter's buckets in order, each of ``limit`` bytes at most (or one bucket).

    Only one segment at a time passes the driver.
    """
    sizes = [(r["bucket"], r["size"]) for r in rows.select("bucket", F.octet_length("bits").alias("size")).orderBy("bucket").collect()]
    out, start = [], 0
    while start < len(sizes):
        end, total = start, 0
        while end < len(sizes) and (end == start or total + sizes[end][1] <= limit):
            total += sizes[end][1]
            end += 1
        low, high = (0 if start == 0 else sizes[start][0]), sizes[end - 1][0]
        found = {r["bucket"]: bytes(r["bits"]) for r in rows.where(F.col("bucket").between(low, high)).select("bucket", "bits").toLocalIterator()}
        blocks = [found.get(b, bytes(8)) for b in range(low, high + 1)]
        out.append(rows.sparkSession.sparkContext.broadcast((low, [len(b) for b in blocks], b"".join(blocks))))
        start = end
    return out


class Held:
    """Values of up to HELD_KEYS keys, in rows of ``width``."""

    def __init__(self, width: int):
        self.keys, self.values = np.empty(0, np.uint64), np.empty((0, width))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the keys that are held, their rows)."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        mine = np.flatnonzero(self.keys[at] == keys) if len(self.keys) else np.empty(0, np.int64)
        return mine, self.values[at[mine]]

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Hold more keys, of which none is held yet, as long as there is room."""
        room = HELD_KEYS - len(self.keys)
        if room > 0 and len(keys):
            keys, values = np.concatenate([self.keys, keys[:room]]), np.concatenate([self.values, values[:room]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], values[order]


class Probabilities:
    """Smoothed log10 probabilities of bigrams from the filter.

    Absolute discounting, interpolated: (c(hw) - d) / c(h) + d * followers(h) / c(h) * p(w), where
    p(w) = (c(w) - u) / N for a known word and u * V / N, the mass so set free, for any unknown one.
    What took many probes of the filter is held for the next texts of a task.
    """

    def __init__(self, parts, bucket_bits: int, hot: set[bytes], tokens: int, kinds: int, discount: float, word_discount: float):
        self.parts, self.bucket_bits, self.hot = parts, bucket_bits, hot
        self.tokens, self.kinds, self.discount, self.word_discount = tokens, kinds, discount, word_discount
        self.held_words, self.held_pairs = Held(2), Held(1)

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U64(64 - self.bucket_bits)).astype(np.int64) if self.bucket_bits else np.zeros(len(keys), np.int64)

    def probe(self, queries: list[tuple[np.ndarray, np.ndarray, int]]) -> list[np.ndarray]:
        """Counts for each (keys, buckets, kind); segments are loaded one after another."""
        out = [np.zeros(len(q[0])) for q in queries]
        for shared in self.parts:
            segment = Segment(*shared.value)
            for result, (keys, buckets, kind) in zip(out, queries):
                mine = np.flatnonzero(segment.holds(buckets))
                result[mine] = segment.counts(keys[mine], buckets[mine], kind)
            if len(self.parts) > 1:
                del segment
                shared.__dict__.pop("_value", None)    # a worker holds one segment at a time
        return out

    def token_scores(self, codes: np.ndarray, histories: np.ndarray, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """log10 probability of each token."""
        is_hot = np.fromiter((w in self.hot for w in words), dtype=bool, count=len(words))
        held, held_words = self.held_words.find(hashes)
        fresh = np.ones(len(words), dtype=bool)
        fresh[held] = False
        # history parts: one for most words, SALTS for hot ones
        cold, hot = np.flatnonzero(fresh & ~is_hot), np.flatnonzero(fresh & is_hot)
        owner = np.concatenate([cold, np.repeat(hot, SALTS)])
        salt = np.concatenate([np.zeros(len(cold), np.uint64), np.tile(np.arange(1, SALTS + 1, dtype=np.uint64), len(hot))])
        parts = mix(hashes[owner] + salt * _U64(0x9E3779B97F4A7C15))
        part, follower = bigram_parts(hashes[histories], hashes[codes], is_hot[histories])
        pairs, place = np.unique(pack_key(part, follower), return_inverse=True)
        short = parts >> _U64(28)
        known, held_pairs = self.held_pairs.find(pairs)
        bigrams, new = np.zeros(len(pairs)), np.ones(len(pairs), dtype=bool)
        bigrams[known], new[known] = held_pairs[:, 0], False
        others = pairs[new]
        bigrams[new], totals, followers = self.probe([
            (others, self.bucket(others), BIGRAM), (short, self.bucket(parts), COUNT), (short, self.bucket(parts), FOLLOWERS)])
        c = np.bincount(owner, totals, minlength=len(words))          # c(w), which is also c(h)
        t = np.minimum(np.bincount(owner, followers, minlength=len(words)), c)
        c = np.where(t > 0, c, 0.0)                                   # every known word has a follower: else a false hit
        c[held], t[held] = held_words.T
        often = np.flatnonzero(new & (bigrams >= EXACT_LEVELS))
        self.held_pairs.add(pairs[often], bigrams[often, None])
        often = np.flatnonzero(fresh & (c >= EXACT_LEVELS))
        self.held_words.add(hashes[often], np.stack([c[often], t[often]], axis=1))
        n = max(self.tokens, 1)
        unknown = max(self.word_discount * self.kinds, 1.0) / n
        base = np.where(c > 0, np.maximum(c - self.word_discount, 0.1) / n, min(unknown, 1.0))
        ch, th = c[histories], t[histories]
        chw = np.minimum(bigrams[place], ch)
        seen = ch > 0
        safe = np.maximum(ch, 1.0)
        p = np.where(seen, np.maximum(chw - self.discount, 0.0) / safe + self.discount * th / safe * base[codes], base[codes])
        return np.log10(np.clip(p, 1e-300, 1.0))


# --- the operator ---------------------------------------------------------------------------------------------------

def score(docs: DataFrame, training: Column) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score), one row per document.

    ``training`` marks the rows to learn from. ``base_score`` is the exact
    add-one unigram score: counts of frequent words are broadcast (at most HEAD
    words can have a share over 1/HEAD), those of all others are joined.
    NULL and empty texts are the end token alone. Equal rows are scored
    separately; without training rows every word is unknown. Texts of any length
    are scored whole (a very long one is a stretch of its own). An empty table
    gives no rows. Only doc_id and text are read, besides what ``training`` uses.
    """
    bound_batches(docs.sparkSession)
    learn = docs.where(training)
    vocabulary = materialise(word_counts(learn).select("word", "n", F.xxhash64("word").alias("h")), "vocabulary")
    stats = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds"),
                           F.count_if(F.col("n") == 1).alias("ones")).first()
    tokens, kinds = stats["tokens"], stats["kinds"]
    head = {bytes(r["word"]): r["n"] for r in vocabulary.where(F.col("n") * HEAD > tokens).select("word", "n").toLocalIterator()}
    hot = {w for w, n in head.items() if n * HOT > tokens}
    bucket_bits = max(0, int(np.ceil(np.log2(max(tokens, 1) / BUCKET_TOKENS))))
    spark = docs.sparkSession
    filter_rows = materialise(build_filter(bigram_payloads(learn, hot, bucket_bits)), "filter")
    rare = filter_rows.agg(F.sum("ones").alias("ones"), F.sum("twos").alias("twos")).first()
    ones, twos = rare["ones"] or 0, rare["twos"] or 0
    discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
    word_discount = min(0.95, max(0.1, stats["ones"] / kinds)) if kinds else 0.5
    model = Probabilities(segments(filter_rows), bucket_bits, hot, tokens, kinds, discount, word_discount)
    shared_head = spark.sparkContext.broadcast(head)

    def run(batches):
        known = shared_head.value

        def out(ids, flags, stretch: Vocabulary):
            codes, histories, words = stretch.stream()
            hashes = hash_words(words)
            exact = np.fromiter((known.get(w, 0) for w in words), dtype=np.int64, count=len(words))
            owner = np.repeat(np.arange(len(ids)), stretch.lengths)
            is_head = exact[codes] > 0
            part = np.where(is_head, np.log10((exact[codes] + 1.0) / (tokens + kinds + 1.0)), 0.0)
            sums = [np.bincount(owner, w, minlength=len(ids)) for w in (part, is_head, model.token_scores(codes, histories, words, hashes))]
            rest = np.flatnonzero(~is_head)
            ends = np.searchsorted(owner[rest], np.arange(len(ids) + 1)).astype(np.int32)
            tails = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[codes[rest]].view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(flags, pa.bool_()), pa.array(stretch.lengths, pa.int64()),
                 pa.array(sums[1].astype(np.int64)), pa.array(sums[0]), pa.array(sums[2]), tails],
                names=["doc_id", "training", "n_tokens", "n_head", "head_score", "score", "tail"])

        ids, flags, stretch = [], [], Vocabulary()
        for batch in batches:
            for doc_id, flag, raw in zip(batch.column("doc_id").to_pylist(), batch.column("training").to_pylist(),
                                         batch.column("text").cast(pa.binary()).to_pylist()):
                ids.append(doc_id)
                flags.append(flag)
                stretch.add(raw)
                if stretch.size >= SCORE_TOKENS:
                    yield out(ids, flags, stretch)
                    ids, flags, stretch = [], [], Vocabulary()
        if ids:
            yield out(ids, flags, stretch)

    marked = texts(docs.withColumn("training", F.coalesce(training, F.lit(False))), "training")
    scored = marked.mapInArrow(frugal(run), "doc_id long, training boolean, n_tokens long, n_head long, head_score double, score double, tail array<bigint>")
    scored = materialise(scored.select("*", F.monotonically_increasing_id().alias("row")), "scored")
    counts = vocabulary.where(F.col("n") * HEAD <= tokens).select("h", "n")
    tail = scored.select("row", F.explode("tail").alias("h")).join(counts, "h", "left")
    add_one = F.log10((F.coalesce("n", F.lit(0)) + 1.0) / F.lit(tokens + kinds + 1.0))
    tail = tail.groupBy("row").agg(F.count("n").alias("known"), F.sum(add_one).alias("part"))
    return scored.drop("tail").join(tail, "row", "left").select(
        "doc_id", "training", "n_tokens", (F.col("n_head") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("part", F.lit(0.0))).alias("base_score"), "score")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"), fold("doc_id", FOLDS) != HELD_OUT)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
