"""Operator 13: phrase collocation mining over FM-indexes of word ids.

Every task cuts its texts into pieces and words and closes a shard per language
whenever it holds ``SHARD_WORDS`` words. Words that are too rare in all shards
together to lie in any candidate become breaks; over the others each shard keeps
the Burrows-Wheeler transforms of its word sequence and of the reversed one,
sorted by contexts of ``DEPTH`` words, as no longer pattern is ever asked for.

A phrase is an interval in both transforms. It is extended to the left in the
forward one and to the right in the reversed one; each step gives all extensions
of all intervals with their counts. Counts are summed over the shards, and a
shard extends only the phrases that are frequent in the whole corpus, and keeps
an extension only if its other part is frequent as well: an extension with a rare
part is itself rare, so no candidate is lost.

What a shard sends to be summed is one sorted, compressed block per bucket of
phrases, not a row per phrase. The task of a bucket adds up equal phrases of all
shards, numbers the frequent ones and answers each shard with the places of its
frequent phrases in the block that it sent. The shard finds their intervals by
repeating its last step, which gives the same phrases in the same order.
"""

from __future__ import annotations

from collections import defaultdict
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, bound_batches, discard, materialise, table

MIN_COUNT, DEPTH, TOP = 30, 4, 2000
SHARD_WORDS = 1 << 19
BYTES_AT_ONCE = 1 << 20
SCORE_SCALE, COVERED = 2_000_000, 80
TOP_SALTS = 64

# fixed values of the contract: separators of pieces and of words
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
_FOLDED = bytes.maketrans(UPPER.encode() + PIECE_ENDS + b"\t", LOWER.encode() + b"\n" * len(PIECE_ENDS) + b" ")

SHARD = "shard long, lang string, ids binary, words array<string>, counts array<long>"
INDEX = "shard long, lang string, forward binary, backward binary, grams binary"
BLOCKS = "shard long, bucket int, block binary"
SUMS = "shard long, bucket int, places array<bigint>, prefixes array<bigint>, suffixes array<bigint>, counts array<bigint>, ids array<bigint>"
BUCKET_PHRASES = 1 << 22              # a bucket has no more phrases than this on average


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as their largest needs, compressed."""
    top = int(numbers.max(initial=0))
    width = 2 if top < 1 << 16 else 4 if top < 1 << 31 else 8
    raw = numbers.astype(f"<u{width}").tobytes()
    return bytes([width]) + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed[9:], int.from_bytes(packed[1:9], "little"), codec="zstd", asbytes=True), f"<u{packed[0]}")


def _array(batch: pa.RecordBatch, i: int, name: str, kind=np.int32) -> np.ndarray:
    return _unpacked(batch[name][i].as_py()).astype(kind)


# ---- shards of word ids ----

def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and a BREAK for every piece end, in parts of bounded size, the last part ending in a BREAK."""
    text = text.translate(_FOLDED)
    at = 0
    while len(text) - at > BYTES_AT_ONCE:
        cut = text.find(b" ", at + BYTES_AT_ONCE)
        if cut < 0:
            break
        yield text[at:cut].replace(b"\n", b" . ").split()
        at = cut
    yield (text[at:] + b"\n").replace(b"\n", b" . ").split()


class _Shard:
    def __init__(self, lang: str):
        self.lang, self.parts, self.size = lang, [], 0
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[BREAK]

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, shard: int) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.ids))[1:]
        words = [w.decode("utf-8", "replace") for w in self.ids][1:]
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([self.lang]), pa.array([_packed(ids)], pa.binary()), pa.array([words], pa.list_(pa.string())),
             pa.array([counts.tolist()], pa.list_(pa.int64()))], ["shard", "lang", "ids", "words", "counts"])


def _shards(limit: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId() << 24, 0, {}
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                by_lang.setdefault(lang, []).append(text.as_buffer().to_pybytes())
            for lang, texts in by_lang.items():
                at = 0
                while at < len(texts):
                    some, size = [texts[at]], len(texts[at])
                    at += 1
                    while at < len(texts) and size + len(texts[at]) < BYTES_AT_ONCE:
                        some.append(texts[at])
                        size += len(texts[at])
                        at += 1
                    for words in _tokens(b"\n".join(some)):
                        shard = held.setdefault(lang, _Shard(lang))
                        shard.add(words)
                        if shard.size >= limit and words and words[-1] == BREAK:      # shards end where a piece ends
                            yield held.pop(lang).row(task + made)
                            made += 1
        for shard in held.values():
            yield shard.row(task + made)
            made += 1
    return build


# ---- FM-indexes ----

def stable_order(values: np.ndarray, top: int) -> np.ndarray:
    """Stable sorting order of integers 0 to ``top``, by 16 bits at a time (numpy sorts those by radix)."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    shift = 16
    while top >> shift:
        order = order[np.argsort(((values >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def transform(s: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of a sequence whose first and last symbol is 0, rotations sorted by their first DEPTH symbols."""
    top, order = int(s.max()), None
    for place in range(DEPTH - 1, -1, -1):
        symbols = np.roll(s, -place)
        order = stable_order(symbols, top) if order is None else order[stable_order(symbols[order], top)]
    return np.roll(s, 1)[order]


def last_to_first(bwt: np.ndarray) -> np.ndarray:
    """Row of each symbol of the last column in the first column."""
    out = np.empty(len(bwt), np.int64)
    out[stable_order(bwt, int(bwt.max(initial=0)))] = np.arange(len(bwt))
    return out


def extend(bwt: np.ndarray, lo: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """All extensions of the intervals by the symbols before them in ``bwt``.

    ``other`` is each interval's start in the transform of the other direction.
    Returns (interval, symbol, new lo, new other, count); breaks do not extend.
    """
    ends = np.cumsum(n)
    which = np.repeat(np.arange(len(lo)), n)
    rows = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(lo - (ends - n), n)
    symbol = bwt[rows].astype(np.int64)
    order = stable_order(symbol, int(symbol.max(initial=0)))  # stable: the first row of a symbol comes first
    order = order[stable_order(which[order], len(lo))]
    which, symbol, rows = which[order], symbol[order], rows[order]
    starts = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (symbol[1:] != symbol[:-1])]) if len(rows) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(rows)])
    smaller = starts - (ends - n)[which[starts]]              # symbols below this one in the interval
    real = symbol[starts] > 0
    starts, counts, smaller = starts[real], counts[real], smaller[real]
    parent = which[starts]
    return parent, symbol[starts], last_to_first(bwt)[rows[starts]], other[parent] + smaller, counts


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both transforms of each shard over its frequent words alone."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids = _array(batch, i, "ids")
            places, grams = batch["places"][i].values.to_numpy(), batch["grams"][i].values.to_numpy()
            order = np.argsort(places)
            symbols = np.zeros(max(int(ids.max(initial=0)), int(places.max(initial=0))) + 1, np.int32)
            symbols[places[order]] = np.arange(1, len(places) + 1)
            s = symbols[ids]
            s = np.r_[np.int32(0), s[(s > 0) | np.r_[True, s[:-1] > 0]], np.int32(0)]     # one break for many
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch["shard"][i].as_py()]), pa.array([batch["lang"][i].as_py()]), pa.array([_packed(transform(s))], pa.binary()),
                 pa.array([_packed(transform(s[::-1]))], pa.binary()), pa.array([_packed(grams[order])], pa.binary())],
                ["shard", "lang", "forward", "backward", "grams"])


def _of(sorted_starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Position of the interval that holds each row, -1 if none does."""
    if not len(sorted_starts):
        return np.full(len(at), -1)
    found = np.searchsorted(sorted_starts, at, "right") - 1
    return np.where((found >= 0) & (at < sorted_starts[found] + sizes[found]), found, -1)


def _word_intervals(bwt: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the intervals of symbols 1 to ``words``; the same in both transforms."""
    n = np.bincount(bwt, minlength=words + 1)[1:]
    return np.cumsum(np.r_[len(bwt) - n.sum(), n])[:-1], n


class _Step:
    """Phrases of one length in a shard (start forward, start backward, count, id) and their extensions by one word."""

    def __init__(self, lo, back, n, ids):
        order = np.argsort(lo, kind="stable")
        self.lo, self.back, self.n, self.ids = (np.asarray(x, np.int64)[order] for x in (lo, back, n, ids))

    def longer(self, bwt: np.ndarray, left: bool, words: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(prefix, suffix, lo, back, n) of the extensions whose other part is frequent too. ``words`` are the ids of the
        symbols, for phrases of a single word, whose other part is the symbol itself."""
        start, other = (self.lo, self.back) if left else (self.back, self.lo)
        order = np.arange(len(start)) if left else np.argsort(start, kind="stable")
        start, other, n, ids = start[order], other[order], self.n[order], self.ids[order]
        parent, symbol, new, new_other, counts = extend(bwt, start, other, n)
        if words is not None:
            part = words[symbol - 1]
        else:                                           # the phrase without the parent's far end
            place = _of(start, n, new)
            keep = place >= 0
            parent, new, new_other, counts, part = parent[keep], new[keep], new_other[keep], counts[keep], ids[place[keep]]
        mine = ids[parent]
        return (part, mine, new, new_other, counts) if left else (mine, part, new_other, new, counts)


def bucket_of(prefix: np.ndarray, suffix: np.ndarray, buckets: int) -> np.ndarray:
    mixed = prefix.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + suffix.astype(np.uint64)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(prefix: np.ndarray, suffix: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, ends): extensions by bucket, then prefix, then suffix, and where each bucket ends."""
    bucket = bucket_of(prefix, suffix, buckets)
    order = np.lexsort((suffix, prefix, bucket))
    return order, np.cumsum(np.bincount(bucket, minlength=buckets))


def _write(prefix: np.ndarray, suffix: np.ndarray, counts: np.ndarray) -> bytes:
    """One compressed block of sorted phrases; prefixes as differences."""
    return _packed(np.concatenate([np.diff(prefix, prepend=0), suffix, counts]))


def _read(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = _unpacked(block).astype(np.int64).reshape(3, -1)
    return np.cumsum(numbers[0]), numbers[1], numbers[2]


def _blocks(shard: int, prefix: np.ndarray, suffix: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    order, ends = _by_bucket(prefix, suffix, buckets)
    prefix, suffix, counts = prefix[order], suffix[order], counts[order]
    starts = np.r_[0, ends[:-1]]
    held = np.flatnonzero(ends > starts)
    blocks = [_write(prefix[a:z], suffix[a:z], counts[a:z]) for a, z in zip(starts[held], ends[held])]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(held), shard, np.int64)), pa.array(held.astype(np.int32)), pa.array(blocks, pa.binary())],
                                      ["shard", "bucket", "block"])


def _sum_bucket(min_count: int, buckets: int):
    """Add up a bucket's phrases over its shards: one row of the frequent ones, and one per shard that has any of them."""
    def add(group: pa.Table) -> pa.Table:
        bucket, shards = group["bucket"][0].as_py(), group["shard"].to_pylist()
        parts = [_read(b.as_py()) for b in group["block"]]
        sizes = [len(p[0]) for p in parts]
        prefix, suffix, counts = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((suffix, prefix))
        prefix, suffix = prefix[order], suffix[order]
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])])
        sums = np.add.reduceat(counts[order], starts)
        frequent = sums >= min_count
        ids = np.full(len(starts), -1, np.int64)
        ids[frequent] = bucket + buckets * np.arange(int(frequent.sum()))
        first = starts[frequent]
        rows = [(None, None, prefix[first], suffix[first], sums[frequent], ids[frequent])]
        each = np.empty(len(order), np.int64)
        each[order] = np.repeat(ids, np.diff(np.r_[starts, len(order)]))
        at = 0
        for shard, size in zip(shards, sizes):
            mine = each[at:at + size]
            at += size
            places = np.flatnonzero(mine >= 0)
            if len(places):
                rows.append((shard, places, None, None, None, mine[places]))
        column = lambda k: pa.array([r[k] for r in rows], pa.list_(pa.int64()))
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()),
                         *[column(k) for k in range(1, 6)]], ["shard", "bucket", "places", "prefixes", "suffixes", "counts", "ids"])
    return add


def _chosen(batch: pa.RecordBatch, i: int, name: str, buckets: int, found: tuple[np.ndarray, ...]) -> _Step:
    """The frequent ones of a repeated step, by the answers (bucket, places in its block, ids) of the sums."""
    prefix, suffix, lo, back, n = found
    order, ends = _by_bucket(prefix, suffix, buckets)
    starts = np.r_[0, ends[:-1]]
    answers = batch[name][i].as_py()
    at = np.concatenate([starts[a["bucket"]] + np.array(a["places"], np.int64) for a in answers])
    places = order[at]
    return _Step(lo[places], back[places], n[places], np.concatenate([np.array(a["ids"], np.int64) for a in answers]))


def _pairs_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    bwt, words = _array(batch, i, "forward"), _array(batch, i, "grams", np.int64)
    lo, n = _word_intervals(bwt, len(words))
    return _Step(lo, lo, n, words).longer(bwt, True, words)


def _find_pairs(buckets: int):
    """Left extensions of all frequent words of each shard."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                prefix, suffix, _, _, n = _pairs_of(batch, i)
                yield _blocks(batch["shard"][i].as_py(), prefix, suffix, n, buckets)
    return find


def _find_triples(buckets: int):
    """Right extensions of the frequent pairs of each shard."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = _chosen(batch, i, "pairs", buckets, _pairs_of(batch, i))
                prefix, suffix, _, _, n = pairs.longer(_array(batch, i, "backward"), False)
                yield _blocks(batch["shard"][i].as_py(), prefix, suffix, n, buckets)
    return find


def _find_quadruples(buckets: int):
    """Left extensions of the frequent triples of each shard."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = _chosen(batch, i, "pairs", buckets, _pairs_of(batch, i))
                triples = _chosen(batch, i, "triples", buckets, pairs.longer(_array(batch, i, "backward"), False))
                prefix, suffix, _, _, n = triples.longer(_array(batch, i, "forward"), True)
                yield _blocks(batch["shard"][i].as_py(), prefix, suffix, n, buckets)
    return find


# ---- Spark ----

def _summed(blocks: DataFrame, min_count: int, buckets: int, name: str) -> DataFrame:
    return materialise(blocks.groupBy("bucket").applyInArrow(_sum_bucket(min_count, buckets), SUMS), name)


def _grams(sums: DataFrame) -> DataFrame:
    """(id, prefix, suffix, f) of the frequent phrases."""
    each = sums.where("shard IS NULL").select(F.explode(F.arrays_zip("ids", "prefixes", "suffixes", "counts")).alias("g"))
    return each.select(F.col("g.ids").alias("id"), F.col("g.prefixes").alias("prefix"), F.col("g.suffixes").alias("suffix"), F.col("g.counts").alias("f"))


def _answers(sums: DataFrame, name: str) -> DataFrame:
    """Per shard the places of its frequent phrases, no more of them than the shard has words."""
    return sums.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("bucket", "places", "ids")).alias(name))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, written, with consecutive ids: the rows of each written part are numbered from where the part before ends.

    Only one number per part reaches the driver."""
    written = materialise(df.withColumn("_n", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("_n", 33), F.col("_n").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["p"], r["n"]) for r in written.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = written.sparkSession.createDataFrame(starts, "_part long, _start long")
    return written.withColumn("_part", part.cast("long")).join(F.broadcast(offsets), "_part").withColumn("id", F.col("_start") + place).drop(
        "_n", "_part", "_start")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, ...]:
    """(totals, words, pairs, triples, quadruples) of ``docs`` (text, lang), per language.

    totals: lang, n (all words). words: id, lang, word, f. The others: id,
    prefix, suffix (ids one level below), f, for the phrases that occur
    ``min_count`` times or more within pieces.

    NULL text is empty, NULL lang is 'und'; texts of any length are read whole; a
    shard grows beyond ``shard_words`` until the next piece end. Repeated rows
    count each time. An empty table gives empty results.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    shards = materialise(texts.where("text <> ''").mapInArrow(_shards(shard_words), SHARD), "phrase-shards")
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select(
        "shard", "lang", (F.col("place") + 1).alias("place"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = materialise(listed.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    sums = listed.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    words = _numbered(sums, "phrase-words")

    own = listed.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("shard").agg(F.collect_list(F.struct("place", "id")).alias("g"))
    own = own.select("shard", F.col("g")["place"].alias("places"), F.col("g")["id"].alias("grams"))
    index = materialise(shards.select("shard", "lang", "ids").join(own, "shard").mapInArrow(_index, INDEX), "phrase-index")
    discard(shards)

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_PHRASES))
    found = index.select("shard", "forward", "grams").mapInArrow(_find_pairs(buckets), BLOCKS)
    pairs = _summed(found, min_count, buckets, "phrase-pairs")
    known = index.join(_answers(pairs, "pairs"), "shard")
    found = known.select("shard", "forward", "backward", "grams", "pairs").mapInArrow(_find_triples(buckets), BLOCKS)
    triples = _summed(found, min_count, buckets, "phrase-triples")
    known = known.join(_answers(triples, "triples"), "shard")
    found = known.select("shard", "forward", "backward", "grams", "pairs", "triples").mapInArrow(_find_quadruples(buckets), BLOCKS)
    quadruples = _summed(found, min_count, buckets, "phrase-quadruples")
    discard(index)
    return totals, words, _grams(pairs), _grams(triples), _grams(quadruples)


def _cut(k: int, left: Column, right: Column) -> Column:
    """Score of the cut after k words, exact: the product is a decimal."""
    wide = lambda c: c.cast("decimal(19,0)")
    value = F.call_function("div", F.lit(SCORE_SCALE).cast("decimal(7,0)") * wide(F.col("a")), wide(left) + wide(right))
    return F.struct(value.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and left_extensions, right_extensions.

    Candidates are phrases of 2 to 4 words that occur ``min_count`` times or
    more. The score is that of the weakest cut, floor(SCORE_SCALE * a / (l + r));
    ties go to the first cut. Candidates inside a longer one with ``covered`` % of
    their count or more are dropped. Each language's first ``top`` by score, count
    and phrase (bytes) stay. The extensions are the numbers of candidates one word
    longer to that side (NULL at the longest phrases, which are not extended).
    """
    totals, words, pairs, triples, quadruples = mine(docs, min_count, shard_words)
    w = words.select("id", "lang", "word", "f")
    one, two = w.alias("p"), w.alias("s")
    second = pairs.join(one, F.col("prefix") == F.col("p.id")).join(two, F.col("suffix") == F.col("s.id")).select(
        pairs["id"], pairs["f"].alias("a"), "prefix", "suffix", F.col("p.lang").alias("lang"), F.concat_ws(" ", "p.word", "s.word").alias("phrase"),
        F.col("s.word").alias("last"), F.col("p.f").alias("f1"), F.col("s.f").alias("f2"))
    second = materialise(second, "phrase-second")
    third = triples.select("id", F.col("f").alias("a"), "prefix", "suffix").alias("t").join(
        second.alias("p"), F.col("t.prefix") == F.col("p.id")).join(second.alias("s"), F.col("t.suffix") == F.col("s.id")).select(
        F.col("t.id").alias("id"), F.col("t.a").alias("a"), "t.prefix", "t.suffix", "p.lang", F.concat_ws(" ", "p.phrase", "s.last").alias("phrase"), "s.last",
        "p.f1", F.col("p.a").alias("f12"), F.col("s.a").alias("f23"), F.col("s.f2").alias("f3"))
    third = materialise(third, "phrase-third")
    fourth = quadruples.select("id", F.col("f").alias("a"), "prefix", "suffix").alias("q").join(
        third.alias("p"), F.col("q.prefix") == F.col("p.id")).join(third.alias("s"), F.col("q.suffix") == F.col("s.id"))
    fourth = fourth.select(
        F.col("q.id").alias("id"), F.col("q.a").alias("a"), "q.prefix", "q.suffix", F.col("p.prefix").alias("first"), F.col("p.suffix").alias("middle"),
        F.col("s.suffix").alias("last_two"), "p.lang", F.concat_ws(" ", "p.phrase", "s.last").alias("phrase"), "p.f1", F.col("p.a").alias("f123"),
        F.col("p.f12").alias("f12"), F.col("s.f23").alias("f34"), F.col("s.a").alias("f234"), F.col("s.f3").alias("f4"))
    fourth = materialise(fourth, "phrase-fourth")

    inside3 = fourth.select(F.explode(F.array("prefix", "suffix")).alias("id"), "a")
    inside2 = third.select(F.explode(F.array("prefix", "suffix")).alias("id"), "a").unionByName(
        fourth.select(F.explode(F.array("first", "middle", "last_two")).alias("id"), "a"))

    def extensions(longer: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (longer.groupBy(F.col("suffix").alias("id")).agg(F.count(F.lit(1)).alias("left_extensions")),
                longer.groupBy(F.col("prefix").alias("id")).agg(F.count(F.lit(1)).alias("right_extensions")))

    def free(grams: DataFrame, inside: DataFrame, longer: DataFrame) -> DataFrame:
        most = inside.groupBy("id").agg(F.max("a").alias("most"))
        left, right = extensions(longer)
        out = grams.join(most, "id", "left").where(
            F.col("most").isNull() | (F.col("most").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * covered))
        zero = F.lit(0).cast("long")
        return out.join(left, "id", "left").join(right, "id", "left").withColumns(
            {c: F.coalesce(F.col(c), zero) for c in ("left_extensions", "right_extensions")})

    def scored(grams: DataFrame, *cuts: Column) -> DataFrame:
        return grams.withColumn("c", F.array_min(F.array(*cuts))).select(
            "lang", "phrase", "a", "c.l", "c.r", "c.score", "left_extensions", "right_extensions")

    c = F.col
    no = F.lit(None).cast("long")
    rows = scored(free(second, inside2, third), _cut(1, c("f1"), c("f2"))).unionByName(
        scored(free(third, inside3, fourth), _cut(1, c("f1"), c("f23")), _cut(2, c("f12"), c("f3")))).unionByName(
        scored(fourth.withColumns({"left_extensions": no, "right_extensions": no}),
               _cut(1, c("f1"), c("f234")), _cut(2, c("f12"), c("f34")), _cut(3, c("f123"), c("f4"))))
    # first within salts of a language, then over them: no language meets in one task as a whole
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_extensions", "right_extensions")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents")).drop("left_extensions", "right_extensions")
