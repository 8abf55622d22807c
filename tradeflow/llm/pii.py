"""Operator 3: personal data by bootstrapped contextual extraction.

Seeds are the spans of four fixed kinds (email, ip, card, phone). A lexical
pattern is the pair of words before an identifier. Spark scores the graph of
patterns and instances in rounds, until nothing changes: a pattern's confidence in a kind is
the share of all its occurrences in the corpus, whatever follows, that are
followed by trusted instances of the kind; an instance's is that of its best
pattern. Identifier-like tokens behind patterns of high confidence are new finds.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, table, texts

KINDS = ("email", "ip", "card", "phone")
MIN_INSTANCES, MIN_CONFIDENCE, MOST_ROUNDS = 3, 0.5, 1000
LOCAL, CONTEXT_CHARS, WORD_CHARS = "A-Za-z0-9._%+-", 256, 100
MARKS = 1 << 24                  # bits of a map of hashes: 2 MB, whatever the number of patterns
COUNTED_PATTERNS = 1 << 18       # different patterns a task holds before it sends their counts

# fixed patterns of the four kinds; the email's start is left to ``emails``
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_TAIL = re.compile(rf"[{LOCAL}]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# a token that may be an identifier: blanks around it, a digit or an at sign inside
_TOKEN = re.compile(r"(?<!\S)\S*[0-9@]\S*")
_EDGES = "\"'.,;:!?()[]{}<>*#$%&="


def emails(text: str):
    """Leftmost non-overlapping matches of [LOCAL]+@domain, without trying each start of a long run again."""
    done, at = 0, text.find("@")
    while at >= 0:
        low, step = max(done, at - 64), 64
        while low > done and _LOCAL_TAIL.search(text, low, at) and _LOCAL_TAIL.search(text, low, at).start() == low:
            step *= 4
            low = max(done, at - step)
        tail = _LOCAL_TAIL.search(text, low, at)
        domain = _DOMAIN.match(text, at) if tail else None
        if domain:
            yield tail.start(), domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def context(text: str, start: int) -> str | None:
    """The two words before ``start``, lower-cased; None if there are fewer within reach or ``start`` is inside a word."""
    if start and not text[start - 1].isspace():
        return None
    low = max(0, start - CONTEXT_CHARS)
    words = text[low:start].split()
    if low and not text[low - 1].isspace():
        words = words[1:]
    if len(words) < 2 or max(map(len, words[-2:])) > WORD_CHARS:
        return None
    return " ".join(words[-2:]).lower()


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str | None, int, int, str, str]]:
    """(kind or None, start, end, pattern, instance): seeds, and identifier-like tokens outside all seeds."""
    out = []
    for kind, a, b in spans:
        c = context(text, a)
        if c:
            out.append((kind, a, b, c, text[a:b].lower()))
    k = 0
    for m in _TOKEN.finditer(text):
        while k < len(spans) and spans[k][2] <= m.start():
            k += 1
        if any(s[1] < m.end() for s in spans[k:k + 4]):
            continue
        token = m[0].rstrip(_EDGES)
        a = m.start() + len(token) - len(token.lstrip(_EDGES))
        b = m.start() + len(token)
        core = text[a:b]
        if 6 <= len(core) <= WORD_CHARS and ("@" in core or sum("0" <= c <= "9" for c in core) >= 4):
            c = context(text, m.start())
            if c:
                out.append((None, a, b, c, core.lower()))
    return out


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, spans, base, found): base spans, the same as text, and candidate occurrences."""
    def run(batches):
        for batch in batches:
            values = batch.column("text").to_pylist()
            spans = [base_spans(t) for t in values]
            found = [[dict(zip(("kind", "first", "end", "pattern", "instance"), c)) for c in candidates(t, s)] for t, s in zip(values, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([[dict(zip(("kind", "first", "end"), x)) for x in s] for s in spans],
                          pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("end", pa.int32())]))),
                 pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in s) for s in spans], pa.string()),
                 pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("end", pa.int32()),
                                                     ("pattern", pa.string()), ("instance", pa.string())])))],
                names=["doc_id", "spans", "base", "found"])
    return texts(docs).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,first:int,end:int>>, base string, "
             "found array<struct<kind:string,first:int,end:int,pattern:string,instance:string>>")


def _marks(values: DataFrame) -> np.ndarray:
    """Map of MARKS bits with the hash of each value set, put together on Spark; MARKS / 64 numbers reach the driver at most."""
    place = values.select(F.pmod(F.xxhash64(values.columns[0]), F.lit(MARKS)).alias("p"))
    words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    out = np.zeros(MARKS // 64, np.int64)
    for r in words.toLocalIterator():
        out[r["w"]] = r["bits"]
    return out.view(np.uint64)


def _marked(marks: np.ndarray, text: str) -> bool:
    place = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42) & (64 * len(marks) - 1)
    return bool(int(marks[place >> 6]) >> (place & 63) & 1)


def count_patterns(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): occurrences of each of ``patterns`` in all texts, whatever follows it.

    One pass: tasks count the word pairs whose hashes are marked in two maps of fixed size (first words, and pairs) and
    send sums; pairs that only share a hash with a pattern fall out in the join with the patterns on Spark.
    """
    spark = docs.sparkSession
    firsts = spark.sparkContext.broadcast(_marks(patterns.select(F.substring_index("pattern", " ", 1).alias("w")).distinct()))
    pairs = spark.sparkContext.broadcast(_marks(patterns.select("pattern")))

    def run(batches):
        first_marks, pair_marks = firsts.value, pairs.value
        opens: dict[str, bool] = {}
        totals: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["pattern", "n"])
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = text.lower().split()
                for a, b in zip(words, words[1:]):
                    known = opens.get(a)
                    if known is None:
                        if len(opens) >= COUNTED_PATTERNS:
                            opens.clear()
                        known = opens[a] = _marked(first_marks, a)
                    if known:
                        p = f"{a} {b}"
                        if p in totals or _marked(pair_marks, p):
                            totals[p] = totals.get(p, 0) + 1
                if len(totals) >= COUNTED_PATTERNS:
                    yield out()
                    totals.clear()
        yield out()
    counted = texts(docs).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counted.join(patterns.select("pattern").distinct(), "pattern", "left_semi")


def confident_patterns(edges: DataFrame, totals: DataFrame, min_instances: int = MIN_INSTANCES,
                       min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(pattern, kind, confidence) at the fixed point of the pattern-instance graph.

    ``edges``: pattern, instance, kind (of seeds, else NULL), n. A pattern needs
    ``min_instances`` different trusted instances of one kind; repeated copies of
    one text add none. Rounds go on until patterns, kinds and confidences (to 9
    places) stay the same; trust only grows, so they do. Only sums and maxima are
    aggregated, so a frequent pattern or instance is spread over tasks before the
    shuffle.
    """
    graph = materialise(edges.join(totals, "pattern"), "graph")
    seeds = graph.where("kind IS NOT NULL").groupBy("instance", "kind").agg(F.lit(1.0).alias("trust"))
    trusted, before, patterns = seeds, None, None
    for _ in range(MOST_ROUNDS):
        scored = (graph.select("pattern", "instance", "n", "total").join(trusted, "instance")
                  .groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("trust")).alias("hits"), F.max("total").alias("total"),
                                                  F.count_distinct("instance").alias("instances"))
                  .select("pattern", "kind", "instances", F.round(F.least(F.col("hits") / F.col("total"), F.lit(1.0)), 9).alias("confidence")))
        best = (scored.where((F.col("instances") >= min_instances) & (F.col("confidence") >= min_confidence))
                .groupBy("pattern").agg(F.max_by(F.struct("kind", "confidence"), F.struct("confidence", "kind")).alias("best")))
        last, patterns = patterns, materialise(best.select("pattern", "best.kind", "best.confidence"), "patterns")
        if last is not None:
            discard(last)
        state = tuple(patterns.agg(F.count("*"), F.bit_xor(F.xxhash64("pattern", "kind", "confidence"))).first())
        if state == before or not state[0]:
            return patterns
        before = state
        new = (graph.where("kind IS NULL").select("pattern", "instance").join(patterns, "pattern")
               .groupBy("instance", "kind").agg(F.max("confidence").alias("trust")))
        trusted = seeds.unionByName(new).groupBy("instance", "kind").agg(F.max("trust").alias("trust"))
    raise RuntimeError(f"patterns did not settle in {MOST_ROUNDS} rounds")


def find(docs: DataFrame, min_instances: int = MIN_INSTANCES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(doc_id, base, base_spans, spans), one row per document.

    ``base_spans`` and ``spans`` are arrays of (kind, first, end) ordered by
    first, then kind as listed; ``spans`` adds the finds. NULL and empty texts
    have no span; equal rows stay separate rows with equal spans. Texts of any
    length are read whole; an empty table gives no rows. Only doc_id and text are
    read, so other columns may have any name.
    """
    rows = materialise(extract(docs).withColumn("row", F.monotonically_increasing_id()), "extracted")
    found = rows.select("row", F.explode("found").alias("c")).select("row", "c.*")
    edges = materialise(found.groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n")), "edges")
    # a pattern of fewer different instances can never be trusted
    wide = materialise(edges.groupBy("pattern").agg(F.count_distinct("instance").alias("k")).where(F.col("k") >= min_instances).select("pattern"), "wide")
    patterns = confident_patterns(edges, count_patterns(docs, wide), min_instances, min_confidence)
    more = (found.where("kind IS NULL").drop("kind").join(patterns, "pattern")
            .groupBy("row").agg(F.collect_set(F.struct("kind", "first", "end")).alias("more")))
    none = F.array().cast("array<struct<kind:string,first:int,end:int>>")
    both = rows.drop("found").join(more, "row", "left").withColumn("all", F.concat("spans", F.coalesce("more", none)))
    key = F.transform("all", lambda x: F.struct(x["first"].alias("first"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"),
                                                x["kind"].alias("kind"), x["end"].alias("end")))
    ordered = F.transform(F.array_sort(key), lambda x: F.struct(x["kind"].alias("kind"), x["first"].alias("first"), x["end"].alias("end")))
    return both.select("doc_id", "base", F.col("spans").alias("base_spans"), ordered.alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    line = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["end"].cast("string")))
    return out.select("doc_id", *map(count, KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), F.array_join(line, ",").alias("spans"))
