"""Hard negatives, exact dedup and phrase mining, against brute force."""
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeflow.llm import exact_dedup, hard_negatives, phrases
from tradeflow.llm.common import bound_batches
from tradeflow.llm.queries import ORACLE_SQL, QUERIES

from tests.harness import compare, duck_connection

from .conftest import ROWS, SCHEMA

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_exact_dedup", "op13_phrases"])
def test_query_equals_its_sql(llm, name):
    got = compare(QUERIES[name](llm, SF), duck_connection(SF), ORACLE_SQL[name])
    assert got["ok"], got


@pytest.mark.parametrize("held, then", [("64m", "8388608"), ("67108864b", "8388608"), ("1g", "8388608"), ("4096k", "4096k"), ("1000", "1000")])
def test_batches_are_bounded(llm, held, then):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = llm.conf.get(name)
    try:
        llm.conf.set(name, held)
        bound_batches(llm)
        assert llm.conf.get(name) == then
    finally:
        llm.conf.set(name, before)


# ---- exact dedup ----

def plain_classes(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, first = max(known) if known else None, True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    return collections.Counter(out)


def found_classes(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect())


def test_exact_classes_of_odd_rows(llm, docs, no_docs):
    assert found_classes(exact_dedup.exact_classes(docs)) == plain_classes([(r[0], r[1]) for r in ROWS])
    assert exact_dedup.exact_classes(no_docs).count() == 0


def test_null_ids_alone_keep_one_row(llm):
    rows = [(None, "a"), (None, "a"), (3, "b"), (None, "b"), (5, None), (6, "")]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    assert found_classes(exact_dedup.exact_classes(df)) == plain_classes(rows)
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.drop_exact_copies(df).collect()) == [("3", "b"), ("6", ""), ("None", "a")]


@pytest.mark.parametrize("hot_parts", [2, 8192])
def test_texts_that_share_a_digest_stay_apart(llm, monkeypatch, hot_parts):
    monkeypatch.setattr(exact_dedup, "HOT_PARTS", hot_parts)
    rng = random.Random(3)
    rows = [(i, rng.choice(["aa", "ab", "ba", "a", "", None, "hot", "hot", "hot", "hot"])) for i in range(120)]
    got = exact_dedup.exact_classes(llm.createDataFrame(rows, "doc_id long, text string"), lambda t: F.substring(t, 1, 1), salts=4)
    plain = collections.Counter((i, k, n, kept) for (i, k, n, kept, _), c in plain_classes(rows).items() for _ in range(c))
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == plain


def test_drop_exact_copies_keeps_all_columns(llm, docs):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        (r[0] is None, r[0]) for r in {(i, k) for (i, k, _, kept, h), _ in plain_classes([(r[0], r[1]) for r in ROWS]).items() if kept})


# ---- hard negatives ----

def plain_negatives(rows, positives=5, negatives=5):
    seen = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        value = (label, [math.floor(256 * v) for v in vector])
        seen[vec_id] = min(seen.get(vec_id, value), value)
    out = set()
    for a, (label, x) in seen.items():
        if a % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in seen.items() if i != a))
        for minus, p, other in [s for s in scored if s[2] == label][:positives]:
            far = [s for s in scored if s[2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:negatives]
            out |= {(a, p, rank, s[1], -minus, -s[0]) for rank, s in enumerate(far, 1)}
    return out


def mined(llm, rows, monkeypatch=None):
    table = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x int, r string, lane int, score long").repartition(3)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    got = hard_negatives.mine(hard_negatives.usable(table, label), F.col("vec_id") % 100 == 0, lanes=3).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_hard_negatives_of_odd_rows(llm, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    extra = (1, "r", 2, 3)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=5).round(1)], int(rng.integers(0, 3)), *extra) for i in range(230)]
    rows += [(231, None, 1, *extra), (232, [1.0, None], 1, *extra), (233, [float("nan")] * 5, 1, *extra), (234, [float("inf")] * 5, 1, *extra),
             (235, [1.0] * 5, None, *extra), (None, [1.0] * 5, 1, *extra), (236, [], 1, *extra), (237, [2.0, -1.0], 1, *extra),
             (300, [0.0] * 5, 0, *extra), (400, [0.5] * 9, 9, *extra), rows[5], rows[100], (6, [9.0] * 5, 2, *extra)]
    assert mined(llm, rows) == plain_negatives([r[:3] for r in rows]) != set()


def test_hard_negatives_of_few_rows(llm):
    assert mined(llm, []) == set()
    assert mined(llm, [(100, [1.0], 1, 0, "", 0, 0)]) == set()
    with pytest.raises(Exception, match="too large"):
        mined(llm, [(100, [1e30], 1, 0, "", 0, 0), (101, [1e30], 1, 0, "", 0, 0)])


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_intervals_hold_every_score(width):
    rng = np.random.default_rng(width)
    x = np.floor(rng.normal(size=(200, width)) * 256).astype(np.int64)
    x[0], x[1] = 0, 5
    anchors = np.r_[x[:20], np.floor(rng.normal(size=(20, width)) * 9).astype(np.int64)]
    centre, half = hard_negatives.estimate(*hard_negatives.encode(x), anchors)
    assert (np.abs(centre - x @ anchors.T) <= half).all()
    if width >= 64:         # and are narrow enough to discard pairs
        assert np.median(half) < 0.2 * np.median(np.linalg.norm(x, axis=1)) * np.median(np.linalg.norm(anchors, axis=1)[:20])


# ---- phrases ----

def plain_phrases(rows, least, top=2000, covered=80):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i:i + n])] += 1
    frequent = {k: v for k, v in counts.items() if len(k[1]) > 1 and v >= least}
    inside = {}
    for (lang, p), v in frequent.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                inside[lang, p[i:i + n]] = max(v, inside.get((lang, p[i:i + n]), 0))
    out = set()
    for lang in totals:
        kept = []
        for (other, p), a in frequent.items():
            if other == lang and 100 * inside.get((lang, p), 0) < covered * a:
                score, k = min((2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("shard_words", [7, 100, 1 << 21])
def test_phrases_by_brute_force(llm, shard_words, monkeypatch):
    monkeypatch.setattr(phrases, "BYTES_AT_ONCE", 300)
    rng = random.Random(shard_words)
    words = ["Of", "the", "a", "É", "cat", "Dog\x1c", "x\x00y", "sat", "日本"]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(words[:rng.randint(2, 9)]) + rng.choice([" "] * 9 + ["\t", "  ", ".", "\n", ", ", "\r\n", "\x0b", " "])
                       for _ in range(rng.randint(0, 40)))
        rows.append((i, rng.choice([text, text, "of the cat sat", None, "", " . "]), rng.choice(["en", "de", None, "und"])))
    rows.append((200, "the cat sat on " * 3000, "en"))
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = phrases.collocations(docs, min_count=3, top=40, shard_words=shard_words).drop("left_extensions", "right_extensions")
    assert {tuple(r) for r in got.collect()} == plain_phrases([(r[2], r[1]) for r in rows], 3, 40)


def test_phrases_of_odd_rows(llm, docs, no_docs):
    got = phrases.collocations(docs, min_count=2).drop("left_extensions", "right_extensions")
    names = SCHEMA.split(", ")
    lang = next(i for i, n in enumerate(names) if n.startswith("lang "))
    assert {tuple(r) for r in got.collect()} == plain_phrases([(r[lang], r[1]) for r in ROWS], 2)
    assert phrases.collocations(no_docs).count() == 0


def test_extensions_are_counted(llm):
    docs = llm.createDataFrame([("en", "a b c. x b c. a b d. b c d")] * 3, "lang string, text string")
    totals, words, pairs, triples, quadruples = phrases.mine(docs, min_count=3)
    assert (words.count(), pairs.count(), triples.count(), quadruples.count()) == (5, 5, 4, 0)
    got = {r.phrase: (r.left_extensions, r.right_extensions) for r in phrases.collocations(docs, min_count=3, covered=101).collect()}
    assert got["b c"] == (2, 1) and got["a b"] == (0, 2) and got["a b c"] == (0, 0)


def test_transform_counts_like_a_scan():
    rng = np.random.default_rng(2)
    s = np.r_[0, rng.integers(0, 4, 400), 0].astype(np.int32)
    bwt, back = phrases.transform(s), phrases.transform(s[::-1])
    n = np.bincount(s, minlength=4)[1:]
    lo = np.cumsum(np.r_[len(s) - n.sum(), n])[:-1]
    parent, symbol, new, other, counts = phrases.extend(bwt, lo, lo, n)
    scan = collections.Counter(zip(s[:-1], s[1:]))
    assert {(c, p + 1): k for p, c, k in zip(parent, symbol, counts)} == {k: v for k, v in scan.items() if k[0] and k[1]}
    again = phrases.extend(back, other, new, counts)                       # to the right, from the other side
    triples = collections.Counter(zip(s[:-2], s[1:-1], s[2:]))
    assert {(symbol[p], parent[p] + 1, c): k for p, c, _, _, k in zip(*again)} == {k: v for k, v in triples.items() if all(k)}
