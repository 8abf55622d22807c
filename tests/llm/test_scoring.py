"""LM scoring, language ID, quality, token counts."""
import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tradeflow.llm import language_id, lm_scoring, quality, token_counts
from tradeflow.llm.common import fold

from .conftest import ROWS

SF = "/root/testdata/sf0.001"


def crc(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


def test_lm_scoring_counts_are_exact_and_scores_beat_the_base(docs):
    rows = lm_scoring.score(docs, fold("doc_id", 7) != 2).collect()
    words = lambda t: lm_scoring.words_of((t or "").encode())
    counts = collections.Counter(w for r in ROWS if crc(r[0], 7) != 2 for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(r[0]), len(words(r[1])), sum(counts[w] > 0 for w in words(r[1])),
                       round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(r[1])), 6)) for r in ROWS)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == expected
    assert all(r.train_tokens == n and r.training == (crc(r.doc_id, 7) != 2) for r in rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_scoring_without_rows(docs, no_docs):
    assert lm_scoring.score(no_docs, F.lit(True)).count() == 0
    rows = lm_scoring.score(docs, F.lit(False)).collect()           # nothing to learn from
    assert len(rows) == len(ROWS) and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_filter_reads_counts_back_in_segments():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20000).astype(np.uint64))
    counts = np.minimum(rng.zipf(1.5, len(keys)), 10 ** 6)
    raw, entries, rare = lm_scoring.build_bucket(keys, counts)
    assert rare == [(counts == 1).sum(), (counts == 2).sum()]
    segment = lm_scoring.Segment(5, [len(raw)], raw)
    got = segment.counts(keys, np.full(len(keys), 5), lm_scoring.BIGRAM)
    q = lm_scoring.levels(counts)
    assert (got >= lm_scoring.LEVEL_VALUES[q]).all() and (got == lm_scoring.LEVEL_VALUES[q]).mean() > 0.9
    other = rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    assert (segment.counts(other, np.full(len(other), 5), lm_scoring.BIGRAM) > 0).mean() < 0.08


def test_language_id_held_out_accuracy(llm):
    out = language_id.op5_language_id(llm, SF)
    rows = out.join(llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_edge_cases(docs, no_docs):
    prototypes = language_id.learn(docs)
    assert sorted(prototypes) == ["de", "en"]
    rows = collections.defaultdict(list)
    for r in language_id.identify(docs, prototypes).collect():
        rows[r.doc_id].append((r.lang_pred, r.score))
    assert rows[4] == rows[5] == rows[6] == [("und", 0.0)]
    assert rows[3][0][0] == "de" and rows[1] == rows[2] and rows[1][0][0] == "en" and len(rows[12]) == 2
    assert language_id.identify(no_docs, prototypes).count() == 0 and language_id.learn(no_docs) == {}
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}
    kept = language_id.keep_identified(docs, prototypes, min_score=0.0)      # texts without a letter go
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert language_id.keep_identified(docs, prototypes, min_score=2.0, min_letters=0).count() == 0
    few = language_id.keep_identified(docs, prototypes, min_score=2.0, min_letters=32).collect()
    assert few and all(0 < sum(map(str.isalpha, r.text)) < 32 for r in few)
    with pytest.raises(Exception, match="more than 1 languages"):
        language_id.learn(docs, max_labels=1)


def test_ngram_vectors_are_bound_rotated_letters():
    table = language_id.Letters(64)
    vector = language_id.text_vectors(["ab"], table)[0]
    letter = {c: table.vectors[table.row_of[ord(c)]] for c in "ab "}
    ngram = lambda x, y, z: np.roll(letter[x], 2) * np.roll(letter[y], 1) * letter[z]
    assert (vector == ngram(" ", "a", "b") + ngram("a", "b", " ")).all()
    both = language_id.text_vectors(["ab", "", "ba !? ab"], table)
    assert (both[0] == vector).all() and not both[1].any()


def plain_vector(text, table):
    """One rotated, bound letter at a time."""
    letters = [c if c.isalpha() else " " for c in text.lower()]
    run = " " + "".join(c for i, c in enumerate(letters) if c != " " or i == 0 or letters[i - 1] != " ") + " "
    run = re.sub(" +", " ", run)
    table.rows(np.array([ord(c) for c in run], np.uint32))
    out = np.zeros(table.dimensions)
    for trio in zip(run, run[1:], run[2:]):
        if trio[1] != " " or " " not in (trio[0], trio[2]):
            out += np.prod([np.roll(table.vectors[table.row_of[ord(c)]], 2 - k) for k, c in enumerate(trio)], axis=0)
    return out


def test_language_id_by_brute_force(llm):
    rows = [(1, "Der Hund läuft.", "de"), (2, "The dog runs!", "en"), (3, "the CAT", "en"), (4, "Katze 12 Maus", "de"), (5, "", "en"), (6, "dog und Hund", None)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    table = language_id.Letters(256)
    expected = {name: sum(plain_vector(t, table) for _, t, lang in rows if lang == name) for name in ("de", "en")}
    got = language_id.learn(docs, dimensions=256)
    assert {k: v.tolist() for k, v in got.items()} == {k: v.tolist() for k, v in expected.items()}
    for r in language_id.identify(docs, got, dimensions=256).collect():
        vector = plain_vector(rows[r.doc_id - 1][1], table)
        if not vector.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosine = {k: vector @ v / np.linalg.norm(vector) / np.linalg.norm(v) for k, v in expected.items()}
        assert r.lang_pred == max(cosine, key=cosine.get) and abs(r.score - max(0.0, max(cosine.values()))) < 1e-5


def test_language_counts_of_huge_alphabets():
    rng = np.random.default_rng(1)
    base = 1_114_000                                      # every code point a letter of its own: base cubed is near 2^63
    group, code = np.sort(rng.integers(0, 50, 4000)), rng.integers(base ** 3 - 40, base ** 3, 4000)
    got = language_id.grouped_counts(group, code, 50, base)
    small = language_id.grouped_counts(group, code - (base ** 3 - 40), 50, 40)
    assert all((a == b).all() for a, b in zip(got, (small[0], small[1] + (base ** 3 - 40), small[2])))
    plain = collections.Counter(zip(group.tolist(), code.tolist()))
    assert {(g, c): n for g, c, n in zip(*map(np.ndarray.tolist, got))} == plain


def test_languages_that_were_not_learnt_go(llm):
    documents = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prototypes = language_id.learn(documents)
    strange = ["Съешь же ещё этих мягких французских булок да выпей чаю.", "これは日本語の文章です。言語を識別するための例文なので、もう少し長くします。",
               "Η γρήγορη καφέ αλεπού πηδάει πάνω από το σκυλί", "Zażółć gęślą jaźń, proszę państwa, to jest zdanie"]
    rows = llm.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(strange)], documents.schema)
    kept = language_id.keep_identified(documents.unionByName(rows), prototypes)
    assert kept.where("doc_id < 0").count() == 0
    lost = documents.join(kept, "doc_id", "left_anti").collect()
    assert len(lost) <= documents.count() // 500, lost


def test_vectors_do_not_depend_on_the_kinds_held_at_once(monkeypatch):
    texts = ["the quick brown fox", "", "über den Wolken 123", "x"]
    whole = language_id.text_vectors(texts, language_id.Letters(64))
    monkeypatch.setattr(language_id, "KINDS_AT_ONCE", 3)
    assert (language_id.text_vectors(texts, language_id.Letters(64)) == whole).all()


def test_quality_held_out(llm):
    rows = quality.op8_quality(llm, SF).join(llm.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_edge_cases(docs, no_docs):
    feats = quality.features(docs)
    assert feats.count() == len(ROWS) and quality.features(no_docs).count() == 0
    labelled = feats.select("x", (F.coalesce("doc_id", F.lit(0)) % 2).cast("int").alias("label"))
    fitted = quality.fit(labelled)
    assert isinstance(fitted, quality.Discriminant)
    assert all(0 <= r.score <= 1 for r in quality.score(feats, fitted).collect())
    assert quality.fit(labelled.where("label = 1")) == 1.0 and quality.fit(labelled.where("false")) == 0.5


def test_quality_fit_by_brute_force(llm):
    """Sums added by Spark over many partitions against covariances taken from the rows."""
    rng, d = np.random.default_rng(3), len(quality.FEATURES)
    groups = [rng.normal(size=(60, d)) @ rng.normal(size=(d, d)) + 3, rng.normal(size=(25, d)) * rng.uniform(0.1, 5, d)]
    rows = [(x.tolist(), k) for k, g in enumerate(groups) for x in g]
    random.Random(1).shuffle(rows)
    fitted = quality.fit(llm.createDataFrame(rows, "x array<double>, label int").repartition(7), 0.3, 0.1, 2.0)
    n = [len(g) for g in groups]
    covs = [np.cov(g.T, bias=True) for g in groups]
    pooled = (covs[0] * n[0] + covs[1] * n[1]) / sum(n)
    centre, scale = np.concatenate(groups).mean(axis=0), np.sqrt(np.diag(pooled))
    points = rng.normal(size=(40, d)) * 3
    density = []
    for g, cov in zip(groups, covs):
        s = (0.7 * cov + 0.3 * pooled) / np.outer(scale, scale)
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 1e-4 * np.eye(d)
        z = (points - g.mean(axis=0)) / scale
        density.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) - 0.5 * np.linalg.slogdet(s)[1])
    expected = 1 / (1 + np.exp(-((density[1] - density[0]) / 2.0 + math.log(n[1] / n[0]))))
    assert np.allclose(fitted.scores(points), expected, atol=1e-6) and np.allclose(fitted.centre, centre)


@pytest.mark.parametrize("labels, constant", [([], 0.5), ([(1, 1, 0)], 1.0), ([(1, 0, 1), (3, 0, 0)], 0.0), ([(None, 1, 1), (1, None, 1), (3, 7, 0)], 0.5)])
def test_quality_with_odd_labels(llm, docs, tmp_path, labels, constant):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = quality.op8_quality(llm, str(tmp_path)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    learnt = [x for x in labels if x[0] is not None and x[1] in (0, 1) and crc(x[0], 5) != 0]
    if len({x[1] for x in learnt}) < 2:
        assert {r.score for r in rows} == {constant}


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(2)
    d = len(quality.FEATURES)
    x = rng.normal(size=(5, d))
    covs = [np.eye(d) * 2.0, np.eye(d) * 0.5]
    factors = [np.linalg.inv(np.linalg.cholesky(c)) for c in covs]
    halves = [0.5 * np.linalg.slogdet(c)[1] for c in covs]
    model = quality.Discriminant(0.3, np.zeros(d), np.ones(d), (np.zeros(d), np.ones(d)), tuple(factors), tuple(halves), 1.0)
    log = [-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - h for m, c, h in zip((0.0, 1.0), covs, halves)]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-(log[1] - log[0] + 0.3))))


@pytest.mark.parametrize("chunk,overlap", [(20, 4), (64, 8), (100, 30)])
def test_token_counts_of_spliced_chunks(chunk, overlap):
    processor = token_counts.model(public_tokenizers.path("piece_bpe_32k.model"))
    encode, count = token_counts.offsets_encoder(processor), lambda raw: len(processor.encode(raw))
    rng = random.Random(chunk)
    parts = ["a", "e", "th", "ing", " ", "  ", "\n", "日", "😀", "é", ".", "1", "xxxxx", "▁", " the ", "$$", "<s>"]
    for _ in range(400):
        raw = "".join(rng.choice(parts) for _ in range(rng.randint(0, 300))).encode()
        assert token_counts.count_tokens(raw, encode, count, chunk, overlap) == count(raw)


def test_token_counts_edge_cases(docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    processor = token_counts.model(path)
    rows = token_counts.token_counts(docs, path, limit=10).collect()
    expected = sorted((str(r[0]), len((r[1] or "").encode()), len(processor.encode(r[1] or ""))) for r in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 10) for r in rows)
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_lm_workers_give_memory_back_after_each_stage(docs, monkeypatch):
    """Counting, gathering and scoring run in workers that live on beside the next stage."""
    from tradeflow.llm import lm_scoring
    from tradeflow.llm.common import fold, frugal
    wrapped = []
    monkeypatch.setattr(lm_scoring, "frugal", lambda run: wrapped.append(run) or frugal(run))
    rows = lm_scoring.score(docs, fold("doc_id", 7) != 2).count()
    assert rows == docs.count() and len(wrapped) == 3


def test_counts_found_are_held_for_the_next_texts(monkeypatch):
    """A second stretch of the same words probes the filter only for what is rare; the scores stay, with and without room."""
    rng = np.random.default_rng(4)
    raws = [b" ".join(b"w%d" % min(i, 400) for i in rng.zipf(1.3, 300)) for _ in range(40)]

    def stretch():
        vocabulary = lm_scoring.Vocabulary()
        for raw in raws:
            vocabulary.add(raw)
        return vocabulary.stream()
    codes, histories, words = stretch()
    hashes, hot = lm_scoring.hash_words(words), {b"w1"}
    is_hot = np.array([w in hot for w in words])
    part, follower = lm_scoring.bigram_parts(hashes[histories], hashes[codes], is_hot[histories])
    keys, counts = np.unique(lm_scoring.pack_key(part, follower), return_counts=True)
    raw, _, (ones, twos) = lm_scoring.build_bucket(keys, counts.astype(np.int64))

    class Shared:
        value = (0, [len(raw)], raw)
    probed, counts_of = [], lm_scoring.Segment.counts
    monkeypatch.setattr(lm_scoring.Segment, "counts", lambda self, keys, *rest: probed.append(len(keys)) or counts_of(self, keys, *rest))
    scores = []
    for room in (1 << 18, 10, 0):
        monkeypatch.setattr(lm_scoring, "HELD_KEYS", room)
        model = lm_scoring.Probabilities([Shared], 0, hot, len(codes), len(words), 0.5, 0.5)
        for _ in range(3):
            probed.clear()
            scores.append(model.token_scores(codes, histories, words, hashes))
            if len(scores) == 2:
                assert probed[0] < first[0] and probed[1] < first[1] / 2
            first = list(probed)
    assert all(np.array_equal(scores[0], s) for s in scores[1:])
