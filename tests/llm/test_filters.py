"""Decontamination, PII, packing, pipeline, independence of the subpackage."""
import collections
import hashlib
import os
import random
import re
import shutil
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeflow.llm import decontamination, packing, pii
from tradeflow.llm.common import materialise

from .conftest import LONG, ROWS

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
WORDS = "word_bpe_49k.json"


def test_decontamination_edge_cases(docs, no_docs, bench):
    for limit in (0, 1 << 20):                                       # shuffled and broadcast windows
        rows = {(r.doc_id, len(r.spans)): r for r in decontamination.hits(docs, bench, broadcast_bytes=limit).collect()}
        by = {k[0]: r for k, r in rows.items()}
        assert sorted(by[1].items) == ["2"] and sorted((s.pos, s.size) for s in by[1].spans) == [(10, 4)]
        assert by[8].items == ["1"] and by[3].items == [] and len(by[3].spans) == 1 and by[5].spans == [] and by[5].n_words == 0
        assert decontamination.hits(docs, bench, broadcast_bytes=limit).count() == len(ROWS)
    assert decontamination.hits(no_docs, bench).count() == 0
    assert decontamination.hits(docs, bench.where("false")).where("size(spans) > 0").count() == 0
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["4", "5", "None", "6", "7", "9", "10", "12", "12"])
    cut = {r.doc_id: r for r in decontamination.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[1].text == "The cat sat on the mat and looked at the long time today." and cut[1].n_chars == len(cut[1].text)
    assert cut[4].text == "" and cut[5].text is None and cut[8].text == "the quick brown " * 400 and LONG.startswith("the quick brown fox")


def plain_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(digits[::-1])]
        if 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base_spans():
    rng = random.Random(5)
    parts = ["a", "@", ".", "-", "1", "25", "300", "+", "_", "é", " ", "(", ")", "4465758382889437", "x.y", "@b.c", "1.2.3.4", "0" * 70, "a" * 80,
             "+1 (663) 555-6869", "%"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("a" * 10 ** 6 + "@b.c") == [("email", 0, 10 ** 6 + 4)] and pii.base_spans("1" * 10 ** 6) == []


def test_pii_finds_by_context(llm):
    rows = [(i, f"some words here and card number: {base} then more words follow here") for i, base in enumerate(
        ["4465758382889437", "4111111111111111", "5500005555555559", "4000056655665556"])]
    rows += [(10, "another text whose card number: 4465-7583-8288-9430x is unseen"),
             (11, "and plain text with of the 12345678 number in it"), (12, None), (13, "")]
    rows += [(20 + i, f"the of the {w} text {w}") for i, w in enumerate(["cat", "dog", "sun"] * 5)]
    got = {r.doc_id: r for r in pii.find(llm.createDataFrame(rows, "doc_id long, text string"), min_instances=3).collect()}
    text = rows[4][1]
    assert [(s.kind, text[s.first:s.end]) for s in got[10].spans] == [("card", "4465-7583-8288-9430x")] and got[10].base_spans == []
    assert got[11].spans == got[12].spans == got[13].spans == [] and len(got) == len(rows)
    assert all(got[i].spans == got[i].base_spans and len(got[i].spans) == 1 for i in range(4))


def plain_patterns(edges, totals, least, confidence):
    trusted = {(i, k): 1.0 for _, i, k, _ in edges if k}
    before = None
    while True:
        hits, seen = collections.Counter(), collections.defaultdict(set)
        for p, i, _, n in edges:
            for (j, kind), trust in trusted.items():
                if i == j and p in totals:
                    hits[p, kind] += n * trust
                    seen[p, kind].add(i)
        best = {}
        for (p, kind), h in hits.items():
            c = round(min(h / totals[p], 1.0), 9)
            if len(seen[p, kind]) >= least and c >= confidence:
                best[p] = max(best.get(p, (0, "")), (c, kind))
        if best == before:
            return {(p, kind, c) for p, (c, kind) in best.items()}
        before = best
        trusted = {(i, k): 1.0 for _, i, k, _ in edges if k}
        for p, i, k, _ in edges:
            if not k and p in best:
                c, kind = best[p]
                trusted[i, kind] = max(c, trusted.get((i, kind), 0))


def test_pii_patterns_by_brute_force(llm):
    # each pattern rises to the trust of the one before over many rounds
    chain = [(f"p {k}", f"i{k}{j}", "card" if k == 0 else None, 1) for k in range(6) for j in range(3)]
    chain += [(f"p {k + 1}", f"i{k}{j}", None, 2) for k in range(5) for j in range(3)]
    rng = random.Random(8)
    other = {(f"q {rng.randrange(12)}", f"x{rng.randrange(30)}"): (rng.choice(["ip", "card", None, None, None]), rng.randint(1, 3)) for _ in range(150)}
    edges = chain + [(p, i, kind, n) for (p, i), (kind, n) in other.items()]
    totals = collections.Counter()
    for p, _, _, n in edges:
        totals[p] += n
    totals = {p: n + rng.choice([0, 0, 3]) for p, n in totals.items() if p != "q 3"}
    got = pii.confident_patterns(llm.createDataFrame(edges, "pattern string, instance string, kind string, n long"),
                                 llm.createDataFrame(list(totals.items()), "pattern string, total long"), 3, 0.4)
    found = {(r.pattern, r.kind): r.confidence for r in got.collect()}
    expected = {(p, kind): c for p, kind, c in plain_patterns(edges, totals, 3, 0.4)}
    assert found.keys() == expected.keys() and all(abs(found[k] - c) < 1e-6 for k, c in expected.items())
    assert ("p 5", "card") in found


def test_pii_pattern_counts_by_brute_force(llm, monkeypatch):
    monkeypatch.setattr(pii, "MARKS", 256)                            # many words share a bit
    monkeypatch.setattr(pii, "COUNTED_PATTERNS", 5)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghé") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))).upper() for _ in range(80)] + [None, ""]
    wanted = ["a b", "aa é", "c c", "zz y", "h a"]
    got = pii.count_patterns(llm.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4),
                             llm.createDataFrame([(w,) for w in wanted], "pattern string"))
    plain = collections.Counter(f"{a} {b}" for t in texts for w in [(t or "").lower().split()] for a, b in zip(w, w[1:]))
    assert {r.pattern: r.total for r in got.collect()} == {w: plain[w] for w in wanted if plain[w]}


def test_pii_edge_cases(docs, no_docs, llm):
    rows = pii.find(docs).collect()
    assert len(rows) == len(ROWS) and pii.find(no_docs).count() == 0
    by = {r.doc_id: r for r in rows}
    # the phone pattern runs on into the address: 16 digits, dropped without a retry
    assert [s.kind for s in by[10].base_spans] == ["email", "ip"] and by[5].base == ""
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pii.op3_pii(llm, SF).collect():
        spans = plain_spans(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert not line or set(line.split(",")) <= set(r.spans.split(","))


def test_word_encoder_is_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS))
    encoder = packing.WordEncoder(public_tokenizers.path(WORDS))
    rng = random.Random(3)
    parts = ["Don't", "ÀÉß", "×÷", "ªº", "'ll", "\xad", "\x1f", "\xa0", "Z", "<|", "a", "Σ", "ΑΣ", "\x1c", " ", "́", "e", "\n", "  ", "\t", "'s", "1", "!?", ".", "<|endoftext|>", "日本", "é", "x", "\x85", "İ", "ﬁ", "\x00", "　"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert encoder.encode(text)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_pieces(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS))
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(by) == {i for i, _ in texts}
    for i, text in texts:
        ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        total += at
    return padding / total


def test_packing_of_documents(llm):
    texts = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check_pieces(packing.op6_packing(llm, SF).collect(), texts, 2048) < 0.02


def test_packing_edge_cases(docs, no_docs):
    path = public_tokenizers.path(WORDS)
    once = docs.dropDuplicates(["doc_id"])
    rows = packing.pack(once, path, capacity=64).collect()
    check_pieces(rows, [(r[0], r[1]) for r in ROWS[:-1]], 64)
    assert packing.pack(no_docs, path).count() == 0
    assert packing.pack(docs, path, with_ids=True).where("length * 4 <> octet_length(ids)").count() == 0
    assert packing.pack(docs.where("text IS NULL"), path, end_id=None).count() == 0


def test_best_cuts_by_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        capacity = rng.randint(4, 12)
        positions, penalties, at = [], [], 0
        for _ in range(rng.randint(1, 9)):
            at += rng.randint(1, capacity)
            positions.append(at)
            penalties.append(rng.randint(0, 5))

        def cost(cuts):
            ends, starts = cuts, [0, *cuts]
            if any(e - s > capacity for s, e in zip(starts, ends)):
                return None
            return sum(capacity - (e - s) + penalties[positions.index(e)] for s, e in zip(starts, ends))
        subsets = [[p for k, p in enumerate(positions[:-1]) if mask >> k & 1] + [positions[-1]] for mask in range(1 << (len(positions) - 1))]
        best = min(c for c in map(cost, subsets) if c is not None)
        assert cost(packing.best_cuts(positions, penalties, capacity, True)) == best
        # more tokens follow: the cheapest state whose open window can still be extended; 0 if the start is one
        open_states = [p for p in positions if p > positions[-1] - capacity]
        reached = [cost(sorted(p for k, p in enumerate(positions) if mask >> k & 1)) for mask in range(1, 1 << len(positions))
                   if max(p for k, p in enumerate(positions) if mask >> k & 1) in open_states]
        assert cost(packing.best_cuts(positions, penalties, capacity, False)) == min(c for c in reached if c is not None)


def queued_cuts(positions, penalties, capacity, last):
    """The recurrence cut by cut, with the queue itself."""
    queue, back, values = collections.deque([(0, 0, -1)]), [], []
    for at, (j, penalty) in enumerate(zip(positions, penalties)):
        while queue[0][1] < j - capacity:
            queue.popleft()
        back.append(queue[0][2])
        values.append(queue[0][0] + capacity - j + penalty)
        while queue and queue[-1][0] >= values[-1] + j:
            queue.pop()
        queue.append((values[-1] + j, j, at))
    at = len(positions) - 1
    if not last:
        at = min((k for k in range(len(positions)) if positions[k] > positions[-1] - capacity), key=lambda k: (values[k], -k))
    cuts = []
    while at >= 0:
        cuts.append(positions[at])
        at = back[at]
    return cuts[::-1]


def test_best_cuts_equal_the_queue():
    rng = random.Random(11)
    for _ in range(200):
        capacity, step = rng.randint(2, 60), rng.randint(1, 9)
        positions = np.cumsum([rng.randint(1, min(step, capacity)) for _ in range(rng.randint(1, 400))]).tolist()
        penalties = [rng.choice([0, 0, 4, 24, rng.randint(0, 3 * capacity)]) for _ in positions]
        for last in (True, False):
            assert packing.best_cuts(positions, penalties, capacity, last) == queued_cuts(positions, penalties, capacity, last)


def test_pipeline(llm):
    import corpus_pipeline
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from tradeflow.llm.common import materialise
        before = docs.count()
        docs = materialise(stage(llm, docs, SF), name)
        assert docs.columns == columns and 100 < docs.count() <= before, name
    rest = [(r.doc_id, r.text) for r in docs.collect()]
    assert len({i for i, _ in rest}) == len(rest) and all(set(t.split("\n")) <= set(texts[i].split("\n")) for i, t in rest)
    pieces = corpus_pipeline.STAGES[-1][1](llm, docs, SF)
    check_pieces(pieces.collect(), rest, 2048)
    assert corpus_pipeline.run(llm, SF).count() == pieces.count()


def test_pipeline_stages_keep_clashing_columns(llm, docs, bench, tmp_path):
    import corpus_pipeline
    names = ["_id", "_hash", "_row", "_text", "_lines", "_keep", "_gaps", "_spans", "_masks", "_salt", "words", "fp", "h"]
    odd = docs.drop("words", "fp", "h").withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in names})
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(llm, kept, str(tmp_path)), name)
        assert kept.columns == odd.columns and kept.schema["n_chars"].dataType == odd.schema["n_chars"].dataType, name
    rows = kept.collect()
    assert rows and all(r[n] == n + ("none" if r.doc_id is None else str(r.doc_id)) for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](llm, kept, str(tmp_path)).count() >= len(rows)
    spans = decontamination.decontaminate(odd, bench, remove="spans")
    assert spans.columns == odd.columns and spans.count() == odd.count()


def test_pipeline_of_odd_tables(llm, docs, no_docs, bench, tmp_path):
    """Nulls, blanks, very long texts, copies and a repeated row; then no row at all."""
    import corpus_pipeline
    for name, table in (("some", docs), ("none", no_docs)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        bench.write.parquet(str(tmp_path / name / "benchmark.parquet"))
    pieces = corpus_pipeline.run(llm, str(tmp_path / "some")).collect()
    ids = collections.Counter(r.doc_id for r in pieces if r.start == 0)
    assert set(ids) <= {r[0] for r in ROWS} and not {4, 5, 6} & set(ids)          # empty, NULL and blank texts went
    assert ids[2] == 0 and ids[12] <= 1                                           # an exact copy and a repeated row
    assert corpus_pipeline.run(llm, str(tmp_path / "none")).count() == 0


def test_the_rest_works_without_this_package(tmp_path):
    """Both folders and the pipeline deleted: the entry module imports, and tests of the rest pass there."""
    copy = tmp_path / "repo"
    gone = {os.path.join(ROOT, "tradeflow", "llm"), os.path.join(ROOT, "tests", "llm")}
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if os.path.join(folder, n) in gone or n in (".git", "__pycache__", "corpus_pipeline.py", ".pytest_cache")])
    script = "import __spark_entry__ as e; names = set(e.queries()); assert names == set(e.oracle_sql()) and len(names) > 80, names ^ set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", script], cwd=copy, check=True, timeout=120)
    chosen = "test_entry_smoke or test_every_query_has_an_oracle or dim_filial or br_currency or test_lenient_dates or test_bind_values"
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-p", "no:cacheprovider", "-k", chosen], cwd=copy, check=True, timeout=600)


def test_a_missing_package_takes_only_these_queries_away():
    script = """
import sys
class Gone:
    def find_spec(self, name, *_):
        if name == "xxhash":
            raise ModuleNotFoundError("No module named 'xxhash'", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 80 and not any(k.startswith("op") and k[2].isdigit() for k in e.queries()) and "pipeline" not in e.queries()
"""
    subprocess.run([sys.executable, "-c", script], cwd=ROOT, check=True, timeout=120)
