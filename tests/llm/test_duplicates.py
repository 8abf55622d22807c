"""SimHash, line dedup, fingerprints."""
import collections
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tradeflow.llm import fingerprints, line_dedup, simhash
from tradeflow.llm.components import connected_components

from .conftest import ROWS

SF = "/root/testdata/sf0.001"


def union(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in pairs:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_components(llm):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(230)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 500 + i) for i in range(50)]
    got = {r.node: r.component for r in connected_components(llm.createDataFrame(edges, "a long, b long")).collect()}
    roots = union(600, edges)
    assert got == {n: roots[n] for e in edges if e[0] != e[1] for n in e}
    assert connected_components(llm.createDataFrame([], "a long, b long")).count() == 0


def plain_simhash(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_simhash_of_documents(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_simhash(r.text) for r in docs]
    roots = union(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    smallest = {k: min(docs[i].doc_id for i in range(len(docs)) if roots[i] == k) for k in set(roots)}
    expected = {(r.doc_id, f"{p:016x}", smallest[k]) for r, p, k in zip(docs, prints, roots)}
    assert {tuple(r) for r in simhash.op7_simhash(llm, SF).collect()} == expected


def test_simhash_pairs_by_brute_force(llm):
    rng = random.Random(6)
    values = set()
    for _ in range(120):
        base = rng.getrandbits(64)
        for _ in range(6):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randint(0, 63)
            values.add(x)
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(r) for r in simhash.link_pairs(llm.createDataFrame([(v,) for v in values], "fp long")).collect()}
    near = lambda x, y: ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 3
    assert got == {(x, y) for x in values for y in values if x < y and near(x, y)} and len(got) > 200


def test_simhash_edge_cases(docs, no_docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[2].component_id == 1 and by[4].fp == by[5].fp == by[6].fp == 0 and by[5].component_id == 4
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(map(str, ids)) == sorted(["1", "3", "4", "None", "7", "8", "9", "10", "11", "12"])


def test_simhash_rows_without_an_id_or_of_one_id(llm):
    rng = random.Random(10)
    text = [" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80)) for _ in range(7)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (5, text[2]), (5, text[3]), (7, text[4]), (None, text[4]),
            (9, text[5]), (9, text[6]), (8, text[6]), (None, None), (None, "")]
    kept = simhash.drop_near_duplicates(llm.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = [(r.doc_id, r.text or "") for r in kept]
    expected = {(None, text[0]), (None, text[1]), (5, text[2]), (5, text[3]), (7, text[4]), (9, text[5]), (8, text[6]), (None, "")}
    assert set(got) == expected and len(got) == len(expected)


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def mutated(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        kind, i = rng.randint(0, 2), rng.randint(0, len(out))
        if kind == 0 or i == len(out):
            out.insert(i, rng.choice(letters))
        elif kind == 1:
            out.pop(i)
        else:
            out[i] = rng.choice(letters)
    return "".join(out)


def test_edit_distance_by_brute_force(llm):
    rng = random.Random(1)
    pairs = []
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        a, b = sorted((a, mutated(rng, a, rng.randint(0, 4), "abé")), key=len)
        pairs.append((a, b, distance(a, b)))
    for edits in (1, 2, 3):
        near = [p for p in pairs if len(p[1]) - len(p[0]) <= edits]
        rows = llm.createDataFrame(near, "a string, b string, d int").select(
            "d", F.split("a", "").alias("a"), F.split("b", "").alias("b")).select("d", line_dedup.edit_distance(F.col("a"), F.col("b"), edits).alias("got")).collect()
        assert all(r.got == r.d if r.d <= edits else r.got > edits for r in rows)


def test_near_pairs_by_brute_force(llm):
    rng = random.Random(2)
    texts = set()
    for _ in range(40):
        base = "".join(rng.choice("abcd é") for _ in range(rng.randint(24, 40))).strip()
        texts |= {mutated(rng, base, rng.randint(0, 3), "abcdé") for _ in range(5)}
    lines = [(i, t, len(t)) for i, t in enumerate(sorted(texts))]
    for edits in (1, 2):
        got = {tuple(sorted(r)) for r in line_dedup.near_pairs(llm.createDataFrame(lines, "id long, line string, len int"), edits, 12).collect()}
        assert got == {(i, j) for i, t, n in lines for j, u, m in lines if i < j and min(n, m) >= 12 and distance(t, u) <= edits}


def test_word_pairs_by_brute_force(llm):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = set()
    for n in [11, 12, 13, 19, 20, 21, 29, 30, 38, 39, 40, 41, 42, 49, 50, 51, 80, 99, 100, 130, 330, 700] * 2:
        base = [rng.choice(vocabulary if n < 130 else vocabulary[:9]) for _ in range(n)]
        for e in [0, 1, n // 10, n // 10 + 1] * 2:
            out = list(base)
            for _ in range(e):
                kind, i = rng.randint(0, 2), rng.randrange(len(out))
                out[i:i + (kind > 0)] = [rng.choice(vocabulary)] if kind < 2 else []
            texts.add(" ".join(out))
    texts.add("go " * 30 + "stop")
    texts.add("go " * 31 + "stop")
    lines = [(i, t, len(t)) for i, t in enumerate(sorted(texts))]
    words = [t.split(" ") for _, t, _ in lines]
    near = {(i, j) for j in range(len(words)) for i in range(j) if min(len(words[i]), len(words[j])) >= 12
            and abs(len(words[i]) - len(words[j])) <= min(len(words[i]), len(words[j])) // 10
            and len(collections.Counter(words[i]) - collections.Counter(words[j])) <= min(len(words[i]), len(words[j])) // 10
            and distance(words[i], words[j]) <= min(len(words[i]), len(words[j])) // 10}
    got = {tuple(sorted(r)) for r in line_dedup.word_pairs(llm.createDataFrame(lines, "id long, line string, len int")).collect()}
    assert got <= near and len(near) > 100 and union(len(lines), got) == union(len(lines), near)


def test_line_repeats_with_changed_words(llm):
    line = "every report of the house was sent to the office before noon and filed there by the clerk on duty"
    rows = [(1, line), (2, line.replace("house", "garden").replace("clerk", "porter")), (3, line.replace("house", "garden").replace("noon", "dawn").replace("clerk", "boy"))]
    assert len(line.split()) == 20
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.first_doc, r.near) for r in line_dedup.repeats(docs).collect()} == {(2, 1, True), (3, 1, True)}
    assert {r.doc_id for r in line_dedup.drop_repeats(llm.createDataFrame([rows[0], rows[2]], "doc_id long, text string")).collect()} == {1, 3}


def plain_repeats(rows, edits=2, min_chars=10, near_chars=24):
    """(doc_id, pos) removed, over (doc_id, text) rows of different ids."""
    found = [(i, p, x.strip(" ")) for i, t in rows for p, x in enumerate((t or "").split("\n")) if len(x.strip(" ")) >= min_chars]
    kinds = sorted({x for _, _, x in found})
    number = {x: k for k, x in enumerate(kinds)}
    pairs = [(a, b) for a in range(len(kinds)) for b in range(a) if min(len(kinds[a]), len(kinds[b])) >= near_chars
             and abs(len(kinds[a]) - len(kinds[b])) <= edits and distance(kinds[a], kinds[b]) <= edits]
    roots = union(len(kinds), pairs)
    groups = collections.defaultdict(list)
    for i, p, x in found:
        groups[roots[number[x]]].append((i, p))
    return {o for g in groups.values() for o in sorted(g)[1:]}


def test_line_repeats_by_brute_force(llm):
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 40))) for _ in range(40)]
    rows = [(i, "\n".join(mutated(rng, rng.choice(pool), rng.choice([0, 0, 0, 1, 2, 5]), "abc") for _ in range(rng.randint(1, 6)))) for i in range(40)]
    gone = plain_repeats(rows)
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r.doc_id, r.pos) for r in line_dedup.repeats(docs).collect()} == gone and len(gone) > 20
    texts = {r.doc_id: r.text for r in line_dedup.drop_repeats(docs).collect()}
    for i, t in rows:
        left = "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone)
        assert texts.get(i) == (left if left.strip() or not any(j == i for j, _ in gone) else None)
    report = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert all(report[i].n_removed == sum(j == i for j, _ in gone) for i, _ in rows)


def test_line_dedup_edge_cases(docs, no_docs):
    report = collections.defaultdict(list)
    for r in line_dedup.line_report(docs).collect():
        report[r.doc_id].append(r)
    assert sum(map(len, report.values())) == len(ROWS)
    assert report[2][0].n_removed == 1 and report[2][0].first_docs == [1] and report[1][0].n_removed == 0
    assert report[11][0].n_removed == 1 and report[11][0].n_near == 0
    assert report[5][0].n_lines == 1 and report[12][0] == report[12][1]
    kept = line_dedup.drop_repeats(docs)
    rows = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == docs.columns and 2 not in rows and rows[5].text is None and rows[6].text == " \n\t "
    assert rows[11].text == "Noch eine Zeile ohne alle Worte." and rows[11].n_chars == len(rows[11].text)
    assert line_dedup.line_report(no_docs).count() == 0 and line_dedup.drop_repeats(no_docs).count() == 0


def shingles(text):
    words = re.findall("[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_documents(llm):
    docs = sorted(llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in fingerprints.op10_fingerprints(llm, SF).collect()}
    error = []
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)].text
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        error += [got[i].near_edited - jaccard(shingles(text), shingles(edited)), got[i].near_next - jaccard(shingles(text), shingles(after))]
        assert abs(got[i].n_shingles / len(shingles(text)) - 1) < 0.45
    assert max(map(abs, error)) < 0.16 and sum(e * e for e in error) / len(error) < 0.04 ** 2


def test_next_rows_over_many_blocks(llm):
    rng = random.Random(8)
    ids = rng.sample(range(10 ** 6), 700) + [10 ** 12 + 5 * i for i in range(300)]
    df = llm.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.after for r in fingerprints.with_next(df, {"after": "text"}, block_rows=10).collect()}
    ids.sort()
    assert got == {i: f"t{j}" for i, j in zip(ids, ids[1:] + ids[:1])}


def test_fingerprints_edge_cases(docs, no_docs):
    rows = fingerprints.fingerprint(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].sketch == by[2].sketch and by[4].sketch == by[5].sketch == by[6].sketch == [] and by[None].next_text == ROWS[0][1]
    assert by[12].next_text == by[12].text or by[12].next_text == ROWS[5][1]
    assert fingerprints.fingerprint(no_docs).count() == 0
    near = fingerprints.fingerprint(docs).select("doc_id", fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("r"))
    got = {r.doc_id: r.r for r in near.collect()}
    assert got[1] == 1.0 and got[4] == 1.0 and got[2] == 0.0


def test_sketches_merge(llm):
    words = [f"w{i}" for i in range(3000)]
    parts = [(0, " ".join(words[:1600])), (0, " ".join(words[1596:])), (1, " ".join(words[:4]))]
    df = fingerprints.with_sketch(llm.createDataFrame(parts, "g int, t string"), "t", "s")
    merged = {r.g: r.s for r in fingerprints.merge(df, "g", "s").collect()}
    whole = fingerprints.with_sketch(llm.createDataFrame([(" ".join(words),)], "t string"), "t", "s")
    assert merged[0] == whole.first().s and len(merged[1]) == 1
    row = whole.select(fingerprints.distinct_count(F.col("s")).alias("n"), fingerprints.containment(F.col("s"), F.col("s")).alias("c")).first()
    assert abs(row.n / 2996 - 1) < 0.4 and row.c == 1.0


def test_lines_of_a_common_passage_are_paired_by_their_rare_words(llm, monkeypatch):
    """60 lines hold one passage of 36 words and 12 words of their own, of equal hash classes: alike but for the rare words."""
    import itertools
    words = {}
    for i in range(20000):
        words.setdefault(xxhash.xxh64_intdigest(f"w{i}", 42) & 15, []).append(f"w{i}")
    passage = [f"p{i}" for i in range(36)]
    texts = [[words[j][i] for j in range(6)] + passage + [words[j][i] for j in range(6, 12)] for i in range(60)]
    texts.append(texts[17][:45] + ["x1", "x2", "x3"])                   # three words of 48: within the bound of 4
    texts.append(["y1", "y2", "y3", "y4", "y5"] + texts[30][5:])        # five words: beyond it
    texts.append(["z1", "z2"] + texts[40][3:])                          # one word less, two others
    lines = [(i * 7 % 63, " ".join(t)) for i, t in enumerate(texts)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    expected = {tuple(sorted((a, b))) for (a, x), (b, y) in itertools.combinations(lines, 2)
                if distance(x.split(), y.split()) <= min(len(x.split()), len(y.split())) // 10}
    made, write = {}, line_dedup.materialise

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "materialise", counted)
    frame = llm.createDataFrame([(i, x, len(x)) for i, x in lines], "id long, line string, len int")
    assert {tuple(sorted(r)) for r in line_dedup.word_pairs(frame).collect()} == expected and len(expected) == 2
    assert made["word_candidates"] < 20                                 # of 1953 pairs


@pytest.mark.parametrize("crowd", [32, 1])
def test_lines_with_a_passage_at_other_places_are_not_compared(llm, monkeypatch, crowd):
    """Lines of the same words, a passage at the start, in the middle or at the end; one line repeats a gram."""
    passage, rest = [f"p{i}" for i in range(16)], [f"r{i}" for i in range(24)]
    texts = [rest[:at] + passage + rest[at:] for at in (0, 12, 24)]
    texts.append(["x1", "x2"] + texts[1][2:] + ["x3"])                  # three edits of the second, words moved by one
    texts.append(rest[:8] + passage + rest[8:-8] + rest[:8])            # the first eight words again at the end
    texts.append(rest[:8] + passage + ["y1"] + rest[8:-8] + rest[:8])
    made, write = {}, line_dedup.materialise

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "materialise", counted)
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    frame = llm.createDataFrame([(i, " ".join(x), len(" ".join(x))) for i, x in enumerate(texts)], "id long, line string, len int")
    assert {tuple(sorted(r)) for r in line_dedup.word_pairs(frame).collect()} == {(1, 3), (4, 5)}
    assert made["word_candidates"] <= 4                                 # of 15 pairs


def test_materialise_drops_what_it_shuffled(llm, monkeypatch):
    """The files of a write's shuffle go when it ends; the session's own setting stays."""
    from tradeflow.llm import common
    before, during = llm.conf.get(common.DROP_SHUFFLES, None), []
    out = common.materialise(llm.range(1000).repartition(7, "id").where(F.col("id") >= 0), "shuffled")
    assert out.count() == 1000 and llm.conf.get(common.DROP_SHUFFLES, None) == before
    from pyspark.sql import DataFrameWriter
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: during.append(llm.conf.get(common.DROP_SHUFFLES)) or write(self, path))
    common.materialise(llm.range(10), "shuffled")
    assert during == ["true"] and llm.conf.get(common.DROP_SHUFFLES, None) == before


def counting(monkeypatch):
    """The rows of each table that the line join writes, by name."""
    made, write = {}, line_dedup.materialise

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(line_dedup, "materialise", counted)
    return made


@pytest.mark.parametrize("crowd", [32, 1])
def test_lines_of_a_common_passage_and_common_words_do_not_meet(llm, monkeypatch, crowd):
    """60 lines hold one passage and words of a small vocabulary: each two share rare words, but no rare gram of three."""
    rng = random.Random(12)
    passage, vocabulary = [f"p{i}" for i in range(24)], [f"v{i}" for i in range(60)]
    texts = [[rng.choice(vocabulary) for _ in range(18)] + passage + [rng.choice(vocabulary) for _ in range(18)] for _ in range(60)]
    texts.append(texts[30][:3] + ["x1"] + texts[30][4:50] + ["x2", "x3"] + texts[30][51:])       # within the bound of 6
    texts.append(texts[41][1:28] + ["y1"] + texts[41][28:-1] + ["y2"])
    made = counting(monkeypatch)
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    lines = [(i * 7 % 62, " ".join(x)) for i, x in enumerate(texts)]
    number = {x: i for i, x in lines}
    frame = llm.createDataFrame([(i, x, len(x)) for i, x in lines], "id long, line string, len int")
    expected = {tuple(sorted((number[" ".join(texts[i])], number[" ".join(texts[j])]))) for i, j in ((30, 60), (41, 61))}
    assert {tuple(sorted(r)) for r in line_dedup.word_pairs(frame).collect()} == expected
    assert made["word_crowd"] < 200 and made["word_pairs"] < 10         # of 62 lines and 1891 pairs


def test_rare_grams_by_brute_force(llm, monkeypatch):
    """All pairs within the bound are found through rare grams alone, also of lines that repeat words or grams."""
    rng = random.Random(13)
    texts = set()
    for n in [12, 13, 19, 20, 29, 30, 39, 40, 41, 43, 60, 100] * 3:
        base = [f"w{rng.randrange(8 if n % 2 else 300)}" for _ in range(n)]
        for e in [0, n // 10, n // 10] * 2:
            out = list(base)
            for _ in range(e):
                kind, i = rng.randint(0, 2), rng.randrange(len(out))
                out[i:i + (kind > 0)] = [f"w{rng.randrange(300)}"] if kind < 2 else []
            texts.add(" ".join(out))
    lines = list(enumerate(sorted(texts)))
    words = [t.split(" ") for _, t in lines]
    near = {(i, j) for j in range(len(words)) for i in range(j) if min(len(words[i]), len(words[j])) >= 12
            and abs(len(words[i]) - len(words[j])) <= min(len(words[i]), len(words[j])) // 10
            and len(collections.Counter(words[i]) - collections.Counter(words[j])) <= min(len(words[i]), len(words[j])) // 10
            and distance(words[i], words[j]) <= min(len(words[i]), len(words[j])) // 10}
    monkeypatch.setattr(line_dedup, "CROWD", 0)
    rows = llm.createDataFrame([(i, len(w), b"".join(chr(0x10000 + hash(x) % 0xF0000).encode() for x in w)) for i, w in enumerate(words)], "id long, n int, code binary")
    met = collections.defaultdict(list)
    for r in line_dedup.rare_grams(rows).collect():
        met[r.gram].append((r.id, r.pos))
    bound = lambda i, j: min(len(words[i]), len(words[j])) // 10
    moved = lambda i, p, j, q: 0 if line_dedup.PLACE in (p, q) else abs(p - q) + abs(len(words[i]) - len(words[j]) - p + q)
    found = {(i, j) for g in met.values() for i, p in g for j, q in g if i < j and moved(i, p, j, q) <= bound(i, j)}
    assert near <= found and len(near) > 100
    frame = llm.createDataFrame([(i, t, len(t)) for i, t in lines], "id long, line string, len int")
    got = {tuple(sorted(r)) for r in line_dedup.word_pairs(frame).collect()}
    assert got <= near and union(len(lines), got) == union(len(lines), near)


def test_lines_that_share_too_little_are_left_out_first(llm, monkeypatch):
    """20 lines of 100 words share a phrase of six: fewer keys than two lines within the bound share."""
    rng = random.Random(14)
    phrase = [f"p{i}" for i in range(6)]
    texts = [[f"w{rng.randrange(10 ** 6)}" for _ in range(47)] + phrase + [f"w{rng.randrange(10 ** 6)}" for _ in range(47)] for _ in range(20)]
    texts.append(texts[7][:20] + ["x1", "x2"] + texts[7][22:70] + ["x3"] + texts[7][72:])
    made = counting(monkeypatch)
    frame = llm.createDataFrame([(i, " ".join(x), len(" ".join(x))) for i, x in enumerate(texts)], "id long, line string, len int")
    assert {tuple(sorted(r)) for r in line_dedup.word_pairs(frame).collect()} == {(7, 20)}
    assert made["word_lines"] == 2
