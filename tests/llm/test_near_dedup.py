import itertools
import random
import re

import numpy as np

from touchline.llm import near_dedup as nd
from touchline.llm.common import Words, connected_components


def words_of(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def similarity(a, b):
    """Longest common subsequence of words, by dynamic programming."""
    a, b = words_of(a), words_of(b)
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1] / (len(a) + len(b) - row[-1])


def classes(rows):
    label = {i: i for i, _ in rows}
    text = dict(rows)
    links = [(a, b) for a, b in itertools.combinations(sorted(text), 2) if similarity(text[a], text[b]) >= 0.8]
    for _ in text:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def made(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    rows = []
    for k in range(25):
        base = [word() for _ in range(r.choice((3, 30, 80, 200)))]
        rows.append((10 * k, " ".join(base)))
        for j in range(1, r.randint(1, 5)):
            copy = base[:]
            for _ in range(r.choice((0, 1, 1, 40))):
                copy[r.randrange(len(copy))] = word()
            rows.append((10 * k + j, " ".join(copy) + r.choice(("", ".", " !"))))
    return rows + [(900, None), (901, ""), (902, " "), (903, "a " * 400), (904, "a " * 401), (905, "x y"), (906, "X, y"), (907, "one two " * 20000)]


def result(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, rep int, key string").repartition(3)
    return {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(df).collect()}


def test_equals_brute_force(spark):
    rows = made()
    small = [(i, t) for i, t in rows if i < 903]
    got = result(spark, rows)
    assert {i: got[i] for i, _ in small} == classes(small)
    assert got[903] == got[904] == 903 and got[905] == got[906] == 905 and got[907] == 907


def test_alignment_is_exact():
    texts = [t for _, t in made(9)][:40]
    seqs = word_hashes(texts)
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert nd.aligned(seqs[i], seqs[j]) == (similarity(texts[i], texts[j]) >= 0.8)


def word_hashes(texts):
    words = Words(texts)
    return [(words.hashes[words.bounds[i] : words.bounds[i + 1]] >> np.uint64(32)).astype("<u4") for i in range(len(texts))]


def test_common_words_in_blocks():
    r = random.Random(8)
    for _ in range(60):
        texts = [" ".join(r.choice("abcdefg") for _ in range(r.randint(0, 60))) for _ in range(2)]
        a, b = word_hashes(texts)
        s = similarity(*texts)
        common = round(s * (len(a) + len(b)) / (1 + s)) if len(a) + len(b) else 0
        assert nd.common_words(a, b, 100, block=7) == nd.common_words(a, b, 100) == common


def test_very_long_texts_align():
    r = random.Random(4)
    a = np.array([r.randrange(5000) for _ in range(30_000)], dtype="<u4")
    b = np.delete(a, r.sample(range(30_000), 2500))
    b[r.sample(range(len(b)), 600)] = 9999
    assert nd.aligned(a, b) and not nd.aligned(a, np.concatenate((a[6000:], a[:6000])))


def test_large_group_stays_together(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1300):
        copy = base[:]
        copy[r.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    assert set(result(spark, rows).values()) == {0}


def test_rows_without_id_and_empty(spark):
    assert result(spark, []) == {} and result(spark, [(None, "a")]) == {}
    kept = nd.keep_one(spark.createDataFrame([(1, "a b c d e f", 5), (1, "a b c d e f", 5), (2, "A b c d e f", 6), (None, "a b c d e f", 7)], "doc_id long, text string, sketch int"))
    assert sorted((str(r["doc_id"]), r["sketch"]) for r in kept.collect()) == [("1", 5), ("1", 5), ("None", 7)]


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randint(200, 400), r.randint(200, 400)) for _ in range(120)] + [(5, 5), (None, 3)]
    label = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in label:
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {x["node"]: x["component"] for x in got.collect()} == label and got.count() == len(label)


def test_pairs_under_a_shared_passage(spark):
    """Pairs whose ids are far apart, in buckets crowded by one passage that most of each document is."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows, n = [], 400
    for i in range(n):
        own = [f"d{i}x{j}" for j in range(20)]
        rows.append((i, " ".join(passage + own)))
        own[r.randrange(1, 19)] = "other"
        rows.append((n + (i * 37) % n, " ".join(passage + own)))
    got = result(spark, rows)
    assert similarity(rows[0][1], rows[2][1]) < 0.8 <= similarity(rows[0][1], rows[1][1])
    assert got == {i: (i if i < n else next(k for k in range(n) if n + (k * 37) % n == i)) for i, _ in rows}


def test_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 7)
    test_pairs_under_a_shared_passage(spark)
    test_equals_brute_force(spark)


def test_template_with_own_parts(spark):
    """Each own part stands in two documents; any two documents share a template of 264 of 300 words."""
    r = random.Random(6)
    template = [f"t{i}" for i in range(264)]
    rows = []
    for i in range(500):
        own = [f"o{i % 250}x{j}" for j in range(36)]
        words = template[:]
        for j in range(0, 36):
            words.insert(8 * j, own[j])
        if i >= 250:
            words[r.randrange(300)] = f"new{i}"
        rows.append((i, " ".join(words)))
    assert similarity(rows[0][1], rows[1][1]) < 0.8 <= similarity(rows[0][1], rows[250][1])
    assert result(spark, rows) == {i: i % 250 for i in range(500)}


def test_recall_on_the_tables(spark, sf_dir):
    """All pairs by brute force on the whole small table: every linked pair shares a class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(docs).collect()}
    seqs = word_hashes([r["text"] for r in rows])
    linked = [(a["doc_id"], b["doc_id"]) for (a, x), (b, y) in itertools.combinations(zip(rows, seqs, strict=True), 2) if nd.aligned(x, y)]
    assert all(got[a] == got[b] for a, b in linked)
    assert len(set(got.values())) >= len(rows) - len(linked)
