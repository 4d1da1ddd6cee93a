import random
import re

import numpy as np

from touchline.llm import decontaminate as dc


def made():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8)))
    items = [[word() for _ in range(n)] for n in (15, 30, 59, 59, 6, 2, 1)]
    docs = []

    def around(inner):
        return " ".join([word() for _ in range(r.randint(0, 50))] + inner + [word() for _ in range(r.randint(0, 50))])

    for k, item in enumerate(items):
        told = {k} if len(item) >= 5 else set()  # shorter items are no passages
        docs.append((10 * k, around(item), told))
        docs.append((10 * k + 1, around([w.upper() + "," for w in item]), told))
    for k in (1, 2, 3):
        changed = items[k][:]
        changed[len(changed) // 2] = "other"
        docs.append((100 + k, around(changed), {k}))
        docs.append((110 + k, around(items[k][5:22]), {k}))
        docs.append((120 + k, around(items[k][5:12]), set()))  # seven words are too few
    docs += [(200, around([]), set()), (201, None, set()), (202, "", set()), (203, around(items[0] + items[1]), {0, 1}), (204, " ".join(word() for _ in range(30000)) + " " + " ".join(items[2]), {2})]
    docs.append((203, docs[-2][1], {0, 1}))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)]


def frames(spark):
    docs, items = made()
    d = spark.createDataFrame([(i, t, 1) for i, t, _ in docs], "doc_id long, text string, item_id int").repartition(3)
    return docs, d, spark.createDataFrame([*items, (50, None), (51, "")], "item_id long, text string")


def brute_force(text, item):
    """Whether any diagonal holds a stretch of 12 words, 80 % of them equal (a short item: all its words in a row)."""
    a, b = (re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (t or "").lower()) for t in (text, item))
    if len(b) < 12:
        return len(b) >= 5 and any(a[i : i + len(b)] == b for i in range(len(a)))
    for shift in range(-len(b) + 12, len(a) - 11):
        begin, end = max(0, -shift), min(len(b), len(a) - shift)
        score = np.concatenate(([0], np.cumsum([1 if a[i + shift] == b[i] else -4 for i in range(begin, end)])))
        if any(score[j] >= score[i] for i in range(len(score)) for j in range(i + 12, len(score))):
            return True
    return False


def test_planted_passages(spark):
    docs, d, items = frames(spark)
    found = {(r["doc_id"], r["item_id"]) for r in dc.find_overlaps(d, items).collect()}
    assert found == {(i, k) for i, _, ks in docs for k in ks}
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    assert found == {(i, k) for i, t, _ in docs for k, x in texts.items() if len(t or "") < 5000 and brute_force(t, x)} | {(204, 2)}
    row = dc.find_overlaps(d, items).filter("doc_id = 101").first()
    assert (row["n_words"], row["n_equal"], row["item_start"]) == (30, 29, 0)


def test_a_small_filter_changes_nothing(spark, monkeypatch):
    docs, d, items = frames(spark)
    monkeypatch.setattr(dc, "LEAST_BITS", 64)
    monkeypatch.setattr(dc, "MOST_BITS", 64)
    assert {(r["doc_id"], r["item_id"]) for r in dc.find_overlaps(d, items).collect()} == {(i, k) for i, _, ks in docs for k in ks}


def test_clean_documents_stay(spark):
    docs, d, items = frames(spark)
    kept = dc.decontaminate(d, items)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, ks in docs if not ks)
    assert dc.decontaminate(d, items.limit(0)).count() == len(docs) and dc.find_overlaps(d, items.limit(0)).isEmpty()
    assert dc.find_overlaps(d.limit(0), items).isEmpty()


def overlaps(spark, cases):
    """Rows (doc, start, item start, words, equal) of pairs (document words, item words), each item for its document alone."""
    docs = spark.createDataFrame([(i, " ".join(a)) for i, (a, _) in enumerate(cases)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(b)) for i, (_, b) in enumerate(cases)], "item_id long, text string")
    return sorted(tuple(r)[:1] + tuple(r)[2:] for r in dc.find_overlaps(docs, items).collect() if r["doc_id"] == r["item_id"])


def test_substitutions(spark):
    """Adjacent ones, and a single one at every place of items of 12 to 20 words."""
    cases = []
    shapes = [(6, 2, 7), (7, 2, 6), (7, 3, 8), (8, 3, 9), (9, 3, 9)] + [(i, 1, n - i - 1) for n in range(12, 21) for i in range(n)]
    for k, (left, gap, right) in enumerate(shapes):
        item = [f"k{k}w{i}" for i in range(left + gap + right)]
        changed = item[:left] + [f"x{i}" for i in range(gap)] + item[left + gap :]
        cases.append((["before"] * 5 + changed + ["after"] * 5, item))
    found = overlaps(spark, cases)
    assert found[:5] == [(k, 5, 0, sum(shapes[k]), shapes[k][0] + shapes[k][2]) for k in range(5)]
    assert [x[0] for x in found] == list(range(len(cases)))
    for (k, start, at, n, same), (left, gap, right) in zip(found, shapes, strict=True):
        # Equal words at an end behind the different one may be left out: what is left scores higher.
        assert n >= 12 and start - at == 5 and same == n - (gap if at <= left < at + n else 0)


def test_every_stretch_of_a_diagonal(spark):
    item = [f"w{i}" for i in range(90)]
    changed = item[:20] + [f"x{i}" for i in range(30)] + item[50:57] + ["y0", "y1"] + item[59:65] + [f"z{i}" for i in range(25)]
    # The first stretch, then the second with what differs around it cut off.
    assert [(x[1], x[3], x[4]) for x in overlaps(spark, [(changed, item)])] == [(0, 20, 20), (50, 15, 13)]


def test_null_ids_and_equal_item_ids(spark):
    words = [f"w{i}" for i in range(20)]
    docs = spark.createDataFrame([(None, " ".join(words), "a"), (None, None, "b"), (3, "", "c")], "doc_id long, text string, k1 string")
    items = spark.createDataFrame([(1, "other " * 20), (1, " ".join(words)), (None, " ".join(words))], "item_id long, text string")
    assert [r["k1"] for r in dc.decontaminate(docs, items).orderBy("k1").collect()] == ["b", "c"]
    assert [r["item_id"] for r in dc.find_overlaps(docs, items).collect()] == [1]


def test_stretches_equal_the_rule():
    r = random.Random(2)
    for _ in range(300):
        same = dc.np.array([r.random() < r.choice((0.3, 0.8, 0.9)) for _ in range(r.randint(0, 45))], dtype=bool)
        any_ = any(same[i:j].sum() * 10 >= 8 * (j - i) for i in range(len(same)) for j in range(i + dc.MIN_WORDS, len(same) + 1))
        assert bool(dc.stretches(same)) == any_
