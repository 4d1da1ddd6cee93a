import random
import time
import zlib

import numpy as np

from touchline.llm import html_extract, html_training, quality, toxicity
from touchline.llm.queries import op7_quality


def texts(n, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("the", "on", "er", "sha", "tion")) for _ in range(r.randint(1, 3)))
    out = []
    for i in range(n):
        words = [word() for _ in range(r.randint(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            words[r.randrange(len(words))] = r.choice(("idiot", "scumhead", "scumbag", "morons"))
        out.append((" ".join(words), int(toxic)))
    return out


def test_toxicity_chain_holds_out():
    chain = toxicity.train(texts(600, 1))
    reader = toxicity.Reader(chain)
    test = texts(300, 2)
    p = reader.probabilities([t for t, _ in test])
    y = np.array([t for _, t in test])
    assert p.shape[1] == len(toxicity.CATEGORIES) and len(chain.weights[2]) == len(chain.weights[0]) + 2
    assert ((p[:, -1] >= 0.5) == y).mean() > 0.98
    assert reader.probabilities([None, ""])[:, -1].max() < 0.5
    assert toxicity.Reader(toxicity.train([("a", 0)])).probabilities(["idiot"]).max() == 0


def test_toxicity_operator(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(texts(400, 3))]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(1000, None, 1), (1001, "", 1), (None, "fine words", 1), (3, rows[3][1], 1)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows] + [(5000, 1, 1), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(docs, chain)
    toxic = {i for i, _, y in rows if y}
    left = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and len(toxic & set(left)) <= 2 and {1000, 1001, None} <= set(left) and len(left) >= len(rows) - len(toxic) + 2
    assert toxicity.score(docs, chain).count() == docs.count()
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.keep_clean(docs, none).count() == docs.count() and toxicity.score(docs.limit(0), chain).isEmpty()


def quality_texts(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(r.choice(("the", "on", "er", "sha", "tion")) for _ in range(r.randint(1, 3))) for _ in range(r.randint(20, 300))]
        bad = i % 3 == 0
        out.append((" | ".join(words) if bad and i % 2 else " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words), int(not bad)))
    return out


def test_quality_net_holds_out():
    net = quality.train(quality_texts(150, 1))
    test = quality_texts(90, 2)
    assert np.mean([(quality.predict(net, t) >= 0.5) == y for t, y in test]) > 0.95
    assert 0 <= quality.predict(net, None) <= 1 and quality.predict(net, None) == quality.predict(net, "")
    assert quality.predict(quality.train([("a", 1)]), "b") == 1.0 and quality.predict(quality.train([]), "b") == 0.5


def test_quality_covers_every_byte():
    net = quality.train(quality_texts(60, 4), epochs=1)
    data = quality.padded(("x" * 100_001).encode())
    whole = quality.responses(net, data).reshape(-1, quality.SEGMENT, quality.FILTERS).max(axis=1)
    chunks = np.maximum(np.maximum(whole[1:], whole[:-1]) + net.bias, 0)
    assert len(data) >= 100_001 and np.allclose(quality.pooled(net, data, 1 << 10), np.concatenate((chunks.max(axis=0), chunks.mean(axis=0))), atol=1e-5)


def test_quality_learns_from_whole_texts():
    """What tells the classes apart stands far behind the beginning of each text."""
    r = random.Random(3)
    rows = [("".join(r.choice("abcde ") for _ in range(6000)) + ("#!#!" * 40 if i % 2 else "") + "".join(r.choice("abcde ") for _ in range(3000)), i % 2) for i in range(160)]
    net = quality.train(rows[:120], epochs=6)
    assert np.mean([(quality.predict(net, t) >= 0.5) == y for t, y in rows[120:]]) > 0.9


def test_training_sample_is_bounded(spark):
    """Bytes are bounded per class, a repeated doc_id comes once with its smallest text, null and empty texts count."""
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(50)] + [(0, "a"), (0, "b")] * 20 + [(60, None), (61, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", {1: 100, 0: 100}, limit=2000)
    assert all(sum(len(t or "") for t, y in rows if y == k) <= 1000 for k in (0, 1)) and ("b", 0) not in rows and rows.count(("a", 0)) <= 1
    assert rows == toxicity.labelled_sample(docs.repartition(7), labels, "toxic", {1: 100, 0: 100}, limit=2000)
    assert toxicity.labelled_sample(docs.limit(0), labels, "toxic", {1: 5, 0: 5}) == []


def test_models_on_odd_tables(spark):
    """Empty tables, repeated rows, null ids and columns with clashing names."""
    docs = spark.createDataFrame([(None, "a b", 1.0, 0), (1, None, 2.0, 0), (1, None, 2.0, 0), (2, "x " * 50_000, 3.0, 0)], "doc_id long, text string, score double, y int")
    net, chain = quality.train(quality_texts(20, 1), epochs=1), toxicity.train(texts(60, 1))
    got = quality.score(docs, net).collect()
    assert len(got) == 4 and sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "None"] and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs.limit(0), net).isEmpty() and toxicity.score(docs, chain).count() == 4
    # ties: equal texts have equal scores, whatever their rows
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1


def test_quality_query_never_learns_held_out_rows(spark, tmp_path):
    rows = [(i, t, y) for i, (t, y) in enumerate(quality_texts(120, 6))]
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows] + [(500, None, "en")], "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = [(i, 1 - y if i in held else y, 0) for i, _, y in rows]  # wrong labels where it must not look
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r for r in op7_quality(spark, str(tmp_path)).collect()}
    assert len(got) == 121 and {i for i, r in got.items() if r["held_out"]} == held | ({500} if zlib.crc32(b"500") % 5 == 0 else set())
    assert np.mean([(got[i]["score"] >= 0.5) == y for i, _, y in rows]) > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a></li><li><a href="/b">other</a></li></ul></nav>
<!-- x --><div class="ad">Buy now.</div><article><h1>Head &amp; line</h1><p><b>First  para&nbsp;graph here with words.<br><p>Second paragraph &lt;3 with more words.</p></article>
<section class="comments"><div class="comment"><p>A reader says something here.</p></div></section><footer>&copy; site</footer>"""


def test_html_extraction():
    model = html_extract.train(html_training.labelled_pages(250))
    assert html_extract.main_text(model, PAGE) == "Head & line\nFirst para graph here with words.\nSecond paragraph <3 with more words."
    assert [html_extract.main_text(model, p) for p in (None, "", "<", "<p", "<script>x", "<!-- a")] == [""] * 3 + [html_extract.main_text(model, "<p")] + [""] * 2
    wrong = total = 0
    for blocks, y in html_training.labelled_pages(120, seed=77):
        path = html_extract.viterbi(model.scores(model.numbers(blocks)), model.step, model.first)
        wrong += sum(a != b for a, b in zip(path, y, strict=True))
        total += len(y)
    assert wrong / total < 0.02


def test_only_markup_is_dropped():
    texts = lambda page: [b.text for b in html_extract.parse(page)]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be the answer</p>") == ["Let x=2 be the answer"]
    assert texts("<p>a <svg><title>t</title><g><text>drawn</text></g></svg> b<noscript>no script</noscript><object>else</object>") == ["a tdrawn b", "no script", "else"]
    assert texts("<p>a<script>var x = '</p>';</script>b<style>p{}</style><template>no</template><textarea>no</textarea><select><option>no</select>c") == ["abc"]
    assert texts("<table><tr><td><b>x</td><td>y</b> z</td></tr></table>") == ["x", "y z"]


def test_deep_and_very_long_markup():
    for page in ("<div>" * 60_000 + "x", "<b>" * 60_000 + "x" + "</b>" * 60_000, "".join(f'<div class="c{i}">' for i in range(3000)) + "x", "<table><tr><td>" + "<i>" * 30_000 + "x" + "</b>" * 30_000, "<p>x" * 60_000):
        start = time.perf_counter()
        blocks = html_extract.parse(page, frozenset(("main",)))
        assert blocks and {b.text for b in blocks} == {"x"} and time.perf_counter() - start < 5


def test_viterbi_is_best_path():
    import itertools

    r = np.random.default_rng(0)
    for n in range(1, 7):
        s, step, first = r.normal(size=(n, 2)), r.normal(size=(2, 2)), r.normal(size=2)
        value = lambda p: first[p[0]] + s[range(len(p)), p].sum() + sum(step[a, b] for a, b in zip(p, p[1:], strict=False))
        assert value(html_extract.viterbi(s, step, first)) == max(value(list(p)) for p in itertools.product((0, 1), repeat=n))


def test_html_operator(spark):
    model = html_extract.train(html_training.labelled_pages(120))
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "u", PAGE, "x"), (3, "v", "<p>" + "word " * 100_000, "x")], "page_id long, url string, html string, text string")
    got = html_extract.extract(pages, model).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got) and html_extract.extract(pages.limit(0), model).isEmpty()


def test_chain_equals_brute_force(spark):
    """Probabilities of the operator against the formula, feature by feature and category by category."""
    rows = texts(200, 5)
    chain = toxicity.train(rows)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)] + [(900, None), (901, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    for i, t in [(i, t) for i, (t, _) in enumerate(rows)] + [(900, None), (901, "")]:
        words = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        present = {f for w in words for f in [w + "$"] + [w[:k] for k in (4, 5, 6) if len(w) >= k]}
        earlier = []
        for category, w in zip(toxicity.CATEGORIES, chain.weights, strict=True):
            z = w[0] + sum(w[1 + n] for f, n in chain.vocabulary.items() if f in present)
            z += sum(a * b for a, b in zip(w[1 + len(chain.vocabulary) :], earlier, strict=True))
            earlier.append(1 / (1 + np.exp(-z)))
            assert abs(got[i][f"p_{category}"] - earlier[-1]) < 1e-9


def test_out_of_fold_choice_never_sees_the_fold():
    """A word that marks toxic rows of one fold only is no feature of that fold's view."""
    rows = [("plain words here", 0)] * 60 + [(f"idiot word{'x' * (i % 3 == 0)}only" if i % 3 == 0 else "idiot words", 1) for i in range(60)]
    y = np.array([v for _, v in rows])
    fold = np.arange(len(rows)) % 3
    chain, _, _ = toxicity._view([t for t, _ in rows], y, fold != 0, 50)
    whole, _, _ = toxicity._view([t for t, _ in rows], y, fold >= 0, 50)
    assert "wordxonly$" in whole.vocabulary and "wordxonly$" not in chain.vocabulary


def test_network_equals_brute_force():
    net = quality.train(quality_texts(30, 2), epochs=1)
    for text in (None, "", "short", "é and more " * 40):
        raw = (text or "").encode()
        data = list(raw) + [0] * (max(2, -(-len(raw) // 128)) * 128 + quality.WIDTH - len(raw))
        places = [sum(float(net.tables[j, data[2 * p + j], 0]) for j in range(quality.WIDTH)) for p in range((len(data) - quality.WIDTH) // 2)]
        tops = [max(places[s : s + quality.SEGMENT]) for s in range(0, len(places), quality.SEGMENT)]
        chunks = [max(0.0, max(a, b) + float(net.bias[0])) for a, b in zip(tops, tops[1:], strict=False)]
        pooled = quality.pooled(net, quality.padded(raw))
        assert np.allclose([pooled[0], pooled[quality.FILTERS]], [max(chunks), sum(chunks) / len(chunks)], atol=1e-4)


def test_parser_keeps_all_text():
    """The blocks of generated pages hold the same words as another parser's text without scripts, styles and titles."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.skip, self.words = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("title", "script", "style")

        def handle_endtag(self, tag):
            self.skip -= tag in ("title", "script", "style")

        def handle_data(self, data):
            self.words += [] if self.skip else [data]

    for seed in range(40):
        page = html_training._Writer(seed).page()
        plain = Plain()
        plain.feed(page)
        plain.close()
        bare = lambda t: "".join(t.split())
        assert bare("".join(b.text for b in html_extract.parse(page))) == bare("".join(plain.words)), seed
