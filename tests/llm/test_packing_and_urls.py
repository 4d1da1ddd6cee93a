import random
import zlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import packing, queries, url_filter


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_plan_places_every_piece_once(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    bins, numbers = {}, {}
    for length, first, pieces, base, per, offset in packing.plan(histogram, 64):
        for k in range(pieces):
            numbers.setdefault(length, []).append(first + k)
            bins.setdefault(base + k // per, []).append((offset + k % per * length, length))
    assert {n: sorted(v) for n, v in numbers.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and sum(3 * n > 64 for _, n in parts) <= 2
    assert sorted(bins) == list(range(len(bins)))


def test_plan_is_tight():
    r = random.Random(2)
    lengths = [min(4096, int(r.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    slots = packing.plan({n: lengths.count(n) for n in set(lengths)}, 4096)
    used = max(base + -(-pieces // per) for _, _, pieces, base, per, _ in slots)
    assert used <= 1.01 * sum(lengths) / 4096 + 1


def test_codec_equals_tokenizer():
    codec = packing.WordCodec(queries.tokenizer_path(), keep=50)
    r = random.Random(1)
    letters = "abcXYZ éÀßñ'0123 .,!?-_\t\n##$%&*'s't're I'LL Don't İﬁΣς日本<|endoftext|>\u0085\u001c½²ªº´`ÿ×÷"
    for _ in range(60):
        texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(5)]
        assert codec.encode(texts) == [codec.whole(t) for t in texts], texts
    once = "".join(chr(c) for c in range(1, 256)) + " one,two,three's"
    assert codec.encode([once] * 3) == [codec.whole(once)] * 3


def test_packing_round_trip(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(("word", "éa", "x1", "it's")) for _ in range(r.choice((1, 5, 300, 2000, 9000))))) for i in range(60)]
    rows += [(100, None), (101, ""), (5, rows[5][1]), (None, "null id")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, piece int, bucket int").repartition(3)
    path = queries.tokenizer_path()
    out = packing.pack(packing.token_pieces(docs, path)).toPandas()
    codec = packing.WordCodec(path)
    for doc, text in rows:
        if doc is None or doc == 5:
            continue
        ids = codec.whole(text or "") + np.array([1], "<u4").tobytes()
        own = out[out.doc_id == doc].sort_values("piece")
        parts = [ids[i : i + 4 * 4096] for i in range(0, len(ids), 4 * 4096)]
        assert own.length.tolist() == [len(p) // 4 for p in parts] and own.ids_crc32.tolist() == [zlib.crc32(p) for p in parts]
        assert own.start.tolist() == [4096 * k for k in range(len(parts))]
    assert len(out[out.doc_id == 5]) == 2 * -(-(len(codec.whole(rows[5][1])) // 4 + 1) // 4096)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 4096
    assert packing.pack(packing.token_pieces(docs.limit(0), path)).isEmpty()


URLS = [
    "http://A.example.COM/en/7x?q#f", "https://com/en/", "http://b.com/en", "http://xcom/en/", "ftp://example.net/de/8", "http://s.example.net/de/9#x", "http://net?x=/de/", "no scheme", None, "",
    "http://o.org/es/1", "://org/es/", "http://É.com/en/", "x://y://z.com/en/", "http://user@h.com/en/", "http://h.com/en/\n?", "http://.com/en/", "http://com./en/",
]


def pages(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y")] * 3 + [(None, URLS[1], "x", "y")]
    return spark.createDataFrame(rows, "page_id long, url string, host string, k string")


def test_urls_equal_sql(spark, tmp_path):
    pages(spark).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.op10_url_filter(spark, str(tmp_path)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, con.execute(queries.ORACLE["op10_url_filter"]).fetchall()))


def test_filter_size_and_join_kind_do_not_matter(spark, monkeypatch):
    listed = spark.createDataFrame([*queries.URL_RULES, ("com", None, "block"), ("com", None, "allow")], "host string, path string, verdict string")
    key = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    want = key(url_filter.judge_urls(pages(spark), listed))
    assert key(url_filter.judge_urls(pages(spark), listed, blocks=1)) == want
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", -1)
    assert key(url_filter.judge_urls(pages(spark), listed)) == want
    assert url_filter.judge_urls(pages(spark), listed.limit(0)).filter("rule is null and verdict = 'allow'").count() == pages(spark).count()
    assert url_filter.judge_urls(pages(spark).limit(0), listed).isEmpty()
