import numpy as np

from touchline.llm import embedding_dedup as ed


def brute(ids, vectors, cosine=0.95):
    unit = {}
    for i, v in zip(ids, vectors, strict=True):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, dtype=float)
            unit[i] = x / np.linalg.norm(x)
    links = {i: {j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine} if i in unit else set() for i in set(ids)}
    label = {i: i for i in links}
    for _ in links:
        label = {i: min([label[i], *(label[j] for j in links[i])]) for i in links}
    return {i: (len(links[i]), label[i], label[i] == i) for i in links}


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, unit string, pass int").repartition(3)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ed.near_duplicate_vectors(df, **options).collect()}


def made(n_large=260, dim=16):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=dim).tolist()) for i in range(150)]
    for k in range(20):
        c = r.normal(size=dim)
        rows += [(1000 + 10 * k + j, (c + r.normal(size=dim) * 0.03).tolist()) for j in range(r.integers(2, 6))]
    c = r.normal(size=dim)
    rows += [(5000 + j, (c + r.normal(size=dim) * 0.02).tolist()) for j in range(n_large)]
    wide = r.normal(size=dim)
    other = r.normal(size=dim)
    rows += [(8000 + j, (wide + other * j / 250).tolist()) for j in range(n_large)]  # a chain that is no clique
    rows += [(9000, None), (9001, [0.0] * dim), (9002, [float("nan")] * dim), (9003, [float("inf")] + [1.0] * (dim - 1)), (9004, []), (9005, [1.0]), (9006, [None] + [1.0] * (dim - 1))]
    rows += [(9020, [2.0]), (9021, [-2.0]), (9022, [1.0, 1.0, 0.1]), (9023, [1.0, 1.0, 0.0]), (9024, [1.0, -1.0, 0.0])]  # other dimensions are compared too
    return rows + [rows[0], rows[160], (9010, rows[160][1])]


def test_equals_brute_force(spark):
    rows = made()
    assert result(spark, rows) == brute([i for i, _ in rows], [v for _, v in rows])


def test_empty_and_unusable(spark):
    assert result(spark, []) == {}
    assert result(spark, [(1, None), (2, [0.0, 0.0])]) == {1: (0, 1, True), 2: (0, 2, True)}


def test_passes_grow_slowly():
    assert ed.passes_for(1) >= 4 and ed.passes_for(10**4) < ed.passes_for(10**6) < 80


def test_copies_and_pairs_in_a_dense_cluster(spark):
    r = np.random.default_rng(7)
    c = np.ones(32)
    bases = [c + r.normal(size=32) * 0.45 for _ in range(60)]
    pairs = [(b, b + r.normal(size=32) * 0.25) for b in bases]
    unit = np.array([v / np.linalg.norm(v) for p in pairs for v in p])
    links = (unit @ unit.T >= 0.951).astype(int)
    assert ((unit @ unit.T >= 0.949).astype(int) == links).all()
    copies = 12
    rows = [(j * 120 + i, pairs[i // 2][i % 2].tolist()) for i in range(120) for j in range(copies)]
    label = list(range(120))
    for _ in label:
        label = [min(label[k] for k in np.flatnonzero(links[i])) for i in range(120)]
    got = result(spark, rows, window=8)
    assert sum(links.sum(axis=1) > 1) > 40
    assert got == {i: (int(links[i % 120].sum()) * copies - 1, label[i % 120], i == label[i % 120]) for i, _ in rows}


def test_recall_in_many_dimensions(spark):
    """Clusters of copies, near copies and pairs at the threshold among spread vectors of 64 dimensions, all by brute force."""
    r = np.random.default_rng(11)
    rows = [(i, r.normal(size=64).tolist()) for i in range(1200)]
    for k in range(150):
        c = r.normal(size=64)
        noise = r.choice((0.0, 0.1, 0.2, 0.22))
        rows += [(5000 + 10 * k + j, (c + r.normal(size=64) * noise).tolist()) for j in range(r.integers(2, 5))]
    got, want = result(spark, rows), brute([i for i, _ in rows], [v for _, v in rows])
    links = sum(n for n, _, _ in want.values())
    assert links > 400 and sum(got[i] != want[i] for i in want) <= 0.001 * len(want)
