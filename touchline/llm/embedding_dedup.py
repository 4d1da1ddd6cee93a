"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets the signs of ``BITS`` random projections, and the vectors are sorted
by them (lexicographic order of the concatenated hashes). Each is compared, by cosine in double
precision, with the ``WINDOW`` vectors before it; verified pairs are united across passes. The
number of passes follows from the number of vectors so that a pair at the threshold is missed with
a probability of at most ``MISS`` (see ``passes_for``). Equal vectors are one in the passes. Where more
than ``WINDOW`` vectors share the leading signs that the number of passes counts on, as in a dense
cluster, all of them are compared, block by block, so the probability holds for any table; the
blocks that meet grow with the square of such a run.

All links of a vector lie inside its group, so the number of its links is then counted there
exactly: small groups by comparing all members; a group of more than ``EXACT`` members first by its
centre: where every member is within half the threshold angle of it, all members are linked. Groups
that this does not prove are compared in blocks, so nothing is capped or sampled.

Scale. One range sort over (pass, hash) deals all passes; windows are streamed, and the windows
that cross two partitions are compared from the partitions' edges. A task holds WINDOW + a batch.

Null vectors, zero vectors and those with null or non-finite components link with nothing and are
groups of their own; so do vectors of different dimensions, each of which is compared by itself. Repeated rows of one vec_id are one vector.
Null vec_ids are returned with no links and a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import connected_components, materialize, skewed_join

COSINE = 0.95
BITS = 60
WINDOW = 128
MISS = 1e-4
EXACT = 500
BLOCK = 1000
#: Members of a run of common signs that are compared as one block.
RUN_BLOCK = 1000


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``.

    Two vectors at angle t agree in one sign with probability 1 - t / pi. Of n sorted vectors about
    n / 2**b share b leading signs, so a pair that agrees in log2(n / window) of them is in a window.
    """
    bits = max(0.0, math.log2(max(1, n) / window)) + 1
    hit = (1 - math.acos(cosine) / math.pi) ** bits
    return max(4, math.ceil(math.log(miss) / math.log1p(-min(hit, 0.95))))


def shared_bits(n: int, window: int = WINDOW) -> int:
    """Leading signs that ``passes_for`` counts on."""
    return int(max(0.0, math.log2(max(1, n) / window)) + 1)


def directions(passes: int, dim: int) -> np.ndarray:
    return np.random.default_rng(20_240_229).normal(size=(passes, BITS, dim))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit): one row per usable vector, eight-byte components as binary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, units = [], []
            for i, v in zip(batch["vec_id"].tolist(), batch["embedding"].tolist(), strict=True):
                if v is None or not len(v):
                    continue
                x = np.asarray(v, dtype=np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top + 0.0  # no negative zeros: equal vectors have equal bytes
                    ids.append(i)
                    units.append((x / np.sqrt(x @ x)).tobytes())
            yield pd.DataFrame({"vec_id": pd.Series(ids, dtype="int64"), "unit": units})

    rows = vectors.filter("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInPandas(run, "vec_id long, unit binary").groupBy("vec_id").agg(F.min("unit").alias("unit"))


def _stack(cells) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.float64).reshape(len(cells), -1)


def _forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """At most len(ids) edges that connect what the pairs (i, j) connect."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(ids[a]), int(ids[b])))
    return out


def _window_pairs(x: np.ndarray, old: int, window: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row, earlier row at most ``window`` before it) among rows from ``old`` on."""
    found_i, found_j = [], []
    step = 512
    for at in range(old, len(x), step):
        stop, begin = min(at + step, len(x)), max(0, at - window)
        i, j = np.nonzero(x[at:stop] @ x[begin:stop].T >= cosine)
        i, j = i + at, j + begin
        near = (j < i) & (i - j <= window)
        found_i.append(i[near])
        found_j.append(j[near])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.zeros(0, int), np.zeros(0, int))


def _spanning(ids: np.ndarray, hit: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the symmetric matrix ``hit``."""
    out, fresh = [], np.ones(len(ids), dtype=bool)
    for s in range(len(ids)):
        stack = [s] if fresh[s] else []
        fresh[s] = False
        while stack:
            r = stack.pop()
            new = np.flatnonzero(hit[r] & fresh)
            fresh[new] = False
            out += [(int(ids[r]), int(ids[k])) for k in new]
            stack += new.tolist()
    return out


def dense_run_edges(units: DataFrame, keys: DataFrame, bits: int, cosine: float, window: int) -> DataFrame:
    """Edges (a, b) that connect the linked pairs in runs of ``keys(pass, key, vec_id)`` with over ``window`` rows of ``bits`` common signs."""
    keys = materialize(keys.select(F.struct("pass", F.shiftright("key", BITS - bits).alias("prefix")).alias("run"), "vec_id"))
    runs = keys.groupBy("run").agg(F.count("*").alias("n")).filter(F.col("n") > window)
    rows = skewed_join(keys, runs, "run", [F.col("vec_id")])
    blocks = F.ceil(F.col("n") / RUN_BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
    rows = rows.select("run", "vec_id", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("run", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "vec_id")

    def all_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _stack(pdf["unit"].tolist())
        return pd.DataFrame(_spanning(pdf["vec_id"].to_numpy(dtype=np.int64), x @ x.T >= cosine), columns=["a", "b"], dtype="int64")

    return rows.join(units, "vec_id").groupBy("run", "lo", "hi").applyInPandas(all_pairs, "a long, b long")


def sorted_pass_edges(units: DataFrame, n: int, dim: int, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """Edges (a, b) of a spanning forest of all pairs verified in any pass."""
    passes = passes_for(n, cosine, window)
    spark = units.sparkSession
    planes = spark.sparkContext.broadcast(directions(passes, dim))
    weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)).astype(np.int64)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _stack(batch["unit"].tolist())
                for p in range(passes):
                    key = ((x @ planes.value[p].T >= 0) @ weights).astype(np.int64)
                    yield pd.DataFrame({"pass": np.int32(p), "key": key, "vec_id": batch["vec_id"], "unit": batch["unit"]})

    def keys_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in keyed(batches):
            yield part[["pass", "key", "vec_id"]]

    # A partition holds many windows; the number depends on the rows alone.
    partitions = max(1, min(4096, n * passes // (64 * window)))
    dealt = (
        units.mapInPandas(keyed, "pass int, key long, vec_id long, unit binary")
        .repartitionByRange(partitions, "pass", "key", "vec_id")
        .sortWithinPartitions("pass", "key", "vec_id")
    )
    schema = "a long, b long, border int, side int, place int, unit binary"

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = np.zeros(0, dtype=np.int64), np.zeros((0, dim))
        own = TaskContext.get().partitionId()
        head: list[tuple] = []
        for batch in batches:
            if not len(batch):
                continue
            cells = batch["unit"].tolist()
            old = len(ids)
            ids = np.concatenate((ids, batch["vec_id"].to_numpy(dtype=np.int64)))
            x = np.vstack((x, _stack(cells)))
            if own and len(head) < window:
                head += [(int(v), 0, own - 1, 1, len(head) + k, c) for k, (v, c) in enumerate(zip(ids[old:].tolist(), cells, strict=True)) if len(head) + k < window]
            i, j = _window_pairs(x, old, window, cosine)
            yield pd.DataFrame([(a, b, -1, 0, 0, None) for a, b in _forest(ids, i, j)], columns=["a", "b", "border", "side", "place", "unit"])
            ids, x = ids[-window:], x[-window:]
        edge = head + [(int(v), 0, own, 0, k - len(ids), x[k].tobytes()) for k, v in enumerate(ids)]
        yield pd.DataFrame(edge, columns=["a", "b", "border", "side", "place", "unit"])

    out = materialize(dealt.mapInPandas(compare, schema))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "place"])
        ids = pdf["a"].to_numpy(dtype=np.int64)
        i, j = _window_pairs(_stack(pdf["unit"].tolist()), 0, window, cosine)
        return pd.DataFrame(_forest(ids, i, j), columns=["a", "b"], dtype="int64")

    borders = out.filter("border >= 0").groupBy("border").applyInPandas(across, "a long, b long")
    dense = dense_run_edges(units, units.mapInPandas(keys_only, "pass int, key long, vec_id long"), shared_bits(n, window), cosine, window)
    return out.filter("border = -1").select("a", "b").union(borders).union(dense)


def count_links(grouped: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links) of ``grouped(vec_id, unit, component)``, exact within each component."""
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    held = materialize(skewed_join(grouped, sizes, "component", [F.col("vec_id")]))

    def all_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _stack(pdf["unit"].tolist())
        return pd.DataFrame({"vec_id": pdf["vec_id"], "n_links": (x @ x.T >= cosine).sum(axis=1) - 1})

    small = held.filter(F.col("size") <= EXACT).groupBy("component").applyInPandas(all_pairs, "vec_id long, n_links long")
    large = held.filter(F.col("size") > EXACT)
    if large.isEmpty():
        return small

    # The centre of each large component: partial sums by salt, then over salts.
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(c, _stack(g["unit"].tolist()).sum(axis=0).tolist()) for c, g in batch.groupby("component")]
            yield pd.DataFrame(rows, columns=["component", "total"])

    totals = large.mapInPandas(partial, "component long, total array<double>").select("component", F.posexplode("total").alias("k", "x"))
    sums = totals.groupBy("component", "k").agg(F.sum("x").alias("x"))
    centre = sums.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("centre"))
    near = skewed_join(large, centre, "component", [F.col("vec_id")])
    # Two vectors within half the angle of a centre are within the angle of each other; the margin is far above rounding.
    half = math.cos(math.acos(cosine) / 2) + 1e-9

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, c = _stack(batch["unit"].tolist()), np.stack(batch["centre"].to_numpy())
                size = np.sqrt((c * c).sum(axis=1))
                yield pd.DataFrame({"component": batch["component"], "near": (x * c).sum(axis=1) / np.where(size > 0, size, 1)})

    proven = near.mapInPandas(within, "component long, near double").groupBy("component").agg(F.min("near").alias("least"))
    marked = materialize(skewed_join(large, proven, "component", [F.col("vec_id")]))
    cliques = marked.filter(F.col("least") >= half).select("vec_id", (F.col("size") - 1).alias("n_links"))
    open_ = marked.filter(F.col("least") < half)
    if open_.isEmpty():
        return small.union(cliques)

    # Blocks of about BLOCK members; every block meets every block of its component.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = open_.withColumn("own", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).withColumn("blocks", blocks)
    asking = dealt.select("component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "vec_id", "unit", F.lit(0).alias("role"))
    asked = dealt.select("component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), F.col("own").alias("other"), "vec_id", "unit", F.lit(1).alias("role"))

    def block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"vec_id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})
        hit = _stack(a["unit"].tolist()) @ _stack(b["unit"].tolist()).T >= cosine
        hit &= a["vec_id"].to_numpy()[:, None] != b["vec_id"].to_numpy()[None, :]
        return pd.DataFrame({"vec_id": a["vec_id"].to_numpy(), "n": hit.sum(axis=1)})

    counted = asking.union(asked).groupBy("component", "own", "other").applyInPandas(block_pairs, "vec_id long, n long")
    return small.union(cliques).union(counted.groupBy("vec_id").agg(F.sum("n").alias("n_links")))


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id of ``vectors(vec_id, embedding)``.

    Vectors of different dimensions have no cosine; each dimension that occurs is compared by itself.
    """
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    units = materialize(unit_vectors(vectors))
    dims = [r[0] for r in units.select((F.length("unit") / 8).cast("int")).distinct().orderBy(1).collect()]
    plain = everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), (F.col("vec_id") == F.col("vec_id")).alias("kept"))
    parts = [p for p in (_linked(units.filter(F.length("unit") == 8 * d), d, cosine, window) for d in dims) if p is not None]
    if not parts:
        return plain
    links = parts[0]
    for p in parts[1:]:
        links = links.union(p)
    joined = everyone.join(links, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _linked(usable: DataFrame, dim: int, cosine: float, window: int) -> DataFrame | None:
    """(vec_id, n_links, component) of the linked ones among vectors of one dimension; None if there are none."""
    firsts = materialize(usable.groupBy("unit").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")))
    copied = firsts.filter("copies > 1").select("unit", F.col("vec_id").alias("b"))
    copies = skewed_join(usable, copied, "unit", [F.col("vec_id")]).select(F.col("vec_id").alias("a"), "b").filter("a <> b")
    edges = sorted_pass_edges(firsts.select("vec_id", "unit"), firsts.count(), dim, cosine, window)
    found = materialize(connected_components(edges.union(copies)))
    if found.isEmpty():
        return None
    grouped = usable.join(found.withColumnRenamed("node", "vec_id"), "vec_id")
    return count_links(grouped, cosine).join(found.withColumnRenamed("node", "vec_id"), "vec_id").select("vec_id", "n_links", "component")
