"""Shared helpers: shared-storage materialisation, joins over hot keys, connected components, word hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Number of salts used wherever one key may hold a large share of all rows.
SALTS = 32


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir``.

    Only a local master, as in tests, may do without; there a temporary folder is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="touchline-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


#: Spark's own setting to remove the shuffle files of an execution once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Files per core of a written table of narrow rows.
NARROW_FILES = 4


def materialize(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor never forces recomputation past this point, a column that is not needed later
    is not read again, and the shuffle files of the steps before are removed. ``narrow``: rows of a few
    numbers, which go to at most ``NARROW_FILES`` files per core instead of one per shuffle partition.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(NARROW_FILES * spark.sparkContext.defaultParallelism)
    path = f"{shared_dir(spark)}/touchline-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salt_of(*cols: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def skewed_join(
    big: DataFrame, small: DataFrame, key: str, spread: list[Column], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join where one ``key`` value may hold a third of ``big``; ``small`` is unique on ``key``.

    A merge join, never a broadcast, since ``small`` may grow with the data. Adaptive execution
    splits the partition of a hot key. Where a session has that turned off, ``big`` rows are dealt
    over ``salts`` sub-keys by a hash of ``spread`` and ``small`` is repeated once per sub-key.
    """
    conf = big.sparkSession.conf
    if all(conf.get(f"spark.sql.adaptive.{x}", "true") == "true" for x in ("enabled", "skewJoin.enabled")):
        return big.join(small.hint("merge"), key, how)
    left = big.withColumn("_salt", salt_of(*spread, salts=salts))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component = smallest node reachable.

    An edge leads from its larger end, the child, to the smaller one, the parent. A round links each
    child to its smallest parent alone and its other parents to that one, then every child to its
    parent's smallest parent; it ends when nothing moves, so all are stars. A node is dealt by its
    number of parents; children of a hub, a third of all edges maybe, meet the hub's parent in
    ``skewed_join``. Rounds grow with the logarithm of the longest chain, and no round makes more
    edges. Nothing is collected. Null ends and self loops are ignored; empty input gives no rows.
    """
    by_child = Window.partitionBy("a").orderBy("b")
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(max_rounds):
        ranked = current.select("a", "b", F.first("b").over(by_child).alias("least"), F.lag("b").over(by_child).alias("before")).filter("before is null or before <> b")
        other = F.col("before").isNotNull()
        single = ranked.select(F.when(other, F.col("b")).otherwise(F.col("a")).alias("a"), F.col("least").alias("b"), other.alias("moved"))
        up = single.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("up"))
        jumped = skewed_join(single, up, "b", [F.col("a")], "left")
        current = materialize(jumped.select("a", F.coalesce("up", "b").alias("b"), (F.col("moved") | F.col("up").isNotNull()).alias("moved")), narrow=True)
        if current.filter("moved").isEmpty():
            break
    else:
        raise RuntimeError("connected components did not settle")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


# ---------------------------------------------------------------- word hashing (numpy)

_ODD = 0x9E3779B97F4A7C15 | 1
_INV = pow(_ODD, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        filled, step = 1, base
        while filled < size:
            take = min(filled, size - filled)
            have[filled : filled + take] = have[:take] * np.uint64(step)
            filled, step = filled + take, step * step % (1 << 64)
        _POWERS[base] = have
    return have[:n]


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x80:] = True
for _span in (b"09", b"az", b"AZ"):
    _IS_WORD[_span[0] : _span[1] + 1] = True


class Words:
    """Hashes of all words of a list of texts, in order, with document bounds.

    A word is a run of letters or digits (any non-ASCII character counts as a letter),
    compared in lower case. ``hashes[bounds[i]:bounds[i+1]]`` are those of text i.
    """

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
        buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        ends_of_text = np.cumsum(sizes)
        mask = _IS_WORD[buf]
        change = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if len(mask) and mask[0]:
            change = np.concatenate(([0], change))
        starts, ends = change[0::2], change[1::2]
        with np.errstate(over="ignore"):
            total = np.zeros(len(buf) + 1, dtype=np.uint64)
            np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_ODD, len(buf)), out=total[1:])
            h = (total[ends] - total[starts]) * powers(_INV, len(buf) + 1)[starts]
        self.hashes = mix64(h)
        self.bounds = np.concatenate(([0], np.searchsorted(starts, ends_of_text))).astype(np.int64)
        self.byte_starts, self.byte_ends = starts, ends
        self.text_starts = np.concatenate(([0], ends_of_text[:-1]))


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each position (the last k-1 positions are not meaningful)."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(words), dtype=np.uint64)
        for j in range(k):
            out[: len(words) - j] += words[j:] * np.uint64(pow(_ODD, 2 * j + 1, 1 << 64))
    return mix64(out)


def batches_by_size(pdf, limit: int = 1_000_000):
    """Split a pandas batch into slices of about ``limit`` characters (a longer text is a slice of its own)."""
    sizes = pdf["text"].str.len().fillna(0).to_numpy(dtype=np.int64) + 1
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield pdf.iloc[begin:i]
            begin, total = i, 0
        total += n
    if begin < len(pdf):
        yield pdf.iloc[begin:]
