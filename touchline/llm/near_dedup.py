"""MinHash near-dedup by Order MinHash, verified by banded alignment.

A document is its sequence of words. A sketch is the ``PICK`` shingles of five words, each labelled
with its occurrence number in the document, of least hash, kept in text order, so equal sketches need
equal shingles in equal order (edit similarity rather than set overlap). Documents that share one of
``SKETCHES`` sketches are candidates; a pair is linked if the alignment of the two word sequences
(longest common subsequence within the band that the similarity allows) has
``common / (a + b - common) >= 0.8``. Every pair whose shingles reach 0.8 is among them: in order, c
common shingles hold at least c + 4 common words.

Pairs of which a share j of all labelled shingles is common share a sketch with a probability of
about ``1 - (1 - j ** PICK) ** SKETCHES``: 0.999 at 0.55, 0.97 at 0.4. Texts of a few dozen words can
reach 0.8 with fewer common shingles; such pairs may be missed.

Scale. Equal texts are collapsed first, so copies are never paired. Each member of a bucket is
compared with the bucket's first. Then every pair that shares a bucket and is not connected is asked
(``rest``): blocks of at most ``BLOCK`` members and about ``BLOCK_WORDS`` words meet block by block, only
where lengths allow a link; a group of more than a block has blocks of its own, which do not meet each
other. No bucket is capped. Blocks that meet grow with the square of the unrelated documents of like
length in one bucket.

Null and empty texts are equal texts. Texts of fewer than five words have one shingle, all their
words. Rows with a null doc_id are left out of the grouping. Repeated rows give repeated results; a
doc_id with several texts has a row, and a class, for each of them, and ``keep_one`` drops it if any is a
later copy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Words, batches_by_size, connected_components, grams, materialize, mix64, skewed_join

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 20
PICK = 2
#: Members, and words, of a bucket that meet another block together.
BLOCK = 500
BLOCK_WORDS = 1_000_000


def labelled_shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all occurrence-labelled shingles, bounds per document)."""
    lengths = np.diff(words.bounds)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - k + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    total = int(bounds[-1])
    if not total:
        return np.zeros(0, dtype=np.uint64), bounds
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(total) - bounds[:-1][doc] + words.bounds[:-1][doc]
    g = grams(words.hashes, k)[place]
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    for i in short:
        own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        g[bounds[i]] = mix64(grams(np.concatenate((own, np.zeros(k, dtype=np.uint64))), k)[:1], seed=len(own))[0]
    with np.errstate(over="ignore"):
        key = g ^ mix64(doc.astype(np.uint64), seed=3)
        order = np.argsort(key)
        again = key[order[1:]] == key[order[:-1]]
        # Only shingles that come more than once in a document have other numbers than 0, in text order.
        several = np.sort(order[np.concatenate((again, [False])) | np.concatenate(([False], again))])
        several = several[np.argsort(key[several], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], key[several][1:] != key[several][:-1]))) if len(several) else several
        number = np.arange(len(several)) - np.repeat(first, np.diff(np.append(first, len(several))))
        g[several] += number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix64(g), bounds


def order_min_hashes(labelled: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(documents, SKETCHES) sketch keys; documents without shingles get zeros.

    One hash deals a document's shingles over ``SKETCHES`` bins and orders each bin. A sketch is the
    ``PICK`` least shingles of a bin, of those after it (in a circle) where it has fewer.
    """
    n = len(bounds) - 1
    out = np.zeros((n, SKETCHES), dtype=np.uint64)
    counts = np.diff(bounds)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    spread = mix64(labelled, seed=7)
    group = np.repeat(np.arange(n) * SKETCHES, counts) + (spread % np.uint64(SKETCHES)).astype(np.int64)
    order = np.argsort((group.astype(np.uint64) << np.uint64(32)) | (spread >> np.uint64(32)))
    size = np.bincount(group, minlength=n * SKETCHES).reshape(n, SKETCHES)[filled]
    before = np.concatenate(([0], np.cumsum(size)))[:-1].reshape(size.shape)
    # The k-th shingle of a bin and those after it is number ``rest`` of bin ``at``.
    at = np.tile(np.arange(SKETCHES), (len(filled), 1))
    rest, row = np.zeros_like(at), np.arange(len(filled))[:, None]
    picked = np.empty((PICK, *size.shape), dtype=np.int64)
    whole = np.repeat(counts[filled][:, None], SKETCHES, axis=1)
    for k in range(PICK):
        # A document of fewer shingles than PICK has them once more.
        for _ in range(SKETCHES):
            empty = rest >= size[row, at]
            if not empty.any():
                break
            rest[empty] = 0
            at[empty] = (at[empty] + 1) % SKETCHES
        picked[k] = order[before[row, at] + rest]
        rest += whole > k
    places = np.sort(picked, axis=0)
    key = np.broadcast_to(mix64(np.arange(SKETCHES, dtype=np.uint64), seed=11), size.shape)
    for p in places:
        key = mix64(key ^ labelled[p], seed=13)
    out[filled] = key
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, f1, f2, n, sketch, seq) of ``docs(doc_id, text)``.

    (f1, f2) fingerprint the whole word sequence; n: its words; seq: their hashes, four bytes each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_by_size(batch):
                words = Words(part["text"].tolist())
                labelled, bounds = labelled_shingles(words)
                keys = order_min_hashes(labelled, bounds).view(np.int64)
                small = (words.hashes >> np.uint64(32)).astype("<u4")
                n = np.diff(words.bounds)
                place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], n)
                with np.errstate(over="ignore"):
                    steps = mix64(words.hashes ^ mix64(place.astype(np.uint64), seed=5))
                    prints = [np.concatenate(([0], np.cumsum(x))).astype(np.uint64)[words.bounds] for x in (steps, mix64(steps, seed=9))]
                    f1, f2 = (np.diff(x).view(np.int64) for x in prints)
                seqs = [small[s:e].tobytes() for s, e in zip(words.bounds, words.bounds[1:], strict=False)]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "f1": f1, "f2": f2, "n": n, "sketch": list(keys), "seq": seqs})

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, f1 long, f2 long, n long, sketch array<long>, seq binary")


def common_words(a: np.ndarray, b: np.ndarray, band: int, block: int = 4096) -> int:
    """Length of the longest common subsequence whose places are at most ``band`` (and part of a block) apart.

    Bit-parallel: one bit per word of ``a``, a block of them at a time; a row per word of ``b``, whose
    carry goes from block to block.
    """
    rows, carry, total = b.tolist(), bytearray(len(b)), 0
    for at in range(0, len(a), block):
        part = a[at : at + block].tolist()
        width = len(part)
        full = state = (1 << width) - 1
        places: dict[int, int] = {}
        for i, w in enumerate(part):
            places[w] = places.get(w, 0) | (1 << i)
        for r in range(max(0, at - band), min(len(rows), at + width + band)):
            hit, c = places.get(rows[r], 0), carry[r]
            if hit or c:
                used = state & hit
                step = state + used + c
                carry[r] = step >> width
                state = (step & full) | (state - used)
        total += width - state.bit_count()
    return total


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the banded alignment of two word sequences reaches ``similarity``."""
    size = len(a) + len(b)
    need = similarity * size / (1 + similarity) - 1e-9
    short = min(len(a), len(b))
    if not size or short < need:
        return size == 0
    other = np.flatnonzero(a[:short] != b[:short])
    head = int(other[0]) if len(other) else short
    # The words on the diagonal are a common subsequence.
    if short - len(other) >= need:
        return True
    a, b = a[head:], b[head:]
    short -= head
    other = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(other[0]) if len(other) else short
    if head + short - len(other) >= need:
        return True
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    # Whoever is farther from the diagonal has lost too many words.
    return head + tail + common_words(a, b, int(size - 2 * need) + 1) >= need


def verify(pairs: DataFrame, seqs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of distinct documents whose alignment reaches ``similarity``; ``seqs(rep, seq)``.

    ``b`` may be a hub of many pairs: it comes last, in ``skewed_join``.
    """
    one = pairs.join(seqs.select(F.col("rep").alias("a"), F.col("seq").alias("seq_a")).hint("merge"), "a")
    both = skewed_join(one, seqs.select(F.col("rep").alias("b"), F.col("seq").alias("seq_b")), "b", [F.col("a")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["a"].tolist(), batch["b"].tolist(), batch["seq_a"].tolist(), batch["seq_b"].tolist(), strict=True)
            found = [(a, b) for a, b, x, y in rows if aligned(np.frombuffer(x, dtype="<u4"), np.frombuffer(y, dtype="<u4"), similarity)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return both.select("a", "b", "seq_a", "seq_b").mapInPandas(run, "a long, b long")


def _crowded(keyed: DataFrame) -> DataFrame:
    """``keyed(key, rep, ...)`` of buckets of two or more, with the bucket's size ``m`` and first member ``top``."""
    crowded = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("top")).filter("m > 1")
    return skewed_join(keyed, crowded, "key", [F.col("rep")])


def _block_links(components: list[int], seqs: list[np.ndarray], split: int, similarity: float) -> list[tuple[int, int]]:
    """Links between the components of rows before ``split`` and those from it on (of all rows with each other, if none are)."""
    n = len(seqs)
    x, y = (np.arange(split), np.arange(split, n)) if split < n else (np.arange(n), np.arange(n))
    group = np.unique(components, return_inverse=True)[1]
    open_ = group[x][:, None] != group[y][None, :]
    if split >= n:
        open_ &= x[:, None] < y[None, :]
    sizes = np.array([len(s) for s in seqs])
    need = similarity * (sizes[x][:, None] + sizes[y][None, :]) / (1 + similarity) - 1e-9
    open_ &= np.minimum(sizes[x][:, None], sizes[y][None, :]) >= need
    if not open_.any():
        return []
    # A common subsequence is no longer than the multiset of common words: words labelled by their occurrence.
    row = np.repeat(np.arange(n), sizes)
    word = (row.astype(np.uint64) << np.uint64(32)) | np.concatenate(seqs).astype(np.uint64)
    order = np.argsort(word, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], word[order][1:] != word[order][:-1])))
    occurrence = np.empty(len(word), dtype=np.uint64)
    occurrence[order] = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
    _, label, count = np.unique((word << np.uint64(32)) | occurrence, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    shared = count[label] > 1
    row, column = row[shared], column[label[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(x), len(y)), dtype=np.float32)
    step = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, (at, at + step))
        held = np.zeros((n, step), dtype=np.float32)
        held[row[lo:hi], column[lo:hi] - at] = 1
        common += held[x] @ held[y].T
    out, root = [], list(range(int(group.max()) + 1))

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    for i, j in zip(*(k.tolist() for k in np.nonzero(open_ & (common >= need))), strict=True):
        i, j = int(x[i]), int(y[j])
        a, b = find(int(group[i])), find(int(group[j]))
        if a != b and aligned(seqs[i], seqs[j], similarity):
            root[a] = b
            out.append((components[i], components[j]))
    return out


def rest(named: DataFrame, seqs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between components of ``named(key, rep, n, component)`` that have linked members in a bucket.

    ``n``: words. Levels of length are a little wider than a link allows, so linked documents are in
    one level or in neighbouring ones. Buckets of two were asked before.
    """
    mixed = named.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("m > 2 and lo < hi")
    step = math.log(1.01 / similarity)
    level = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    rows = skewed_join(named, mixed.select("key"), "key", [F.col("rep")])
    rows = materialize(rows.select("key", "rep", "component", level.alias("level"), F.struct("key", level.alias("level"), "component").alias("cell")), narrow=True)
    # The longest text of a level decides how many make a block. Components of more than a block have blocks of their own.
    most = F.least(F.lit(float(BLOCK)), F.greatest(F.lit(1.0), BLOCK_WORDS / F.exp((F.col("level") + 1) * step)))
    cells = rows.groupBy("cell").agg(F.count("*").alias("m")).select("cell", "m", "cell.key", "cell.level")
    crowd = cells.filter(F.col("m") <= most).groupBy("key", "level").agg(F.sum("m").alias("total"))
    cells = cells.join(crowd.hint("merge"), ["key", "level"], "left").select("cell", F.when(F.col("m") > most, F.col("m")).alias("m"), "total")
    dealt = skewed_join(rows, cells, "cell", [F.col("rep")])
    own = F.when(F.col("m").isNotNull(), F.col("component"))
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.coalesce("m", "total") / most))
    members = materialize(dealt.select("key", "level", F.xxhash64(own, part).alias("block"), "rep", "component", own.alias("own")), narrow=True)

    blocks = members.groupBy("key", "level", "block").agg(F.first("own").alias("own"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    one = blocks.select("key", F.col("level").alias("at"), *[F.col(c).alias(f"{c}_1") for c in ("level", "block", "own", "lo", "hi")])
    two = blocks.select("key", F.explode(F.array("level", F.col("level") - 1)).alias("at"), *[F.col(c).alias(f"{c}_2") for c in ("level", "block", "own", "lo", "hi")])
    meet = one.join(two.hint("merge"), ["key", "at"]).filter(
        "(level_1 < level_2 or block_1 <= block_2) and least(lo_1, lo_2) < greatest(hi_1, hi_2) and not (own_1 is not null and own_2 is not null and own_1 = own_2)"
    )
    task = F.xxhash64("key", "level_1", "block_1", "level_2", "block_2").alias("task")
    sides = [F.struct(F.col(f"level_{k}").alias("level"), F.col(f"block_{k}").alias("block"), F.lit(k).alias("side")) for k in (1, 2)]
    same = (F.col("level_1") == F.col("level_2")) & (F.col("block_1") == F.col("block_2"))
    asked = meet.select("key", task, F.explode(F.when(same, F.array(sides[0])).otherwise(F.array(*sides))).alias("s")).select("key", "task", "s.*")
    asked = members.select("key", "level", "block", "rep", "component").join(asked.hint("merge"), ["key", "level", "block"])
    asked = asked.select("task", "side", "rep", "component").join(seqs.hint("merge"), "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, held = None, ([], [], [])

        def done() -> list[tuple[int, int]]:
            sides, components, own = held
            return _block_links(components, own, sides.count(1), similarity) if len(sides) > 1 else []

        for batch in batches:
            found = []
            for t, *row, seq in zip(*(batch[c].tolist() for c in ("task", "side", "component", "seq")), strict=True):
                if t != task:
                    found += done()
                    task, held = t, ([], [], [])
                for have, value in zip(held, (*row, np.frombuffer(seq, dtype="<u4")), strict=True):
                    have.append(value)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(done(), columns=["a", "b"], dtype="int64")

    dealt = asked.repartition("task").sortWithinPartitions("task", "side")
    return dealt.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, exact_id, class_id, kept) for every row of ``docs(doc_id, text)``.

    exact_id: smallest doc_id of the same word sequence; class_id: smallest doc_id reachable by
    links; kept: doc_id = class_id.
    """
    drawn = materialize(sketches(docs))
    # Equal texts: smallest id per fingerprint, joined back only where there are copies.
    first = [F.first(c).alias(c) for c in ("n", "sketch", "seq")]
    classes = materialize(drawn.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *first))
    copied = classes.filter("copies > 1").select(F.struct("f1", "f2").alias("f"), "rep")
    rows = skewed_join(drawn.select("doc_id", F.struct("f1", "f2").alias("f")), copied, "f", [F.col("doc_id")], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("exact_id"))
    keyed = classes.filter("n > 0").select("rep", "n", F.posexplode("sketch").alias("j", "s")).select("rep", "n", F.xxhash64("j", "s").alias("key"))
    # Buckets of one member never matter again.
    buckets = materialize(_crowded(keyed), narrow=True)
    seqs = classes.select("rep", "seq")
    pairs = buckets.filter("rep <> top").select(F.col("rep").alias("a"), F.col("top").alias("b")).distinct()
    found = materialize(verify(pairs, seqs, similarity), narrow=True)
    near = connected_components(found)
    named = buckets.select("key", "rep", "n").join(near.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
    left = materialize(rest(named.withColumn("component", F.coalesce("component", "rep")), seqs, similarity))
    joined = skewed_join(rows, near.select(F.col("node").alias("exact_id"), F.col("component").alias("near")), "exact_id", [F.col("doc_id")], "left")
    joined = joined.withColumn("near", F.coalesce("near", "exact_id"))
    if not left.isEmpty():
        # The links between components make components of components.
        wider = connected_components(left).select(F.col("node").alias("near"), "component")
        joined = skewed_join(joined, wider, "near", [F.col("doc_id")], "left").withColumn("near", F.coalesce("component", "near"))
    return joined.select("doc_id", "exact_id", F.col("near").alias("class_id"), (F.col("doc_id") == F.col("near")).alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without the documents of a group other than its first; all columns as they are."""
    dropped = near_duplicates(docs, similarity).filter("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
