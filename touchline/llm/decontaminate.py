"""Benchmark decontamination by spaced-seed hashing.

Fixed masks ignore chosen token positions, so a seed still hits where a substituted word falls
on an ignored place. The seeds of the benchmark are joined with the seeds at every position of every
document; around a hit the two texts are compared word by word on the hit's diagonal, and every
stretch of at least ``MIN_WORDS`` words of which ``IDENTITY`` agree is an overlap: the
best-scoring one first, else the longest, then those beside it (see ``stretches``).

Scale. A Bloom filter of the benchmark's seeds, built by one aggregation, is broadcast; it has 32 bits
per seed between ``LEAST_BITS`` and ``MOST_BITS``, so its size is bounded whatever the benchmark's. One scan
lets through the texts with a seed that the filter holds, and only those are written, their copies
once. Their seeds meet the benchmark's in an ordinary equi-join, which drops the filter's false
positives; hits meet words by joins too, cut down to the item's length. Nothing is collected but the
filter's words. A filter that is too small lets more through and changes no result.

Words are runs of letters and digits in lower case. Items of ``SHORT_WORDS`` up to ``MIN_WORDS`` words are
overlaps only as a whole (all their words in a row); shorter ones, such as a bare "yes", are no
passages and overlap with nothing. Null and empty texts and items overlap with nothing. Repeated rows
give repeated results; an item_id with several texts is several items; an empty table gives no overlaps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Words, batches_by_size, materialize, mix64, skewed_join

#: Fixed masks (1: the word counts): spans of 8 to 11 words, 7 of which count.
MASKS = ("11101011", "110110111", "11101001011", "1111111")
MIN_WORDS = 12
#: The least words of an item, and the mask laid at the first word of items below ``MIN_WORDS``.
SHORT_WORDS = 5
SHORT_MASK = "1" * SHORT_WORDS
IDENTITY = 0.8
LEAST_BITS = 1 << 23
MOST_BITS = 1 << 30
PROBES = 4
_MISS = 3.0

OVERLAP = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long"


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the counted words of ``mask`` laid at each position (fewer positions than words)."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                total += words[j : j + n] * np.uint64(pow(0xC2B2AE3D27D4EB4F, 2 * j + 1, 1 << 64) | 1)
    return mix64(total, seed=len(mask) + 100 * mask.count("0"))


def _best(same: np.ndarray) -> tuple[int, int]:
    """The stretch of highest score, 1 for an equal word and -``_MISS`` for another."""
    score = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, -_MISS))))
    low = np.minimum.accumulate(score)
    stop = int(np.argmax(score - low))
    return int(np.flatnonzero(score[: stop + 1] == low[stop])[-1]), stop


def _longest(same: np.ndarray) -> tuple[int, int]:
    """The longest stretch of which ``IDENTITY`` agree; different words at its ends are left out down to ``MIN_WORDS`` words."""
    # In whole hundredths, so that a share of exactly IDENTITY counts.
    share = round(100 * IDENTITY)
    score = np.concatenate(([0], np.cumsum(np.where(same, 100 - share, -share))))
    # For each end the first start that scores no higher: the minima so far fall, so theirs can be searched.
    starts = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    stop = int(np.argmax(np.arange(len(score)) - starts))
    start = int(starts[stop])
    while stop - start > MIN_WORDS and not same[stop - 1]:
        stop -= 1
    while stop - start > MIN_WORDS and not same[start]:
        start += 1
    return start, stop


def stretches(same: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, stop) of at least ``MIN_WORDS`` words of which ``IDENTITY`` agree, none overlapping.

    What is left beside them holds no such stretch.
    """
    out, open_ = [], [(0, len(same))]
    while open_:
        begin, end = open_.pop()
        if end - begin < MIN_WORDS:
            continue
        for pick in (_best, _longest):
            start, stop = pick(same[begin:end])
            if stop - start >= MIN_WORDS and same[begin + start : begin + stop].sum() >= IDENTITY * (stop - start):
                out.append((begin + start, begin + stop))
                open_ += [(begin, begin + start), (begin + stop, end)]
                break
    return sorted(out)


def _placed_seeds(words: Words, mask: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the text, seed) of every place at which a mask lies within one text."""
    h = seed_hashes(words.hashes, mask)
    lengths = np.diff(words.bounds)
    text = np.repeat(np.arange(len(lengths)), lengths)[: len(h)]
    place = np.arange(len(h)) - words.bounds[:-1][text]
    inside = np.flatnonzero(place + len(mask) <= lengths[text])
    return text[inside], place[inside], h[inside]


def _by_text(text: np.ndarray, place: np.ndarray, seed: np.ndarray, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places and seeds of each of ``n`` texts."""
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(1, n))
    return np.split(place[order].astype(np.int32), cuts), np.split(seed[order].view(np.int64), cuts)


def _word_bytes(words: Words, i: int) -> bytes:
    """The words of a text as four bytes each."""
    return (words.hashes[words.bounds[i] : words.bounds[i + 1]] >> np.uint64(32)).astype("<u4").tobytes()


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, n, seq, seeds, places) of the items that can overlap; ``item`` numbers the texts by a hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_by_size(batch):
                words = Words(part["text"].tolist())
                n = np.diff(words.bounds)
                found = [_placed_seeds(words, m) for m in MASKS]
                text, place, seed = (np.concatenate(x) for x in zip(*found, strict=True))
                keep = n[text] >= MIN_WORDS
                short = _placed_seeds(words, SHORT_MASK)
                first = (short[1] == 0) & (n[short[0]] < MIN_WORDS)
                text, place, seed = (np.concatenate((x[keep], y[first])) for x, y in zip((text, place, seed), short, strict=True))
                place, seed = _by_text(text, place, seed, len(n))
                seqs = [_word_bytes(words, i) for i in range(len(n))]
                yield pd.DataFrame({"item_id": part["item_id"].to_numpy(), "item": part["item"].to_numpy(), "n": n, "seq": seqs, "seeds": seed, "places": place})

    rows = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    out = rows.withColumn("item", F.xxhash64("item_id", "text")).mapInPandas(run, "item_id long, item long, n long, seq binary, seeds array<long>, places array<int>")
    return out.filter(F.col("n") >= SHORT_WORDS)


def _probes(seeds: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit numbers of each seed, probe after probe; ``bits`` is a power of two."""
    for k in range(PROBES):
        yield (mix64(seeds, seed=k + 31) & np.uint64(bits - 1)).astype(np.int64)


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bits, packed in bytes, of a Bloom filter of ``seeds(seed)``."""
    n = seeds.agg(F.count("*")).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(32 * max(1, n)))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(np.concatenate([*_probes(batch["seed"].to_numpy(dtype=np.int64).view(np.uint64), bits), np.zeros(0, dtype=np.int64)]))
            yield pd.DataFrame({"word": at >> 6, "bit": (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)})

    words = seeds.mapInPandas(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint8)


def _text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text; null for a null text."""
    return [F.when(text.isNotNull(), F.xxhash64(text)).alias("k1"), F.when(text.isNotNull(), F.xxhash64(F.lit("second"), text)).alias("k2")]


def _candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(k1, k2, seq, seeds, places) of the distinct texts with a seed that the filter holds: all such seeds with their places."""
    spark = docs.sparkSession
    masks = (*MASKS, SHORT_MASK) if not items.filter(F.col("n") < MIN_WORDS).isEmpty() else MASKS
    shared = spark.sparkContext.broadcast(seed_filter(items.select(F.explode("seeds").alias("seed"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            for part in batches_by_size(batch):
                words = Words(part["text"].tolist())
                found = []
                for mask in masks:
                    text, place, seed = _placed_seeds(words, mask)
                    left = np.arange(len(seed))
                    for at in _probes(seed, 8 * len(table)) if len(seed) else ():
                        at = at[left]
                        left = left[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
                    found.append((text[left], place[left], seed[left]))
                text, place, seed = (np.concatenate(x) for x in zip(*found, strict=True))
                hit, (place, seed) = np.unique(text), _by_text(text, place, seed, len(part))
                yield pd.DataFrame(
                    {
                        "k1": part["k1"].to_numpy()[hit], "k2": part["k2"].to_numpy()[hit], "seq": [_word_bytes(words, i) for i in hit.tolist()],
                        "seeds": pd.Series([seed[i] for i in hit.tolist()], dtype=object), "places": pd.Series([place[i] for i in hit.tolist()], dtype=object),
                    }
                )

    texts = docs.filter("text is not null").select(*_text_key(F.col("text")), "text")
    found = materialize(texts.mapInPandas(run, "k1 long, k2 long, seq binary, seeds array<long>, places array<int>"))
    return materialize(found.groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ("seq", "seeds", "places")]))


def text_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, item_id, doc_start, item_start, n_words, n_equal) of the distinct texts of ``docs``."""
    items = materialize(benchmark_items(benchmark))
    texts = _candidates(docs, items)
    own = texts.select("k1", "k2", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("k1", "k2", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    held = items.select("item", "n", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("item", "n", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    hits = own.join(held.hint("merge"), "seed").select("k1", "k2", "item", "n", (F.col("place") - F.col("at")).alias("shift")).distinct()
    # From the document, only the words beside the item's: from ``begin`` of the item on.
    begin = F.greatest(F.lit(0), -F.col("shift"))
    part = F.substring(F.col("seq"), (4 * (F.col("shift") + begin) + 1).cast("int"), (4 * (F.col("n") - begin)).cast("int"))
    cut = hits.join(texts.select("k1", "k2", "seq").hint("merge"), ["k1", "k2"]).select("k1", "k2", "item", "shift", begin.cast("int").alias("begin"), part.alias("doc"))
    both = skewed_join(cut, items.select("item", "item_id", "seq"), "item", [F.col("k1")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for k1, k2, item, shift, begin, doc, seq in zip(*(batch[c].tolist() for c in ("k1", "k2", "item_id", "shift", "begin", "doc", "seq")), strict=True):
                a, b = np.frombuffer(doc, dtype="<u4"), np.frombuffer(seq, dtype="<u4")
                if len(b) < MIN_WORDS:
                    if np.array_equal(a, b):
                        found.append((k1, k2, item, shift, 0, len(b), len(b)))
                    continue
                same = a == b[begin : begin + len(a)]
                for start, stop in stretches(same):
                    found.append((k1, k2, item, shift + begin + start, begin + start, stop - start, int(same[start:stop].sum())))
            yield pd.DataFrame(found, columns=["k1", "k2", "item_id", "doc_start", "item_start", "n_words", "n_equal"], dtype="int64")

    return both.mapInPandas(run, "k1 long, k2 long, item_id long, doc_start long, item_start long, n_words long, n_equal long")


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """OVERLAP rows of ``docs(doc_id, text)`` against ``benchmark(item_id, text)``: one per row, item and stretch; starts count words."""
    found = materialize(text_overlaps(docs, benchmark))
    rows = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *_text_key(F.col("text")))
    return rows.join(found.hint("merge"), ["k1", "k2"]).select("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no benchmark item, all columns as they are."""
    found = materialize(text_overlaps(docs, benchmark).select("k1", "k2").distinct())
    # The row travels as one struct, so no column of the input can clash with the keys.
    rows = docs.select(F.struct("*").alias("row"), *_text_key(F.col("text")))
    kept = rows.join(found.hint("merge"), ["k1", "k2"], "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
