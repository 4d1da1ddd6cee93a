"""Best-fit packing by large-item matching.

Documents become token pieces (only those longer than a sequence are cut). Pieces above a
third of the capacity pair at most twice per sequence by greedy matching (each of the
longest takes the longest partner that still fits); the smaller pieces, longest first,
go to the fullest sequence that still has room (best fit).

The matching works on the histogram of piece lengths: equal pieces are interchangeable, so a
plan over at most ``capacity`` lengths with multiplicities is the same packing as one over
pieces. Its size depends on the capacity alone, not on the number of documents, so the driver
may hold and broadcast it. Each piece then gets its number within its length (counts by
bucket, prefix sums, row numbers within a bucket), and the plan maps it to its place.

Null and empty texts are one piece (the end token). Repeated rows are packed as often as they
occur. Very long texts become full pieces and a rest. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import batches_by_size, materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces a bucket, on average: pieces of one length are numbered bucket by bucket.
BUCKET = 20_000

#: Texts of these characters only (as Latin-1 bytes) are normalised alike by str.lower() and by the tokenizer file's own steps.
_PLAIN = bytes(c for c in range(256) if c in b"\t\n\r" or 0x20 <= c <= 0x7E or c >= 0xC0 and c not in (0xD7, 0xF7))
#: The file's pre-token pattern, over those characters.
_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÿ]+|[0-9]|[^\sa-z0-9À-ÿ]+")


def _pretokens(word: str) -> list[str]:
    """Pre-tokens of a lower-case word of plain characters."""
    if word.isalpha():
        return [word]
    if word[:-1].isalpha() and not word[-1].isalnum():
        return [word[:-1], word[-1]]
    return _TOKEN.findall(word)


class _Lookup(dict):
    """Values by key; what is asked for in vain gets an empty place, which is noted in ``missed`` to be filled."""

    def __init__(self):
        super().__init__()
        self.missed: dict[str, bytearray] = {}

    def __missing__(self, key: str) -> bytearray:
        value = self[key] = self.missed[key] = bytearray()
        return value


class WordCodec:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The file's tokenizer splits a text into pre-tokens, none of which holds white space, and merges
    each on its own. So the ids of a white-space word are put together once from those of its
    pre-tokens and reused, up to ``keep`` words. New pre-tokens are merged many at a time: with blanks
    between them, each ends with an id of a word end. Texts with characters outside the plain set, or
    with a special token's string in them, go through the tokenizer whole.
    """

    def __init__(self, path: str, keep: int = 500_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # The same merges for pre-tokens that are normalised and set apart by blanks already.
        self._merger = Tokenizer.from_file(path)
        self._merger.normalizer = normalizers.Sequence([])
        self._merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._keep = keep
        self._words = _Lookup()
        self._tokens: dict[str, bytes] = {}
        self._specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _plain(self, text: str) -> bool:
        try:
            other = text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            return False
        return not other and not any(s in text for s in self._specials)

    def _learn(self) -> None:
        """Fill the places of the missed words."""
        split = [(place, _pretokens(word)) for word, place in self._words.missed.items()]
        known = self._tokens
        new = list({t for _, found in split for t in found if t not in known})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            ids = np.asarray(self._merger.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            if len(cuts) == len(part):
                raw = ids.tobytes()
                known.update(zip(part, [raw[s:e] for s, e in zip([0, *cuts], cuts, strict=False)], strict=True))
            else:
                known.update((t, self.whole(t)) for t in part)
        for place, found in split:
            for t in found:
                place += known[t]
        self._words.missed.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self._words, self._tokens):
            if len(known) > self._keep:
                known.clear()
        look = self._words.__getitem__
        parts = [list(map(look, text.lower().split())) if self._plain(text) else [self.whole(text)] for text in texts]
        self._learn()
        return [b"".join(p) for p in parts]


@lru_cache(maxsize=2)
def codec_of(path: str) -> WordCodec:
    """One codec per tokenizer file and Python worker, so that later tasks start with its words."""
    return WordCodec(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """PIECES of ``docs(doc_id, text)``: its ids, then ``end_id``, cut every ``capacity`` tokens."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(tokenizer_path)
        for batch in batches:
            for some in batches_by_size(batch):
                rows = []
                encoded = codec.encode([t or "" for t in some["text"].tolist()])
                for doc, ids in zip(some["doc_id"].tolist(), encoded, strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first number, pieces, first sequence, pieces per sequence, offset).

    Pieces numbered ``first .. first + pieces - 1`` of that length go, ``per`` at a time, to
    consecutive sequences from ``first sequence`` on, from ``offset`` on in each.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    groups: list[tuple[int, list[tuple[int, int, int, int]]]] = []  # (sequences, [(length, first, per, offset)])
    gaps: dict[int, list[int]] = {}

    def take(length: int, n: int) -> int:
        first = used[length]
        used[length] += n
        left[length] -= n
        return first

    def add(room: int, n: int, parts: list) -> None:
        groups.append((n, parts))
        if room not in gaps:
            bisect.insort(open_gaps, room)
            gaps[room] = []
        gaps[room].append(len(groups) - 1)

    open_gaps: list[int] = []
    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            fits = bisect.bisect_right(large, capacity - length)
            mate = next((large[i] for i in range(fits - 1, -1, -1) if left[large[i]] > (large[i] == length)), None)
            if mate is None:
                n = left[length]
                add(capacity - length, n, [(length, take(length, n), 1, 0)])
            elif mate == length:
                n = left[length] // 2
                add(capacity - 2 * length, n, [(length, take(length, 2 * n), 2, 0)])
            else:
                n = min(left[length], left[mate])
                first = take(length, n)
                add(capacity - length - mate, n, [(length, first, 1, 0), (mate, take(mate, n), 1, length)])

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                per = capacity // length
                n, rest = divmod(left[length], per)
                if n:
                    add(capacity - per * length, n, [(length, take(length, n * per), per, 0)])
                if rest:
                    add(capacity - rest * length, 1, [(length, take(length, rest), rest, 0)])
                continue
            room = open_gaps[at]
            index = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
                open_gaps.pop(at)
            n, parts = groups[index]
            per = room // length
            full, rest = divmod(left[length], per)
            pieces = [(min(full, n), per)] if full else []
            if full < n and rest:
                pieces.append((1, rest))
            done = 0
            for m, q in pieces:
                own = [(ln, f + done * p, p, o) for ln, f, p, o in parts]
                add(room - q * length, m, [*own, (length, take(length, m * q), q, capacity - room)])
                done += m
            groups[index] = (0, [])
            if done < n:
                add(room, n - done, [(ln, f + done * p, p, o) for ln, f, p, o in parts])

    slots, base = [], 0
    for n, parts in groups:
        slots += [(length, first, n * per, base, per, offset) for length, first, per, offset in parts if n]
        base += n
    return slots


def pack(pieces: DataFrame, capacity: int = 4096, bucket: int = BUCKET) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (written once, so that tokens are not made twice)."""
    kept = materialize(pieces)
    buckets = max(64, -(-kept.count() // bucket))
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    # (length, bucket) counts: at most one row a piece, and capacity x buckets rows.
    counts = kept.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = sorted(plan(histogram, capacity))
    table = np.array(slots, dtype=np.int64).reshape(-1, 6)
    shared = kept.sparkSession.sparkContext.broadcast(table)

    numbered = (
        kept.withColumn("k", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")))
        .join(offsets, ["length", "bucket"])
        .withColumn("number", F.col("before") + F.col("k") - 1)
        .select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        key = t[:, 0] * (1 << 50) + t[:, 1]
        for batch in batches:
            number = batch.pop("number").to_numpy(dtype=np.int64)
            length = batch["length"].to_numpy(dtype=np.int64)
            slot = t[np.searchsorted(key, length * (1 << 50) + number, side="right") - 1]
            nth, within = np.divmod(number - slot[:, 1], slot[:, 4])
            batch["sequence_id"] = slot[:, 3] + nth
            batch["offset"] = slot[:, 5] + within * length
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch

    return numbered.mapInPandas(place, PIECES + ", sequence_id long, offset long")
