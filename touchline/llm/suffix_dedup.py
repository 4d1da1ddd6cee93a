"""Exact-substring dedup by distributed prefix doubling over a sparse suffix array.

Removes every byte covered by a ``LENGTH``-byte string that also starts in a document with a
smaller id. Every position has a rank for its prefix of 1 byte; the rank of a prefix twice as long is
that of the pair (rank here, rank at the offset by which it grows): 2, 4, 8, 16 bytes, ``HALF`` (two
overlapping prefixes of 16), and ``LENGTH``. Up to ``HALF`` bytes ranks are made where the text is; from
there on Spark brings (rank, position) pairs together in ranges of rank, where they are sorted; positions
whose rank is unique drop out, the rest go on with the longer prefix, until the threshold:

1. *Round HALF.* Of the ``HALF``-byte prefixes that start in a ``LENGTH``-byte window, the one of least
   rank stands for the window. Equal windows choose equal places, so only the chosen places, about one
   in thirteen, are dealt and sorted. Unique ranks: no window there repeats.
2. *Both sides.* The rank is paired with the ranks ``HALF`` bytes before and after (the surroundings
   that any window of that place can reach). Equal pairs settle all windows of a place at once: all
   but the smallest document's are repeats. A rank with a single surrounding is then done.
3. *Round LENGTH.* Only places of equal rank but different surroundings (where a match begins or
   ends) go on: their windows get the rank of two ranks ``HALF`` bytes apart and are dealt and sorted
   again, and the smallest document of each rank keeps its window.

A rank is a 64-bit name of its pair rather than a dense number, so equal prefixes have equal ranks
everywhere without a renumbering of all positions; pairs are compared by two ranks, 96 bits and more, so
unequal strings of one rank are not to be expected at any corpus size.

Scale. Texts are packed once into compressed chunks in the shared folder; nothing else holds text. A
longer document is cut into pieces, each with the windows that begin in it, and put together at the end.
A chunk settles what it can by itself (of copies inside it, one asks), so a string that a third of
all documents share is asked about once per chunk, not per document. Questions are dealt by rank
into buckets of bounded size, answers return to their chunk. Each step is written, and its shuffle files go.

Null text is empty; documents with a null id neither lose bytes nor count as smaller. Documents
of equal id do not remove each other's bytes; each row gets a result. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialize, mix64

LENGTH = 50
HALF = 25
#: Bytes of text in a chunk, and in a piece of a longer document.
CHUNK = 1_500_000
#: Bytes of text whose questions share a bucket: about a million sampled places.
BUCKET = 10_000_000
LEAST_BUCKETS = 64
_LOW = np.uint64(0xFFFFFFFF)

#: Bytes at the end of a piece that the next one begins with, so that each window lies in one piece.
_SHARED = LENGTH - 1
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def pieces_of(raw: bytes, most: int) -> list[tuple[int, int]]:
    """(begin, end) of the pieces of a text; all but the last share their last bytes with the next."""
    cuts = range(most, len(raw) - _SHARED, most)
    return [(at, end + _SHARED if end < len(raw) else end) for at, end in zip((0, *cuts), (*cuts, len(raw)), strict=True)]


def make_chunks(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """(chunk, size, blob): pieces of documents ordered by id within a chunk, as _HEAD columns and bytes."""
    most = max(chunk_bytes, LENGTH)

    def packed(key: int, rows: list[tuple]) -> tuple[int, int, bytes]:
        rows.sort(key=lambda r: (r[1], r[0], r[2], r[3]))
        head = np.array([(*r[:-1], len(r[-1])) for r in rows], dtype="<i8").reshape(-1, len(_HEAD)).T
        raw = np.int64(len(rows)).tobytes() + np.ascontiguousarray(head).tobytes() + b"".join(r[-1] for r in rows)
        return key, int(head[-1].sum()), zstandard.ZstdCompressor(level=3).compress(raw)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, made = TaskContext.get().partitionId() << 32, 0
        rows: list[tuple] = []
        held = number = 0
        for batch in batches:
            for doc, null, text in zip(batch["doc_id"].tolist(), batch["null"].tolist(), batch["text"].tolist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                cut = pieces_of(raw, most)
                for k, (s, e) in enumerate(cut):
                    if rows and held + e - s > chunk_bytes:
                        yield pd.DataFrame([packed(base + made, rows)], columns=["chunk", "size", "blob"])
                        made, rows, held = made + 1, [], 0
                    rows.append((int(doc), int(null), base + number, k if len(cut) > 1 else -1, int(k == len(cut) - 1), raw[s:e]))
                    held += e - s
                number += 1
        if rows:
            yield pd.DataFrame([packed(base + made, rows)], columns=["chunk", "size", "blob"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("null"), "text")
    return rows.mapInPandas(run, "chunk long, size long, blob binary")


#: Of each piece in a chunk: its document's id (0 for null), whether that is null, the number of its row, its place in the document (-1: all of it), whether it is the last, its bytes.
_HEAD = ("ids", "nulls", "rows", "pieces", "lasts", "sizes")


class Chunk:
    """A chunk's documents and the ranks of its places."""

    def __init__(self, blob: bytes):
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
        self.ids, self.nulls, self.rows, self.pieces, self.lasts, self.sizes = (np.frombuffer(raw, dtype="<i8", count=n, offset=8 + 8 * n * k) for k in range(len(_HEAD)))
        self.data = np.frombuffer(raw, dtype=np.uint8, offset=8 + 8 * len(_HEAD) * n)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def sample(self) -> None:
        """Chosen places with their windows; ranks and surroundings of the places."""
        n = len(self.data)
        with np.errstate(over="ignore"):
            windows = n - LENGTH + 1
            if windows <= 0:
                self.places = self.doc = np.zeros(0, dtype=np.int64)
                self.low = self.high = self.places
                self.rank = self.around = self.ranks = np.zeros(0, dtype=np.uint64)
                return
            self.ranks = rank = doubled(self.data, HALF)
            key = (rank & ~_LOW) | np.arange(len(rank), dtype=np.uint64)
            width = LENGTH - HALF + 1
            least, reach = key, 1
            while reach * 2 <= width:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            if reach < width:
                least = np.minimum(least[: len(key) - width + 1], least[width - reach :][: len(key) - width + 1])
            chosen = (least & _LOW).astype(np.int64)
            inside = np.zeros(windows, dtype=bool)
            for s, e, null in zip(self.starts.tolist(), self.ends.tolist(), self.nulls.tolist(), strict=True):
                if not null and e - s >= LENGTH:
                    inside[s : e - LENGTH + 1] = True
            starts = np.flatnonzero(inside)
            chosen = chosen[starts]
            new = np.concatenate(([True], chosen[1:] != chosen[:-1])) if len(chosen) else np.zeros(0, dtype=bool)
            first = np.flatnonzero(new)
            self.places = chosen[first]
            self.low = starts[first]
            self.high = starts[np.append(first[1:], len(starts)) - 1] if len(first) else starts
            self.doc = np.searchsorted(self.ends, self.places, side="right")
            # Chosen ranks are small ones; spread again, they fall evenly into ranges.
            self.rank = _spread(rank[self.places] * np.uint64(0x94D049BB133111EB))
            s = np.maximum(self.places - HALF, self.starts[self.doc])
            e = np.minimum(self.places + 2 * HALF, self.ends[self.doc])
            # Where a document's end cuts the surroundings off, the rank there reaches into the place's own bytes.
            cut = ((self.places - s) * 64 + (e - self.places)).astype(np.uint64)
            self.around = paired(paired(rank[s], rank[e - HALF]), cut)

    def whole(self, at: np.ndarray) -> np.ndarray:
        """Rank of the LENGTH bytes from each place."""
        return paired(self.ranks[at], self.ranks[at + HALF])

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """(class of each place by rank and surroundings, first place of each class).

        Places are in document order, so a class's first place lies in its smallest document here.
        """
        order = np.lexsort((np.arange(len(self.rank)), self.around, self.rank))
        r, a = self.rank[order], self.around[order]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (a[1:] != a[:-1]))) if len(r) else np.zeros(0, dtype=bool)
        number = np.empty(len(r), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return number, order[new]

    def windows_of(self, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of every window of the picked places, its document)."""
        n = self.high[picked] - self.low[picked] + 1
        at = np.repeat(self.low[picked] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return at, np.repeat(self.doc[picked], n)


_BYTE = mix64(np.arange(256, dtype=np.uint64), seed=17)


def paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rank of pairs of ranks."""
    with np.errstate(over="ignore"):
        return _spread(x * np.uint64(0x9E3779B97F4A7C15) + _spread(y))


def doubled(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from every position that has as many, by prefix doubling."""
    rank, reach = _BYTE[data], 1
    with np.errstate(over="ignore"):
        while reach < length:
            offset = min(reach, length - reach)
            # Linear with an odd factor of its own in each round; spread once, at the end.
            factor = mix64(np.array([reach], dtype=np.uint64), seed=19) | np.uint64(1)
            rank, reach = rank[: len(rank) - offset] + rank[offset:] * factor, reach + offset
    return _spread(rank)


def _spread(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compresses small differences to their low bytes."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplaned(raw: bytes, dtype: type, n: int, at: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(raw, dtype=np.uint8, count=width * n, offset=at).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def _questions(chunk: int, buckets: int, rank: np.ndarray, extra: np.ndarray, doc: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows (bucket, chunk, first, n, blob) of one chunk's questions, in order of rank, dealt by ranges of rank.

    A question's token is its place in that order, so it need not be sent; ranks go as differences.
    """
    own = ((rank >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.searchsorted(own, np.arange(buckets + 1))
    least = int(doc.min()) if len(doc) else 0
    away = (doc - least).astype(np.uint64)
    pack = zstandard.ZstdCompressor(level=1)
    rows = []
    for b in range(buckets):
        s, e = int(cuts[b]), int(cuts[b + 1])
        if e > s:
            steps = np.diff(rank[s:e], prepend=np.uint64(0))
            blob = np.int64(least).tobytes() + _planes(steps) + _planes(extra[s:e]) + _planes(away[s:e])
            rows.append((b, chunk, s, e - s, pack.compress(blob)))
    yield pd.DataFrame(rows, columns=["bucket", "chunk", "first", "n", "blob"])


_QUESTION = "bucket int, chunk long, first long, n long, blob binary"


def _by_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, ...]]:
    """(chunk, rank, extra, token, doc) arrays of one bucket after another; the input is sorted by bucket."""

    def joined(rows: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, ...]:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for chunk, first, n, blob in rows:
            raw = zstandard.ZstdDecompressor().decompress(blob)
            least = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
            parts[0].append(np.full(n, chunk, dtype=np.int64))
            parts[1].append(np.cumsum(_unplaned(raw, np.uint64, n, 8)))
            parts[2].append(_unplaned(raw, np.uint64, n, 8 + 8 * n))
            parts[3].append(np.arange(first, first + n, dtype=np.uint32))
            parts[4].append(_unplaned(raw, np.uint64, n, 8 + 16 * n).astype(np.int64) + least)
        return tuple(np.concatenate(p) for p in parts)

    now, rows = None, []
    for batch in batches:
        columns = (batch[c].tolist() for c in ("bucket", "chunk", "first", "n", "blob"))
        for b, chunk, first, n, blob in zip(*columns, strict=True):
            if b != now and rows:
                yield joined(rows)
                rows = []
            now = b
            rows.append((chunk, first, n, blob))
    if rows:
        yield joined(rows)


def _answers(chunk: np.ndarray, token: np.ndarray, kind: np.ndarray) -> pd.DataFrame:
    """Rows (chunk, kind, tokens) of the questions with an answer (kind > 0)."""
    order = np.lexsort((token, kind, chunk))
    order = order[kind[order] > 0]
    c, k, t = chunk[order], kind[order], token[order].astype("<u4")
    if not len(c):
        return pd.DataFrame({"chunk": pd.Series(dtype="int64"), "kind": pd.Series(dtype="int32"), "tokens": pd.Series(dtype="object")})
    first = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (k[1:] != k[:-1]))))
    ends = np.append(first[1:], len(c))
    return pd.DataFrame({"chunk": c[first], "kind": k[first].astype(np.int32), "tokens": [t[s:e].tobytes() for s, e in zip(first, ends, strict=True)]})


def _settle(mixed: bool):
    """Answers of a bucket: 1, a smaller document holds the string; 2 (if ``mixed``), go on with whole windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk, rank, extra, token, doc in _by_bucket(batches):
            order = np.lexsort((doc, extra, rank))
            r, x, d = rank[order], extra[order], doc[order]
            new_r = np.concatenate(([True], r[1:] != r[:-1]))
            new_x = new_r | np.concatenate(([True], x[1:] != x[:-1]))
            first = np.flatnonzero(new_x)
            least = np.repeat(d[first], np.diff(np.append(first, len(d))))
            kind = np.where(d > least, 1, 0)
            if mixed:
                group = np.flatnonzero(new_r)
                size = np.diff(np.append(group, len(r)))
                several = np.repeat(np.add.reduceat(new_x.astype(np.int64), group) > 1, size)
                spread = np.repeat(np.minimum.reduceat(d, group) < np.maximum.reduceat(d, group), size)
                kind = np.where((kind == 0) & several & spread, 2, kind)
            yield _answers(chunk[order], token[order], kind)

    return run


def _told(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with their answers: tokens of kind 1 and 2 as lists of binaries."""
    per = answers.groupBy("chunk").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("tokens"))).alias("gone"), F.collect_list(F.when(F.col("kind") == 2, F.col("tokens"))).alias("open"),
        F.collect_list(F.when(F.col("kind") == 3, F.col("tokens"))).alias("whole"),
    )
    return chunks.join(per, "chunk", "left").select("chunk", "blob", "gone", "open", "whole")


def _tokens(cell) -> np.ndarray:
    return np.frombuffer(b"".join(cell) if cell is not None else b"", dtype="<u4").astype(np.int64)


def _open_windows(c: Chunk, number: np.ndarray, first: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, documents, ranks) of the windows of open classes, in the class's first document."""
    is_open = np.zeros(len(first), dtype=bool)
    is_open[open_] = True
    home = c.ids[c.doc[first]][number] if len(first) else c.doc
    picked = np.flatnonzero(is_open[number] & (c.ids[c.doc] == home)) if len(first) else number
    at, doc = c.windows_of(picked)
    return at, doc, c.whole(at) if len(at) else np.zeros(0, dtype=np.uint64)


def _window_classes(c: Chunk, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each window by rank, first window of each class), first by place and so by document."""
    order = np.lexsort((at, w))
    new = np.concatenate(([True], w[order][1:] != w[order][:-1])) if len(w) else np.zeros(0, dtype=bool)
    number = np.empty(len(w), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """RESULT rows, one per row of ``docs(doc_id, text)``: what is removed and the digest of what is kept."""
    chunks = materialize(make_chunks(docs, chunk_bytes))
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, blob in zip(batch["chunk"].tolist(), batch["blob"].tolist(), strict=True):
                c = Chunk(blob)
                c.sample()
                _, first = c.classes()
                yield from _questions(key, buckets, c.rank[first], c.around[first], c.ids[c.doc[first]])

    def dealt(questions: DataFrame, mixed: bool) -> DataFrame:
        return materialize(questions.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(_settle(mixed), "chunk long, kind int, tokens binary"))

    places = dealt(chunks.mapInPandas(ask, _QUESTION), True)

    def ask_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, blob, open_ in zip(batch["chunk"].tolist(), batch["blob"].tolist(), batch["open"].tolist(), strict=True):
                if open_ is None or not len(open_):
                    continue
                c = Chunk(blob)
                c.sample()
                at, doc, w = _open_windows(c, *c.classes(), _tokens(open_))
                _, first = _window_classes(c, at, w)
                yield from _questions(key, buckets, w[first], c.ranks[at[first]] & _LOW, c.ids[doc[first]])

    windows = dealt(_told(chunks, places).mapInPandas(ask_windows, _QUESTION), False)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob, gone, open_, whole in zip(batch["blob"].tolist(), batch["gone"].tolist(), batch["open"].tolist(), batch["whole"].tolist(), strict=True):
                yield _result(Chunk(blob), _tokens(gone), _tokens(open_), _tokens(whole))

    answers = places.union(windows.select("chunk", F.lit(3).alias("kind"), "tokens"))
    done = materialize(_told(chunks, answers).mapInPandas(finish, _FINISHED))
    cut = done.filter("piece >= 0").repartition("row").sortWithinPartitions("row", "piece").mapInPandas(_joined, RESULT)
    return done.filter("piece < 0").select(*cut.columns).union(cut)


def _result(c: Chunk, gone: np.ndarray, open_: np.ndarray, whole: np.ndarray) -> pd.DataFrame:
    """Cover the removed windows of one chunk and describe each document."""
    c.sample()
    cover = np.zeros(len(c.data) + LENGTH + 1, dtype=np.int32)
    number, first = c.classes()
    if len(first):
        lost = np.zeros(len(first), dtype=bool)
        lost[gone] = True
        home = c.ids[c.doc[first]]
        away = lost[number] | (c.ids[c.doc] > home[number])
        np.add.at(cover, c.low[away], 1)
        np.add.at(cover, c.high[away] + LENGTH, -1)
        at, doc, w = _open_windows(c, number, first, open_)
        if len(at):
            own, top = _window_classes(c, at, w)
            lost = np.zeros(len(top), dtype=bool)
            lost[whole] = True
            away = lost[own] | (c.ids[doc] > c.ids[doc[top]][own])
            np.add.at(cover, at[away], 1)
            np.add.at(cover, at[away] + LENGTH, -1)
    removed = np.cumsum(cover[: len(c.data)]) > 0
    rows = []
    for doc, null, row, piece, last, s, e in zip(*(x.tolist() for x in (c.ids, c.nulls, c.rows, c.pieces, c.lasts, c.starts, c.ends)), strict=True):
        mask, text = removed[s:e], c.data[s:e]
        if piece >= 0:
            own = len(text) if last else len(text) - _SHARED
            rows.append((None if null else doc, 0, 0, 0, "", [], row, piece, text[:own].tobytes(), mask.tobytes()))
            continue
        spans = _spans(mask)
        digest = hashlib.sha256((text[~mask] if spans else text).tobytes()).hexdigest()
        rows.append((None if null else doc, e - s, int(mask.sum()), len(spans), digest, [{"start": a, "end": b} for a, b in spans], row, piece, None, None))
    out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "row", "piece", "own", "gone"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


_FINISHED = RESULT + ", row long, piece int, own binary, gone binary"


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of set places."""
    change = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in zip(change[0::2], change[1::2], strict=True)]


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """RESULT rows of the documents whose pieces come in order; a piece at a time is held."""
    now, doc, digest, n, lost, spans, carried = None, None, None, 0, 0, [], None

    def done() -> pd.DataFrame:
        out = pd.DataFrame([(doc, n, lost, len(spans), digest.hexdigest(), [{"start": a, "end": b} for a, b in spans])], columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    for batch in batches:
        ids = batch["doc_id"].astype("Int64").tolist()
        for d, row, own, gone in zip(ids, batch["row"].tolist(), batch["own"].tolist(), batch["gone"].tolist(), strict=True):
            if row != now:
                if now is not None:
                    yield done()
                now, doc, digest, n, lost, spans, carried = row, None if pd.isna(d) else int(d), hashlib.sha256(), 0, 0, [], np.zeros(_SHARED, dtype=bool)
            mask = np.frombuffer(gone, dtype=bool).copy()
            mask[: len(carried)] |= carried[: len(mask)]
            text, mine, carried = np.frombuffer(own, dtype=np.uint8), mask[: len(own)], mask[len(own) :]
            digest.update(text[~mine].tobytes())
            for a, b in _spans(mine):
                if spans and spans[-1][1] == n + a:
                    spans[-1] = (spans[-1][0], n + b)
                else:
                    spans.append((n + a, n + b))
            n, lost = n + len(own), lost + int(mine.sum())
    if now is not None:
        yield done()
