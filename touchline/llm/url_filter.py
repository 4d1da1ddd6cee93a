"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join (DataFrame functions only).

Semantics. Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
A-Z lower-cased; path: from there up to ``?``, ``#`` or the end. A null url or one without
``://`` has empty host and path. A listed entry (host, path, verdict) fits its host and all
subdomains where the url's path starts with the entry's path; the longest entry wins (ties:
the later in text order). Urls that no entry fits get ``default``.

Repeated rows stay repeated; extra columns of the input are not looked at, whatever their
names; an empty input or an empty list gives the obvious result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import skewed_join

#: The filter has BLOCKS blocks of eight 8-byte words, one bit of each word per entry: 64 bytes
#: a block, 1 MiB in all at the default. Its size is fixed by this parameter, not by the data.
BLOCKS = 1 << 14
WORDS = 8

#: A list whose keys and rules take no more than this is broadcast; a longer one is shuffled.
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    """Host of a url, ASCII lower-cased; empty where there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column, most: int) -> Column:
    """The host itself and every parent domain, as far as they have at most ``most`` labels: a.b.c gives [a.b.c, b.c, c]."""
    parts = F.split(host, r"\.", -1)
    first = F.greatest(F.lit(1), F.size(parts) - most + 1)
    return F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.lit(most)), "."))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """Eight words with one bit each, chosen by successive 6-bit pieces of a second hash."""
    second = F.xxhash64(key, F.lit("mask"))
    return F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)),
        lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftrightunsigned", second, i * 6).bitwiseAND(F.lit(63)).cast("int")),
    )


def bloom_blocks(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, words): the filter of the keys ``k`` in ``listed``, at most ``blocks`` rows."""
    keyed = listed.select(_block(F.col("k"), blocks).alias("block"), _mask(F.col("k")).alias("m"))
    words = keyed.groupBy("block").agg(*[F.bit_or(F.col("m")[i]).alias(f"w{i}") for i in range(WORDS)])
    return words.select("block", F.array(*[f"w{i}" for i in range(WORDS)]).alias("words"))


def judge_urls(pages: DataFrame, listed: DataFrame, default: str = "allow", blocks: int = BLOCKS) -> DataFrame:
    """Judge ``pages(page_id, url)`` by ``listed(host, path, verdict)``.

    Returns page_id, url, host, path, rule (``host + path`` of the entry that won, else null)
    and verdict. Lookup keys are every (host suffix, path prefix) of a url, with prefixes only
    of the lengths that occur in the list. The filter's blocks are broadcast (size fixed by
    ``blocks``); keys that pass are joined with the list by an ordinary equi-join, which drops
    false positives, so the result does not depend on the filter's size.
    """
    entries = (
        listed.select(F.lower("host").alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
        .withColumn("k", F.concat_ws("\n", "h", "p"))
        .groupBy("k")
        .agg(F.max(F.struct("verdict", "h", "p")).alias("e"))
        .select("k", F.col("e.verdict").alias("verdict"), F.concat("e.h", "e.p").alias("rule"))
    )
    lengths = sorted(r[0] for r in listed.select(F.length(F.coalesce("path", F.lit("")))).distinct().collect())
    # No entry fits a suffix of more labels than any listed host has, however many a url's host has.
    most = listed.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1

    rows = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    prefixes = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    paths = F.array_compact(F.array(*prefixes)) if prefixes else F.array().cast("array<string>")
    keys = F.flatten(
        F.transform(host_suffixes(F.col("host"), most), lambda h: F.transform(paths, lambda p: F.concat_ws("\n", h, p)))
    )
    # One row per key plus a keyless row that keeps every page, hit or not.
    probes = rows.withColumn("k", F.explode(F.concat(F.array(F.lit(None).cast("string")), keys)))
    filtered = (
        probes.withColumn("block", _block(F.coalesce("k", F.lit("")), blocks))
        .join(F.broadcast(bloom_blocks(entries, blocks)), "block", "left")
        .filter(
            F.col("k").isNull()
            | (
                F.col("words").isNotNull()
                & F.forall(F.zip_with("words", _mask(F.col("k")), lambda w, m: w.bitwiseAND(m) == m), lambda ok: ok)
            )
        )
        .select("page_id", "url", "host", "path", "k")
    )
    keyless = filtered.filter("k is null").select(
        "page_id", "url", "host", "path", F.lit(None).cast("struct<n int,rule string,verdict string>").alias("b")
    )
    hits = _exact(filtered.filter("k is not null"), entries).select(
        "page_id", "url", "host", "path", F.struct(F.length("rule").alias("n"), "rule", "verdict").alias("b")
    )
    # Each keyless row stands for one input row; equal rows are counted and given back.
    judged = (
        keyless.withColumn("one", F.lit(1))
        .unionByName(hits.withColumn("one", F.lit(0)))
        .groupBy("page_id", "url", "host", "path")
        .agg(F.max("b").alias("b"), F.sum("one").cast("int").alias("copies"))
    )
    return judged.select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("b.rule").alias("rule"),
        F.coalesce("b.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")


def _exact(hits: DataFrame, entries: DataFrame) -> DataFrame:
    """Hash join of the keys that passed the filter with the list.

    The list is broadcast only if its own size, counted first, is within ``BROADCAST_BYTES``;
    beyond that it is shuffled, and a hot key's rows are dealt over salts.
    """
    held = entries.agg(F.sum(F.length("k") + F.length("rule") + 64)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        return hits.join(F.broadcast(entries), "k")
    return skewed_join(hits, entries, "k", [F.col("page_id"), F.col("url")])
