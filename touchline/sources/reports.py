"""Parsers of match pages: report, announcement and the officials' JSON answer.

Pages are walked with the standard library's parser (events by class attribute), in one Arrow-fed
pass per table; everything after the parse is native.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.labels import EVENT_CLASSES, mapped
from touchline.functions.minutes import parse_minute

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Nodes(HTMLParser):
    """Collects (depth-first number, tag, classes, text, ancestors' classes) of every element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.all: list[dict] = []

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        node = {"tag": tag, "classes": (found.get("class") or "").split(), "href": found.get("href"), "text": [], "path": [c for n in self.open for c in n["classes"]]}
        self.all.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i]["tag"] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for n in self.open:
            n["text"].append(data)


def elements(page: str | None) -> list[dict]:
    """All elements with squeezed text."""
    parser = _Nodes()
    parser.feed(page or "")
    parser.close()
    for n in parser.all:
        n["text"] = " ".join("".join(n["text"]).split())
    return parser.all


NODES = "key string, n int, tag string, classes array<string>, path array<string>, text string, href string"


def page_nodes(pages: DataFrame, key: str, html: str, classes: list[str] | None = None) -> DataFrame:
    """NODES rows of the elements that carry one of ``classes`` (all that have a class, if None)."""
    wanted = set(classes or ())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, page in zip(batch["key"].tolist(), batch["html"].tolist(), strict=True):
                for i, n in enumerate(elements(page)):
                    if n["classes"] and (not wanted or wanted & set(n["classes"])):
                        rows.append((k, i, n["tag"], n["classes"], n["path"], n["text"], n["href"]))
            yield pd.DataFrame(rows, columns=["key", "n", "tag", "classes", "path", "text", "href"])

    return pages.select(F.col(key).cast("string").alias("key"), F.col(html).alias("html")).mapInPandas(run, NODES)


def report_events(pages: DataFrame, key: str = "match_id", html: str = "html") -> DataFrame:
    """(match_id, n, event, player, shirt, minute) of elements whose last class is a known event.

    Text reads '<shirt> <player> <minute>'; pages that say the match was not played give nothing.
    """
    played = pages.filter(~F.coalesce(F.col(html).rlike("(?iu)не е одигран|not played"), F.lit(False)))
    rows = page_nodes(played, key, html).withColumn("event", mapped(F.element_at("classes", -1), EVENT_CLASSES)).filter("event is not null")
    shape = r"^(?:(\d+)\.?\s+)?(.*?)\s*(\d+(?:\+\d+)?'?)?$"
    return rows.select(
        F.col("key").alias("match_id"), "n", "event",
        F.nullif(F.regexp_extract("text", shape, 2), F.lit("")).alias("player"),
        F.nullif(F.regexp_extract("text", shape, 1), F.lit("")).try_cast("int").alias("shirt"),
        parse_minute(F.nullif(F.regexp_extract("text", shape, 3), F.lit(""))).alias("minute"),
    )


def page_fields(pages: DataFrame, fields: dict[str, str], key: str = "match_id", html: str = "html") -> DataFrame:
    """One row per page: for each {column: class}, the text of the first element of that class, else null."""
    nodes = page_nodes(pages, key, html, list(fields.values()))
    firsts = [F.min_by(F.when(F.array_contains("classes", c), F.nullif("text", F.lit(""))), F.when(F.array_contains("classes", c), F.col("n"))).alias(name) for name, c in fields.items()]
    found = nodes.groupBy("key").agg(*firsts)
    return pages.select(F.col(key).cast("string").alias("key")).distinct().join(found, "key", "left").withColumnRenamed("key", key)


def officials_answers(answers: DataFrame, key: str = "match_id", columns: tuple[str, ...] = ("finished", "played", "scheduled")) -> DataFrame:
    """(match_id, officials) of JSON answers {success, data: html table}: the first successful answer counts.

    Null: no answer at all; an empty array: an answer without rows.
    """
    answer = F.coalesce(*[F.when(F.from_json(c, "success boolean, data string")["success"], F.from_json(c, "success boolean, data string")["data"]) for c in columns])
    rows = answers.select(key, answer.alias("data"))
    cells = F.regexp_extract_all("data", F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))

    def cell(row, i: int):
        found = F.get(F.regexp_extract_all(row, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), F.lit(i))
        return F.trim(F.regexp_replace(F.regexp_replace(found, "<[^>]*>", " "), r"\s+", " "))

    people = F.filter(F.transform(cells, lambda r: F.struct(cell(r, 0).alias("role"), cell(r, 1).alias("name"))), lambda p: p["name"].isNotNull())
    return rows.select(key, people.alias("officials"))
