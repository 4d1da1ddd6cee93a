"""Facts of raw web pages by native expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_facts(pages: DataFrame) -> DataFrame:
    """(page_id, title, links): the title and the number of links of the first ``nav``."""
    nav = F.regexp_extract("html", r"(?s)<nav>(.*?)</nav>", 1)
    return pages.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"), F.regexp_count(nav, F.lit('<a href="[^"]*"')).cast("long").alias("links"))
