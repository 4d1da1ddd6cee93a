"""Who is who: homonyms inside a club, stints, intervals of one name over clubs, ids of events."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.calendar import SUMMER_WINDOW, WINTER_WINDOW
from touchline.functions.labels import is_child, is_senior
from touchline.functions.text import join_key, reversed_words, slug, squish
from touchline.operators.tables import stints

STINT_DAYS = 180
SUMMER_DAYS, OTHER_DAYS = 60, 15


def same_day_clusters(appearances: DataFrame) -> DataFrame:
    """cluster: 1, or the how-manieth appearance of the day, for a (name, team) that ever appears twice in one match.

    Conflicts are those of one day, so first-fit puts the k-th appearance of a day into cluster k.
    """
    per_match = Window.partitionBy("name", "team", "match_id", "match_date")
    rows = appearances.withColumn("_n", F.count("*").over(per_match))
    rows = rows.withColumn("_twice", F.max("_n").over(Window.partitionBy("name", "team")) > 1)
    kth = F.row_number().over(Window.partitionBy("name", "team", "match_date").orderBy("ord"))
    return rows.withColumn("cluster", F.when(F.col("_twice") & F.col("team").isNotNull(), kth).otherwise(1)).drop("_n", "_twice")


def split_stints(appearances: DataFrame, days: int = STINT_DAYS) -> DataFrame:
    """cluster becomes cluster * 1000 + stint; a stint ends where more than ``days`` pass."""
    gap = F.datediff(F.col("match_date"), F.col("_previous")) > days
    rows = stints(appearances, ["name", "team", "cluster"], "match_date", "ord", gap)
    return rows.withColumn("cluster", (F.col("cluster") * 1000 + F.col("stint")).cast("int")).drop("stint")


def intervals(appearances: DataFrame) -> DataFrame:
    """(name, team, cluster): first and last date, any senior, any child category."""
    return appearances.filter("match_date is not null and team is not null").groupBy("name", "team", "cluster").agg(
        F.min("match_date").alias("first"), F.max("match_date").alias("last"), F.bool_or(is_senior(F.col("category"))).alias("senior"), F.bool_or(is_child(F.col("category"))).alias("child")
    )


def _compatible(group: list[dict], row: dict) -> bool:
    """Whether an interval may belong to the person of a group."""
    if (row["senior"] or any(g["senior"] for g in group)) and (row["child"] or any(g["child"] for g in group)):
        return False
    for g in group:
        late, early = max(row["first"], g["first"]), min(row["last"], g["last"])
        gap = (late - early).days
        limit = SUMMER_DAYS if late.month in (6, 7) or early.month in (6, 7) else OTHER_DAYS
        window = late.month in SUMMER_WINDOW or early.month in SUMMER_WINDOW or (late.month in WINTER_WINDOW and early.month in WINTER_WINDOW)
        if gap <= limit and not (gap > 0 and window):
            return False
    return True


def persons(spans: DataFrame) -> DataFrame:
    """Give each interval of a name a person number: by first date, the first group without a conflict.

    First fit is sequential, so names with several intervals go to Python, one name at a time; names
    with one interval are done natively. A name's intervals are few (clubs x stints).
    """
    counted = spans.withColumn("_n", F.count("*").over(Window.partitionBy("name")))
    one = counted.filter("_n = 1").select("name", "team", "cluster", F.lit(1).alias("person"), F.lit(False).alias("homonym"))

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        groups: list[list[dict]] = []
        rows = pdf.sort_values(["first", "team", "cluster"]).to_dict("records")
        for row in rows:
            place = next((i for i, g in enumerate(groups) if _compatible(g, row)), None)
            if place is None:
                groups.append([])
                place = len(groups) - 1
            groups[place].append(row)
            row["person"] = place + 1
        out = pd.DataFrame(rows)[["name", "team", "cluster", "person"]]
        return out.assign(homonym=len(groups) > 1)

    several = counted.filter("_n > 1").drop("_n").groupBy("name").applyInPandas(assign, "name string, team string, cluster int, person int, homonym boolean")
    return one.union(several)


def with_ids(appearances: DataFrame, assigned: DataFrame, english: DataFrame | None = None) -> DataFrame:
    """player_id: slug of the name, with the person number for homonyms.

    ``english(name, english)`` gives the slug of another spelling; its names also match with their
    words in reverse order. Rows without an interval get the plain slug.
    """
    rows = appearances.join(assigned, ["name", "team", "cluster"], "left")
    base = slug(F.col("name"))
    if english is not None:
        keys = english.select(F.col("name").alias("_name"), "english", F.lit(0).alias("_p")).union(english.select(reversed_words(F.trim("name")), "english", F.lit(1)))
        names = keys.groupBy("_name").agg(F.min_by("english", F.struct("_p", "english")).alias("_en"))
        rows = rows.join(names, rows["name"] == names["_name"], "left").drop("_name")
        base = F.coalesce(slug(F.col("_en")), base)
    number = F.when(F.col("homonym"), F.concat(F.lit("_"), F.col("person").cast("string"))).otherwise("")
    out = rows.withColumn("player_id", F.concat(base, F.coalesce(number, F.lit(""))))
    return out.drop("person", "homonym", "_en")


def resolve_players(appearances: DataFrame, english: DataFrame | None = None) -> DataFrame:
    """All steps for ``appearances(name, team, match_id, match_date, category, ord, ...)``; names of two letters or less go."""
    named = appearances.filter(F.length(F.trim("name")) > 2)
    clustered = split_stints(same_day_clusters(named))
    return with_ids(clustered, persons(intervals(clustered)), english)


def event_ids(events: DataFrame, appearances: DataFrame) -> DataFrame:
    """player_id of events(match_id, name, team, shirt): by name and team, then by match, team and shirt,
    then by the name or the shirt where that is unique in the match, then the name's slug.

    A name and team with two ids gives two rows (as a plain join does).
    """
    a = appearances.withColumns({"_name": squish(F.col("name")), "_team": squish(F.col("team"))})
    known = a.filter("_name <> '' and _team <> ''")
    by_name = known.select("_name", "_team", F.col("player_id").alias("_1")).distinct()
    by_shirt = known.filter("match_id is not null and shirt is not null").select("match_id", "_team", "shirt", F.col("player_id").alias("_2")).distinct()

    def unique(keys: list[str], name: str) -> DataFrame:
        return a.filter(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min("player_id").alias(name), F.max("player_id").alias("_max")).filter(f"{name} = _max").drop("_max")

    e = events.withColumns({"_name": squish(F.col("name")), "_team": squish(F.col("team"))})
    e = e.join(by_name, ["_name", "_team"], "left").join(by_shirt, ["match_id", "_team", "shirt"], "left")
    e = e.join(unique(["match_id", "_name"], "_3"), ["match_id", "_name"], "left").join(unique(["match_id", "shirt"], "_4"), ["match_id", "shirt"], "left")
    return e.withColumn("player_id", F.coalesce("_1", "_2", "_3", "_4", slug(F.col("name")))).drop("_name", "_team", "_1", "_2", "_3", "_4")


def _place(rows: DataFrame, *columns: str) -> Column:
    """The row's ``ord`` where there is one, then its values: a total order that no partitioning changes."""
    return F.struct(*(["ord"] if "ord" in rows.columns else []), *columns)


def apply_conversions(rows: DataFrame, column: str, conversions: DataFrame) -> DataFrame:
    """Replace names by ``conversions(original, corrected[, ord])`` on squished lower-case keys; the first row of a key by ``ord`` counts."""
    first = F.min_by("corrected", _place(conversions, "original", "corrected"))
    once = conversions.withColumn("_k", join_key(F.col("original"))).groupBy("_k").agg(first.alias("_to"))
    return rows.withColumn("_k", join_key(F.col(column))).join(once, "_k", "left").withColumn(column, F.coalesce("_to", column)).drop("_k", "_to")


def unify(rows: DataFrame, unification: DataFrame) -> DataFrame:
    """Replace name and player_id of names listed in ``unification(wrong, right, right_id[, ord])``; the first row of a name by ``ord`` counts."""
    first = F.min_by(F.struct("right", "right_id"), _place(unification, "right", "right_id"))
    u = unification.groupBy("wrong").agg(first.alias("_u"))
    joined = rows.join(u, rows["name"] == u["wrong"], "left")
    return joined.withColumns({"name": F.coalesce("_u.right", "name"), "player_id": F.coalesce("_u.right_id", "player_id")}).drop("wrong", "_u")


def spread_base_ids(bio: DataFrame, appearances: DataFrame) -> DataFrame:
    """Bio rows by base id go to every final id minted from it (base or base_k)."""
    finals = appearances.select("player_id").distinct().withColumn("base_id", F.regexp_replace("player_id", r"_\d+$", ""))
    return bio.withColumnRenamed("player_id", "base_id").join(finals, "base_id", "left").withColumn("player_id", F.coalesce("player_id", "base_id")).drop("base_id")
