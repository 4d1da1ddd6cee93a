"""Time on the pitch, goal attribution and what depends on both: keepers and defensive trios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.minutes import base_minute, clamp, ratio
from touchline.operators.tables import numbered, ordering, ranked


def parse_substitutions(texts: DataFrame) -> DataFrame:
    """(match_id, team, minute, shirt_in, shirt_out) of 'Entra X (n) por Y (m)' texts; unparsable rows go."""
    parsed = texts.withColumns(
        {
            "shirt_in": F.nullif(F.regexp_extract("text", r"Entra .*?\((\d+)\)", 1), F.lit("")).try_cast("int"),
            "shirt_out": F.nullif(F.regexp_extract("text", r"por .*?\((\d+)\)", 1), F.lit("")).try_cast("int"),
        }
    )
    return parsed.filter("shirt_in is not null and shirt_out is not null").drop("text")


def minutes_played(lineups: DataFrame, substitutions: DataFrame, durations: DataFrame) -> DataFrame:
    """min_in, min_out, minutes and substituted for ``lineups(match_id, team, shirt, starter, ...)``.

    ``substitutions(match_id, team, ord, minute, shirt_in, shirt_out)`` apply by shirt, the last of
    a shirt counting. Starters are on from 0 to the end, substitutes come on at their minute. Minutes
    keep their stoppage encoding here. A null shirt gets no minutes if its side made any change.
    """
    side = ["match_id", "team"]
    came = substitutions.groupBy(*side, F.col("shirt_in").alias("shirt")).agg(F.max_by("minute", "ord").alias("_in"))
    went = substitutions.groupBy(*side, F.col("shirt_out").alias("shirt")).agg(F.max_by("minute", "ord").alias("_out"))
    changed = substitutions.select(*side).distinct().withColumn("_changed", F.lit(True))
    rows = (
        lineups.join(durations.select("match_id", F.col("duration").alias("_duration")), "match_id", "left")
        .join(came, [*side, "shirt"], "left")
        .join(went, [*side, "shirt"], "left")
        .join(changed, side, "left")
    )
    duration = F.coalesce("_duration", F.lit(90))
    unknown = F.col("_changed") & F.col("shirt").isNull()
    rows = rows.withColumns(
        {
            "duration": duration,
            "min_in": F.when(unknown, None).otherwise(F.coalesce("_in", F.when(F.col("starter"), 0))),
            "_end": F.when(F.col("starter"), duration).otherwise(0),
            "substituted": F.col("_out").isNotNull(),
        }
    )
    rows = rows.withColumn("min_out", F.when(unknown, None).otherwise(F.coalesce("_out", "_end")))
    rows = rows.withColumn("min_out", F.when(F.col("min_in").isNotNull() & ~F.col("starter") & (F.col("min_out") == 0), F.col("duration")).otherwise(F.col("min_out")))
    played = F.when(F.col("min_in").isNull() & ~unknown, 0).otherwise(F.col("min_out") - F.col("min_in"))
    return rows.withColumn("minutes", clamp(played, F.col("duration"))).drop("_in", "_out", "_end", "_changed", "_duration")


def first_keeper_only(appearances: DataFrame, forced: DataFrame | None = None) -> DataFrame:
    """At most one starting keeper per (match, team): the first by ``ord``. ``forced(player_id)`` are keepers always."""
    if forced is not None:
        appearances = appearances.join(forced.select("player_id").distinct().withColumn("_forced", F.lit(True)), "player_id", "left")
        appearances = appearances.withColumn("keeper", F.coalesce("_forced", "keeper")).drop("_forced")
    marked = F.col("starter") & F.col("keeper")
    w = Window.partitionBy("match_id", "team").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    nth = F.sum(F.coalesce(marked, F.lit(False)).cast("int")).over(w)
    return appearances.withColumn("_nth", nth).withColumn("keeper", F.when(marked & (F.col("_nth") > 1), False).otherwise(F.col("keeper"))).drop("_nth")


def substitute_keepers(appearances: DataFrame, reds: DataFrame, forced: DataFrame, minutes_after_red: int = 10) -> DataFrame:
    """Forced keepers who came on stay keepers only if they replaced the starting keeper in the same
    minute, or came on within ten minutes of that keeper's red card. ``reds(match_id, player_id, minute)``."""
    start = appearances.filter("starter and keeper").groupBy("match_id", "team").agg(F.min(F.struct("ord", "player_id", "min_out")).alias("g"))
    start = start.select("match_id", "team", F.col("g.player_id").alias("_gk"), F.col("g.min_out").alias("_gk_out"))
    red = start.join(reds.select("match_id", F.col("player_id").alias("_gk"), F.col("minute").alias("_red")), ["match_id", "_gk"]).groupBy("match_id", "team").agg(F.min("_red").alias("_red"))
    rows = appearances.join(start.drop("_gk"), ["match_id", "team"], "left").join(red, ["match_id", "team"], "left")
    rows = rows.join(forced.select("player_id").distinct().withColumn("_forced", F.lit(True)), "player_id", "left")
    direct = F.col("min_in").isNotNull() & (F.col("min_in") == F.col("_gk_out"))
    after_red = F.col("min_in").between(F.col("_red"), F.col("_red") + minutes_after_red)
    field = ~F.col("starter") & F.col("keeper") & F.col("_forced") & F.col("_gk_out").isNotNull() & ~F.coalesce(direct, F.lit(False)) & ~F.coalesce(after_red, F.lit(False))
    return rows.withColumn("keeper", F.when(field, False).otherwise(F.col("keeper"))).drop("_gk_out", "_red", "_forced")


def conceded(goals: DataFrame, matches: DataFrame, appearances: DataFrame | None = None) -> DataFrame:
    """(match_id, team, goal_minute): the side that conceded each goal, minutes without stoppage.

    One attribution for all uses: the scorer's own side concedes an own goal, the other side any
    other; without a known scorer's side, the side not credited concedes.
    """
    g = goals.join(matches.select("match_id", "home", "away"), "match_id", "left")
    if appearances is not None:
        g = g.join(appearances.select("match_id", "player_id", F.col("team").alias("_own")).distinct(), ["match_id", "player_id"], "left")
    else:
        g = g.withColumn("_own", F.lit(None).cast("string"))
    other = F.when(F.col("_own") == F.col("home"), F.col("away")).otherwise(F.col("home"))
    by_credit = F.when(F.lower(F.trim("credited")) == F.lower(F.trim("home")), F.col("away")).otherwise(F.col("home"))
    side = F.when(F.col("_own").isNotNull(), F.when(F.col("kind") == "own_goal", F.col("_own")).otherwise(other)).otherwise(by_credit)
    return g.select("match_id", side.alias("team"), base_minute(F.col("minute")).alias("goal_minute"))


def keeper_matches(keepers: DataFrame, conceded_goals: DataFrame) -> DataFrame:
    """Goals conceded while on the pitch, bounds included, and whether it was a full match.

    ``keepers``: match_id, team, player_id, competition, season, min_in, min_out, minutes, duration,
    ga_base, substituted. An equi-join on (match, side) with the interval as a condition of the sum,
    so keepers without a goal against stay.
    """
    k = keepers.withColumns({"_in": base_minute(F.col("min_in")), "_out": base_minute(F.col("min_out"))})
    keys = ["player_id", "match_id", "team", "competition", "season", "_in", "_out", "minutes", "duration", "ga_base", "substituted"]
    inside = F.col("goal_minute").between(F.col("_in"), F.col("_out"))
    per = k.join(conceded_goals, ["match_id", "team"], "left").groupBy(*keys).agg(F.count_if(F.coalesce(inside, F.lit(False))).alias("ga"))
    full = (F.col("_in") <= 0) & (F.col("_out") >= F.col("duration")) & ~F.col("substituted")
    return per.withColumn("full_match", F.coalesce(full, F.lit(False))).withColumnsRenamed({"_in": "min_in", "_out": "min_out"})


def keeper_table(per_match: DataFrame) -> DataFrame:
    """Clean sheets, goals against per match length, places with shared ties (clean sheets, ratio, minutes)."""
    base = F.when(F.max((F.col("ga_base") == 60).cast("int")) == 1, 60).when(F.max((F.col("ga_base") == 80).cast("int")) == 1, 80).otherwise(90)
    table = per_match.groupBy("player_id", "competition", "season").agg(
        F.sum("ga").alias("ga"), F.count_if(F.col("full_match") & (F.col("ga") == 0)).alias("clean_sheets"), F.sum("minutes").alias("minutes"), base.alias("base")
    )
    table = table.withColumn("ga_ratio", F.round(ratio(F.col("ga"), F.col("minutes"), F.col("base")), 6)).drop("base")
    return ranked(table, ["competition", "season"], ordering("-clean_sheets", "ga_ratio", "-minutes"))


def defensive_trios(defenders: DataFrame, conceded_goals: DataFrame) -> DataFrame:
    """Minutes together and goals against for every three defenders of a side with shared time.

    ``defenders(match_id, team, competition, season, player_id, min_in, min_out)``. The subsets of a
    side's defenders (a dozen at most) are made by ordered self-joins on (match, team).
    """
    d = defenders.filter("player_id is not null and min_in is not null")
    key = ["match_id", "team", "competition", "season"]

    def side(name: str) -> DataFrame:
        return d.select(*key, F.col("player_id").alias(name), F.col("min_in").alias(f"in_{name}"), F.col("min_out").alias(f"out_{name}"))

    trios = side("a").join(side("b"), key).filter("a < b").join(side("c"), key).filter("b < c")
    trios = trios.select(
        *key, F.concat_ws("-", "a", "b", "c").alias("trio"), F.greatest("in_a", "in_b", "in_c").alias("start"), F.least("out_a", "out_b", "out_c").alias("end")
    ).filter("end > start")
    together = trios.groupBy("trio", "competition", "season", "team").agg(F.sum(F.col("end") - F.col("start")).alias("minutes"))
    against = (
        trios.join(conceded_goals, ["match_id", "team"])
        .filter(F.col("goal_minute").between(F.col("start"), F.col("end")))
        .groupBy("trio", "competition", "season", "team")
        .agg(F.count("*").alias("ga"))
    )
    table = together.join(against, ["trio", "competition", "season", "team"], "left").withColumn("ga", F.coalesce("ga", F.lit(0)))
    return table.withColumn("ga_ratio", F.round(ratio(F.col("ga"), F.col("minutes"), 90.0), 6))


def goals_in_match(goals: DataFrame) -> DataFrame:
    """One row per scorer and kind in a match: minutes listed in order, rows ordered by the first."""
    from touchline.functions.minutes import show_minute, sort_minute

    rows = goals.withColumns({"_s": sort_minute(F.col("minute")), "_t": show_minute(F.col("minute"))})
    listed = rows.groupBy("match_id", "player_id", "kind").agg(
        F.min("_s").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_t"))), lambda x: x["_t"]), ", ").alias("minutes")
    )
    return numbered(listed, ["match_id"], ordering("first", "player_id", "kind"), "place")
