"""Statistics of players, teams and officials.

``appearances``: match_id, player_id, team, competition, season, match_date, starter, minutes, shirt,
name, ord. ``goals``: match_id, player_id, competition, season, kind, minute. ``cards``: match_id,
player_id, competition, season, color, minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.calendar import age_on
from touchline.functions.text import non_empty
from touchline.operators.tables import first_rows, ordering, ranked



def card_counts(cards: DataFrame, by: list[str]) -> DataFrame:
    return cards.filter("player_id is not null").groupBy(*by).agg(F.count_if(F.col("color") == "yellow").alias("yellows"), F.count_if(F.col("color") == "red").alias("reds"))


def goal_counts(goals: DataFrame, by: list[str]) -> DataFrame:
    return goals.filter("player_id is not null and kind = 'normal'").groupBy(*by).agg(F.count("*").alias("goals"))


def player_totals(appearances: DataFrame, goals: DataFrame, cards: DataFrame, bio: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Called up (distinct matches), played, starts, minutes, goals, cards, last team and, with ``bio(player_id, birth)``, age."""
    base = appearances.filter("player_id is not null").groupBy("player_id").agg(
        F.max_by("team", F.struct("match_date", "match_id", "team")).alias("team"),
        F.count_distinct("match_id").alias("called_up"),
        F.count_if(F.col("minutes") > 0).alias("played"),
        F.count_if(F.col("starter")).alias("starts"),
        F.coalesce(F.sum("minutes"), F.lit(0)).alias("minutes"),
    )
    out = base.join(goal_counts(goals, ["player_id"]), "player_id", "left").join(card_counts(cards, ["player_id"]), "player_id", "left")
    out = out.fillna(0, ["goals", "yellows", "reds"])
    if bio is not None:
        out = out.join(bio.select("player_id", "birth"), "player_id", "left").withColumn("age", age_on(F.col("birth"), as_of)).drop("birth")
    return out


def teams_of_players(appearances: DataFrame) -> DataFrame:
    """Per (player, competition, season): teams in order of first match, joined, and the latest one."""
    firsts = appearances.filter("player_id is not null").groupBy("player_id", "competition", "season", "team").agg(F.min(F.struct("match_date", "match_id")).alias("first"), F.max(F.struct("match_date", "match_id")).alias("last"))
    return firsts.groupBy("player_id", "competition", "season").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "team"))), lambda x: x["team"]), " / ").alias("teams"), F.max_by("team", F.struct("last", "team")).alias("last_team")
    )


def top_scorers(appearances: DataFrame, goals: DataFrame) -> DataFrame:
    """Goals per (competition, season, player); equal numbers share the lowest place. Scorers without an appearance stay."""
    per = goal_counts(goals, ["player_id", "competition", "season"])
    return ranked(per.join(teams_of_players(appearances), ["player_id", "competition", "season"], "left"), ["competition", "season"], ordering("-goals"))


def discipline(cards: DataFrame) -> DataFrame:
    """Cards per (competition, season, player), places by reds, then yellows, ties shared."""
    per = card_counts(cards, ["player_id", "competition", "season"]).filter("yellows > 0 or reds > 0")
    return ranked(per, ["competition", "season"], ordering("-reds", "-yellows"))


def second_yellows(events: DataFrame) -> DataFrame:
    """Card rows of events with card = yellow, red or second_yellow; a second yellow is a yellow and a red."""
    colors = F.when(F.col("card") == "second_yellow", F.array(F.lit("yellow"), F.lit("red"))).when(F.col("card").isin("yellow", "red"), F.array("card"))
    return events.withColumn("color", F.explode(colors)).drop("card")


def careers(appearances: DataFrame, goals: DataFrame, cards: DataFrame) -> DataFrame:
    """(player, season, competition, team): appearances, goals and cards joined in full, zero-filled.

    A goal or card goes to the team the player appeared for in that match.
    """
    key = ["player_id", "season", "competition", "team"]
    a = appearances.filter("player_id is not null")
    teams = a.select("match_id", "player_id", "team").distinct()
    calls = a.groupBy(*key).agg(F.count_distinct("match_id").alias("called_up"), F.count_if(F.col("minutes") > 0).alias("played"), F.sum("minutes").alias("minutes"))
    g = goal_counts(goals.join(teams, ["match_id", "player_id"], "left"), key)
    c = card_counts(cards.drop("team").join(teams, ["match_id", "player_id"], "left"), key)
    # Union and one aggregation: a full outer join on null-safe keys in a single shuffle.
    numbers = ["called_up", "played", "minutes", "goals", "yellows", "reds"]
    parts = calls.unionByName(g, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return parts.groupBy(*key).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in numbers])


def career_totals(appearances: DataFrame, goals: DataFrame, cards: DataFrame, by: list[str], where: str = "true") -> DataFrame:
    """Career summary over the matches that ``where`` selects (national teams, categories); also without any."""
    rows = careers(appearances.filter(where), goals.filter(where) if "national" in goals.columns else goals, cards.filter(where) if "national" in cards.columns else cards)
    return rows.groupBy(*by).agg(*[F.sum(n).alias(n) for n in ("called_up", "played", "minutes", "goals", "yellows", "reds")])


def rosters(appearances: DataFrame, goals: DataFrame, cards: DataFrame) -> DataFrame:
    """Per (team, season, player), for players with an appearance there."""
    return careers(appearances, goals, cards).filter("team is not null and called_up > 0").groupBy("team", "season", "player_id").agg(*[F.sum(n).alias(n) for n in ("called_up", "played", "minutes", "goals", "yellows", "reds")])


def team_seasons(matches: DataFrame) -> DataFrame:
    """(team, competition, season, last_date), either side."""
    rows = matches.select("competition", "season", "match_date", F.explode(F.array("home", "away")).alias("team"))
    return rows.groupBy("team", "competition", "season").agg(F.max("match_date").alias("last_date"))


def people_seasons(assignments: DataFrame, who: list[str]) -> DataFrame:
    """Referees or staff: distinct matches and last date per (who, competition, season)."""
    return assignments.groupBy(*who, "competition", "season").agg(F.count_distinct("match_id").alias("matches"), F.max("match_date").alias("last_date"))


def possible_minutes(matches: DataFrame) -> DataFrame:
    """Minutes each team could have played."""
    rows = matches.filter("match_id is not null and not coalesce(cancelled, false)").select("competition", "season", "duration", F.explode(F.array("home", "away")).alias("team"))
    return rows.groupBy("competition", "season", "team").agg(F.sum("duration").alias("possible_minutes"))


def main_shirt(appearances: DataFrame) -> DataFrame:
    """Most frequent shirt of each player, the lowest on ties."""
    counts = appearances.filter("shirt is not null and player_id is not null").groupBy("player_id", "shirt").agg(F.count("*").alias("n"))
    return first_rows(counts, ["player_id"], ordering("-n", "shirt")).select("player_id", "shirt", "n")


def main_ground(matches: DataFrame, priority: str) -> DataFrame:
    """Most used ground of each home team among its matches of best ``priority`` (lowest), name on ties."""
    counts = matches.filter("ground is not null").groupBy("home", priority, "ground").agg(F.count("*").alias("n"))
    return first_rows(counts, ["home"], ordering(priority, "-n", "ground")).select(F.col("home").alias("team"), "ground", "n")


def latest_season_card(rows: DataFrame, excluded: str = "(?iu)бараж|baraz|пријател|friendly") -> DataFrame:
    """Sums over each player's latest season that is no play-off or friendly; played >= starts, sub_on >= 0."""
    w = Window.partitionBy("player_id")
    kept = rows.filter(~F.col("competition").rlike(excluded)).withColumn("_last", F.max("season").over(w)).filter("season = _last")
    out = kept.groupBy("player_id", "season").agg(F.sum("played").alias("played"), F.sum("starts").alias("starts"), F.sum("minutes").alias("minutes"))
    out = out.withColumn("played", F.greatest("played", "starts"))
    return out.withColumn("sub_on", F.greatest(F.lit(0), F.col("played") - F.col("starts")))


def top_per_competition(table: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    return first_rows(table, ["competition", "season"], order, n)


def goal_teams(goals: DataFrame, order: list[str]) -> DataFrame:
    """(competition, season, player_id, teams, last_team) of scorers from their goals, for players without appearances.

    The team is the player's, else the credited one; blank ids and teams do not count.
    """
    rows = goals.select("competition", "season", non_empty(F.col("player_id")).alias("player_id"), non_empty(F.coalesce("team", "credited")).alias("team"), F.struct(*order).alias("_o"))
    rows = rows.filter("competition is not null and player_id is not null and team is not null")
    firsts = rows.groupBy("competition", "season", "player_id", "team").agg(F.min("_o").alias("_f"), F.max("_o").alias("_l"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("_f", "team"))), lambda x: x["team"])
    return firsts.groupBy("competition", "season", "player_id").agg(F.array_join(names, " / ").alias("teams"), F.max_by("team", F.struct("_l", "team")).alias("last_team"))
