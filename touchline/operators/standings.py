"""Results and league tables.

``matches``: match_id, competition, season, round, match_date, home, away, goals_home, goals_away,
cancelled, official (and withdrawn, where known).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import club_key
from touchline.operators.tables import numbered, ordering


def override_official(matches: DataFrame, official: DataFrame) -> DataFrame:
    """Goals of ``official(match_id, goals_home, goals_away)`` replace those played; the first row of a match counts."""
    once = official.groupBy("match_id").agg(F.min_by(F.struct("goals_home", "goals_away"), "ord").alias("o"))
    joined = matches.join(once, "match_id", "left")
    return joined.withColumns(
        {
            "goals_home": F.coalesce("o.goals_home", "goals_home"),
            "goals_away": F.coalesce("o.goals_away", "goals_away"),
            "official": F.col("o").isNotNull(),
        }
    ).drop("o")


def counted_goals(own: str, other: str, home: bool) -> Column:
    """Goals for the table: an official result counts 3-0 for its winner, a tied one for the home side."""
    won = F.col(own) >= F.col(other) if home else F.col(own) > F.col(other)
    return F.when(F.col("official").eqNullSafe(True) & F.col(own).isNotNull() & F.col(other).isNotNull(), F.when(won, 3).otherwise(0)).otherwise(F.col(own))


def sides(matches: DataFrame) -> DataFrame:
    """Two rows per match: team, opponent, gf, ga, at_home."""
    m = matches.withColumns({"_h": counted_goals("goals_home", "goals_away", True), "_a": counted_goals("goals_away", "goals_home", False)})
    rows = F.explode(
        F.array(
            F.struct(F.col("home").alias("team"), F.col("away").alias("opponent"), F.col("_h").alias("gf"), F.col("_a").alias("ga"), F.lit(True).alias("at_home")),
            F.struct(F.col("away").alias("team"), F.col("home").alias("opponent"), F.col("_a").alias("gf"), F.col("_h").alias("ga"), F.lit(False).alias("at_home")),
        )
    )
    keep = [c for c in matches.columns if c not in ("home", "away", "goals_home", "goals_away")]
    return m.select(*keep, rows.alias("s")).select(*keep, "s.*")


def league_table(matches: DataFrame, sanctions: DataFrame | None = None, drop_unscored: bool = False) -> DataFrame:
    """Standings per (competition, season): one shuffle for the table, one for the places.

    Cancelled and withdrawn matches do not count. A match without a score counts as a draw, unless
    ``drop_unscored``. ``sanctions(competition, season, team, points)`` are deducted. Order: points,
    goal difference, goals, team.
    """
    valid = matches.filter(F.col("match_id").isNotNull() & ~F.col("cancelled").eqNullSafe(True))
    if "withdrawn" in matches.columns:
        valid = valid.filter(~F.col("withdrawn").eqNullSafe(True))
    if drop_unscored:
        valid = valid.filter("goals_home is not null and goals_away is not null")
    won, lost = F.col("gf") > F.col("ga"), F.col("gf") < F.col("ga")

    def times(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("int")), F.lit(0))

    table = (
        sides(valid)
        .withColumn("points", F.when(won, 3).when(lost, 0).otherwise(1))
        .groupBy("competition", "season", "team")
        .agg(
            F.count("*").alias("played"),
            F.sum("points").alias("points"),
            times(won).alias("won"),
            F.count_if(~F.coalesce(won, F.lit(False)) & ~F.coalesce(lost, F.lit(False))).alias("drawn"),
            times(lost).alias("lost"),
            F.coalesce(F.sum("gf"), F.lit(0)).alias("gf"),
            F.coalesce(F.sum("ga"), F.lit(0)).alias("ga"),
        )
        .withColumn("gd", F.col("gf") - F.col("ga"))
    )
    if sanctions is not None:
        minus = sanctions.groupBy("competition", "season", "team").agg(F.sum("points").alias("minus"))
        table = table.join(minus, ["competition", "season", "team"], "left").withColumn("points", F.col("points") - F.coalesce("minus", F.lit(0))).drop("minus")
    return numbered(table, ["competition", "season"], ordering("-points", "-gd", "-gf", "team"))


def withdrawn_matches(matches: DataFrame, rules: DataFrame, containment: bool = False) -> DataFrame:
    """Matches hit by a withdrawal rule (competition, club, from_round): that round or later with the club on a side.

    The rules are a hand-kept list; the join is an equi-join on competition and side, or a theta
    join with either name containing the other if ``containment`` (the live ingest's rule).
    """
    m = matches.select("match_id", "competition", F.col("round").try_cast("int").alias("_round"), F.explode(F.array(club_key(F.col("home")), club_key(F.col("away")))).alias("_club"))
    r = rules.select(F.col("competition").alias("_rc"), club_key(F.col("club")).alias("_rclub"), F.col("from_round").cast("int").alias("_from"))
    a, b = F.lower(F.trim("competition")), F.lower(F.trim("_rc"))
    same = (a.contains(b) | b.contains(a)) if containment else (a == b)
    return m.join(r, same & (F.col("_club") == F.col("_rclub")) & (F.col("_round") >= F.col("_from")), "left_semi").select("match_id").distinct()


def with_cancellation(matches: DataFrame, rules: DataFrame, cancelled_ids: DataFrame) -> DataFrame:
    """cancelled and withdrawn flags: a rule first, then the flag as read, then the list of ids, then False."""
    hit = withdrawn_matches(matches, rules).withColumn("_rule", F.lit(True))
    listed = cancelled_ids.select("match_id").distinct().withColumn("_listed", F.lit(True))
    joined = matches.join(hit, "match_id", "left").join(listed, "match_id", "left")
    return joined.withColumns(
        {"cancelled": F.coalesce("_rule", "cancelled", "_listed", F.lit(False)), "withdrawn": F.coalesce("_rule", F.lit(False))}
    ).drop("_rule", "_listed")


def withdrawal_placeholders(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """Cancelled return fixtures that a withdrawn club will not play.

    The club's n matches before the rule's round are its first half, numbered in round order; a
    missing round r gets the mirror of number r - n with sides swapped, up to the competition's last
    round or twice n. Ids are null.
    """
    own = sides_of_rules(matches, rules)
    last = matches.groupBy(F.lower(F.trim("competition")).alias("_c")).agg(F.max(F.col("round").try_cast("int")).alias("_last"))
    first = own.filter("_round < from_round")
    from pyspark.sql import Window

    w = Window.partitionBy("rule_id")
    first = first.withColumn("number", F.row_number().over(w.orderBy("_round", "match_id"))).withColumn("n", F.count("*").over(w))
    span = first.groupBy("rule_id", "_c", "from_round").agg(F.max("n").alias("n"), F.max("_round").alias("top")).join(last, "_c")
    rounds = span.select("rule_id", "n", F.explode(F.when(F.greatest("_last", F.col("n") * 2, "top") >= F.col("from_round"), F.sequence("from_round", F.greatest("_last", F.col("n").cast("int") * 2, "top")))).alias("round"))
    missing = rounds.join(own.select("rule_id", F.col("_round").alias("round")).distinct(), ["rule_id", "round"], "left_anti")
    mirror = first.select("rule_id", "number", "competition", "season", F.col("away").alias("home"), F.col("home").alias("away"))
    found = missing.withColumn("number", (F.col("round") - F.col("n")).cast("int")).join(mirror, ["rule_id", "number"])
    none = F.lit(None)
    return found.select(
        none.cast("long").alias("match_id"), "competition", "season", "round", none.cast("date").alias("match_date"), "home", "away",
        none.cast("int").alias("goals_home"), none.cast("int").alias("goals_away"), F.lit(True).alias("cancelled"), F.lit(True).alias("withdrawn"), F.lit(False).alias("official"),
    )


def sides_of_rules(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """Matches of each rule's club in its competition, with the rule."""
    r = rules.select(F.lower(F.trim("competition")).alias("_c"), club_key(F.col("club")).alias("_club"), F.col("from_round").cast("int").alias("from_round"))
    r = r.withColumn("rule_id", F.xxhash64("_c", "_club", "from_round"))
    m = matches.withColumns({"_c": F.lower(F.trim("competition")), "_round": F.col("round").try_cast("int")})
    return m.withColumn("_club", F.explode(F.array(club_key(F.col("home")), club_key(F.col("away"))))).join(r, ["_c", "_club"])


def with_fixtures(matches: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Matches and the planned fixtures that none of them has played (same competition, season, round and sides)."""
    key = ["competition", "season", "round", "home", "away"]
    keyed = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    played = matches.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    condition = keyed[0]
    for k in keyed[1:]:
        condition = condition & k
    return matches.unionByName(fixtures.join(played, condition, "left_anti"), allowMissingColumns=True)
