"""Queries of the match operators over the analog tables, each with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.labels import category_key, cup_round_keys, match_duration, round_order, score_text
from touchline.functions.minutes import base_minute, show_minute, sort_minute
from touchline.operators import identity, incremental, masters, players, presence, standings, tables
from touchline.plans import analogs as a
from touchline.streaming import ingest

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None, base: bool = True):
    """Register a query under its function's name; ``sql`` follows the analog definitions."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = (a.SQL if base else "") + sql
        return f

    return add


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


TABLE = """, t AS (
  SELECT competition, season, team, count(*) AS played, sum(CASE WHEN gf > ga THEN 3 WHEN gf < ga THEN 0 ELSE 1 END) AS points,
    sum(CASE WHEN gf > ga THEN 1 ELSE 0 END) AS won, sum(CASE WHEN gf = ga THEN 1 ELSE 0 END) AS drawn, sum(CASE WHEN gf < ga THEN 1 ELSE 0 END) AS lost,
    sum(gf) AS gf, sum(ga) AS ga, sum(gf) - sum(ga) AS gd FROM sides WHERE NOT cancelled GROUP BY ALL)
"""


@query(
    TABLE
    + """, m AS (SELECT competition, season, team, sum(points) AS minus FROM sanctions GROUP BY ALL),
u AS (SELECT t.* REPLACE (points - coalesce(minus, 0) AS points) FROM t LEFT JOIN m USING (competition, season, team))
SELECT competition, season, team, CAST(played AS BIGINT) AS played, CAST(points AS BIGINT) AS points, CAST(won AS BIGINT) AS won, CAST(drawn AS BIGINT) AS drawn,
  CAST(lost AS BIGINT) AS lost, CAST(gf AS BIGINT) AS gf, CAST(ga AS BIGINT) AS ga, CAST(gd AS BIGINT) AS gd,
  row_number() OVER (PARTITION BY competition, season ORDER BY points DESC, gd DESC, gf DESC, team) AS pos FROM u"""
)
def standings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longs(standings.league_table(a.matches(spark, sf_dir), a.sanctions(spark, sf_dir)), "played", "points", "won", "drawn", "lost", "gf", "ga", "gd", "pos")


QUERIES["standings"], ORACLE["standings"] = QUERIES.pop("standings_table"), ORACLE.pop("standings_table")


@query(
    """SELECT a.player_id, max_by(a.team, (a.match_date, a.match_id, a.team)) AS team, count(DISTINCT a.match_id) AS called_up,
  CAST(count(*) FILTER (a.minutes > 0) AS BIGINT) AS played, CAST(count(*) FILTER (a.starter) AS BIGINT) AS starts, CAST(sum(a.minutes) AS BIGINT) AS minutes,
  CAST(coalesce(any_value(g.n), 0) AS BIGINT) AS goals, CAST(coalesce(any_value(c.y), 0) AS BIGINT) AS yellows, CAST(coalesce(any_value(c.r), 0) AS BIGINT) AS reds
FROM appearances a LEFT JOIN (SELECT player_id, count(*) AS n FROM goals WHERE kind = 'normal' GROUP BY 1) g USING (player_id)
LEFT JOIN (SELECT player_id, count(*) FILTER (color = 'yellow') AS y, count(*) FILTER (color = 'red') AS r FROM cards GROUP BY 1) c USING (player_id) GROUP BY 1"""
)
def player_totals(spark, sf_dir):
    out = players.player_totals(a.appearances(spark, sf_dir), a.goals(spark, sf_dir), a.cards(spark, sf_dir))
    return longs(out, "called_up", "played", "starts", "minutes", "goals", "yellows", "reds")


TEAMS = """, firsts AS (SELECT player_id, competition, season, team, min((match_date, match_id)) AS f, max((match_date, match_id)) AS l FROM appearances GROUP BY ALL),
teams AS (SELECT player_id, competition, season, string_agg(team, ' / ' ORDER BY f, team) AS teams, max_by(team, (l, team)) AS last_team FROM firsts GROUP BY ALL)
"""


@query(TEAMS + "SELECT * FROM teams")
def unique_join_text(spark, sf_dir):
    return players.teams_of_players(a.appearances(spark, sf_dir))


@query(
    TEAMS
    + """, s AS (SELECT player_id, competition, season, count(*) AS goals FROM goals WHERE kind = 'normal' GROUP BY ALL)
SELECT s.*, teams, last_team, rank() OVER (PARTITION BY competition, season ORDER BY goals DESC) AS pos FROM s LEFT JOIN teams USING (player_id, competition, season)"""
)
def scorers_rank(spark, sf_dir):
    return longs(players.top_scorers(a.appearances(spark, sf_dir), a.goals(spark, sf_dir)), "goals", "pos")


@query(
    """, c AS (SELECT player_id, competition, season, count(*) FILTER (color = 'yellow') AS yellows, count(*) FILTER (color = 'red') AS reds FROM cards GROUP BY ALL)
SELECT *, rank() OVER (PARTITION BY competition, season ORDER BY reds DESC, yellows DESC) AS pos FROM c"""
)
def discipline_tie_rank(spark, sf_dir):
    return longs(players.discipline(a.cards(spark, sf_dir)), "yellows", "reds", "pos")


@query("SELECT match_id, player_id, CAST(minute AS BIGINT) AS minute, color, count(*) AS n FROM cards GROUP BY ALL")
def explode_second_yellow(spark, sf_dir):
    return longs(a.cards(spark, sf_dir), "minute").groupBy("match_id", "player_id", "minute", "color").agg(F.count("*").alias("n"))


CONCEDED = """, own AS (SELECT DISTINCT match_id, player_id, team FROM appearances),
conceded AS (SELECT g.match_id, CASE WHEN g.kind = 'own_goal' THEN o.team WHEN o.team = m.home THEN m.away ELSE m.home END AS team,
    CASE WHEN g.minute > 140 THEN CAST(substr(CAST(g.minute AS VARCHAR), 1, 2) AS BIGINT) ELSE g.minute END AS goal_minute
  FROM goals g JOIN matches m USING (match_id) LEFT JOIN own o USING (match_id, player_id)),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id, team ORDER BY shirt, player_id) AS rn FROM appearances WHERE starter) WHERE rn = 1),
per AS (SELECT k.player_id, k.match_id, k.team, k.competition, k.season, k.minutes, k.duration, k.min_in, k.min_out,
    count(*) FILTER (goal_minute BETWEEN k.min_in AND k.min_out) AS ga FROM k LEFT JOIN conceded USING (match_id, team) GROUP BY ALL)
"""


def _keepers(spark, sf_dir) -> DataFrame:
    w = Window.partitionBy("match_id", "team").orderBy("shirt", "player_id")
    starters = a.appearances(spark, sf_dir).filter("starter").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return starters.withColumn("ga_base", F.col("duration"))


def _conceded(spark, sf_dir) -> DataFrame:
    return presence.conceded(a.goals(spark, sf_dir), a.matches(spark, sf_dir), a.appearances(spark, sf_dir))


@query(CONCEDED + "SELECT player_id, match_id, team, CAST(ga AS BIGINT) AS ga, (min_in <= 0 AND min_out >= duration) AS full_match FROM per")
def keeper_interval(spark, sf_dir):
    per = presence.keeper_matches(_keepers(spark, sf_dir), _conceded(spark, sf_dir))
    return longs(per.select("player_id", "match_id", "team", "ga", "full_match"), "ga")


@query(
    CONCEDED
    + """, t AS (SELECT player_id, competition, season, CAST(sum(ga) AS BIGINT) AS ga, CAST(count(*) FILTER (min_in <= 0 AND min_out >= duration AND ga = 0) AS BIGINT) AS clean_sheets, CAST(sum(minutes) AS BIGINT) AS minutes,
    CASE WHEN bool_or(duration = 60) THEN 60 WHEN bool_or(duration = 80) THEN 80 ELSE 90 END AS base FROM per GROUP BY ALL),
r AS (SELECT * EXCLUDE (base), CASE WHEN minutes > 0 THEN round(CAST(ga AS DOUBLE) / minutes * base, 6) ELSE 0 END AS ga_ratio FROM t)
SELECT * EXCLUDE (ga_ratio), round(ga_ratio, 4) AS ga_ratio, rank() OVER (PARTITION BY competition, season ORDER BY clean_sheets DESC, ga_ratio, minutes DESC) AS pos FROM r"""
)
def keeper_table(spark, sf_dir):
    out = presence.keeper_table(presence.keeper_matches(_keepers(spark, sf_dir), _conceded(spark, sf_dir)))
    return longs(out, "ga", "clean_sheets", "minutes", "pos").withColumn("ga_ratio", F.round("ga_ratio", 4))


@query(
    CONCEDED
    + """, d AS (SELECT * FROM appearances),
tr AS (SELECT a.match_id, a.team, a.competition, a.season, a.player_id || '-' || b.player_id || '-' || c.player_id AS trio,
    greatest(a.min_in, b.min_in, c.min_in) AS s, least(a.min_out, b.min_out, c.min_out) AS e
  FROM d a JOIN d b ON a.match_id = b.match_id AND a.team = b.team AND a.player_id < b.player_id JOIN d c ON a.match_id = c.match_id AND a.team = c.team AND b.player_id < c.player_id),
v AS (SELECT * FROM tr WHERE e > s),
g AS (SELECT trio, competition, season, team, count(*) AS ga FROM v JOIN conceded USING (match_id, team) WHERE goal_minute BETWEEN s AND e GROUP BY ALL),
m AS (SELECT trio, competition, season, team, sum(e - s) AS minutes FROM v GROUP BY ALL)
SELECT trio, competition, season, team, CAST(minutes AS BIGINT) AS minutes, CAST(coalesce(ga, 0) AS BIGINT) AS ga, round(coalesce(ga, 0) / CAST(minutes AS DOUBLE) * 90, 4) AS ga_ratio FROM m LEFT JOIN g USING (trio, competition, season, team)"""
)
def trio_shared(spark, sf_dir):
    out = presence.defensive_trios(a.appearances(spark, sf_dir), _conceded(spark, sf_dir))
    return longs(out, "minutes", "ga").withColumn("ga_ratio", F.round("ga_ratio", 4))


CAREER = """, own AS (SELECT DISTINCT match_id, player_id, team FROM appearances),
x AS (SELECT player_id, season, competition, team, match_id, CASE WHEN minutes > 0 THEN 1 ELSE 0 END AS played, minutes, 0 AS goals, 0 AS yellows, 0 AS reds FROM appearances
  UNION ALL SELECT player_id, season, competition, o.team, NULL, 0, 0, 1, 0, 0 FROM goals LEFT JOIN own o USING (match_id, player_id) WHERE kind = 'normal'
  UNION ALL SELECT player_id, season, competition, o.team, NULL, 0, 0, 0, CASE WHEN color = 'yellow' THEN 1 ELSE 0 END, CASE WHEN color = 'red' THEN 1 ELSE 0 END FROM cards c LEFT JOIN own o USING (match_id, player_id)),
career AS (SELECT player_id, season, competition, team, CAST(count(DISTINCT match_id) AS BIGINT) AS called_up, CAST(sum(played) AS BIGINT) AS played, CAST(sum(minutes) AS BIGINT) AS minutes,
  CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(yellows) AS BIGINT) AS yellows, CAST(sum(reds) AS BIGINT) AS reds FROM x GROUP BY ALL)
"""
NUMBERS = ("called_up", "played", "minutes", "goals", "yellows", "reds")


@query(CAREER + "SELECT * FROM career")
def career_full_outer(spark, sf_dir):
    return longs(players.careers(a.appearances(spark, sf_dir), a.goals(spark, sf_dir), a.cards(spark, sf_dir)), *NUMBERS)


@query(
    CAREER
    + """SELECT team, season, player_id, CAST(sum(called_up) AS BIGINT) AS called_up, CAST(sum(played) AS BIGINT) AS played, CAST(sum(minutes) AS BIGINT) AS minutes,
  CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(yellows) AS BIGINT) AS yellows, CAST(sum(reds) AS BIGINT) AS reds FROM career WHERE team IS NOT NULL AND called_up > 0 GROUP BY ALL"""
)
def roster(spark, sf_dir):
    return longs(players.rosters(a.appearances(spark, sf_dir), a.goals(spark, sf_dir), a.cards(spark, sf_dir)), *NUMBERS)


@query(
    CAREER
    + """SELECT player_id, CASE competition WHEN '5-LOW' THEN 'category_cadet' WHEN '4-NOT SPECIFIED' THEN 'category_youth' ELSE 'category_senior' END AS category, CAST(sum(called_up) AS BIGINT) AS called_up, CAST(sum(played) AS BIGINT) AS played, CAST(sum(minutes) AS BIGINT) AS minutes,
  CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(yellows) AS BIGINT) AS yellows, CAST(sum(reds) AS BIGINT) AS reds FROM career GROUP BY ALL"""
)
def career_by_category(spark, sf_dir):
    c = F.col("competition")
    key = category_key(F.when(c == "5-LOW", "Кадети").when(c == "4-NOT SPECIFIED", "Младинци").otherwise("Сениори"))
    rows = [df(spark, sf_dir).withColumn("competition", key) for df in (a.appearances, a.goals, a.cards)]
    return longs(players.career_totals(*rows, ["player_id", "competition"]).withColumnRenamed("competition", "category"), *NUMBERS)


@query("SELECT team, competition, season, max(match_date) AS last_date FROM (SELECT competition, season, match_date, unnest([home, away]) AS team FROM matches) GROUP BY ALL")
def team_seasons(spark, sf_dir):
    return players.team_seasons(a.matches(spark, sf_dir))


@query(
    """SELECT 'Official ' || CAST(l_suppkey % 40 AS VARCHAR) AS name, competition, season, count(DISTINCT match_id) AS matches, max(match_date) AS last_date FROM ev GROUP BY ALL"""
)
def referee_seasons(spark, sf_dir):
    rows = a._events(spark, sf_dir).withColumn("name", F.concat(F.lit("Official "), (F.col("l_suppkey") % 40).cast("string")))
    return players.people_seasons(rows, ["name"])


@query("SELECT competition, season, team, CAST(sum(duration) AS BIGINT) AS possible_minutes FROM (SELECT competition, season, duration, unnest([home, away]) AS team FROM matches WHERE NOT cancelled) GROUP BY ALL")
def possible_minutes(spark, sf_dir):
    return longs(players.possible_minutes(a.matches(spark, sf_dir)), "possible_minutes")


@query(
    """SELECT player_id, shirt, n FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY n DESC, shirt) AS rn FROM
  (SELECT player_id, shirt, count(*) AS n FROM appearances GROUP BY ALL)) WHERE rn = 1"""
)
def mode_tie_lowest(spark, sf_dir):
    return longs(players.main_shirt(a.appearances(spark, sf_dir)), "shirt", "n")


@query(
    """SELECT home AS team, ground, n FROM (SELECT *, row_number() OVER (PARTITION BY home ORDER BY competition, n DESC, ground) AS rn FROM
  (SELECT home, competition, 'Ground ' || CAST(round % 7 AS VARCHAR) AS ground, count(*) AS n FROM matches GROUP BY ALL)) WHERE rn = 1"""
)
def priority_mode(spark, sf_dir):
    m = a.matches(spark, sf_dir).withColumn("ground", F.concat(F.lit("Ground "), (F.col("round") % 7).cast("string")))
    return longs(players.main_ground(m, "competition"), "n")


@query(
    """, s AS (SELECT player_id, competition, season, count(*) AS goals FROM goals WHERE kind = 'normal' GROUP BY ALL)
SELECT competition, season, player_id, goals FROM (SELECT *, row_number() OVER (PARTITION BY competition, season ORDER BY goals DESC, player_id) AS rn FROM s) WHERE rn <= 5"""
)
def topk_per_group(spark, sf_dir):
    per = players.goal_counts(a.goals(spark, sf_dir), ["competition", "season", "player_id"])
    return longs(players.top_per_competition(per, tables.ordering("-goals", "player_id")), "goals")


@query(
    """, s AS (SELECT player_id, competition, season, count(*) FILTER (minutes > 0) AS played, count(*) FILTER (starter) AS starts, sum(minutes) AS minutes FROM appearances GROUP BY ALL),
k AS (SELECT *, max(season) OVER (PARTITION BY player_id) AS l FROM s)
SELECT player_id, season, CAST(greatest(sum(played), sum(starts)) AS BIGINT) AS played, CAST(sum(starts) AS BIGINT) AS starts, CAST(sum(minutes) AS BIGINT) AS minutes,
  CAST(greatest(0, greatest(sum(played), sum(starts)) - sum(starts)) AS BIGINT) AS sub_on FROM k WHERE season = l GROUP BY ALL"""
)
def latest_season_card(spark, sf_dir):
    rows = a.appearances(spark, sf_dir).groupBy("player_id", "competition", "season").agg(F.count_if(F.col("minutes") > 0).alias("played"), F.count_if(F.col("starter")).alias("starts"), F.sum("minutes").alias("minutes"))
    return longs(players.latest_season_card(rows), "played", "starts", "minutes", "sub_on")


@query(
    """, hit AS (SELECT DISTINCT m.match_id FROM matches m JOIN rules r ON m.competition = r.competition AND (m.home = r.club OR m.away = r.club) AND m.round >= r.from_round)
SELECT m.match_id, CASE WHEN h.match_id IS NOT NULL THEN true WHEN cancelled IS NOT NULL THEN cancelled ELSE false END AS cancelled, h.match_id IS NOT NULL AS withdrawn FROM matches m LEFT JOIN hit h USING (match_id)"""
)
def cancel_precedence(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    return standings.with_cancellation(m, a.rules(spark, sf_dir), m.filter("match_id % 97 = 0").select("match_id")).select("match_id", "cancelled", "withdrawn")


@query("SELECT DISTINCT m.match_id FROM matches m JOIN rules r ON m.competition = r.competition AND (m.home = r.club OR m.away = r.club) AND m.round >= r.from_round")
def rule_range_semi(spark, sf_dir):
    return standings.withdrawn_matches(a.matches(spark, sf_dir), a.rules(spark, sf_dir))


LEAGUE = """, one AS (SELECT * REPLACE (competition || ' ' || CAST(season AS VARCHAR) AS competition) FROM (SELECT *, row_number() OVER (PARTITION BY competition, season, round, home ORDER BY match_id) AS rn FROM matches) WHERE rn = 1),
every AS (SELECT DISTINCT r.competition || ' ' || CAST(season AS VARCHAR) AS competition, club, from_round FROM rules r, (SELECT DISTINCT season FROM matches)),
own AS (SELECT o.match_id, o.competition, o.season, o.round, o.home, o.away, r.club, r.from_round FROM one o JOIN every r ON o.competition = r.competition AND (o.home = r.club OR o.away = r.club)),
f AS (SELECT *, row_number() OVER (PARTITION BY competition, club, from_round ORDER BY round, match_id) AS number, count(*) OVER (PARTITION BY competition, club, from_round) AS n FROM own WHERE round < from_round),
last AS (SELECT competition, max(round) AS l FROM one GROUP BY 1),
span AS (SELECT competition, club, from_round, max(n) AS n, greatest(max(l), 2 * max(n), max(round)) AS top FROM f JOIN last USING (competition) GROUP BY ALL),
rounds AS (SELECT competition, club, from_round, n, unnest(generate_series(from_round, top)) AS round FROM span WHERE top >= from_round),
miss AS (SELECT * FROM rounds q WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.competition = q.competition AND o.club = q.club AND o.from_round = q.from_round AND o.round = q.round))
"""


@query(LEAGUE + "SELECT f.competition, f.season, CAST(miss.round AS BIGINT) AS round, f.away AS home, f.home AS away FROM miss JOIN f ON f.competition = miss.competition AND f.club = miss.club AND f.from_round = miss.from_round AND f.number = miss.round - miss.n")
def mirror_fixture(spark, sf_dir):
    """Every season as a competition of its own; a home side's first match of a round is its match of the round."""
    name = F.concat_ws(" ", "competition", F.col("season").cast("string"))
    m = a.matches(spark, sf_dir)
    one = tables.first_rows(m, ["competition", "season", "round", "home"], tables.ordering("match_id")).withColumn("competition", name)
    seasons = F.explode(F.sequence(F.lit(1980), F.lit(2040)))
    rules = a.rules(spark, sf_dir).withColumn("season", seasons).select(name.alias("competition"), "club", "from_round")
    return longs(standings.withdrawal_placeholders(one, rules).select("competition", "season", "round", "home", "away"), "round")


@query(
    """SELECT match_id, CASE WHEN match_id % 3 = 0 THEN CAST(16 AS BIGINT) ELSE goals_home END AS goals_home, CASE WHEN match_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE goals_away END AS goals_away, match_id % 3 = 0 AS official FROM matches"""
)
def official_override(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    fixed = m.filter("match_id % 3 = 0").select("match_id", F.lit(16).cast("long").alias("goals_home"), F.lit(0).cast("long").alias("goals_away"), F.lit(1).alias("ord"))
    twice = fixed.union(fixed.withColumns({"goals_home": F.lit(1).cast("long"), "ord": F.lit(2)}))
    return standings.override_official(m, twice).select("match_id", "goals_home", "goals_away", "official")


@query(
    """, fx AS (SELECT DISTINCT competition, season, round, away AS home, home AS away FROM matches)
SELECT competition, season, round, home, away FROM fx WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.competition = fx.competition AND m.season = fx.season AND m.round = fx.round AND m.home = fx.home AND m.away = fx.away)"""
)
def anti_placeholders(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    fixtures = m.select("competition", "season", "round", F.col("away").alias("home"), F.col("home").alias("away")).distinct()
    return standings.with_fixtures(m, fixtures).filter("match_id is null").select("competition", "season", "round", "home", "away")


@query(
    """SELECT competition, season, team, opponent, at_home, CAST(count(*) AS BIGINT) AS n, CAST(sum(gf) AS BIGINT) AS gf FROM sides GROUP BY ALL"""
)
def unpivot_sides(spark, sf_dir):
    return longs(standings.sides(a.matches(spark, sf_dir)).groupBy("competition", "season", "team", "opponent", "at_home").agg(F.count("*").alias("n"), F.sum("gf").alias("gf")), "n", "gf")


@query(
    """, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
s AS (SELECT user_id, event_id, sum(CASE WHEN p IS NOT NULL AND epoch(ts) - epoch(p) > 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) + 1 AS stint FROM o)
SELECT user_id, event_id, CAST(stint AS BIGINT) AS stint FROM s"""
)
def stint_split(spark, sf_dir):
    ev = a.table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    out = tables.stints(ev, ["user_id"], "ts", "event_id", F.col("ts") > F.col("_previous") + F.expr("INTERVAL 24 HOURS"))
    return longs(out.select("user_id", "event_id", "stint"), "stint")


@query(
    """, b AS (SELECT user_id, event_id, CASE WHEN value < 50 THEN 1 ELSE 0 END AS bad FROM events),
i AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM b),
r AS (SELECT *, sum(bad) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS consecutive FROM i),
s AS (SELECT *, max(CASE WHEN consecutive >= 7 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS st FROM r)
SELECT user_id, event_id, CAST(consecutive AS BIGINT) AS consecutive FROM s WHERE coalesce(st, 0) = 0"""
)
def run_length_exit(spark, sf_dir):
    ev = a.table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return longs(tables.until_failures(ev, ["user_id"], "event_id", F.col("value") < 50, 7).drop("value"), "consecutive")


@query(
    """, i AS (SELECT match_id, team, minute, player_id, row_number() OVER (PARTITION BY match_id, team ORDER BY minute, player_id) AS k, count(*) OVER (PARTITION BY match_id, team) AS n FROM cards WHERE color = 'yellow'),
o AS (SELECT match_id, team, quantity AS went, player_id AS p2, row_number() OVER (PARTITION BY match_id, team ORDER BY quantity, player_id, l_suppkey) AS k, count(*) OVER (PARTITION BY match_id, team) AS n FROM ev WHERE l_returnflag = 'N')
SELECT match_id, team, CAST(k AS BIGINT) AS k, CAST(minute AS BIGINT) AS minute, player_id, CAST(went AS BIGINT) AS went, p2 FROM i JOIN o USING (match_id, team, k, n)"""
)
def zip_join(spark, sf_dir):
    came = a.cards(spark, sf_dir).filter("color = 'yellow'").select("match_id", "team", "minute", "player_id")
    went = a._events(spark, sf_dir).filter("l_returnflag = 'N'").select("match_id", "team", F.col("quantity").alias("went"), F.col("player_id").alias("p2"), "l_suppkey")
    out = tables.zip_join(came, went, ["match_id", "team"], [F.col("minute"), F.col("player_id")], [F.col("went"), F.col("p2"), F.col("l_suppkey")])
    return longs(out.drop("l_suppkey"), "k", "minute", "went")


@query(
    """, app AS (SELECT match_id, 'Name ' || substr(player_id, 2) AS name, team, shirt, 'id_' || player_id || CASE WHEN season % 2 = 0 THEN '_1' ELSE '' END AS player_id FROM appearances),
e AS (SELECT match_id, CASE WHEN quantity % 4 = 0 THEN 'Unknown' ELSE 'Name ' || substr(player_id, 2) END AS name, CASE WHEN quantity % 3 = 0 THEN 'Nowhere' ELSE team END AS team, CASE WHEN quantity % 5 = 0 THEN NULL ELSE shirt END AS shirt FROM ev WHERE l_returnflag = 'A'),
b1 AS (SELECT DISTINCT name, team, player_id AS i1 FROM app), b2 AS (SELECT DISTINCT match_id, team, shirt, player_id AS i2 FROM app),
b3 AS (SELECT match_id, name, min(player_id) AS i3 FROM app GROUP BY ALL HAVING count(DISTINCT player_id) = 1), b4 AS (SELECT match_id, shirt, min(player_id) AS i4 FROM app GROUP BY ALL HAVING count(DISTINCT player_id) = 1)
SELECT match_id, name, team, CAST(shirt AS BIGINT) AS shirt, coalesce(i1, i2, i3, i4, 'unknown') AS player_id FROM e LEFT JOIN b1 USING (name, team) LEFT JOIN b2 USING (match_id, team, shirt) LEFT JOIN b3 USING (match_id, name) LEFT JOIN b4 USING (match_id, shirt)"""
)
def cascade_ids(spark, sf_dir):
    name = F.concat(F.lit("Name "), F.substring("player_id", 2, 10))
    app = a.appearances(spark, sf_dir).select("match_id", name.alias("name"), "team", "shirt", F.concat(F.lit("id_"), "player_id", F.when(F.col("season") % 2 == 0, "_1").otherwise("")).alias("player_id"))
    q = F.col("quantity")
    ev = a._events(spark, sf_dir).filter("l_returnflag = 'A'").select(
        "match_id", F.when(q % 4 == 0, "Unknown").otherwise(name).alias("name"), F.when(q % 3 == 0, "Nowhere").otherwise(F.col("team")).alias("team"), F.when(q % 5 == 0, None).otherwise(F.col("shirt")).alias("shirt")
    )
    return longs(identity.event_ids(ev, app).select("match_id", "name", "team", "shirt", "player_id"), "shirt")


@query(
    """, app AS (SELECT match_id, 'N' || CAST(CAST(substr(player_id, 2) AS BIGINT) % 40 AS VARCHAR) AS name, team, match_date, match_id * 10000 + shirt * 1000 + CAST(substr(player_id, 2) AS BIGINT) AS ord FROM appearances),
n AS (SELECT *, count(*) OVER (PARTITION BY name, team, match_id, match_date) AS c FROM app),
t AS (SELECT *, max(c) OVER (PARTITION BY name, team) > 1 AS tw, row_number() OVER (PARTITION BY name, team, match_date ORDER BY ord) AS k FROM n),
c AS (SELECT name, team, match_id, match_date, ord, CASE WHEN tw THEN k ELSE 1 END AS cluster FROM t),
p AS (SELECT *, lag(match_date) OVER (PARTITION BY name, team, cluster ORDER BY match_date, ord) AS prev FROM c)
SELECT name, team, match_id, ord, CAST(cluster * 1000 + 1 + sum(CASE WHEN prev IS NOT NULL AND match_date - prev > 180 THEN 1 ELSE 0 END) OVER (PARTITION BY name, team, cluster ORDER BY match_date, ord) AS BIGINT) AS cluster FROM p"""
)
def homonym_stints(spark, sf_dir):
    number = F.substring("player_id", 2, 10).cast("long")
    app = a.appearances(spark, sf_dir).select("match_id", F.concat(F.lit("N"), (number % 40).cast("string")).alias("name"), "team", "match_date", (F.col("match_id") * 10000 + F.col("shirt") * 1000 + number).alias("ord"))
    out = identity.split_stints(identity.same_day_clusters(app))
    return longs(out.select("name", "team", "match_id", "ord", "cluster"), "cluster")


@query(None)
def identity_resolution(spark, sf_dir):
    number = F.substring("player_id", 2, 10).cast("long")
    group = F.when(number % 3 == 0, "сениори").when(number % 3 == 1, "пионери").otherwise("младинци")
    app = a.appearances(spark, sf_dir).select(
        "match_id", F.concat(F.lit("Name N"), (number % 40).cast("string")).alias("name"), "team", "match_date", (F.col("match_id") * 10000 + F.col("shirt") * 1000 + number).alias("ord"), group.alias("category")
    )
    return identity.resolve_players(app).select("name", "team", "match_id", "ord", "player_id")


@query(
    """, b AS (SELECT match_id FROM matches WHERE match_id % 11 <> 0 UNION ALL SELECT -1),
m2 AS (SELECT match_id FROM matches WHERE match_id % 101 = 0)
SELECT 'new' AS change, count(*) AS n FROM matches WHERE match_id NOT IN (SELECT match_id FROM b) UNION ALL SELECT 'deleted', count(*) FROM b WHERE match_id NOT IN (SELECT match_id FROM matches)
UNION ALL SELECT 'modified', count(*) FROM matches WHERE match_id IN (SELECT match_id FROM b) AND match_id % 101 = 0"""
)
def set_diff(spark, sf_dir):
    now = a.matches(spark, sf_dir).select("match_id", "goals_home")
    then = now.filter("match_id % 11 <> 0").withColumn("goals_home", F.when(F.col("match_id") % 101 == 0, -1).otherwise(F.col("goals_home")))
    then = then.union(spark.createDataFrame([(-1, 0)], "match_id long, goals_home long"))
    return tables.snapshot_diff(now, then, "match_id", ["goals_home"]).groupBy("change").agg(F.count("*").alias("n"))


SCOPE = """, affected AS (SELECT match_id FROM matches WHERE match_id % 50 = 0 UNION SELECT match_id FROM matches WHERE match_id % 77 = 0 UNION SELECT match_id FROM matches WHERE match_id % 91 = 0)
"""


@query(
    SCOPE
    + """SELECT 'competition' AS kind, competition || '__' || CAST(season AS VARCHAR) AS key FROM matches WHERE match_id IN (SELECT match_id FROM affected) OR match_id % 61 = 0
UNION SELECT 'team', unnest([home, away]) FROM matches WHERE match_id IN (SELECT match_id FROM affected)
UNION SELECT 'player', player_id FROM appearances WHERE match_id IN (SELECT match_id FROM affected)
UNION SELECT 'stadium', 'Ground ' || CAST(round % 7 AS VARCHAR) FROM matches WHERE match_id IN (SELECT match_id FROM affected)
UNION SELECT 'referee', 'Official ' || CAST(l_suppkey % 40 AS VARCHAR) FROM ev WHERE match_id IN (SELECT match_id FROM affected)
UNION SELECT 'staff', 'Coach ' || home FROM matches WHERE match_id IN (SELECT match_id FROM affected)"""
)
def incremental_scope(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    results = m.filter("match_id % 91 = 0").select("match_id", "goals_home", "goals_away")
    affected = incremental.affected_matches(m, m.filter("match_id % 50 <> 0"), m.filter("match_id % 77 = 0"), results, results.limit(0))
    officials = a._events(spark, sf_dir).select("match_id", F.concat(F.lit("Official "), (F.col("l_suppkey") % 40).cast("string")).alias("name"))
    grounds = m.select("match_id", F.concat(F.lit("Ground "), (F.col("round") % 7).cast("string")).alias("ground"))
    staff = m.select("match_id", F.concat(F.lit("Coach "), "home").alias("name"))
    return incremental.affected_scope(m, affected, a.appearances(spark, sf_dir), m.filter("match_id % 61 = 0"), officials, grounds, staff)


@query(
    """, s AS (SELECT match_id, CAST(round % 7 AS BIGINT) AS state FROM matches)
SELECT match_id, CASE WHEN match_id % 5 = 0 AND match_id % 3 = 0 THEN 'skip' WHEN match_id % 5 = 0 THEN 'announcement' WHEN match_id % 3 = 0 AND round % 4 = 3 THEN 'skip'
  WHEN round % 4 = 0 THEN 'skip' WHEN round % 4 = 1 AND match_date > DATE '1996-01-01' THEN 'skip' ELSE 'both' END AS action FROM matches"""
)
def poll_decisions(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    r = F.col("round") % 4
    tracking = m.filter("round % 4 <> 3").select("match_id", F.when(r == 0, "Archived").when(r == 1, "Scheduled").otherwise("Live_Post").alias("state"), F.col("match_date").cast("timestamp").alias("kick_off"))
    now = F.lit("1996-01-01 02:00:00").cast("timestamp")
    return ingest.plan_polls(m.select("match_id"), tracking, m.filter("match_id % 5 = 0"), m.filter("match_id % 3 = 0"), now)


@query(
    """WITH RECURSIVE o AS (SELECT 'm' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 16 AS VARCHAR) AS match_id, ['empty', 'announced', 'no_report', 'empty', 'report'][event_id % 5 + 1] AS outcome,
  row_number() OVER (PARTITION BY user_id, event_id % 16 ORDER BY event_id) AS k FROM events),
s AS (SELECT match_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS state, 0 AS attempts, false AS complete FROM o WHERE k = 1
  UNION ALL SELECT s.match_id, o.k,
    CASE WHEN s.state = 'Archived' THEN s.state WHEN outcome = 'empty' AND attempts + 1 >= 3 THEN 'Archived' WHEN outcome = 'announced' THEN 'Scheduled' WHEN outcome = 'report' THEN 'Archived' ELSE 'Live_Post' END,
    CASE WHEN s.state = 'Archived' THEN attempts WHEN outcome = 'empty' THEN attempts + 1 WHEN outcome = 'announced' THEN 0 ELSE 1 END,
    CASE WHEN s.state = 'Archived' THEN complete ELSE outcome = 'report' END FROM s JOIN o ON o.match_id = s.match_id AND o.k = s.k + 1)
SELECT match_id, max_by(state, k) AS state, CAST(max_by(attempts, k) AS INT) AS attempts, max_by(complete, k) AS complete FROM s GROUP BY match_id""",
    base=False,
)
def state_replay(spark, sf_dir):
    ev = a.table(spark, sf_dir, "events")
    outcomes = F.element_at(F.array(*[F.lit(x) for x in ("empty", "announced", "no_report", "empty", "report")]), (F.col("event_id") % 5 + 1).cast("int"))
    rows = ev.select(F.concat(F.lit("m"), F.col("user_id").cast("string"), F.lit("_"), (F.col("event_id") % 16).cast("string")).alias("match_id"), F.col("event_id").alias("polled"), outcomes.alias("outcome"))
    return ingest.replay(rows)


@query("SELECT CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS scheduled, CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS live_post, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS archived FROM orders", base=False)
def state_counters(spark, sf_dir):
    s = F.col("o_orderstatus")
    return ingest.state_counts(a.table(spark, sf_dir, "orders").select(F.when(s == "O", "Scheduled").when(s == "P", "Live_Post").when(s == "F", "Archived").alias("state")))


@query(
    """, c AS (SELECT home, away, CAST(round % 6 + 1 AS VARCHAR) AS round FROM matches),
n AS (SELECT home, away, round, count(*) AS matches FROM c GROUP BY ALL),
l AS (SELECT *, max(CASE WHEN matches = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY home, away ORDER BY CAST(round AS INT) ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM n)
SELECT home, away, round, matches, CASE WHEN matches = 1 THEN CASE WHEN later = 1 THEN 'cup_round_1_2' ELSE 'cup_round_final' END
  WHEN 2 * matches > 16 THEN 'cup_round_1_16' WHEN 2 * matches > 8 THEN 'cup_round_1_8' WHEN 2 * matches > 4 THEN 'cup_round_1_4' ELSE 'cup_round_1_2' END AS round_key FROM l"""
)
def cup_round_infer(spark, sf_dir):
    """All matches of a pair of teams as one cup, so that brackets of every size occur."""
    cup = a.matches(spark, sf_dir).withColumn("round", F.col("round") % 6 + 1)
    return longs(cup_round_keys(cup, ["home", "away"]), "matches")


@query(
    """, v AS (SELECT DISTINCT CASE round % 10 WHEN 0 THEN '1/64' WHEN 1 THEN '1/32' WHEN 2 THEN '1/16' WHEN 3 THEN '1/8' WHEN 4 THEN '1/4' WHEN 5 THEN '1/2' WHEN 6 THEN '3/4' WHEN 7 THEN 'Ф' WHEN 8 THEN CAST(round AS VARCHAR) ELSE 'x' END AS name FROM matches)
SELECT name, CAST(CASE name WHEN '1/64' THEN 1 WHEN '1/32' THEN 2 WHEN '1/16' THEN 3 WHEN '1/8' THEN 4 WHEN '1/4' THEN 5 WHEN '1/2' THEN 6 WHEN '3/4' THEN 6.5 WHEN 'Ф' THEN 7 WHEN 'x' THEN 99 ELSE CAST(name AS DOUBLE) END AS DOUBLE) AS ord FROM v"""
)
def round_ordering(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("1/64", "1/32", "1/16", "1/8", "1/4", "1/2", "3/4", "Ф")])
    r = F.col("round") % 10
    rows = a.matches(spark, sf_dir).select(F.when(r < 8, F.get(names, r.cast("int"))).when(r == 8, F.col("round").cast("string")).otherwise("x").alias("name")).distinct()
    return rows.withColumn("ord", round_order(F.col("name")))


@query(
    """, c AS (SELECT match_id, minute AS m FROM goals)
SELECT CAST(m AS BIGINT) AS minute, CASE WHEN m > 140 THEN substr(CAST(m AS VARCHAR), 1, 2) || '+' || substr(CAST(m AS VARCHAR), 3) ELSE CAST(m AS VARCHAR) END AS shown,
  CAST(CASE WHEN m > 140 THEN CAST(substr(CAST(m AS VARCHAR), 1, 2) AS INT) ELSE m END AS DOUBLE) AS base,
  round(CASE WHEN m > 140 THEN CAST(substr(CAST(m AS VARCHAR), 1, 2) AS DOUBLE) + CAST(substr(CAST(m AS VARCHAR), 3) AS DOUBLE) / 1000 ELSE m END, 4) AS sort_key, count(*) AS n FROM c GROUP BY ALL"""
)
def minute_codec(spark, sf_dir):
    m = F.col("minute")
    rows = a.goals(spark, sf_dir).select(m.cast("long").alias("minute"), show_minute(m).alias("shown"), base_minute(m).alias("base"), F.round(sort_minute(m), 4).alias("sort_key"))
    return rows.groupBy("minute", "shown", "base", "sort_key").agg(F.count("*").alias("n"))


@query(
    """, s AS (SELECT match_id, player_id, kind, min(CASE WHEN minute > 140 THEN 45.002 ELSE minute END) AS first,
    string_agg(CASE WHEN minute > 140 THEN '45+2' ELSE CAST(minute AS VARCHAR) END, ', ' ORDER BY CASE WHEN minute > 140 THEN 45.002 ELSE minute END) AS minutes FROM goals GROUP BY ALL)
SELECT match_id, player_id, kind, minutes, row_number() OVER (PARTITION BY match_id ORDER BY first, player_id, kind) AS place FROM s"""
)
def goals_in_match(spark, sf_dir):
    return longs(presence.goals_in_match(a.goals(spark, sf_dir)).drop("first"), "place")


@query(
    """, e AS (SELECT match_id, minute, kind AS event, player_id, credited AS team, 1 AS p FROM goals UNION ALL SELECT match_id, minute, color, player_id, team, 2 FROM cards
  UNION ALL SELECT match_id, quantity, 'substitution', player_id, team, 3 FROM ev WHERE l_returnflag = 'N' AND shirt > 4),
s AS (SELECT e.*, e.team = home AS at_home, CASE WHEN minute > 140 THEN 45.002 ELSE minute END AS k FROM e JOIN matches USING (match_id))
SELECT match_id, event, at_home, CASE WHEN minute > 140 THEN '45+2' ELSE CAST(minute AS VARCHAR) END AS shown, row_number() OVER (PARTITION BY match_id ORDER BY k, p, event, player_id, team) AS place FROM s"""
)
def match_timeline(spark, sf_dir):
    subs = a._events(spark, sf_dir).filter("l_returnflag = 'N' and shirt > 4").select("match_id", F.col("quantity").alias("minute"), "player_id", "team")
    rows = masters.timeline(a.matches(spark, sf_dir), a.goals(spark, sf_dir), a.cards(spark, sf_dir), subs)
    return longs(rows.select("match_id", "event", "at_home", "shown", "place"), "place")


@query(
    """SELECT match_id, CASE WHEN cancelled THEN 'cancelled' ELSE CAST(goals_home AS VARCHAR) || ' - ' || CAST(goals_away AS VARCHAR) || CASE WHEN goals_home = goals_away THEN ' (' || CAST(round % 6 AS VARCHAR) || ' - ' || CAST(match_id % 4 AS VARCHAR) || ')' ELSE '' END || CASE WHEN official THEN '*' ELSE '' END END AS score FROM matches"""
)
def display_score(spark, sf_dir):
    tied = F.col("goals_home") == F.col("goals_away")
    text = score_text(F.col("goals_home"), F.col("goals_away"), F.col("cancelled"), F.col("official"), F.when(tied, F.col("round") % 6), F.when(tied, F.col("match_id") % 4))
    return a.matches(spark, sf_dir).select("match_id", text.alias("score"))


@query("SELECT match_date, CAST(season AS BIGINT) AS season, lpad(CAST(season % 100 AS VARCHAR), 2, '0') || '/' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS label, count(*) AS n FROM matches GROUP BY ALL")
def season_of_date(spark, sf_dir):
    from touchline.functions.calendar import season_label, season_start

    day = F.col("match_date")
    return a.matches(spark, sf_dir).groupBy("match_date", season_start(day).cast("long").alias("season"), season_label(season_start(day)).alias("label")).agg(F.count("*").alias("n"))


@query(
    """, x AS (SELECT competition, season, team, CAST(sum(gf) AS BIGINT) AS gf, at_home FROM sides GROUP BY ALL)
SELECT competition, season, team, max(CASE WHEN at_home THEN gf END) AS home, max(CASE WHEN NOT at_home THEN gf END) AS away FROM x GROUP BY ALL"""
)
def pivot_wide(spark, sf_dir):
    s = standings.sides(a.matches(spark, sf_dir)).withColumn("side", F.when(F.col("at_home"), "home").otherwise("away"))
    return longs(s.groupBy("competition", "season", "team").pivot("side", ["home", "away"]).agg(F.sum("gf")), "home", "away")


@query(
    """, c AS (SELECT p_partkey, p_size, CAST(floor(p_retailprice) AS BIGINT) % 50 AS x, p_partkey % 50 AS y FROM part)
SELECT p_partkey, CASE WHEN p_size >= x AND p_size >= y THEN 'p_size' WHEN x >= y THEN 'x' ELSE 'y' END AS best FROM c"""
)
def argmax_columns(spark, sf_dir):
    rows = a.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("long").alias("p_size"), (F.floor("p_retailprice") % 50).alias("x"), (F.col("p_partkey") % 50).alias("y"))
    return rows.select("p_partkey", tables.argmax_column(["p_size", "x", "y"]).alias("best"))


@query(
    """, g AS (SELECT DISTINCT competition, season, home AS team FROM matches), sp AS (SELECT competition, season, CAST(min(round) AS BIGINT) AS lo, CAST(max(round) AS BIGINT) AS hi, home FROM matches GROUP BY ALL),
q AS (SELECT competition, season, home, unnest(generate_series(lo, hi)) AS round FROM sp)
SELECT competition, season, home, CAST(round AS BIGINT) AS round FROM q WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.competition = q.competition AND m.season = q.season AND m.home = q.home AND m.round = q.round)"""
)
def missing_rounds(spark, sf_dir):
    return longs(tables.missing_numbers(a.matches(spark, sf_dir), ["competition", "season", "home"], "round", F.min("round"), F.max("round")), "round")


@query("SELECT competition, season, max(round) AS latest, count(*) AS n, count(DISTINCT home) AS teams FROM matches GROUP BY ALL")
def latest_round(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    latest = tables.latest_of(m, ["competition", "season"], "round").withColumnRenamed("round", "latest")
    return latest.join(m.groupBy("competition", "season").agg(F.count("*").alias("n"), F.count_distinct("home").alias("teams")), ["competition", "season"])


@query(
    """, d AS (SELECT DISTINCT competition || CASE WHEN round % 3 = 0 THEN ' (A)' WHEN round % 3 = 1 THEN ' (B)' ELSE ' Куп' END AS competition, season FROM matches),
e AS (SELECT *, trim(regexp_replace(competition, '\\s*\\([^)]*\\)\\s*$', '')) AS base_name, nullif(regexp_extract(competition, '\\(([^)]*)\\)$', 1), '') AS group_label, competition LIKE '%Куп' AS cup FROM d)
SELECT *, replace(regexp_replace(regexp_replace(replace(lower(competition), 'куп', 'kup'), '[\\s/]+', '_', 'g'), '[^a-z0-9_\\-]+', '', 'g'), '__', '_') || '_' || CAST(season AS VARCHAR) AS competition_id, CAST(season AS INT) AS start_year,
  count(*) OVER (PARTITION BY season, base_name) > 1 AS nested, CAST(row_number() OVER (ORDER BY season DESC, cup, base_name, competition) AS BIGINT) AS sort_order FROM e"""
)
def competition_dimension(spark, sf_dir):
    r = F.col("round") % 3
    m = a.matches(spark, sf_dir).withColumn("competition", F.concat("competition", F.when(r == 0, " (A)").when(r == 1, " (B)").otherwise(" Куп")))
    return longs(masters.competitions(m), "sort_order")


GROUPS = (
    ("1-Urgent 25/26", None, "A", 0, 5), ("1-urgent", " ", "B", 4, 9), ("2-HIGH", "1994", "A", 0, 3), ("2-HIGH", "1994", "B", 2, 7), ("2-HIGH", "1996", "C", 7, 7),
    ("3-MEDIUM", None, "A", 6, 8), ("3-MEDIUM", None, "B", 0, 11), ("3-MEDIUM", None, "C", 0, 11),
)


@query(
    """, gr(k, ord, season, label, lo, hi) AS (VALUES ('1-urgent', 0, NULL, 'A', 0, 5), ('1-urgent', 1, NULL, 'B', 4, 9), ('2-high', 2, 1994, 'A', 0, 3), ('2-high', 3, 1994, 'B', 2, 7), ('2-high', 4, 1996, 'C', 7, 7),
  ('3-medium', 5, NULL, 'A', 6, 8), ('3-medium', 6, NULL, 'B', 0, 11), ('3-medium', 7, NULL, 'C', 0, 11)),
nm AS (SELECT match_id, season, lower(competition) AS k, CASE match_id % 4 WHEN 0 THEN competition || ' 25/26' WHEN 1 THEN lower(competition) WHEN 2 THEN competition || ' (X)' ELSE competition END AS competition,
  CAST(substr(home, 6) AS INT) AS h, CAST(substr(away, 6) AS INT) AS a FROM matches),
j AS (SELECT match_id, ord, label, h BETWEEN lo AND hi AS hin, a BETWEEN lo AND hi AS ain FROM nm JOIN gr ON nm.k = gr.k AND (gr.season IS NULL OR gr.season = nm.season) WHERE (h BETWEEN lo AND hi OR a BETWEEN lo AND hi) AND match_id % 4 <> 2),
r AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY ord) AS rn FROM j),
f AS (SELECT match_id, min_by(label, ord) FILTER (rn > 1 AND hin AND ain) AS both_teams, min_by(label, ord) FILTER (rn = 1) AS first_label, bool_or(hin AND rn = 1) AS first_home, min_by(label, ord) FILTER (rn > 1 AND hin) AS home_team FROM r GROUP BY 1)
SELECT match_id, competition || coalesce(' (' || coalesce(both_teams, CASE WHEN first_home THEN first_label END, home_team, first_label) || ')', '') AS competition FROM nm LEFT JOIN f USING (match_id)"""
)
def competition_groups(spark, sf_dir):
    k, c = F.col("match_id") % 4, F.col("competition")
    name = F.when(k == 0, F.concat(c, F.lit(" 25/26"))).when(k == 1, F.lower(c)).when(k == 2, F.concat(c, F.lit(" (X)"))).otherwise(c)
    m = a.matches(spark, sf_dir).withColumn("competition", name)
    rows = [(*g[:3], [f" team {t:02d}" for t in range(g[3], g[4] + 1)], i) for i, g in enumerate(GROUPS)]
    groups = spark.createDataFrame(rows, "competition string, season string, label string, teams array<string>, ord int")
    return masters.into_groups(m, groups).select("match_id", "competition")


@query(
    """SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'home' WHEN o_orderkey % 4 = 1 THEN 'away' WHEN o_orderkey % 4 = 2 THEN 'home' ELSE 'away' END AS side FROM orders""",
    base=False,
)
def side_attribution(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    r = F.col("match_id") % 4
    club = F.when(r == 0, F.col("home")).when(r == 1, F.concat(F.lit("  "), F.upper("away"))).when(r == 2, F.concat(F.col("home"), F.lit(" II"))).otherwise(F.regexp_replace("away", " ", ""))
    return m.select(F.col("match_id").alias("id"), masters.side_of(club, F.col("home"), F.col("away")).alias("side"))


@query(
    """, l AS (SELECT player_id, match_id, team, shirt, starter, duration FROM appearances),
s AS (SELECT match_id, team, minute, sin, sout, ord FROM (SELECT match_id, team, quantity AS minute, shirt AS sin, (shirt + 1) % 7 + 1 AS sout, l_suppkey * 100000 + quantity * 10 + shirt AS ord FROM ev WHERE l_returnflag = 'N' AND shirt > 4)),
i AS (SELECT match_id, team, sin AS shirt, max_by(minute, ord) AS m FROM s GROUP BY ALL), o AS (SELECT match_id, team, sout AS shirt, max_by(minute, ord) AS m FROM s GROUP BY ALL),
j AS (SELECT l.*, coalesce(i.m, CASE WHEN starter THEN 0 END) AS min_in, coalesce(o.m, CASE WHEN starter THEN duration ELSE 0 END) AS e, o.m IS NOT NULL AS substituted FROM l LEFT JOIN i USING (match_id, team, shirt) LEFT JOIN o USING (match_id, team, shirt)),
k AS (SELECT *, CASE WHEN min_in IS NOT NULL AND NOT starter AND e = 0 THEN duration ELSE e END AS min_out FROM j)
SELECT match_id, team, player_id, CAST(min_in AS BIGINT) AS min_in, CAST(min_out AS BIGINT) AS min_out, CAST(greatest(0, least(duration, CASE WHEN min_in IS NULL THEN 0 ELSE min_out - min_in END)) AS BIGINT) AS minutes, substituted FROM k"""
)
def minutes_from_substitutions(spark, sf_dir):
    line = a.appearances(spark, sf_dir).select("player_id", "match_id", "team", "shirt", "starter")
    ev = a._events(spark, sf_dir).filter("l_returnflag = 'N' and shirt > 4")
    text = F.format_string("Entra X (%d) por Y (%d)", F.col("shirt"), (F.col("shirt") + 1) % 7 + 1)
    subs = presence.parse_substitutions(ev.select("match_id", "team", F.col("quantity").alias("minute"), text.alias("text"), (F.col("l_suppkey") * 100000 + F.col("quantity") * 10 + F.col("shirt")).alias("ord")))
    out = presence.minutes_played(line, subs, a.matches(spark, sf_dir).select("match_id", "duration"))
    return longs(out.select("match_id", "team", "player_id", "min_in", "min_out", "minutes", "substituted"), "min_in", "min_out", "minutes")


@query(
    """, r AS (SELECT competition, season, home AS team, '[' || string_agg('{"match_id":' || CAST(match_id AS VARCHAR) || ',"away":"' || away || '","score":null}', ',' ORDER BY round, match_id) || ']' AS model FROM matches GROUP BY ALL) SELECT * FROM r"""
)
def page_json(spark, sf_dir):
    rows = a.matches(spark, sf_dir).withColumn("score", F.lit(None).cast("string")).withColumnRenamed("home", "team")
    return tables.json_rows(rows, ["competition", "season", "team"], ["round", "match_id"], ["match_id", "away", "score"], "model")


@query(
    """, d AS (SELECT competition, 60 + CAST(substr(competition, 1, 1) AS BIGINT) AS x FROM matches), c AS (SELECT CASE CAST(substr(competition, 1, 1) AS BIGINT) WHEN 1 THEN 'Кадети' WHEN 2 THEN 'Младинци' WHEN 3 THEN 'Петлиња' ELSE 'Сениори' END AS category FROM matches)
SELECT category, CAST(CASE category WHEN 'Кадети' THEN 60 WHEN 'Сениори' THEN 90 ELSE 80 END AS BIGINT) AS duration, count(*) AS n FROM c GROUP BY ALL"""
)
def category_durations(spark, sf_dir):
    from touchline.functions.labels import category

    k = F.substring("competition", 1, 1).cast("int")
    raw = F.when(k == 1, "КАДЕТИ  U14").when(k == 2, "Mladinska liga").when(k == 3, "Петлиња").otherwise("СЕНИОРИ")
    rows = a.matches(spark, sf_dir).select(category(raw).alias("category"))
    return longs(rows.groupBy("category", match_duration(F.col("category")).alias("duration")).agg(F.count("*").alias("n")), "duration")
