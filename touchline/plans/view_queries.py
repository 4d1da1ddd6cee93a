"""Queries of the view operators, each with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import players, presence, standings, views
from touchline.plans import analogs as a
from touchline.plans.match_queries import _conceded, _keepers, CONCEDED, longs, query, TABLE

NAMES = ("Суперлига", "Прва лига", "КУП", "Куп елиминација", "Втора лига", "Бараж за Прва", "ОФЛ Скопје", "Куп ОФС", "Друго")
_NAME = "['Суперлига', 'Прва лига', 'КУП', 'Куп елиминација', 'Втора лига', 'Бараж за Прва', 'ОФЛ Скопје', 'Куп ОФС', 'Друго'][CAST(match_id % 9 AS INT) + 1]"


def name_of(key: str):
    return F.element_at(F.array(*[F.lit(x) for x in NAMES]), (F.col(key) % 9 + 1).cast("int"))


@query(
    f"""SELECT {_NAME} AS competition, CAST(CASE match_id % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 3.1 WHEN 4 THEN 4 WHEN 5 THEN 2.2 WHEN 6 THEN 6 WHEN 7 THEN 8 ELSE 7 END AS DOUBLE) AS ord, count(*) AS n FROM matches GROUP BY ALL"""
)
def archive_order(spark, sf_dir):
    rows = a.matches(spark, sf_dir).select(name_of("match_id").alias("competition"))
    return rows.groupBy("competition", views.competition_order(F.col("competition")).alias("ord")).agg(F.count("*").alias("n"))


@query(
    """, c AS (SELECT match_id, count(*) FILTER (credited = home) AS h, count(*) FILTER (credited = away) AS w FROM goals JOIN matches USING (match_id) GROUP BY ALL)
SELECT match_id, CAST(coalesce(h, goals_home) AS BIGINT) AS goals_home, CAST(coalesce(w, goals_away) AS BIGINT) AS goals_away FROM matches LEFT JOIN c USING (match_id)"""
)
def score_from_goals(spark, sf_dir):
    return longs(views.score_from_goals(a.matches(spark, sf_dir), a.goals(spark, sf_dir)).select("match_id", "goals_home", "goals_away"), "goals_home", "goals_away")


@query(
    """SELECT match_id, coalesce(a.n_regionkey, b.n_regionkey) AS region FROM (SELECT match_id, CASE WHEN match_id % 3 = 0 THEN 'k' || CAST(match_id % 30 AS VARCHAR) ELSE 'c' || CAST(match_id % 40 AS VARCHAR) END AS k FROM matches) m
LEFT JOIN (SELECT 'k' || CAST(n_nationkey AS VARCHAR) AS k, n_regionkey FROM nation) a USING (k) LEFT JOIN (SELECT 'c' || CAST(n_nationkey AS VARCHAR) AS k, n_regionkey FROM nation) b USING (k)"""
)
def either_key_lookup(spark, sf_dir):
    m = F.col("match_id")
    rows = a.matches(spark, sf_dir).select("match_id", F.when(m % 3 == 0, F.concat(F.lit("k"), (m % 30).cast("string"))).otherwise(F.concat(F.lit("c"), (m % 40).cast("string"))).alias("k"))
    n = F.col("n_nationkey").cast("string")
    dim = a.table(spark, sf_dir, "nation").select(F.concat(F.lit("k"), n).alias("key"), F.concat(F.lit("c"), n).alias("mk"), F.col("n_regionkey").alias("region"))
    return views.either_key(rows, "k", dim, ("key", "mk"), "region").select("match_id", "region")


MENU = {
    "Прва лига": "first", "PRVA LIGA": "first", "Втора лига": "second", "Куп на РМ": "national_cup", "Kup na рм 25": "national_cup", "Трета лига": "third", "Куп Битола": "regional_cup", "Суперлига": "municipal",
    "ОФЛ Скопје А1": "municipal", "Бараж за Прва": None, "Куп на РМ елиминација": None, "Пријателски": None, "Прва Junior лига": None, "ФФМ лига": None,
}


@query(
    ", n(i, name, bucket) AS (VALUES " + ", ".join(f"({i}, '{n}', {repr(b) if b else 'NULL'})" for i, (n, b) in enumerate(MENU.items())) + f""")
SELECT DISTINCT CAST(season AS BIGINT) AS season, bucket, name AS competition FROM matches JOIN n ON match_id % {len(MENU)} = i WHERE bucket IS NOT NULL AND match_id % 5 <> 4"""
)
def navigation_buckets(spark, sf_dir):
    k, names = F.col("match_id"), F.array(*[F.lit(x) for x in MENU])
    rows = a.matches(spark, sf_dir).select(F.col("season").cast("string").alias("season"), F.get(names, (k % len(MENU)).cast("int")).alias("competition"), F.when(k % 5 == 4, "КАДЕТИ").otherwise("Сениори  ").alias("category"))
    return views.navigation(rows.distinct(), F.col("season")).select(F.col("season").cast("long").alias("season"), "bucket", "competition").distinct()


@query(
    """SELECT match_id, CASE match_id % 4 WHEN 0 THEN 'timovi/x-' || CAST(match_id AS VARCHAR) || '.html' WHEN 1 THEN 'natprevaruvanja/' || CAST(match_id AS VARCHAR) || '.html' WHEN 2 THEN '#' ELSE 'staff/a.html' END AS path,
  CASE WHEN match_id % 5 = 0 THEN CAST(match_id AS VARCHAR) WHEN match_id % 5 = 1 THEN competition ELSE competition || '__' || CAST(season AS VARCHAR) END AS cid FROM matches"""
)
def links_and_ids(spark, sf_dir):
    m = F.col("match_id")
    s = m.cast("string")
    target = F.when(m % 4 == 0, F.concat(F.lit("equipo-x-"), s)).when(m % 4 == 1, F.concat(F.lit("menu-competicion-"), s)).when(m % 4 == 2, F.lit("menu-x")).otherwise("staff-a")
    cid = views.competition_id([F.when(m % 5 == 0, m)], F.col("competition"), F.when(m % 5 == 1, " ").otherwise(F.col("season").cast("string")))
    return a.matches(spark, sf_dir).select("match_id", views.target_path(target).alias("path"), cid.alias("cid"))


@query(
    TABLE
    + """, p AS (SELECT *, row_number() OVER (PARTITION BY competition, season ORDER BY points DESC, gd DESC, gf DESC, team) AS pos FROM t),
s AS (SELECT competition, season, '[' || string_agg('{"pos":' || CAST(pos AS VARCHAR) || ',"team":"' || team || '","played":' || CAST(played AS VARCHAR) || ',"points":' || CAST(CAST(points AS BIGINT) AS VARCHAR) || ',"gd":' || CAST(CAST(gd AS BIGINT) AS VARCHAR) || '}', ',' ORDER BY pos) || ']' AS standings FROM p GROUP BY ALL),
m AS (SELECT competition, season, '[' || string_agg('{"match_id":' || CAST(match_id AS VARCHAR) || ',"round":' || CAST(round AS VARCHAR) || ',"home":"' || home || '","away":"' || away || '","goals_home":' || CAST(goals_home AS VARCHAR) || ',"goals_away":' || CAST(goals_away AS VARCHAR) || '}', ',' ORDER BY round, match_id) || ']' AS matches FROM matches GROUP BY ALL)
SELECT competition, season, m.matches, standings FROM m LEFT JOIN s USING (competition, season)"""
)
def competition_hub(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    return views.competition_hub(m, standings.league_table(m))


@query(
    CONCEDED
    + """, sc AS (SELECT player_id, competition, season, count(*) AS goals FROM goals WHERE kind = 'normal' GROUP BY ALL),
cd AS (SELECT player_id, competition, season, count(*) FILTER (color = 'yellow') AS yellows, count(*) FILTER (color = 'red') AS reds FROM cards GROUP BY ALL),
kt AS (SELECT player_id, competition, season, sum(ga) AS ga, count(*) FILTER (min_in <= 0 AND min_out >= duration AND ga = 0) AS cs, sum(minutes) AS minutes, CASE WHEN bool_or(duration = 60) THEN 60 WHEN bool_or(duration = 80) THEN 80 ELSE 90 END AS base FROM per GROUP BY ALL),
u AS (SELECT competition, season, 'scorers' AS kind, player_id, row_number() OVER (PARTITION BY competition, season ORDER BY goals DESC, player_id) AS place FROM sc
  UNION ALL SELECT competition, season, 'cards', player_id, row_number() OVER (PARTITION BY competition, season ORDER BY reds DESC, yellows DESC, player_id) FROM cd
  UNION ALL SELECT competition, season, 'keepers', player_id, row_number() OVER (PARTITION BY competition, season ORDER BY cs DESC, CASE WHEN minutes > 0 THEN round(CAST(ga AS DOUBLE) / minutes * base, 6) ELSE 0 END, minutes DESC, player_id) FROM kt)
SELECT competition, season, kind, CAST(place AS BIGINT) AS place, player_id FROM u WHERE place <= 5"""
)
def top_tables(spark, sf_dir):
    scorers = players.goal_counts(a.goals(spark, sf_dir), ["player_id", "competition", "season"])
    keepers = presence.keeper_table(presence.keeper_matches(_keepers(spark, sf_dir), _conceded(spark, sf_dir)))
    return longs(views.top_tables(scorers, players.discipline(a.cards(spark, sf_dir)), keepers), "place")
