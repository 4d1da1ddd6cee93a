"""Match tables derived from the order tables, and the same definitions as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.calendar import season_start
from touchline.operators.players import second_yellows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def team_name(n) -> F.Column:
    return F.concat(F.lit("Team "), F.lpad(n.cast("string"), 2, "0"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        key.alias("match_id"),
        F.col("o_orderpriority").alias("competition"),
        season_start(day).cast("long").alias("season"),
        (key % 30 + 1).alias("round"),
        day.alias("match_date"),
        team_name(cust % 12).alias("home"),
        team_name((cust % 12 + 1 + key % 11) % 12).alias("away"),
        (F.floor("o_totalprice") % 6).alias("goals_home"),
        (key % 5).alias("goals_away"),
        ((F.col("o_orderstatus") == "P") & (key % 10 == 0)).alias("cancelled"),
        (key % 17 == 0).alias("official"),
        F.when(F.col("o_orderpriority") == "5-LOW", 60).when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 80).otherwise(90).cast("long").alias("duration"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir).select("match_id", "competition", "season", "match_date", "home", "away", "duration")
    item = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("P"), F.lpad((F.col("l_partkey") % 200).cast("string"), 3, "0")).alias("player_id"),
        F.col("l_linenumber").cast("long").alias("shirt"),
        F.col("l_quantity").cast("long").alias("quantity"),
        "l_suppkey",
        "l_returnflag",
    )
    own = F.when(F.col("shirt") % 2 == 1, F.col("home")).otherwise(F.col("away"))
    other = F.when(F.col("shirt") % 2 == 1, F.col("away")).otherwise(F.col("home"))
    return item.join(m, "match_id").withColumns({"team": own, "opponent": other})


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).groupBy("match_id", "player_id", "team", "competition", "season", "match_date", "duration").agg(
        F.min("shirt").alias("shirt"), F.min(F.when(F.col("shirt") <= 4, 0).otherwise(F.col("quantity"))).alias("min_in")
    )
    return rows.withColumns(
        {"ord": F.col("shirt"), "starter": F.col("shirt") <= 4, "min_out": F.col("duration"), "minutes": F.greatest(F.lit(0), F.col("duration") - F.col("min_in")), "substituted": F.lit(False)}
    )


def goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own_goal = F.col("l_suppkey") % 20 == 0
    return _events(spark, sf_dir).filter("l_returnflag = 'A'").select(
        "match_id", "player_id", "competition", "season",
        F.when(own_goal, "own_goal").otherwise("normal").alias("kind"),
        F.when(F.col("quantity") == 45, 452).otherwise(F.col("quantity") + 1).alias("minute"),
        F.when(own_goal, F.col("opponent")).otherwise(F.col("team")).alias("credited"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_suppkey") % 5 == 0, "second_yellow").when(F.col("l_suppkey") % 7 == 0, "red").otherwise("yellow")
    rows = _events(spark, sf_dir).filter("l_returnflag = 'R'").select("match_id", "player_id", "competition", "season", "team", (F.col("quantity") + 1).alias("minute"), kind.alias("card"))
    return second_yellows(rows)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Withdrawal rules from nations: competition, club, from_round."""
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.element_at(names, (F.col("n_regionkey") + 1).cast("int")).alias("competition"), F.concat(F.lit("FK  team "), F.lpad((k % 12).cast("string"), 2, "0")).alias("club"), (k + 10).alias("from_round")
    )


def sanctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.element_at(names, (F.col("n_regionkey") + 1).cast("int")).alias("competition"), (F.lit(1993) + k % 5).cast("long").alias("season"), team_name(k % 12).alias("team"), (k % 4).cast("long").alias("points")
    )


SQL = """
WITH matches AS (
  SELECT o_orderkey AS match_id, o_orderpriority AS competition,
    CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS BIGINT) AS season,
    o_orderkey % 30 + 1 AS round, CAST(o_orderdate AS DATE) AS match_date,
    'Team ' || lpad(CAST(o_custkey % 12 AS VARCHAR), 2, '0') AS home,
    'Team ' || lpad(CAST((o_custkey % 12 + 1 + o_orderkey % 11) % 12 AS VARCHAR), 2, '0') AS away,
    CAST(floor(o_totalprice) AS BIGINT) % 6 AS goals_home, o_orderkey % 5 AS goals_away,
    (o_orderstatus = 'P' AND o_orderkey % 10 = 0) AS cancelled, (o_orderkey % 17 = 0) AS official,
    CAST(CASE o_orderpriority WHEN '5-LOW' THEN 60 WHEN '4-NOT SPECIFIED' THEN 80 ELSE 90 END AS BIGINT) AS duration
  FROM orders),
ev AS (
  SELECT l_orderkey AS match_id, 'P' || lpad(CAST(l_partkey % 200 AS VARCHAR), 3, '0') AS player_id, CAST(l_linenumber AS BIGINT) AS shirt,
    CAST(l_quantity AS BIGINT) AS quantity, l_suppkey, l_returnflag, competition, season, match_date, duration, home, away,
    CASE WHEN l_linenumber % 2 = 1 THEN home ELSE away END AS team, CASE WHEN l_linenumber % 2 = 1 THEN away ELSE home END AS opponent
  FROM lineitem JOIN matches ON l_orderkey = match_id),
appearances AS (
  SELECT *, shirt <= 4 AS starter, greatest(0, duration - min_in) AS minutes, duration AS min_out FROM (
    SELECT match_id, player_id, team, competition, season, match_date, duration, min(shirt) AS shirt, min(CASE WHEN shirt <= 4 THEN 0 ELSE quantity END) AS min_in
    FROM ev GROUP BY ALL)),
goals AS (
  SELECT match_id, player_id, competition, season, CASE WHEN l_suppkey % 20 = 0 THEN 'own_goal' ELSE 'normal' END AS kind,
    CASE WHEN quantity = 45 THEN 452 ELSE quantity + 1 END AS minute, CASE WHEN l_suppkey % 20 = 0 THEN opponent ELSE team END AS credited
  FROM ev WHERE l_returnflag = 'A'),
card_events AS (
  SELECT *, quantity + 1 AS minute, CASE WHEN l_suppkey % 5 = 0 THEN 'second_yellow' WHEN l_suppkey % 7 = 0 THEN 'red' ELSE 'yellow' END AS card
  FROM ev WHERE l_returnflag = 'R'),
cards AS (
  SELECT match_id, player_id, competition, season, team, minute, 'yellow' AS color FROM card_events WHERE card <> 'red'
  UNION ALL SELECT match_id, player_id, competition, season, team, minute, 'red' FROM card_events WHERE card <> 'yellow'),
rules AS (
  SELECT ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][n_regionkey + 1] AS competition,
    'Team ' || lpad(CAST(n_nationkey % 12 AS VARCHAR), 2, '0') AS club, n_nationkey + 10 AS from_round FROM nation),
sanctions AS (
  SELECT ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][n_regionkey + 1] AS competition, CAST(1993 + n_nationkey % 5 AS BIGINT) AS season,
    'Team ' || lpad(CAST(n_nationkey % 12 AS VARCHAR), 2, '0') AS team, CAST(n_nationkey % 4 AS BIGINT) AS points FROM nation),
sides AS (
  SELECT match_id, competition, season, cancelled, home AS team, away AS opponent, true AS at_home,
    CASE WHEN official THEN CASE WHEN goals_home >= goals_away THEN 3 ELSE 0 END ELSE goals_home END AS gf,
    CASE WHEN official THEN CASE WHEN goals_away > goals_home THEN 3 ELSE 0 END ELSE goals_away END AS ga FROM matches
  UNION ALL SELECT match_id, competition, season, cancelled, away, home, false,
    CASE WHEN official THEN CASE WHEN goals_away > goals_home THEN 3 ELSE 0 END ELSE goals_away END,
    CASE WHEN official THEN CASE WHEN goals_home >= goals_away THEN 3 ELSE 0 END ELSE goals_home END FROM matches)
"""
