"""Queries of the master tables, sources and small functions that the other modules do not reach, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import calendar, labels, text
from touchline.operators import identity, incremental, masters, players, standings, tables, views
from touchline.plans import analogs as a
from touchline.plans.match_queries import longs, query
from touchline.sources import match_pages


@query(
    """, p AS (SELECT match_id, count(*) FILTER (team = home) AS lineup_home, count(*) FILTER (team = away) AS lineup_away, count(*) FILTER (starter) AS starters FROM appearances JOIN matches USING (match_id, competition, season, match_date, duration) GROUP BY 1),
g AS (SELECT match_id, count(*) FILTER (credited = home) AS h, count(*) FILTER (credited = away) AS w, count(*) AS n, sum(minute) AS minutes FROM goals JOIN matches USING (match_id, competition, season) GROUP BY 1),
c AS (SELECT match_id, count(*) AS cards FROM cards GROUP BY 1)
SELECT CAST(match_id AS VARCHAR) AS match_id, competition, home, away, CAST(coalesce(h, goals_home) AS BIGINT) AS goals_home, CAST(coalesce(w, goals_away) AS BIGINT) AS goals_away, CAST(round AS VARCHAR) AS round,
  strftime(match_date, '%d.%m.%Y') AS day, lineup_home, lineup_away, starters, CAST(coalesce(n, 0) AS BIGINT) AS n_goals, CAST(coalesce(minutes, 0) AS BIGINT) AS minutes, CAST(coalesce(cards, 0) AS BIGINT) AS n_cards
FROM matches JOIN p USING (match_id) LEFT JOIN g USING (match_id) LEFT JOIN c USING (match_id)"""
)
def page_records(spark, sf_dir):
    """Report and announcement pages of every match, written out from the tables and read back."""
    ev, m = a._events(spark, sf_dir), a.matches(spark, sf_dir)
    own_goal, minute = F.col("l_suppkey") % 20 == 0, F.when(F.col("quantity") == 45, "45+2").otherwise((F.col("quantity") + 1).cast("string"))
    card = F.when(F.col("l_suppkey") % 5 == 0, "second_yellow").when(F.col("l_suppkey") % 7 == 0, "red").otherwise("yellow")
    kind = F.when(F.col("l_returnflag") == "A", F.when(own_goal, "own_goal").otherwise("goal")).when(F.col("l_returnflag") == "R", card)
    when = F.when(F.col("l_returnflag") == "A", minute).otherwise((F.col("quantity") + 1).cast("string"))
    event = F.when(kind.isNotNull(), F.concat(F.lit('<div class="ffm-rez__evt '), kind, F.lit('"><i></i><span>'), when, F.lit("'</span></div>"))).otherwise("")
    rows = ev.groupBy("match_id", "team", "home", "player_id").agg(F.min("shirt").alias("shirt"), F.array_join(F.array_sort(F.collect_list(event)), "").alias("events"))
    row = F.concat(
        F.lit('<div class="ffm-rez__start"><div class="ffm-rez__name"><span>'), "player_id", F.lit("</span> <span>"), F.col("shirt").cast("string"),
        F.lit('</span></div><div class="ffm-rez__evts">'), "events", F.lit("</div></div>"),
    )
    place = F.when(F.col("team") == F.col("home"), 0).otherwise(1) + F.when(F.col("shirt") <= 4, 0).otherwise(2)
    columns = rows.groupBy("match_id").agg(*[F.array_join(F.array_sort(F.collect_list(F.when(place == i, row))), "").alias(f"c{i}") for i in range(4)])
    day, meta = F.date_format("match_date", "dd.MM.yyyy"), '<div class="ffm-match-meta__details">'
    head = [F.concat(F.lit('<b class="ffm-match-header__name"> '), team, F.lit('</b><i class="ffm-match-header__goal">'), goals.cast("string"), F.lit("</i>")) for team, goals in ((F.col("home"), F.col("goals_home")), (F.col("away"), F.col("goals_away")))]
    details = F.concat(F.lit(meta + "<span>"), F.col("round").cast("string"), F.lit(". коло</span><span>"), day, F.lit("</span><span>18:30</span></div>"))
    boxes = [F.concat(F.lit('<div class="ffm-rez__oneteam">'), f"c{i}", F.lit("</div>")) for i in range(4)]
    pages = m.join(columns, "match_id").select("match_id", F.concat(F.lit("<html><body>"), *head, details, *boxes, F.lit("</body>")).alias("html"))
    told = F.concat(
        F.lit('<div class="ffm-najava__team-home">'), "home", F.lit('</div><div class="ffm-najava__team-away">'), "away", F.lit('</div><div class="ffm-najava__competition">'), "competition", F.lit(" 25/26 ( )</div>")
    )
    announced = match_pages.announcements(m.select("match_id", told.alias("html")))
    out = match_pages.enriched(match_pages.reports(pages), announced)
    found = out.select(
        "match_id", "competition", "home", "away", "goals_home", "goals_away", "round", "day", F.size("lineup_home").alias("lineup_home"), F.size("lineup_away").alias("lineup_away"),
        (F.size(F.filter("lineup_home", lambda p: p["starter"])) + F.size(F.filter("lineup_away", lambda p: p["starter"]))).alias("starters"),
        F.size("goals").alias("n_goals"), F.aggregate("goals", F.lit(0), lambda s, g: s + g["minute"]).alias("minutes"), F.size("cards").alias("n_cards"),
    )
    return longs(found, "goals_home", "goals_away", "lineup_home", "lineup_away", "starters", "n_goals", "minutes", "n_cards")


@query(
    """, n AS (SELECT DISTINCT home AS name, 'En ' || home AS en FROM matches)
SELECT match_id, CASE competition WHEN '5-LOW' THEN 'category_cadet' WHEN '4-NOT SPECIFIED' THEN 'category_kids' WHEN '3-MEDIUM' THEN 'category_youth' ELSE 'category_senior' END AS category_key, 'En ' || home AS home_name, 'En ' || away AS away_name FROM matches"""
)
def match_history(spark, sf_dir):
    m, c = a.matches(spark, sf_dir), F.col("competition")
    rows = m.withColumn("category", F.when(c == "5-LOW", "Кадети").when(c == "4-NOT SPECIFIED", "Детска лига").when(c == "1-URGENT", "Сениори"))
    rows = rows.withColumn("competition", F.when(c == "3-MEDIUM", "Младинска лига").otherwise(c))
    names = m.select(F.col("home").alias("name")).distinct().withColumn("en", F.concat(F.lit("En "), "name"))
    return masters.match_history(rows, names).select("match_id", "category_key", "home_name", "away_name")


@query("SELECT upper(substr(c_name, 1, 1)) AS letter, CAST(count(DISTINCT c_name) AS BIGINT) AS n, min(c_name) AS first FROM customer WHERE regexp_matches(substr(c_name, 1, 1), '\\p{L}') GROUP BY 1", base=False)
def alphabet_index(spark, sf_dir):
    out = masters.alphabet_index(a.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), "name", "en")
    return out.select("letter", F.size("names").cast("long").alias("n"), F.get("names", 0).alias("first"))


@query(
    """SELECT match_id, 'Name ' || CAST(l_suppkey % 50 AS VARCHAR) AS name, CASE l_suppkey % 4 WHEN 0 THEN 'referee_main' WHEN 1 THEN 'referee_asst2' WHEN 2 THEN 'var_operator' ELSE 'referee_role_x' END AS role, count(DISTINCT 1) AS n FROM ev GROUP BY ALL"""
)
def official_assignments(spark, sf_dir):
    k = F.col("l_suppkey") % 4
    role = F.when(k == 0, "Главен  Судија").when(k == 1, "Assistant 2").when(k == 2, "VAR operator").otherwise("X")
    name = F.concat((F.col("l_suppkey") % 50).cast("string"), F.lit(" Name (Skopje)"))
    rows = masters.officials(a._events(spark, sf_dir).select("match_id", name.alias("name"), role.alias("role")))
    return rows.groupBy("match_id", "name", "role").agg(F.count("*").alias("n"))


@query(
    """SELECT match_id, CASE WHEN match_id % 6 = 0 THEN 'Right 0' WHEN match_id % 6 = 1 THEN 'x1' WHEN match_id % 6 = 2 THEN 'Team two' ELSE 'Ana  ' || CAST(match_id % 6 AS VARCHAR) END AS name, CASE match_id % 6 WHEN 0 THEN 'id0' ELSE 'p' || CAST(match_id AS VARCHAR) END AS player_id FROM matches"""
)
def corrected_names(spark, sf_dir):
    """Conversions on squished keys, then unification by exact name; of several rows of a key the first by ``ord`` counts."""
    m = a.matches(spark, sf_dir).select("match_id", F.concat(F.lit("Ana  "), (F.col("match_id") % 6).cast("string")).alias("name"), F.concat(F.lit("p"), F.col("match_id").cast("string")).alias("player_id"))
    conversions = spark.createDataFrame([("ana 0", "Wrong 0", 2), (" ANA 0 ", "W0", 1), ("Ana 1", "x1", 3), ("ana 2", "Team two", 0), ("ana 2", "Team three", 5)], "original string, corrected string, ord int")
    unification = spark.createDataFrame([("W0", "No", "no", 9), ("W0", "Right 0", "id0", 1), ("Wrong 0", "No", "no", 0)], "wrong string, right string, right_id string, ord int")
    return identity.unify(identity.apply_conversions(m, "name", conversions), unification)


@query(
    """, f AS (SELECT DISTINCT player_id || CASE WHEN season % 2 = 0 THEN '_1' ELSE '' END AS final, player_id AS base FROM appearances)
SELECT coalesce(final, base_id) AS player_id, nationality FROM (SELECT 'P' || lpad(CAST(i AS VARCHAR), 3, '0') AS base_id, 'N' || CAST(i % 7 AS VARCHAR) AS nationality FROM range(0, 210) r(i)) b LEFT JOIN f ON f.base = b.base_id"""
)
def bio_by_final_id(spark, sf_dir):
    app = a.appearances(spark, sf_dir).select(F.concat("player_id", F.when(F.col("season") % 2 == 0, "_1").otherwise("")).alias("player_id"))
    i = F.col("id").cast("string")
    bio = spark.range(210).select(F.concat(F.lit("P"), F.lpad(i, 3, "0")).alias("player_id"), F.concat(F.lit("N"), (F.col("id") % 7).cast("string")).alias("nationality"))
    return identity.spread_base_ids(bio, app)


@query("SELECT match_id, CASE WHEN match_id % 3 = 0 THEN 'restore' ELSE 'exclude' END AS change FROM matches WHERE (match_id % 2 = 0) <> (match_id % 3 = 0)")
def exclusion_changes(spark, sf_dir):
    m = a.matches(spark, sf_dir).select("match_id")
    return incremental.exclusion_changes(m.filter("match_id % 2 = 0"), m.filter("match_id % 3 = 0"))


@query(
    """SELECT match_id, CASE match_id % 4 WHEN 0 THEN 'New home' WHEN 3 THEN home ELSE home END AS home, CASE WHEN match_id % 4 = 0 THEN 'Ground' ELSE 'Old' END AS ground FROM matches"""
)
def enriched_reports(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    announced = m.filter("match_id % 4 < 3").select("match_id", F.when(F.col("match_id") % 4 == 0, "New home").when(F.col("match_id") % 4 == 1, "  ").alias("home"), F.when(F.col("match_id") % 4 == 0, "Ground").alias("ground"))
    return incremental.enrich(m.select("match_id", "home", F.lit("Old").alias("ground")), announced, "match_id", ["home", "ground"])


@query(
    """SELECT match_id, competition || ' ' || CAST(round % 3 AS VARCHAR) AS competition, season FROM goals JOIN matches USING (match_id, competition, season)"""
)
def goals_in_context(spark, sf_dir):
    m = a.matches(spark, sf_dir).withColumn("competition", F.concat_ws(" ", "competition", (F.col("round") % 3).cast("string")))
    return masters.in_context(a.goals(spark, sf_dir).select("match_id", "competition", "season"), m).select("match_id", "competition", "season")


@query("SELECT DISTINCT player_id FROM appearances WHERE CAST(substr(player_id, 2) AS BIGINT) IN (SELECT n_nationkey FROM nation)")
def hidden_profiles(spark, sf_dir):
    hidden = a.table(spark, sf_dir, "nation").select(F.concat(F.lit("P"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("player_id"))
    return masters.profile_exclusions(a.appearances(spark, sf_dir), hidden, "player_id")


@query(
    """SELECT s_suppkey, 'En ' || CAST(s_suppkey % 5 AS VARCHAR) AS en, CASE WHEN s_suppkey % 5 < 3 THEN 'Es ' || CAST(s_suppkey % 5 AS VARCHAR) ELSE 'Ana ' || CAST(s_suppkey % 5 AS VARCHAR) END AS es FROM supplier""",
    base=False,
)
def entity_names(spark, sf_dir):
    k = F.col("s_suppkey") % 5
    rows = a.table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Ана "), k.cast("string")).alias("name"))
    told = rows.select("name", F.lit("en").alias("lang"), F.concat(F.lit("En "), F.substring("name", 5, 1)).alias("text"))
    told = told.union(rows.filter(k < 3).select("name", F.lit("es"), F.concat(F.lit("Es "), F.substring("name", 5, 1))))
    return rows.join(masters.entity_names(rows, told), "name").select("s_suppkey", "en", "es")


@query(
    """SELECT match_id, CASE match_id % 5 WHEN 0 THEN 'жфк' WHEN 1 THEN '25/26' ELSE NULL END IS NOT NULL AS known, CASE WHEN match_id % 3 = 0 THEN 'тиверија' WHEN match_id % 3 = 1 THEN 'fkx' ELSE 'ohrid' END AS club,
  CASE WHEN match_id % 3 = 1 THEN NULL ELSE 'x y' END AS kept, CASE match_id % 4 WHEN 0 THEN CAST(2025 AS BIGINT) WHEN 1 THEN CAST(1999 AS BIGINT) END AS year, CASE match_id % 2 WHEN 0 THEN 'MK / AL' ELSE 'MK' END AS nations FROM matches"""
)
def small_functions(spark, sf_dir):
    """Keys of clubs, blank values, season years and mapped lists."""
    k = F.col("match_id")
    club = F.when(k % 3 == 0, "ЖФК  Тиверија").when(k % 3 == 1, "FKX").otherwise(" fk Ohrid ")
    return a.matches(spark, sf_dir).select(
        "match_id", (k % 5 < 2).alias("known"), text.club_key(club).alias("club"), text.non_empty(F.when(k % 3 == 1, " Na ").otherwise(" x  y")).alias("kept"),
        calendar.season_year(F.when(k % 4 == 0, "25/26").when(k % 4 == 1, "1999/00").otherwise("x")).cast("long").alias("year"),
        text.mapped_list(F.when(k % 2 == 0, "Македонија / Албанија; Македонија").otherwise("Македонија"), {"Македонија": "MK", "Албанија": "AL"}).alias("nations"),
    )


@query(
    """SELECT DISTINCT CASE match_id % 4 WHEN 0 THEN 'ОФЛ Скопје' WHEN 1 THEN 'лига Битола' WHEN 2 THEN 'Лига' END AS label, CASE match_id % 4 WHEN 3 THEN 'category_cadet' ELSE 'category_senior' END AS key FROM matches"""
)
def municipal_groups(spark, sf_dir):
    k = F.col("match_id") % 4
    name = F.when(k == 0, "ОФЛ Скопје (Исток) 25/26").when(k == 1, "СУПЕР лига Битола").when(k == 2, "Лига").otherwise("(А) 25/26")
    return a.matches(spark, sf_dir).select(views.municipal_group(name).alias("label"), labels.category_key(F.when(k == 3, "Кадети").otherwise("x")).alias("key")).distinct()


@query("SELECT match_id, team, CAST(row_number() OVER (PARTITION BY match_id ORDER BY shirt NULLS LAST, player_id) AS BIGINT) AS place, player_id FROM appearances")
def roster_places(spark, sf_dir):
    rows = tables.numbered(a.appearances(spark, sf_dir), ["match_id"], views.roster_order("shirt"), "place")
    return longs(rows.select("match_id", "team", "place", "player_id"), "place")


@query(
    """SELECT match_id, CASE match_id % 4 WHEN 0 THEN 'Прва МФЛ' WHEN 1 THEN 'Трета МФЛ' END AS division, CAST(CASE match_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 10 END AS BIGINT) AS role_place FROM matches"""
)
def division_and_role_order(spark, sf_dir):
    k = F.col("match_id")
    name = F.when(k % 4 == 0, " ПРВА  МФЛ 25/26").when(k % 4 == 1, "Treta mfl").otherwise("Прва лига")
    role = F.when(k % 3 == 0, "referee_main").when(k % 3 == 1, "var_referee").otherwise("referee_role_x")
    return longs(a.matches(spark, sf_dir).select("match_id", labels.division(name).alias("division"), labels.role_order(role).alias("role_place")), "role_place")


@query(
    """, e AS (SELECT g.match_id, player_id, minute, cancelled, official FROM goals g JOIN matches USING (match_id, competition, season))
SELECT CAST(cancelled AS VARCHAR) AS cancelled, count(*) AS n, CAST(count(*) FILTER (NOT cancelled AND NOT official) AS BIGINT) AS counted FROM e GROUP BY 1"""
)
def event_flags(spark, sf_dir):
    m, g = a.matches(spark, sf_dir), a.goals(spark, sf_dir)
    flagged = masters.with_match_flag(g, m).withColumn("n", F.lit(1)).withColumn("counted", F.lit(0))
    counted = masters.with_match_flag(masters.counted_events(g, m), m).withColumn("n", F.lit(0)).withColumn("counted", F.lit(1))
    rows = flagged.unionByName(counted).groupBy(F.col("cancelled").cast("string").alias("cancelled")).agg(F.sum("n").alias("n"), F.sum("counted").alias("counted"))
    return rows


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'ana_' || CAST(s_suppkey AS VARCHAR) END AS player_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'goalkeeper' WHEN s_suppkey % 3 = 1 THEN 'forward' ELSE 'midfielder' END AS position,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Охрид' ELSE 'Berlin' END AS city, CASE WHEN s_suppkey % 5 <> 0 THEN DATE '2000-01-02' END AS birth FROM supplier""",
    base=False,
)
def bio_positions(spark, sf_dir):
    k = F.col("s_suppkey")
    top = {"GK": 0, "SC": 1, "MC": 2}
    values = [F.when(k % 7 != 0, F.when(k % 3 == top.get(p, 9), 20.0).otherwise(3.0)).alias(p) for p in labels.POSITIONS]
    sheet = a.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(k % 11 != 0, "Ана").alias("first_name"), k.cast("string").alias("second_name"), k.cast("string").alias("nationality"),
        F.when(k % 5 == 0, "unknown").otherwise("2000-01-02").alias("birth"), F.when(k % 2 == 0, "Ohrid").otherwise("Berlin").alias("city"), *values,
    )
    cities = spark.createDataFrame([("Охрид",), ("Скопје",)], "mk string")
    out = masters.bios(sheet, cities)
    return out.select(F.col("nationality").cast("long").alias("s_suppkey"), "player_id", "position", "city", "birth")


@query(
    """SELECT match_id, CASE match_id % 4 WHEN 0 THEN 'En exact' WHEN 1 THEN 'En loose' WHEN 2 THEN 'unknown' END AS name_en, CASE match_id % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'p' || CAST(match_id AS VARCHAR) ELSE '???' END AS player, CASE WHEN match_id % 2 = 0 THEN 'Liga 24/25' ELSE 'Cup' END AS competition FROM matches"""
)
def display_names(spark, sf_dir):
    k = F.col("match_id")
    names = spark.createDataFrame([("Ана Б", "En exact"), ("АНА  В", "En loose"), ("Ана Г", None)], "name string, en string")
    rows = a.matches(spark, sf_dir).select(
        "match_id", F.when(k % 4 == 0, "Ана Б").when(k % 4 == 1, " ана в").when(k % 4 == 2, "unknown").alias("name"),
        masters.player_display(F.when(k % 3 == 0, "X").when(k % 3 == 1, " na "), F.when(k % 3 == 1, F.concat(F.lit("p"), k.cast("string")))).alias("player"),
        masters.competition_display(F.when(k % 2 == 0, "Liga 25/26"), F.lit("Cup"), F.lit("25/26"), F.lit("24/25")).alias("competition"),
    )
    return masters.display_names(rows, "name", names, ("en",)).select("match_id", "name_en", "player", "competition")


@query(
    """, f AS (SELECT competition, season, player_id, credited AS team, min((match_id, minute)) AS f, max((match_id, minute)) AS l FROM goals GROUP BY ALL)
SELECT competition, season, player_id, string_agg(team, ' / ' ORDER BY f, team) AS teams, max_by(team, (l, team)) AS last_team FROM f GROUP BY ALL"""
)
def goal_teams(spark, sf_dir):
    return players.goal_teams(a.goals(spark, sf_dir).withColumn("team", F.lit(" ")).withColumn("team", F.nullif(F.trim("team"), F.lit(""))), ["match_id", "minute"])


@query(
    """, p AS (SELECT 'team' AS kind, home AS key FROM matches UNION SELECT 'player', player_id FROM appearances UNION SELECT 'static', 'index')
SELECT kind, key FROM p WHERE kind = 'static' OR (kind = 'team' AND key IN ('Team 01', 'Team 02'))"""
)
def pages_to_build(spark, sf_dir):
    pages = a.matches(spark, sf_dir).select(F.lit("team").alias("kind"), F.col("home").alias("key")).distinct()
    pages = pages.union(a.appearances(spark, sf_dir).select(F.lit("player"), "player_id").distinct()).union(spark.sql("SELECT 'static', 'index'"))
    scope = spark.createDataFrame([("team", "Team 01"), ("team", "Team 02"), ("player", "P001")], "kind string, key string")
    return views.pages_to_build(pages, scope, switches={"player": False})


@query(
    """, g AS (SELECT match_id, string_agg('{"player":"' || player_id || '","minute":"' || CAST(minute AS VARCHAR) || '\'\'","own_goal":' || CASE kind WHEN 'own_goal' THEN 'true' ELSE 'false' END || '}', ',' ORDER BY minute, player_id, kind = 'own_goal') FILTER (credited = home) AS h,
  string_agg('{"player":"' || player_id || '","minute":"' || CAST(minute AS VARCHAR) || '\'\'","own_goal":' || CASE kind WHEN 'own_goal' THEN 'true' ELSE 'false' END || '}', ',' ORDER BY minute, player_id, kind = 'own_goal') FILTER (credited = away) AS w
  FROM goals JOIN matches USING (match_id, competition, season) GROUP BY 1)
SELECT match_id, '{"homeTeam":"' || home || '","awayTeam":"' || away || '","homeScore":"' || CAST(goals_home AS VARCHAR) || '","awayScore":"' || CAST(goals_away AS VARCHAR) || '","homeGoals":[' || coalesce(h, '') || '],"awayGoals":[' || coalesce(w, '') || '],"ground":"","day":"","time":"","competition":"' || competition || '","round":"' || CAST(round AS VARCHAR) || '","lang":"mk"}' AS snapshot
FROM matches LEFT JOIN g USING (match_id)"""
)
def match_snapshots(spark, sf_dir):
    return views.match_snapshots(a.matches(spark, sf_dir), a.goals(spark, sf_dir).withColumn("name", F.lit(None).cast("string")))


@query(
    """, r AS (SELECT DISTINCT match_id, 'Official ' || CAST(l_suppkey % 30 AS VARCHAR) AS name, CASE shirt % 3 WHEN 0 THEN 'referee_main' WHEN 1 THEN 'match_delegate' ELSE 'referee_asst1' END AS role FROM ev),
o AS (SELECT match_id, name, string_agg(role, ', ' ORDER BY CASE role WHEN 'referee_main' THEN 1 WHEN 'referee_asst1' THEN 2 ELSE 8 END) AS roles FROM r GROUP BY ALL)
SELECT name, season, count(*) AS n, min_by(roles, (match_date, match_id)) AS first_roles FROM o JOIN matches USING (match_id) GROUP BY ALL"""
)
def referee_pages(spark, sf_dir):
    k = F.col("shirt") % 3
    rows = a._events(spark, sf_dir).select("match_id", F.concat(F.lit("Official "), (F.col("l_suppkey") % 30).cast("string")).alias("name"), F.when(k == 0, "referee_main").when(k == 1, "match_delegate").otherwise("referee_asst1").alias("role"))
    models = views.referee_pages(rows, a.matches(spark, sf_dir))
    read = F.from_json("matches_data", "array<struct<match_id:long,roles:string>>")
    return models.select("name", "season", F.size(read).cast("long").alias("n"), F.get(read, 0)["roles"].alias("first_roles"))


@query(
    """, l AS (SELECT competition, season, max(round) AS round FROM matches GROUP BY ALL)
SELECT competition, season, CAST(round AS BIGINT) AS round, '[' || string_agg('{"match_id":' || CAST(match_id AS VARCHAR) || ',"home":"' || home || '","away":"' || away || '","goals_home":' || CAST(goals_home AS VARCHAR) || ',"goals_away":' || CAST(goals_away AS VARCHAR) || '}', ',' ORDER BY match_date, match_id) || ']' AS matches_data
FROM matches JOIN l USING (competition, season, round) GROUP BY ALL"""
)
def home_portal(spark, sf_dir):
    return longs(views.home_portal(a.matches(spark, sf_dir)), "round")


@query(
    """SELECT 'Ground ' || CAST(round % 7 AS VARCHAR) AS ground, count(*) AS n, string_agg(DISTINCT home, ' / ' ORDER BY home) AS home_sides FROM matches WHERE round % 7 <> 6 GROUP BY 1"""
)
def stadium_pages(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    records = m.select("match_id", F.when(F.col("round") % 7 != 6, F.concat(F.lit("Ground "), (F.col("round") % 7).cast("string"))).alias("ground"))
    models = views.stadium_pages(masters.stadiums(records, m))
    return models.select("ground", F.size(F.from_json("matches_data", "array<struct<match_id:long>>")).cast("long").alias("n"), "home_sides")


@query(
    """SELECT match_id, CASE match_id % 4 WHEN 0 THEN CAST(1 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) WHEN 2 THEN CASE WHEN match_id % 5 = 0 THEN CAST(2 AS BIGINT) END END AS officials FROM matches"""
)
def backfilled_officials(spark, sf_dir):
    """Records asked before (one official or none), never asked and answered now, and never asked for."""
    k, kind = F.col("match_id"), "array<struct<role:string,name:string>>"
    one = F.array(F.struct(F.lit("r").alias("role"), F.lit("n").alias("name")))
    cached = a.matches(spark, sf_dir).select("match_id", F.when(k % 4 == 0, one).when(k % 4 == 1, F.array().cast(kind)).cast(kind).alias("officials"))
    asked = incremental.to_backfill(cached).filter("match_id % 4 = 2")
    answers = asked.select("match_id", F.when(k % 5 == 0, F.concat(one, one)).otherwise(F.array().cast(kind)).alias("officials"))
    return incremental.backfilled(cached, answers).select("match_id", F.when(F.col("officials").isNotNull(), F.size("officials")).cast("long").alias("officials"))


@query("SELECT home AS team FROM matches WHERE season = 1996 INTERSECT SELECT away FROM matches WHERE season = 1997")
def common_teams(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    return tables.common_rows(m.filter("season = 1996").select(F.col("home").alias("team")), m.filter("season = 1997").select(F.col("away")))


@query(
    """SELECT n_name, 'Country ' || n_name AS en, CASE WHEN n_nationkey % 4 = 0 THEN 'Club' ELSE 'Es ' || n_name END AS es FROM nation""", base=False)
def entity_overrides(spark, sf_dir):
    n = a.table(spark, sf_dir, "nation")
    told = n.select(F.col("n_name").alias("name"), F.lit("es").alias("lang"), F.concat(F.lit("Es "), "n_name").alias("text"))
    countries = n.select(F.col("n_name").alias("mk"), F.concat(F.lit("Country "), "n_name").alias("en"))
    clubs = n.filter("n_nationkey % 4 = 0").select(F.concat(F.lit(" "), F.lower("n_name")).alias("original"), F.lit("Club").alias("corrected"))
    out = masters.entity_names(n.select(F.col("n_name").alias("name")), told, ("en", "es"), countries)
    es = masters.entity_names(n.select(F.col("n_name").alias("name")), told, ("es",), clubs=clubs)
    return out.select(F.col("name").alias("n_name"), "en").join(es.select(F.col("name").alias("n_name"), "es"), "n_name")


@query(
    """, d AS (SELECT match_id, match_date AS a, match_date + CAST(match_id % 40 AS INT) AS b, match_date - 3650 AS birth FROM matches)
SELECT match_id, CASE WHEN match_id % 5 = 0 THEN NULL ELSE a END AS parsed, CASE WHEN match_id % 5 = 0 THEN NULL WHEN match_id % 3 = 0 THEN CAST(a AS TIMESTAMP) ELSE CAST(a AS TIMESTAMP) + INTERVAL 1110 MINUTE END AS kick_off,
  CAST(floor((a - birth) / 365.25) AS BIGINT) AS age, (month(a) BETWEEN 6 AND 9 OR month(b) BETWEEN 6 AND 9 OR (month(a) IN (11, 12, 1, 2) AND month(b) IN (11, 12, 1, 2))) AS moving,
  CAST(CASE WHEN month(b) IN (6, 7) THEN 60 ELSE 15 END AS BIGINT) AS threshold, CAST(CASE WHEN b > a + 5 THEN b - (a + 5) ELSE greatest(a, b) - least(a + 5, b + 9) END AS BIGINT) AS gap,
  CASE WHEN match_id % 2 = 0 THEN lpad(CAST((year(a) - 1) % 100 AS VARCHAR), 2, '0') || '/' || lpad(CAST(year(a) % 100 AS VARCHAR), 2, '0') ELSE CAST(year(a) AS VARCHAR) || '/' || lpad(CAST((year(a) + 1) % 100 AS VARCHAR), 2, '0') END AS season FROM d"""
)
def calendar_functions(spark, sf_dir):
    """Dates and times of day from text, ages, transfer windows, gaps of intervals and seasons of play-offs."""
    k, day = F.col("match_id"), F.col("match_date")
    later = F.date_add(day, (k % 40).cast("int"))
    text_day = F.when(k % 5 == 0, "31.02.2001").otherwise(F.date_format(day, "dd.MM.yyyy"))
    label = F.concat(F.year(day).cast("string"), F.lit("/"), F.lpad(F.pmod(F.year(day) + 1, F.lit(100)).cast("string"), 2, "0"))
    rows = a.matches(spark, sf_dir).select(
        "match_id", calendar.parse_date(text_day).alias("parsed"), calendar.kick_off(text_day, F.when(k % 3 == 0, "later").otherwise("18:30")).cast("timestamp_ntz").alias("kick_off"),
        calendar.age_on(F.date_sub(day, 3650), day).alias("age"), calendar.in_transfer_window(day, later).alias("moving"), calendar.gap_threshold(later).alias("threshold"),
        calendar.interval_gap(day, F.date_add(day, 5), later, F.date_add(later, 9)).alias("gap"), calendar.play_off_season(F.when(k % 2 == 0, "Бараж за Прва").otherwise("Прва"), label).alias("season"),
    )
    return longs(rows, "age", "threshold", "gap")


#: Text functions, an input and what comes of it.
TEXTS = (
    (text.cyrillic_to_latin, "марија ѓорѓиева-џ", "Marija Gjorgjieva-Dž"), (text.standard_name, "Shkendija", "Шкендија"), (text.standard_name, "Ана", "Ана"), (text.strip_parenthesis, "Ana (Skopje) ", "Ana"),
    (text.group_label, "Liga (Istok)", "Istok"), (text.quiet_capitals, "ПРВА лига (куп) НА СЕВЕР", "Прва Лига (КУП) на север"), (text.note_lines, "a\\n\\nb", "a\nb"), (text.club_key, "ЖФК  Тиверија", "тиверија"),
    (text.last_word_first, "Popova Ana", "Ana Popova"), (text.distinct_words, "a b a c b", "a b c"), (calendar.strip_season, "Liga 2025/26", "Liga"), (calendar.long_season, "Liga 25/26", "Liga 2025/26"),
    (labels.official_role, "2. помошен судија", "referee_asst2"), (labels.category, "помали петлиња", "Помали петлиња"), (labels.division, "Втора мфл", "Втора МФЛ"),
)


@query(
    "SELECT match_id % " + str(len(TEXTS)) + " AS k, CASE match_id % " + str(len(TEXTS)) + " " + " ".join(f"WHEN {i} THEN '{out}'" for i, (_, _, out) in enumerate(TEXTS)) + " END AS text, count(*) AS n FROM matches GROUP BY ALL"
)
def text_functions(spark, sf_dir):
    k = F.col("match_id") % len(TEXTS)
    given, found = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (function, value, _) in enumerate(TEXTS):
        given = F.when(k == i, value).otherwise(given)
        found = F.when(k == i, function(F.col("given"))).otherwise(found)
    rows = a.matches(spark, sf_dir).withColumn("given", given)
    return rows.groupBy(k.alias("k"), found.alias("text")).agg(F.count("*").alias("n"))


@query(
    """, r AS (SELECT DISTINCT competition || ' 25/26' AS competition, from_round, club FROM rules)
SELECT DISTINCT m.match_id FROM matches m JOIN r ON contains(lower(r.competition), lower(m.competition)) AND (m.home = r.club OR m.away = r.club) AND m.round >= r.from_round"""
)
def rules_by_containment(spark, sf_dir):
    rules = a.rules(spark, sf_dir).withColumn("competition", F.concat("competition", F.lit(" 25/26")))
    return standings.withdrawn_matches(a.matches(spark, sf_dir), rules, containment=True)


@query(
    """, s AS (SELECT *, count(*) OVER (PARTITION BY match_id, team) AS n, row_number() OVER (PARTITION BY match_id, team ORDER BY shirt, player_id) AS rn FROM appearances WHERE starter)
SELECT match_id, team, player_id FROM s WHERE rn = 1"""
)
def first_starters(spark, sf_dir):
    """The starter of the lowest shirt of each side, who keeps the goal unless a list says otherwise."""
    rows = a.appearances(spark, sf_dir).filter("starter")
    return tables.first_rows(rows, ["match_id", "team"], tables.ordering("shirt", "player_id")).select("match_id", "team", "player_id")
