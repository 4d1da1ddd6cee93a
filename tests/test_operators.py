import datetime as dt

from pyspark.sql import functions as F

from touchline.operators import identity, incremental, masters, players, presence, standings, tables

MATCH = "match_id long, competition string, season string, round string, match_date date, home string, away string, goals_home int, goals_away int, cancelled boolean, official boolean"
D = dt.date


def league(spark):
    rows = [
        (1, "L", "25/26", "1", D(2025, 8, 10), "A", "B", 2, 0, None, False),
        (2, "L", "25/26", "1", D(2025, 8, 10), "C", "D", 1, 1, False, False),
        (3, "L", "25/26", "2", D(2025, 8, 17), "B", "C", 16, 0, False, True),
        (4, "L", "25/26", "2", D(2025, 8, 17), "D", "A", 5, 5, True, False),
        (5, "L", "25/26", "3", D(2025, 8, 24), "A", "C", None, None, False, False),
        (6, "L", "25/26", "3", D(2025, 8, 24), "D", "B", 2, 2, False, True),
    ]
    return spark.createDataFrame(rows, MATCH)


def test_league_table(spark):
    sanctions = spark.createDataFrame([("L", "25/26", "A", 1)], "competition string, season string, team string, points int")
    got = {r["team"]: (r["pos"], r["played"], r["points"], r["gf"], r["ga"]) for r in standings.league_table(league(spark), sanctions).collect()}
    # 16-0 and a tied official result count 3-0 (home), no score counts as a draw, the cancelled match not at all
    assert got == {"D": (1, 2, 4, 4, 1), "A": (2, 2, 3, 2, 0), "B": (3, 3, 3, 3, 5), "C": (4, 3, 2, 1, 4)}
    assert standings.league_table(league(spark), drop_unscored=True).filter("team = 'A'").first()["played"] == 1


def test_cancellation_and_placeholders(spark):
    rows = [(i, "L 25/26", "25/26", str(r), None, h, a, 1, 0, None, False) for i, (r, h, a) in enumerate([(1, "ФК X", "A"), (2, "B", "X"), (3, "X", "C"), (4, "A", "X"), (5, "A", "B"), (6, "A", "C")])]
    m = spark.createDataFrame(rows, MATCH)
    rules = spark.createDataFrame([("L 25/26", "FK x", 4)], "competition string, club string, from_round int")
    flags = standings.with_cancellation(m, rules, spark.createDataFrame([(4,)], "match_id long"))
    assert {r["match_id"]: (r["cancelled"], r["withdrawn"]) for r in flags.collect()} == {0: (False, False), 1: (False, False), 2: (False, False), 3: (True, True), 4: (True, False), 5: (False, False)}
    made = {(r["round"], r["home"], r["away"]) for r in standings.withdrawal_placeholders(m, rules).collect()}
    assert made == {(5, "X", "B"), (6, "C", "X")}


def test_presence(spark):
    line = spark.createDataFrame(
        [(1, "A", 1, "k", True), (1, "A", 2, "x", True), (1, "A", 12, "s", False), (1, "A", 13, "n", False), (1, "A", None, "q", True)], "match_id long, team string, shirt int, player_id string, starter boolean"
    )
    texts = spark.createDataFrame([(1, "A", 60, "Entra S (12) por K (1)", 1), (1, "A", 70, "???", 2)], "match_id long, team string, minute int, text string, ord int")
    out = presence.minutes_played(line, presence.parse_substitutions(texts), spark.createDataFrame([(1, 90)], "match_id long, duration int"))
    got = {r["player_id"]: (r["min_in"], r["min_out"], r["minutes"], r["substituted"]) for r in out.collect()}
    assert got == {"k": (0, 60, 60, True), "x": (0, 90, 90, False), "s": (60, 90, 30, False), "n": (None, 0, 0, False), "q": (None, None, None, False)}
    keepers = out.filter("player_id in ('k', 's')").withColumns({"competition": F.lit("L"), "season": F.lit("s"), "ga_base": F.lit(90)})
    goals = spark.createDataFrame([(1, "A", float(m)) for m in (59, 60, 61)], "match_id long, team string, goal_minute double")
    per = presence.keeper_matches(keepers, goals)
    assert {r["player_id"]: (r["ga"], r["full_match"]) for r in per.collect()} == {"k": (2, False), "s": (2, False)}  # bounds included
    table = presence.keeper_table(per)
    assert {r["player_id"]: r["pos"] for r in table.collect()} == {"k": 1, "s": 2}


def test_goal_attribution_and_trios(spark):
    m = spark.createDataFrame([(1, "H", "V")], "match_id long, home string, away string")
    goals = spark.createDataFrame([(1, "p", "H", 451, "normal"), (1, "p", "V", 10, "own_goal"), (1, None, " v ", 20, "normal")], "match_id long, player_id string, credited string, minute int, kind string")
    app = spark.createDataFrame([(1, "p", "H")], "match_id long, player_id string, team string")
    assert sorted((r["team"], r["goal_minute"]) for r in presence.conceded(goals, m, app).collect()) == [("H", 10.0), ("H", 20.0), ("V", 45.0)]
    d = [(1, "H", "L", "s", p, a, b) for p, a, b in [("a", 0, 90), ("b", 0, 90), ("c", 0, 30), ("d", 30, 90)]]
    trios = presence.defensive_trios(spark.createDataFrame(d, "match_id long, team string, competition string, season string, player_id string, min_in int, min_out int"), presence.conceded(goals, m, app))
    assert {r["trio"]: (r["minutes"], r["ga"]) for r in trios.collect()} == {"a-b-c": (30, 2), "a-b-d": (60, 0)}  # c and d share no time


def test_identity(spark):
    schema = "name string, team string, match_id int, match_date date, category string, ord int"
    rows = [
        ("Ана Икс", "A", 1, D(2024, 3, 1), "сениори", 1), ("Ана Икс", "A", 1, D(2024, 3, 1), "сениори", 2), ("Ана Икс", "A", 2, D(2024, 12, 1), "сениори", 3),
        ("Ева Ју", "A", 3, D(2024, 3, 1), "сениори", 4), ("Ева Ју", "B", 4, D(2024, 3, 10), "пионери", 5), ("Ева Ју", "C", 5, D(2024, 9, 1), "сениори", 6),
        ("Ју", "C", 5, D(2024, 9, 1), "сениори", 7),
    ]
    clustered = identity.split_stints(identity.same_day_clusters(spark.createDataFrame(rows, schema)))
    assert {r["ord"]: r["cluster"] for r in clustered.collect()} == {1: 1001, 2: 2001, 3: 1002, 4: 1001, 5: 1001, 6: 1001, 7: 1001}
    ids = {r["ord"]: r["player_id"] for r in identity.resolve_players(spark.createDataFrame(rows, schema)).collect()}
    assert 7 not in ids and ids[1] != ids[2] and ids[4] != ids[5] and ids[4] == ids[6] == "eva_ju_1"
    english = spark.createDataFrame([("Ју Ева", "Eve You")], "name string, english string")
    assert {r["player_id"] for r in identity.resolve_players(spark.createDataFrame(rows, schema), english).filter("name = 'Ева Ју'").collect()} == {"eve_you_1", "eve_you_2"}


def test_event_cascade(spark):
    app = spark.createDataFrame(
        [(1, "Ana K", "A", 7, "ana"), (1, "Eva", "A", 8, "eva_1"), (1, "Eva", "B", 9, "eva_2"), (2, "Iva", "A", 5, "iva")], "match_id long, name string, team string, shirt int, player_id string"
    )
    ev = spark.createDataFrame(
        [(1, " Ana  K", "A", None), (1, "?", "A", 8), (2, "Iva", "Z", None), (1, "?", "Z", 9), (1, "Eva", "Z", None), (1, None, None, None)], "match_id long, name string, team string, shirt int"
    )
    got = [r["player_id"] for r in identity.event_ids(ev.withColumn("o", F.monotonically_increasing_id()), app).orderBy("o").collect()]
    assert got == ["ana", "eva_1", "iva", "eva_2", "eva", None]


def test_tables(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10)], "k string, w int")
    assert {(r["k"], r["w"]) for r in tables.null_safe_join(a, b, ["k"]).collect()} == {(None, 10), ("x", None)}
    assert tables.null_safe_join(a, b, ["k"], "left_anti").count() == 1
    assert tables.same_rows(a, a) and not tables.same_rows(a, a.limit(1))
    cols = spark.createDataFrame([(1, 1, None), (None, None, None), (0, 2, 2)], "a int, b int, c int")
    assert [r[0] for r in cols.select(tables.argmax_column(["a", "b", "c"])).collect()] == ["a", None, "b"]
    runs = spark.createDataFrame([("g", i, i not in (1, 2)) for i in range(6)], "g string, i int, bad boolean")
    assert sorted(r["i"] for r in tables.until_failures(runs, ["g"], "i", F.col("bad"), 2).collect()) == [0, 1, 2, 3, 4]


def test_players(spark):
    app = spark.createDataFrame(
        [(1, "p", "A", "L", "s", D(2025, 1, 1), True, 90, 9, 1), (2, "p", "B", "L", "s", D(2025, 2, 1), False, 0, 9, 1), (3, "q", "B", "L", "s", D(2025, 2, 1), False, 10, 7, 1)],
        "match_id long, player_id string, team string, competition string, season string, match_date date, starter boolean, minutes int, shirt int, ord int",
    )
    goals = spark.createDataFrame([(1, "p", "L", "s", "normal"), (1, "p", "L", "s", "own_goal"), (9, "z", "L", "s", "normal")], "match_id long, player_id string, competition string, season string, kind string")
    cards = players.second_yellows(spark.createDataFrame([(1, "p", "L", "s", "second_yellow"), (3, "q", "L", "s", "yellow")], "match_id long, player_id string, competition string, season string, card string"))
    total = {r["player_id"]: (r["team"], r["called_up"], r["played"], r["goals"], r["yellows"], r["reds"]) for r in players.player_totals(app, goals, cards).collect()}
    assert total == {"p": ("B", 2, 1, 1, 1, 1), "q": ("B", 1, 1, 0, 1, 0)}
    assert {r["player_id"]: (r["pos"], r["teams"]) for r in players.top_scorers(app, goals).collect()} == {"p": (1, "A / B"), "z": (1, None)}
    assert {r["player_id"]: r["pos"] for r in players.discipline(cards).collect()} == {"p": 1, "q": 2}
    assert {(r["player_id"], r["team"]): r["goals"] for r in players.careers(app, goals, cards).collect()} == {("p", "A"): 1, ("p", "B"): 0, ("q", "B"): 0, ("z", None): 1}


def test_incremental(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "match_id long")
    res = lambda *x: spark.createDataFrame(list(x), "match_id long, goals_home int, goals_away int")
    got = incremental.affected_matches(ids(1, 2, 3), ids(1, 2), ids(2), res((1, 3, 0)), res((1, 0, 3)))
    assert {r[0] for r in got.collect()} == {1, 2, 3}
    same = incremental.affected_matches(ids(1, 2), ids(1, 2), ids(), res((1, 3, 0)), res((1, 3, 0)))
    assert same.isEmpty()
    gone = incremental.affected_matches(ids(1, 2), ids(1, 2, 9), ids(), res((1, 3, 0)), res((1, 3, 0)))
    assert {r[0] for r in gone.collect()} == {1, 2}


def test_names_and_search(spark):
    names = spark.createDataFrame([("Тиверија",)], "name string")
    wide = masters.entity_names(names, spark.createDataFrame([("Тиверија", "en", "Tiverija FC")], "name string, lang string, text string"))
    assert wide.first().asDict() == {"name": "Тиверија", "mk": "Тиверија", "sq": "Tiverija", "es": "Tiverija", "en": "Tiverija FC"}
    index = masters.search_index({"team": (wide, "team-")})
    assert index.first()["target_id"] == "team-tiverija" and masters.suggestions(index, "Тивер").count() == 1 and masters.suggestions(index, "т").count() == 0
    fined = masters.sanctions_by_name(spark.createDataFrame([(" tiverija  fc", 3)], "team string, points int"), wide)
    assert fined.first()["team"] == "Тиверија"
    letters = masters.alphabet_index(spark.createDataFrame([("Ана",), ("Ѓока",), ("1x",)], "n string"), "n")
    assert {r["letter"] for r in letters.collect()} == {"А", "Ѓ"}


def test_persons_equal_brute_force(spark):
    """First fit over random intervals of a few names, against a direct reading of the rule."""
    import random

    r = random.Random(6)
    spans = []
    for n in range(12):
        for k in range(r.randint(1, 7)):
            first = D(2020, 1, 1) + dt.timedelta(days=r.randint(0, 1200))
            kind = r.choice(("senior", "child", None))
            spans.append((f"n{n}", f"T{r.randint(1, 3)}", 1000 + k, first, first + dt.timedelta(days=r.randint(0, 250)), kind == "senior", kind == "child"))
    df = spark.createDataFrame(spans, "name string, team string, cluster int, first date, last date, senior boolean, child boolean")
    got = {(x["name"], x["team"], x["cluster"]): (x["person"], x["homonym"]) for x in identity.persons(df).collect()}

    def fits(group, row):
        everyone = [*group, row]
        if any(x[5] for x in everyone) and any(x[6] for x in everyone):
            return False
        for x in group:
            late, early = max(row[3], x[3]), min(row[4], x[4])
            gap = (late - early).days
            allowed = 60 if 6 in (late.month, early.month) or 7 in (late.month, early.month) else 15
            moving = any(m in (6, 7, 8, 9) for m in (late.month, early.month)) or all(m in (11, 12, 1, 2) for m in (late.month, early.month))
            if gap <= allowed and (gap <= 0 or not moving):
                return False
        return True

    for name in {x[0] for x in spans}:
        groups = []
        own = sorted((x for x in spans if x[0] == name), key=lambda x: (x[3], x[1], x[2]))
        for row in own:
            home = next((g for g in groups if fits(g, row)), None)
            if home is None:
                groups.append(home := [])
            home.append(row)
        for i, g in enumerate(groups):
            for row in g:
                assert got[row[:3]] == (i + 1, len(groups) > 1)
