"""What pages and interactive tables ask for: orders, links, labels, navigation, page models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.calendar import parse_date, season_year
from touchline.functions.labels import category, category_key, is_youth, mapped, role_order  # noqa: F401
from touchline.functions.text import squish
from touchline.operators.masters import player_display
from touchline.operators.tables import json_rows, ordering

# ---- Fixed values: category keys and orders, competition orders by name, page folders.

ARCHIVE_ORDER = {"Младинци": 2, "Кадети": 3, "Пионери": 4, "Млади Пионери": 5, "Петлиња": 6, "Помали петлиња": 7}
LEAGUE_ORDER = (("суперлига", 1.0), ("прва", 2.0), ("втора", 4.0), ("трета", 5.0), ("офл", 6.0))
PLAY_OFF_ORDER = (("прва", 2.2), ("куп", 3.2), ("втора", 4.2), ("трета", 5.2), ("офл", 6.2))
FOLDERS = {"jugadora": "igracki", "equipo": "timovi", "arbitro": "sudii", "стадион": "stadioni", "staff": "staff", "menu-competicion": "natprevaruvanja"}


def category_label(normal: Column, max_age: Column, texts: dict[str, str] | None = None, prefix: str = "U") -> Column:
    """'Youth (U16)': the category's text in a language, else the category itself, with the age."""
    name = F.coalesce(mapped(normal, texts), normal) if texts else normal
    return F.concat(name, F.lit(f" ({prefix}"), max_age.cast("int").cast("string"), F.lit(")"))


def competition_order(name: Column) -> Column:
    """Order of a competition within its category; play-offs stand behind what they are played for."""
    text = F.lower(squish(name))
    play_off = text.rlike(r"(?U)\bбараж\b")
    cup, regional = text.contains("куп"), text.contains("офс")
    order = F.when(cup & regional, 8.0).otherwise(7.0)
    for word, value in reversed(LEAGUE_ORDER[2:]):
        order = F.when(text.contains(word), value).otherwise(order)
    order = F.when(cup & ~regional, F.when(text.contains("елиминација"), 3.1).otherwise(3.0)).otherwise(order)
    for word, value in reversed(LEAGUE_ORDER[:2]):
        order = F.when(text.contains(word), value).otherwise(order)
    target = F.regexp_replace(text, r"^бараж\s+за\s+", "")
    behind = order + 0.2
    for word, value in reversed(PLAY_OFF_ORDER):
        behind = F.when(target.contains(word), value).otherwise(behind)
    return F.when(play_off, behind).otherwise(order)


def archive(competitions: DataFrame) -> list[Column]:
    """Sort keys of the archive: latest season, category, competition, name in Macedonian order."""
    normal = category(F.col("category"), F.col("competition"))
    place = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ARCHIVE_ORDER.items() for x in kv]), normal), F.lit(1))
    return [season_year(F.col("season")).desc_nulls_last(), place, competition_order(F.col("competition")), F.collate(F.col("competition"), "mk")]


def column_sort(table: DataFrame, column: str, descending: bool = False, locale: str = "mk") -> DataFrame:
    """Interactive sort: numbers before text, numbers by value, text by locale; blank counts as 0."""
    text = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("0"))
    number = F.nullif(F.regexp_extract(text, r"^[+-]?(\d+\.?\d*|\.\d+)", 0), F.lit("")).try_cast("double")
    keys = [number, F.collate(text, locale)]
    return table.orderBy(*[k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys])


def roster_order(column: str, locale: str = "mk") -> list[Column]:
    """Shirt (none last, as 999), name, or a number (none as 0); then the player."""
    if column == "shirt":
        return [F.coalesce("shirt", F.lit(999)), F.col("player_id")]
    if column == "name":
        return [F.collate(F.coalesce("name", F.lit("")), locale), F.col("player_id")]
    return [F.coalesce(F.col(column).cast("long"), F.lit(0)), F.col("player_id")]


def schedule_order(day: str = "day") -> list[Column]:
    return [parse_date(F.col(day)).desc_nulls_last()]


def target_path(target: Column) -> Column:
    """Page of a target id 'type-id' (two-part types included); '#' for unknown types."""
    out = F.lit("#")
    for kind, folder in FOLDERS.items():
        known = target.startswith(kind + "-")
        out = F.when(known, F.concat(F.lit(folder + "/"), F.substring(target, len(kind) + 2, 1 << 30), F.lit(".html"))).otherwise(out)
    return out


def competition_id(explicit: list[Column], name: Column, season: Column) -> Column:
    """The first explicit id, else 'name__season', else the name, else null."""
    n, s = F.nullif(F.trim(name), F.lit("")), F.nullif(F.trim(season), F.lit(""))
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in explicit], F.when(s.isNotNull(), F.concat(n, F.lit("__"), s)), n)


def either_key(rows: DataFrame, column: str, dimension: DataFrame, keys: tuple[str, str], value: str) -> DataFrame:
    """Look a value up by the dimension's first key, else by its second; the smallest value of a key counts."""
    out = rows
    for i, k in enumerate(keys):
        once = dimension.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias("_k")).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(once, F.col(column) == F.col("_k"), "left").drop("_k")
    return out.withColumn(value, F.coalesce("_v0", "_v1")).drop("_v0", "_v1")


def national_team_code(rows: DataFrame, team: str, countries: DataFrame, home: str = "Македонија") -> DataFrame:
    """code: 'mk' for the home country, else the lower-case code of the first country row of that name, else null."""
    once = countries.groupBy(F.col("name").alias("_n")).agg(F.min_by("code", "ord").alias("_c"))
    joined = rows.join(once, F.col(team) == F.col("_n"), "left")
    return joined.withColumn("code", F.when(F.col(team) == home, "mk").otherwise(F.lower("_c"))).drop("_n", "_c")


def score_from_goals(matches: DataFrame, goals: DataFrame) -> DataFrame:
    """Goals counted by credited team replace the header's score of matches that have any goal event."""
    counted = (
        goals.join(matches.select("match_id", "home", "away"), "match_id")
        .groupBy("match_id")
        .agg(F.count_if(F.col("credited") == F.col("home")).alias("_h"), F.count_if(F.col("credited") == F.col("away")).alias("_a"))
    )
    joined = matches.join(counted, "match_id", "left")
    return joined.withColumns({"goals_home": F.coalesce("_h", "goals_home"), "goals_away": F.coalesce("_a", "goals_away")}).drop("_h", "_a")


def navigation(competitions: DataFrame, season: str | Column) -> DataFrame:
    """(season, bucket, competition): what the menu shows of a season, from ``competitions(competition, season, category)``.

    Friendlies, play-offs, cup eliminations, youth and whatever is not of a senior category are left out.
    A competition is in every bucket whose beginning it has; what has none is municipal.
    """
    name = F.col("competition")
    text = F.lower(name)
    cup = text.rlike("куп|kup")
    shown = competitions.filter((F.col("season") == season) & ~text.rlike(r"(?U)пријателски|\bбараж\b") & ~(cup & text.rlike("елиминација|eliminacija")))
    senior = F.lower(squish(F.coalesce("category", F.lit("")))).rlike("сениор|senior")
    shown = shown.filter(senior & ~is_youth(F.col("category"), name))
    national = text.rlike("^(куп|kup) (на|na) рм")
    buckets = F.array_compact(
        F.array(
            F.when(text.rlike("^(прва|prva)"), "first"), F.when(text.rlike("^(втора|vtora)"), "second"), F.when(national, "national_cup"),
            F.when(text.rlike("^(трета|treta)"), "third"), F.when(text.rlike("^(куп|kup)") & ~national, "regional_cup"),
        )
    )
    return shown.select(F.explode(F.when(F.size(buckets) > 0, buckets).otherwise(F.array(F.lit("municipal")))).alias("bucket"), "competition", "season")


def municipal_group(name: Column) -> Column:
    """What municipal leagues are grouped by: the name without parentheses, season and 'super'; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(name, r"\s*\(.*\)", ""), r"\s*\d{2}/\d{2}$", "")
    return F.nullif(F.trim(F.regexp_replace(bare, r"(?iu)супер\s*", "")), F.lit(""))


def round_label(key: Column, texts: dict[str, str], fallback: Column) -> Column:
    """The key's text, else the key itself, else the squished raw round, else ''."""
    return F.coalesce(mapped(key, texts) if texts else F.lit(None), F.nullif(key, F.lit("")), squish(fallback.cast("string")), F.lit(""))


def competition_hub(matches: DataFrame, table: DataFrame) -> DataFrame:
    """One row per (competition, season): rounds with their matches and the league table, as JSON."""
    m = json_rows(matches, ["competition", "season"], ["round", "match_id"], ["match_id", "round", "home", "away", "goals_home", "goals_away"], "matches")
    t = json_rows(table, ["competition", "season"], ["pos"], ["pos", "team", "played", "points", "gd"], "standings")
    return m.join(t, ["competition", "season"], "left")


#: Page families that a build may leave out; a full build has all of them.
SWITCHES = dict.fromkeys(("static", "competition", "match", "player", "team", "referee", "stadium", "staff"), True)


def pages_to_build(pages: DataFrame, scope: DataFrame, full: bool = False, switches: dict[str, bool] | None = None) -> DataFrame:
    """``pages(kind, key)`` of the families that are switched on: all on a full build, else those in ``scope(kind, key)``.

    Static pages have no key of their own and are built whenever they are switched on.
    """
    on = [kind for kind, wanted in (SWITCHES | (switches or {})).items() if wanted]
    wanted = pages.filter(F.col("kind").isin(on))
    if full:
        return wanted
    return wanted.filter("kind = 'static'").union(wanted.filter("kind <> 'static'").join(scope, ["kind", "key"], "left_semi"))


def match_snapshots(matches: DataFrame, goals: DataFrame, language: str = "mk") -> DataFrame:
    """(match_id, snapshot): what a shared picture of a match shows, as JSON: sides, score, goals by side, ground, day and round."""

    def listed(team: str) -> Column:
        own = F.col("credited") == F.col(team)
        minute = F.coalesce(F.concat(F.col("minute").cast("string"), F.lit("'")), F.lit(""))
        goal = F.struct(player_display(F.col("name"), F.col("player_id")).alias("player"), minute.alias("minute"), (F.col("kind") == "own_goal").alias("own_goal"))
        key = F.struct(F.coalesce(F.col("minute"), F.lit(1 << 30)), F.col("player_id"), goal.alias("g"))
        return F.transform(F.array_sort(F.collect_list(F.when(own, key))), lambda x: x["g"])

    sides = matches.select("match_id", "home", "away")
    told = goals.join(sides, "match_id").groupBy("match_id").agg(listed("home").alias("homeGoals"), listed("away").alias("awayGoals"))
    rows = matches.join(told, "match_id", "left")
    none = F.array().cast(told.schema["homeGoals"].dataType)
    text = {c: (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in matches.columns else F.lit("")) for c in ("ground", "day", "time", "competition", "round")}
    snapshot = F.struct(
        F.col("home").alias("homeTeam"), F.col("away").alias("awayTeam"), F.coalesce(F.col("goals_home").cast("string"), F.lit("0")).alias("homeScore"),
        F.coalesce(F.col("goals_away").cast("string"), F.lit("0")).alias("awayScore"), F.coalesce("homeGoals", none).alias("homeGoals"), F.coalesce("awayGoals", none).alias("awayGoals"),
        *[c.alias(n) for n, c in text.items()], F.lit(language).alias("lang"),
    )
    return rows.select("match_id", F.to_json(snapshot).alias("snapshot"))


def referee_pages(assignments: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per official and season: matches with the roles in their order, as JSON."""
    rows = assignments.withColumn("_o", role_order(F.col("role"))).groupBy("name", "match_id").agg(F.array_sort(F.collect_set(F.struct("_o", "role"))).alias("r"))
    rows = rows.select("name", "match_id", F.array_join(F.transform("r", lambda x: x["role"]), ", ").alias("roles")).join(matches.select("match_id", "season", "match_date", "home", "away"), "match_id")
    return json_rows(rows, ["name", "season"], ["match_date", "match_id"], ["match_id", "match_date", "home", "away", "roles"], "matches_data")


def stadium_pages(stadiums: DataFrame) -> DataFrame:
    """One row per ground: its matches and home sides, as JSON."""
    known = stadiums.filter("ground is not null")
    m = json_rows(known, ["ground"], ["match_id"], ["match_id", "home", "away"], "matches_data")
    return m.join(known.groupBy("ground").agg(F.array_join(F.array_sort(F.collect_set("home")), " / ").alias("home_sides")), "ground")


def home_portal(latest: DataFrame) -> DataFrame:
    """One row per competition and season: the matches of its latest round, as JSON."""
    last = latest.groupBy("competition", "season").agg(F.max("round").alias("round"))
    rows = latest.join(last, ["competition", "season", "round"])
    return json_rows(rows, ["competition", "season", "round"], ["match_date", "match_id"], ["match_id", "home", "away", "goals_home", "goals_away"], "matches_data")


def team_pages(rosters: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per (team, season): roster and matches, as JSON."""
    r = json_rows(rosters, ["team", "season"], ["player_id"], ["player_id", "called_up", "played", "minutes", "goals"], "roster_data")
    sides = matches.withColumn("team", F.explode(F.array("home", "away")))
    m = json_rows(sides, ["team", "season"], ["match_date", "match_id"], ["match_id", "match_date", "home", "away"], "matches_data")
    return r.join(m, ["team", "season"], "full")


def person_pages(assignments: DataFrame) -> DataFrame:
    """One row per person: seasons with their matches, latest first, as JSON."""
    return json_rows(assignments.withColumn("_neg", -F.datediff("match_date", F.lit("1970-01-01").cast("date"))), ["name"], ["_neg", "match_id"], ["match_id", "match_date", "competition", "season"], "matches_data")


def top_tables(scorers: DataFrame, cards: DataFrame, keepers: DataFrame, n: int = 5) -> DataFrame:
    """(competition, season, kind, place, player_id): the first n of each statistic."""
    from touchline.operators.tables import numbered, union_by_name

    parts = []
    for kind, table, order in (("scorers", scorers, ["-goals"]), ("cards", cards, ["-reds", "-yellows"]), ("keepers", keepers, ["-clean_sheets", "ga_ratio", "-minutes"])):
        placed = numbered(table.drop("pos"), ["competition", "season"], ordering(*order, "player_id"), "place").filter(F.col("place") <= n)
        parts.append(placed.select("competition", "season", F.lit(kind).alias("kind"), "place", "player_id"))
    return union_by_name(parts)
