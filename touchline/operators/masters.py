"""Master tables: categories, competitions, officials, staff, entity names, sanctions, search index, timeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.calendar import long_season, season_year, strip_season
from touchline.functions.labels import category, category_key, is_cup, mapped, official_role, POSITIONS, STAFF_ROLES
from touchline.functions.minutes import show_minute, sort_minute
from touchline.functions.text import (
    cyrillic_to_latin, distinct_words, group_label, is_latin, join_key, last_word_first, latin_to_cyrillic, non_empty, search_terms, slug, squish, standard_name,
    strip_parenthesis, team_key,
)
from touchline.operators.tables import argmax_column, first_rows, numbered, ordering, union_by_name


def standard_names(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Names in Latin letters to Cyrillic, in all given columns."""
    return rows.withColumns({c: standard_name(F.col(c)) for c in columns})


def attach_category(matches: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Category data of ``catalogue(name, category, max_age)`` by name with season, with the long season, then without."""
    keys = [
        catalogue.select(join_key(F.col("name")).alias("_k"), F.lit(0).alias("_p"), "category", "max_age"),
        catalogue.select(join_key(long_season(F.col("name"))).alias("_k"), F.lit(1).alias("_p"), "category", "max_age"),
        catalogue.select(join_key(strip_season(F.col("name"))).alias("_k"), F.lit(2).alias("_p"), "category", "max_age"),
    ]
    once = reduce(DataFrame.union, keys).groupBy("_k").agg(F.min(F.struct("_p", "category", "max_age")).alias("c"))
    m = matches.withColumn("_full", F.concat_ws(" ", strip_season(F.col("competition")), "season"))
    full = once.select(F.col("_k").alias("_k1"), F.col("c").alias("_c1"))
    bare = once.select(F.col("_k").alias("_k2"), F.col("c").alias("_c2"))
    joined = m.join(full, join_key(F.col("_full")) == F.col("_k1"), "left").join(bare, join_key(strip_season(F.col("competition"))) == F.col("_k2"), "left")
    found = joined.withColumns({"category": F.coalesce("_c1.category", "_c2.category"), "max_age": F.coalesce("_c1.max_age", "_c2.max_age")})
    found = found.withColumn("category", category(F.col("category"), F.col("competition")))
    default = F.max("max_age").over(Window.partitionBy("category"))
    return found.withColumn("max_age", F.coalesce("max_age", default)).drop("_full", "_k1", "_k2", "_c1", "_c2")


def into_groups(matches: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ' (label)' to competitions that have groups: ``groups(competition, season, label, teams, ord)``, teams an array.

    Names and teams are compared trimmed, in lower case, without season; a group without season is for all.
    Of the groups with either team, in order, the first counts, unless a later one has both teams, or has
    the home team where the first has not. Matches of no group and names with a parenthesis at their end stay.
    Groups are a short list per competition, so each match meets the list of its competition in one row.
    """
    bare = F.struct(
        "ord", F.nullif(F.trim("season"), F.lit("")).alias("season"), "label", F.transform("teams", lambda t: F.lower(F.trim(t))).alias("teams")
    )
    per = groups.select(F.lower(strip_season(F.col("competition"))).alias("_k"), bare.alias("g")).groupBy("_k").agg(F.array_sort(F.collect_list("g")).alias("_g"))
    m = matches.withColumns({"_k": F.lower(strip_season(F.col("competition"))), "_h": F.lower(F.trim("home")), "_a": F.lower(F.trim("away"))}).join(per, "_k", "left")

    def has(team: str, g: Column) -> Column:
        return F.coalesce((F.col(team) != "") & F.array_contains(g["teams"], F.col(team)), F.lit(False))

    fits = F.filter("_g", lambda g: (g["season"].isNull() | g["season"].eqNullSafe(F.col("season").cast("string"))) & (has("_h", g) | has("_a", g)))
    m = m.withColumn("_fit", F.transform(fits, lambda g: F.struct(g["label"].alias("label"), has("_h", g).alias("home"), has("_a", g).alias("away"))))
    first, rest = F.get("_fit", 0), F.slice("_fit", 2, F.greatest(F.size("_fit"), F.lit(1)))
    both = F.get(F.filter(rest, lambda g: g["home"] & g["away"]), 0)["label"]
    at_home = F.get(F.filter(rest, lambda g: g["home"]), 0)["label"]
    label = F.coalesce(both, F.when(first["home"], first["label"]), at_home, first["label"])
    open_ = label.isNotNull() & ~F.col("competition").rlike(r"\([^)]*\)\s*$")
    return m.withColumn("competition", F.when(open_, F.concat("competition", F.lit(" ("), label, F.lit(")"))).otherwise(F.col("competition"))).drop("_k", "_g", "_h", "_a", "_fit")


def in_context(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows with the competition and season that their match has now (null for unknown matches)."""
    now = matches.select("match_id", "competition", "season")
    return rows.drop("competition", "season").join(now, "match_id", "left")


def competitions(matches: DataFrame) -> DataFrame:
    """One row per (competition, season): id, group, base name, cup flag, order among seasons, nesting flag."""
    rows = matches.filter("competition is not null").select("competition", "season").distinct()
    rows = rows.withColumns(
        {
            "competition_id": slug(F.concat_ws("_", "competition", "season")),
            "group_label": group_label(F.col("competition")),
            "base_name": strip_parenthesis(F.col("competition")),
            "cup": is_cup(F.col("competition")),
            "start_year": F.coalesce(season_year(F.col("season").cast("string")), F.col("season").try_cast("int")),
        }
    )
    size = F.count("*").over(Window.partitionBy("season", "base_name"))
    rows = rows.withColumn("nested", size > 1)
    order = Window.orderBy(F.col("start_year").desc_nulls_last(), F.col("cup").cast("int"), "base_name", "competition")
    return rows.withColumn("sort_order", F.row_number().over(order))


def officials(assignments: DataFrame) -> DataFrame:
    """(match_id, name, role, raw): cleaned names, role keys; a row with a raw role is preferred; one row per match, name, role."""
    rows = assignments.select("match_id", last_word_first(strip_parenthesis(F.col("name"))).alias("name"), official_role(F.col("role")).alias("role"), F.col("role").alias("raw"))
    return first_rows(rows.filter("name is not null"), ["match_id", "name", "role"], [F.col("raw").isNull(), F.col("raw")])


def staff(rows: DataFrame, coaches: DataFrame) -> DataFrame:
    """Staff with role keys; matches without staff rows fall back on ``coaches(match_id, team, name)``."""
    known = rows.select("match_id", "team", "name", mapped(F.col("role"), STAFF_ROLES).alias("role"))
    spare = coaches.join(rows.select("match_id", "team").distinct(), ["match_id", "team"], "left_anti").filter("name is not null")
    return known.unionByName(spare.select("match_id", "team", "name", F.lit("head_coach").alias("role")))


def entity_names(names: DataFrame, translations: DataFrame, languages: tuple[str, ...] = ("sq", "es", "en"), countries: DataFrame | None = None, clubs: DataFrame | None = None) -> DataFrame:
    """(name, mk, one column per language): translation (the smallest of several), else transliteration.

    ``translations(name, lang, text)``. A country's translation in ``countries(mk, one column per language)``
    wins over that, and the Latin spelling of ``clubs(original, corrected)`` (by squished lower-case name) over all.
    """
    wide = translations.groupBy("name").pivot("lang", list(languages)).agg(F.min("text"))
    rows = names.select("name").distinct().join(wide, "name", "left")
    told = {lang: F.coalesce(F.col(lang), cyrillic_to_latin(F.col("name"))) for lang in languages}
    if countries is not None:
        own = [lang for lang in languages if lang in countries.columns]
        once = countries.filter("mk is not null").groupBy(F.col("mk").alias("_mk")).agg(*[F.min(lang).alias(f"_{lang}") for lang in own])
        rows = rows.join(once, F.col("name") == F.col("_mk"), "left")
        told |= {lang: F.coalesce(F.col(f"_{lang}"), told[lang]) for lang in own}
    if clubs is not None:
        once = clubs.groupBy(join_key(F.col("original")).alias("_ck")).agg(F.min("corrected").alias("_club"))
        rows = rows.join(once, join_key(F.col("name")) == F.col("_ck"), "left")
        told = {lang: F.coalesce(F.col("_club"), c) for lang, c in told.items()}
    return rows.select("name", F.col("name").alias("mk"), *[c.alias(lang) for lang, c in told.items()])


def stadiums(records: DataFrame, matches: DataFrame) -> DataFrame:
    """(match_id, ground) of all records with sides, day, competition and category of their match."""
    context = [c for c in ("home", "away", "day", "competition", "season", "category") if c in matches.columns]
    return records.select("match_id", "ground").join(matches.select("match_id", *context), "match_id", "left")


def with_match_flag(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events with the cancelled flag that their match has now; null for unknown matches."""
    return events.drop("cancelled").join(matches.select("match_id", "cancelled"), "match_id", "left")


def counted_events(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events without those of cancelled, withdrawn and officially decided matches."""
    out = [F.col(c).eqNullSafe(True) for c in ("cancelled", "withdrawn", "official") if c in matches.columns]
    return events.join(matches.filter(reduce(Column.__or__, out)).select("match_id"), "match_id", "left_anti")


def bios(sheet: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """(player_id, position, nationality, birth, city) of a bio sheet (see ``schemas.TABLES['bios']``).

    The position group is that of the column with the largest value, the first on ties. A city in Latin
    letters goes to Cyrillic if ``cities(mk)`` knows it so.
    """
    best = mapped(argmax_column(list(POSITIONS)), POSITIONS)
    full = F.when(F.col("first_name").isNotNull() & F.col("second_name").isNotNull(), slug(F.concat_ws(" ", "first_name", "second_name")))
    rows = sheet.withColumns({"player_id": full, "position": best, "_cyrillic": F.when(is_latin(F.col("city")), latin_to_cyrillic(F.col("city")))})
    city = F.col("city")
    if cities is not None:
        rows = rows.join(cities.select(F.col("mk").alias("_cyrillic")).distinct().withColumn("_known", F.lit(True)), "_cyrillic", "left")
        city = F.when(F.col("_known"), F.col("_cyrillic")).otherwise(city)
    return rows.select("player_id", "position", "nationality", F.col("birth").try_cast("date").alias("birth"), city.alias("city"))


def display_names(rows: DataFrame, column: str, names: DataFrame, languages: tuple[str, ...] = ("mk", "sq", "es", "en")) -> DataFrame:
    """One column ``{column}_{language}`` each: the name's translation, else that of its squished lower-case key, else the name."""
    exact = names.groupBy(F.col("name").alias("_n")).agg(*[F.min(lang).alias(f"_e_{lang}") for lang in languages])
    loose = names.groupBy(join_key(F.col("name")).alias("_k")).agg(*[F.min_by(F.nullif(lang, F.lit("")), "name").alias(f"_l_{lang}") for lang in languages])
    joined = rows.join(exact, F.col(column) == F.col("_n"), "left").join(loose, join_key(F.col(column)) == F.col("_k"), "left")
    named = {f"{column}_{lang}": F.coalesce(F.col(f"_e_{lang}"), F.col(f"_l_{lang}"), F.col(column)) for lang in languages}
    return joined.withColumns(named).drop("_n", "_k", *[f"_{x}_{lang}" for x in "el" for lang in languages])


def player_display(name: Column, player_id: Column) -> Column:
    """Name of a player in a language, else the id, else '???'; blank and a written-out 'na' are no name."""
    return F.coalesce(non_empty(name), F.nullif(squish(player_id), F.lit("")), F.lit("???"))


def competition_display(name: Column, competition: Column, season: Column, shown_season: Column | None = None) -> Column:
    """Full name in a language, else the plain one; another season may be shown in place of its own."""
    text = F.coalesce(name, competition, F.lit("???"))
    if shown_season is None:
        return text
    first = F.instr(text, F.lit("") if season is None else season)
    swapped = F.concat(F.substring(text, F.lit(1), first - 1), shown_season, F.substring(text, first + F.length(season), F.lit(1 << 30)))
    return F.when((F.coalesce(season, F.lit("")) != "") & shown_season.isNotNull() & (first > 0), swapped).otherwise(text)


def resolved_sanctions(sanctions: DataFrame, teams: DataFrame) -> DataFrame:
    """(resolved): how many sanctions are of a known team."""
    return sanctions.join(teams.select("team").distinct(), "team").agg(F.count("*").alias("resolved"))


def translated(rows: DataFrame, texts: DataFrame, language: str, default: str = "mk") -> DataFrame:
    """text of rows(key): in the language, else in the default one, else the key itself. ``texts(key, lang, text)``."""
    wide = texts.filter(F.col("lang").isin(language, default)).groupBy("key").agg(
        F.max(F.when(F.col("lang") == language, F.col("text"))).alias("_a"), F.max(F.when(F.col("lang") == default, F.col("text"))).alias("_b")
    )
    return rows.join(wide, "key", "left").withColumn("text", F.coalesce("_a", "_b", "key")).drop("_a", "_b")


def sanctions_by_name(sanctions: DataFrame, names: DataFrame) -> DataFrame:
    """Sanctions with the club's original name, whichever language it is given in; unknown names stay."""
    long = names.unpivot(["name"], [c for c in names.columns if c != "name"], "lang", "spelling").select(join_key(F.col("spelling")).alias("_k"), "name")
    once = long.groupBy("_k").agg(F.min("name").alias("_name"))
    return sanctions.withColumn("_k", join_key(F.col("team"))).join(once, "_k", "left").withColumn("team", F.coalesce("_name", "team")).drop("_k", "_name")


def search_index(families: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, type, target_id, terms) of all families {type: (names with translations, id prefix)}."""
    parts = []
    for kind, (names, prefix) in families.items():
        spellings = [search_terms(F.col(c)) for c in names.columns]
        parts.append(
            names.select(
                "name", F.lit(kind).alias("type"), F.concat(F.lit(prefix), slug(F.col("name"))).alias("target_id"), distinct_words(F.trim(F.concat_ws(" ", *spellings))).alias("terms")
            )
        )
    return union_by_name(parts).distinct()


def suggestions(index: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """First matches of a search box, two characters at least."""
    from touchline.functions.text import search_matches

    return index.filter(search_matches(F.col("terms"), query)).orderBy("type", "name", "target_id").limit(limit)


def timeline(matches: DataFrame, goals: DataFrame, cards: DataFrame, substitutions: DataFrame) -> DataFrame:
    """All events of each match in order of the minute, with side and text of the minute."""
    events = union_by_name(
        [
            goals.select("match_id", "minute", F.col("kind").alias("event"), "player_id", F.col("credited").alias("team"), F.lit(1).alias("_p")),
            cards.select("match_id", "minute", F.col("color").alias("event"), "player_id", "team", F.lit(2).alias("_p")),
            substitutions.select("match_id", "minute", F.lit("substitution").alias("event"), "player_id", "team", F.lit(3).alias("_p")),
        ]
    )
    home = matches.select("match_id", team_key(F.col("home")).alias("_home"))
    rows = events.join(home, "match_id").withColumns({"at_home": team_key(F.col("team")) == F.col("_home"), "_s": sort_minute(F.col("minute")), "shown": show_minute(F.col("minute"))})
    return numbered(rows, ["match_id"], ordering("_s", "_p", "event", "player_id", "team"), "place").drop("_s", "_p", "_home")


def side_of(club: Column, home: Column, away: Column) -> Column:
    """'home' or 'away' for a club text: exact, normalised, containment, without spaces; else 'home'."""

    def bare(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), r"\s+", "")

    k, h, a = join_key(club), join_key(home), join_key(away)
    return (
        F.when(club == home, "home")
        .when(club == away, "away")
        .when(k == h, "home")
        .when(k == a, "away")
        .when(h.contains(k) | k.contains(h), "home")
        .when(a.contains(k) | k.contains(a), "away")
        .when(bare(club) == bare(home), "home")
        .when(bare(club) == bare(away), "away")
        .otherwise("home")
    )


def match_history(matches: DataFrame, names: DataFrame) -> DataFrame:
    """Matches with category, category key and both teams' display names (one dimension joined twice).

    Without a category the competition's name tells it: youth, cadets, else seniors.
    """
    told = F.when(F.col("competition").contains("Младинска"), "Младинци").when(F.col("competition").contains("Кадетска"), "Кадети").otherwise("Сениори")
    h = names.select(F.col("name").alias("home"), F.col("en").alias("home_name"))
    a = names.select(F.col("name").alias("away"), F.col("en").alias("away_name"))
    rows = matches.withColumn("category", F.coalesce("category", told)).withColumn("category_key", category_key(F.col("category")))
    return rows.join(h, "home", "left").join(a, "away", "left")


def profile_exclusions(rows: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct names of rows that are in ``names``: who gets no page."""
    return rows.join(names.select(column).distinct(), column, "left_semi").select(column).distinct()


def alphabet_index(rows: DataFrame, column: str, locale: str = "mk") -> DataFrame:
    """(letter, names in locale order): initial letters only."""
    lettered = rows.select(F.upper(F.substring(column, 1, 1)).alias("letter"), F.col(column).alias("name")).distinct().filter(F.col("letter").rlike(r"^\p{L}$"))
    ordered = lettered.withColumn("_r", F.row_number().over(Window.partitionBy("letter").orderBy(F.collate(F.col("name"), locale), "name")))
    return ordered.groupBy("letter").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "name"))), lambda x: x["name"]).alias("names"))
