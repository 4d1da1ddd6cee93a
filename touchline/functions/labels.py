"""Ladders that map names of competitions, categories, rounds, roles and events to keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.text import slug, squish

# ---- Fixed values: patterns tried in order, and their labels.

CATEGORIES = (
    (r"(помали|pomali).{0,10}(петли|petli)|(петли|petli).{0,10}(помали|pomali)", "Помали петлиња"),
    (r"петлиња|petlinja|petlinjë", "Петлиња"),
    (r"(млади|помлади|mladi|young).{0,10}(пионер|pioner)", "Млади Пионери"),
    (r"пионер|pioner|pioneer", "Пионери"),
    (r"кадет|kadet|cadet", "Кадети"),
    (r"младин|mladin|youth|juven", "Младинци"),
    (r"детска|kids?|child", "Детска лига"),
    (r"сениор|senior", "Сениори"),
)
CATEGORY_KEYS = {
    "Младинци": "category_youth", "Кадети": "category_cadet", "Помали петлиња": "category_pomali_petlinja", "Петлиња": "category_petlinja",
    "Млади Пионери": "category_mladi_pioneri", "Пионери": "category_pioneri", "Детска лига": "category_kids",
}
YOUTH = ("Младинци", "Кадети", "Пионери", "Млади Пионери", "Помали петлиња", "Петлиња", "Детска лига")
YOUTH_WORDS = (
    r"ффм|ffm|помали[\s/-]*петлиња|помали[\s/-]*петлинја|петлиња|petlinja|petlinjë|детска|detska|kids|child|children|младин|mladin|junior|youth|juven"
    r"|пионер|pioner|кадет|kadet|cadet"
)
ROUND_ORDER = (("1/64", 1.0), ("1/32", 2.0), ("1/16", 3.0), ("1/8", 4.0), ("1/4", 5.0), ("1/2", 6.0), ("3/4", 6.5))
DIVISIONS = ((r"прва\s+мфл|prva\s+mfl", "Прва МФЛ"), (r"втора\s+мфл|vtora\s+mfl", "Втора МФЛ"), (r"трета\s+мфл|treta\s+mfl", "Трета МФЛ"))
POSITIONS = {
    "GK": "goalkeeper", "DL": "defender", "DC": "defender", "DR": "defender", "DM": "midfielder", "WBL": "defender", "WBR": "defender", "ML": "midfielder",
    "MC": "midfielder", "MR": "midfielder", "AML": "forward", "AMC": "forward", "AMR": "forward", "SC": "forward",
}
ROLE_ORDER = ("referee_main", "referee_asst1", "referee_asst2", "referee_asst4", "var_referee", "var_assistant", "var_operator", "match_delegate", "match_kontrolor")
SHORT_MATCHES = {60: ("Кадети", "Кадетска"), 80: ("Младинци", "Младинска", "Петлиња", "Помали петлиња")}
OFFICIAL_ROLES = (
    (r"главен\s+судија|main\s+referee|referee\s+main", "referee_main"),
    (r"(^|\b)1\.?\s*помошен|assistant\s*1|1st\s*assistant|first\s*assistant", "referee_asst1"),
    (r"(^|\b)2\.?\s*помошен|assistant\s*2|2nd\s*assistant|second\s*assistant", "referee_asst2"),
    (r"четврт|4\.?\s*судија|assistant\s*4|fourth\s*official", "referee_asst4"),
    (r"авар|avar|var\s*assistant|вар\s*2|var\s*2", "var_assistant"),
    (r"вар\s*оператор|var\s*operator|вар\s*3|var\s*3|вар\s*4|var\s*4", "var_operator"),
    (r"(^|\b)вар\s*судија|var\s*referee|вар\s*1|var\s*1", "var_referee"),
    (r"делегат|delegate", "match_delegate"),
    (r"контролор|controller", "match_kontrolor"),
    (r"комесар\s*за\s*безбедност|security\s*commissioner", "security_commissioner"),
)
STAFF_ROLES = {
    "Главен тренер": "head_coach", "Помошен тренер": "assistant_coach", "Физиотерапевт": "physiotherapist", "Доктор": "doctor",
    "Клупски претставник": "club_representative", "Администратор": "administrator", "Кондициски тренер": "fitness_coach",
    "Безбедносно лице": "security_commissioner", "Тренер на голмани": "goalkeeping_coach",
}
EVENT_CLASSES = {
    "goal": "goal", "penalty": "penalty", "own_goal": "own_goal", "yellow": "yellow", "red": "red", "second_yellow": "second_yellow",
    "substitution": "substitution_in", "substitution_out": "substitution_out",
}
SENIOR_WORDS = "senior|сениори|младинци|youth|кадет|kadet|cadet"
CHILD_WORDS = "пионери|pioner|детска|kids|petlinja"


def category(raw: Column, competition: Column | None = None) -> Column:
    """Normalised category from the category text and the competition name; unmatched text stays, squished."""
    text = squish(F.coalesce(raw, F.lit("")))
    both = F.lower(F.concat_ws(" ", text, squish(F.coalesce(competition, F.lit(""))) if competition is not None else F.lit("")))
    out = F.lit(None).cast("string")
    for pattern, label in reversed(CATEGORIES):
        out = F.when(both.rlike(pattern), label).otherwise(out)
    return F.coalesce(out, text)


def category_key(normal: Column) -> Column:
    return F.coalesce(mapped(normal, CATEGORY_KEYS), F.lit("category_senior"))


def is_youth(raw: Column, competition: Column) -> Column:
    """Whether a competition is one of the young, by its category or by a word of category or name."""
    words = F.lower(squish(F.concat_ws(" ", raw, competition)))
    return category(raw, competition).isin(*YOUTH) | words.rlike(YOUTH_WORDS)


def division(competition: Column) -> Column:
    """Division of a league by its name, else null."""
    text = F.lower(F.trim(competition))
    return F.coalesce(*[F.when(text.rlike(pattern), label) for pattern, label in DIVISIONS])


def role_order(role: Column) -> Column:
    """Place of an official's role in a match; unknown roles after the known ones."""
    known = F.array_position(F.array(*[F.lit(r) for r in ROLE_ORDER]), role)
    return F.when(F.coalesce(known, F.lit(0)) > 0, known).otherwise(len(ROLE_ORDER) + 1)


def match_duration(category_label: Column) -> Column:
    """Minutes of a match: cadets 60, youth and the younger 80, others 90."""
    out = F.lit(90)
    for minutes, labels in SHORT_MATCHES.items():
        out = F.when(category_label.isin(*labels), minutes).otherwise(out)
    return out


def is_cup(name: Column) -> Column:
    text = F.lower(squish(F.coalesce(name, F.lit(""))))
    return text.rlike("куп|kup") & ~text.rlike("елиминац|eliminac")


def is_senior(category_text: Column) -> Column:
    """Categories that a child cannot play in; null is False."""
    return F.coalesce(F.lower(category_text).rlike(SENIOR_WORDS), F.lit(False))


def is_child(category_text: Column) -> Column:
    return F.coalesce(F.lower(category_text).rlike(CHILD_WORDS), F.lit(False))


def round_order(c: Column) -> Column:
    """Order of a round name: fractions of a cup, the final, plain numbers; unknown names last."""
    out = F.when(c.rlike(r"[Фф]$|final"), 7.0).when(c.rlike(r"^\d+$"), c.try_cast("double")).otherwise(99.0)
    for part, value in reversed(ROUND_ORDER):
        out = F.when(c.contains(part), value).otherwise(out)
    return F.when(c.isNotNull(), out)


def cup_round_keys(matches: DataFrame, by: list[str], round_column: str = "round") -> DataFrame:
    """(by, round, matches, round_key): the knock-out stage of each numeric cup round, from its number of matches.

    One match is the final, or a semi-final if a later round has one match too; else the bracket
    that twice the matches fill up to a power of two names the stage. Other names get no key.
    """
    counted = matches.withColumn("round", squish(F.col(round_column).cast("string"))).filter("round is not null and round <> ''").groupBy(*by, "round").agg(F.count("*").alias("matches"))
    later = Window.partitionBy(*by).orderBy(round_order(F.col("round")), "round").rowsBetween(1, Window.unboundedFollowing)
    single_later = F.coalesce(F.max((F.col("matches") == 1).cast("int")).over(later), F.lit(0)) == 1
    bracket = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("matches") * 2)))
    stage = F.when(bracket >= 32, "cup_round_1_16").when(bracket >= 16, "cup_round_1_8").when(bracket >= 8, "cup_round_1_4").when(bracket >= 4, "cup_round_1_2").otherwise("cup_round_final")
    one = F.when(single_later, "cup_round_1_2").otherwise("cup_round_final")
    return counted.withColumn("round_key", F.when(~F.col("round").rlike(r"^\d+$"), None).when(F.col("matches") == 1, one).otherwise(stage))


def official_role(c: Column) -> Column:
    """Role key of an official; a key from the slug for unknown roles, null for blank ones."""
    text = F.lower(squish(c))
    out = F.when(text != "", F.concat(F.lit("referee_role_"), slug(text)))
    for pattern, key in reversed(OFFICIAL_ROLES):
        out = F.when(text.rlike("(?U)" + pattern), key).otherwise(out)
    return out


def mapped(c: Column, values: dict[str, str]) -> Column:
    """Exact look-up; unknown values give null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def score_text(home: Column, away: Column, cancelled: Column, official: Column, pens_home: Column | None = None, pens_away: Column | None = None) -> Column:
    """Displayed score: cancelled label, '-', 'a - b', shoot-out in parentheses, '*' for official results."""
    score = F.concat_ws(" - ", home.cast("string"), away.cast("string"))
    if pens_home is not None and pens_away is not None:
        score = F.when(pens_home.isNotNull() & pens_away.isNotNull(), F.concat(score, F.format_string(" (%d - %d)", pens_home, pens_away))).otherwise(score)
    score = F.when(official.eqNullSafe(True), F.concat(score, F.lit("*"))).otherwise(score)
    return F.when(cancelled.eqNullSafe(True), "cancelled").when(home.isNull() | away.isNull(), "-").otherwise(score)
