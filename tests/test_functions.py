import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.functions import calendar, labels, minutes, text


def values(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("c"))).collect()]


CASES = [
    (text.squish, ["  a b\t c ", None, ""], ["a b c", None, ""]),
    (text.join_key, ["КУП  Сениори", "ÇË "], ["куп сениори", "çë"]),
    (text.team_key, [" ", "A b"], [None, "a b"]),
    (text.club_key, ["ЖФК  Тиверија", "fk Ohrid", "FKX"], ["тиверија", "ohrid", "fkx"]),
    (text.non_empty, ["", " na ", "NA", "x"], [None, None, None, "x"]),
    (text.is_latin, ["abc", "абв", "ž", None, "12"], [True, False, True, False, False]),
    (text.latin_to_cyrillic, ["Shkendija", "ohrid  maxi", "", None], ["Шкендија", "Охрид  Макси", "", None]),
    (text.cyrillic_to_latin, ["марија ѓорѓиева", "ана-марија џ"], ["Marija Gjorgjieva", "Ana-Marija Dž"]),
    (text.standard_name, ["Ana", "Ана"], ["Ана", "Ана"]),
    (text.slug, ["Ѓорче Петров / U17", "  Çë!! ", "a__b"], ["gjorce_petrov_u17", "ce", "a_b"]),
    (text.search_terms, ["Џака", "Xhaka", "Жана", " ", None, "Schmidt"], ["zaka", "zaka", "zana", "", "", "smidt"]),
    (text.last_word, ["Ana Marija K", "X"], ["K", "X"]),
    (text.last_word_first, ["Popova Ana", "X", "A B C"], ["Ana Popova", "X", "C A B"]),
    (text.reversed_words, ["a b c"], ["c b a"]),
    (text.mapped_list, ["A / B;A"], ["A / B"]),
    (text.strip_parenthesis, ["Ana (Skopje)", "Ana"], ["Ana", "Ana"]),
    (text.group_label, ["Liga (Istok)", "Liga"], ["Istok", None]),
    (text.quiet_capitals, ["ПРВА лига (куп) НА Рм-офл", "МФЛ ЗАПАД, Југ", "Прва Лига", None], ["Прва Лига (КУП) на Рм-Офл", "МФЛ запад, Југ", "Прва Лига", None]),
    (text.note_lines, ["a\\n\\nb\r\n"], ["a\nb"]),
    (minutes.parse_minute, ["45+1", "67'", "x", "", None, "90+3"], [451, 67, None, None, None, 903]),
    (labels.is_cup, ["КУП 25/26", "Куп елиминација", None], [True, False, False]),
    (labels.category, ["КАДЕТИ", "помали петлиња", "  сениори ", "друго"], ["Кадети", "Помали петлиња", "Сениори", "друго"]),
    (labels.round_order, ["1/8", "1/64", "Ф", "12", "x", None], [4.0, 1.0, 7.0, 12.0, 99.0, None]),
    (labels.official_role, ["Главен судија", "VAR operator", "Assistant 2", "Чуден", " "], ["referee_main", "var_operator", "referee_asst2", "referee_role_cuden", None]),
    (calendar.parse_date, ["01.08.2025", "31.02.2025", "x"], [dt.date(2025, 8, 1), None, None]),
    (calendar.season_year, ["25/26", "2025/26", "x"], [2025, 2025, None]),
    (calendar.strip_season, ["Liga 2025/26", "Liga 25/26", "Liga 2025-2026", "Liga"], ["Liga"] * 4),
    (calendar.long_season, ["Liga 25/26"], ["Liga 2025/26"]),
]


@pytest.mark.parametrize("function,inputs,expected", CASES, ids=[f"{c[0].__name__}_{i}" for i, c in enumerate(CASES)])
def test_text_functions(spark, function, inputs, expected):
    assert values(spark, function, inputs) == expected


def test_minutes(spark):
    m = [451, 90, 903, 1052, None, 141]
    assert values(spark, minutes.base_minute, m, "int") == [45.0, 90.0, 90.0, 10.0, None, 14.0]
    assert values(spark, minutes.sort_minute, m, "int") == [45.001, 90.0, 90.003, 10.052, 999.0, 14.001]
    assert values(spark, minutes.show_minute, m, "int") == ["45+1", "90", "90+3", "10+52", "after match", "14+1"]
    assert values(spark, lambda c: minutes.clamp(c, F.lit(90)), [-5, 100, None, 30], "int") == [0, 90, None, 30]


def test_dates(spark):
    days = [dt.date(2025, 8, 1), dt.date(2025, 7, 31), None]
    assert values(spark, calendar.season_start, days, "date") == [2025, 2024, None]
    assert values(spark, lambda c: calendar.season_label(calendar.season_start(c)), [dt.date(1999, 9, 1), dt.date(2025, 9, 1)], "date") == ["99/00", "25/26"]
    row = spark.sql("select date'2024-06-20' a, date'2024-07-05' b, date'2024-11-30' c, date'2025-01-10' d, date'2025-04-01' e")
    col = F.col
    got = row.select(
        calendar.in_transfer_window(col("a"), col("e")), calendar.in_transfer_window(col("c"), col("d")), calendar.in_transfer_window(col("e"), col("e")),
        calendar.interval_gap(col("a"), col("b"), col("c"), col("d")), calendar.gap_threshold(col("b")), calendar.gap_threshold(col("e")), calendar.age_on(col("a"), col("e")),
    ).first()
    assert list(got) == [True, True, False, 148, 60, 15, 0]
    assert spark.sql("select 'Бараж лига' n, '25/26' s").select(calendar.play_off_season(col("n"), col("s"))).first()[0] == "24/25"


def test_cup_rounds(spark):
    rows = [("c", "1")] * 8 + [("c", "2")] * 4 + [("c", "3")] * 1 + [("c", "4")] * 1 + [("c", "1/8")] * 3
    got = {r["round"]: r["round_key"] for r in labels.cup_round_keys(spark.createDataFrame(rows, "cup string, round string"), ["cup"]).collect()}
    assert got == {"1": "cup_round_1_8", "2": "cup_round_1_4", "3": "cup_round_1_2", "4": "cup_round_final", "1/8": None}


def test_search_is_script_independent(spark):
    names = spark.createDataFrame([("Џака",), ("Жана",)], "n string")
    hits = names.select(text.search_matches(text.search_terms(F.col("n")), "xhak").alias("a"), text.search_matches(text.search_terms(F.col("n")), "ž").alias("b"))
    assert [tuple(r) for r in hits.collect()] == [(True, False), (False, False)]
