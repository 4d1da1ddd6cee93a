"""Dates, seasons and gaps. ``as_of`` dates are parameters; nothing reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months in which players may move freely between clubs, and the winter months.
SUMMER_WINDOW = (6, 7, 8, 9)
WINTER_WINDOW = (11, 12, 1, 2)


def parse_date(c: Column) -> Column:
    """'dd.MM.yyyy' to a date, anything else to null."""
    return F.try_to_timestamp(c, F.lit("dd.MM.yyyy")).cast("date")


def kick_off(day: Column, time: Column) -> Column:
    """Time stamp of a text date and text time; the date alone where the time is missing or bad."""
    return F.coalesce(F.try_to_timestamp(F.concat_ws(" ", day, time), F.lit("dd.MM.yyyy HH:mm")), F.try_to_timestamp(day, F.lit("dd.MM.yyyy")))


def season_start(day: Column) -> Column:
    """First year of the season of a date; seasons begin in August."""
    return F.when(F.month(day) >= 8, F.year(day)).otherwise(F.year(day) - 1)


def season_label(start_year: Column) -> Column:
    """2025 to '25/26'."""
    return F.format_string("%02d/%02d", F.pmod(start_year, F.lit(100)).cast("int"), F.pmod(start_year + 1, F.lit(100)).cast("int"))


def season_year(label: Column) -> Column:
    """First year in '25/26' or '2025/26' as four digits, else null."""
    year = F.nullif(F.regexp_extract(label, r"(\d{2,4})\s*/", 1), F.lit("")).try_cast("int")
    return F.when(year < 100, year + 2000).otherwise(year)


def play_off_season(name: Column, label: Column) -> Column:
    """The season before, for play-off competitions; others keep theirs."""
    return F.when(name.rlike(r"(?iu)(?U)\bбараж\b|\bbaraz"), season_label(season_year(label) - 1)).otherwise(label)


def strip_season(name: Column) -> Column:
    """Competition name without a trailing season in any of its four spellings."""
    return F.trim(F.regexp_replace(name, r"\s*(\d{4}-\d{4}|\d{4}/\d{4}|\d{4}/\d{2}|\d{2}/\d{2})\s*$", ""))


def long_season(name: Column) -> Column:
    """'25/26' to '2025/26' wherever it stands alone in a text."""
    return F.regexp_replace(name, r"(?<!\d)(\d{2})/(\d{2})(?!\d)", "20$1/$2")


def age_on(birth: Column, as_of: Column) -> Column:
    """Whole years by days / 365.25."""
    return F.floor(F.datediff(as_of, birth) / F.lit(365.25))


def in_transfer_window(a: Column, b: Column) -> Column:
    """Either date in summer, or both in winter; null dates are in none."""
    summer = F.month(a).isin(*SUMMER_WINDOW) | F.month(b).isin(*SUMMER_WINDOW)
    return F.coalesce(summer | (F.month(a).isin(*WINTER_WINDOW) & F.month(b).isin(*WINTER_WINDOW)), F.lit(False))


def interval_gap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Days between two intervals, negative where they overlap."""
    return F.datediff(F.greatest(start_a, start_b), F.least(end_a, end_b))


def gap_threshold(boundary: Column, summer: int = 60, other: int = 15) -> Column:
    return F.when(F.month(boundary).isin(6, 7), summer).otherwise(other)


def local_time(c: Column, zone: str = "Europe/Skopje") -> Column:
    """The instant at which clocks in ``zone`` show a time stamp without zone (its clock time is kept)."""
    return F.to_utc_timestamp(c, zone)
