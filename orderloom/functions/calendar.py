"""Calendar columns: parts of the date, pay days, Polish holidays, cyclic pairs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Polish public holidays on a fixed day as (month, day, first year).
FIXED_HOLIDAYS = [
    (1, 1, 0),
    (1, 6, 2011),
    (5, 1, 0),
    (5, 3, 0),
    (8, 15, 0),
    (11, 1, 0),
    (11, 11, 0),
    (12, 24, 2025),
    (12, 25, 0),
    (12, 26, 0),
]
# Holidays that move with Easter, in days after Easter Sunday
# (Easter Sunday, Easter Monday, Pentecost, Corpus Christi).
EASTER_OFFSETS = [0, 1, 49, 60]

PAYDAY_START = [1, 2, 3]
PAYDAY_TENTH = [10, 11, 12]

# Periods of the cyclic columns.
CYCLIC_PERIODS = {"hour_of_day": 24, "day_of_week": 7}


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column '{column}' is required")


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter as a DATE, by the Meeus/Jones/Butcher computus."""
    golden = year % 19
    century = _div(year, 100)
    in_century = year % 100
    epact = (19 * golden + century - _div(century, 4) - _div(century - _div(century + 8, 25) + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * _div(in_century, 4) - epact - in_century % 4) % 7
    fix = _div(golden + 11 * epact + 22 * weekday, 451)
    days = epact + weekday - 7 * fix + 114
    return F.make_date(year, _div(days, 31).cast("int"), (days % 31 + 1).cast("int"))


def is_holiday(day: Column) -> Column:
    """Whether a DATE is a Polish public holiday, in any year."""
    year = F.year(day)
    fixed = [(F.month(day) == month) & (F.dayofmonth(day) == dom) & (year >= first) for month, dom, first in FIXED_HOLIDAYS]
    since = F.datediff(day, easter_sunday(year))
    return reduce(lambda x, y: x | y, fixed, since.isin(EASTER_OFFSETS))


def add_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    _require(df, day)
    d = F.col(day)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "day_of_month": F.dayofmonth(d),
            "month": F.month(d),
            "quarter": F.quarter(d),
            "year": F.year(d),
            "is_weekend": F.weekday(d).isin(5, 6).cast("int"),
            "is_holiday": F.coalesce(is_holiday(F.to_date(d)), F.lit(False)).cast("int"),
        }
    )


def add_paydays(df: DataFrame, day: str = "date") -> DataFrame:
    _require(df, day)
    dom = F.dayofmonth(day)
    return df.withColumns(
        {
            "is_payday_1st": dom.isin(PAYDAY_START).cast("int"),
            "is_payday_10th": dom.isin(PAYDAY_TENTH).cast("int"),
            "is_payday": dom.isin(PAYDAY_START + PAYDAY_TENTH).cast("int"),
        }
    )


def cyclic_pair(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def add_extended_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Weekday, month, day of year, ISO week, weekend flag and their cyclic pairs."""
    _require(df, day)
    d = F.col(day)
    columns = {
        "weekday": F.weekday(d),
        "month": F.month(d),
        "day_of_month": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": F.weekday(d).isin(5, 6).cast("int"),
    }
    for name, value, period in (
        ("weekday", F.weekday(d), 7),
        ("month", F.month(d), 12),
        ("day", F.dayofyear(d), 365),
    ):
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclic_pair(value, period)
    return df.withColumns(columns)


def encode_cyclic(df: DataFrame, periods: dict[str, int] | None = None) -> DataFrame:
    """Replace each present column by its sine and cosine; skip absent ones."""
    for column, period in (periods or CYCLIC_PERIODS).items():
        if column in df.columns:
            sine, cosine = cyclic_pair(F.col(column), period)
            df = df.withColumns({f"{column}_sin": sine, f"{column}_cos": cosine}).drop(column)
    return df


def log_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each present column by ln(1 + x); skip absent ones."""
    return df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in columns if c in df.columns})
