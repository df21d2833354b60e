"""Calendar features of a timestamp column (session time zone UTC)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

def calendar_parts(t: Column) -> dict[str, Column]:
    """year, month, day, hour, minute and second as integers."""
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "minute": F.minute(t),
        "second": F.second(t),
    }


def days_in_month(t: Column) -> Column:
    """Length of the month; every fourth year is a leap year, centuries included."""
    extra = (F.month(t) == 2) & (F.year(t) % 100 == 0) & (F.year(t) % 400 != 0)
    return F.dayofmonth(F.last_day(t)) + extra.cast("int")


def cyclic_time(t: Column) -> dict[str, Column]:
    """Sine of the position in the year, month, week (Sunday is day 1), day, hour and minute."""
    turns = {
        "month_sin": F.month(t) / F.lit(12),
        "day_sin": F.dayofmonth(t) / days_in_month(t),
        "weekday_sin": F.dayofweek(t) / F.lit(7),
        "hour_sin": F.hour(t) / F.lit(24),
        "minute_sin": F.minute(t) / F.lit(60),
        "second_sin": F.second(t) / F.lit(60),
    }
    return {name: F.sin(F.lit(2 * math.pi) * turn) for name, turn in turns.items()}


# Which scaled features belong to each frequency unit, in output order.
SCALED_FEATURES: dict[str, tuple[str, ...]] = {
    "Y": (),
    "Q": ("month_of_year",),
    "M": ("month_of_year",),
    "W": ("day_of_month", "week_of_year"),
    "D": ("day_of_week", "day_of_month", "day_of_year"),
    "B": ("day_of_week", "day_of_month", "day_of_year"),
    "H": ("hour_of_day", "day_of_week", "day_of_month", "day_of_year"),
    "T": ("minute_of_hour", "hour_of_day", "day_of_week", "day_of_month", "day_of_year"),
    "S": (
        "second_of_minute", "minute_of_hour", "hour_of_day", "day_of_week", "day_of_month",
        "day_of_year",
    ),
}

# Accepted spellings of the frequency units.
UNIT_ALIASES = {
    "a": "Y", "y": "Y", "ye": "Y", "q": "Q", "qe": "Q", "m": "M", "me": "M", "w": "W", "d": "D",
    "b": "B", "h": "H", "t": "T", "min": "T", "s": "S",
}

# Integer marks per frequency unit, in output order.
INTEGER_MARKS: dict[str, tuple[str, ...]] = {
    "Y": (),
    "M": ("month",),
    "W": ("month",),
    "D": ("month", "day", "weekday"),
    "B": ("month", "day", "weekday"),
    "H": ("month", "day", "weekday", "hour"),
    "T": ("month", "day", "weekday", "hour", "minute"),
}


def parse_frequency(freq: str) -> tuple[int, str]:
    """Multiple and unit of a frequency such as ``h``, ``15min`` or ``2D``."""
    match = re.fullmatch(r"(\d*)([A-Za-z]+)", freq.strip())
    unit = UNIT_ALIASES.get(match.group(2).lower()) if match else None
    if unit is None:
        raise ValueError(f"unsupported frequency {freq!r}; use one of Y Q M W D B H T/min S")
    return int(match.group(1) or 1), unit


def features_for_freq(freq: str) -> tuple[str, ...]:
    """Names of the scaled features of a frequency."""
    return SCALED_FEATURES[parse_frequency(freq)[1]]


def _scaled(t: Column) -> dict[str, Column]:
    fractions = {
        "second_of_minute": F.second(t) / F.lit(59.0),
        "minute_of_hour": F.minute(t) / F.lit(59.0),
        "hour_of_day": F.hour(t) / F.lit(23.0),
        "day_of_week": F.weekday(t) / F.lit(6.0),
        "day_of_month": (F.dayofmonth(t) - 1) / F.lit(30.0),
        "day_of_year": (F.dayofyear(t) - 1) / F.lit(365.0),
        "month_of_year": (F.month(t) - 1) / F.lit(11.0),
        "week_of_year": (F.weekofyear(t) - 1) / F.lit(52.0),
    }
    return {name: fraction - F.lit(0.5) for name, fraction in fractions.items()}


def time_features(t: Column, freq: str = "h") -> dict[str, Column]:
    """Calendar features scaled to [-0.5, 0.5] for a frequency."""
    every = _scaled(t)
    return {name: every[name] for name in features_for_freq(freq)}


def time_marks(t: Column, freq: str = "h") -> dict[str, Column]:
    """Integer calendar marks for a frequency; minutes are quarter hours 0 to 3."""
    unit = parse_frequency(freq)[1]
    if unit not in INTEGER_MARKS:
        raise ValueError(f"no integer marks for frequency {freq!r}")
    every = {
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "weekday": F.weekday(t),
        "hour": F.hour(t),
        "minute": F.floor(F.minute(t) / F.lit(15)).cast("int"),
    }
    return {name: every[name] for name in INTEGER_MARKS[unit]}


# Microseconds per fixed-length unit.
UNIT_MICROS = {"S": 1_000_000, "T": 60_000_000, "H": 3_600_000_000, "D": 86_400_000_000}


def future_time(last: Column, step: Column, freq: str) -> Column:
    """Timestamp ``step`` (1, 2, ...) periods after ``last``.

    Business days, weeks (Sunday), months, quarters and years (their last days) count from the first
    such day on or after ``last`` and keep its time of day.
    """
    multiple, unit = parse_frequency(freq)
    step, last = step.cast("long"), last.cast("timestamp")
    if unit in UNIT_MICROS:
        return F.timestamp_micros(F.unix_micros(last) + step * F.lit(multiple * UNIT_MICROS[unit]))
    time_of_day = F.unix_micros(last) - F.unix_micros(F.date_trunc("day", last))
    steps = step * F.lit(multiple)
    day = F.to_date(last)
    weekday = F.weekday(last)
    if unit == "B":
        into_weekend = F.greatest(weekday - 4, F.lit(0))
        wait = F.when(into_weekend > 0, 3 - into_weekend).otherwise(0)
        first_weekday = F.when(into_weekend > 0, 0).otherwise(weekday)
        target = F.date_add(
            day, (wait + steps + 2 * F.floor((first_weekday + steps) / F.lit(5))).cast("int")
        )
    elif unit == "W":
        target = F.date_add(day, (6 - weekday + 7 * steps).cast("int"))
    elif unit == "M":
        target = F.last_day(F.add_months(F.last_day(day), steps.cast("int")))
    elif unit in ("Q", "Y"):
        months, period = (3, "quarter") if unit == "Q" else (12, "year")
        begin = F.to_date(F.date_trunc(period, last))
        target = F.last_day(F.add_months(begin, (months - 1 + months * steps).cast("int")))
    else:
        raise ValueError(f"no future timestamps for frequency {freq!r}")
    return F.timestamp_micros(F.unix_micros(target.cast("timestamp")) + time_of_day)
