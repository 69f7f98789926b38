"""Dates from many spellings, cycles and congresses. What can't be read is null, never a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(col: Column) -> Column:
    """The date at the start of an ISO text, with or without a time."""
    return F.try_to_date(F.left(F.btrim(col), F.lit(10)), "yyyy-MM-dd")


def us_date(col: Column) -> Column:
    """M/D/YYYY, with or without a time after it."""
    return F.try_to_date(F.regexp_extract(col, r"^\s*(\d{1,2}/\d{1,2}/\d{4})", 1), "M/d/yyyy")


def compact_date(col: Column) -> Column:
    """yyyyMMdd, whatever follows."""
    return F.try_to_date(F.regexp_extract(col, r"^\s*(\d{8})", 1), "yyyyMMdd")


def epoch_date(col: Column) -> Column:
    """The UTC date of "/Date(milliseconds)/"."""
    return F.to_date(F.timestamp_millis(F.regexp_extract(col, r"/Date\((-?\d+)", 1).try_cast("long")))


def month_name_date(col: Column) -> Column:
    """12-Mar-2020 or March 12, 2020."""
    return F.coalesce(F.try_to_date(F.btrim(col), "d-MMM-yyyy"), F.try_to_date(F.btrim(col), "MMMM d, yyyy"))


def any_date(col: Column) -> Column:
    return F.coalesce(iso_date(col), us_date(col), compact_date(col), epoch_date(col), month_name_date(col))


def even_cycle(date: Column) -> Column:
    """The even year that a date's two-year cycle ends in."""
    return (F.year(date) + F.year(date) % 2).cast("int")


def state_cycle(date: Column, stated: Column | None = None) -> Column:
    """A stated numeric election year, else the calendar year."""
    own = F.year(date).cast("int")
    return F.coalesce(stated.try_cast("int"), own) if stated is not None else own


def congress_of(year: Column) -> Column:
    """The number of the congress that sits in a year (the 1st began in 1789)."""
    return F.floor((year - 1789) / 2).cast("int") + 1


def lookback(date: Column, days: int = 550, floor: str = "2000-01-01") -> Column:
    return F.greatest(F.date_sub(date, days), F.lit(floor).cast("date"))


def is_fresh(then: Column, now: Column, days: int = 45) -> Column:
    """Whether `then` is less than so many days before `now`; an unknown time is stale."""
    return F.coalesce(F.datediff(now, then) < days, F.lit(False))
