"""Amounts of money as decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# The CPI-U's annual averages (1982-84 = 100), series CUUR0000SA0 of the Bureau of Labor Statistics; the last two
# are monthly figures, as the years' averages weren't published. Years that aren't here are left as they are.
CPI = {
    2000: 172.2, 2001: 177.1, 2002: 179.9, 2003: 184.0, 2004: 188.9, 2005: 195.3, 2006: 201.6, 2007: 207.342, 2008: 215.303, 2009: 214.537,
    2010: 218.056, 2011: 224.939, 2012: 229.594, 2013: 232.957, 2014: 236.736, 2015: 237.017, 2016: 240.007, 2017: 245.12, 2018: 251.107, 2019: 255.657, 2020: 258.811, 2021: 270.97, 2022: 292.655, 2023: 304.702, 2024: 313.689, 2025: 322.5, 2026: 329.8,
}
BASE_YEAR = 2026


def money(col: Column) -> Column:
    """An amount without dollar signs and commas; what isn't a number is null, never 0."""
    return F.regexp_replace(F.btrim(col), "[$,]", "").try_cast(MONEY)


def cpi_adjusted(amount: Column, year: Column, base: int = BASE_YEAR) -> Column:
    """The amount in dollars of the base year; unknown years are not adjusted, a null amount is 0."""
    table = F.create_map(*[F.lit(x) for y, v in CPI.items() for x in (y, CPI[base] / v)])
    return F.coalesce(amount.cast("double"), F.lit(0.0)) * F.coalesce(F.try_element_at(table, year.cast("int")), F.lit(1.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where there is no whole."""
    return F.when(whole > 0, part / whole)
