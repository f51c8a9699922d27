"""Expressions on user attributes. Every clock input is the explicit ``as_of`` date."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: width of one expertise class.
CLASS_WIDTH = 0.05


def _year_sum(years: Column, term) -> Column:
    return F.aggregate(years, F.lit(0.0), lambda total, year: total + term(year))


def elite_score(years: Column, as_of: datetime.date) -> Column:
    """Recency-weighted share of elite years; 0 where there are none."""
    next_year = float(as_of.year + 1)
    base = _year_sum(years, lambda year: year)
    recent = _year_sum(years, lambda year: year / (F.lit(next_year) - year))
    return F.when(base != 0.0, recent / base).otherwise(F.lit(0.0))


def elite_score_v0(years: Column, as_of: datetime.date) -> Column:
    """Earlier score: whole-number quotients, added up and not normalised."""
    next_year = as_of.year + 1
    total = _year_sum(years, lambda year: F.floor(year / (F.lit(next_year) - year)))
    return F.coalesce(total, F.lit(0.0)).cast("long")


def elite_category(score: Column) -> Column:
    """Expertise class of a score."""
    return F.floor(score / F.lit(CLASS_WIDTH)).cast("int")


def months_since(year_month: Column, as_of: datetime.date) -> Column:
    """Whole months since the first of a ``YYYY-MM`` month; null where it is malformed."""
    start = F.try_to_date(year_month, "yyyy-MM")
    return F.floor(F.months_between(F.lit(as_of), start)).cast("double")


def calendar_months_since(year_month: Column, as_of: datetime.date) -> Column:
    """Difference of the calendar months, read from the text itself."""
    year = F.split_part(year_month, F.lit("-"), F.lit(1)).try_cast("long")
    month = F.split_part(year_month, F.lit("-"), F.lit(2)).try_cast("long")
    return F.lit(as_of.year * 12 + as_of.month) - (year * 12 + month)


def map_total(slots: Column) -> Column:
    """Sum of a map's values, absent ones left out."""
    return F.aggregate(
        F.map_values(slots), F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0))
    )


def category_slug(category: Column) -> Column:
    """Lower-cased name with underscores, as prediction files are called."""
    return F.translate(F.lower(category), " ", "_")
