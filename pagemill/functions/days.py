"""Day of a traffic file and its index in the sampled window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# First day and length of the sampled window, and where the eight date
# digits of a traffic file name start (1-based).
FIRST_DAY = date(2010, 1, 1)
N_DAYS = 75
DATE_START = 12


def day_from_file_name(name: Column, strict: bool = True) -> Column:
    """``pagecounts-YYYYMMDD-...`` to a date; no date there is an error, or NULL if not strict."""
    day = F.try_to_date(F.substring(name, DATE_START, 8), "yyyyMMdd")
    if not strict:
        return day
    return F.coalesce(day, F.raise_error(F.concat(F.lit("no date in file name: "), name)))


def day_index(day: Column, first_day: date = FIRST_DAY, clamp: bool = True) -> Column:
    """Days since ``first_day``; earlier days count as day 0 if ``clamp``, else negative."""
    index = F.datediff(day, F.lit(first_day))
    return F.greatest(index, F.lit(0)) if clamp else index
