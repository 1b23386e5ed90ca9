"""Per-day series built from an array of ``struct(day, n)``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sparse_series(entries: Column) -> Column:
    """``day-n day-n`` for the days with a count above 0, in day order."""
    present = F.filter(F.sort_array(entries), lambda e: e["n"] > 0)
    pairs = F.transform(present, lambda e: F.concat_ws("-", e["day"].cast("string"), e["n"].cast("string")))
    return F.array_join(pairs, " ")


def dense_series(entries: Column, n_days: int) -> Column:
    """Array with one count per day of the window, 0 where there is none."""
    counts = F.map_from_entries(entries)
    days = F.sequence(F.lit(0), F.lit(n_days - 1))
    return F.transform(days, lambda d: F.coalesce(F.try_element_at(counts, d), F.lit(0).cast("bigint")))
