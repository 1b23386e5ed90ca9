"""Access series per title over a window of days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from pagemill.functions.days import FIRST_DAY, N_DAYS, day_index
from pagemill.functions.series import dense_series, sparse_series

# Fixed value: a title is reported when its best day is above this.
THRESHOLD = 1000


def daily_counts(
    pagecounts: DataFrame,
    first_day: date = FIRST_DAY,
    n_days: int = N_DAYS,
    early: str = "clamp",
    late: str = "fail",
) -> DataFrame:
    """``title, day, n`` with ``day`` the index in the window.

    ``early``: days before the window are added to day 0 (``clamp``) or left out
    (``drop``). ``late``: days behind it fail the job (``fail``) or are left out
    (``drop``); :func:`late_records` lists those.
    """
    if early not in ("clamp", "drop") or late not in ("fail", "drop"):
        raise ValueError("early must be 'clamp' or 'drop', late 'fail' or 'drop'")
    counted = pagecounts.select(
        "title", day_index(F.col("day"), first_day, clamp=early == "clamp").alias("day"), "views"
    )
    if early == "drop":
        counted = counted.where(F.col("day") >= 0)
    day = F.col("day")
    if late == "drop":
        counted = counted.where(day < n_days)
    counts = counted.groupBy("title", "day").agg(F.sum("views").alias("n"), F.count("title").alias("titled"))
    titled = F.col("titled") > 0
    if late == "fail":
        # On the aggregated rows, one test per title and day; in the filter, so that it holds
        # whichever columns are used.
        outside = F.raise_error(F.concat(F.lit("day index outside the window: "), day.cast("string")))
        titled = F.when(day < n_days, titled).otherwise(outside.cast("boolean"))
    # Rows without a title are dropped here: a test of the title itself would be pushed
    # down to the records and parse each of them twice.
    return counts.where(titled).drop("titled")


def late_records(pagecounts: DataFrame, first_day: date = FIRST_DAY, n_days: int = N_DAYS) -> DataFrame:
    """Records of days behind the window."""
    return pagecounts.where(day_index(F.col("day"), first_day) >= n_days)


def _series(counts: DataFrame) -> DataFrame:
    # At most one entry per day of the window and title, so the lists are short.
    return counts.groupBy("title").agg(
        F.max("n").alias("peak"), F.collect_list(F.struct("day", "n")).alias("entries")
    )


def _hot(counts: DataFrame, threshold: int) -> DataFrame:
    """Rows of the titles with a day above ``threshold``.

    Rows are dealt by title once: the peak is taken over a title's few rows where they lie, and
    the lists of :func:`_series` are made there of what is left, which is little.
    """
    peak = F.max("n").over(Window.partitionBy("title"))
    return counts.withColumn("_peak", peak).where(F.col("_peak") > threshold).drop("_peak")


def trend(counts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``title, peak, series``: sparse series of the titles with a day above ``threshold``."""
    return _series(_hot(counts, threshold)).select("title", "peak", sparse_series(F.col("entries")).alias("series"))


def dense_trend(counts: DataFrame, n_days: int = N_DAYS, threshold: int | None = None) -> DataFrame:
    """``title, peak, days``: one count per day of the window, zeros kept."""
    series = _series(counts if threshold is None else _hot(counts, threshold))
    return series.select("title", "peak", dense_series(F.col("entries"), n_days).alias("days"))
