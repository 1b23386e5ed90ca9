"""The jobs over paths: text in, text out.

Each deletes what it has saved in between when its result is written. The lookups
(``top_pages``, ``page_name``, ``page_info``) return a table instead; show it within
:func:`pagemill.lineage.scratch`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill import sources
from pagemill.functions.days import FIRST_DAY, N_DAYS
from pagemill.lineage import cut_lineage, scratch, spread_scan
from pagemill.operators import balance, counts, edits, ranking, trends
from pagemill.sources import sinks


def cleaning(job: Callable[..., None]) -> Callable[..., None]:
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **options) -> None:
        with scratch(spark):
            job(spark, *args, **options)

    return run


def accepted(read: Callable, spark: SparkSession, source: str, rejects: str | None, **options) -> DataFrame:
    """Records of ``source``; with ``rejects``, bad lines go there as ``reason \\t line`` instead
    of failing the job."""
    if rejects is None:
        return read(spark, source, **options)
    good, bad = read(spark, source, mode="reject", **options)
    sinks.write_lines(sinks.key_value_lines(bad, "reason", "value"), rejects)
    return good


@cleaning
def word_count(spark: SparkSession, source: str, target: str) -> None:
    result = counts.word_count(spread_scan(sources.read_lines(spark, source)))
    sinks.write_lines(sinks.key_value_lines(result, "word", "n"), target)


@cleaning
def access_count(
    spark: SparkSession,
    source: str,
    target: str,
    project: str | None = None,
    by_project: bool = False,
    rejects: str | None = None,
) -> None:
    """``title \\t n`` lines, with ``by_project`` ``project \\t title \\t n``."""
    records = accepted(sources.read_pagecounts, spark, source, rejects)
    result = counts.access_count(records, project, by_project)
    key = F.concat_ws("\t", "project", "title") if by_project else "title"
    sinks.write_lines(sinks.key_value_lines(result, key, "accesses"), target)


def top_pages(spark: SparkSession, accesses: str, k: int = 15) -> DataFrame:
    """The ``k`` most accessed titles of a saved access count."""
    return counts.top_pages(sources.read_access_counts(spark, accesses), k)


@cleaning
def trend(
    spark: SparkSession,
    source: str,
    target: str,
    threshold: int = trends.THRESHOLD,
    first_day: date = FIRST_DAY,
    n_days: int = N_DAYS,
    early: str = "clamp",
    late: str = "fail",
    rejects: str | None = None,
) -> None:
    """Files of days that are left out (``early`` or ``late`` is ``drop``) are not opened."""
    days = {}
    if early == "drop":
        days["first_day"] = first_day
    if late == "drop":
        days["last_day"] = first_day + timedelta(days=n_days - 1)
    records = accepted(sources.read_pagecounts, spark, source, rejects, **days)
    daily = trends.daily_counts(records, first_day, n_days, early, late)
    sinks.write_lines(sinks.trend_lines(trends.trend(daily, threshold)), target)


@cleaning
def page_edits(
    spark: SparkSession,
    source: str,
    target: str,
    by: str,
    sort: str = "no",
    files: int | None = None,
    part_edits: int = edits.PART_EDITS,
    rejects: str | None = None,
) -> None:
    """Histories by ``user`` or ``page``, sorted by ``id``, by ``edits`` or not (``no``).

    ``files`` sets the number of files of the result, each written by one task; a single one is
    joined of sorted parts. A history of more than ``part_edits`` edits is written as several lines (:func:`sinks.history_text`).
    """
    order = {"id": "key", "edits": "edits", "no": None}[sort]
    records = accepted(sources.read_revisions, spark, source, rejects)
    history = edits.sort_edits(edits.edit_history(records, by, part_edits), by, order, None if files == 1 else files)
    sinks.write_lines(sinks.history_lines(history, by), target, files=files if order is None or files == 1 else None)


@cleaning
def sort_by_count(spark: SparkSession, source: str, target: str, files: int | None = None) -> None:
    """``n rest`` lines in the order of their numbers, then of the rest, as ``n \t rest``."""
    counted = sources.parse_counted(sources.read_lines(spark, source))
    order = ["n", "rest"]
    if files is not None and files > 1:
        counted = counted.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        counted = counted.orderBy(*order)
    sinks.write_lines(sinks.key_value_lines(counted, "n", "rest"), target, files=1 if files == 1 else None)


@cleaning
def page_rank(
    spark: SparkSession,
    source: str,
    target: str,
    runs: int,
    resume: bool = False,
    save: str = "ranks",
    line_links: int = sinks.LINE_LINKS,
) -> None:
    """``runs`` steps; results go to ``target/<step>``, or to ``target`` for a single step.

    ``resume`` takes saved ranks as the source. The last step is written with its links, so
    it can be resumed from. Of the steps before, ``save`` writes ``all`` in that form, only
    the ``ranks`` (``id \\t rank``), or ``last``: none. A page of more than ``line_links``
    links is written as several lines, each with the rank. The source is parsed once.
    """
    if save not in ("all", "ranks", "last"):
        raise ValueError(f"save must be 'all', 'ranks' or 'last', not {save!r}")
    lines = sources.read_lines(spark, source)
    start = None
    if resume:
        state = cut_lineage(sources.parse_rank_lines(lines))
        start, links = sources.split_ranks(state)
    else:
        links = cut_lineage(sources.parse_links(lines))
    links, pages = sources.explode_links(links)
    merged = cut_lineage(ranking.merge_edges(links))
    lists = cut_lineage(sinks.link_lists(merged, ranking.out_degree(merged, pages), line_links))

    def write(i: int, ranks: DataFrame) -> None:
        folder = target if runs == 1 else f"{target}/{i}"
        if i == runs or save == "all":
            sinks.write_lines(sinks.rank_lines(ranks, lists), folder)
        elif save == "ranks":
            sinks.write_lines(sinks.key_value_lines(ranks, "id", "rank"), folder)

    ranks = ranking.page_rank(merged, runs, pages, start, save=None if save == "last" else write)
    if save == "last":
        write(runs, ranks)


@cleaning
def edit_view_balance(
    spark: SparkSession, titles: str, page_history: str, accesses: str, target: str, files: int | None = None
) -> None:
    """From a titles file and the saved results of the page-edit and access-count jobs."""
    result = balance.edit_view_balance(
        sources.read_titles(spark, titles),
        sources.read_edit_counts(spark, page_history),
        sources.read_access_counts(spark, accesses),
    )
    sinks.write_lines(sinks.balance_lines(result), target, files=files)


def index_titles(spark: SparkSession, titles: str, target: str) -> None:
    """Saves where the lines of the titles are, for lookups that read a few of them."""
    with scratch(spark):
        sources.index_titles(spark, titles, target)


def page_name(spark: SparkSession, titles: str, page_id: int, index: str | None = None) -> DataFrame:
    return sources.read_title(spark, titles, page_id, index)


def page_info(spark: SparkSession, ranks: str, titles: str, page_id: int, index: str | None = None) -> DataFrame:
    saved, _ = sources.read_ranks(spark, ranks)
    title = sources.read_title(spark, titles, page_id, index)
    return balance.rank_names(saved.where(F.col("id") == str(page_id)), title)
