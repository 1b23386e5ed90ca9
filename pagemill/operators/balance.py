"""Edits per access of each title, and lookups by page id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.text import normalise_title


def title_edits(titles: DataFrame, edits: DataFrame) -> DataFrame:
    """``page_id, title, edits``: every title and every edited page.

    A page without edits has 0, edits without a title have the title ``''``. Repeated
    rows of a page are summed up.
    """
    per_page = edits.groupBy("page_id").agg(F.sum("edits").alias("edits"))
    return titles.join(per_page, "page_id", "full_outer").select(
        "page_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("edits", F.lit(0)).cast("bigint").alias("edits"),
    )


def ratio(edits: Column, accesses: Column) -> Column:
    """Edits per access; NULL without accesses."""
    return edits.cast("double") / F.nullif(accesses, F.lit(0)).cast("double")


def balance(titled: DataFrame, accesses: DataFrame) -> DataFrame:
    """``title, ratio, edits, accesses`` for every title that has access data.

    Edits of pages without a title (``''``) are not matched. Titles are compared with their
    whitespace normalised. Rows of equal titles are summed up on both sides before the join,
    so the join keys are unique.
    """
    title = normalise_title(F.col("title")).alias("title")
    per_title = titled.select(title, "edits").where(F.col("title") != "").groupBy("title").agg(F.sum("edits").alias("edits"))
    seen = accesses.groupBy(title).agg(F.sum("accesses").alias("accesses"))
    edits = F.coalesce("edits", F.lit(0)).cast("bigint")
    return seen.join(per_title, "title", "left").select(
        "title", ratio(edits, F.col("accesses")).alias("ratio"), edits.alias("edits"), "accesses"
    )


def edit_view_balance(titles: DataFrame, edits: DataFrame, accesses: DataFrame) -> DataFrame:
    """Numbered titles, edits by page id and accesses by title to one ratio per title."""
    return balance(title_edits(titles, edits), accesses)


def page_names(titles: DataFrame, page_id: int | None = None) -> DataFrame:
    """Titles by id, all or one."""
    return titles if page_id is None else titles.where(F.col("page_id") == page_id)


def rank_names(ranks: DataFrame, titles: DataFrame, page_id: int | None = None) -> DataFrame:
    """``page_id, title, rank``: the rank of each named page, all or one."""
    by_id = ranks.select(F.col("id").cast("bigint").alias("page_id"), "rank")
    return page_names(titles, page_id).join(by_id, "page_id").select("page_id", "title", "rank")
