"""Word counts, access counts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pagemill.functions.text import words


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """``word, n``: occurrences of each whitespace-separated token."""
    return (
        lines.select(F.explode(words(F.col(text))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def access_count(pagecounts: DataFrame, project: str | None = None, by_project: bool = False) -> DataFrame:
    """``title, accesses`` over all projects, over one, or per project."""
    if project is not None:
        pagecounts = pagecounts.where(F.col("project") == project)
    keys = ["project", "title"] if by_project else ["title"]
    return pagecounts.groupBy(*keys).agg(F.sum("views").alias("accesses"))


def top_pages(accesses: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most accessed titles; equal counts come in descending title order."""
    return accesses.orderBy(F.desc("accesses"), F.desc("title")).limit(k)
