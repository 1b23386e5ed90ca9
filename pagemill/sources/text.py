"""Plain text scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.functions.text import normalise_title
from pagemill.lineage import settle
from pagemill.sources.line_places import check_fresh, line_at, line_index, number_lines, save_index


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value string``: every line of a file or of all files of a folder.

    Compressed files are decoded by their extension. A gzip file is one task; the
    aggregations that follow shuffle only their partial results.
    """
    return spark.read.text(path)


def titles(lines: DataFrame) -> DataFrame:
    """``page_id bigint, title string`` of numbered lines."""
    return lines.select(F.col("line_no").alias("page_id"), normalise_title(F.col("value")).alias("title"))


def read_titles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``page_id bigint, title string``: one title per line, the id is its line number."""
    return titles(number_lines(spark, path))


def index_titles(spark: SparkSession, path: str | list[str], target: str) -> None:
    """Saves a line index, with which :func:`read_title` reads a few lines instead of all files."""
    save_index(line_index(spark, path), target)


def read_title(spark: SparkSession, path: str | list[str], page_id: int, index: str | None = None) -> DataFrame:
    """The row of :func:`read_titles` with this id.

    ``index`` is a saved index of the same files; it fails if they are others by now. Without
    one the files are indexed first.
    """
    if index is None:
        found = settle(spark, lambda: line_index(spark, path))
    else:
        found = spark.read.parquet(index)
        check_fresh(spark, found, path)
    return titles(line_at(spark, found, page_id))
