"""Read-back of saved results: edit histories by page or user, access counts by title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.functions.codec import unescape
from pagemill.functions.text import rest_from, strict_field, strict_long, whole_number
from pagemill.sources.text import read_lines

# Fixed value: separator of the parts of a saved edit history.
PART_SEPARATOR = "!@#"


def parse_edit_counts(lines: DataFrame) -> DataFrame:
    """``page_id bigint, edits bigint`` from ``page \\t edits!@#...`` lines.

    Of a page saved in several parts, each line has the total in front; the first part
    counts.
    """
    fields = F.split("value", "\t", 2)
    text = strict_field(fields, 1, "history")
    part = F.get(F.split(text, PART_SEPARATOR), F.lit(4))
    first = lines.where(F.coalesce(part == "0", F.lit(True)))
    return first.select(
        strict_long(F.get(fields, F.lit(0)), "page_id").alias("page_id"),
        strict_long(F.substring_index(text, PART_SEPARATOR, 1), "edits").alias("edits"),
    )


def parse_history(lines: DataFrame, by: str = "page") -> DataFrame:
    """A whole saved history, as :func:`pagemill.operators.edits.edit_history` gives it.

    Names come back as they were, whatever they hold (:mod:`pagemill.functions.codec`); those
    of files that others wrote must not hold a separator.
    """
    key = {"user": "user", "page": "page_id"}[by]
    name = unescape(F.substring_index("value", "\t", 1))
    fields = F.split(strict_field(F.split("value", "\t", 2), 1, "history"), PART_SEPARATOR)

    def items(i: int) -> Column:
        text = strict_field(fields, i, "history")
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))

    total = strict_long(F.get(fields, F.lit(0)), "edits")
    return lines.select(
        (F.when(name.isNotNull(), strict_long(name, "page_id")) if by == "page" else name).alias(key),
        F.coalesce(whole_number(F.get(fields, F.lit(4))), F.lit(0).cast("bigint")).alias("part"),
        F.coalesce(whole_number(F.get(fields, F.lit(5))), total).alias("edits"),
        total.alias("total"),
        items(1).alias("timestamps"),
        F.transform(items(2), unescape).alias("others"),
        items(3).alias("actions"),
    )


def read_history(spark: SparkSession, path: str | list[str], by: str = "page") -> DataFrame:
    return parse_history(read_lines(spark, path), by)


def read_edit_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_edit_counts(read_lines(spark, path))


def parse_access_counts(lines: DataFrame) -> DataFrame:
    """``title string, accesses bigint`` from ``title \\t n`` lines."""
    fields = F.split("value", "\t")
    return lines.select(
        F.get(fields, F.lit(0)).alias("title"),
        strict_long(strict_field(fields, 1, "accesses"), "accesses").alias("accesses"),
    )


def read_access_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_access_counts(read_lines(spark, path))


def parse_counted(lines: DataFrame) -> DataFrame:
    """``n bigint, rest string`` from ``n <white space> rest`` lines; spacing within the rest is kept."""
    return lines.select(
        strict_long(strict_field(F.split("value", r"\s+", 2), 0, "count"), "count").alias("n"),
        rest_from(F.col("value"), 1).alias("rest"),
    )
