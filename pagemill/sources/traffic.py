"""Hourly traffic records: ``project title views bytes``, one space between fields."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.functions.days import day_from_file_name
from pagemill.functions.text import strict_field, strict_long, whole_number
from pagemill.lineage import spread_scan
from pagemill.sources.listing import place_of, traffic_manifest
from pagemill.sources.text import read_lines


def parse_pagecounts(
    lines: DataFrame, mode: str = "failfast", file: str | None = None
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """``project, title, views, bytes`` from lines in ``value``; with ``file``, also ``day, file``.

    ``failfast``: a record without a title or whole-number views, or a file name without
    a date, fails the job as soon as that field is used. ``reject``: returns the good
    rows and a table ``value, reason`` of the others. Bytes are never required: what is no
    bigint reads as NULL.
    """
    if mode not in ("failfast", "reject"):
        raise ValueError(f"mode must be 'failfast' or 'reject', not {mode!r}")
    strict = mode == "failfast"
    fields = F.split("value", " ")
    if strict:
        title, views = strict_field(fields, 1, "title"), strict_long(strict_field(fields, 2, "views"), "views")
    else:
        title, views = F.get(fields, F.lit(1)), whole_number(F.get(fields, F.lit(2)))
    columns = [
        F.get(fields, F.lit(0)).alias("project"),
        title.alias("title"),
        views.alias("views"),
        whole_number(F.get(fields, F.lit(3))).alias("bytes"),
    ]
    day = day_from_file_name(F.col(file), strict) if file else None
    if file:
        columns += [day.alias("day"), F.col(file).alias("file")]
    if strict:
        return lines.select(*columns)

    # Out of a generator, so that the tests below do not parse each line once more.
    parsed = lines.select("value", F.size(fields).alias("_fields"), F.inline(F.array(F.struct(*columns))))
    dated = F.col("day").isNotNull() if file else F.lit(True)
    reason = (
        F.when(F.col("_fields") < 3, "too few fields")
        .when(~dated, "no date in file name")
        .otherwise("views is not a number")
    )
    good = F.col("views").isNotNull() & dated
    names = ["project", "title", "views", "bytes", *(["day", "file"] if file else [])]
    return parsed.where(good).select(*names), parsed.where(~good).select("value", reason.alias("reason"))


def read_pagecounts(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "failfast",
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Traffic files with the day taken from each file's name.

    Files of days before ``first_day`` or after ``last_day`` are not opened. A file without a
    day is never out of bounds: it fails the read by its name, or all its lines are rejected.
    """
    if mode == "failfast":
        undated = traffic_manifest(spark, path).where("place = 'undated'").select("name").limit(5).collect()
        if undated:
            raise ValueError(f"no date in file name: {', '.join(sorted(r.name for r in undated))}")
    lines, name = read_lines(spark, path), F.col("_metadata.file_name")
    if first_day is not None or last_day is not None:
        day = day_from_file_name(name, strict=False)
        lines = lines.where(place_of(day, first_day, last_day).isin("in", "undated"))
    return parse_pagecounts(spread_scan(lines.select("value", name.alias("file"))), mode, "file")
