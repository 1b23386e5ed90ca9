"""The files of an input as a table, from their listing alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.functions.days import day_from_file_name


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, name, size, modified``: the input files by their URI, without opening any.

    ``modified`` is in milliseconds.
    """
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("length").alias("size"),
        F.unix_millis("modificationTime").alias("modified"),
    )


def place_of(day: Column, first_day: date | None, last_day: date | None) -> Column:
    """``early``, ``in`` or ``late`` of the days asked for, ``undated`` without a day."""
    place = F.when(day.isNull(), "undated")
    if first_day is not None:
        place = place.when(day < F.lit(first_day), "early")
    if last_day is not None:
        place = place.when(day > F.lit(last_day), "late")
    return place.otherwise("in")


def traffic_manifest(
    spark: SparkSession, path: str | list[str], first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """``file, name, size, modified, day, place`` of traffic files: what a read of these days takes."""
    files = list_files(spark, path).withColumn("day", day_from_file_name(F.col("name"), strict=False))
    return files.withColumn("place", place_of(F.col("day"), first_day, last_day))
