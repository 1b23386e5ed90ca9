"""Adjacency lines ``from: to1 to2 ...`` and saved ranks ``from: rRANK to1 to2 ...``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.functions.text import WHITESPACE, strip_suffix, tokens
from pagemill.sources.text import read_lines


def _not_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim(F.col("value"), F.lit(WHITESPACE)) != "")


def _rest(t: Column, start: int) -> Column:
    return F.slice(t, start, F.greatest(F.size(t) - start + 1, F.lit(0)))


def parse_links(lines: DataFrame) -> DataFrame:
    """``src string, links array<string>`` from lines in ``value``; blank lines are skipped."""
    t = F.col("t")
    return _not_blank(lines).select(tokens(F.col("value")).alias("t")).select(
        strip_suffix(F.get(t, F.lit(0)), ":").alias("src"), _rest(t, 2).alias("links")
    )


def read_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_links(read_lines(spark, path))


def explode_links(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link lists to ``(edges src, dst)`` and ``(pages id)``, the pages that have a line."""
    edges = links.select("src", F.explode("links").alias("dst"))
    return edges, links.select(F.col("src").alias("id"))


def parse_rank_lines(lines: DataFrame) -> DataFrame:
    """``src, rank, links`` of each line of a saved iteration state."""
    t = F.col("t")
    rank = F.get(t, F.lit(1))
    bad = F.raise_error(F.concat(F.lit("no rank in: "), F.array_join(t, " ")))
    return _not_blank(lines).select(tokens(F.col("value")).alias("t")).select(
        strip_suffix(F.get(t, F.lit(0)), ":").alias("src"),
        F.coalesce(
            F.when(F.startswith(rank, F.lit("r")), F.substr(rank, F.lit(2)).try_cast("double")), bad
        ).alias("rank"),
        _rest(t, 3).alias("links"),
    )


def split_ranks(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ranks id, rank)`` and ``(links src, links)`` of parsed lines.

    A page whose links were saved on several lines has its rank on each of them.
    """
    ranks = state.groupBy(F.col("src").alias("id")).agg(F.max("rank").alias("rank"))
    return ranks, state.select("src", "links")


def parse_ranks(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Saved iteration state to ``(ranks id, rank)`` and ``(links src, links)``."""
    return split_ranks(parse_rank_lines(lines))


def read_ranks(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_ranks(read_lines(spark, path))
