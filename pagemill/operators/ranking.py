"""Unnormalised PageRank: ``rank = base + damping * sum(rank of source / its link count)``.

Pages without links pass nothing on, repeated links count each time, self-links count.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage, delete_path, save_table, scratch_path

# Fixed values of the rank formula, and the first rank of every page.
DAMPING, BASE, FIRST_RANK = 0.85, 0.15, 1.0

# Links of one source that share a join key; a bigger source is spread over several.
SPREAD_LINKS = 100_000

# Links per partition of a graph too small for all shuffle partitions.
PARTITION_LINKS = 10_000


class Graph(NamedTuple):
    """``pages id, links, spread`` and ``edges src, [salt,] dst, m``, both saved for the steps."""

    pages: DataFrame
    edges: DataFrame
    tables: tuple[str, ...]

    def release(self) -> None:
        for name in self.tables:
            self.pages.sparkSession.sql(f"drop table if exists {name}")


def save_buckets(df: DataFrame, by: list[str], buckets: int) -> str:
    """``df`` as a table in the shared folder, one sorted file per bucket; the table's name.

    A join by these columns reads each bucket where it is needed, without a shuffle; whoever
    loses an executor reads its buckets again. The folder goes with the scope (:func:`scratch`).
    """
    name = f"spark_catalog.default.pagemill_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *by)
    path = scratch_path(df.sparkSession, "buckets")
    dealt.write.bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return name


def out_degree(edges: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """``id, links`` of all sources, targets and listed pages; repeated links count.

    ``edges`` are ``src, dst`` or, merged, ``src, dst, m``.
    """
    m = F.col("m") if "m" in edges.columns else F.lit(1)
    end = lambda page, n: F.struct(F.col(page).alias("id"), n.cast("bigint").alias("links"))
    ends = edges.select(F.inline(F.array(end("src", m), end("dst", F.lit(0)))))
    if pages is not None:
        ends = ends.unionByName(pages.select("id", F.lit(0).cast("bigint").alias("links")))
    return ends.groupBy("id").agg(F.sum("links").alias("links"))


def merge_edges(edges: DataFrame) -> DataFrame:
    """``src, dst, m``: distinct links with their multiplicity; merged ones stay as they are."""
    if "m" in edges.columns:
        return edges
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))


def build_graph(
    edges: DataFrame, pages: DataFrame | None = None, spread_links: int = SPREAD_LINKS, partitions: int | None = None
) -> Graph:
    """Prepare ``edges (src, dst)``, or merged ``(src, dst, m)``, for many steps.

    Edges not merged yet are read once: merged and saved, they give the degrees as well.

    Edges and pages are saved in buckets by their join key, so a step shuffles only ranks and
    partial sums. If a source has more than ``spread_links`` links, the key is
    ``(src, salt)`` with a salt by target, and its rank is sent once per salt.
    ``partitions`` defaults to ``spark.sql.shuffle.partitions``, or fewer for a small graph.
    """
    spread = F.greatest(F.ceil(F.col("links") / spread_links).cast("int"), F.lit(1))
    merged = edges if "m" in edges.columns else cut_lineage(merge_edges(edges))
    degrees = cut_lineage(out_degree(merged, pages).withColumn("spread", spread))
    if partitions is None:
        links = degrees.agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0]
        most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Fewer than all costs one more shuffle of the sums per step: only for far smaller graphs.
        enough = links // PARTITION_LINKS + 1
        partitions = enough if 2 * enough <= most else most
    hubs, n_hubs = broadcast_if_small(degrees.where(F.col("spread") > 1).select(F.col("id").alias("src"), "spread"))
    by = ["src"]
    if n_hubs:
        salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("spread")).cast("int"), F.lit(0))
        merged, by = merged.join(hubs, "src", "left").withColumn("salt", salt).drop("spread"), ["src", "salt"]
    spark = edges.sparkSession
    names = (save_buckets(degrees, ["id"], partitions), save_buckets(merged, by, partitions))
    return Graph(*(spark.table(name) for name in names), names)


def first_ranks(graph: Graph, start: DataFrame | None = None) -> DataFrame:
    """``id, links, spread, rank``: 1.0 for every page, or saved ranks ``(id, rank)``."""
    if start is None:
        return graph.pages.withColumn("rank", F.lit(FIRST_RANK))
    return graph.pages.join(start, "id", "left").withColumn("rank", F.coalesce("rank", F.lit(FIRST_RANK)))


def rank_step(graph: Graph, ranks: DataFrame, damping: float = DAMPING, base: float = BASE) -> DataFrame:
    """One step from ``id, links, spread, rank`` to the same columns."""
    sent = ranks.where(F.col("links") > 0).select(
        F.col("id").alias("src"), "spread", (F.col("rank") / F.col("links")).alias("share")
    )
    by = ["src"]
    if "salt" in graph.edges.columns:
        by = ["src", "salt"]
        sent = sent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)))
    # Ranks of a bucket are few beside its links: hashed, they leave the links unsorted.
    received = (
        graph.edges.join(sent.drop("spread").hint("shuffle_hash"), by)
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col("share") * F.col("m")).alias("received"))
    )
    rank = F.lit(base) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return graph.pages.join(received.hint("shuffle_hash"), "id", "left").select("id", "links", "spread", rank.alias("rank"))


def page_rank(
    edges: DataFrame,
    runs: int,
    pages: DataFrame | None = None,
    start: DataFrame | None = None,
    damping: float = DAMPING,
    base: float = BASE,
    save_every: int = 5,
    save: Callable[[int, DataFrame], None] | None = None,
    spread_links: int = SPREAD_LINKS,
) -> DataFrame:
    """``id, rank`` after ``runs`` steps over ``edges (src, dst)``.

    ``pages (id)`` adds pages without any link; ``start (id, rank)`` resumes from saved
    ranks; ``save(i, ranks)`` is called with the result of every step. Runs eagerly: the
    ranks are saved every ``save_every`` steps, to bound the plan, and at the end; earlier
    saved ranks are deleted as soon as later ones are there. ``edges`` may be merged already
    (:func:`merge_edges`), and should then be a saved table.
    """
    if runs < 1:
        raise ValueError("runs must be at least 1")
    graph = build_graph(edges, pages, spread_links)
    try:
        ranks, earlier = first_ranks(graph, start), None
        for i in range(1, runs + 1):
            ranks = rank_step(graph, ranks, damping, base)
            if save is not None or i % save_every == 0 or i == runs:
                ranks, path = save_table(ranks)
                if earlier is not None:
                    delete_path(edges.sparkSession, earlier)
                earlier = path
            if save is not None:
                save(i, ranks.select("id", "rank"))
    finally:
        graph.release()
    return ranks.select("id", "rank")
