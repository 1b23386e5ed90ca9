"""Saved intermediate tables and guarded broadcasts shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows up to which a table of keys may be broadcast; some 50 MB with long keys.
BROADCAST_ROWS = 250_000

# Tables saved in each open scope, the innermost last. Each thread of jobs has its own scopes.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("pagemill-scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; an open :func:`scratch` scope deletes it at its end."""
    path = f"{shared_folder(spark).rstrip('/')}/pagemill-{name}-{uuid.uuid4()}"
    on_scope_end(path)
    return path


def on_scope_end(path: str) -> None:
    """Have the innermost open scope delete ``path`` at its end."""
    if scopes := _scopes.get():
        scopes[-1].append(path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope around whole jobs: the tables saved in it are deleted when it ends.

    Results have to be written or shown within it.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            delete_path(spark, path)


def save_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` computed once, as a Parquet table in the shared folder, and the table's path.

    Unlike an RDD checkpoint it is compressed and later steps read only the columns they
    need. It outlives lost executors. It stays until its :func:`scratch` scope ends, or until
    whoever owns the shared folder cleans it up.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """:func:`save_table` for a table that stays until the end."""
    return save_table(df)[0]


def settle(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, as a saved table; the tables that it saved on the way are deleted."""
    path = scratch_path(spark, "table")
    with scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, strict: bool = False) -> tuple[DataFrame, int]:
    """Mark a key table for broadcast if it has at most ``max_rows`` rows; also its row count.

    Beyond that the table comes back unmarked, so joins to it shuffle. ``df`` is read for
    the count and again in the join, so it should be saved or persisted. Spark may still
    broadcast an unmarked table by the size of the files it comes from, which says nothing of
    the rows that an explode makes of them; ``strict`` keeps it from that.
    """
    n = df.count()
    if n <= (BROADCAST_ROWS if max_rows is None else max_rows):
        return F.broadcast(df), n
    return (df.hint("merge") if strict else df), n


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread the rows of a scan that has fewer tasks than there are cores.

    For a few files that cannot be split, such as gzip. A scan of a big input has more
    tasks than cores and comes back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
