"""Row identity, column hygiene and Arrow helpers shared by the operators."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark import Broadcast
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage

# Locator of a row: hashed path of its file, and its position in that file.
FILE, ROW = "_at_file", "_at_row"


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with a locator that every later read of the same rows repeats.

    Rows straight from files carry their file and position. Others (built in memory, or
    already joined) are first saved in the shared folder, which gives them one. Rows that have
    a locator keep it.
    """

    if FILE in docs.columns and ROW in docs.columns:
        return docs

    def with_place(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")
        return df.withColumns(
            {FILE: F.xxhash64(place.getField("file_path")), ROW: place.getField("row_index").cast("bigint")}
        )

    try:
        return with_place(docs)
    except AnalysisException:
        return with_place(cut_lineage(docs))


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text column, with an empty text for a null."""
    return F.coalesce(docs[column], F.lit(""))


def schema_with(docs: DataFrame, keep: list[str], added: list[T.StructField]) -> T.StructType:
    return T.StructType([docs.schema[c] for c in keep] + added)


def add_columns(
    docs: DataFrame, added: list[T.StructField], compute: Callable[[pa.RecordBatch], list[pa.Array]], drop: tuple = ()
) -> DataFrame:
    """``docs`` plus columns that ``compute`` makes of each Arrow batch.

    Columns of ``docs`` with the name of an added one give way; those in ``drop`` are read
    by ``compute`` and left out of the result.
    """
    names = [f.name for f in added]
    docs = docs.drop(*(set(docs.columns) & set(names)))
    keep = [c for c in docs.columns if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = compute(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep] + columns, names=keep + names
            )

    return docs.mapInArrow(run, schema_with(docs, keep, added))


def _neutral(docs: DataFrame, needed: tuple[str, ...]) -> dict[str, str]:
    mark = "_in"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark = f"_{mark}"
    return {c: f"{mark}{i}" for i, c in enumerate(docs.columns) if c not in needed}


def shielded(*needed: str) -> Callable:
    """For an operator on ``docs`` that reads the columns ``needed``.

    It sees all others under neutral names, so none can clash with a name it uses within.
    They come back under their own, except where the operator adds a column of that name.
    """

    def wrap(operate: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operate)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            neutral = _neutral(docs, needed)
            out = operate(docs.withColumnsRenamed(neutral), *args, **options)
            here = set(out.columns)
            old = [(c, neutral.get(c, c)) for c in docs.columns if neutral.get(c, c) in here]
            added = here - {name for _, name in old}
            kept = [F.col(name).alias(c) for c, name in old if c not in added]
            return out.select(*kept, *(c for c in out.columns if c in added))

        return run

    return wrap


# Bytes of a batch that a Python worker is sent where a stage of the pipeline runs: the batch,
# its copy in the executor and what is computed of it are held at a time.
BATCH_BYTES = "8m"
_shared: ContextVar[list | None] = ContextVar("pagemill-shared", default=None)


def share(spark: SparkSession, value: object) -> Broadcast:
    """A value for the Python workers; a :func:`python_stage` around it ends it."""
    out = spark.sparkContext.broadcast(value)
    if (own := _shared.get()) is not None:
        own.append(out)
    return out


@contextmanager
def python_stage(spark: SparkSession) -> Iterator[None]:
    """For jobs that run to their end within: small batches, and shared values go at the end."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size)
    token = _shared.set([])
    spark.conf.set(size, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(size, before)
        for value in _shared.get():
            value.destroy()
        _shared.reset(token)


def without(docs: DataFrame, needed: tuple[str, ...], refused: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` but those whose locators ``refused`` returns.

    ``refused`` gets the columns ``needed`` and the locator. Its result is saved, a few bytes
    per refused row, and the rows meet it in the JVM: their texts go to Python but not back.
    """
    spark, rows = docs.sparkSession, located(docs.withColumnsRenamed(_neutral(docs, needed)))
    names = _neutral(docs, needed)
    with python_stage(spark):
        out = cut_lineage(refused(rows.select(*needed, FILE, ROW)).select(F.col(FILE).alias("_no_file"), F.col(ROW).alias("_no_row")))
    out, _ = broadcast_if_small(out)
    same = (F.col(FILE) == F.col("_no_file")) & (F.col(ROW) == F.col("_no_row"))
    return rows.join(out, same, "left_anti").select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def keeping_columns(docs: DataFrame, needed: tuple[str, ...], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``judge`` returns, with exactly the columns of ``docs``, those named like
    one that ``judge`` adds included."""
    neutral = _neutral(docs, needed)
    out = judge(docs.withColumnsRenamed(neutral))
    return out.select(*(F.col(neutral.get(c, c)).alias(c) for c in docs.columns))
