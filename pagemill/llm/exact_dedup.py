"""Exact deduplication by a stateful stream over the digests of whole texts.

A landing table holds digest, identifier and locator of every row. A streaming aggregation
reads it and keeps, per digest and without expiry, the identifier and locator of the row
that stays and the number of rows seen. The state lives in RocksDB files, checkpointed to
the shared folder after every batch, and is read back as a table. Rows whose digest was hit
more than once are then compared by their full bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage, scratch_path, settle
from pagemill.llm.rows import FILE, ROW, keeping_columns, located, shielded, text_of

# How the stream keeps its state: on disk, and opened only while a task works on it.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def keyed_state(spark: SparkSession, landing: str, schema, checkpoint: str) -> DataFrame:
    """``digest, keep, n`` after the stream has taken in everything new under ``landing``.

    Run again with the same checkpoint, it takes in only files that came since.
    """
    stream = spark.readStream.schema(schema).parquet(landing)
    # Of equal digests the largest (doc_id, locator) stays; partial sums go into the shuffle.
    kept = stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", FILE, ROW)).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        query = (
            kept.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    state = spark.read.format("statestore").load(checkpoint)
    value = [F.col("value").getField(f.name) for f in state.schema["value"].dataType.fields]
    return state.select(F.col("key.digest").alias("digest"), value[0].alias("keep"), value[1].alias("n"))


def duplicated(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``digest, text, keep, n`` of the texts held by several rows; ``text`` is null where the
    digest alone tells them apart from all others."""
    spark = rows.sparkSession

    def streamed() -> DataFrame:
        landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "state")
        place = rows.select(digest(text_of(rows)).alias("digest"), "doc_id", FILE, ROW)
        place.write.parquet(landing)
        return keyed_state(spark, landing, place.schema, checkpoint).where("n > 1")

    several = settle(spark, streamed)
    # Full bytes of the hits: copies meet in the partial aggregate, whose key is the text.
    key, _ = broadcast_if_small(several.select("digest"))
    hits = rows.select(digest(text_of(rows)).alias("digest"), text_of(rows).alias("text"), "doc_id", FILE, ROW).join(
        key, "digest"
    )
    texts = hits.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").count()
    clashing = cut_lineage(texts.where("count > 1").select("digest"))
    whole = F.lit(None).cast("string").alias("text")
    if clashing.isEmpty():
        return several.select("digest", whole, "keep", "n")
    # Different texts of one digest: group these few by digest and text.
    apart = (
        hits.join(clashing, "digest", "left_semi")
        .groupBy("digest", "text")
        .agg(F.max(F.struct("doc_id", FILE, ROW)).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    alone = several.join(clashing, "digest", "left_anti").select("digest", whole, "keep", "n")
    return cut_lineage(alone.unionByName(apart))


@shielded("doc_id", "text")
def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``docs`` with ``keep_id, group_size, kept, digest``.

    Texts are equal when their bytes are; a null text counts as empty. Of equal texts the
    row with the largest ``doc_id`` stays (a null id only if all are null; of rows that
    also share the id, the one at the largest locator), and ``keep_id`` is its id. An empty
    table stays empty; columns of ``docs`` named like the added ones are replaced.
    """
    rows = located(docs)
    groups = duplicated(rows, digest)
    clash = groups.where("text IS NOT NULL")
    rows = rows.withColumn("digest", digest(text_of(rows)))
    # Rows of a hot digest only meet one row of the group's table; AQE may split them.
    one, _ = broadcast_if_small(groups.where("text IS NULL").select("digest", "keep", F.col("n").alias("_n")))
    out = rows.join(one, "digest", "left")
    if not clash.isEmpty():
        other = clash.select(
            F.col("digest").alias("_digest2"), F.col("text").alias("_text2"), F.col("keep").alias("_keep2"), F.col("n").alias("_n2")
        )
        same = (F.col("digest") == F.col("_digest2")) & (text_of(out) == F.col("_text2"))
        out = out.join(other, same, "left")
        out = out.withColumn("keep", F.coalesce("keep", "_keep2")).withColumn("_n", F.coalesce("_n", "_n2"))
    stays = (F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[ROW] == F.col(ROW))
    return out.select(
        *docs.columns,
        F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("keep")["doc_id"]).alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(stays, F.lit(True)).alias("kept"),
        "digest",
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per different text."""
    return keeping_columns(docs, ("doc_id", "text"), lambda d: exact_dedup(d).where("kept"))
