"""Mixing sources to target weights by entropy balancing.

Rates are the exponentially tilted weights closest to one (in relative entropy, measured
over tokens) that meet one token constraint per source. The convex dual separates by
source; its Newton steps run side by side on the table of source totals, wherever its rows
are. Rates become whole copies of documents: within bounded buckets of a source, each
document takes the number of copies that brings the bucket's running total nearest to its
target, longest documents first, so only the shortest ones decide what is left over.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.llm.rows import FILE, ROW, located, shielded
from pagemill.operators.numbering import number_rows

# Weights of the sources in order, repeating; share of all words; most copies.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
# Documents of a source that are rounded together, on average.
BUCKET_DOCS = 2_000
# Newton steps; the dual falls by at least one unit of the exponent per step until it is
# within one of the solution, and then converges quadratically.
STEPS = 64


def size_column(text: Column) -> Column:
    """Number of words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def weighted(totals: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """``totals`` with the weight of each source, dealt in code-point order, null last."""
    at = F.col("_place") - 1
    turn = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(at, F.lit(len(weights))).cast("int"))
    order = [F.col("source").isNull(), F.col("source")]
    return number_rows(totals, order, "_place").withColumn("weight", turn).drop("_place")


def targets(totals: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, n, source_size, weight`` with ``target``.

    All targets share ``share`` of all words by weight; one above ``most`` times its source
    stops there and the excess is shared again, until none is above. Each round brings two
    sums to the driver.
    """
    limit = most * F.col("source_size")
    total = share * (totals.agg(F.sum("source_size")).first()[0] or 0)
    per_weight = 0.0
    while True:
        stopped = limit < per_weight * F.col("weight")
        taken, open_weight = totals.agg(
            F.sum(F.when(stopped, limit).otherwise(0.0)), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        after = (total - taken) / open_weight
        if after <= per_weight:
            break
        per_weight = after
    return totals.withColumn("target", F.least(limit.cast("double"), F.lit(per_weight) * F.col("weight")))


def rates(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rate``: Newton's method on the dual ``size * exp(x) - target * x``.

    The gradient is ``size * exp(x) - target`` and the Hessian ``size * exp(x)``.
    """

    def step(x: Column, _: Column) -> Column:
        tilted = F.col("source_size") * F.exp(x)
        return x - (tilted - F.col("target")) / tilted

    dual = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(0.0), step)
    return sources.withColumn(
        "rate", F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.exp(dual)).otherwise(F.lit(0.0))
    )


def copies_of(sizes: np.ndarray, rate: float, most: int) -> np.ndarray:
    """Copies of documents in the given order, so that the running total stays near the target."""
    out = np.zeros(len(sizes), dtype=np.int64)
    wanted = taken = 0.0
    for i, size in enumerate(sizes.tolist()):
        if size:
            wanted += rate * size
            out[i] = min(most, max(0, int((wanted - taken) / size + 0.5)))
            taken += float(out[i] * size)
    return out


def _repeats(rows: DataFrame, bucket_docs: int) -> DataFrame:
    """``_source, doc_id, digest, _shares`` of rows repeated whole so often that they would crowd
    their bucket, of ``_source, _bucket, doc_id, digest``."""
    crowded = rows.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 4 * bucket_docs)
    crowded, _ = broadcast_if_small(cut_lineage(crowded.select(F.col("_source").alias("_of"), F.col("_bucket").alias("_at"))))
    inside = rows.join(crowded, rows["_source"].eqNullSafe(F.col("_of")) & (rows["_bucket"] == F.col("_at")), "left_semi")
    counts = inside.groupBy("_source", "doc_id", "digest").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > bucket_docs).select(
        "_source", "doc_id", "digest", F.ceil(F.col("_n") / bucket_docs).alias("_shares")
    )


def mix_plan(docs: DataFrame, most: int = MOST, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies, taken`` and the locator of every row.

    ``taken = copies * size``, with at most ``most`` copies. A null source is one of its own;
    a null or empty text has size 0 and no copies. Repeated rows are documents of their own,
    told apart by their locator. Buckets and the order within go by id and text, so reruns
    agree, also over other files of the same rows. An empty table gives an empty plan.
    """
    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest")
    rows = located(docs).select("doc_id", "source", FILE, ROW, size_column(F.col("text")).alias("size"), text)
    rows = cut_lineage(rows)
    totals = cut_lineage(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")))
    sources = cut_lineage(rates(targets(cut_lineage(weighted(totals)), most=most)))
    # One row per source, so a hot source only meets that one; AQE may split its rows.
    key, _ = broadcast_if_small(sources.withColumnRenamed("source", "_source"))
    rows = rows.join(key, rows["source"].eqNullSafe(F.col("_source")))
    # A hot source is dealt over as many buckets as it needs, each rounded by itself.
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.ceil(F.col("n") / bucket_docs)))
    repeats, _ = broadcast_if_small(cut_lineage(_repeats(rows, bucket_docs)))
    of = {"_source": "_of", "doc_id": "_id", "digest": "_digest"}
    same = [rows[c].eqNullSafe(F.col(name)) for c, name in of.items()]
    rows = rows.join(repeats.withColumnsRenamed(of), same, "left")
    # Such rows are rounded apart from the others; which of them is taken makes no difference.
    share = F.coalesce(F.pmod(F.xxhash64(FILE, ROW), F.col("_shares")) + 1, F.lit(0)).alias("_share")
    columns = ["doc_id", FILE, ROW, "size", "source_size", "target", "rate"]

    def round_bucket(part: pd.DataFrame) -> pd.DataFrame:
        order = ["size", "doc_id", "digest", FILE, ROW]
        part = part.sort_values(order, ascending=[False, True, True, True, True], kind="stable")
        copies = copies_of(part["size"].to_numpy(), float(part["rate"].iloc[0]), most)
        return part[columns].assign(copies=copies, taken=copies * part["size"].to_numpy())

    dealt = rows.select("_source", "_bucket", share, "digest", *columns)
    schema = T.StructType(
        [dealt.schema[c] for c in columns]
        + [T.StructField("copies", T.LongType()), T.StructField("taken", T.LongType())]
    )
    return dealt.groupBy("_source", "_bucket", "_share").applyInPandas(round_bucket, schema)


@shielded("doc_id", "text", "source")
def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``docs`` with the columns of :func:`mix_plan`, one row per copy, numbered by ``copy``.

    Documents without a copy are left out. Columns of ``docs`` named like the added ones are
    replaced.
    """
    rows = located(docs)
    plan = cut_lineage(mix_plan(rows, most).where("copies > 0").drop("doc_id"))
    plan, _ = broadcast_if_small(plan)
    out = rows.join(plan, [FILE, ROW]).drop(FILE, ROW)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
