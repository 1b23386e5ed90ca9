"""Global 1-based numbering without gathering the rows in one task.

Rows get a slot ``partition << 33 | position``, the slots are saved, and only one count per
partition is summed up in order and sent back. Lines of files are numbered without that copy, see
:mod:`pagemill.sources.line_places`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.lineage import cut_lineage

# Position of a row within its partition, in the lower bits of its slot.
POSITION_BITS = 33


def number_rows(df: DataFrame, by: list[str | Column], into: str = "line_no") -> DataFrame:
    """Number rows in the order of ``by``; rows equal in it come in any order."""
    # The last range key is unique, so even a value held by a third of all rows is spread.
    order = [*by, "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    return number_in_order(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row"), into)


def number_in_order(ordered: DataFrame, into: str = "line_no") -> DataFrame:
    """Number the rows of a sorted table in the order they have."""
    # Range bounds are sampled, so both passes below have to see the same partitions.
    slots = cut_lineage(ordered.withColumn("_slot", F.monotonically_increasing_id()))
    block = F.shiftright("_slot", POSITION_BITS)
    per_block = slots.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: small enough for one task and for a broadcast by construction.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_slot") - F.shiftleft("_block", POSITION_BITS)
    return (
        slots.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")
        .withColumn(into, F.col("_offset") + position + 1)
        .drop("_block", "_slot", "_offset")
    )
