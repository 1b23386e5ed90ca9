"""Edit counts, histories and action tags, by user or by page.

A revision needs the columns ``rev_id, page_id, user, ts, comment``; ``(ts, rev_id)`` gives
the order of edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.tags import mask_tags, tag_mask
from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.operators.numbering import number_rows

# Key column and counterparty column of either view.
SIDES = {"user": ("user", "page_id"), "page": ("page_id", "user")}

# Edits packed into one row unless a job says otherwise; a longer history continues in
# further parts.
PART_EDITS = 50_000
# Parts of a key that a task may pack at once and then cut, as long as they have no more than
# ``PART_EDITS`` edits together.
PACKED_PARTS = 16


def _sides(by: str) -> tuple[str, str]:
    if by not in SIDES:
        raise ValueError(f"by must be one of {sorted(SIDES)}, not {by!r}")
    return SIDES[by]


def edit_counts(revisions: DataFrame, by: str = "page") -> DataFrame:
    """``<key>, edits``."""
    key, _ = _sides(by)
    return revisions.groupBy(key).agg(F.count(F.lit(1)).alias("edits"))


def edit_log(revisions: DataFrame, by: str = "page") -> DataFrame:
    """The history in long form: one row per edit, sorted by key and time."""
    key, other = _sides(by)
    return revisions.select(key, "ts", "rev_id", other).orderBy(key, "ts", "rev_id")


def last_actions(revisions: DataFrame, by: str = "page", word_safe: bool = False) -> DataFrame:
    """``<key>, actions``: tags of the latest edit with a comment, empty if there is none."""
    key, _ = _sides(by)
    mask = tag_mask(F.col("comment"), word_safe)
    tagged = revisions.select(key, mask.alias("mask"), F.struct("ts", "rev_id").alias("at"))
    latest = F.max_by("mask", F.when(F.col("mask").isNotNull(), F.col("at")))
    return tagged.groupBy(key).agg(latest.alias("mask")).select(key, mask_tags(F.col("mask")).alias("actions"))


def all_actions(revisions: DataFrame, by: str = "page", word_safe: bool = False) -> DataFrame:
    """``<key>, actions``: tags of any of its comments."""
    key, _ = _sides(by)
    tagged = revisions.select(key, tag_mask(F.col("comment"), word_safe).alias("mask"))
    return tagged.groupBy(key).agg(F.bit_or("mask").alias("mask")).select(
        key, mask_tags(F.col("mask")).alias("actions")
    )


def _pack(log: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct("ts", "rev_id", "other", "mask")))
    return log.groupBy(*keys).agg(entries.alias("entries"), *aggregates)


def _unpack(packed: DataFrame, key: str, part: Column, total: Column, latest: Column) -> DataFrame:
    return packed.select(
        key,
        part.cast("bigint").alias("part"),
        F.size("entries").cast("bigint").alias("edits"),
        total.cast("bigint").alias("total"),
        F.col("entries.ts").alias("timestamps"),
        F.col("entries.other").alias("others"),
        latest.alias("mask"),
    )


def _cut(packed: DataFrame, key: str, part_edits: int, latest: Column) -> DataFrame:
    """One row per ``part_edits`` of the packed entries, in order."""
    n = F.size("entries")
    parts = F.sequence(F.lit(0), F.floor((n - 1) / part_edits).cast("int"))
    pieces = F.transform(parts, lambda i: F.slice("entries", i * part_edits + 1, part_edits))
    return packed.select(key, n.alias("total"), latest.alias("latest"), F.posexplode(pieces).alias("part", "entries"))


def edit_history(revisions: DataFrame, by: str = "page", part_edits: int = PART_EDITS) -> DataFrame:
    """``<key>, part, edits, total, timestamps, others, actions``: the packed history.

    A key with up to ``part_edits`` edits is one row with ``part`` 0. A busier key gets one
    row per ``part_edits`` edits, in order. One of a few small parts is packed by one task and
    cut; no task ever holds the whole history of a busier one (``PACKED_PARTS``).
    ``edits`` is the number in the row, ``total`` that of the key; ``actions`` are the
    key's latest tags, on each of its rows. Edits with a null key are a history of their own.
    """
    key, other = _sides(by)
    log = revisions.select(
        key, F.col(other).cast("string").alias("other"), "ts", "rev_id", tag_mask(F.col("comment")).alias("mask")
    )
    packed_edits = max(part_edits, min(PACKED_PARTS * part_edits, PART_EDITS))
    busy = edit_counts(revisions, by).where(F.col("edits") > packed_edits)
    busy = cut_lineage(busy)
    n_busy = busy.count()
    if n_busy:
        # Read three times below, and often parsed from text: saved once as five columns.
        log = cut_lineage(log)
    quiet = _marked(log, busy, key).where("busy IS NULL").drop("busy") if n_busy else log
    latest = F.try_element_at(F.array_compact("entries.mask"), F.lit(-1))
    history = _pack(quiet, [key])
    if packed_edits > part_edits:
        history = _unpack(_cut(history, key, part_edits, latest), key, F.col("part"), F.col("total"), F.col("latest"))
    else:
        history = _unpack(history, key, F.lit(0), F.size("entries"), latest)
    if n_busy:
        history = history.unionByName(_busy_history(_marked(log, busy, key).where("busy").drop("busy"), key, part_edits))
    return history.withColumn("actions", mask_tags(F.col("mask"))).drop("mask")


def _joined(rows: DataFrame, table: DataFrame, key: str, how: str) -> DataFrame:
    """Join on a key that may be null."""
    return rows.join(table.withColumnRenamed(key, "_key"), rows[key].eqNullSafe(F.col("_key")), how).drop("_key")


# Shares a key's rows are dealt into where the busy keys are too many to be broadcast.
SHARES = 16


def _marked(log: DataFrame, busy: DataFrame, key: str) -> DataFrame:
    """``log`` with ``busy``, true or null.

    Rows meet the busy keys by key and share, so a join that shuffles does not gather a key
    in one task; the pack that follows shuffles the quiet rows by key, the numbering of the
    busy ones by their order.
    """
    rows = log.withColumn("_share", F.pmod(F.xxhash64("rev_id"), F.lit(SHARES)).cast("int"))
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    keys = busy.select(F.col(key).alias("_key"), F.lit(True).alias("busy"), shares.alias("_of"))
    keys, _ = broadcast_if_small(keys, strict=True)
    same = rows[key].eqNullSafe(F.col("_key")) & (rows["_share"] == F.col("_of"))
    return rows.join(keys, same, "left").drop("_key", "_of", "_share")


def _busy_history(log: DataFrame, key: str, part_edits: int) -> DataFrame:
    """Parts of exactly ``part_edits`` edits, cut by the position among all rows in key order."""
    numbered = number_rows(log, [key, "ts", "rev_id"], "n")
    tagged_at = F.when(F.col("mask").isNotNull(), F.col("n"))
    per_key = numbered.groupBy(key).agg(
        F.min("n").alias("first"), F.count(F.lit(1)).alias("total"), F.max_by("mask", tagged_at).alias("latest")
    )
    per_key, _ = broadcast_if_small(cut_lineage(per_key), strict=True)
    part = F.floor((F.col("n") - F.col("first")) / part_edits)
    # The explicit repartition keeps a shuffled join by key from gathering a key in one task.
    parts = _joined(numbered, per_key, key, "inner").withColumn("part", part).repartition(key, "part")
    packed = _pack(parts, [key, "part"], F.first("total").alias("total"), F.first("latest").alias("latest"))
    return _unpack(packed, key, F.col("part"), F.col("total"), F.col("latest"))


def sort_edits(
    result: DataFrame, by: str = "page", sort: str | None = None, files: int | None = None
) -> DataFrame:
    """Order a result by its key (``"key"``), by ascending edit count (``"edits"``) or not at all.

    The parts of a packed history stay together, by the total of their key. ``files`` sets
    the number of partitions of a sorted result, and so the files it is written to.
    """
    key, _ = _sides(by)
    if sort is None:
        return result
    if sort not in ("key", "edits"):
        raise ValueError(f"sort must be 'key', 'edits' or None, not {sort!r}")
    packed = "part" in result.columns
    order = [key, "part"] if packed else [key]
    if sort == "edits":
        order = ["total" if packed else "edits", *order]
    if files is not None:
        return result.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return result.orderBy(*order)
