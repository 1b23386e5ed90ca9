"""Repeated passages by anchors and rank doubling, in place of prefix-partitioned suffix trees.

A passage of ``WINDOW`` words is repeated if two documents hold it. Only windows are
compared whose anchor occurs in two documents: the anchor is the run of ``GRAM`` words with the
smallest hash in the window, so equal windows have equal anchors and nothing is lost. The
anchor partitions the passages into groups small enough for memory; within a group, the depth
at which passages are told apart is doubled up to ``WINDOW``. That gives the classes of equal
windows, which are one level of a suffix tree; no tree, no maximal repeats and no prefixes of
other lengths are made, since nothing else is asked. Where one anchor has too many passages,
they are grouped by a hash of the whole window; only its smallest document has to be
aggregated then.

The texts are shuffled twice, to the shared anchors of each and to the ranges cut out of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from pagemill.lineage import cut_lineage, settle
from pagemill.llm.rows import FILE, ROW, add_columns, located, shielded
from pagemill.llm.words import SPACED, Words, ngrams, word_blocks

WINDOW, GRAM = 50, 16
# Passages with one anchor up to which they share a tree: some 100 MB in its task.
MAX_GROUP = 20_000
# Passages whose trees are built in one go: groups are put together up to this many.
TREE_ROWS = 20_000
# Bytes that stand for a word in a passage.
CODE = 5

# Lower bits that hold a place: enough for the words of any text that a row can hold.
_POSITION = np.uint64((1 << 30) - 1)


def anchors(words: Words, hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``document, hash, low, high`` of every anchor: of the windows that start at the words
    ``low`` to ``high`` of the document, it is the one."""
    span = window - gram + 1
    grams = ngrams(hashes, gram)
    if len(grams) < span:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    # Smallest hash first, then the leftmost.
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < span:
        more = min(width, span - width)
        least = np.minimum(least[: len(least) - more], least[more:])
        width += more
    counts = words.counts()
    owner = np.repeat(np.arange(len(counts)), counts)[: len(least)]
    at = np.arange(len(least))
    inside = at + window <= words.first[owner + 1]
    owner, at, place = owner[inside], at[inside], (least[inside] & _POSITION).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(at)) - 1
    own = words.first[owner[begin]]
    return owner[begin], grams[place[begin]], at[begin] - own, at[stop[: len(begin)]] - own


def anchor_table(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``key, doc_id, low, high`` and locator of all anchors of all texts with an id."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, words in word_blocks(batch.column("text"), SPACED):
                owner, key, low, high = anchors(words, words.hashes(), window, gram)
                of = pa.array(owner + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        *(batch.column(c).take(of) for c in ("doc_id", FILE, ROW)),
                        pa.array(low, pa.int32()),
                        pa.array(high, pa.int32()),
                    ],
                    names=["key", "doc_id", FILE, ROW, "low", "high"],
                )

    schema = T.StructType(
        [T.StructField("key", T.LongType())]
        + [rows.schema[c] for c in ("doc_id", FILE, ROW)]
        + [T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())]
    )
    return rows.where("doc_id IS NOT NULL").select("doc_id", "text", FILE, ROW).mapInArrow(find, schema)


def shared_anchors(found: DataFrame, max_group: int) -> DataFrame:
    """Per document, the ``anchors`` (``low, high, key, hot``) that also occur in another."""
    keys = found.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n")
    )
    keys = cut_lineage(keys.where("least < most").select("key", (F.col("n") > max_group).alias("hot")))
    # At most one anchor per word of the document.
    shared = F.collect_list(F.struct("low", "high", "key", "hot"))
    return cut_lineage(found.join(keys, "key").groupBy(FILE, ROW).agg(shared.alias("anchors")))


def passages(rows: DataFrame, window: int) -> DataFrame:
    """What the trees are made of: ``key, doc_id, low, codes`` and locator, the words from
    ``low`` to the end of the last window of an anchor. Of a hot anchor, each window by
    itself, with its hash as ``key`` and no codes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("anchors")
            for lo, hi, words in word_blocks(batch.column("text"), SPACED):
                hashes = words.hashes()
                raw = hashes.view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()
                whole = ngrams(hashes, window).view(np.int64)
                of, keys, lows, codes, hot = [], [], [], [], []
                for d, own in enumerate(lists.slice(lo, hi - lo).to_pylist()):
                    first = int(words.first[d])
                    for a in own:
                        if a["hot"]:
                            span = range(a["low"], a["high"] + 1)
                            of += [lo + d] * len(span)
                            keys += whole[first + a["low"] : first + a["high"] + 1].tolist()
                            lows += span
                            codes += [None] * len(span)
                        else:
                            of.append(lo + d)
                            keys.append(a["key"])
                            lows.append(a["low"])
                            codes.append(raw[(first + a["low"]) * CODE : (first + a["high"] + window) * CODE])
                of = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        *(batch.column(c).take(of) for c in ("doc_id", FILE, ROW)),
                        pa.array(lows, pa.int32()),
                        pa.array(codes, pa.binary()),
                    ],
                    names=["key", "doc_id", FILE, ROW, "low", "codes"],
                )

    schema = T.StructType(
        [T.StructField("key", T.LongType())]
        + [rows.schema[c] for c in ("doc_id", FILE, ROW)]
        + [T.StructField("low", T.IntegerType()), T.StructField("codes", T.BinaryType())]
    )
    return rows.select("doc_id", "text", FILE, ROW, "anchors").mapInArrow(cut, schema)


def ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    return np.unique((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64), return_inverse=True)[1]


def tree_nodes(codes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """For the suffixes at ``starts``, the node of their tree at depth ``window``.

    The words from a start on may not run out before that depth. At each step suffixes with
    equal ranks share a node; its children are told apart by the rank half the depth on.
    """
    ranks, depth = np.unique(codes, return_inverse=True)[1], 1
    while depth * 2 <= window:
        ranks, depth = ranked(ranks[: len(ranks) - depth], ranks[depth:]), depth * 2
    return ranked(ranks[starts], ranks[starts + window - depth])


def repeats(batch: pa.Table, window: int) -> pa.RecordBatch:
    """Word ranges of the passages that a document with a smaller id also has, from all
    passages of some groups."""
    data = b"".join(batch.column("codes").to_pylist())
    wide = np.zeros((len(data) // CODE, 8), dtype=np.uint8)
    wide[:, :CODE] = np.frombuffer(data, dtype=np.uint8).reshape(-1, CODE)
    lengths = pc.binary_length(batch.column("codes")).to_numpy() // CODE
    windows = lengths - window + 1
    begin = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(lengths)), windows)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    nodes = tree_nodes(wide.view(np.uint64).reshape(-1), begin[of] + offset, window)
    docs = batch.column("doc_id").to_numpy()[of]
    order = np.lexsort((docs, nodes))
    head = np.searchsorted(nodes[order], np.arange(nodes.max() + 1))
    later = np.flatnonzero(docs > docs[order][head][nodes])
    # Runs of windows of one passage are one range.
    new = np.ones(len(later), dtype=bool)
    new[1:] = (np.diff(later) > 1) | (of[later][1:] != of[later][:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(later))[: len(first)] - 1
    row, low = of[later[first]], batch.column("low").to_numpy()
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c).combine_chunks().take(pa.array(row)) for c in (FILE, ROW)),
            pa.array(low[row] + offset[later[first]], pa.int32()),
            pa.array(low[row] + offset[later[last]] + window, pa.int32()),
        ],
        names=[FILE, ROW, "start", "end"],
    )


def tree_ranges(parts: DataFrame, window: int) -> DataFrame:
    """``start, end`` and locator of repeated passages, tree by tree."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < TREE_ROWS:
                continue
            table = pa.Table.from_batches(held)
            # The last group may go on in the next batch.
            whole = int(np.searchsorted(table.column("key").to_numpy(), table.column("key")[-1].as_py()))
            if whole:
                yield repeats(table.slice(0, whole), window)
            held = table.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield repeats(pa.Table.from_batches(held), window)

    schema = T.StructType([parts.schema[FILE], parts.schema[ROW]]).add("start", T.IntegerType()).add("end", T.IntegerType())
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(build, schema)


def repeated_ranges(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """Per document, the word ranges ``cuts`` (``start, end``) that repeat one of a smaller id."""
    found = cut_lineage(anchor_table(rows, window, gram))
    shared = shared_anchors(found, max_group)
    parts = passages(rows.join(shared, [FILE, ROW]), window)
    parts = cut_lineage(parts)
    trees = tree_ranges(parts.where("codes IS NOT NULL"), window)
    hot = parts.where("codes IS NULL").drop("codes")
    first = cut_lineage(hot.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most"))
    later = hot.join(first, "key").where("doc_id > least")
    windows = later.select(FILE, ROW, F.col("low").alias("start"), (F.col("low") + window).alias("end"))
    # At most one range per word of the document.
    return trees.unionByName(windows).groupBy(FILE, ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))


@shielded("doc_id", "text")
def substring_dedup(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_group: int = MAX_GROUP, drop: tuple = ()
) -> DataFrame:
    """``docs`` with ``n_words, n_removed, kept_text``.

    Words are runs without space or 0x09-0x0D. Removed is each word covered by ``window``
    consecutive words that also start somewhere in a document with a smaller ``doc_id``;
    windows are judged on the input. A row with a null id neither loses words nor makes
    others lose any; rows with the same id don't affect each other; a null text has no words
    and an empty ``kept_text``. An empty table stays empty; columns of ``docs`` named like
    the added ones are replaced; those in ``drop`` are left out.
    """
    rows = located(docs)
    cuts = settle(docs.sparkSession, lambda: repeated_ranges(rows, window, gram, max_group))
    rows = rows.join(cuts.withColumnRenamed("cuts", "_cuts"), [FILE, ROW], "left")

    def apply(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words, n_removed, kept = [], [], []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("_cuts").to_pylist()):
            words = (text or "").encode().split()  # of bytes: exactly space and 0x09-0x0D
            left, at = [], 0
            for c in cuts or ():
                left += words[at : max(at, c["start"])]
                at = max(at, c["end"])
            left += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ]
    return add_columns(rows, fields, apply, (*drop, "_cuts")).drop(FILE, ROW)
