"""Best-fit packing of tokenised documents by linear grouping.

A piece has one of few lengths, so the plan is made of how many pieces have each: a table of
at most ``length`` numbers, whatever the corpus. Large lengths are dealt, longest first, into
groups of equal cardinality and rounded up to the longest of their group; the linear program
over the configurations of these few sizes is solved by column generation (each column a
knapsack), and every configuration is repeated as often as its whole number says. Then the
actual lengths take the places of the rounded ones, and what is left (large pieces beyond the
whole numbers, those of sequences that rounding left too empty, and all small ones) goes,
longest first, where it fits best. Sequences of equal
contents are kept as one run with a count, so each step handles runs.

A piece finds its place by its rank among the pieces of its length, which is summed up from
counts per task; nothing is sorted or gathered.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.llm import tokens

LENGTH = 1024
# The id behind every document.
END = 2
# Numbers of groups of large lengths, of which the better serves; the length up to which pieces
# are small; shares of a sequence that may stay empty where it comes from the program.
GROUPS, SMALL, LOSSES = (24, 48), 64, (0, 0.002, 0.01, 0.04, 1)
# Columns that the linear program may generate; whatever is left by then is packed by best fit.
COLUMNS = 3_000
# A rank within a length takes the lower bits of a key.
RANK_BITS = 48


# --- pieces ------------------------------------------------------------------------


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, keep_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document, with ``ids`` if asked, and
    ``_part, _rank``: the task, and the place among that task's pieces of the same length.

    A document of over ``length`` ids (its end included) is cut so that only its first piece
    may be shorter.
    """
    schema = T.StructType([docs.schema["doc_id"]] + [
        T.StructField(n, t) for n, t in (
            ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
            ("_part", T.IntegerType()), ("_rank", T.LongType()),
        )
    ] + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for batch in batches:
            for lo, hi, ids, first in tokens.encoded(batch.column("text"), path):
                # The end of each document behind its ids.
                ids = np.insert(ids, first[1:], end).astype("<u4")
                first = first + np.arange(hi - lo + 1)
                sizes = np.diff(first)
                n_pieces = -(-sizes // length)
                doc = np.repeat(np.arange(hi - lo), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                head = sizes - (n_pieces - 1) * length
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * length)
                size = np.where(piece == 0, head[doc], length)
                at = first[doc] + start
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + size).tolist())]
                order = np.argsort(size, kind="stable")
                counts = np.bincount(size, minlength=length + 1)
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + seen[size[order]]
                seen += counts
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, size, crc)),
                    pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(rank, pa.int64()),
                ]
                if keep_ids:
                    offsets = pa.array(np.append(at, len(ids)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.uint32()).cast(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- the plan ----------------------------------------------------------------------


@dataclass
class Run:
    """``count`` sequences that hold pieces of the same ``sizes``."""

    count: int
    sizes: tuple[int, ...]


@dataclass
class Stock:
    """Pieces not yet packed, as ``size, count`` from the longest to the shortest."""

    left: list[list[int]] = field(default_factory=list)

    def take(self, n: int) -> list[tuple[int, int]]:
        out = []
        while n:
            size, count = self.left[0]
            k = min(n, count)
            out.append((size, k))
            n -= k
            self.left[0][1] -= k
            if not self.left[0][1]:
                self.left.pop(0)
        return out


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, Stock]]:
    """``size, stock`` of about ``groups`` groups of equal cardinality, rounded up to ``size``."""
    least = -(-sum(counts.values()) // groups)
    out: list[tuple[int, Stock]] = []
    room = 0
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            if not room:
                # Equal lengths round to the same size: a group more would only repeat it.
                if not out or out[-1][0] != size:
                    out.append((size, Stock()))
                room = least
            k = min(left, room)
            stock = out[-1][1].left
            if stock and stock[-1][0] == size:
                stock[-1][1] += k
            else:
                stock.append([size, k])
            left, room = left - k, room - k
    return out


def best_configuration(sizes: np.ndarray, worth: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest worth: a knapsack that may take a size repeatedly."""
    best, taken = np.zeros(length + 1), np.full(length + 1, -1)
    for room in range(int(sizes.min()), length + 1):
        fits = sizes <= room
        values = np.where(fits, best[room - np.where(fits, sizes, 0)] + worth, -1.0)
        k = int(values.argmax())
        if values[k] > best[room - 1] + 1e-12:
            best[room], taken[room] = values[k], k
        else:
            best[room] = best[room - 1]
    out, room = np.zeros(len(sizes)), length
    while room > 0:
        k = taken[room]
        if k < 0:
            room -= 1
        else:
            out[k] += 1
            room -= int(sizes[k])
    return float(best[length]), out


def configurations(sizes: np.ndarray, demand: np.ndarray, length: int) -> list[tuple[float, np.ndarray]]:
    """How often which configuration is used: the linear program's basis by column generation."""
    basis = np.diag(length // sizes).astype(float)
    inverse = np.diag(1.0 / (length // sizes))
    for step in range(COLUMNS):
        value, column = best_configuration(sizes, inverse.sum(axis=0), length)
        if value <= 1 + 1e-7:
            break
        x, way = inverse @ demand, inverse @ column
        ratios = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1.0), np.inf)
        out = int(ratios.argmin())
        basis[:, out] = column
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)
    return list(zip(np.maximum(inverse @ demand, 0).tolist(), basis.T))


def substituted(count: int, slots: list[list[tuple[int, int]]]) -> list[Run]:
    """``count`` sequences, of which each slot is filled by its runs of actual sizes."""
    cuts = sorted({0, count}.union(*({int(c) for c in np.cumsum([n for _, n in slot])} for slot in slots)))
    out, at, used = [], [0] * len(slots), [0] * len(slots)
    for a, b in zip(cuts, cuts[1:]):
        out.append(Run(b - a, tuple(slot[i][0] for slot, i in zip(slots, at))))
        for k, slot in enumerate(slots):
            used[k] += b - a
            if used[k] == slot[at[k]][1]:
                at[k], used[k] = at[k] + 1, 0
    return out


def best_fit(runs: list[Run], counts: dict[int, int], length: int) -> list[Run]:
    """Adds pieces, longest first, each to the fullest sequence that has room."""
    by_room: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        by_room[length - sum(run.sizes)].append(run)

    def put(run: Run, n: int, size: int, times: int) -> None:
        """``times`` pieces into each of ``n`` sequences of ``run``, which keeps the others."""
        run.count -= n
        filled = Run(n, run.sizes + (size,) * times)
        by_room[length - sum(filled.sizes)].append(filled)

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in range(size, length + 1):
            queue = by_room[room] if room in by_room else []
            while left and queue:
                run, times = queue[-1], room // size
                n = min(run.count, left // times)
                if n:
                    put(run, n, size, times)
                    left -= n * times
                elif left:
                    put(run, 1, size, left)
                    left = 0
                if not run.count:
                    queue.remove(run)
        times = length // size
        if left >= times:
            by_room[length - times * size].append(Run(left // times, (size,) * times))
        if left % times:
            by_room[length - left % times * size].append(Run(1, (size,) * (left % times)))
    return [run for room in sorted(by_room) for run in by_room[room] if run.count]


def packing_plan(
    counts: dict[int, int], length: int = LENGTH, groups: tuple[int, ...] = GROUPS, small: int = SMALL
) -> list[Run]:
    """Runs of sequences that together hold ``counts[size]`` pieces of each size.

    Of the plans for each number of groups, and for each loss of room up to which a sequence
    of the program stays as it is (pieces of others are packed by best fit), the one with the
    fewest sequences.
    """
    full = [Run(counts[length], (length,))] if counts.get(length) else []
    open_counts = {s: n for s, n in counts.items() if s < length and n}
    large = {s: n for s, n in open_counts.items() if s > small}
    best: list[Run] = []
    for n_groups in groups if large else ():
        runs = configured(linear_groups(large, n_groups), length)
        for loss in sorted({int(length * x) for x in LOSSES}):
            kept = [Run(r.count, r.sizes) for r in runs if length - sum(r.sizes) <= loss]
            rest = dict(open_counts)
            for run in kept:
                for size in run.sizes:
                    rest[size] -= run.count
            found = best_fit(kept, rest, length)
            if not best or sum(r.count for r in found) < sum(r.count for r in best):
                best = found
    return full + (best or best_fit([], open_counts, length))


def configured(stocks: list[tuple[int, Stock]], length: int) -> list[Run]:
    """Sequences of the program's configurations, with actual sizes in the places of the rounded."""
    sizes = np.array([size for size, _ in stocks])
    demand = np.array([sum(n for _, n in stock.left) for _, stock in stocks], dtype=float)
    runs = []
    for times, column in configurations(sizes, demand, length):
        # Whole numbers only, and never more than there is: rounding errors leave a rest.
        n, used = int(times + 1e-6), np.flatnonzero(column)
        for k in used:
            n = min(n, sum(c for _, c in stocks[k][1].left) // int(column[k]))
        if n:
            runs += substituted(n, [stocks[k][1].take(n) for k in used for _ in range(int(column[k]))])
    return runs


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """From which rank of a size on pieces lie in which sequences, sorted by size and rank."""
    rows, rank, sequence = [], defaultdict(int), 0
    for run in runs:
        at = 0
        for size in run.sizes:
            rows.append((size << RANK_BITS | rank[size], sequence, at))
            rank[size] += run.count
            at += size
        sequence += run.count
    rows.sort()
    key, first, at = (np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    return {"key": key, "sequence": first, "offset": at}


# --- packing -----------------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    length: int = LENGTH,
    end: int = END,
    groups: tuple[int, ...] = GROUPS,
    small: int = SMALL,
    keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and its
    ``ids`` with ``keep_ids``.

    ``tokenizer`` is the path of a tokenizer file on every executor, by default the public
    byte-level one. A null or empty text is the end id alone. Null ids and repeated rows are
    documents of their own. Texts are encoded whole. No other column of ``docs`` is read, so
    their names may clash with any. An empty table gives no pieces. Sequences are numbered from
    0; the same table gives as many of them each time.
    """
    saved = cut_lineage(pieces(docs, tokenizer or tokens.public_path(), length, end, keep_ids))
    per_task = cut_lineage(saved.groupBy("_part", F.col("length").alias("_size")).agg(F.count(F.lit(1)).alias("_n")))
    # At most ``length`` rows.
    counts = {r["_size"]: r["n"] for r in per_task.groupBy("_size").agg(F.sum("_n").alias("n")).collect()}
    plan = places(packing_plan(counts, length, groups, small))
    # One row per task and length; a length has at most as many rows as there were tasks.
    earlier = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("_part", "_size", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    bases, _ = broadcast_if_small(cut_lineage(bases))
    ranked = saved.join(bases, (saved["_part"] == bases["_part"]) & (saved["length"] == bases["_size"]))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = ranked.select(*(saved[c] for c in names), (F.col("_rank") + F.col("_base")).alias("_rank"))
    # A few thousand runs, bounded by the lengths that there are and not by the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = (batch.column("length").to_numpy() << RANK_BITS) | batch.column("_rank").to_numpy()
            at = np.searchsorted(shared.value["key"], key, side="right") - 1
            sequence = shared.value["sequence"][at] + key - shared.value["key"][at]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(sequence, pa.int64()), pa.array(shared.value["offset"][at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = T.StructType(
        [ranked.schema[c] for c in names] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, each of the ids of its pieces in order.

    A sequence has at most ``length`` ids, so no group is larger.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))
