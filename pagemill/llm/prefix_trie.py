"""The prefix trie of conversations, from sorted LCPs with a sparse table of range minima.

Conversations are sorted by their turns (as digests), so the conversations under a node lie
next to each other, and the longest common prefix (LCP) of neighbours says how deep they stay
together. A row proposes the prefixes that its predecessor does not share, and the prefix that
it does share with it (their parent). Each of these searches the left and right ends of its
members by itself: binary search over a sparse table of minima of the LCPs. Members, smallest
ids, leaves and saved bytes are then differences of running sums and minima over that range.

Rows are cut into blocks of bounded size. A search runs in the table of its block, and where it
leaves the block, in a second sparse table over the minima of all blocks (a few numbers per
block). Nodes that cross the edge of a block are the prefixes of the row at that edge: their
parts in the first and last block are saved as small tables and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage

# Bytes of a turn's digest: 128 bits of its SHA-256.
DIGEST = 16
# A block ends at so many conversations or turns, whichever comes first.
BLOCK_ROWS, BLOCK_TURNS = 1 << 14, 1 << 17
# Block ids: the task in the upper bits.
BLOCK_BITS = 32
_NONE = hashlib.sha256(b"").hexdigest()


# --- sequences ---------------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation as ``array<struct<digest, bytes>>``.

    Turns go by ``turn`` (null first), equal ones by their digest. A null role or text is
    empty. Rows without a conversation id belong to none. Texts stay where they are: only
    24 bytes of a turn are shuffled, and a conversation's are one row.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    # The length in front keeps ("a", "b") apart from ("", "ab").
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        conversations["turn"].alias("turn"),
        F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, DIGEST).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    rows = conversations.select(conversations["conv_id"].cast("bigint").alias("conv_id"), turn.alias("t"))
    grouped = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation with the first turns of its family's first one in place of its own.

    Of conversation ``c`` the first ``crc32(c) % heads`` turns come from conversation
    ``c - c % family`` (all it has if fewer, none if it is absent).
    """
    own = F.col("conv_id")
    first = own - own % family
    h = (F.crc32(own.cast("string").cast("binary")) % heads).cast("int")
    # A family has at most 2 * family - 1 ids (around 0), each of them one row.
    kin = Window.partitionBy("_family")
    head = F.max(F.when(own == F.col("_family"), F.struct(F.slice("turns", 1, heads - 1).alias("t")))).over(kin)["t"]
    with_head = turns.withColumn("_family", first).withColumn("_head", head)
    lead = F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return with_head.select("conv_id", F.concat(lead, rest).alias("turns"))


# --- sorted rows -------------------------------------------------------------------

_SORTED = "block bigint, idx int, conv_id bigint, len int, prev_len int, lcp int, bytes array<bigint>, edge binary"


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return (int(differ[0]) if len(differ) else n) // DIGEST


def sorted_rows(turns: DataFrame, block_rows: int, block_turns: int) -> DataFrame:
    """Conversations in the order of their turns: the LCP with the row before, cut into blocks.

    The first row of a task has no LCP yet; it and the last one keep their digests in ``edge``.
    """
    key = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    rows = turns.select("conv_id", F.unhex(key).alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
    # The id as the last range key spreads equal conversations.
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << BLOCK_BITS
        before, held, block, rows_in, turns_in = None, None, -1, 0, 0
        names = [c.split()[0] for c in _SORTED.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            rows = []
            for key, conv, sizes in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "bytes"))):
                n = len(key) // DIGEST
                if block < 0 or rows_in >= block_rows or turns_in + n > block_turns:
                    block, rows_in, turns_in = block + 1, 0, 0
                first = before is None
                lcp, prev = (-1, -1) if first else (n if key == before else common_turns(before, key), len(before) // DIGEST)
                if held is not None:
                    rows.append(held)
                held = (base + block, rows_in, conv, n, prev, lcp, sizes, key if first else None)
                before, rows_in, turns_in = key, rows_in + 1, turns_in + n
            if rows:
                yield out(rows)
        if held is not None:
            yield out([(*held[:-1], before)])

    return ordered.mapInArrow(run, _SORTED)


def joined_at_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` with the LCPs of the first rows of all tasks, and ``shared``: the bytes of the
    turns shared with the row before. The very first row shares nothing."""
    task = F.shiftright("block", BLOCK_BITS)
    ends = rows.where(F.col("edge").isNotNull()).groupBy(task.alias("task")).agg(
        F.min_by("edge", F.struct("block", "idx")).alias("first"), F.max_by("edge", F.struct("block", "idx")).alias("last")
    )
    # Two rows per task.
    before = ends.select("task", "first", F.lag("last").over(Window.orderBy("task")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column("before").to_pylist(), batch.column("first").to_pylist()))
            lcps = [0 if a is None else common_turns(a, b) for a, b in pairs]
            lens = [0 if a is None else len(a) // DIGEST for a, _ in pairs]
            columns = [batch.column("task"), pa.array(lcps, pa.int32()), pa.array(lens, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["_task", "_lcp", "_len"])

    fixed, _ = broadcast_if_small(cut_lineage(before.mapInArrow(run, "_task bigint, _lcp int, _len int")))
    first = F.col("lcp") < 0
    out = rows.drop("edge").join(fixed, F.when(first, task) == F.col("_task"), "left")
    lcp = F.when(first, F.col("_lcp")).otherwise(F.col("lcp"))
    sum_of = F.aggregate(F.slice("bytes", F.lit(1), lcp), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return out.select(
        "block", "idx", "conv_id", "len", F.when(first, F.col("_len")).otherwise(F.col("prev_len")).alias("prev_len"),
        lcp.alias("lcp"), "bytes", sum_of.alias("shared"),
    )


# --- sparse tables -----------------------------------------------------------------


class Sparse:
    """Minima of all runs of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows, self.n = [np.asarray(values, np.int64)], len(values)
        while 1 << len(self.rows) <= self.n:
            half = 1 << (len(self.rows) - 1)
            below = self.rows[-1]
            self.rows.append(np.minimum(below[: len(below) - half], below[half:]))

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First position from ``at`` on with a value below ``depth``; ``n`` if there is none."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            fits = at <= self.n - (1 << k)
            go = fits & (row[np.where(fits, at, 0)] >= depth)
            at[go] += 1 << k
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last position up to ``at`` with a value below ``depth``; -1 if there is none."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, start = self.rows[k], at - (1 << k) + 1
            fits = start >= 0
            go = fits & (row[np.where(fits, start, 0)] >= depth)
            at[go] -= 1 << k
        return at

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of positions ``a`` to ``b``, both included; ``a <= b``."""
        level = np.log2(b - a + 1).astype(np.int64) if len(a) else np.zeros(0, np.int64)
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own, row = level == k, self.rows[k]
            out[own] = np.minimum(row[a[own]], row[b[own] - (1 << k) + 1])
        return out


def running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])


@dataclass
class Blocks:
    """A few numbers of every block, in order, and sparse tables over them."""

    ids: np.ndarray
    first_lcp: np.ndarray
    first_same: np.ndarray
    lcps: Sparse
    convs: Sparse
    n: np.ndarray
    leaves: np.ndarray
    shared: np.ndarray
    # Per lowest LCP: the blocks with it, and their running number of rows that branch there.
    branching: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list) -> Blocks:
        rows = sorted(rows, key=lambda r: r.block)
        column = lambda name: np.array([r[name] for r in rows], dtype=np.int64)
        lowest, branch = column("lowest"), column("branch")
        where = {int(v): np.flatnonzero(lowest == v) for v in np.unique(lowest)}
        return cls(
            column("block"), column("first_lcp"), column("first_same"), Sparse(lowest), Sparse(column("conv")),
            running(column("n")), running(column("leaves")), running(column("shared")),
            {v: (at, running(branch[at])) for v, at in where.items()},
        )

    def start_of(self, block: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The earlier block in which the node of this depth starts that holds the first row of ``block``."""
        return np.where(depth <= 0, 0, self.lcps.left(block - 1, np.maximum(depth, 1)))

    def between(self, a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows, leaf ends, shared bytes, smallest id and branches at ``depth`` of the blocks
        behind ``a`` and before ``b``."""
        whole = [s[b] - s[a + 1] for s in (self.n, self.leaves, self.shared)]
        conv = np.full(len(a), np.iinfo(np.int64).max)
        some = b > a + 1
        conv[some] = self.convs.least(a[some] + 1, b[some] - 1)
        branches = np.zeros(len(a), np.int64)
        for d in np.unique(depth):
            if int(d) in self.branching:
                at, sums = self.branching[int(d)]
                own = depth == d
                branches[own] = sums[np.searchsorted(at, b[own])] - sums[np.searchsorted(at, a[own] + 1)]
        return *whole, conv, branches


def block_numbers(rows: DataFrame) -> DataFrame:
    """One row per block for :class:`Blocks`."""
    deeper = (F.col("len") > F.col("lcp")).cast("bigint")
    per_lcp = rows.groupBy("block", "lcp").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(deeper).alias("branch"),
        F.sum((F.col("lcp") < F.col("prev_len")).cast("bigint")).alias("leaves"),
        F.sum("shared").alias("shared"),
        F.min("conv_id").alias("conv"),
        F.max(F.when(F.col("idx") == 0, F.struct("lcp", "len", "prev_len"))).alias("first"),
    )
    first = F.max("first")
    same = (first["lcp"] == first["len"]) & (first["len"] == first["prev_len"])
    return per_lcp.groupBy("block").agg(
        *(F.sum(c).alias(c) for c in ("n", "leaves", "shared")),
        F.min("conv").alias("conv"),
        F.min("lcp").alias("lowest"),
        F.min_by("branch", "lcp").alias("branch"),
        first["lcp"].alias("first_lcp"),
        # Also for rows without turns, whose first one ends a node of no depth.
        (same & first["prev_len"].isNotNull()).cast("bigint").alias("first_same"),
    )


# --- nodes -------------------------------------------------------------------------

# kind: 0 a node, 1 the first part of a node that leaves its block, 2 the part of such a node
# at the start of its last block, 3 a piece of the ids that end at such a node.
_PARTS = (
    "kind int, at int, depth int, conv_id bigint, parent_conv_id bigint, parent_at int, n_convs bigint, "
    "n_children bigint, n_leaves bigint, shared bigint, above bigint, part int, ends string"
)
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
_PART_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in _PARTS.split(", "))])


def part_table(n: int, **columns: object) -> pa.Table:
    """``n`` rows of parts; single values are repeated, and columns that are not given are null."""
    values = [np.full(n, v) if isinstance(v, int) else v for v in map(columns.get, _PART_SCHEMA.names)]
    arrays = [pa.nulls(n, f.type) if v is None else pa.array(v, f.type) for v, f in zip(values, _PART_SCHEMA)]
    return pa.Table.from_arrays(arrays, schema=_PART_SCHEMA)


def node_parts(rows: pa.Table, blocks: Blocks, root_conv: int) -> pa.Table:
    """Nodes that start in one block, and its parts of nodes that cross its edges."""
    rows = rows.sort_by("idx").combine_chunks()
    at = int(np.searchsorted(blocks.ids, rows["block"][0].as_py()))
    last_block = at == len(blocks.ids) - 1
    lcp, size, prev, conv = (rows[c].to_numpy().astype(np.int64) for c in ("lcp", "len", "prev_len", "conv_id"))
    n = len(lcp)
    lcps, convs = Sparse(lcp), Sparse(conv)
    leaves, shared = running(lcp < prev), running(rows["shared"].to_numpy())
    # Running bytes of all turns of all rows.
    sums, row_start = running(pc.list_flatten(rows["bytes"]).to_numpy()), np.cumsum(size) - size

    # Every prefix that the row before does not share, and its ends.
    new = size - lcp
    row = np.repeat(np.arange(n), new)
    first_node = np.cumsum(new) - new
    depth = np.arange(len(row)) - first_node[row] + lcp[row] + 1
    left, stop = lcps.left(row, depth), lcps.right(row + 1, depth)
    # The next block may hold more members.
    next_lcp = -1 if last_block else int(blocks.first_lcp[at + 1])
    crosses = (stop == n) & (next_lcp >= depth)
    inside_stop = stop - 1

    # The prefix shared with the row before: searched in the same way, on both sides.
    child = np.flatnonzero(new > 0)
    shared_depth = lcp[child]
    p_left, p_stop = lcps.left(child, np.maximum(shared_depth, 1)), lcps.right(child + 1, np.maximum(shared_depth, 1))
    is_root = shared_depth == 0
    here = ~is_root & (p_left >= 0)
    p_node = np.full(len(child), -1)
    p_node[here] = first_node[p_left[here]] + shared_depth[here] - lcp[p_left[here]] - 1
    children = np.zeros(len(row), np.int64)
    np.add.at(children, p_node[here], 1)
    # All but the first new prefix of a row lie under the one before it.
    follows = np.flatnonzero(depth > lcp[row] + 1)
    np.add.at(children, follows - 1, 1)

    smallest = convs.least(left, inside_stop)
    parent_conv, parent_at = np.full(len(row), -1), np.full(len(row), -1)
    parent_conv[follows] = smallest[follows - 1]
    parent_at[follows] = np.where(crosses[follows - 1], at, -1)
    top = first_node[child]
    parent_conv[top[is_root]] = root_conv
    known = here & ~((p_stop == n) & (next_lcp >= shared_depth))
    parent_conv[top[known]] = convs.least(p_left[known], p_stop[known] - 1)
    open_right = here & ~known
    parent_at[top[open_right]] = at
    open_left = ~is_root & (p_left < 0)
    parent_at[top[open_left]] = blocks.start_of(np.full(open_left.sum(), at), shared_depth[open_left])

    # Ids that end at the last prefix of a row: the rows that equal it.
    same = (lcp == size) & (size == prev)
    if at == 0:
        same[0] = False
    next_new = Sparse(np.where(same, 1, 0))
    ends = np.full(len(row), _NONE, dtype=object)
    texts: list[tuple[int, int, str]] = []

    def ids(a: int, b: int) -> str:
        return ",".join(map(str, conv[a:b].tolist()))

    run_stop = next_new.right(child + 1, np.ones(len(child), np.int64))
    runs_on = (run_stop == n) & (not last_block and bool(blocks.first_same[at + 1]))
    for i, b, on, node in zip(child.tolist(), run_stop.tolist(), runs_on.tolist(), (first_node + new - 1)[child].tolist()):
        if on:
            texts.append((at, int(size[i]), ids(i, b)))
            ends[node] = None
        else:
            ends[node] = hashlib.sha256(ids(i, b).encode()).hexdigest()
    if same[0]:
        b = int(next_new.right(np.zeros(1, np.int64), np.ones(1, np.int64))[0])
        texts.append((int(blocks.start_of(np.array([at]), size[:1])[0]), int(size[0]), ids(0, b)))
    elif at == 0 and size[0] == 0:
        b = int(next_new.right(np.ones(1, np.int64), np.ones(1, np.int64))[0])
        texts.append((0, 0, ids(0, b)))

    above = sums[row_start[row] + depth - 1] - sums[row_start[row]]
    nodes = part_table(
        len(row), kind=np.where(crosses, 1, 0), at=at, depth=depth, conv_id=smallest, parent_conv_id=parent_conv,
        parent_at=parent_at, n_convs=inside_stop - left + 1, n_children=children,
        n_leaves=leaves[stop] - leaves[left + 1], shared=shared[stop] - shared[left + 1], above=above, part=at, ends=ends,
    )
    # Where nodes that come from earlier blocks end in this one.
    edge_depth = np.arange(max(int(lcp.min()), 0) + 1, int(lcp[0]) + 1)
    start = np.zeros(len(edge_depth), np.int64)
    stops = lcps.right(start, edge_depth)
    branch = [int(((lcp[:b] == d) & (size[:b] > d)).sum()) for d, b in zip(edge_depth.tolist(), stops.tolist())]
    tails = part_table(
        len(edge_depth), kind=2, at=at, depth=edge_depth, conv_id=convs.least(start, stops - 1), n_convs=stops,
        n_children=branch, n_leaves=leaves[stops], shared=shared[stops], part=at,
    )
    starts, depths, pieces = zip(*texts) if texts else ((), (), ())
    return pa.concat_tables([nodes, tails, part_table(len(texts), kind=3, at=starts, depth=depths, part=at, ends=pieces)])


def crossing(parts: DataFrame, shared_blocks: Broadcast) -> DataFrame:
    """Nodes that leave their block, put together from their parts."""
    heads = parts.where("kind = 1").drop("kind", "part")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks: Blocks = shared_blocks.value
            at, depth = (batch.column(c).to_numpy().astype(np.int64) for c in ("at", "depth"))
            end = blocks.lcps.right(at + 1, depth)
            columns = [*batch.columns, pa.array(end, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in blocks.between(at, end, depth)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    added = ["end_at", "m_convs", "m_leaves", "m_shared", "m_conv", "m_children"]
    schema = T.StructType(
        [*heads.schema, T.StructField("end_at", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in added[1:])]
    )
    tails = parts.where("kind = 2").select(
        F.col("at").alias("end_at"), "depth", *(F.col(c).alias(f"t_{c}") for c in ("conv_id", "n_convs", "n_children", "n_leaves", "shared"))
    )
    full = heads.mapInArrow(reach, schema).join(tails, ["end_at", "depth"], "left")

    def total(own: str, middle: str) -> Column:
        return F.col(own) + F.col(middle) + F.coalesce(F.col(f"t_{own}"), F.lit(0))

    return full.select(
        "at", "depth", F.least("conv_id", "m_conv", "t_conv_id").alias("conv_id"), "parent_conv_id", "parent_at",
        total("n_convs", "m_convs").alias("n_convs"), total("n_children", "m_children").alias("n_children"),
        total("n_leaves", "m_leaves").alias("n_leaves"), total("shared", "m_shared").alias("shared"), "above", "ends",
    )


def long_ends(parts: DataFrame) -> DataFrame:
    """``e_at, e_depth, digest`` of ids that end at a node in several blocks.

    The pieces of a node stream through one hash in order, a block's ids at a time.
    """
    pieces = parts.where("kind = 3").select("at", "depth", "part", "ends").repartition("at", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for at, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("at", "depth", "ends"))):
                if (at, depth) != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (at, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node:
            out.append((*node, digest.hexdigest()))
            columns = zip(zip(*out), (pa.int32(), pa.int32(), pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["e_at", "e_depth", "digest"])

    return pieces.sortWithinPartitions("at", "depth", "part").mapInArrow(run, "e_at int, e_depth int, digest string")


def prefix_trie(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns`` (see :func:`sequences`).

    ``conv_id`` is the smallest member, whose first ``depth`` turns are the node's text;
    ``parent_conv_id`` is null for the root, a node of depth 0 that holds all. ``n_convs``,
    ``n_children`` and ``n_leaves`` count members, children and childless nodes below (the node
    itself included); ``saved_bytes`` are those of the turns below and of the node itself that
    members share, each counted for all members but one; ``ends_sha256`` hashes the ids of the
    members that end here, ascending and comma-joined. Conversations without turns end at the
    root. An empty table has no nodes.
    """
    spark = turns.sparkSession
    rows = cut_lineage(sorted_rows(turns, block_rows, block_turns))
    rows = cut_lineage(joined_at_tasks(rows))
    # One row per block of many conversations.
    blocks = Blocks.of(block_numbers(rows).collect())
    if not len(blocks.ids):
        return spark.createDataFrame([], _RESULT)
    root = int(blocks.convs.least(np.zeros(1, np.int64), np.array([len(blocks.ids) - 1]))[0])
    shared = spark.sparkContext.broadcast(blocks)

    def run(block: pa.Table) -> pa.Table:
        return node_parts(block, shared.value, root)

    parts = cut_lineage(rows.groupBy("block").applyInArrow(run, _PARTS))
    names = ["at", "depth", "conv_id", "parent_conv_id", "parent_at", "n_convs", "n_children", "n_leaves", "shared", "above", "ends"]
    long, _ = broadcast_if_small(cut_lineage(long_ends(parts)))
    known = {
        "at": 0, "depth": 0, "conv_id": root, "parent_conv_id": None, "parent_at": -1, "n_convs": int(blocks.n[-1]),
        "n_leaves": int(blocks.leaves[-1]), "shared": int(blocks.shared[-1]), "above": 0, "ends": _NONE,
    }
    inside = parts.select(names)
    of = {c: F.lit(v).cast(inside.schema[c].dataType).alias(c) for c, v in known.items()}
    top = rows.where((F.col("lcp") == 0) & (F.col("len") > 0)).agg(F.count(F.lit(1)).alias("n_children")).select(
        *(of.get(c, F.col(c)) for c in names)
    )
    same_node = (F.col("at") == F.col("e_at")) & (F.col("depth") == F.col("e_depth"))
    crossed = cut_lineage(
        crossing(parts, shared).unionByName(top).join(long, same_node, "left")
        .withColumn("ends", F.coalesce("digest", "ends")).select(names)
    )
    every = parts.where("kind = 0").select(names).unionByName(crossed)
    # Parents that cross the edge of a block are few: the prefixes of the rows at the edges.
    parents, _ = broadcast_if_small(
        crossed.select(F.col("at").alias("p_at"), F.col("depth").alias("p_depth"), F.col("conv_id").alias("p_conv"))
    )
    apart = every.where("parent_at >= 0").join(
        parents, (F.col("parent_at") == F.col("p_at")) & (F.col("depth") - 1 == F.col("p_depth")), "left"
    )
    every = every.where("parent_at < 0").unionByName(apart.withColumn("parent_conv_id", F.col("p_conv")).select(names))
    return every.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + 1).alias("n_leaves"),
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_bytes"),
        F.col("ends").alias("ends_sha256"),
    )


_RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_bytes bigint, ends_sha256 string"
)
