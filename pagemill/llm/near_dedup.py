"""Near-duplicate detection by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its five-word shingles. Each sample draws, per shingle, the
gamma and uniform variates of the sampling scheme from tables indexed by the shingle's hash
and takes the shingle of the smallest value, so two texts agree in a sample with the
probability of their weighted Jaccard similarity. Samples are banded into buckets, bucket
members are paired, and a pair is a link if its exact weighted Jaccard similarity is high
enough. Connected texts are one class, so of a large bucket the likely pairs are verified first,
and then only members that these links leave apart.

Whole texts are compared once: identical texts share a node.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage, settle
from pagemill.llm.rows import FILE, ROW, keeping_columns, located, python_stage, share, shielded, text_of
from pagemill.llm.words import ALNUM, Words, ngrams, word_blocks

SHINGLE, SIMILARITY = 5, 0.8
SAMPLES, BANDS = 64, 16
# Document frequencies are counted per hash bucket of shingles; this many 4-byte numbers
# are what the executors get, whatever the size of the corpus.
FEATURES = 1 << 18
# How far a shingle of one document outweighs one of all documents.
IDF_WEIGHT = 0.25
# Bucket members up to which all are paired, and up to which a task finds the pairs that
# connect them; further pairs per member that it takes.
PAIR_ALL, TREE_NODES, NEAREST = 8, 4_096, 3
# Members and characters of text of a block; what is left of a large bucket is compared block
# against block.
BLOCK_NODES, BLOCK_CHARS = 1_024, 1 << 23
# Share of equal samples below which a pair is not compared: four standard deviations under
# the threshold.
LEAST_ESTIMATE = 0.6

_random = np.random.Generator(np.random.PCG64(5))
_POOL = 1 << 16
_R = _random.gamma(2.0, 1.0, _POOL).astype(np.float32)
_B = _random.random(_POOL).astype(np.float32)
_LOG_C = np.log(_random.gamma(2.0, 1.0, _POOL)).astype(np.float32)
_FACTORS = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, how often each occurs, and where documents begin.

    A document of fewer words than ``n``, but not none, has one shingle of all of them.
    """
    counts = words.counts()
    hashes = words.hashes()
    owner = np.repeat(np.arange(len(counts)), counts)
    found, of = ngrams(hashes, n), owner[: max(0, len(owner) - n + 1)]
    whole = of == owner[n - 1 :]
    found, of = [found[whole]], [of[whole]]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            found.append(ngrams(hashes, size)[words.first[short]])
            of.append(short)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(found)))
    return found[at], times, np.searchsorted(of[at], np.arange(len(counts) + 1))


def features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def weights(hashes: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return ((1 + np.log(times)) * idf[features(hashes)]).astype(np.float32)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and per feature that of the documents with a shingle in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for _, _, words in word_blocks(batch.column(0), ALNUM, lower=True):
                hashes, _, first = shingles(words)
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
                both = np.unique(owner * FEATURES + features(hashes))
                total += np.bincount(both % FEATURES, minlength=FEATURES)
                n += int((np.diff(first) > 0).sum())
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(total[held], n), pa.int64())],
            names=["feature", "n"],
        )

    counts = texts.mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    out, n = np.zeros(FEATURES, dtype=np.int64), 0
    for feature, size in counts.collect():  # at most FEATURES + 1 rows
        if feature < 0:
            n = size
        else:
            out[feature] = size
    return n, out


def damped_idf(n: int, frequencies: np.ndarray) -> np.ndarray:
    """From 1 for a shingle of all documents to ``1 + IDF_WEIGHT`` for one that is in none.

    Damped, because the shingles that a large group of copies shares are frequent for that
    reason alone, and would else weigh less than the few that tell its members apart.
    """
    rarity = np.log((1 + n) / (1 + frequencies)) / np.log(2 + n)
    return (1 + IDF_WEIGHT * rarity).astype(np.float32)


def samples(hashes: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of ``SAMPLES`` hashed (shingle, step) pairs per document; documents without a
    shingle have no row."""
    begin = first[:-1][np.diff(first) > 0]
    out = np.empty((len(begin), SAMPLES), dtype=np.int32)
    log_weight = np.log(weight)
    for j, factor in enumerate(_FACTORS):
        drawn = hashes * factor
        at = (drawn >> np.uint64(48)).astype(np.int64)
        r, b = _R[at], _B[at]
        step = np.floor(log_weight / r + b)
        value = _LOG_C[at] - r * (step - b + np.float32(1))
        # Floats as integers of the same order, above a hash of the shingle and its step.
        bits = value.view(np.int32)
        bits = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) + (1 << 31)
        name = (drawn ^ (step.astype(np.int64).view(np.uint64) << np.uint64(20))) * np.uint64(0x9E3779B97F4A7C15)
        packed = (bits.view(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
        out[:, j] = np.minimum.reduceat(packed, begin).astype(np.uint32).view(np.int32) if len(begin) else 0
    return out


def signatures(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """``node, sig array<int>`` of ``node, text``, one per node; none without a word."""
    shared = share(texts.sparkSession, idf)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in word_blocks(batch.column("text"), ALNUM, lower=True):
                hashes, times, first = shingles(words)
                sig = samples(hashes, weights(hashes, times, shared.value), first)
                held = np.flatnonzero(np.diff(first) > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(lo, hi - lo).take(pa.array(held)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(held) + 1) * SAMPLES, pa.int32()), pa.array(sig.reshape(-1), pa.int32())
                        ),
                    ],
                    names=["node", "sig"],
                )

    return texts.mapInArrow(sample, "node binary, sig array<int>").dropDuplicates(["node"])


def tree_pairs(sigs: np.ndarray, least: float, nearest: int = NEAREST) -> np.ndarray:
    """Index pairs that connect whatever all pairs of an estimate of ``least`` would connect.

    They are a maximum spanning tree by the share of equal samples: at any threshold its
    edges connect the same members as all pairs above the threshold do. These shares are
    estimates, and exact similarities may connect other members. So each member is also paired
    with its ``nearest`` others, and with the ``nearest`` members that are closest to all, such
    as the text that the others are copies of; :func:`connected` finds what is still missing.
    One row of similarities is held at a time.
    """
    n = len(sigs)
    floor = int(least * sigs.shape[1])
    best, parent = np.full(n, -1), np.zeros(n, dtype=np.int64)
    inside = np.zeros(n, dtype=bool)
    total = np.zeros(n, dtype=np.int64)
    pairs, at = [], 0
    for _ in range(n):
        inside[at] = True
        equal = (sigs == sigs[at]).sum(axis=1)
        total[at] = equal.sum()
        equal[at] = -1
        near = np.argpartition(-equal, min(nearest, n - 1))[:nearest]
        pairs += [(at, int(j)) for j in near if equal[j] >= floor]
        closer = ~inside & (equal > best)
        best[closer], parent[closer] = equal[closer], at
        at = int(np.argmax(np.where(inside, -2, best)))
        if not inside[at] and best[at] >= floor:
            pairs.append((at, int(parent[at])))
    for hub in np.argsort(-total, kind="stable")[:nearest].tolist():
        equal = (sigs == sigs[hub]).sum(axis=1)
        pairs += [(hub, int(j)) for j in np.flatnonzero(equal >= floor) if j != hub]
    return np.unique(np.sort(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=1), axis=0)


def _tree(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("node")
    nodes = part["node"].to_numpy()
    pairs = tree_pairs(np.stack(part["sig"].to_numpy()), LEAST_ESTIMATE)
    return pd.DataFrame({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})


def candidate_pairs(sigs: DataFrame, tree_nodes: int = TREE_NODES) -> tuple[DataFrame, DataFrame]:
    """Distinct ``a, b`` of nodes that meet in a bucket and agree in enough samples, and the
    ``bucket, node`` of the buckets in which not all such pairs are among them.

    All pairs of a small bucket, the pairs of :func:`tree_pairs` of a larger one. A bucket of
    more than ``tree_nodes`` members is split by twice as many samples, again and again, up
    to buckets of equal signatures; in each that is too large, every member is also paired
    with two members drawn by hash, which differ from band to band. The pairs that a large
    bucket has besides these are left to :func:`connected`.
    """
    step = SAMPLES // BANDS
    around = F.concat("sig", "sig")  # a band's samples go on from its own to all others
    banded = sigs.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    found: list[DataFrame] = []
    open_buckets = None
    size = step
    while True:
        keyed = banded.select("node", "band", F.xxhash64("band", F.slice(around, F.col("band") * step + 1, size)).alias("bucket"))
        rank = F.xxhash64("node", "bucket")
        buckets = keyed.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min(rank).alias("low"), F.max(rank).alias("high")
        )
        buckets, _ = broadcast_if_small(cut_lineage(buckets.where("n > 1")))
        members = cut_lineage(keyed.join(buckets, "bucket"))
        few = members.where(F.col("n") <= PAIR_ALL).select("bucket", "node")
        other = few.withColumnRenamed("node", "b")
        found.append(few.withColumnRenamed("node", "a").join(other, "bucket").where("a < b").select("a", "b"))
        some = members.where((F.col("n") > PAIR_ALL) & (F.col("n") <= tree_nodes)).select("bucket", "node")
        found.append(some.join(sigs, "node").groupBy("bucket").applyInPandas(_tree, "a binary, b binary"))
        hot = members.where(F.col("n") > tree_nodes)
        if open_buckets is None:  # the members of later buckets share one of these
            open_buckets = members.where(F.col("n") > PAIR_ALL).select("bucket", "node")
        if hot.isEmpty():
            break
        leaders = hot.where((rank == F.col("low")) | (rank == F.col("high")))
        leaders = leaders.select("bucket", F.col("node").alias("leader"))
        # A hot bucket has two leaders, so its rows can be split between tasks.
        star = hot.select("bucket", "node").join(leaders, "bucket").where("node != leader")
        found.append(star.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")))
        if size == SAMPLES:
            break
        size *= 2
        banded = hot.select("node", "band").join(sigs, "node")
    pairs = cut_lineage(functools.reduce(DataFrame.unionByName, found).distinct())
    left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    equal = F.aggregate(
        F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    likely = pairs.join(left, "a").join(right, "b").where(equal >= int(LEAST_ESTIMATE * SAMPLES))
    return cut_lineage(likely.select("a", "b")), open_buckets


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of sorted ``(hashes, weights)``."""
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    total_a, total_b = a[1].sum(dtype=np.float64), b[1].sum(dtype=np.float64)
    both, least = a[1][i].sum(dtype=np.float64) + b[1][j].sum(dtype=np.float64), np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
    return float(least / (total_a + total_b - both + np.maximum(a[1][i], b[1][j]).sum(dtype=np.float64)))


def weighted_sets(column: pa.Array, idf: np.ndarray) -> Iterator[tuple]:
    """Sorted ``(hashes, weights)`` of the shingles of each text."""
    for _, _, words in word_blocks(column, ALNUM, lower=True):
        hashes, times, first = shingles(words)
        weight = weights(hashes, times, idf)
        for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
            yield hashes[i:j], weight[i:j]


def links(pairs: DataFrame, rows: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose texts have an exact similarity of at least ``least``."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted, _ = broadcast_if_small(cut_lineage(nodes))
    texts = cut_lineage(rows.select("node", "text").join(wanted, "node").dropDuplicates(["node"]))
    shared = share(rows.sparkSession, idf)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (weighted_sets(batch.column(c), shared.value) for c in ("text_a", "text_b"))
            close = [similarity(x, y) >= least for x, y in zip(*sets)]
            yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return cut_lineage(pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a binary, b binary"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``a, b``; the root is the smallest node of its component.

    Alternating stars: each round hangs all larger neighbours of a node, and then the node
    and its smaller ones, onto its smallest neighbour, until nothing moves. Only minima are
    aggregated, so a node with very many neighbours is never gathered.
    """
    state = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
        state = cut_lineage(small.where("u != v").distinct())
        # A count and a checksum of the edges: when both stay, the stars are done.
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def joining_pairs(sigs: np.ndarray, sets: list[tuple], roots: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> list:
    """Index pairs of an exact similarity of at least ``least`` that join what has different roots.

    Each of ``left`` is compared with all of ``right`` that it is not connected with yet, by
    roots or by pairs found before, unless too few samples are equal; so there are
    fewer pairs than roots.
    """
    sizes = np.array([len(hashes) for hashes, _ in sets])
    first = np.concatenate([[0], np.cumsum(sizes)])
    _, names = np.unique(np.concatenate([hashes for hashes, _ in sets]), return_inverse=True)
    weight = np.concatenate([w for _, w in sets]).astype(np.float64)
    total = np.add.reduceat(weight, first[:-1])
    own = np.zeros(names.max() + 1)
    _, part = np.unique(roots, return_inverse=True)
    pairs = []
    for x in left.tolist():
        other = right[part[right] != part[x]]
        other = other[(sigs[other] == sigs[x]).sum(axis=1) >= int(LEAST_ESTIMATE * sigs.shape[1])]
        if not len(other):
            continue
        of_x = slice(first[x], first[x + 1])
        own[names[of_x]] = weight[of_x]
        begin = np.cumsum(sizes[other]) - sizes[other]
        at = np.arange(sizes[other].sum()) + np.repeat(first[other] - begin, sizes[other])
        both = np.add.reduceat(np.minimum(weight[at], own[names[at]]), begin)
        own[names[of_x]] = 0
        for y in other[both / (total[x] + total[other] - both) >= least].tolist():
            if part[y] != part[x]:
                pairs.append((x, y))
                part[part == part[y]] = part[x]
    return pairs


def central_pairs(members: DataFrame, found: DataFrame) -> DataFrame:
    """``a, b`` of the most linked member of each bucket of ``bucket, node, root`` with all
    members that are not connected with it: the text of which they may be copies."""
    degrees = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    most = F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "node", "root"))
    centres = members.join(degrees, "node", "left").groupBy("bucket").agg(most.alias("centre"))
    centres, _ = broadcast_if_small(cut_lineage(centres))
    apart = members.join(centres, "bucket").where(F.col("centre.root") != F.col("root"))
    return cut_lineage(
        apart.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")).distinct()
    )


def _blocks(chosen: Column) -> Column:
    chars = F.sum(F.when(chosen, F.col("chars")))
    return F.greatest(F.ceil(F.count_if(chosen) / BLOCK_NODES), F.ceil(chars / BLOCK_CHARS)).cast("int")


def unconnected(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket, node, root, major`` of the buckets whose members do not all have one root;
    ``major`` members have the root that most of the bucket's have."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut_lineage(rooted)
    sizes = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    kinds = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.struct("n", "root")).alias("most"))
    kinds, _ = broadcast_if_small(cut_lineage(kinds.where("kinds > 1").select("bucket", "most")))
    return cut_lineage(
        rooted.join(kinds, "bucket").select("bucket", "node", "root", (F.col("root") == F.col("most.root")).alias("major"))
    )


def connected(
    found: DataFrame, buckets: DataFrame, sigs: DataFrame, rows: DataFrame, idf: np.ndarray, least: float
) -> DataFrame:
    """``node, root`` as :func:`components` has them of the links ``found`` and of all that the
    pairs of each of the ``bucket, node`` would add.

    A bucket whose members are all connected needs no more. In others the most linked member
    is paired with the rest first. What is still apart is compared exactly, block of members
    against block; only members of the largest connected part are not compared with each other.
    """
    roots = components(found)
    apart = unconnected(buckets, roots)
    if apart.isEmpty():
        return roots
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    central = links(central_pairs(apart, found), rows, idf, least)
    if not central.isEmpty():
        roots = components(stars.unionByName(central))
        apart = unconnected(apart.select("bucket", "node"), roots)
        if apart.isEmpty():
            return roots
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    wanted, _ = broadcast_if_small(cut_lineage(apart.select("node").distinct()))
    texts = cut_lineage(rows.select("node", "text").join(wanted, "node").dropDuplicates(["node"]))
    lengths = texts.select("node", F.length("text").alias("chars"))
    sized = apart.join(lengths, "node")
    # Blocks of minor members come first, then those of the major ones.
    counts = sized.groupBy("bucket").agg(_blocks(~F.col("major")).alias("minors"), _blocks(F.col("major")).alias("majors"))
    counts, _ = broadcast_if_small(cut_lineage(counts))
    spread = sized.join(counts, "bucket").withColumn("hash", F.xxhash64("node"))
    block = F.when(F.col("major"), F.col("minors") + F.pmod("hash", "majors")).otherwise(F.pmod("hash", "minors"))
    # A major block meets all minor ones, a minor one all blocks.
    last = F.when(F.col("major"), F.col("minors")).otherwise(F.col("minors") + F.col("majors")) - 1
    spread = spread.withColumn("block", block.cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    tasks = spread.select(
        "bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "root"
    )
    shared = share(rows.sparkSession, idf)

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        nodes = part["node"].to_numpy()
        sets = list(weighted_sets(pa.array(part["text"], pa.string()), shared.value))
        _, roots = np.unique(part["root"].to_numpy(), return_inverse=True)
        left = np.flatnonzero((part["block"] == part["i"]).to_numpy())
        right = np.flatnonzero((part["block"] == part["j"]).to_numpy())
        pairs = joining_pairs(np.stack(part["sig"].to_numpy()), sets, roots, left, right, least)
        ends = [sorted((nodes[x], nodes[y])) for x, y in pairs]
        return pd.DataFrame(ends, columns=["a", "b"], dtype=object)

    exact = tasks.join(sigs, "node").join(texts, "node").groupBy("bucket", "i", "j").applyInPandas(join, "a binary, b binary")
    exact = cut_lineage(exact)
    return roots if exact.isEmpty() else components(stars.unionByName(exact))


def node_of(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def near_classes(rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``node, class_id, class_size, keep`` of the nodes in classes of several rows.

    ``rows`` are ``node, text, doc_id`` and the locator.
    """
    n, frequencies = document_frequencies(rows.select("text"))
    idf = damped_idf(n, frequencies)
    sigs = cut_lineage(signatures(rows.select("node", "text"), idf))
    pairs, buckets = candidate_pairs(sigs)
    found = links(pairs, rows, idf, least)
    roots = connected(found, buckets, sigs, rows, idf, least)
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    # Copies meet in the partial aggregate; from here on there is one row per text.
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW)
    nodes = rows.groupBy("node").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    nodes = cut_lineage(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    classes = nodes.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("class_size"))
    return nodes.drop("n", "first").join(classes.where("class_size > 1"), "root").select(
        "node", F.col("keep.doc_id").alias("class_id"), "class_size", "keep"
    )


@shielded("doc_id", "text")
def near_dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with ``class_id, class_size, kept``.

    Texts linked directly or through others, and all copies of them, are one class, named by
    its smallest ``doc_id`` (null only if it has no other); that row stays, and of several
    with this id the one at the smallest locator. A text without a word (a null one too) is in
    a class with its copies only. An empty table stays empty; columns of ``docs`` named like the
    added ones are replaced.
    """
    rows = located(docs)
    text = text_of(rows)
    rows = rows.withColumn("node", node_of(text))
    judged = rows.select("node", text.alias("text"), "doc_id", FILE, ROW)
    table, _ = broadcast_if_small(settle(docs.sparkSession, lambda: near_classes(judged, least)))
    out = rows.join(table, "node", "left")
    stays = (F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[ROW] == F.col(ROW))
    alone = F.col("class_size").isNull()
    return out.select(
        *docs.columns,
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
        F.coalesce(stays, F.lit(True)).alias("kept"),
    )


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class of near copies."""
    with python_stage(docs.sparkSession):  # all that runs in Python is saved when near_dedup returns
        return keeping_columns(docs, ("doc_id", "text"), lambda d: near_dedup(d).where("kept"))
