"""Phrase collocations from sorted count streams.

Phrases are counted order by order (one word, two, ...). A phrase cannot be more frequent than
a phrase within it, so an order only counts what lies between frequent phrases of the order
below; these are sent as a Bloom filter, which lets too much through but never too little, and
the counts decide. The counts of each order form two streams: one in the order of the first
words (prefix order), one in that of the last words (suffix order). Merge joins of a stream with
the one of the order below carry along the counts of all first parts (prefix order) and all last
parts (suffix order) of a phrase, and back the counts of its extensions by one word on either
side. No counts are held in hash tables.

Extensions by one word are enough: if a phrase of two more words is nearly as frequent as the
one within it, so is the phrase of one more word between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.llm.rows import python_stage, share
from pagemill.llm.tokens import gather
from pagemill.llm.words import Words, mix, ngrams, word_blocks

# Longest phrase, least count, share (in percent) of a phrase that one around it
# needs to replace it, rows reported per language, scale of the scores.
LONGEST, LEAST, SHARE, TOP, SCALE = 4, 30, 80, 2_000, 2_000_000
# Shares of a language whose best phrases are found side by side.
SHARES = 16
# Fixed value: the language of documents without one.
UNKNOWN = "und"
# Bits per frequent phrase in a filter, and the most bits of one (32 MB). Beyond, more phrases
# pass it, which costs shuffling and leaves the counts as they are.
FILTER_BITS, MOST_BITS = 8, 1 << 28
# Phrases that a task holds before it counts them, bytes of text that it takes apart at a time,
# and phrases cut out at a time.
HELD, SLICE_BYTES, CUT = 1 << 18, 1 << 23, 1 << 14

_BYTES = np.arange(256)
# Bytes between words, and bytes that end a piece.
_BLANK = (_BYTES == 0x20) | (_BYTES == 0x09)
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_WORD = ~(_BLANK | _STOP)


# --- filters -----------------------------------------------------------------------


class Filter:
    """A Bloom filter of two probes over 64-bit hashes."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.data = np.zeros(bits >> 3, np.uint8)

    def probes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        again = mix(hashes + np.uint64(0x9E3779B97F4A7C15))
        return (hashes >> self.shift).astype(np.int64), (again >> self.shift).astype(np.int64)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.probes(hashes):
            out &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return out


def phrase_hashes(words: np.ndarray, n: int, lang: str) -> np.ndarray:
    """Hashes of all runs of ``n`` words of a language; entry ``i`` starts at word ``i``."""
    own = np.frombuffer(lang.encode() or b"\0", np.uint8).astype(np.uint64)
    return mix(ngrams(words, n) ^ ngrams(own + np.uint64(1), len(own))[0])


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about ``SLICE_BYTES`` of text at a time."""
    rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def by_language(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str, pa.Array]]:
    """The column's values of each language."""
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1))
    values = batch.column(column).take(pa.array(order))
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, values.slice(int(bounds[k]), int(bounds[k + 1] - bounds[k]))


def frequent_filter(stream: DataFrame, n: int) -> Filter:
    """The filter of the phrases of a stream of order ``n``: at most ``MOST_BITS`` reach the driver."""
    wanted = FILTER_BITS * max(1, stream.count())
    made = Filter(max(1 << 16, min(MOST_BITS, 1 << (wanted - 1).bit_length())))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, phrases in by_language(batch, "phrase"):
                for _, _, words in word_blocks(phrases, _WORD):
                    hashes = phrase_hashes(words.hashes(), n, lang)[::n]
                    at = np.unique(np.concatenate(made.probes(hashes)))
                    yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 0x7FFF)], names=["bucket", "bit"])

    at = stream.select("lang", "phrase").mapInArrow(positions, "bucket bigint, bit bigint")
    for row in at.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        size = min(4096, len(made.data))
        made.data[row.bucket * 4096 : row.bucket * 4096 + size] = np.frombuffer(row.bits, np.uint8)[:size]
    return made


# --- counts ------------------------------------------------------------------------


def _runs(words: Words, n: int, lang: str, known: Filter | None) -> pa.Array:
    """The phrases of ``n`` words within pieces, whose parts pass the filter."""
    places = len(words.starts) - n + 1
    if places <= 0:
        return pa.array([], pa.large_string())
    # Pieces end at stops and at the ends of documents; both only add up.
    piece = np.cumsum(_STOP[words.data])[words.starts] + np.repeat(np.arange(len(words.first) - 1), words.counts())
    inside = piece[:places] == piece[n - 1 :]
    if known is not None:
        passed = known.passes(phrase_hashes(words.hashes(), n - 1, lang))
        inside &= passed[:-1] & passed[1:]
    at = np.flatnonzero(inside)
    # All words with one space behind each, of which every phrase is a run of bytes.
    sizes = words.ends - words.starts + 1
    joined = gather(np.append(words.data, np.uint8(0x20)), words.starts, sizes)
    ends = np.cumsum(sizes)
    joined[ends - 1] = 0x20
    start, size = (ends - sizes)[at], ends[at + n - 1] - 1 - (ends - sizes)[at]
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    cuts = [gather(joined, start[i : i + CUT], size[i : i + CUT]) for i in range(0, len(at), CUT)]
    data = np.concatenate(cuts) if cuts else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def phrase_counts(docs: DataFrame, n: int, known: Filter | None = None) -> DataFrame:
    """``lang, phrase, f`` of all phrases of ``n`` words that may be frequent.

    ``docs`` are ``lang, text``. For ``n = 1`` there is also a row per language without a
    phrase, with the number of its words.
    """
    shared = share(docs.sparkSession, known)

    def count(lang: str, held: list[pa.Array]) -> pa.RecordBatch:
        counts = pc.value_counts(pa.chunked_array(held, pa.large_string()))
        phrases, times = counts.field("values").cast(pa.string()), counts.field("counts")
        if n == 1:
            phrases = pa.concat_arrays([phrases, pa.nulls(1, pa.string())])
            times = pa.concat_arrays([times, pa.array([sum(map(len, held))], pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases)), phrases, times], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in (own for batch in batches for part in slices(batch) for own in by_language(part, "text")):
            held, size = [], 0
            for _, _, words in word_blocks(texts, _WORD, lower=True):
                held.append(_runs(words, n, lang, shared.value))
                size += len(held[-1])
                if size > HELD:
                    yield count(lang, held)
                    held, size = [], 0
            if size:
                yield count(lang, held)

    partial = docs.mapInArrow(run, "lang string, phrase string, f bigint")
    return partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def streams(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, list[DataFrame]]:
    """``lang, n`` (words), and per order ``lang, phrase, f, lefts, rights, head, tail``.

    ``lefts`` are the counts of the phrase's first 1, 2, ... words, ``rights`` of its last;
    ``head`` is the phrase without its last word, ``tail`` without its first.
    """
    counts = cut_lineage(phrase_counts(docs, 1).where((F.col("f") >= least) | F.col("phrase").isNull()))
    totals = counts.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    alone = F.array("f")
    out = [counts.where(F.col("phrase").isNotNull()).select("lang", "phrase", "f", alone.alias("lefts"), alone.alias("rights"))]
    for n in range(2, longest + 1):
        below = out[-1]
        found = phrase_counts(docs, n, frequent_filter(below, n - 1)).where(F.col("f") >= least)
        found = found.withColumns(
            {"head": F.substring_index("phrase", " ", n - 1), "tail": F.substring_index("phrase", " ", 1 - n)}
        )
        # In prefix order with the first words of the order below, then in suffix order.
        prefix = below.select("lang", F.col("phrase").alias("head"), F.col("lefts"))
        suffix = below.select("lang", F.col("phrase").alias("tail"), F.col("rights"))
        joined = found.join(prefix.hint("merge"), ["lang", "head"]).join(suffix.hint("merge"), ["lang", "tail"])
        grown = {c: F.concat(F.col(c), alone) for c in ("lefts", "rights")}
        out.append(cut_lineage(joined.withColumns(grown)))
    return totals, out


# --- collocations ------------------------------------------------------------------


def exact(c: Column) -> Column:
    """A whole number that products do not overflow."""
    return c.cast("decimal(19,0)")


def weakest_cut(n: int) -> Column:
    """``score, k, l, r`` of the cut with the lowest score; the first of equal ones."""

    def cut(k: int) -> Column:
        parts = f"lefts[{k - 1}] as decimal(19,0)", f"rights[{n - k - 1}] as decimal(19,0)"
        # Whole division of decimals: exact, and at most half the scale.
        score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(f as decimal(19,0)) div (cast({parts[0]}) + cast({parts[1]}))")
        return F.struct(
            score.alias("score"), F.lit(k).alias("k"), F.col("lefts")[k - 1].alias("l"), F.col("rights")[n - k - 1].alias("r")
        )

    return F.array_min(F.array(*(cut(k) for k in range(1, n))))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` and ``k, longer``: the best phrases of each language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts of its weakest cut (after
    ``k`` words), ``n`` the language's number of words, ``longer`` the highest count of a
    candidate with one more word (0 if there is none). A phrase gives way to a candidate around
    it that has ``share`` percent of its count. All counts cover whole texts of all documents. A
    null text is empty, a null language ``und``; equal scores go by count and then by phrase in
    byte order; repeated rows count as often as they are there; only ``lang`` and ``text`` are
    read, so other columns may have any name. An empty table gives no rows.
    """
    read = docs.select(F.coalesce(docs["lang"], F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    with python_stage(docs.sparkSession):  # all counts are saved when it ends
        totals, orders = streams(read, longest, least)
    kept = None
    for n in range(2, longest + 1):
        own = orders[n - 1].select("lang", "phrase", "f", weakest_cut(n).alias("cut"))
        if n < longest:
            above = orders[n]
            for side, more in (("head", "_after"), ("tail", "_before")):
                most = above.groupBy("lang", F.col(side).alias("phrase")).agg(F.max("f").alias(more))
                own = own.join(most.hint("merge"), ["lang", "phrase"], "left")
            own = own.withColumn("longer", F.coalesce(F.greatest("_after", "_before"), F.lit(0))).drop("_after", "_before")
        else:
            own = own.withColumn("longer", F.lit(0).cast("bigint"))
        own = own.where(exact(F.col("longer")) * 100 < exact(F.col("f")) * share)
        kept = own if kept is None else kept.unionByName(own)
    # The best of each share of a language first, so one task gets at most ``SHARES * top`` rows.
    order = F.desc("cut.score"), F.desc("f"), "phrase"
    kept = kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for by in (["lang", "_share"], ["lang"]):
        best = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        kept = kept.withColumn("rank", best).where(F.col("rank") <= top)
    ranked = kept
    return ranked.join(broadcast_if_small(totals)[0], "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        F.col("f").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").cast("bigint").alias("score"),
        F.col("cut.k").cast("bigint").alias("k"),
        "longer",
    )
