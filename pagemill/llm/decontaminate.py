"""Benchmark decontamination by Wu-Manber search over words.

Every window of an item's words is a test string. Per string length, a shift table indexed
by the hash of a block of two words says how far the search may jump; where it says zero,
the block's bucket selects the strings that end in it, and comparing the words themselves
confirms an occurrence. Strings of different lengths have tables of their own, so that a
short item does not shorten the jumps of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagemill.lineage import cut_lineage
from pagemill.llm.rows import add_columns, share, shielded, without
from pagemill.llm.words import ALNUM, Words, mix, word_blocks

WINDOW = 10
# Test strings (with their item) searched in one pass over the documents.
MAX_STRINGS = 100_000
# Fixed value: a word, in lower-cased text.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_column(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none of a null."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD_PATTERN), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item string, words string``: distinct windows of each item, words joined by one space.

    An item of fewer words than a window, but not none, is one window. A null item id reads
    as an empty one.
    """
    words = F.col("w")
    last = F.greatest(F.size(words) - window, F.lit(0))
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), last))
    windows = F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, window), " "))
    return (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_column(F.col("text")).alias("w"))
        .select("item", F.explode(windows).alias("words"))
        .distinct()
    )


class Table:
    """Shift and bucket tables of test strings that all have ``length`` words."""

    def __init__(self, length: int, strings: list[bytes]) -> None:
        self.length, self.block = length, min(2, length)
        column = pa.array([s.decode() for s in strings], pa.string())
        hashes = np.concatenate([w.hashes() for _, _, w in word_blocks(column, ALNUM)])
        rows = hashes.reshape(len(strings), length)
        blocks = self.blocks(rows)
        self.bits = np.uint64(64 - max(16, min(26, int(np.ceil(np.log2(blocks.size + 1))) + 4)))
        self.shift = np.full(1 << (64 - int(self.bits)), length - self.block + 1, dtype=np.uint16)
        for k in range(blocks.shape[1]):  # the block that ends k + block words into the string
            np.minimum.at(self.shift, (blocks[:, k] >> self.bits).astype(np.int64), blocks.shape[1] - 1 - k)
        self.buckets: dict[int, list[tuple[int, int]]] = {}
        for i, (last, head) in enumerate(zip(blocks[:, -1].tolist(), rows[:, 0].tolist())):
            self.buckets.setdefault(last, []).append((head, i))
        self.strings = strings

    def blocks(self, hashes: np.ndarray) -> np.ndarray:
        """Hashes of the blocks of two words that start at each word but the last."""
        if self.block == 1:
            return hashes
        return mix(hashes[..., :-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[..., 1:])

    def search(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``document, first word, string`` of every occurrence."""
        if len(hashes) < self.length:
            return
        blocks = self.blocks(hashes)
        shifts = self.shift[(blocks >> self.bits).astype(np.int64)].tolist()
        first, lead = words.first.tolist(), self.length - self.block
        for d in range(len(first) - 1):
            at, end = first[d] + lead, first[d + 1] - self.block
            while at <= end:
                jump = shifts[at]
                if jump:
                    at += jump
                    continue
                start = at - lead
                for head, i in self.buckets.get(int(blocks[at]), ()):
                    if head == int(hashes[start]) and words.text(start, start + self.length) == self.strings[i]:
                        yield d, start, i
                at += 1


class Strings:
    """Distinct test strings and their items; the tables are built once in each worker."""

    def __init__(self, pairs: list[tuple[str, str]]) -> None:
        self.items: dict[str, list[str]] = {}
        for item, words in pairs:
            self.items.setdefault(words, []).append(item)
        self.tables: list[Table] | None = None

    def __getstate__(self) -> dict:
        return {"items": self.items, "tables": None}

    def load(self) -> list[Table]:
        if self.tables is None:
            by_length: dict[int, list[bytes]] = {}
            for words in self.items:
                by_length.setdefault(words.count(" ") + 1, []).append(words.encode())
            self.tables = [Table(n, strings) for n, strings in sorted(by_length.items())]
        return self.tables

    def hits(self, words: Words) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Hit word ranges and the items found, by document."""
        ranges: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        hashes = words.hashes()
        for table in self.load():
            for d, start, i in table.search(words, hashes):
                own = start - int(words.first[d])
                ranges.setdefault(d, []).append((own, own + table.length))
                items.setdefault(d, set()).update(self.items[table.strings[i].decode()])
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(docs: DataFrame, strings: Strings, drop: tuple) -> DataFrame:
    """One pass over the documents; hits add to those of earlier passes."""
    shared = share(docs.sparkSession, strings)
    earlier = "hit_ranges" in docs.columns

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words: list[int] = []
        ranges: list[list] = [[] for _ in range(batch.num_rows)]
        items: list[set] = [set() for _ in range(batch.num_rows)]
        if earlier:
            for d, (old, found) in enumerate(zip(batch.column("_ranges").to_pylist(), batch.column("_items").to_pylist())):
                ranges[d], items[d] = [(r["start"], r["end"]) for r in old], set(found)
        for lo, _, words in word_blocks(batch.column("text"), ALNUM, lower=True):
            n_words += words.counts().tolist()
            hit, found = shared.value.hits(words)
            for d, more in hit.items():
                ranges[lo + d] += more
                items[lo + d] |= found[d]
        ranges = [merged(r) for r in ranges]
        return [
            pa.array(n_words, pa.int64()),
            pa.array([sum(r["end"] - r["start"] for r in own) for own in ranges], pa.int64()),
            pa.array(ranges, _RANGES),
            pa.array([sorted(own) for own in items], pa.list_(pa.string())),
        ]

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_ranges", T._parse_datatype_string("array<struct<start:bigint,end:bigint>>")),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    if earlier:
        docs = docs.withColumnsRenamed({"hit_ranges": "_ranges", "items": "_items"})
        drop = (*drop, "_ranges", "_items")
    return add_columns(docs, fields, compute, drop)


@shielded("text")
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_strings: int = MAX_STRINGS, drop: tuple = ()
) -> DataFrame:
    """``docs`` with ``n_words, n_hit, hit_ranges, items, contaminated``.

    ``hit_ranges`` are the merged word ranges that some window of an item covers, ``items``
    the ids (as sorted text) of the items with such a window. All windows of all items are
    searched, in blocks of about ``max_strings``; between two blocks the documents are saved
    in the shared folder. A null or empty text has no words and no hits; an empty benchmark
    hits nothing; repeated rows are judged alike; columns named like the added ones are
    replaced. Columns in ``drop`` (such as the text) are left out of the result.
    """
    windows = cut_lineage(item_windows(benchmark, window))
    blocks = max(1, -(-windows.count() // max_strings))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    out = docs
    for k in range(blocks):
        # At most about max_strings rows: the bound on what is sent to the executors.
        pairs = sorted((r.item, r.words) for r in windows.where(block == k).collect())
        last = k == blocks - 1
        out = _pass(out, Strings(pairs), drop if last else ())
        if not last:
            out = cut_lineage(out)
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any window of an item."""
    return without(docs, ("text",), lambda d: decontaminate(d, benchmark, drop=("text",)).where("contaminated"))
