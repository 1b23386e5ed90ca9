"""Language identification by words first, backing off to shorter and shorter n-grams.

A known word scores its log frequency in each language. An unseen word is cut into
character n-grams of the longest order that has any known one, and scores the mean log
frequency of those among the different words of the language. Counts cover every training
document; the model that is sent to the executors keeps each language's own most frequent
entries up to a documented bound, with the counts that all languages have of them, so a
language keeps its words however small its share of the text. What falls out of the bound
backs off to shorter n-grams like any other unseen word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagemill.lineage import broadcast_if_small, cut_lineage, scratch
from pagemill.llm.rows import add_columns, share, shielded, without

# Letters of any script, and numerals such as a half that are no digits.
WORD = re.compile(r"[^\W\d_]+")
# Orders of n-grams, longest first; a word counts as order 0.
ORDERS = (4, 3, 2, 1)
# Words, and n-grams of each order, that each language has its most frequent of in the model; all
# languages' counts of a kept one are kept. With many languages they share the most entries.
MAX_WORDS, MAX_GRAMS, MOST = 25_000, 10_000, 500_000
SMOOTHING = 0.5
# Unseen words whose n-grams a worker remembers.
MAX_REMEMBERED = 200_000
# A text below this posterior probability is of no clear language.
MIN_SCORE = 0.5
# Characters up to which the words of a text are listed in one go.
LIST_CHARS = 1 << 22
UNDETERMINED = "und"

_COUNTS = "lang string, n int, gram string, count bigint"


def words_of(text: str) -> Counter:
    """Lower-cased words of a whole text with their counts: runs of letters (category L)."""
    text = text.lower()
    if len(text) <= LIST_CHARS:
        words = Counter(WORD.findall(text))
    else:
        words = Counter(m.group() for m in WORD.finditer(text))
    for word in [w for w in words if not w.isalpha()]:
        times = words.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            words[part] += times
    return words


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def held_out(doc_id: Column) -> Column:
    """Rows kept from training; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _rows(lang: str, n: int, counts: dict) -> pa.RecordBatch:
    size = len(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * size, pa.string()),
            pa.array([n] * size, pa.int32()),
            pa.array(list(counts), pa.string()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        names=["lang", "n", "gram", "count"],
    )


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, n = 0, gram, count`` of every word in all rows of ``text, lang``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by_lang.items():
                yield _rows(lang, 0, words)

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(partial, _COUNTS)
    return parts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def count_grams(words: DataFrame) -> DataFrame:
    """``lang, n, gram, count`` of the n-grams of every different word; each word counts once,
    since it is words not seen before that they are to tell apart."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[tuple[str, int], Counter] = {}
        for batch in batches:
            own: dict[str, list[str]] = {}
            for lang, word in zip(batch.column("lang").to_pylist(), batch.column("gram").to_pylist()):
                own.setdefault(lang, []).append(word)
            for lang, found in own.items():
                # Ends are marked by a space each; what spans two words has two in a row.
                joined = f" {'  '.join(found)} "
                for n in ORDERS:
                    grams = Counter(map("".join, zip(*(joined[i:] for i in range(n)))))
                    held = by_lang.setdefault((lang, n), Counter())
                    for gram, count in grams.items():
                        if "  " not in gram:
                            held[gram] += count
        for (lang, n), grams in by_lang.items():
            yield _rows(lang, n, grams)

    return words.mapInArrow(partial, _COUNTS).groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def most_frequent(counts: DataFrame, max_words: int, max_grams: int) -> DataFrame:
    """All languages' entries of the grams that are among the most frequent of some language.

    A language keeps, per order, its entries above the lowest frequency that leaves it within
    the bound. Frequencies are told apart in steps of an eighth of a power of two, so the driver
    sees at most a few hundred numbers per language and order, whatever the size of the table.
    """
    step = F.floor(F.log2("count") * 8).cast("int")
    sizes: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for lang, n, at, size in counts.groupBy("lang", "n", step.alias("at")).count().collect():
        sizes.setdefault((lang, n), []).append((at, size))
    share = MOST // max(1, len({lang for lang, _ in sizes}))
    floors = []
    for (lang, n), found in sizes.items():
        total, floor = 0, None
        for at, size in sorted(found, reverse=True):
            total += size
            if total > min(share, max_words if n == 0 else max_grams):
                break
            floor = at
        if floor is not None:
            floors.append((lang, n, floor))
    # A row per language and order.
    table = counts.sparkSession.createDataFrame(floors, "lang string, n int, floor int")
    kept = counts.join(F.broadcast(table), ["lang", "n"]).where(step >= F.col("floor")).select("n", "gram").distinct()
    # At most ``MOST`` words and ``MOST`` grams of each order.
    kept, _ = broadcast_if_small(cut_lineage(kept))
    return counts.join(kept, ["n", "gram"], "left_semi")


class Model:
    """Log frequencies of the kept entries; a row of ``table`` per entry, a column per language."""

    def __init__(self, entries: pa.Table, totals: list) -> None:
        """``entries`` are ``n, gram, lang, count`` in that order, sorted."""
        self.langs = sorted({t["lang"] for t in totals})
        column = {lang: i for i, lang in enumerate(self.langs)}
        all_counts, kinds = np.zeros((1 + max(ORDERS), len(self.langs))), np.zeros(1 + max(ORDERS))
        for t in totals:
            all_counts[t["n"], column[t["lang"]]] = t["count"]
            kinds[t["n"]] = max(kinds[t["n"]], t["kinds"])
        orders, grams = entries["n"].to_numpy(), entries["gram"].combine_chunks().dictionary_encode()
        codes = grams.indices.to_numpy(zero_copy_only=False)
        first = np.ones(len(codes), dtype=bool)
        first[1:] = (codes[1:] != codes[:-1]) | (orders[1:] != orders[:-1])
        names = grams.dictionary.to_pylist()
        self.index: list[dict[str, int]] = [{} for _ in range(1 + max(ORDERS))]
        for row, (n, code) in enumerate(zip(orders[first].tolist(), codes[first].tolist())):
            self.index[n][names[code]] = row
        order = orders[first]
        table = np.zeros((len(order), len(self.langs)))
        of = pc.index_in(entries["lang"], pa.array(self.langs, pa.string())).to_numpy()
        table[np.cumsum(first) - 1, of] = entries["count"].to_numpy()
        self.table = np.log((table + SMOOTHING) / (all_counts[order] + SMOOTHING * kinds[order][:, None] + SMOOTHING))
        share = all_counts[0] / max(1.0, all_counts[0].sum())
        self.prior = np.log(share + 1e-12)
        self.unseen: dict[str, list[int]] = {}

    def back_off(self, word: str) -> list[int]:
        """Entries of the word's known n-grams of the longest order that has any."""
        for n in ORDERS:
            known = [i for i in map(self.index[n].get, grams_of(word, n)) if i is not None]
            if known:
                return known
        return []

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        entries: list[int] = []
        times: list[float] = []
        for (word, count), entry in zip(words.items(), map(self.index[0].get, words)):
            if entry is not None:
                entries.append(entry)
                times.append(count)
                continue
            known = self.unseen.get(word)
            if known is None:
                if len(self.unseen) >= MAX_REMEMBERED:
                    self.unseen.clear()
                known = self.unseen[word] = self.back_off(word)
            if known:
                entries += known
                times += [count / len(known)] * len(known)
        score = self.prior + np.asarray(times, dtype=float) @ self.table[entries] if entries else self.prior
        best = int(score.argmax())
        return self.langs[best], float(1 / np.exp(score - score[best]).sum())


def train(docs: DataFrame, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model of at most ``max_words + 4 * max_grams`` grams of each language from all rows of ``text, lang``."""
    with scratch(docs.sparkSession):
        words = cut_lineage(count_words(docs))
        counts = words.unionByName(cut_lineage(count_grams(words)))
        totals = counts.groupBy("lang", "n").agg(F.sum("count").alias("count"), F.count(F.lit(1)).alias("kinds"))
        entries = most_frequent(counts, max_words, max_grams).select("n", "gram", "lang", "count")
        # Sorted, since the order of a shuffle is not repeatable and sums of floats depend on it.
        held = entries.toArrow().sort_by([(c, "ascending") for c in ("n", "gram", "lang")])
        return Model(held, totals.orderBy("lang", "n").collect())


@shielded("text", "lang")
def identify(docs: DataFrame, model: Model, drop: tuple = ()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, its posterior probability.

    ``lang_pred`` is a learned language, or ``und`` (score 0) for a text that is null or has
    no letter, or if nothing was learned. A text whose words have no known n-gram at all
    gets the most frequent language. Repeated rows are judged alike; an empty table stays
    empty; columns named like the added ones are replaced. Ties go to the language that
    sorts first.
    """
    shared = share(docs.sparkSession, model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [shared.value.predict(text) for text in batch.column("text").to_pylist()]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return add_columns(docs, fields, compute, drop)


@shielded("doc_id", "text", "lang")
def language_id(docs: DataFrame, drop: tuple = (), **bounds: int) -> DataFrame:
    """Learn from the labelled rows of ``docs`` that are not held out, then judge every row."""
    training = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    return identify(docs.withColumn("held_out", held_out(F.col("doc_id"))), train(training, **bounds), drop)


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is clearly of one learned language."""
    clear = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)
    return without(
        docs, ("doc_id", "text", "lang"), lambda d: language_id(d, drop=("text", "lang")).where(~clear)
    )
