"""Collocations against counts in plain Python."""

import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill import lineage
from pagemill.llm import collocations as co

from . import brute

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_collocations(rows, longest=4, least=30, share=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute._LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= share * candidates[p[i : i + m]]:
                        dropped.add(p[i : i + m])
        rows = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in co.collocations(docs, **options).select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.fixture(scope="module")
def prose():
    """Frequent phrases of two to six words in three languages, one of them without a name."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(25)] + ["É", "the", "New", "ß"]
    phrases = ["New York", "a b c", "x y z q", "one two three four five six", "É ß", "the the the"]
    rows = []
    for i in range(400):
        parts = [phrases[j] if j < len(phrases) else " ".join(rng.choice(words, 3)) for j in rng.integers(0, 14, 12)]
        glue = rng.choice([" ", "  \t", ". ", ",", "\n", "\x0b", " "], len(parts))
        rows.append((["en", None, "de"][min(2, i % 4)], "".join(p + g for p, g in zip(parts, glue))))
    return rows


@pytest.mark.parametrize("least, share, top", [(30, 80, 2000), (5, 50, 40), (2, 100, 7)])
def test_against_brute_force(spark, prose, least, share, top):
    want = brute_collocations(prose, least=least, share=share, top=top)
    assert want and {r[0] for r in want} == {"en", "de", "und"}
    assert found(frame(spark, prose).repartition(7), least=least, share=share, top=top) == want


def test_longer_phrases_and_no_broadcast(spark, prose, monkeypatch):
    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(co, "HELD", 100)
    assert found(frame(spark, prose), longest=6, least=20) == brute_collocations(prose, longest=6, least=20)


def test_a_full_filter_changes_nothing(spark, prose, monkeypatch):
    """Beyond its bound the filter lets more through; the counts decide."""
    monkeypatch.setattr(co.Filter, "passes", lambda self, hashes: np.ones(len(hashes), bool))
    assert found(frame(spark, prose)) == brute_collocations(prose)


def test_hard_rows(spark):
    rows = [(None if i % 3 == 0 else f"l{i % 2}", r[1]) for i, r in enumerate(brute.hard_rows())]
    rows += [("", "a b a b a b"), ("l1", "x" * 100_000 + " y " + "x" * 100_000 + " y")]
    want = brute_collocations(rows, least=2)
    assert found(frame(spark, rows), least=2) == want and any(len(r[2]) > 100_000 for r in want)


def test_other_columns_and_empty_tables(spark, prose):
    docs = frame(spark, prose).withColumns({c: F.lit(1) for c in ("phrase", "f", "lefts", "rank", "doc_id", "head")})
    assert found(docs) == brute_collocations(prose)
    assert found(docs.limit(0)) == [] and found(frame(spark, [("en", None), (None, "")])) == []


def test_scores_are_exact_beyond_64_bits(spark):
    """The quotient of products of over 64 bits, next to a whole number."""
    big = 4_000_000_000_000_000_000
    rows = [(big, big, [big * 2 - 1, 0], [0, 0]), (big - 1, big, [big, 0], [big, 0]), (3, big, [7, 3], [5, 3])]
    for f, _, lefts, rights in rows:
        df = spark.createDataFrame([(f, lefts, [rights[0] or 1, 0])], "f bigint, lefts array<bigint>, rights array<bigint>")
        got = df.select(co.weakest_cut(2).alias("cut")).first().cut
        assert got.score == 2_000_000 * f // (lefts[0] + (rights[0] or 1))


def test_ties_go_to_the_first_cut(spark):
    df = spark.createDataFrame([(10, [20, 20, 20, 10], [20, 20, 20, 10])], "f bigint, lefts array<bigint>, rights array<bigint>")
    assert df.select(co.weakest_cut(4).alias("cut")).first().cut.k == 1


def test_filter_has_no_false_negatives():
    made = co.Filter(1 << 16)
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    for at in made.probes(hashes):
        np.bitwise_or.at(made.data, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    assert made.passes(hashes).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert made.passes(others).mean() < 0.2


def test_hashes_of_a_phrase_do_not_depend_on_its_place():
    from pagemill.llm.words import word_blocks

    text, phrase = pa.array(["", "one two three four", "two three"]), pa.array(["two three"])
    words = next(word_blocks(text, co._WORD))[2]
    alone = next(word_blocks(phrase, co._WORD))[2]
    assert co.phrase_hashes(words.hashes(), 2, "en")[1] == co.phrase_hashes(alone.hashes(), 2, "en")[0]
    assert co.phrase_hashes(alone.hashes(), 2, "en")[0] != co.phrase_hashes(alone.hashes(), 2, "de")[0]


def test_streams_meet_in_merge_joins(spark, prose):
    plan = co.collocations(frame(spark, prose))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan
    assert Path(co.__file__).read_text().count('hint("merge")') == 3
