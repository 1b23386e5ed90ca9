"""Packing against ids of whole texts, and its plan against counts and brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pagemill.llm import packing, queries, tokens

from . import brute

SF_DIR = "/root/testdata/sf0.01"
PATH = tokens.public_path()
WHOLE = Tokenizer.from_file(PATH)


@pytest.fixture
def tokenizer():
    return WHOLE


def ids_of(column):
    return [ids[a:b].tolist() for _, _, ids, first in tokens.encoded(column, PATH) for a, b in zip(first, first[1:])]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.none() | st.text(st.sampled_from("ab1'.<| \t\n\r\x0b\x1c\x7f\u0085  　́éß中😀") | st.characters(), max_size=30),
        max_size=8,
    )
)
def test_ids_of_parts_are_those_of_the_text(texts):
    texts += ["a<|endoftext|>b", "it's <|endoftext|>\n"]
    whole = WHOLE.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert ids_of(pa.array(texts, pa.string())) == [e.ids for e in whole]


def check_packed(rows, texts, tokenizer, length=1024):
    """Pieces tile their documents, sequences are gapless and hold at most ``length`` ids."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == texts.keys()
    by_sequence = defaultdict(list)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // length) and all(r.length == length for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at and 0 < r.length <= length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
            by_sequence[r.sequence_id].append((r.offset, r.length))
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence), sum(r.length for r in rows)


def test_packing_of_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = queries.op13_best_fit_packing(spark, SF_DIR).collect()
    used, total = check_packed(rows, texts, tokenizer)
    sizes = Counter(r.length for r in rows)
    plain = sum(r.count for r in packing.best_fit([], sizes, 1024))
    assert -(-total // 1024) <= used <= plain


def test_hard_rows(spark, tokenizer):
    rows = {i: r for i, r in enumerate(brute.hard_rows())}
    docs = spark.createDataFrame([(i, r[1], r[2], 1, 2) for i, r in rows.items()], "doc_id int, text string, ids string, _rank int, length int")
    packed = packing.pack(docs.repartition(3), length=64)
    found = packed.collect()
    check_packed(found, {i: r[1] for i, r in rows.items()}, tokenizer, 64)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    whole = {r.sequence_id: r.ids for r in packing.sequences(spark.createDataFrame(found, packed.schema)).collect()}
    for r in found:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_repeats_nulls_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (None, "")], "doc_id bigint, text string")
    rows = packing.pack(docs, keep_ids=False).collect()
    assert len(rows) == 4 and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows) == sorted(np.cumsum([0, *[r.length for r in sorted(rows, key=lambda r: r.offset)]])[:-1].tolist())
    assert packing.pack(docs.limit(0)).collect() == []


def test_ranks_do_not_need_a_broadcast(spark, monkeypatch, tokenizer):
    from pagemill import lineage

    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    texts = {i: f"word {i % 5} " * (i % 7) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    check_packed(packing.pack(docs, length=32).collect(), texts, tokenizer, 32)


def held(runs, length):
    back = Counter()
    for run in runs:
        assert run.count > 0 and sum(run.sizes) <= length
        for size in run.sizes:
            back[size] += run.count
    return back


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_holds_every_piece(counts):
    runs = packing.packing_plan(counts, length=40, groups=(3, 6), small=5)
    assert held(runs, 40) == Counter(counts)
    total = sum(s * n for s, n in counts.items())
    assert sum(r.count for r in runs) <= max(1, 2 * -(-total // 40))


def exact_bins(sizes, length):
    """The fewest sequences, by trying all ways."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, length - sizes[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_plan_of_few_pieces_is_near_the_best(sizes):
    runs = packing.packing_plan(dict(Counter(sizes)), length=20, groups=(8,), small=2)
    assert sum(r.count for r in runs) <= exact_bins(sorted(sizes, reverse=True), 20) + 1


def test_program_beats_best_fit_where_thirds_fit():
    """Best fit, longest first, pairs what the program puts three to a sequence."""
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(200, 420, 20_000).tolist())
    plan = packing.packing_plan(dict(counts))
    assert held(plan, 1024) == counts
    assert sum(r.count for r in plan) < 0.98 * sum(r.count for r in packing.best_fit([], dict(counts), 1024))


def test_groups_have_equal_cardinality():
    counts = {s: s % 7 + 1 for s in range(65, 1024)}
    stocks = packing.linear_groups(counts, 24)
    sizes = [sum(n for _, n in stock.left) for _, stock in stocks]
    assert len(set(sizes[:-1])) == 1 and sizes[-1] <= sizes[0]
    assert all(size == stock.left[0][0] for size, stock in stocks)


def test_size_of_the_plan_does_not_grow_with_the_corpus():
    counts = {s: 1000 + s for s in range(1, 1025)}
    few, many = packing.packing_plan(counts), packing.packing_plan({s: n * 1000 for s, n in counts.items()})
    assert len(many) <= 1.5 * len(few)
    assert sum(r.count for r in many) <= 1001 * sum(r.count for r in few)
