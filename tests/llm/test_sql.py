"""The registered queries against their SQL, and the pipeline against its operators."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from pagemill.llm import queries

from . import brute

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, db, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    want = db.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert Counter(tuple(r) for r in found.select(*names).collect()) == Counter(want.fetchall())


def test_all_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert queries.QUERIES.keys() | {"pipeline"} <= driver.queries().keys()


def test_pipeline_against_brute_force(spark, tmp_path):
    """Stages 2 to 4 recomputed from what stage 1 keeps, and the mix from what they keep."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    mixed = corpus_pipeline.run(spark, SF_DIR).collect()
    last = {}
    for d in docs:  # the largest id of equal texts stays
        if any(c.isalpha() for c in d[1]):
            last[d[1]] = max(last.get(d[1], -1), d[0])
    texts = sorted(last, key=last.get)
    root = brute.groups_of(len(texts), brute.near_pairs(texts, 0.8))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {last[t] for i, t in enumerate(texts) if root[i] == i and not brute.contamination(t, items)[-1]}
    by_id = {d[0]: d for d in docs}
    copies = Counter(r.doc_id for r in mixed)
    assert copies.keys() <= kept and set(copies.values()) <= {1, 2}
    sizes = Counter()
    for i in kept:
        sizes[by_id[i][3]] += len(brute.spaced_words(by_id[i][1]))
    taken = Counter()
    for r in mixed:
        assert (r.text, r.lang, r.source, r.n_chars) == by_id[r.doc_id][1:]
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.size
    targets = {r.source: r.target for r in mixed}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - t) <= 0.02 * t + 50 for s, t in targets.items())


def test_pipeline_of_hard_rows(spark, tmp_path):
    rows = brute.hard_rows()
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[7][1])], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert set(docs.columns) <= set(mixed.columns)
    left = {r.doc_id for r in mixed.collect()}
    assert left and not left & {3, 4, 5, 6, 7, 8, 12, 20}  # no letters, or a passage of the item
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), str(tmp_path))
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
