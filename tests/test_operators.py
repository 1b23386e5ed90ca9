import random
import re
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from pagemill import lineage
from pagemill.functions.tags import KEYWORDS
from pagemill.operators import balance, counts, edits, ranking, trends
from pagemill.operators.numbering import number_rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- counts ------------------------------------------------------------------------


def test_word_count(spark):
    df = spark.createDataFrame([("to be or not",), ("  to be\tTo ",), ("",)], "value string")
    assert rows(counts.word_count(df)) == [("To", 1), ("be", 2), ("not", 1), ("or", 1), ("to", 2)]


TRAFFIC = [("en", "A", 4), ("de", "A", 5), ("en", "B", 9), ("en", "C", 2**31), ("en", "C", 1)]


def test_access_count(spark):
    df = spark.createDataFrame(TRAFFIC, "project string, title string, views bigint")
    assert rows(counts.access_count(df)) == [("A", 9), ("B", 9), ("C", 2**31 + 1)]
    assert rows(counts.access_count(df, project="de")) == [("A", 5)]
    assert ("de", "A", 5) in rows(counts.access_count(df, by_project=True))
    assert [tuple(r) for r in counts.top_pages(counts.access_count(df), 2).collect()] == [
        ("C", 2**31 + 1),
        ("B", 9),
    ]
    assert counts.top_pages(counts.access_count(df)).count() == 3


# --- trends ------------------------------------------------------------------------

VISITS = [
    ("A", date(2010, 1, 1), 4),
    ("A", date(2009, 12, 31), 3),
    ("A", date(2010, 1, 3), 11),
    ("B", date(2010, 1, 2), 10),
    ("C", date(2010, 1, 2), 0),
    ("C", date(2010, 1, 4), 12),
]


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(VISITS, "title string, day date, views bigint")


def test_trend(visits):
    daily = trends.daily_counts(visits)
    assert rows(trends.trend(daily, threshold=10)) == [("A", 11, "0-7 2-11"), ("C", 12, "3-12")]
    assert rows(trends.trend(daily)) == []
    dense = {r.title: r.days for r in trends.dense_trend(daily).collect()}
    assert dense["A"] == [7, 0, 11] + [0] * 72 and dense["C"][:4] == [0, 0, 0, 12]
    assert rows(trends.dense_trend(daily, threshold=11).select("title")) == [("C",)]


def test_rows_without_title_are_dropped(spark):
    df = spark.createDataFrame([(None, date(2010, 1, 1), 5), ("A", date(2010, 1, 1), 1)], "title string, day date, views bigint")
    assert rows(trends.daily_counts(df)) == [("A", 0, 1)]


def test_sparse_and_dense_agree(visits):
    daily = trends.daily_counts(visits)
    sparse = {r.title: r.series for r in trends.trend(daily, threshold=-1).collect()}
    for r in trends.dense_trend(daily).collect():
        assert sparse[r.title] == " ".join(f"{i}-{n}" for i, n in enumerate(r.days) if n)


def test_late_days_fail_whatever_is_used(visits):
    daily = trends.daily_counts(visits, n_days=3)
    for columns in (["title"], ["n"], ["day"], ["title", "n"]):
        with pytest.raises(Exception, match="outside the window"):
            daily.select(*columns).collect()


def test_window_ends(visits):
    assert rows(trends.daily_counts(visits, early="drop"))[0] == ("A", 0, 4)
    with pytest.raises(Exception, match="day index outside the window: 3"):
        trends.daily_counts(visits, n_days=3).collect()
    assert ("C", 3, 12) not in rows(trends.daily_counts(visits, n_days=3, late="drop"))
    assert rows(trends.late_records(visits, n_days=3)) == [("C", date(2010, 1, 4), 12)]
    with pytest.raises(ValueError):
        trends.daily_counts(visits, early="keep")


# --- edits -------------------------------------------------------------------------


def random_revisions(n, seed=1):
    """Half of all edits are by one user and a third on one page."""
    rng = random.Random(seed)
    words = ["", "Fixed typo", "bad dog", "Removed", "created x", "talk", "REVERT edit"]
    out = []
    for rev in range(n):
        user = "bot" if rng.random() < 0.5 else f"u{rng.randrange(40)}"
        page = 0 if rng.random() < 0.34 else rng.randrange(60)
        out.append((rev, page, rng.choice(words), user, f"200701{rng.randrange(10, 31)}101010"))
    rng.shuffle(out)
    return out


def brute_tags(comment):
    glued = "".join(comment.lower().split())
    return [k for k in KEYWORDS if k in glued]


def brute_history(data, by, size):
    key, other = (3, 1) if by == "user" else (1, 3)
    groups = defaultdict(list)
    for r in data:
        groups[r[key]].append(r)
    out = {}
    for k, rs in groups.items():
        rs.sort(key=lambda r: (r[4], r[0]))
        tagged = [r for r in rs if r[2].strip()]
        tags = brute_tags(tagged[-1][2]) if tagged else []
        for part in range(0, (len(rs) - 1) // size + 1):
            piece = rs[part * size : (part + 1) * size]
            out[(k, part)] = (len(piece), [r[4] for r in piece], [str(r[other]) for r in piece], tags)
    return out


REVISION = "rev_id bigint, page_id bigint, comment string, user string, ts string"


@pytest.fixture(scope="module")
def revision_data():
    return random_revisions(3000)


@pytest.fixture(scope="module")
def revisions(spark, revision_data):
    return spark.createDataFrame(revision_data, REVISION).repartition(5)


@pytest.mark.parametrize("by", ["user", "page"])
@pytest.mark.parametrize("size", [7, 60, 10_000])
def test_history_against_brute_force(revisions, revision_data, by, size):
    history = edits.edit_history(revisions, by, part_edits=size)
    key = "user" if by == "user" else "page_id"
    rows = history.collect()
    got = {(r[key], r.part): (r.edits, r.timestamps, r.others, r.actions) for r in rows}
    assert got == brute_history(revision_data, by, size)
    totals = Counter(r[3] if by == "user" else r[1] for r in revision_data)
    assert all(r.total == totals[r[key]] for r in rows)


@pytest.fixture
def no_broadcasts(spark, monkeypatch):
    """As if every key table were too big for a broadcast."""
    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_history_without_broadcasts(revisions, revision_data, no_broadcasts):
    history = edits.edit_history(revisions, "user", part_edits=60).collect()
    got = {(r.user, r.part): (r.edits, r.timestamps, r.others, r.actions) for r in history}
    assert got == brute_history(revision_data, "user", 60)


def test_hot_key_is_spread_before_it_is_packed(spark, revisions, no_broadcasts):
    """Too many busy keys for a broadcast: rows meet them by key and share, and only then by key."""
    plan = edits.edit_history(revisions, "user", part_edits=60)._jdf.queryExecution().executedPlan().toString()
    quiet = plan[: plan.index("Filter isnotnull(busy")] if "Filter isnotnull(busy" in plan else plan
    assert re.search(r"Exchange hashpartitioning\(coalesce\(user#\d+, \), isnull\(user#\d+\), _share#\d+", plan)
    assert re.search(r"ObjectHashAggregate.*\n.*Exchange hashpartitioning\(user#\d+, \d+\)", quiet)


def test_busy_keys_are_not_broadcast_by_the_size_of_their_files(revisions, revision_data, monkeypatch):
    """Beyond the row count, Spark's own threshold for files does not broadcast them after all."""
    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    history = edits.edit_history(revisions, "user", part_edits=60)
    joins = re.findall(r"BroadcastHashJoin.*", history._jdf.queryExecution().executedPlan().toString())
    assert all("_block" in j for j in joins)  # one row per partition
    got = {(r.user, r.part): (r.edits, r.timestamps, r.others, r.actions) for r in history.collect()}
    assert got == brute_history(revision_data, "user", 60)


def revisions_of(*per_page):
    """Page ``i`` has ``per_page[i]`` edits, two each second, some of them tagged."""
    return [
        (1000 * page + i, page, "fixed" if i % 7 == 3 else "" if i % 2 else "moved", f"u{i % 5}", f"20070101{i // 2:06d}")
        for page, n in enumerate(per_page)
        for i in range(n)
    ]


def test_keys_of_a_few_parts_are_packed_and_cut(spark):
    """No key is joined or numbered unless it has more parts than a task packs at once."""
    data = revisions_of(1, 3, 4, 6, 7, 3 * edits.PACKED_PARTS)
    history = edits.edit_history(spark.createDataFrame(data[::-1], REVISION).repartition(4), "page", part_edits=3)
    assert "Join" not in history._jdf.queryExecution().executedPlan().toString()
    got = {(r.page_id, r.part): (r.edits, r.timestamps, r.others, r.actions) for r in history.collect()}
    assert got == brute_history(data, "page", 3)
    assert Counter(r[0] for r in got) == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3, 5: edits.PACKED_PARTS}


@pytest.mark.parametrize("packed", [50_000, 5, 2])
def test_a_key_of_more_parts_is_numbered(spark, monkeypatch, packed):
    """Also one whose parts have more edits than a task packs, however few they are."""
    monkeypatch.setattr(edits, "PART_EDITS", packed)
    data = revisions_of(2, 3 * edits.PACKED_PARTS + 1, 5, 6, 3 * edits.PACKED_PARTS)
    history = edits.edit_history(spark.createDataFrame(data[::-1], REVISION).repartition(4), "page", part_edits=3)
    assert "Join" in history._jdf.queryExecution().executedPlan().toString()
    rows = history.collect()
    got = {(r.page_id, r.part): (r.edits, r.timestamps, r.others, r.actions) for r in rows}
    assert got == brute_history(data, "page", 3) and len(rows) == len(got)
    totals = Counter(r[1] for r in data)
    assert all(r.total == totals[r.page_id] for r in rows)


def test_null_key_has_a_history(spark):
    data = [(i, None if i % 2 else 1, "u", f"2007010100{i:04d}", None) for i in range(50)]
    df = spark.createDataFrame(data, "rev_id bigint, page_id bigint, user string, ts string, comment string")
    for size in (10, 1000):
        got = Counter()
        for r in edits.edit_history(df, part_edits=size).collect():
            assert r.edits <= size and r.total == 25
            got[r.page_id] += r.edits
        assert got == {None: 25, 1: 25}


def test_rank_without_broadcasts(spark, no_broadcasts):
    df = spark.createDataFrame(hub_edges(), "src bigint, dst bigint")
    assert_ranks(ranking.page_rank(df, 3, spread_links=100), brute_rank(hub_edges(), [], 3))


@pytest.mark.parametrize("partitions", ["1", "5", "64"])
def test_results_do_not_depend_on_partitions(spark, revisions, revision_data, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        history = edits.edit_history(revisions, "page", part_edits=50).collect()
        df = spark.createDataFrame(hub_edges(), "src bigint, dst bigint")
        assert_ranks(ranking.page_rank(df, 2, spread_links=100), brute_rank(hub_edges(), [], 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {(r.page_id, r.part): (r.edits, r.timestamps, r.others, r.actions) for r in history}
    assert got == brute_history(revision_data, "page", 50)


def test_counts_agree_between_views(revisions, revision_data):
    per_user = dict(rows(edits.edit_counts(revisions, "user")))
    per_page = dict(rows(edits.edit_counts(revisions, "page")))
    assert per_user == Counter(r[3] for r in revision_data)
    assert sum(per_user.values()) == sum(per_page.values()) == len(revision_data)


def test_log_is_sorted_and_whole(revisions, revision_data):
    log = [(r.user, r.ts, r.rev_id) for r in edits.edit_log(revisions, "user").collect()]
    assert log == sorted((r[3], r[4], r[0]) for r in revision_data)


def test_actions(spark):
    data = [
        (1, 5, "fix it", "a", "1"),
        (2, 5, "", "a", "2"),
        (3, 6, "added", "b", "3"),
        (4, 6, "moved", "b", "3"),
        (5, 7, "  ", "c", "4"),
    ]
    df = spark.createDataFrame(data, REVISION)
    assert rows(edits.last_actions(df)) == [(5, ["fix"]), (6, ["mov"]), (7, [])]
    assert rows(edits.all_actions(df)) == [(5, ["fix"]), (6, ["add", "mov"]), (7, [])]
    assert rows(edits.edit_history(df).select("page_id", "actions")) == rows(edits.last_actions(df))


def test_sort(revisions):
    by_edits = edits.sort_edits(edits.edit_counts(revisions, "user"), "user", "edits").collect()
    assert [(r.edits, r.user) for r in by_edits] == sorted((r.edits, r.user) for r in by_edits)
    by_key = edits.sort_edits(edits.edit_counts(revisions, "page"), "page", "key").collect()
    assert [r.page_id for r in by_key] == sorted(r.page_id for r in by_key)
    history = edits.edit_history(revisions, "user", part_edits=50)
    parts = [(r.user, r.part) for r in edits.sort_edits(history, "user", "edits").collect()]
    totals = Counter()
    for r in history.collect():
        totals[r.user] += r.edits
    assert parts == sorted(parts, key=lambda p: (totals[p[0]], p))
    for bad in (("word", None), ("user", "id")):
        with pytest.raises(ValueError):
            edits.sort_edits(history, *bad)


# --- numbering ---------------------------------------------------------------------


@pytest.mark.parametrize("partitions", ["1", "3", "50"])
def test_number_rows(spark, partitions):
    names = [f"n{(i * 7919) % 4001:05d}" for i in range(4001)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(n,) for n in names], "name string")
        got = number_rows(df, ["name"], "no").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r.name: r.no for r in got} == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_number_rows_spreads_equal_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("x"))
    got = number_rows(df.withColumn("id", F.spark_partition_id()), ["x"], "no")
    assert sorted(r.no for r in got.select("no").collect()) == list(range(1, 9001))
    same = got.where("x = 'same'").agg(F.min("no"), F.max("no")).first()
    assert tuple(same) == (3001, 9000)


# --- balance -----------------------------------------------------------------------


def test_title_edits_and_balance(spark):
    titles = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "a"), (5, "")], "page_id bigint, title string")
    found = spark.createDataFrame([(1, 1), (3, 3), (3, 2), (99, 4), (5, 6)], "page_id bigint, edits bigint")
    titled = balance.title_edits(titles, found)
    assert rows(titled) == [(1, "a", 1), (2, "b", 0), (3, "c", 5), (4, "a", 0), (5, "", 6), (99, "", 4)]
    accesses = spark.createDataFrame(
        [("a", 6), ("a", 4), ("c", 4), ("b", 0), ("zz", 7), ("", 3)], "title string, accesses bigint"
    )
    assert rows(balance.balance(titled, accesses)) == [
        ("", 0.0, 0, 3),
        ("a", 0.1, 1, 10),
        ("b", None, 0, 0),
        ("c", 1.25, 5, 4),
        ("zz", 0.0, 0, 7),
    ]
    spaced = spark.createDataFrame([(" a", 6), ("a ", 4), ("c\t", 4), ("b", 0), ("zz", 7), (" ", 3)], accesses.schema)
    assert rows(balance.balance(titled, spaced)) == rows(balance.balance(titled, accesses))
    names = spark.createDataFrame([(1, "b  b", 2), (2, " b b", 1)], "page_id bigint, title string, edits bigint")
    seen = spark.createDataFrame([("b   b", 3), ("b b", 1)], accesses.schema)
    assert rows(balance.balance(names, seen)) == [("b b", 0.75, 3, 4)]
    assert rows(balance.edit_view_balance(titles, found, accesses)) == rows(balance.balance(titled, accesses))


def test_lookups(spark):
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(1, 13)], "page_id bigint, title string")
    ranks = spark.createDataFrame([(str(i), i / 10) for i in range(1, 12)], "id string, rank double")
    assert rows(balance.page_names(titles, 10)) == [(10, "t10")]
    assert rows(balance.rank_names(ranks, titles, 10)) == [(10, "t10", 1.0)]
    assert balance.rank_names(ranks, titles).count() == 11


# --- ranking -----------------------------------------------------------------------


def brute_rank(edges, pages, runs, start=None):
    ids = {p for e in edges for p in e} | set(pages)
    degree = Counter(s for s, _ in edges)
    rank = {i: (start or {}).get(i, 1.0) for i in ids}
    for _ in range(runs):
        received = Counter()
        for s, d in edges:
            received[d] += rank[s] / degree[s]
        rank = {i: 0.15 + 0.85 * received[i] for i in ids}
    return rank


def assert_ranks(got, want):
    got = {r.id: r.rank for r in got.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


SMALL = [("2", "1"), ("3", "1"), ("3", "4"), ("r1", "r2"), ("r1", "r2"), ("r1", "3"), ("3", "3")]


@pytest.mark.parametrize("runs", [1, 2, 6])
def test_rank_small(spark, runs):
    edges = spark.createDataFrame(SMALL, "src string, dst string")
    pages = spark.createDataFrame([("1",), ("alone",)], "id string")
    got = ranking.page_rank(edges, runs, pages, save_every=2)
    assert_ranks(got, brute_rank(SMALL, ["1", "alone"], runs))
    assert {r.id: r.rank for r in got.collect()}["alone"] == 0.15


def hub_edges():
    """One source and one target hold a third of all links each."""
    rng = random.Random(3)
    edges = [(0, rng.randrange(300)) for _ in range(1000)]
    edges += [(rng.randrange(300), 1) for _ in range(1000)]
    return edges + [(rng.randrange(300), rng.randrange(300)) for _ in range(1000)]


@pytest.mark.parametrize("spread_links", [5, 100, 100_000])
def test_rank_hubs(spark, spread_links):
    edges = hub_edges()
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    assert_ranks(ranking.page_rank(df, 4, spread_links=spread_links), brute_rank(edges, [], 4))


@pytest.mark.parametrize("links", [1, 50, 1500])
def test_rank_on_few_or_all_partitions(spark, monkeypatch, links):
    monkeypatch.setattr(ranking, "PARTITION_LINKS", links)
    df = spark.createDataFrame(hub_edges(), "src bigint, dst bigint")
    assert_ranks(ranking.page_rank(df, 2), brute_rank(hub_edges(), [], 2))


def test_hub_is_spread(spark):
    graph = ranking.build_graph(spark.createDataFrame(hub_edges(), "src bigint, dst bigint"), spread_links=100)
    biggest = graph.edges.groupBy("src", "salt").count().agg(F.max("count")).first()[0]
    graph.release()
    assert biggest < 100


def test_rank_resumes_and_saves(spark):
    edges = spark.createDataFrame(SMALL, "src string, dst string")
    saved = {}
    final = ranking.page_rank(edges, 4, save=lambda i, r: saved.update({i: r.collect()}))
    assert sorted(saved) == [1, 2, 3, 4]
    half = spark.createDataFrame(saved[2], "id string, rank double")
    assert_ranks(half, brute_rank(SMALL, [], 2))
    resumed = ranking.page_rank(edges, 2, start=half)
    assert_ranks(resumed, {r.id: r.rank for r in final.collect()})
    with pytest.raises(ValueError):
        ranking.page_rank(edges, 0)


@pytest.mark.parametrize("spread_links,rank_shuffles", [(100_000, 0), (100, 1)])
def test_step_leaves_the_edges_in_place(spark, spread_links, rank_shuffles):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.createDataFrame(hub_edges(), "src bigint, dst bigint")
    graph = ranking.build_graph(df, spread_links=spread_links, partitions=8)
    try:
        step = ranking.rank_step(graph, ranking.rank_step(graph, ranking.first_ranks(graph)))
        plan = step._jdf.queryExecution().executedPlan().toString()
        by_target = re.findall(r"Exchange hashpartitioning\((?:dst|id)#\d+L, 8\), ENSURE", plan)
        by_source = re.findall(r"Exchange hashpartitioning\(src#\d+L(?:, salt#\d+)?, 8\), ENSURE", plan)
        assert (len(by_target), len(by_source)) == (2, 2 * rank_shuffles)
        # Each of the two steps reads the saved buckets of the links, neither dealt nor sorted.
        assert len(re.findall(r"Scan parquet spark_catalog\S*pagemill_\w+\[src.*Bucketed: true", plan)) == 2
        assert "+- Sort [" not in plan and "InMemoryTableScan" not in plan, plan
    finally:
        graph.release()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
