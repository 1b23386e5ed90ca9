"""What the plans read, push down and shuffle."""

import re

import pytest

from pagemill.plans import catalog

SF_DIR = "/root/testdata/sf0.01"


def plan(spark, name):
    return catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name,columns",
    [
        ("access_count", "value:double,props:string"),
        ("access_count_by_project", "event_type:string,value:double,props:string"),
        ("trend_sparse", "ts:timestamp_ntz,value:double,props:string"),
        ("word_count", "text:string"),
        ("out_degree", "l_orderkey:bigint,l_partkey:bigint"),
        ("action_tags", "doc_id:bigint,text:string"),
    ],
)
def test_scans_read_only_their_columns(spark, name, columns):
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)))
    assert schemas == {columns}


def test_series_are_listed_for_hot_titles_only(spark):
    """One shuffle by title; the filter by peak lies below the aggregate that makes the lists."""
    text = plan(spark, "trend_sparse")
    lists, rest = text.split("collect_list", 1)[0], text.split("collect_list", 1)[1]
    assert re.search(r"Filter \(isnotnull\(_peak#\d+L\) AND \(_peak#\d+L > 600\)\)", rest) and "Filter" not in lists
    assert rest.index("Filter") < rest.index("Window") < rest.index("Exchange hashpartitioning(title")
    assert len(re.findall(r"Exchange hashpartitioning\(title#\d+, \d+\)", text)) == 1


def test_project_filter_reaches_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(spark, "access_count_one_project")


def test_top_pages_is_no_global_sort(spark):
    text = plan(spark, "top_pages")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name,shuffles", [("access_count", 1), ("daily_counts", 1), ("trend_sparse", 2), ("out_degree", 1)])
def test_sums_are_partial_before_the_shuffle(spark, name, shuffles):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == shuffles
    assert "partial_sum" in text


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert not re.search(r"Python|ArrowEval|MapIn|CartesianProduct|BroadcastNestedLoop", text)


def source_scans(plan):
    return len(re.findall(r"Scan text", plan))


def test_rank_job_parses_its_source_once(spark, tmp_path, monkeypatch):
    """Every job of the run is planned; only the first save reads text."""
    from pagemill import lineage
    from pagemill.plans import jobs

    (tmp_path / "links.txt").write_text("1:\n2: 1\n3: 1 4\n4:\n")
    scans, save = [], lineage.save_table

    def counting(df):
        scans.append(source_scans(df._jdf.queryExecution().executedPlan().toString()))
        return save(df)

    monkeypatch.setattr(lineage, "save_table", counting)
    monkeypatch.setattr("pagemill.operators.ranking.save_table", counting)
    for target, options in (("a", {}), ("b", {"save": "last"})):
        scans.clear()
        jobs.page_rank(spark, str(tmp_path / "links.txt"), str(tmp_path / target), 3, **options)
        assert scans[0] == 1 and sum(scans) == 1 and len(scans) > 3


def test_no_single_task_above_the_packing(spark, tmp_path, monkeypatch):
    """Not even for a single file, which is joined of the parts in their order."""
    from pagemill.plans import jobs
    from pagemill.sources import sinks

    edits = "".join(f"{i} {i % 40} {i} Fixed typo 5 Ann 2007010100{i:04d} 0 0 NULL NULL\n" for i in range(200))
    (tmp_path / "in.txt").write_text(edits)
    plans, write = [], sinks.write_merged

    def noting(lines, target):
        plans.append(lines._jdf.queryExecution().executedPlan().toString())
        write(lines, target)

    monkeypatch.setattr(sinks, "write_merged", noting)
    for sort in ("no", "id", "edits"):
        jobs.page_edits(spark, str(tmp_path / "in.txt"), str(tmp_path / sort), "page", sort, files=1)
        assert [f.name for f in (tmp_path / sort).iterdir() if not f.name.startswith(".")] == ["part-00000"]
    assert len(plans) == 3 and not any(re.search(r"Coalesce|SinglePartition|Partitioning\(1\)", p) for p in plans)
    keys = [int(line.split("\t")[0]) for line in (tmp_path / "id" / "part-00000").read_text().splitlines()]
    assert keys == sorted(keys) and len(keys) == 40
    with pytest.raises(FileExistsError):
        jobs.page_edits(spark, str(tmp_path / "in.txt"), str(tmp_path / "id"), "page", "id", files=1)


def test_balance_from_text_sends_no_keys_through_the_driver(spark, tmp_path, monkeypatch):
    """Customers with more orders than a part, and more of them than may be broadcast."""
    import duckdb

    from pagemill import lineage
    from pagemill.sources import sinks

    customers = [(i, f"Customer#{i:09d}") for i in range(30)]
    orders = [i % 12 for i in range(300)] + [12] * 170 + [13] * 161 + [14] * 160 + [15]
    events = [(i, i % 25, i % 7 + 0.5) for i in range(200)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    keys = spark.createDataFrame(list(enumerate(orders)), "o_orderkey bigint, o_custkey bigint")
    keys.write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(events, "event_id bigint, user_id bigint, value double").write.parquet(str(tmp_path / "events.parquet"))
    db, plans, write = duckdb.connect(), [], sinks.write_lines
    for t in ("customer", "orders", "events"):
        db.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")

    def noting(lines, path, **options):
        plans.append(lines._jdf.queryExecution().executedPlan().toString())
        write(lines, path, **options)

    monkeypatch.setattr(sinks, "write_lines", noting)
    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    got = [tuple(r) for r in catalog.QUERIES["balance_from_text"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(db.execute(catalog.SQL["balance_from_text"]).fetchall()) and len(got) == 25
    joins = [j for p in plans for j in re.findall(r"\w+Join.*", p)]
    assert any("SortMergeJoin" in j for j in joins)
    # Numbering broadcasts one row per partition.
    assert all("_block" in j for j in joins if "Broadcast" in j)
