import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from pagemill import sources
from pagemill.functions import codec
from pagemill.operators import counts, edits, ranking
from pagemill.sources import sinks


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_traffic_files_plain_and_gzip(spark, tmp_path):
    (tmp_path / "pagecounts-20100101-000000").write_text("en Main_Page 3 100\nde Main_Page 4 7\nen A%20 1\n")
    with gzip.open(tmp_path / "pagecounts-20100103-010000.gz", "wt") as f:
        f.write("en Main_Page 11 9\nen  5 9\n")
    rows = sources.read_pagecounts(spark, str(tmp_path))
    assert rows.columns == ["project", "title", "views", "bytes", "day", "file"]
    got = {(r.project, r.title, r.views, r.bytes, r.day) for r in rows.collect()}
    assert got == {
        ("en", "Main_Page", 3, 100, date(2010, 1, 1)),
        ("de", "Main_Page", 4, 7, date(2010, 1, 1)),
        ("en", "A%20", 1, None, date(2010, 1, 1)),
        ("en", "Main_Page", 11, 9, date(2010, 1, 3)),
        ("en", "", 5, 9, date(2010, 1, 3)),
    }
    assert {r.file for r in rows.select("file").distinct().collect()} == {
        "pagecounts-20100101-000000",
        "pagecounts-20100103-010000.gz",
    }
    totals = {r.title: r.accesses for r in counts.access_count(rows).collect()}
    assert totals == {"Main_Page": 18, "A%20": 1, "": 5}


@pytest.mark.parametrize("line,message", [("en A x 5", "bad number"), ("en A", "no field 'views'"), ("en", "no field")])
def test_traffic_failfast(spark, line, message):
    with pytest.raises(Exception, match=message):
        sources.parse_pagecounts(lines(spark, "en B 1 1", line)).collect()


def test_traffic_reject_keeps_every_line(spark, tmp_path):
    (tmp_path / "pagecounts-20100101-0").write_text("en A 1 1\nen B\nen C x 1\n\n")
    (tmp_path / "oddly-named").write_text("en D 1 1\n")
    good, bad = sources.read_pagecounts(spark, str(tmp_path), mode="reject")
    assert [r.title for r in good.collect()] == ["A"]
    assert {(r.value, r.reason) for r in bad.collect()} == {
        ("en B", "too few fields"),
        ("", "too few fields"),
        ("en C x 1", "views is not a number"),
        ("en D 1 1", "no date in file name"),
    }


def test_unknown_mode(spark):
    for parse in (sources.parse_pagecounts, sources.parse_revisions):
        with pytest.raises(ValueError):
            parse(lines(spark, "x"), mode="skip")


REVISIONS = [
    "11  7   11   Reverted   bad edit 5  Ann  20070525171206  1  0  NULL  NULL ",
    "12  7   12   5  Bob  20070525171207  0  0  NULL  NULL",
    "13\t8\t13\tnew page\t6\tAnn Lee\t20070525171208\t0\t0\tNULL\tNULL",
]


def test_revisions(spark, tmp_path):
    (tmp_path / "revisions.txt").write_text("\n".join([REVISIONS[0], "", "   ", *REVISIONS[1:]]) + "\n")
    rows = sources.read_revisions(spark, str(tmp_path)).orderBy("rev_id").collect()
    assert [tuple(r) for r in rows] == [
        (11, 7, 11, "Reverted bad edit", 5, "Ann", "20070525171206", 1),
        (12, 7, 12, "", 5, "Bob", "20070525171207", 0),
        # of a name with spaces only the last word is the user; the rest shifts forward
        (13, 8, 13, "new page 6", None, "Lee", "20070525171208", 0),
    ]


def test_revisions_failfast_and_reject(spark):
    short, no_page = "11 7 11 Ann", "11 x 11 c 5 Ann 20070525171206 1 0 NULL NULL"
    for bad, field, message in ((short, "user", "too few fields in"), (no_page, "page_id", "bad number in 'page_id'")):
        with pytest.raises(Exception, match=message):
            sources.parse_revisions(lines(spark, bad)).select(field).collect()
    good, rejected = sources.parse_revisions(lines(spark, REVISIONS[0], short, no_page), mode="reject")
    assert [r.rev_id for r in good.collect()] == [11]
    assert {tuple(r) for r in rejected.collect()} == {
        (short, "too few fields"),
        (no_page, "page or revision id is not a number"),
    }


def test_links(spark, tmp_path):
    (tmp_path / "links.txt").write_text("1:\n2: 1\n\n3: 1 4 \nr5:  r6 3 3\n")
    links = sources.read_links(spark, str(tmp_path))
    assert {(r.src, tuple(r.links)) for r in links.collect()} == {
        ("1", ()),
        ("2", ("1",)),
        ("3", ("1", "4")),
        ("r5", ("r6", "3", "3")),
    }
    edges, pages = sources.explode_links(links)
    assert {tuple(r) for r in ranking.out_degree(edges, pages).collect()} == {
        ("1", 0),
        ("2", 1),
        ("3", 2),
        ("4", 0),
        ("r5", 3),
        ("r6", 0),
    }


def test_titles_keep_line_numbers(spark, tmp_path):
    (tmp_path / "titles.txt").write_text("b\n\n  a \t x \n")
    rows = sources.read_titles(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [tuple(r) for r in rows] == [(1, "b"), (2, ""), (3, "a x")]


def test_titles_of_many_blocks_and_files(spark, tmp_path):
    wanted = [f"title {i} " + "x" * (i % 37) for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(wanted[:3000]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(wanted[3000:3001]) + "\n")
    (tmp_path / "c.txt").write_text("\n".join(wanted[3001:]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        assert sources.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        rows = sources.read_titles(spark, str(tmp_path)).collect()
        some = [sources.read_title(spark, str(tmp_path), i).collect() for i in (1, 2999, 3000, 3001, 3002, 5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.page_id: r.title for r in rows} == {i + 1: t.strip() for i, t in enumerate(wanted)}
    assert [tuple(r) for rows in some for r in rows] == [(i, wanted[i - 1].strip()) for i in (1, 2999, 3000, 3001, 3002, 5000)]


def test_read_back(spark, tmp_path):
    (tmp_path / "history").write_text("7\t2!@#1 2!@#a b!@#edit fix\n8\t1!@#3!@#c!@#\n")
    assert {tuple(r) for r in sources.read_edit_counts(spark, str(tmp_path / "history")).collect()} == {(7, 2), (8, 1)}
    (tmp_path / "accesses").write_text("a\t3\nb c\t4\n")
    assert {tuple(r) for r in sources.read_access_counts(spark, str(tmp_path / "accesses")).collect()} == {
        ("a", 3),
        ("b c", 4),
    }
    (tmp_path / "bad").write_text("a 3\n")
    with pytest.raises(Exception, match="no field 'accesses'"):
        sources.read_access_counts(spark, str(tmp_path / "bad")).collect()


def test_ranks_round_trip(spark):
    links = sources.parse_links(lines(spark, "1:", "2: 1 1 1 1 1", "3: 1 4", "4: 4"))
    edges, pages = sources.explode_links(links)
    ranks = ranking.page_rank(edges, 2, pages)
    degrees = ranking.out_degree(edges, pages)
    for line_links in (2, 10_000):
        lists = sinks.link_lists(ranking.merge_edges(edges), degrees, line_links)
        assert lists.select(F.max(F.size("links"))).first()[0] <= max(2 * line_links, 5)
        saved = sinks.rank_lines(ranks, lists)
        start, again = sources.parse_ranks(saved)
        assert sorted(map(tuple, start.collect())) == sorted(map(tuple, ranks.collect()))
        back, _ = sources.explode_links(again)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, edges.collect()))
    assert "3:\tr0.15  1 4 " in {r.value for r in saved.collect()}
    assert "1:\tr" in {r.value[:4] for r in saved.collect()}


def test_ranks_need_a_rank(spark):
    with pytest.raises(Exception, match="no rank in"):
        sources.parse_ranks(lines(spark, "1: 2 3"))[0].collect()


def test_number_of_files(spark, tmp_path):
    rows = spark.range(100).repartition(4).selectExpr("id as page_id", "100 - id as edits")
    for files in (1, 3):
        ordered = edits.sort_edits(rows, "page", "edits", files=files)
        sinks.write_lines(sinks.key_value_lines(ordered, "page_id", "edits"), str(tmp_path / f"sorted{files}"))
        parts = sorted((tmp_path / f"sorted{files}").glob("part-*"))
        assert len(parts) == files
        assert [int(l.split()[1]) for p in parts for l in p.read_text().splitlines()] == list(range(1, 101))
    sinks.write_lines(sinks.key_value_lines(rows, "page_id", "edits"), str(tmp_path / "dealt"), files=2)
    assert len(list((tmp_path / "dealt").glob("part-*"))) == 2


@pytest.mark.parametrize(
    "text,value",
    [
        ("9000000000000000000", 9 * 10**18),
        ("-9223372036854775808", -(2**63)),
        ("+9223372036854775807", 2**63 - 1),
        ("0" * 30 + "7", 7),
        ("9223372036854775808", None),
        ("1" * 40, None),
        ("1.0", None),
        (" 1", None),
        ("1e3", None),
    ],
)
def test_numbers_of_any_length(spark, text, value):
    good, bad = sources.parse_pagecounts(lines(spark, f"en\tA {text} {text}".replace("\t", " ")), mode="reject")
    if " " in text:  # an empty field of views
        assert [r.reason for r in bad.collect()] == ["views is not a number"]
    elif value is None:
        assert good.collect() == [] and [r.reason for r in bad.collect()] == ["views is not a number"]
        with pytest.raises(Exception, match="bad number"):
            sources.parse_pagecounts(lines(spark, f"en A {text} 1")).collect()
        assert sources.parse_pagecounts(lines(spark, f"en A 1 {text}")).first().bytes is None
    else:
        assert [(r.views, r.bytes) for r in good.collect()] == [(value, value)] and bad.collect() == []


def test_rank_text_of_any_length(spark):
    start, _ = sources.parse_ranks(lines(spark, f"1:\tr0.{'3' * 100} 2", f"2:\tr{'0' * 90}5.5"))
    assert {(r.id, r.rank) for r in start.collect()} == {("1", float("0." + "3" * 100)), ("2", 5.5)}


@pytest.mark.parametrize("line", ["11 7 11 Ann", "xx 8", "11 x 3 c 5 Ann 20070101000001 0 0 NULL NULL"])
def test_a_bad_record_fails_whatever_is_used(spark, line):
    records = sources.parse_revisions(lines(spark, "1 7 1 c 5 Ann 20070101000001 0 0 NULL NULL", line))
    uses = [edits.edit_counts(records), edits.edit_counts(records, "user"), edits.all_actions(records), edits.edit_log(records)]
    for use in [*uses, *(records.select(c) for c in records.columns)]:
        with pytest.raises(Exception, match="too few fields|bad number"):
            use.collect()


def test_day_bounds_open_only_their_files(spark, tmp_path):
    for day in range(1, 10):
        if day in (3, 4):
            (tmp_path / f"pagecounts-2010010{day}-000000").write_text(f"en A {day} 1\n")
        else:  # whoever opens it fails
            (tmp_path / f"pagecounts-2010010{day}-000000.gz").write_bytes(b"no gzip")
    found = sources.read_pagecounts(spark, str(tmp_path), first_day=date(2010, 1, 3), last_day=date(2010, 1, 4))
    assert sorted(r.views for r in found.collect()) == [3, 4]
    with pytest.raises(Exception):
        sources.read_pagecounts(spark, str(tmp_path), first_day=date(2010, 1, 3)).collect()


def test_part_files_follow_by_number(spark, tmp_path):
    names = {"part-99999": "a\nb\n", "part-100000": "c\n", "part-20000-x.txt": "d\n"}
    for name, text in names.items():
        (tmp_path / name).write_text(text)
    rows = sources.read_titles(spark, str(tmp_path)).collect()
    assert {r.page_id: r.title for r in rows} == {1: "d", 2: "a", 3: "b", 4: "c"}
    for i, title in {1: "d", 3: "b", 4: "c"}.items():
        assert [tuple(r) for r in sources.read_title(spark, str(tmp_path), i).collect()] == [(i, title)]
    assert sources.read_title(spark, str(tmp_path), 5).collect() == []


def test_history_round_trip(spark):
    rows = [(i, 7 if i % 3 else 8, f"2007010100{i:04d}", f"u{i % 5}", "fixed" if i == 3 else None) for i in range(100)]
    revisions = spark.createDataFrame(rows, "rev_id bigint, page_id bigint, ts string, user string, comment string")
    for by in ("page", "user"):
        for size in (1, 20, 1000):
            history = edits.edit_history(revisions, by, part_edits=size)
            saved = sinks.history_lines(history, by)
            back = sources.parse_history(saved, by)
            assert back.columns == history.columns
            assert sorted(map(str, back.collect())) == sorted(map(str, history.collect()))
            if by == "page":
                counts = {tuple(r) for r in sources.parse_edit_counts(saved).collect()}
                assert counts == {(7, 66), (8, 34)}
                assert all(int(r.value.split("\t")[1].split("!@#")[0]) in (66, 34) for r in saved.collect())


def test_hot_day_is_several_files(spark, tmp_path):
    days = F.when(F.col("id") < 900, F.lit("2010-01-01")).otherwise(F.lit("2010-01-02")).cast("date")
    records = spark.range(1000).select(
        F.lit("en").alias("project"), F.lit("Hot").alias("title"), F.lit(1).alias("views"), F.lit(0).alias("bytes"), days.alias("day")
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a test's shares are tiny
    try:
        sinks.write_pagecounts(records, str(tmp_path / "traffic"), file_records=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted(f.name for f in (tmp_path / "traffic").iterdir() if f.suffix == ".gz")
    assert sum(f.startswith("pagecounts-20100101-") for f in files) > 2
    found = sources.read_pagecounts(spark, str(tmp_path / "traffic")).groupBy("day").count().collect()
    assert {(r.day, r["count"]) for r in found} == {(date(2010, 1, 1), 900), (date(2010, 1, 2), 100)}


def undated_files(tmp_path):
    for name, text in {
        "pagecounts-20100101-000000": "en A 1 1\n",
        "pagecounts-20100105-000000": "en A 2 1\nen B x 1\n",
        "pagecounts-20100109-000000": "en A 4 1\n",
        "pagecounts-undated1-x": "en A 8 1\nen C 9 1\n",
    }.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("first, last", [(None, None), (3, None), (None, 6), (3, 6)])
def test_undated_files_are_never_out_of_bounds(spark, tmp_path, first, last):
    path = undated_files(tmp_path)
    bounds = {
        "first_day": first and date(2010, 1, first),
        "last_day": last and date(2010, 1, last),
    }
    with pytest.raises(ValueError, match="no date in file name: pagecounts-undated1-x"):
        sources.read_pagecounts(spark, path, **bounds)
    good, bad = sources.read_pagecounts(spark, path, mode="reject", **bounds)
    wanted = {(d, v) for d, v in ((1, 1), (5, 2), (9, 4)) if d >= (first or 1) and d <= (last or 9)}
    assert {(r.day.day, r.views) for r in good.collect()} == wanted
    undated = {("en A 8 1", "no date in file name"), ("en C 9 1", "no date in file name")}
    assert {tuple(r) for r in bad.collect()} == undated | {("en B x 1", "views is not a number")}


def test_manifest_of_traffic_files(spark, tmp_path):
    path = undated_files(tmp_path)
    found = sources.traffic_manifest(spark, path, date(2010, 1, 3), date(2010, 1, 6))
    assert {(r.name, r.size, r.day and r.day.day, r.place) for r in found.collect()} == {
        ("pagecounts-20100101-000000", 9, 1, "early"),
        ("pagecounts-20100105-000000", 18, 5, "in"),
        ("pagecounts-20100109-000000", 9, 9, "late"),
        ("pagecounts-undated1-x", 18, None, "undated"),
    }
    assert {r.place for r in sources.traffic_manifest(spark, path).collect()} == {"in", "undated"}


def test_manifest_opens_no_file(spark, tmp_path):
    (tmp_path / "pagecounts-20100101-0.gz").write_bytes(b"no gzip")
    files = sources.list_files(spark, str(tmp_path))
    assert [(r.name, r.size) for r in files.collect()] == [("pagecounts-20100101-0.gz", 7)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_days_are_written_by_tasks(spark, tmp_path):
    """Files named by day, at most ``file_records`` records each, and nothing staged beside them."""
    days = F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") % 3).cast("int"))
    records = spark.range(1000).select(
        F.lit("en").alias("project"), F.col("id").cast("string").alias("title"), F.lit(1).alias("views"), F.lit(0).alias("bytes"), days.alias("day")
    )
    sinks.write_pagecounts(records, str(tmp_path / "traffic"), file_records=100)
    assert [f.name for f in tmp_path.iterdir()] == ["traffic"]
    names = sorted(f.name for f in (tmp_path / "traffic").iterdir() if f.name.endswith(".gz"))
    assert len(names) >= 12 and {n[:20] for n in names} == {f"pagecounts-2010010{d}-" for d in (1, 2, 3)}
    for f in (tmp_path / "traffic").glob("*.gz"):
        with gzip.open(f, "rt") as lines_of:
            assert len(lines_of.readlines()) <= 100
    back = sources.read_pagecounts(spark, str(tmp_path / "traffic"))
    assert sorted((int(r.title), r.day) for r in back.collect()) == sorted((int(r.title), r.day) for r in records.collect())


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_merged_file_has_the_bytes_of_its_parts(spark, tmp_path, rows, monkeypatch):
    ordered = spark.range(rows, numPartitions=7).selectExpr("concat('line ', id) as value")
    sinks.write_merged(ordered, str(tmp_path / "one.txt"))
    assert (tmp_path / "one.txt").read_text() == "".join(f"line {i}\n" for i in range(rows))
    assert {f.name for f in tmp_path.iterdir()} <= {"one.txt", ".one.txt.crc"}
    with pytest.raises(FileExistsError):
        sinks.write_merged(ordered, str(tmp_path / "one.txt"))
    monkeypatch.setattr(sinks, "join_files", lambda *a: False)
    sinks.write_merged(ordered, str(tmp_path / "copied.txt"))
    assert (tmp_path / "copied.txt").read_bytes() == (tmp_path / "one.txt").read_bytes()
    assert [r.value for r in spark.read.text(str(tmp_path / "copied.txt")).collect()] == [f"line {i}" for i in range(rows)]


def test_scopes_of_two_threads_do_not_meet(spark):
    import threading

    from pagemill import lineage

    first, second = threading.Event(), threading.Event()
    kept = {}

    def outer():
        with lineage.scratch(spark):
            df, path = lineage.save_table(spark.range(3))
            first.set()
            second.wait(60)
            kept["rows"] = df.count()

    thread = threading.Thread(target=outer)
    thread.start()
    first.wait(60)
    with lineage.scratch(spark):
        lineage.save_table(spark.range(2))
    second.set()
    thread.join()
    assert kept["rows"] == 3


NAMES = ["Ann", "Ann B", "x!@#y", "!@#", " ", "", None, "\\", "\\s", "a\\ b", "tab\there", "line\nbreak\r", "!", "!@", "a!", "\\0", "\\e", "\\x@#", "ü  \u2028"]


def test_names_survive_their_text(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    for escape in (codec.escape_key, codec.escape_item):
        rows = df.select("name", escape(F.col("name")).alias("text")).withColumn("back", codec.unescape(F.col("text"))).collect()
        assert [r.back for r in rows] == NAMES and len({r.text for r in rows}) == len(NAMES)
        assert not any(c in r.text for r in rows for c in "\t\n\r")
        plain = {r.name: r.text for r in rows}
        assert plain["Ann"] == "Ann" and plain["!"] == "!" and plain["ü  \u2028"].startswith("ü")
    assert all(" " not in r.text and "!@#" not in r.text for r in rows)


def test_history_of_names_with_separators(spark, tmp_path):
    rows = [(i, i % 3, f"2007010100{i:04d}", NAMES[i % len(NAMES)], "fixed" if i == 3 else None) for i in range(60)]
    rows += [(100 + i, None, "20080101000000", "nobody's page", None) for i in range(2)]
    revisions = spark.createDataFrame(rows, "rev_id bigint, page_id bigint, ts string, user string, comment string")
    for by in ("page", "user"):
        for size in (4, 1000):
            history = edits.edit_history(revisions, by, part_edits=size)
            path = str(tmp_path / f"{by}{size}")
            sinks.write_lines(sinks.history_lines(history, by), path)
            back = sources.read_history(spark, path, by)
            assert sorted(map(str, back.collect())) == sorted(map(str, history.collect()))
