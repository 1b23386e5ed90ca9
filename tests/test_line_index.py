"""Lines by number: ranges of bytes, the index, and lookups through it."""

import gzip
import re
import time

import pytest

from pagemill import sources
from pagemill.operators import balance
from pagemill.plans import jobs
from pagemill.sources import line_places as li


@pytest.fixture(params=[("7000", "100"), ("134217728", "4194304"), ("1000000", "1000000")])
def splits(spark, request):
    """Different split settings of the caller's session."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, value in zip(names, request.param):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def lookups(spark, path, ids, **options):
    index = li.settle(spark, lambda: li.line_index(spark, path, **options))
    return [tuple(r) for i in ids for r in li.line_at(spark, index, i).collect()]


def test_every_id_of_large_files(spark, tmp_path, splits):
    """Four files of 13 MB in ranges of 4 MB, and every probed id of them."""
    n, width = 200_000, 64
    for f in range(4):
        (tmp_path / f"t{f}.txt").write_text("".join(f"{f * n + i + 1:010d} {'x' * (width - 12)}\n" for i in range(n)))
    ids = [1, 2, 65_000, 66_000, 199_999, 200_000, 200_001, 250_000, 300_000, 599_999, 600_000, 600_001, 799_999, 800_000]
    found = lookups(spark, str(tmp_path), [*ids, 0, -1, 800_001], range_bytes=4 << 20)
    assert [(i, v[:10]) for i, v in found] == [(i, f"{i:010d}") for i in ids]
    numbered = li.number_lines(spark, str(tmp_path), range_bytes=4 << 20)
    assert numbered.where("cast(left(value, 10) as bigint) != line_no").count() == 0 and numbered.count() == 4 * n


def test_compressed_files_and_any_separator(spark, tmp_path, splits):
    texts = ["a\nb\r\nc\rd\n\n", "e\r\r\nf", "", "\n", "x" * 300_000 + "\n" + "y\r\n" * 5000, "last"]
    want = []
    for i, text in enumerate(texts):
        data = text.encode()
        name = f"part-{i:05d}" + (".gz" if i % 2 else "")
        (tmp_path / name).write_bytes(gzip.compress(data) if i % 2 else data)
        own = re.split("\r\n|\r|\n", text)
        want += own[:-1] if own[-1] == "" else own
    numbered = sorted(tuple(r) for r in li.number_lines(spark, str(tmp_path), range_bytes=9000).collect())
    assert numbered == list(enumerate(want, 1))
    ids = [*range(1, 16), len(want) - 1, len(want)]
    found = lookups(spark, str(tmp_path), [*ids, len(want) + 1], range_bytes=9000, entry_lines=3)
    assert found == [(i, want[i - 1]) for i in ids]


def test_ends_at_the_edges_of_ranges(spark, tmp_path):
    """Lines that start, end or lie across a multiple of the range's size."""
    data = b"".join(b"%d" % (i % 10) * (i % 9) + (b"\r\n" if i % 4 == 0 else b"\n") for i in range(500))
    (tmp_path / "t.txt").write_bytes(data)
    want = data.decode().replace("\r\n", "\n").split("\n")[:-1]
    for size in (7, 64, 10_000):
        assert sorted(map(tuple, li.number_lines(spark, str(tmp_path), range_bytes=size).collect())) == list(enumerate(want, 1))
        ids = range(1, 501, 61)
        assert lookups(spark, str(tmp_path), ids, range_bytes=size, entry_lines=2) == [(i, want[i - 1]) for i in ids]


def test_index_entries_say_where_lines_start(spark, tmp_path):
    data = "".join(f"é {i}\n" for i in range(1000)).encode()
    (tmp_path / "t.txt").write_bytes(data)
    rows = li.line_index(spark, str(tmp_path), range_bytes=1000, entry_lines=10).collect()
    assert sum(r.lines for r in rows) == 1000 and max(r.lines for r in rows) == 10
    for r in rows:
        assert data[r.offset :].startswith(f"é {r.first_line - 1}\n".encode())
        assert data[r.offset : r.offset + r.bytes].count(b"\n") == r.lines


def test_saved_index(spark, tmp_path, monkeypatch):
    folder, index = tmp_path / "titles", str(tmp_path / "index")
    folder.mkdir()
    for f in range(3):
        (folder / f"t{f}.txt").write_text("".join(f"title {f * 3000 + i}  \t x\n" for i in range(3000)))
    jobs.index_titles(spark, str(folder), index)
    monkeypatch.setattr(li, "ranged_lines", None)  # whoever scans lines fails
    for i in (1, 3000, 3001, 9000):
        assert [tuple(r) for r in jobs.page_name(spark, str(folder), i, index).collect()] == [(i, f"title {i - 1} x")]
    assert jobs.page_name(spark, str(folder), 9001, index).collect() == []
    monkeypatch.undo()
    (tmp_path / "ranks").write_text("4500:\tr2.5  1 2 \n7:\tr1.0  \n")
    rows = [tuple(r) for r in jobs.page_info(spark, str(tmp_path / "ranks"), str(folder), 4500, index).collect()]
    assert rows == [(4500, "title 4499 x", 2.5)]
    time.sleep(0.01)
    (folder / "t3.txt").write_text("one more\n")
    with pytest.raises(RuntimeError, match="does not fit the files"):
        jobs.page_name(spark, str(folder), 1, index)


def test_many_bytes_between_entries_are_read_by_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(li, "READ_BYTES", 10)
    (tmp_path / "t.txt").write_text("".join(f"line {i}\n" for i in range(100)))
    assert lookups(spark, str(tmp_path), [1, 50, 100]) == [(1, "line 0"), (50, "line 49"), (100, "line 99")]


def test_numbering_saves_no_lines(spark, tmp_path, monkeypatch):
    """Neither a saved table nor a shuffle of the lines."""
    (tmp_path / "t.txt").write_text("a\nb\n")
    numbered = sources.read_titles(spark, str(tmp_path))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "Exchange hashpartitioning" not in plan
    assert not re.search(r"ReadSchema: struct<[^>]*value", plan.split("Scan text")[0])
    assert all("value" not in schema for schema in re.findall(r"Scan parquet.*?ReadSchema: struct<([^>]*)>", plan))
    assert sorted(map(tuple, numbered.collect())) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(li, "BROADCAST_RANGES", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, sources.read_titles(spark, str(tmp_path)).collect())) == [(1, "a"), (2, "b")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_numbered_lines_belong_to_the_callers_session(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\nb\n")
    titles = sources.read_titles(spark, str(tmp_path))
    assert titles.sparkSession is spark or titles._jdf.sparkSession().equals(spark._jsparkSession)
    edits = spark.createDataFrame([(2, 5)], "page_id bigint, edits bigint")
    assert sorted(map(tuple, balance.title_edits(titles, edits).collect())) == [(1, "a", 0), (2, "b", 5)]
