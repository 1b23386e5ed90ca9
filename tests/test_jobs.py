"""The jobs from files to files, as called from the command line."""

import pathlib

import pytest

from pagemill.__main__ import main
from pagemill.lineage import shared_folder
from pagemill.plans import jobs


def read(path):
    return [l for p in sorted(path.glob("part-*")) for l in p.read_text().splitlines()]


@pytest.fixture
def data(tmp_path):
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "one").write_text("to be or\n")
    (tmp_path / "words" / "two").write_text("not to be\n")
    (tmp_path / "traffic").mkdir()
    (tmp_path / "traffic" / "pagecounts-20100101-000000").write_text("en a 4 1\nde a 3 1\nen b 10 1\n")
    (tmp_path / "traffic" / "pagecounts-20100103-000000").write_text("en a 11 1\nen zz 7 1\n")
    (tmp_path / "revisions.txt").write_text(
        "21 1 21 Fixed typo 5 Ann 20070101000001 0 0 NULL NULL\n"
        "22 2 22 6 Bob 20070101000002 0 0 NULL NULL\n"
        "23 1 23 6 Bob 20070101000003 0 0 NULL NULL\n"
        "24 1 24 bad dog 6 Bob 20070101000004 0 0 NULL NULL\n"
    )
    (tmp_path / "titles.txt").write_text("a\nb\nc\n")
    (tmp_path / "links.txt").write_text("1:\n2: 1\n3: 1 4\n4:\n")
    return tmp_path


@pytest.fixture(autouse=True)
def nothing_left_over(spark):
    """Every job deletes the tables it has saved in between."""
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("pagemill-*"))
    yield
    assert set(folder.glob("pagemill-*")) == before


def run(*args):
    main([str(a) for a in args])


def test_word_count(spark, data):
    run("word-count", data / "words", data / "out")
    assert sorted(read(data / "out")) == ["be\t2", "not\t1", "or\t1", "to\t2"]


def test_access_count_and_top(spark, data, capsys):
    run("access-count", data / "traffic", data / "out")
    assert sorted(read(data / "out")) == ["a\t18", "b\t10", "zz\t7"]
    run("access-count", data / "traffic", data / "de", "--project", "de")
    assert read(data / "de") == ["a\t3"]
    run("top-pages", data / "out", 2)
    shown = capsys.readouterr().out
    assert shown.index("18") < shown.index("10") and "zz" not in shown


def test_trend(spark, data):
    run("trend", data / "traffic", data / "out", "--threshold", 10)
    assert read(data / "out") == ["a\t0-7 2-11 "]
    run("trend", data / "traffic", data / "none")
    assert read(data / "none") == []


def test_page_edits(spark, data):
    run("page-edits", data / "revisions.txt", data / "user", "--by", "user", "--sort", "edits")
    assert read(data / "user") == [
        "Ann\t1!@#20070101000001!@#1!@#fix",
        "Bob\t3!@#20070101000002 20070101000003 20070101000004!@#2 1 1!@#add",
    ]
    run("page-edits", data / "revisions.txt", data / "page", "--by", "page", "--sort", "id", "--files", 1)
    assert len(list((data / "page").glob("part-*"))) == 1
    assert read(data / "page") == [
        "1\t3!@#20070101000001 20070101000003 20070101000004!@#Ann Bob Bob!@#add",
        "2\t1!@#20070101000002!@#Bob!@#",
    ]
    run("page-edits", data / "revisions.txt", data / "any", "--by", "page")
    assert sorted(read(data / "any")) == read(data / "page")


def test_page_rank(spark, data, capsys):
    run("page-rank", data / "links.txt", data / "ranks", 3, "--save", "all")
    first, last = sorted(read(data / "ranks" / "1")), sorted(read(data / "ranks" / "3"))
    assert "3:\tr0.15  1 4 " in first and len(first) == 4
    run("page-rank", data / "ranks" / "1", data / "more", 2, "--resume", "--save", "last")
    assert not (data / "more" / "1").exists()
    run("page-rank", data / "links.txt", data / "brief", 3)
    brief = {k: float(v) for k, v in (l.split("\t") for l in read(data / "brief" / "1"))}
    assert brief == pytest.approx({"1": 1.425, "2": 0.15, "3": 0.15, "4": 0.575})
    assert sorted(read(data / "brief" / "3")) == last
    run("page-rank", data / "links.txt", data / "short", 1, "--line-links", 1)
    own = [l.split()[2:] for l in read(data / "short") if l.startswith("3:\tr0.15 ")]
    assert sorted(x for links in own for x in links) == ["1", "4"]
    assert sorted(read(data / "more" / "2")) == last
    run("page-rank", data / "links.txt", data / "single", 1)
    assert sorted(read(data / "single")) == first
    run("page-info", data / "ranks" / "3", data / "titles.txt", 2)
    assert "|b    |0.15|" in capsys.readouterr().out


def test_balance_from_the_other_jobs(spark, data, capsys):
    run("page-edits", data / "revisions.txt", data / "history", "--by", "page")
    run("access-count", data / "traffic", data / "accesses")
    run("edit-view-balance", data / "titles.txt", data / "history", data / "accesses", data / "out")
    assert sorted(read(data / "out")) == [f"a\t{3 / 18} 3 18", "b\t0.1 1 10", "zz\t0.0 0 7"]
    run("page-name", data / "titles.txt", 3)
    assert "|c    |" in capsys.readouterr().out


def test_rejects_go_aside(spark, data):
    (data / "traffic" / "pagecounts-20100102-000000").write_text("en c x 1\nen\n")
    with pytest.raises(Exception):
        run("access-count", data / "traffic", data / "fails")
    run("access-count", data / "traffic", data / "out", "--by-project", "--mode", "reject", "--rejects", data / "bad")
    assert sorted(read(data / "out")) == ["de\ta\t3", "en\ta\t15", "en\tb\t10", "en\tzz\t7"]
    assert sorted(read(data / "bad")) == ["too few fields\ten", "views is not a number\ten c x 1"]
    with pytest.raises(SystemExit):
        run("access-count", data / "traffic", data / "other", "--mode", "reject")
    (data / "revisions.txt").write_text("21 1 21 Ann\n22 2 22 6 Bob 20070101000002 0 0 NULL NULL\n")
    run("page-edits", data / "revisions.txt", data / "page", "--by", "page", "--mode", "reject", "--rejects", data / "short")
    assert read(data / "page") == ["2\t1!@#20070101000002!@#Bob!@#"]
    assert read(data / "short") == ["too few fields\t21 1 21 Ann"]


def test_trend_leaves_days_out(spark, data):
    window = ("--threshold", 6, "--first-day", "2010-01-02", "--n-days", 1)
    with pytest.raises(Exception, match="outside the window"):
        run("trend", data / "traffic", data / "fails", *window)
    run("trend", data / "traffic", data / "late", *window, "--late", "drop")
    assert sorted(read(data / "late")) == ["a\t0-7 ", "b\t0-10 "]
    run("trend", data / "traffic", data / "none", *window, "--early", "drop", "--late", "drop")
    assert read(data / "none") == []


def test_long_histories_are_parts(spark, data):
    run("page-edits", data / "revisions.txt", data / "user", "--by", "user", "--sort", "edits", "--part-edits", 2)
    assert read(data / "user") == [
        "Ann\t1!@#20070101000001!@#1!@#fix",
        "Bob\t3!@#20070101000002 20070101000003!@#2 1!@#add!@#0!@#2",
        "Bob\t3!@#20070101000004!@#1!@#add!@#1!@#1",
    ]


def test_sort_by_count(spark, tmp_path):
    (tmp_path / "counts").write_text("10 b  two  spaces\n9\ta\n10\ta\n-1 c\n")
    for files in (None, 1, 2):
        target = tmp_path / f"sorted{files}"
        jobs.sort_by_count(spark, str(tmp_path / "counts"), str(target), files)
        parts = sorted(f for f in target.iterdir() if f.name.startswith("part-"))
        assert [line for f in parts for line in f.read_text().splitlines()] == ["-1\tc", "9\ta", "10\ta", "10\tb  two  spaces"]
        assert files is None or len(parts) == files
    (tmp_path / "bad").write_text("x y\n")
    with pytest.raises(Exception, match="bad number in 'count'"):
        jobs.sort_by_count(spark, str(tmp_path / "bad"), str(tmp_path / "never"))


def test_arguments_of_the_lookups():
    from pagemill.__main__ import parser

    args = parser().parse_args(["page-info", "ranks", "titles", "7", "--index", "saved"])
    assert (args.ranks, args.titles, args.page_id, args.index) == ("ranks", "titles", 7, "saved")
    assert parser().parse_args(["page-name", "titles", "7"]).index is None
    args = parser().parse_args(["index-titles", "titles", "target"])
    assert (args.job, args.titles, args.target) == ("index-titles", "titles", "target")
