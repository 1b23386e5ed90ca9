from datetime import date

import pytest
from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill.functions.text import WHITESPACE


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_words_split_on_every_delimiter_but_vertical_tab(spark):
    got = column(spark, ["a b\tc\fd\re", " x,  Y!", "a\x0bb", ""], fn.words)
    assert [[w for w in ws if w] for ws in got] == [["a", "b", "c", "d", "e"], ["x,", "Y!"], ["a\x0bb"], []]


def test_tokens_have_no_empty_tail(spark):
    assert column(spark, ["1: ", "a  b\tc \t", " a"], fn.tokens) == [["1:"], ["a", "b", "c"], ["", "a"]]


def test_glue_and_titles(spark):
    assert column(spark, [f"a{WHITESPACE}b c"], fn.glue) == ["abc"]
    assert column(spark, ["  a \t b  c ", ""], fn.normalise_title) == ["a b c", ""]


def test_strip_suffix_and_rest(spark):
    assert column(spark, ["1:", "a::", "b", ":"], lambda x: fn.strip_suffix(x, ":")) == ["1", "a:", "b", ""]
    assert column(spark, ["5  k v  w", "a b"], lambda x: fn.rest_from(x, 1)) == ["k v  w", "b"]


def test_whole_number(spark):
    texts = ["12", "-3", "+4", "5.0", "5x", " 6", "", None, "99999999999999999999"]
    assert column(spark, texts, fn.whole_number) == [12, -3, 4, None, None, None, None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_long_raises(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="bad number in 'views': 5x"):
            column(spark, ["5x"], lambda x: fn.strict_long(x, "views"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_day_of_file(spark):
    names = ["pagecounts-20081001-xxxx.gz", "pagecounts-20100101-0", "pagecounts-20100212-000001_part"]
    days = column(spark, names, fn.day_from_file_name)
    assert days == [date(2008, 10, 1), date(2010, 1, 1), date(2010, 2, 12)]
    bad = ["pagecounts-20100231-0", "notes.txt"]
    assert column(spark, bad, lambda x: fn.day_from_file_name(x, strict=False)) == [None, None]
    with pytest.raises(Exception, match="no date in file name"):
        column(spark, bad, fn.day_from_file_name)


def test_day_index(spark):
    days = [date(2008, 10, 1), date(2010, 1, 1), date(2010, 2, 12), date(2010, 3, 16), date(2010, 3, 17)]
    assert column(spark, days, fn.day_index, "date") == [0, 0, 42, 74, 75]
    assert column(spark, days[:2], lambda x: fn.day_index(x, clamp=False), "date") == [-457, 0]


def test_tags(spark):
    comments = ["Reverted edits by x", "bad dog", "removed", "Created, fixed", "nothing", "  ", "", None]
    masks = column(spark, comments, fn.tag_mask)
    assert [m is None for m in masks] == [False] * 5 + [True] * 3
    tags = column(spark, comments, lambda x: fn.mask_tags(fn.tag_mask(x)))
    assert tags == [["revert", "edit"], ["add"], ["remov", "mov"], ["fix", "creat"], [], [], [], []]
    assert column(spark, comments[:3], lambda x: fn.mask_text(fn.tag_mask(x, word_safe=True))) == [
        "revert edit",
        "",
        "remov mov",
    ]


def test_series(spark):
    df = spark.sql("select array(named_struct('day', 2, 'n', 11L), named_struct('day', 0, 'n', 7L), "
                   "named_struct('day', 1, 'n', 0L)) e")
    got = df.select(fn.sparse_series(F.col("e")), fn.dense_series(F.col("e"), 4)).first()
    assert tuple(got) == ("0-7 2-11", [7, 0, 11, 0])
