"""Revision records: ``rev page text_id comment... user_id user ts minor 0 NULL NULL``.

Fields are separated by runs of whitespace and the comment is not quoted, so the fields
behind it are found by counting from the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.functions.text import WHITESPACE, tokens, whole_number
from pagemill.lineage import spread_scan
from pagemill.sources.text import read_lines

# Fields before the comment, fields after it.
HEAD, TAIL = 3, 7


def parse_revisions(lines: DataFrame, mode: str = "failfast") -> DataFrame | tuple[DataFrame, DataFrame]:
    """``rev_id, page_id, text_id, comment, user_id, user, ts, minor`` from lines in ``value``.

    ``ts`` stays the 14-digit text, which sorts like the time it names. The comment has
    single spaces. A short record or a bad revision or page id fails the job, whichever field
    is used, or lands in the second table ``value, reason`` with
    ``mode="reject"``.
    """
    if mode not in ("failfast", "reject"):
        raise ValueError(f"mode must be 'failfast' or 'reject', not {mode!r}")
    records = lines.select("value", tokens(F.col("value")).alias("t"))
    complete, good_ids = _tests(F.col("t"))
    if mode == "failfast":
        return _fields(records, strict=True)
    reason = F.when(~complete, "too few fields").otherwise("page or revision id is not a number")
    bad = records.where(~(complete & good_ids)).select("value", reason.alias("reason"))
    return _fields(records.where(complete & good_ids), strict=False), bad


def _tests(t: Column) -> tuple[Column, Column]:
    """Whether a split record has all its fields, and both ids in front."""
    ids = whole_number(F.get(t, F.lit(0))).isNotNull() & whole_number(F.get(t, F.lit(1))).isNotNull()
    return F.size(t) >= HEAD + TAIL, F.coalesce(ids, F.lit(False))


def _fields(records: DataFrame, strict: bool) -> DataFrame:
    """Typed fields of split records ``t``; with ``strict`` each stands under the test of its record."""
    t = F.col("t")
    n = F.size(t)
    complete, good_ids = _tests(t)
    bad = F.raise_error(
        F.concat(F.when(~complete, "too few fields in: ").otherwise("bad number in 'page_id' or 'rev_id': "), F.array_join(t, " "))
    )

    def checked(value: Column) -> Column:
        return F.when(complete & good_ids, value).otherwise(bad) if strict else value

    columns = {
        "rev_id": whole_number(F.get(t, F.lit(0))),
        "page_id": whole_number(F.get(t, F.lit(1))),
        "text_id": whole_number(F.get(t, F.lit(2))),
        "comment": F.array_join(F.slice(t, HEAD + 1, F.greatest(n - HEAD - TAIL, F.lit(0))), " "),
        "user_id": whole_number(F.get(t, n - 7)),
        "user": F.get(t, n - 6),
        "ts": F.get(t, n - 5),
        "minor": whole_number(F.get(t, n - 4)).cast("int"),
    }
    return records.select(*(checked(value).alias(name) for name, value in columns.items()))


def read_revisions(
    spark: SparkSession, path: str | list[str], mode: str = "failfast"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Revision files; blank lines are no records."""
    lines = read_lines(spark, path).where(F.rtrim(F.col("value"), F.lit(WHITESPACE)) != "")
    return parse_revisions(spread_scan(lines), mode)
