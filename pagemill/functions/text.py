"""Text expressions: tokenising, gluing, strict parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The delimiters of plain word tokenising, and the whitespace class of
# record splitting (which also holds the vertical tab).
WORD_DELIMITERS = " \t\n\r\f"
WHITESPACE = " \t\n\x0b\f\r"
WHOLE_NUMBER = "[+-]?[0-9]+"


def words(line: Column) -> Column:
    """Tokens of a line; case and punctuation are kept. Delimiters at an end leave an empty token."""
    return F.split(line, f"[{WORD_DELIMITERS}]+")


def tokens(line: Column) -> Column:
    """Split on runs of whitespace. Trailing whitespace yields no empty last token."""
    return F.split(F.rtrim(line, F.lit(WHITESPACE)), r"\s+")


def squeeze(text: Column) -> Column:
    """Collapse whitespace runs to one space."""
    return F.regexp_replace(text, r"\s+", " ")


def normalise_title(title: Column) -> Column:
    return F.trim(squeeze(title))


def glue(text: Column) -> Column:
    """Remove all whitespace, so that neighbouring words touch."""
    return F.regexp_replace(text, r"\s+", "")


def strip_suffix(text: Column, suffix: str) -> Column:
    cut = F.left(text, F.length(text) - len(suffix))
    return F.when(F.endswith(text, F.lit(suffix)), cut).otherwise(text)


def rest_from(line: Column, n: int) -> Column:
    """The line from its ``n``-th (0-based) whitespace token on, inner spacing kept."""
    return F.regexp_replace(line, rf"^(?:\S*\s+){{{n}}}", "")


def strict_field(fields: Column, i: int, name: str) -> Column:
    """Field ``i`` of a split record; a record too short for it fails the job."""
    missing = F.concat(F.lit(f"no field '{name}' in: "), F.array_join(fields, " "))
    return F.coalesce(F.get(fields, F.lit(i)), F.raise_error(missing))


def whole_number(text: Column) -> Column:
    """Text to bigint, NULL unless it is digits with an optional sign that a bigint can hold.

    The pattern keeps out what a cast would trim or round, and goes first because a failing cast builds an exception per row.
    """
    return F.when(F.rlike(text, F.lit(f"^{WHOLE_NUMBER}$")), text.try_cast("bigint"))


def strict_long(text: Column, name: str) -> Column:
    """Text to bigint; text that is no whole number fails the job, ANSI mode or not."""
    bad = F.concat(F.lit(f"bad number in '{name}': "), text)
    return F.coalesce(whole_number(text), F.raise_error(bad))
