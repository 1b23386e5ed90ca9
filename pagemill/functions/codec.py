"""Names in saved records: an escape for the characters that separate fields and lines.

Text without any of them, and without a backslash, stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What cannot stand in a record as it is, and how it is written. The backslash
# comes first: the others write one.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
# In a list of names also its separator, and the first character of the separator of fields.
LIST_ESCAPES = (*ESCAPES, (" ", "\\s"), ("!@#", "\\x@#"))
# A missing and an empty name of a list.
MISSING, EMPTY = "\\0", "\\e"
# Fixed value: the separator of fields starts with it.
_DECODED = {"\\t": "\t", "\\n": "\n", "\\r": "\r", "\\s": " ", "\\x": "!", EMPTY: ""}


def _escaped(text: Column, escapes: tuple) -> Column:
    for raw, written in escapes:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def escape_key(name: Column) -> Column:
    """A name that stands alone before a tab; null is written, empty stays empty."""
    return F.coalesce(_escaped(name, ESCAPES), F.lit(MISSING))


def escape_item(name: Column) -> Column:
    """A name of a list that is separated by spaces."""
    return F.coalesce(F.when(name == "", EMPTY).otherwise(_escaped(name, LIST_ESCAPES)), F.lit(MISSING))


def unescape(text: Column) -> Column:
    """What :func:`escape_key` or :func:`escape_item` was given."""

    def decoded(part: Column) -> Column:
        for written, raw in _DECODED.items():
            part = F.replace(part, F.lit(written), F.lit(raw))
        return part

    # Between doubled backslashes, each single one starts an escape.
    parts = F.transform(F.split(text, r"\\\\"), decoded)
    whole = F.array_join(parts, "\\")
    plain = ~F.contains(text, F.lit("\\"))
    return F.when(text == MISSING, F.lit(None)).when(plain, text).otherwise(whole)
