"""Action tags of edit comments, carried as a bit mask so that aggregates stay on integers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pagemill.functions.text import glue

# Action keywords, in output order.
KEYWORDS = ("revert", "edit", "fix", "add", "tag", "insert", "remov", "updat", "mov", "creat")


def tag_mask(comment: Column, word_safe: bool = False) -> Column:
    """Bit i is set when keyword i occurs in the comment; NULL for an empty comment.

    Comments are matched with their whitespace removed, so a keyword may span words;
    ``word_safe`` matches on the comment as written.
    """
    glued = glue(F.coalesce(comment, F.lit("")))
    text = F.lower(comment if word_safe else glued)
    # Plain additions, not a branch, so that the text is prepared once for all keywords.
    bits = [F.when(F.contains(text, F.lit(k)), 1 << i).otherwise(0) for i, k in enumerate(KEYWORDS)]
    return reduce(lambda a, b: a + b, bits, F.when(glued != "", 0))


def _hits(mask: Column) -> list[Column]:
    return [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(k)) for i, k in enumerate(KEYWORDS)]


def mask_tags(mask: Column) -> Column:
    """Mask to an array of keywords, in keyword order; NULL gives an empty array."""
    return F.array_compact(F.array(*_hits(mask)))


def mask_text(mask: Column) -> Column:
    """Mask to keywords with one space between; NULL gives the empty string."""
    return F.concat_ws(" ", *_hits(mask))
