from pagemill.functions.days import day_from_file_name, day_index
from pagemill.functions.series import dense_series, sparse_series
from pagemill.functions.tags import KEYWORDS, mask_tags, mask_text, tag_mask
from pagemill.functions.text import (
    glue,
    normalise_title,
    rest_from,
    squeeze,
    strict_field,
    strict_long,
    strip_suffix,
    tokens,
    whole_number,
    words,
)

__all__ = [
    "KEYWORDS",
    "day_from_file_name",
    "day_index",
    "dense_series",
    "glue",
    "mask_tags",
    "mask_text",
    "normalise_title",
    "rest_from",
    "sparse_series",
    "squeeze",
    "strict_field",
    "strict_long",
    "strip_suffix",
    "tag_mask",
    "tokens",
    "whole_number",
    "words",
]
