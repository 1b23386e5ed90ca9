from pagemill.sources.graphs import (
    explode_links,
    parse_links,
    parse_rank_lines,
    parse_ranks,
    read_links,
    read_ranks,
    split_ranks,
)
from pagemill.sources.history import (
    parse_access_counts,
    parse_counted,
    parse_edit_counts,
    parse_history,
    read_access_counts,
    read_edit_counts,
    read_history,
)
from pagemill.sources.line_places import line_index
from pagemill.sources.listing import list_files, traffic_manifest
from pagemill.sources.revisions import parse_revisions, read_revisions
from pagemill.sources.text import index_titles, read_lines, read_title, read_titles
from pagemill.sources.traffic import parse_pagecounts, read_pagecounts

__all__ = [
    "explode_links",
    "index_titles",
    "line_index",
    "list_files",
    "parse_access_counts",
    "parse_counted",
    "parse_edit_counts",
    "parse_history",
    "parse_links",
    "parse_pagecounts",
    "parse_rank_lines",
    "parse_ranks",
    "parse_revisions",
    "read_access_counts",
    "read_edit_counts",
    "read_history",
    "read_lines",
    "read_links",
    "read_pagecounts",
    "read_ranks",
    "read_revisions",
    "read_title",
    "read_titles",
    "split_ranks",
    "traffic_manifest",
]
