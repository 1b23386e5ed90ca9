"""``spark-submit``-able entry point: ``python -m pagemill <job> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from pagemill.lineage import scratch
from pagemill.plans import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pagemill")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for path in paths:
            p.add_argument(path)
        return p

    def records(name: str) -> argparse.ArgumentParser:
        """A job over records, whose bad lines may be written aside."""
        p = job(name, "source", "target")
        p.add_argument("--mode", choices=["failfast", "reject"], default="failfast")
        p.add_argument("--rejects", metavar="PATH", help="where --mode reject writes bad lines")
        return p

    job("word-count", "source", "target")
    p = records("access-count")
    p.add_argument("--project")
    p.add_argument("--by-project", action="store_true")
    job("top-pages", "accesses").add_argument("k", type=int, nargs="?", default=15)
    p = records("trend")
    p.add_argument("--threshold", type=int, default=jobs.trends.THRESHOLD)
    p.add_argument("--first-day", type=date.fromisoformat, default=jobs.FIRST_DAY)
    p.add_argument("--n-days", type=int, default=jobs.N_DAYS)
    p.add_argument("--early", choices=["clamp", "drop"], default="clamp")
    p.add_argument("--late", choices=["fail", "drop"], default="fail")
    p = records("page-edits")
    p.add_argument("--by", choices=["user", "page"], required=True)
    p.add_argument("--sort", choices=["id", "edits", "no"], default="no")
    p.add_argument("--part-edits", type=int, default=jobs.edits.PART_EDITS)
    p.add_argument("--files", type=int, help="files of the result, each written by one task")
    p = job("sort-by-count", "source", "target")
    p.add_argument("--files", type=int)
    p = job("page-rank", "source", "target")
    p.add_argument("runs", type=int)
    p.add_argument("--resume", action="store_true")
    p.add_argument("--save", choices=["all", "ranks", "last"], default="ranks")
    p.add_argument("--line-links", type=int, default=jobs.sinks.LINE_LINKS)
    p = job("edit-view-balance", "titles", "page_history", "accesses", "target")
    p.add_argument("--files", type=int)
    job("index-titles", "titles", "target")
    for name, *paths in (("page-name", "titles"), ("page-info", "ranks", "titles")):
        p = job(name, *paths)
        p.add_argument("page_id", type=int)
        p.add_argument("--index", help="saved by index-titles from the same titles")
    return top


def main(argv: list[str] | None = None) -> None:
    top = parser()
    args = vars(top.parse_args(argv))
    name, mode = args.pop("job"), args.pop("mode", None)
    if mode is not None and (mode == "reject") != (args["rejects"] is not None):
        top.error("--mode reject and --rejects PATH go together")
    spark = SparkSession.builder.appName(f"pagemill {name}").getOrCreate()
    with scratch(spark):
        result = getattr(jobs, name.replace("-", "_"))(spark, **args)
        if result is not None:  # the lookups and the top-k report: at most k rows
            result.show(args.get("k", 1), truncate=False)


if __name__ == "__main__":
    main()
