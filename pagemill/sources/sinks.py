"""Text forms of the results and their writers."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.functions.codec import escape_item, escape_key
from pagemill.lineage import on_scope_end, scratch, scratch_path
from pagemill.sources.history import PART_SEPARATOR

# Links written on one line unless a job says otherwise; a page with more gets several lines.
LINE_LINKS = 10_000
# Records of a traffic file, about; a day with more gets several files.
FILE_RECORDS = 5_000_000


def key_value_lines(df: DataFrame, key: str | Column, value: str | Column) -> DataFrame:
    """``value``: one ``key \\t value`` line per row, in the order of ``df``."""
    key, value = (F.col(c) if isinstance(c, str) else c for c in (key, value))
    line = F.concat_ws("\t", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(value.cast("string"), F.lit("")))
    return df.select(line.alias("value"))


def history_text() -> Column:
    """``edits!@#timestamps!@#others!@#actions`` of a packed history row.

    A row that is one part of several has the key's total in front, and two more fields
    behind: ``!@#part!@#edits`` with its number and the edits in it. So whoever reads the
    first field of any line has the total. Names are escaped (:mod:`pagemill.functions.codec`)
    where they hold a separator.
    """
    several = F.col("total") > F.col("edits")
    part = F.when(several, F.concat_ws(PART_SEPARATOR, F.lit(""), F.col("part").cast("string"), F.col("edits").cast("string")))
    text = F.concat_ws(
        PART_SEPARATOR,
        F.col("total").cast("string"),
        F.array_join("timestamps", " "),
        F.array_join(F.transform("others", escape_item), " "),
        F.array_join("actions", " "),
    )
    return F.concat(text, F.coalesce(part, F.lit("")))


def history_lines(history: DataFrame, by: str) -> DataFrame:
    """Lines of a packed history, one per part; a user is escaped like the names."""
    key = {"user": "user", "page": "page_id"}[by]
    return key_value_lines(history, escape_key(F.col(key).cast("string")), history_text())


def trend_lines(trends: DataFrame) -> DataFrame:
    """``title \\t day-n day-n `` with the closing space of the series."""
    return key_value_lines(trends, "title", F.concat("series", F.lit(" ")))


def balance_lines(balances: DataFrame) -> DataFrame:
    """``title \\t ratio edits accesses``; without accesses the ratio reads Infinity or NaN."""
    undefined = F.when(F.col("edits") == 0, "NaN").otherwise("Infinity")
    ratio = F.coalesce(F.col("ratio").cast("string"), undefined)
    return key_value_lines(
        balances, "title", F.concat_ws(" ", ratio, F.col("edits").cast("string"), F.col("accesses").cast("string"))
    )


def link_lists(edges: DataFrame, degrees: DataFrame, line_links: int = LINE_LINKS) -> DataFrame:
    """``id, piece, links``: link lists of about ``line_links`` entries from ``src, dst, m``.

    ``degrees`` are ``id, links``; a page without links has one empty list. A source with
    more links is spread over pieces by target, and a link repeated more often than that is
    cut into runs, so no list grows with a hub.
    """
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("m") - 1) / line_links).cast("bigint"))
    spread = F.ceil(F.col("links") / line_links).cast("bigint")
    pieces = (
        edges.select("src", "dst", "m", F.explode(runs).alias("run"))
        .join(degrees.select(F.col("id").alias("src"), "links"), "src")
        .select(
            F.col("src").alias("id"),
            F.pmod(F.xxhash64("dst", "run"), spread).alias("piece"),
            "dst",
            F.least(F.col("m") - F.col("run") * line_links, F.lit(line_links)).cast("int").alias("times"),
        )
        # Keeps the join by source from gathering all pieces of a hub in one task.
        .repartition("id", "piece")
    )
    repeated = F.array_repeat(F.col("dst").cast("string"), F.col("times"))
    lists = pieces.groupBy("id", "piece").agg(F.flatten(F.sort_array(F.collect_list(repeated))).alias("links"))
    empty = degrees.where(F.col("links") == 0).select(
        "id", F.lit(0).cast("bigint").alias("piece"), F.array().cast("array<string>").alias("links")
    )
    return lists.unionByName(empty)


def rank_lines(ranks: DataFrame, lists: DataFrame) -> DataFrame:
    """``id: \\t rRANK  to1 to2 `` lines, the saved state that ``read_ranks`` takes.

    ``lists`` are the ``id, piece, links`` of :func:`link_lists`, one line each.
    """
    links = F.transform("links", lambda x: F.concat(x, F.lit(" ")))
    text = F.concat(F.lit("r"), F.col("rank").cast("string"), F.lit("  "), F.array_join(links, ""))
    return key_value_lines(lists.join(ranks, "id"), F.concat(F.col("id").cast("string"), F.lit(":")), text)


def write_lines(lines: DataFrame, path: str, mode: str = "error", files: int | None = None) -> None:
    """One text file per partition, in the order of ``lines``.

    ``files`` deals unsorted lines out anew over that many files; each is written by one
    task. For a sorted result give the number of files to the sort instead
    (:func:`pagemill.operators.edits.sort_edits`). A single file is not written by one task but
    joined of the parts, in their order (:func:`write_merged`).
    """
    if files == 1:
        if mode == "error" and path_exists(lines.sparkSession, path):
            raise FileExistsError(f"{path} is already there")
        write_merged(lines, f"{path.rstrip('/')}/part-00000")
        return
    (lines if files is None else lines.repartition(files)).write.mode(mode).text(path)


def write_pagecounts(records: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Traffic records ``project, title, views, bytes, day`` as gzip files named by day.

    The records are dealt over tasks in the order of days, a hot day over many, and staged by
    day in the shared folder. Then a job per day writes files of up to ``file_records`` records:
    its tasks name them ``pagecounts-YYYYMMDD-<task>...gz``, and its commit makes them visible.
    Jobs that write to one folder run one after the other. Fails if the folder has files of a
    day that is written.
    """
    spark = records.sparkSession
    line = F.concat_ws(" ", "project", "title", F.col("views").cast("string"), F.col("bytes").cast("string"))
    lines = records.select(line.alias("value"), F.date_format("day", "yyyyMMdd").alias("day"))
    with scratch(spark):
        staged = scratch_path(spark, "traffic")
        # The second range key spreads a day that no range of days can split.
        dealt = lines.withColumn("_turn", F.monotonically_increasing_id()).repartitionByRange("day", "_turn").drop("_turn")
        dealt.write.partitionBy("day").parquet(staged)
        by_day = spark.read.schema("value string, day string").parquet(staged)
        for row in by_day.select("day").distinct().orderBy("day").collect():
            own = by_day.where(F.col("day").eqNullSafe(F.lit(row.day))).select("value")
            own.write.mode("append").options(
                compression="gzip", maxRecordsPerFile=file_records, **{"mapreduce.output.basename": f"pagecounts-{row.day}"}
            ).text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def write_merged(lines: DataFrame, target: str) -> None:
    """``lines`` in their order as a single file.

    Tasks write part files side by side; then the file system joins them in the order of their
    numbers, a step on its directory where it can (as HDFS does). Elsewhere their bytes are
    copied through one stream with a buffer, on the driver. Fails if ``target`` is there.
    """
    spark = lines.sparkSession
    fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = fs_path(target).getFileSystem(conf)
    if path_exists(spark, target):
        raise FileExistsError(f"{target} is already there")
    with scratch(spark):
        # Beside the target: file systems join files of one volume only.
        staged = f"{target.rstrip('/')}.parts-{uuid.uuid4()}"
        on_scope_end(staged)
        lines.write.text(staged)
        parts = sorted(
            (f.getPath() for f in fs.listStatus(fs_path(staged)) if f.getPath().getName().startswith("part-") and f.getLen()),
            key=lambda p: (int(p.getName().split("-")[1]), p.getName()),
        )
        joined = fs_path(f"{staged}/joined")
        if not join_files(spark, fs, parts, joined):
            stream = fs.create(joined)
            try:
                for part in parts:
                    source = fs.open(part)
                    try:
                        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, conf, False)
                    finally:
                        source.close()
            finally:
                stream.close()
        # Complete or not there at all.
        if not fs.rename(joined, fs_path(target)):
            raise OSError(f"cannot rename to {target}")


def join_files(spark: SparkSession, fs, parts: list, target) -> bool:
    """Whether the file system joined ``parts`` itself."""
    if len(parts) < 2:
        return False
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, part in enumerate(parts[1:]):
        array[i] = part
    try:
        fs.concat(parts[0], array)
    except UnsupportedOperationException:
        return False
    return fs.rename(parts[0], target)
