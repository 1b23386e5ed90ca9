"""Lines of text files by number, independent of how Spark plans the splits of a scan.

Files are read in ranges of a fixed size from their start, one task each, whatever the size of
the input, the cores, the settings of the session, and the files that a filter leaves: the scan
belongs to a session of its own whose splits are these ranges. So a line's place (file, range,
position in it) is the same in every scan. A file that cannot be split is one range.

Numbering counts the lines per range in one scan and adds the counts to the positions of a
second one; the lines themselves are neither shuffled nor saved. The index goes further: it has
the byte at which every ``ENTRY_LINES``-th line starts, so a lookup reads only the few lines
between two entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pagemill.lineage import broadcast_if_small, settle
from pagemill.operators.numbering import POSITION_BITS
from pagemill.sources.listing import list_files

# Bytes of a file read by one task, and lines between two entries of the index.
RANGE_BYTES, ENTRY_LINES = 32 << 20, 1024
# Bytes between two entries that a lookup reads itself; more are read by a task.
READ_BYTES = 16 << 20
# Ranges whose counts may be broadcast: three numbers each.
BROADCAST_RANGES = 1_000_000


def range_session(spark: SparkSession, range_bytes: int) -> SparkSession:
    """A session like this one, whose file scans have one split per range and task."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    # Splits are as long as the smaller of the two allows, and two never share a task: opening
    # the next one is said to cost as much as a whole range.
    own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(range_bytes))
    own.conf.unset("spark.sql.files.maxPartitionNum")
    return own


def ranged_lines(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, separator: str | None = None
) -> DataFrame:
    """``value, file, size, modified, start, row``: each line with its range and its position there."""
    reader = range_session(spark, range_bytes).read
    lines = (reader if separator is None else reader.option("lineSep", separator)).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND((1 << POSITION_BITS) - 1).alias("row"),
    )


def range_offsets(ranges: DataFrame) -> DataFrame:
    """``file, start, lines, bytes`` of ranges with ``lines_before`` and, in the file, ``bytes_before``.

    Ranges are summed per file, then only files are put in one order: by folder, by the
    number of a part file (``part-99999`` before ``part-100000``), by name.
    """
    folder, number = F.regexp_extract("file", r"^(.*/)", 1), F.regexp_extract("file", r"part-(\d+)[^/]*$", 1)
    files = ranges.groupBy("file").agg(F.sum("lines").alias("_lines"))
    # One row per file.
    earlier = Window.orderBy(folder, number.try_cast("bigint"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("file").alias("_of"), F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumns({f"_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in ("lines", "bytes")})
    return inside.join(files, inside["file"] == files["_of"]).select(
        "file", "start", (F.col("_before") + F.col("_lines")).alias("lines_before"), F.col("_bytes").alias("bytes_before")
    )


def number_lines(
    spark: SparkSession, path: str | list[str], into: str = "line_no", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``<into>, value``: the lines of text files, numbered from 1 in file order.

    Two scans: one counts the lines of each range, the other reads them. No line is shuffled
    or saved.
    """
    lines = ranged_lines(spark, path, range_bytes)
    counts = settle(
        spark,
        lambda: lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("lines"), F.lit(0).alias("bytes")),
    )
    # Short keys keep the broadcast small: a file by its hash, a range by its start.
    key = F.xxhash64("file").alias("_file")
    offsets = settle(spark, lambda: range_offsets(counts).select(key, F.col("start").alias("_start"), "lines_before"))
    offsets, _ = broadcast_if_small(offsets, max_rows=BROADCAST_RANGES)
    rows = lines.select(key, "start", "row", "value")
    same = (offsets["_file"] == rows["_file"]) & (offsets["_start"] == rows["start"])
    # The offsets on the left: the result belongs to the caller's session.
    return offsets.join(rows, same).select((F.col("lines_before") + F.col("row") + 1).alias(into), "value")


# --- the index ---------------------------------------------------------------------


def line_index(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, entry_lines: int = ENTRY_LINES
) -> DataFrame:
    """One row per up to ``entry_lines`` lines of a range: ``first_line, lines``, where they are
    (``file, start, row, offset, bytes``), and what the file was (``size, modified``).

    ``offset`` is the byte of the (uncompressed) file at which the first of them starts. Lines
    end at a line feed; a carriage return before it belongs to the end, and one within ends a
    line as well.
    """
    raw = ranged_lines(spark, path, range_bytes, separator="\n")
    returns = F.regexp_count("value", F.lit("\r")) - F.endswith("value", F.lit("\r")).cast("int")
    entry = F.floor(F.col("row") / entry_lines).cast("bigint") * entry_lines
    counted = raw.groupBy("file", "start", entry.alias("row")).agg(
        F.max("size").alias("size"),
        F.max("modified").alias("modified"),
        F.sum(F.when(F.contains("value", F.lit("\r")), returns + 1).otherwise(1)).alias("lines"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
    )
    entries = settle(spark, lambda: counted)
    ranges = settle(
        spark, lambda: range_offsets(entries.groupBy("file", "start").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes")))
    )
    ranges, _ = broadcast_if_small(ranges.withColumnsRenamed({"file": "_file", "start": "_start"}))
    # A range has at most as many entries as bytes: it was read by one task.
    earlier = Window.partitionBy("file", "start").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("lines", "bytes")}
    placed = entries.withColumns({f"_{c}": n for c, n in before.items()})
    return placed.join(ranges, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))).select(
        (F.col("lines_before") + F.col("_lines") + 1).alias("first_line"),
        "lines", "file", "start", "row", (F.col("bytes_before") + F.col("_bytes")).alias("offset"), "bytes",
        "size", "modified", F.lit(range_bytes).cast("bigint").alias("range_bytes"), F.lit(entry_lines).cast("bigint").alias("entry_lines"),
    )


def save_index(index: DataFrame, target: str) -> None:
    """As a table in the order of lines, of which a lookup reads only the part around its line."""
    index.repartitionByRange("first_line").sortWithinPartitions("first_line").write.parquet(target)


def check_fresh(spark: SparkSession, index: DataFrame, path: str | list[str]) -> None:
    """Fails if files were added, changed or deleted since they were indexed."""
    known = index.select("file", "size", "modified").distinct()
    # Empty files have no lines, so the index does not know them.
    there = list_files(spark, path).where(F.col("size") > 0).select("file", "size", "modified")
    differ = known.exceptAll(there).unionByName(there.exceptAll(known)).select("file").first()
    if differ is not None:
        raise RuntimeError(f"the index does not fit the files any more: {differ['file']}")


def _lines_of(raw: list[bytes]) -> list[bytes]:
    out = []
    for line in raw:
        out += line.removesuffix(b"\r").split(b"\r")
    return out


def _entry_bytes(spark: SparkSession, entry) -> bytes | None:
    """The bytes between two entries, or None of a compressed file or if they are too many."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(entry["file"]))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    # The last line of a file may lack its end.
    n = min(entry["bytes"], entry["size"] - entry["offset"])
    if codec is not None or n > READ_BYTES:
        return None
    stream = path.getFileSystem(conf).open(path)
    try:
        stream.seek(entry["offset"])
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
    finally:
        stream.close()


def line_at(spark: SparkSession, index: DataFrame, n: int, into: str = "line_no") -> DataFrame:
    """Line ``n`` of :func:`number_lines` by an index, or no row.

    Of a plain file the lines between two entries are read; of a compressed one, a task reads
    the file up to them.
    """
    schema = f"{into} bigint, value string"
    entry = index.where((F.col("first_line") <= n) & (F.col("first_line") + F.col("lines") > n)).first()
    if entry is None:
        return spark.createDataFrame([], schema)
    data = _entry_bytes(spark, entry)
    if data is not None:
        raw = data.split(b"\n")
    else:
        rows = ranged_lines(spark, [entry["file"]], entry["range_bytes"], separator="\n")
        inside = (F.col("row") >= entry["row"]) & (F.col("row") < entry["row"] + entry["entry_lines"])
        # At most the lines of one entry.
        own = rows.where((F.col("start") == entry["start"]) & inside).select("row", F.col("value").cast("binary").alias("value"))
        raw = [bytes(r["value"]) for r in sorted(own.collect())]
    line = _lines_of(raw)[n - entry["first_line"]]
    return spark.createDataFrame([(n, line.decode(errors="replace"))], schema)
