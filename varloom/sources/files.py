"""Row numbers in the order of files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_file_order(rows: DataFrame, name: str) -> DataFrame:
    """Rows as scanned from files, with a leading column ``name``: their number, by file path and place.

    Spark deals ranges of files to tasks by size, so its own row IDs follow the order of lines only inside
    a range. Ranges are counted first (one narrow row each); a row's number is what stands before its
    range and its place there.
    """
    columns = rows.columns
    marked = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    ranges = marked.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_file", "_start")) - F.col("_n")
    ranges = ranges.select("_file", "_start", "_first", before.alias("_before"))
    met = marked.join(ranges, ["_file", "_start"])
    return met.select((F.col("_before") + F.col("_id") - F.col("_first")).alias(name), *columns)


#: Bits of a row's place in its task, and of its range, in the numbers of :func:`in_scan_order`.
PLACE_BITS, RANGE_BITS = 31, 32
#: Paths of files that are sent to every task; more are joined by a shuffle.
MOST_SENT = 100_000
_SLASHES = "^([a-zA-Z0-9+.-]+:)/+"


def in_scan_order(rows: DataFrame, name: str) -> DataFrame:
    """Rows as scanned from files, with a leading column ``name``: numbers that rise with file path and place.

    One scan, without counting: a number holds the rank of the file, where its range begins, and the place
    in the task, which rises inside a range. Numbers are distinct but have gaps; :func:`in_file_order`
    gives them without. Only over several files is there a join, with the list of their paths.
    """
    spark, columns = rows.sparkSession, rows.columns
    # One path may be written with one slash behind its scheme, or three.
    files = sorted(re.sub(_SLASHES, r"\1/", file) for file in rows.inputFiles())

    def size(key: str) -> int:
        return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))

    # No range of a file is shorter than this, but for its last one.
    step = max(1, min(size("spark.sql.files.maxPartitionBytes"), size("spark.sql.files.openCostInBytes")))
    file_bits = max(len(files) - 1, 0).bit_length()
    most = 1 << (RANGE_BITS - file_bits)
    marked = rows.select(
        "*",
        F.regexp_replace("_metadata.file_path", _SLASHES, "$1/").alias("_file"),
        F.floor(F.col("_metadata.file_block_start") / step).alias("_range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    rank = F.lit(0).cast("bigint")
    if len(files) > 1:
        ranks = spark.createDataFrame(list(enumerate(files)), "_rank bigint, _path string")
        if len(files) <= MOST_SENT:
            # Lines then stay where they are.
            ranks = F.broadcast(ranks)
        marked = marked.join(ranks, F.col("_file") == F.col("_path"), "left")
        rank = F.col("_rank")
    number = (rank * most + F.col("_range")) * (1 << PLACE_BITS) + F.col("_place")
    fits = rank.isNotNull() & (F.col("_range") < most) & (F.col("_place") < (1 << PLACE_BITS))
    checked = F.when(fits, number).otherwise(F.raise_error(F.concat(F.lit("no number for a row of "), F.col("_file"))))
    return marked.select(checked.alias(name), *columns)
