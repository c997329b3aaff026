"""Stored stages and the region-searchable layout."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.params import ANN_FIELDS
from varloom.session import new_path


def _complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored result of ``build``, computed only when ``path`` holds no finished write."""
    if not _complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fingerprint(df: DataFrame) -> str:
    """A name for what ``df`` computes from what: its plan, and path, size and time of change of every file it reads."""
    spark = df.sparkSession
    limit = "spark.sql.debug.maxToStringFields"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "1000000")
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(limit, usual)
    # Numbers of columns and of plan nodes differ between runs.
    facts = [re.sub(r"#\d+L?|plan_id=\d+", "#", plan)]
    for file in sorted(df.inputFiles()):
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        facts.append(f"{file} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(facts).encode()).hexdigest()[:24]


def stage_by_content(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The stored result of ``df`` below ``folder``, computed only if nothing finished has its :func:`fingerprint`.

    A changed input file, parameter or operator makes another stage; the earlier one stays.
    """
    return stage(df.sparkSession, f"{folder}/{name}-{fingerprint(df)}", lambda: df)


def bucketed(df: DataFrame, name: str, keys: list[str] | tuple, buckets: int | None = None) -> DataFrame:
    """Store ``df`` as a table in buckets of ``keys`` and read it back.

    Joins and groups on columns that include ``keys`` find their rows in the bucket: they are not shuffled
    again. The table lies in the shared folder; its name is new. Rows are dealt out before the write, so
    that a bucket is one file.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"{name}_{path.rpartition('-')[2]}".replace("-", "_")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(count, *keys).write.bucketBy(count, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def write_by_region(records: DataFrame, path: str, partitions: int | None = None) -> None:
    """Parquet sorted by (CHROM, POS), so that a region filter skips files and row groups.

    ROW_ID, where there is one, also spreads a site with very many rows over several files.
    """
    keys = [c for c in ("CHROM", "POS", "ROW_ID") if c in records.columns]
    args = [partitions, *keys] if partitions else keys
    records.repartitionByRange(*args).sortWithinPartitions(*keys).write.parquet(path)


def read_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """Records of one region of a stored file."""
    return spark.read.parquet(path).filter((F.col("CHROM") == chrom) & F.col("POS").between(start, end))


def report_names(df: DataFrame) -> DataFrame:
    """Rename to the column names of the text reports; VARIANT columns become JSON text."""
    df = df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() == "variant"})
    names = {**ANN_FIELDS, "feature_start": "Start", "feature_end": "End", "ALT_SUMMARY": "N_ALT_GTS:REF>ALT"}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns and k != v})


def calls_wide(calls: DataFrame, sample_ids: list[int]) -> DataFrame:
    """One column per sample and call field (``<id>_GT`` ...) instead of ``CALLS``, for text reports."""
    fields = calls.schema["CALLS"].dataType.elementType.fieldNames()
    rest = [F.col(f"`{c}`") for c in calls.columns if c != "CALLS"]
    cells = [
        F.get("CALLS", F.lit(i))[name].alias(f"{sample}_{name}")
        for i, sample in enumerate(sample_ids)
        for name in fields
    ]
    return calls.select(*rest, *cells)
