"""VCF lines as a stream.

Everything that works on one record or row at a time (parsing, cleaning, decomposing, splitting
ANN, calls and scores) takes the stream as it takes a table. Joins, counts and ranks are batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.sources.vcf import parse_lines


def stream_vcf(spark: SparkSession, path: str, genotypes: bool = True) -> DataFrame:
    """Records of the VCF files in a folder, new files included; there is no ROW_ID."""
    return parse_lines(spark.readStream.text(path), genotypes)
