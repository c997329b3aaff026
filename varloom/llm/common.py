"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.session import new_path

# White space as the contracts define it: blank, and the five controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold`` of ``folds``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def keyed_bits(seed: str, *columns: Column) -> Column:
    """60 bits, as a long, of the MD5 of ``seed`` and the columns; nulls count as an empty text."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def small_batches(df: DataFrame) -> DataFrame:
    """Have Arrow send few rows at once, so that a batch of very long texts still fits a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return df


def keep_rows(docs: DataFrame, keys: list[Column], kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are in ``kept``, one row for each of them.

    ``kept`` has columns ``key0, key1, ...`` and ``copies``: how many rows of ``docs`` carry the key.
    Only keys that more than one row carries are shuffled a second time to leave one row.
    """
    names = [fresh(docs, f"row_key{i}") for i in range(len(keys))]
    theirs = [fresh(docs, f"kept{i}") for i in range(len(keys))]
    copies = fresh(docs, "row_copies")
    small = kept.select(*(F.col(f"key{i}").alias(n) for i, n in enumerate(theirs)), F.col("copies").alias(copies))
    wide = docs.withColumns(dict(zip(names, keys, strict=True)))
    same = [F.col(n).eqNullSafe(F.col(t)) for n, t in zip(names, theirs, strict=True)]
    met = wide.join(small, on=same, how="inner")
    once = met.filter(F.col(copies) == 1).select(*docs.columns)
    again = met.filter(F.col(copies) > 1).dropDuplicates(names).select(*docs.columns)
    return once.unionByName(again)
