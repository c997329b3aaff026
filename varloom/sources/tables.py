"""Gene features, gene-function tables, sample tables and stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions.text import reloaded
from varloom.params import NAME_COLUMNS
from varloom.sources.files import in_file_order

GFF_SCHEMA = (
    "CHROM string, Source string, Type string, Start bigint, End bigint, "
    "Score string, Strand string, Phase string, Attributes string"
)

# Type names of a column-type table.
COLUMN_TYPES = {
    "character": T.StringType(),
    "numeric": T.DoubleType(),
    "integer": T.IntegerType(),
    "logical": T.BooleanType(),
    "factor": T.StringType(),
    "Date": T.DateType(),
}


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GFF3 file, with ``_row`` in file order."""
    rows = spark.read.schema(GFF_SCHEMA).csv(path, sep="\t", comment="#", quote="")
    return in_file_order(rows, "_row")


def read_annotation_table(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A gene-function table with ``_row`` in file order; ``#`` is taken off the column names.

    ``\\N`` is missing; in the GO table empty and ``NA`` are, instead. An empty file is a table without rows.
    """
    lines = spark.read.text(path)
    head = lines.first()
    if head is None:
        return spark.createDataFrame([], f"_row bigint, proteinId string, {NAME_COLUMNS[source]} string")
    first = head["value"]
    names = [n.strip('"').replace("#", "") for n in first.split("\t")]
    numbered = in_file_order(lines, "_row")
    parts = numbered.filter(F.col("value") != first).select("_row", F.split("value", "\t").alias("_f"))

    def field(i: int):
        text = F.regexp_replace(F.get("_f", F.lit(i)), '^"(.*)"$', "$1")
        return reloaded(text) if source == "GO" else F.nullif(text, F.lit("\\N"))

    return parts.select("_row", *[field(i).alias(n) for i, n in enumerate(names)])


def discover_annotation_tables(spark: SparkSession, folder: str, prefix: str) -> dict[str, DataFrame]:
    """The ``<prefix>*_GO.*.tab.gz``, ``_IPR.``, ``_KEGG.`` and ``_KOG.`` tables of a folder."""
    return {
        source: read_annotation_table(spark, f"{folder}/{prefix}*_{source}.*tab.gz", source)
        for source in NAME_COLUMNS
    }


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV with header; all columns are text unless a schema is given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.csv(path, header=True)


def read_ids(spark: SparkSession, path: str, name: str = "SampleID") -> DataFrame:
    """One ID per line, sorted."""
    ids = spark.read.text(path).select(F.trim("value").try_cast("bigint").alias(name))
    return ids.orderBy(name)


def typed_schema(types: dict[str, str]) -> T.StructType:
    """Schema from column-type names; unknown names are text."""
    return T.StructType([T.StructField(c, COLUMN_TYPES.get(t, T.StringType())) for c, t in types.items()])


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str | dict[str, str]) -> DataFrame:
    """A stored TSV, read with declared types."""
    declared = typed_schema(schema) if isinstance(schema, dict) else schema
    return spark.read.schema(declared).csv(path, sep="\t", header=True, nullValue="NA")


def write_tsv(df: DataFrame, path: str, header: bool = True, compressed: bool = False) -> None:
    """Write a TSV; missing values show as ``NA``."""
    writer = df.write.option("sep", "\t").option("nullValue", "NA").option("emptyValue", "")
    writer.csv(path, header=header, compression="gzip" if compressed else "none")


NUMBER = r"^[+-]?(?:(?:0|[1-9][0-9]*)(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to boolean or double where every value allows it.

    Empty text and ``NA`` are missing. A number has no leading zeros and no suffix: ``007`` and ``12d``
    are codes and stay text. One pass over the data gives two flags per column.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    logical = ["T", "F", "TRUE", "FALSE", "true", "false", "True", "False"]
    tests = []
    for i, name in enumerate(texts):
        value = reloaded(F.col(f"`{name}`"))
        tests.append(F.bool_and(value.isin(logical)).alias(f"l{i}"))
        tests.append(F.bool_and(value.isNull() | value.rlike(NUMBER)).alias(f"n{i}"))
    seen = df.agg(*tests).first()
    out = {}
    for i, name in enumerate(texts):
        value = reloaded(F.col(f"`{name}`"))
        if seen[f"l{i}"]:
            out[name] = value.try_cast("boolean")
        elif seen[f"n{i}"]:
            out[name] = value.try_cast("double")
        else:
            out[name] = value
    return df.withColumns(out)
