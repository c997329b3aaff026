"""Exact deduplication by recipes of content-defined chunks.

A text is normalised (white space deleted) and cut where its content says so, so that equal passages
give equal chunks whatever stands before them. Chunks are deduplicated once over the corpus by their
whole content: two contents under one digest get different identifiers. A document is then its list of
identifiers, its recipe, and recipes alone are compared: long texts are not moved again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import SPACE, keep_rows, store

#: Shortest and longest chunk in code points.
LEAST, MOST = 256, 4096
#: A chunk ends behind four letters of these classes: one place in some hundreds of running text.
CUT = "(?<=[aeiouäéñ][bdlnrsö][aeiou][hnst])"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def chunks(norm: Column, least: int = LEAST, most: int = MOST, cut: str = CUT) -> Column:
    """Chunks of a normalised text, in order; joined they are the text. An empty text has none."""
    return F.regexp_extract_all(norm, F.lit(f"(?s).{{{least},{most}}}?{cut}|.{{1,{most}}}"), F.lit(0))


def _digest(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk))


def collided(docs: DataFrame, text: str = "text", digest=_digest) -> DataFrame:
    """``(print, chunk, nth)`` of chunks whose digest another content has too; normally no row.

    Contents are made distinct inside each task before they are shuffled, so one in every document costs
    one row per task.
    """
    cut = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    distinct = cut.withColumn("print", digest(F.col("chunk"))).groupBy("print", "chunk").agg(F.lit(1).alias("one"))
    shared = distinct.groupBy("print").agg(F.count("*").alias("contents")).filter("contents > 1")
    if digest is _digest and shared.isEmpty():
        return docs.sparkSession.createDataFrame([], "print binary, chunk string, nth int")
    met = distinct.join(shared, "print").select("print", "chunk")
    return met.withColumn("nth", F.row_number().over(Window.partitionBy("print").orderBy("chunk")))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=_digest) -> DataFrame:
    """A row per distinct ``(doc_id, text)`` content: ``doc_id, length, text_sha256, raw_hash, recipe, copies``.

    ``recipe`` is the ordered list of verified chunk identifiers, ``length`` counts code points of the
    original text, ``copies`` the rows that agree in all of these.
    """
    norm = normalised(F.col(text))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("norm", norm)
    rows = base.select(
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).alias("length"),
        F.sha2("norm", 256).alias("text_sha256"),
        F.xxhash64("text").alias("raw_hash"),
        F.transform(chunks(F.col("norm")), digest).alias("recipe"),
    )
    found = collided(docs, text, digest)
    if not found.isEmpty():
        # Contents that share a digest: their documents get identifiers with a number behind the digest.
        bad = found.select("print", "chunk", "nth")
        place = base.select("doc_id", "text", F.posexplode(chunks(F.col("norm"))).alias("at", "chunk"))
        named = place.withColumn("print", digest(F.col("chunk"))).join(bad, ["print", "chunk"], "left")
        number = F.coalesce(F.lpad(F.hex("nth"), 8, "0"), F.lit(""))
        named = named.withColumn("id", F.unhex(F.concat(F.hex("print"), number)))
        lists = named.select("doc_id", F.xxhash64("text").alias("raw_hash"), "at", "id").distinct()
        lists = lists.groupBy("doc_id", "raw_hash").agg(F.array_sort(F.collect_list(F.struct("at", "id")))["id"].alias("named"))
        key = rows.doc_id.eqNullSafe(lists.doc_id) & (rows.raw_hash == lists.raw_hash)
        rows = rows.join(lists, key, "left").select(
            rows.doc_id, "length", "text_sha256", rows.raw_hash, F.coalesce("named", "recipe").alias("recipe")
        )
    same = rows.groupBy("doc_id", "length", "text_sha256", "raw_hash", "recipe").agg(F.count("*").alias("copies"))
    return store(same, "recipes")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=_digest) -> DataFrame:
    """The rows of :func:`recipes` with ``keep_id``, ``keep_hash`` and ``group_size``.

    Equal recipes form a group. The longest original text stays, then the smallest id (a null id comes
    last), then the lowest hash of the original text. Null and empty texts are one group; an empty table
    gives no row. Sizes and the choice are combined before the shuffle, so a group may hold any share of
    the rows.
    """
    rows = recipes(docs, doc_id, text, digest)
    order = F.struct(
        (-F.col("length")).alias("length"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"),
        F.col("raw_hash").alias("raw_hash"),
    )
    best = rows.groupBy("recipe").agg(F.min(order).alias("best"), F.sum("copies").alias("group_size"))
    best = best.select(
        F.col("recipe"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.raw_hash").alias("keep_hash"),
        (-F.col("best.length")).alias("keep_length"),
        "group_size",
    )
    # Stored, so that the join deals both sides itself and can split a recipe that very many rows have.
    met = rows.join(store(best, "recipe-groups"), "recipe")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("raw_hash") == F.col("keep_hash"))
    return met.withColumn("stays", stays & (F.col("length") == F.col("keep_length")))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows that agree in id and text one is kept.
    """
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    rows = exact_groups(docs, doc_id, text).withColumn("nth", each)
    kept = (F.col("stays") & (F.col("nth") == 1)).alias("kept")
    return rows.select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    kept = exact_groups(docs, doc_id, text).filter("stays")
    kept = kept.select(F.col("doc_id").alias("key0"), F.col("raw_hash").alias("key1"), "copies")
    return keep_rows(docs, [F.col(doc_id), F.xxhash64(F.col(text))], kept)
