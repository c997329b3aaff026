"""Ranked search of a query set over all documents by dense products of blocks.

Items come in blocks of bounded size. For a block, the words of its items are its vocabulary. Each
document is reduced to the vocabulary words it has; impacts of a tile of documents form one dense matrix,
weights of the items another, and BLAS multiplies them in float64. Vocabulary tiles are cut so that no
sum in a product can reach 2**53: every product is exact, and tiles are added as 64-bit integers. A task
keeps the best of each item over its tiles, ties by id; a second step joins what tasks have kept.

Nulls: a null text has no word, so such documents count nowhere and such items find nothing. A null
``doc_id`` sorts last among equal scores, a null ``item_id`` is an item of its own. Rows that share an
``item_id`` are one item with all their words; rows of one ``doc_id`` are ranked each on its own. Very long
texts are read in segments. Without documents or items the result is empty. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import small_batches, store

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
#: Words of all items of a block, with repeats; an item with more has a block of its own.
BLOCK_WORDS = 50_000
#: Items of a block at most. With the bound above, no set of tiles is larger than about 100 MB.
BLOCK_ITEMS = 256
#: Vocabulary words and documents of a tile.
TILE_WORDS, TILE_DOCS = 1_024, 512
#: No impact is larger: 10**9 tf div (1000 tf + 12 m).
LARGEST_IMPACT = 10**6
#: Sums of weights of a tile that stay exact when multiplied by impacts.
EXACT = (2**53 - 1) // LARGEST_IMPACT
#: Parts of the first of the two steps that join the best of all tasks.
PARTS = 64
SEGMENT = 1 << 22

_BLANKED = bytes(
    i + 32 if 65 <= i <= 90 else i if i >= 128 or chr(i).isalnum() else 32 for i in range(256)
)


def terms(text: Column) -> Column:
    """Words of a text in order; only A-Z become small letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(f"({TERM})"))


def segments(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded stretch at a time; words are never cut."""
    data, start = data.translate(_BLANKED), 0
    while start < len(data):
        end = start + SEGMENT
        if end < len(data):
            end = data.find(b" ", end)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, q``: words of every item with their number."""
    return items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("q"))


def item_blocks(words: DataFrame) -> DataFrame:
    """``words`` with ``block``: items in order of their ids fill blocks; one beyond :data:`BLOCK_WORDS` stands alone.

    The running sum sees one short row per item.
    """
    size = words.groupBy("item_id").agg(F.sum("q").alias("size"))
    order = Window.orderBy(F.col("item_id").asc_nulls_first())
    alone = F.col("size") > BLOCK_WORDS
    placed = size.withColumns({"upto": F.sum(F.when(alone, 0).otherwise(F.col("size"))).over(order), "nth": F.row_number().over(order)})
    shared = F.concat_ws(" ", F.floor(F.col("upto") / BLOCK_WORDS), F.floor(F.col("nth") / BLOCK_ITEMS))
    block = F.when(alone, F.concat(F.lit("alone "), F.col("nth"))).otherwise(shared)
    placed = placed.select(F.col("item_id").alias("item"), block.alias("block"))
    return words.join(placed, words["item_id"].eqNullSafe(placed["item"])).drop("item")


def read_documents(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, n, terms, tf``: number of words of each document, and those of the vocabulary it has."""
    place = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(vocabulary)})
    width = len(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = place.value.get
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in batch.column(1):
                value = text.as_py()
                n, seen = 0, []
                for words in segments(value.encode()) if value else ():
                    n += len(words)
                    held = [i for i in map(get, words) if i is not None]
                    if held:
                        seen.append(np.unique(np.array(held, dtype=np.int32), return_counts=True))
                if len(seen) > 1:
                    total = np.zeros(width, dtype=np.int64)
                    for i, c in seen:
                        total[i] += c
                    seen = [(np.flatnonzero(total).astype(np.int32), total[total > 0])]
                sizes.append(n)
                found.append(seen[0][0] if seen else [])
                counts.append(seen[0][1] if seen else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(read, f"doc_id {kind}, n long, terms array<int>, tf array<long>")


def tiles(items: list[tuple[int, int, int]], n_items: int, weights: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vocabulary tiles: ``(word numbers, matrix of words by items)``.

    ``items`` has ``(word number, item number, repeats)``. An entry is the weight of the word times its
    repeats; one beyond :data:`EXACT` is cut into several columns.
    """
    columns: list[tuple[int, dict[int, int]]] = []
    by_word: dict[int, dict[int, int]] = {}
    for word, item, q in items:
        by_word.setdefault(word, {})[item] = weights[word] * q
    for word in sorted(by_word):
        left = {i: v for i, v in by_word[word].items() if v}
        while left:
            columns.append((word, {i: min(v, EXACT) for i, v in left.items()}))
            left = {i: v - EXACT for i, v in left.items() if v > EXACT}
    out, held, sums = [], [], np.zeros(n_items, dtype=np.int64)

    def close() -> None:
        if held:
            matrix = np.zeros((len(held), n_items))
            for row, (_, entries) in enumerate(held):
                matrix[row, list(entries)] = list(entries.values())
            out.append((np.array([w for w, _ in held], dtype=np.int64), matrix))

    for word, entries in columns:
        places, values = list(entries), np.array(list(entries.values()), dtype=np.int64)
        if len(held) >= TILE_WORDS or (sums[places] + values > EXACT).any():
            close()
            held, sums = [], np.zeros(n_items, dtype=np.int64)
        held.append((word, entries))
        sums[places] += values
    close()
    return out


def best(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest positive scores; equal ones by id, null ids last."""
    places = np.flatnonzero(scores > 0)
    if len(places) > top:
        least = np.partition(scores[places], len(places) - top)[len(places) - top]
        # All that tie with the last one stay until ids decide.
        places = places[scores[places] >= least]
    order = np.lexsort((ids[places], missing[places], -scores[places]))
    return places[order[:top]]


def score_documents(read: DataFrame, cut: list[tuple[np.ndarray, np.ndarray]], n_items: int, docs: int, words: int, top: int) -> DataFrame:
    """``item, doc_id, score``: the best of each item in every task."""
    sent = read.sparkSession.sparkContext.broadcast(cut)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = sent.value
        kept_scores = [np.empty(0, dtype=np.int64)] * n_items
        kept_ids = [np.empty(0, dtype=np.int64)] * n_items
        kept_missing = [np.empty(0, dtype=bool)] * n_items
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(start, TILE_DOCS)
                rows = part.num_rows
                missing = np.asarray(part.column(0).is_null().to_numpy(zero_copy_only=False))
                ids = part.column(0).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                lengths = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                at = np.repeat(np.arange(rows), lengths)
                term, tf = part.column(2).flatten().to_numpy(zero_copy_only=False), part.column(3).flatten().to_numpy(zero_copy_only=False)
                m = 75 + (25 * n * docs) // max(words, 1)
                impact = (10**9 * tf) // (1000 * tf + 12 * m[at])
                order = np.argsort(term, kind="stable")
                at, term, impact = at[order], term[order], impact[order]
                total = np.zeros((rows, n_items), dtype=np.int64)
                for held, matrix in columns:
                    lo, hi = np.searchsorted(term, [held[0], held[-1] + 1])
                    column = np.searchsorted(held, term[lo:hi])
                    inside = held[column] == term[lo:hi]
                    dense = np.zeros((rows, len(held)))
                    dense[at[lo:hi][inside], column[inside]] = impact[lo:hi][inside]
                    total += (dense @ matrix).astype(np.int64)
                for item in range(n_items):
                    floor = kept_scores[item][-1] if len(kept_scores[item]) == top else 1
                    near = np.flatnonzero(total[:, item] >= floor)
                    if len(near):
                        scores = np.concatenate([kept_scores[item], total[near, item]])
                        all_ids = np.concatenate([kept_ids[item], ids[near]])
                        all_missing = np.concatenate([kept_missing[item], missing[near]])
                        keep = best(scores, all_ids, all_missing, top)
                        kept_scores[item], kept_ids[item], kept_missing[item] = scores[keep], all_ids[keep], all_missing[keep]
        sizes = [len(k) for k in kept_scores]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(n_items), sizes), pa.int32()),
                    pa.array(np.concatenate(kept_ids), pa.int64(), mask=np.concatenate(kept_missing)),
                    pa.array(np.concatenate(kept_scores), pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return read.mapInArrow(score, "item int, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of every item: ``item_id, rank, doc_id, score``.

    A word weighs floor(1000 ln((2N+2)/(2df+1))), N documents with a word, df documents with this one; a
    document gives it 10**9 tf div (1000 tf + 12 m) with m = 75 + (25 n N div L), n words in the
    document, L in all. ``doc_id`` is a whole number.
    """
    spark = docs.sparkSession
    words = store(item_blocks(item_terms(items)), "search-items")
    blocks = [r.block for r in words.select("block").distinct().orderBy("block").collect()]
    kind = items.schema["item_id"].dataType.simpleString()
    ranked = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    last = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for block in blocks:
        # Bounded by BLOCK_WORDS and BLOCK_ITEMS.
        rows = words.filter(F.col("block") == block).select("item_id", "term", "q").collect()
        vocabulary = sorted({r.term for r in rows})
        names = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
        place, number = {t: i for i, t in enumerate(vocabulary)}, {x: i for i, x in enumerate(names)}
        read = store(read_documents(docs, vocabulary), "search-documents")
        size = read.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for term, held in read.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
            df[term] = held
        weights = [math.floor(1000 * math.log((2 * size.docs + 2) / (2 * held + 1))) for held in df.tolist()]
        cut = tiles([(place[r.term], number[r.item_id], r.q) for r in rows], len(names), weights)
        scored = score_documents(read, cut, len(names), size.docs, size.words, top)
        # First the best of each part, so that no task sees what all tasks have kept of an item.
        some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))).orderBy(*last)))
        best_of = some.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*last)))
        listed = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kind}")
        ranked = ranked.unionByName(best_of.filter(F.col("rank") <= top).join(F.broadcast(listed), "item").select("item_id", "rank", "doc_id", "score"))
    return ranked
