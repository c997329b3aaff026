"""Packing documents into windows of fixed length by the sum-of-squares rule.

A document is cut into whole windows and a rest. Rests come in a seeded order, and each goes to the fill
level where the sum over levels of the squared number of partly filled windows is least afterwards; one
array of counts per level is the state. Documents are dealt by hash to groups of bounded size that pack
on their own. When a group ends, its few open windows are emptied into each other by cutting, so that at
most one window of a group is padded.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import small_batches, store

WINDOW = 2048
END = 1
#: Documents of a group on average.
GROUP = 20_000
#: Words whose ids a Python worker remembers; only speed depends on it.
REMEMBERED = 800_000
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordTokenizer:
    """Ids of a tokenizer that drops white space and treats the words between it on their own."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            special = [t["content"] for t in json.load(file)["added_tokens"]]
        if any(" " in s or "\n" in s for s in special):
            raise ValueError("a special token with white space: words are not independent")
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}

    def _encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if part not in self.parts:
            self.parts[part] = self._encode(part)
        return self.parts[part]

    def _word(self, word: str) -> bytes:
        simple = _SIMPLE.fullmatch(word)
        if not simple or "<|" in word:
            return self._encode(word)
        # Letters and marks behind them never join: both recur far more often than their pairs.
        return self._part(simple[1].lower()) + self._part(simple[2])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        words = text.replace("\n", " ").split(" ")
        while True:
            try:
                return b"".join(map(self.words.__getitem__, words))
            except KeyError:
                for cache in (self.words, self.parts):
                    if len(cache) > REMEMBERED:
                        cache.clear()
                        cache[""] = b""
                for word in set(words).difference(self.words):
                    self.words[word] = self._word(word)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_ids(text: Column, path: str, end: int = END) -> Column:
    """Ids of a text and the closing id, as binary little-endian 32-bit numbers; null counts as empty."""
    tail = int(end).to_bytes(4, "little")

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        tokenizer = _tokenizer(path)
        return pd.Series([(tokenizer.encode(t) if isinstance(t, str) else b"") + tail for t in texts])

    return encode(text)


def cut(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """A row per window or rest of a document, stored: ``row, doc_id, raw_hash, start, length, ids_crc32, doc_tokens``.

    ``row`` tells rows of ``docs`` apart, also equal ones.
    """
    tail = int(end).to_bytes(4, "little")

    @F.pandas_udf("doc_tokens long, crcs array<long>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        tokenizer, sizes, sums = _tokenizer(path), [], []
        for t in texts:
            ids = (tokenizer.encode(t) if isinstance(t, str) else b"") + tail
            sizes.append(len(ids) // 4)
            sums.append([zlib.crc32(ids[i : i + 4 * window]) for i in range(0, len(ids), 4 * window)])
        return pd.DataFrame({"doc_tokens": sizes, "crcs": sums})

    read = small_batches(docs).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("raw_hash"),
        measure(F.col(text)).alias("m"),
    )
    pieces = read.select("row", "doc_id", "raw_hash", "m.doc_tokens", F.posexplode("m.crcs").alias("nth", "ids_crc32"))
    start = (F.col("nth") * F.lit(window)).cast("long")
    length = F.least(F.lit(window).cast("long"), F.col("doc_tokens") - start)
    return store(pieces.select("row", "doc_id", "raw_hash", start.alias("start"), length.alias("length"), "ids_crc32", "doc_tokens"), "pieces")


def sum_of_squares(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Windows as lists of positions in ``lengths`` (all at most ``window``), by the sum-of-squares rule."""
    count = np.zeros(window + 1, dtype=np.int64)
    stacks: list[list[list[int]]] = [[] for _ in range(window)]
    closed = []
    for i, size in enumerate(lengths.tolist()):
        if size == window:
            closed.append([i])
            continue
        # Half the change of the sum: one window less at a level, one more at the level reached.
        change = count[size:] - count[: window + 1 - size] + 1.0
        change[count[: window + 1 - size] == 0] = np.inf
        change[0] = count[size] + 0.5
        if count[window - size]:
            change[-1] = 0.5 - count[window - size]
        level = int(change.argmin())
        if level:
            held = stacks[level].pop()
            count[level] -= 1
        else:
            held = []
        held.append(i)
        if level + size == window:
            closed.append(held)
        else:
            stacks[level + size].append(held)
            count[level + size] += 1
    return closed + [held for level in range(window - 1, 0, -1) for held in stacks[level]]


def filled(lengths: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(position, start in the piece, length)``; open windows are emptied into each other."""
    windows = [[(i, 0, int(lengths[i])) for i in held] for held in sum_of_squares(lengths, window)]
    levels = [sum(n for _, _, n in held) for held in windows]
    order = sorted(range(len(windows)), key=lambda w: -levels[w])
    first, last = 0, len(order) - 1
    while first < last:
        into, out = order[first], order[last]
        room = window - levels[into]
        if not room:
            first += 1
            continue
        i, start, length = windows[out].pop()
        moved = min(room, length)
        windows[into].append((i, start + length - moved, moved))
        if moved < length:
            windows[out].append((i, start, length - moved))
        levels[into] += moved
        levels[out] -= moved
        if not windows[out]:
            last -= 1
    return [held for held in windows if held]


def place(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces; a piece cut once more has a null ``ids_crc32``.

    The number of groups follows the number of pieces, so a group stays near ``group`` rows at any size.
    """
    groups = max(1, -(-pieces.count() // group))

    def pack(key: tuple[int], frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", "row", "start"], kind="stable", ignore_index=True)
        rows = [
            (key[0] * (1 << 32) + number, offset, i, start, length)
            for number, held in enumerate(filled(frame.length.to_numpy(), window))
            for offset, (i, start, length) in zip(np.cumsum([0] + [n for _, _, n in held]).tolist(), held, strict=False)
        ]
        at = pd.DataFrame(rows, columns=["sequence_id", "offset", "i", "from", "new"])
        out = frame.iloc[at.i].reset_index(drop=True)
        out["ids_crc32"] = out.ids_crc32.where(at.new == out.length).astype("Int64")
        out["start"] = out.start + at["from"]
        out["length"] = at.new
        out["sequence_id"], out["offset"] = at.sequence_id, at.offset
        return out.drop(columns=["group", "order"])

    keyed = pieces.withColumn("order", F.xxhash64("row", "start")).withColumn("group", F.pmod("order", F.lit(groups)))
    schema = f"{pieces.schema.toDDL()}, sequence_id long, offset long"
    return keyed.groupBy("group").applyInPandas(pack, schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end: int = END,
    group: int = GROUP,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, raw_hash``.

    Every row of ``docs`` is packed, equal ones too; null and empty texts are the closing id alone. An
    empty table gives no row. Only pieces that were cut to fill the last windows are read again, to sum
    their ids.
    """
    placed = store(place(cut(docs, path, doc_id, text, window, end), window, group), "placed")
    again = placed.filter("ids_crc32 is null").select(F.col("doc_id").alias("id"), F.col("raw_hash").alias("raw")).distinct()
    again = store(again, "cut-again")
    source = docs.select(F.col(doc_id).alias("id2"), F.col(text).alias("text")).withColumn("raw2", F.xxhash64("text"))
    met = source.join(again, F.col("id2").eqNullSafe(F.col("id")) & (F.col("raw2") == F.col("raw")), "left_semi")
    met = small_batches(met.dropDuplicates(["id2", "raw2"])).select("id2", "raw2", token_ids(F.col("text"), path, end).alias("ids"))
    parts = placed.filter("ids_crc32 is null").join(
        met, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("raw_hash") == F.col("raw2"))
    )
    piece = F.col("ids").substr((F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    parts = parts.withColumn("ids_crc32", F.crc32(piece))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "raw_hash"]
    return placed.filter("ids_crc32 is not null").select(*columns).unionByName(parts.select(*columns))


def sequences(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
              window: int = WINDOW, end: int = END, pad: int = 0) -> DataFrame:
    """The training windows: ``sequence_id, ids`` (padded to ``window`` unless a power of two long), ``used``.

    ``placed`` is a result of :func:`pack_documents` over ``docs``. A window holds at most ``window`` ids,
    so a group is bounded.
    """
    source = docs.select(F.col(doc_id).alias("id2"), F.col(text).alias("text")).withColumn("raw2", F.xxhash64("text"))
    source = small_batches(source.dropDuplicates(["id2", "raw2"])).select("id2", "raw2", token_ids(F.col("text"), path, end).alias("doc"))
    met = placed.join(source, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("raw_hash") == F.col("raw2")))
    piece = F.hex(F.col("doc").substr((F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
    one = met.groupBy("sequence_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("offset", piece.alias("piece"))))["piece"], "").alias("hex"),
        F.sum("length").alias("used"),
    )
    spot = F.sequence(F.lit(0), (F.length("hex") / 8 - 1).cast("int"))
    little = lambda i: F.substring(F.col("hex"), i * 8 + 1, F.lit(8))
    swapped = lambda h: F.concat(*(F.substring(h, p, 2) for p in (7, 5, 3, 1)))
    ids = F.transform(spot, lambda i: F.conv(swapped(little(i)), 16, 10).cast("int"))
    two = F.bin("used").rlike("^10*$")
    padding = F.array_repeat(F.lit(pad), F.when(two, F.lit(0)).otherwise(F.lit(window) - F.col("used")).cast("int"))
    return one.select("sequence_id", F.concat(ids, padding).alias("ids"), "used")
