"""Phrases that recur, found by sampling with a negative border, and how tightly their words belong together.

Words are counted in all documents. Of longer phrases, a sample of documents is mined level by level with a
lowered threshold: it proposes phrases. One pass over all documents then counts the proposed phrases
exactly, together with their negative border: all phrases that are not proposed although the phrase without
its first word and the one without its last word are. Where a phrase of the border turns out frequent,
phrases that contain it may be frequent as well and have not been counted; another pass counts what it newly
allows, until a pass brings no such failure. No phrase is counted in two passes.

The border is wide: most of its phrases occur once or twice. The pass therefore first adds up counts by a
hash of the phrase, which is never below the count of the phrase, and then counts by the words themselves
what can reach the threshold. Counts by hash travel sorted, as steps from one hash to the next in a row for
each range of hashes: two to three bytes a phrase. Counts by the words are first added up in the task, and
travel in a row for each language and range of hashes as well. What has been proposed, and what can reach it, are bit fields of bounded size
(:data:`MOST_BITS`), so that every task can hold them whatever the corpus. Phrases that share a bit are
counted without need, never left out.

Nulls: a null text is empty, a null ``lang`` counts as ``und``. A single text of any length is read in
stretches. Repeated rows count each time. Ties of scores are cut by count and phrase. Without documents, or
phrases, the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from varloom.llm.common import small_batches, store

#: Words of a phrase at most; times a phrase must occur; phrases of a language that are returned.
LONGEST, LEAST, TOP = 5, 100, 2_000
#: A document in so many is in the sample.
SAMPLED = 8
#: Times that a phrase must occur in the sample to be proposed: about a third of what is expected at LEAST.
PROPOSED = 4
#: Least and largest size of a bit field, as powers of two: 32 KB and 16 MB.
LEAST_BITS, MOST_BITS = 18, 27
#: Bytes of text that a task gathers before it counts: some two million words.
CHUNK = 12_000_000
#: Rows that a task sends at once.
ROWS = 50_000
#: Hashes of a range, as a power of two, and counts by hash that a task gathers before it sends them.
RANGE_BITS, SUMS = 22, 2_000_000
#: Counts by the words: how many ranges of hashes, as a power of two, and bytes that a task gathers.
PLACE_BITS, GATHERED = 10, 32_000_000
#: Parts in which the phrases of a language are ranked before the first ones of all parts are.
PARTS = 64
UNKNOWN = "und"

_STOP = b"\xff"  # never part of UTF-8
_BETWEEN = "\n"  # a stop, never part of a phrase
_TABLE = bytes(
    32 if i in (0x20, 0x09) else 0xFF if 0x0A <= i <= 0x0D or chr(i) in ".,;:!?" else i + 32 if 65 <= i <= 90 else i for i in range(256)
)
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _has(field: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of ``hashes`` are set; the size of a field is a power of two."""
    if field is None:
        return np.zeros(len(hashes), dtype=bool)
    slots = (hashes >> np.uint64(64 - (len(field).bit_length() + 2))).astype(np.int64)
    return (field[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def summed(parts: list[np.ndarray], hash_bits: int) -> np.ndarray:
    """Counts added up, ordered by hash. A count is one number: the hash above, how often it was met below."""
    low = np.uint64(64 - hash_bits)
    most = np.uint64((1 << (64 - hash_bits)) - 1)
    every = np.concatenate(parts)
    every.sort()
    keys = every >> low
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    every &= most
    return keys[first] << low | np.minimum(np.add.reduceat(every, first), most)


def _bytes_apart(numbers: np.ndarray) -> np.ndarray:
    """All lowest bytes, then all second ones, and so on: the upper ones are nearly all zero and compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def packed(counts: np.ndarray, hash_bits: int) -> pa.RecordBatch:
    """``range, sums``: what :func:`summed` gives, a row for each range of hashes."""
    keys = counts >> np.uint64(64 - hash_bits)
    times = np.minimum(counts & np.uint64((1 << (64 - hash_bits)) - 1), np.uint64((1 << 32) - 1))
    ranges = keys >> np.uint64(RANGE_BITS)
    first = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]]))
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[first] = keys[first] & np.uint64((1 << RANGE_BITS) - 1)
    steps, widths = _bytes_apart(steps)[:3], np.where(np.maximum.reduceat(times, first) < 256, 1, 4)
    times = _bytes_apart(times)
    rows = [
        bytes([width]) + steps[:, start:end].tobytes() + times[:width, start:end].tobytes()
        for width, start, end in zip(widths.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True)
    ]
    return pa.RecordBatch.from_arrays([pa.array(ranges[first].astype(np.int32)), pa.array(rows, pa.binary())], ["range", "sums"])


def unpacked(place: int, sums: bytes, hash_bits: int) -> np.ndarray:
    """The counts of one row of :func:`packed`."""
    parts = np.frombuffer(sums, dtype=np.uint8, offset=1).reshape(3 + sums[0], -1).astype(np.uint64)
    keys = (parts[0] | parts[1] << np.uint64(8) | parts[2] << np.uint64(16)).cumsum() + np.uint64(place << RANGE_BITS)
    times = parts[3]
    for k in range(1, sums[0]):
        times = times | parts[3 + k] << np.uint64(8 * k)
    return keys << np.uint64(64 - hash_bits) | times


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """The hash of each word as a phrase of ``lang``."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def longer_hashes(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """The hashes of phrases from those of all words but the last, and of the last."""
    mixed = (heads ^ (tails >> np.uint64(1))) * _FACTOR + tails
    return (mixed ^ (mixed >> np.uint64(29))) * _SPREAD


def hash_of(lang: str, phrase: str) -> np.ndarray:
    """The hash that counting gives a phrase, as an array of one."""
    hashes = word_hashes(lang, phrase.encode().split(b" "))
    whole = hashes[:1]
    for k in range(1, len(hashes)):
        whole = longer_hashes(whole, hashes[k : k + 1])
    return whole


@F.pandas_udf(LongType())
def phrase_hash(lang: pd.Series, phrase: pd.Series) -> pd.Series:
    """:func:`hash_of` for columns."""
    return pd.Series([int(hash_of(*both).view(np.int64)[0]) for both in zip(lang, phrase, strict=True)], dtype="int64")


@dataclass(frozen=True)
class Fields:
    """Bit fields of a pass.

    A phrase of several words is counted if its two parts of one word less are in ``now`` and not both in
    ``before``, what earlier passes built on; and, if ``possible`` is given, if it is in there itself.
    Counts by hash tell ``hash_bits`` apart, at most 35.
    """

    before: np.ndarray | None = None
    now: np.ndarray | None = None
    possible: np.ndarray | None = None
    hash_bits: int = LEAST_BITS + 8


class Counter:
    """Counts the phrases of texts, some millions of words at a time: by hash, or by the words themselves."""

    def __init__(self, fields: Fields, levels: range, by_hash: bool) -> None:
        self.fields, self.levels, self.by_hash = fields, levels, by_hash
        self.texts: dict[str, list[bytes]] = {}
        self.held, self.carried = 0, b""
        self.sums: list[np.ndarray] = []
        self.gathered = 0

    def add(self, text: bytes, lang: str) -> Iterator[pa.RecordBatch]:
        # Stops become words of their own.
        data, start, carried = text.translate(_TABLE).replace(_STOP, b" \xff "), 0, b""
        while len(data) - start > CHUNK:
            end = data.find(b" ", start + CHUNK)
            if end < 0:
                break
            # The last words also start phrases that are not complete yet.
            yield from self._count(lang, carried + data[start:end], LONGEST - 1)
            carried, start = self.carried, end
        self.texts.setdefault(lang, []).append(carried + data[start:])
        self.held += len(data) - start
        if self.held > CHUNK:
            yield from self.count()

    def count(self) -> Iterator[pa.RecordBatch]:
        """Counts of what has been gathered; forgets it."""
        texts, self.texts, self.held = self.texts, {}, 0
        for lang, parts in texts.items():
            yield from self._count(lang, b" \xff ".join(parts), 0)

    def end(self) -> Iterator[pa.RecordBatch]:
        """All that has not been sent."""
        yield from self.count()
        yield from self._send()

    def _send(self) -> Iterator[pa.RecordBatch]:
        parts, self.sums, self.gathered = self.sums, [], 0
        if parts:
            yield packed(summed(parts, self.fields.hash_bits), self.fields.hash_bits)

    def _gather(self, hashes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keeps counts by hash until there are many."""
        low = np.uint64(64 - self.fields.hash_bits)
        most = (1 << (64 - self.fields.hash_bits)) - 1
        self.sums.append(hashes >> low << low | np.minimum(times, most).astype(np.uint64))
        self.gathered += len(hashes)
        if self.gathered > SUMS:
            yield from self._send()

    def _count(self, lang: str, data: bytes, open_words: int) -> Iterator[pa.RecordBatch]:
        """Counts of phrases but those that start in the last ``open_words``, which go to ``carried``."""
        words = pc.list_flatten(pc.split_pattern(pa.array([data], pa.large_binary()), pattern=b" ")).dictionary_encode()
        told, stop, nothing = words.dictionary, pa.scalar(_STOP, pa.large_binary()), pa.scalar(b"", pa.large_binary())
        named = pc.and_(pc.not_equal(told, stop), pc.not_equal(told, nothing)).to_numpy(zero_copy_only=False)
        # Words count from 1; a stop is 0.
        number = np.where(named, np.cumsum(named), 0).astype(np.int32)
        stream = words.indices.to_numpy()
        empty = pc.index(told, nothing).as_py()
        stream = number[stream[stream != empty] if empty >= 0 else stream]
        names = pa.concat_arrays([pa.array([b""], pa.large_binary()), told.filter(pa.array(named))])
        del words, told
        if open_words:
            tail = names.take(pa.array(stream[-open_words:])).to_pylist()
            self.carried = b" ".join(w or _STOP for w in tail) + b" "
        size, starts = len(names), max(0, len(stream) - open_words)
        stream = np.concatenate([stream, np.zeros(LONGEST, dtype=np.int32)])
        hashes = word_hashes(lang, names.to_pylist())
        fields = self.fields
        if 1 in self.levels:
            times = np.bincount(stream[:starts], minlength=size)
            times[0] = 0
            if not self.by_hash and times.any():
                yield self._batch(lang, pa.array([b""], pa.large_binary()), times.sum(keepdims=True), np.zeros(1, dtype=np.uint64))
            yield from self._told(lang, 1, names, hashes, times, np.arange(size)[:, None])
        phrases, whole, met = np.arange(size, dtype=np.int32)[:, None], hashes, np.ones(size, dtype=bool)
        # Of each place: the number of the phrase that starts there, 0 where none of interest does.
        number = stream
        for level in range(2, max(self.levels) + 1):
            usable, old = _has(fields.now, whole), _has(fields.before, whole) & met
            usable[0] = False
            at = np.flatnonzero(usable[number[:-1]] & usable[number[1:]])
            if not len(at):
                return
            left = number[at]
            inverse, codes = pd.factorize(left.astype(np.int64) * size + stream[at + level - 1])
            inverse = inverse.astype(np.int32)
            # Whether an earlier pass has counted it.
            met = np.zeros(len(codes) + 1, dtype=bool)
            met[inverse + 1] = old[left] & old[number[at + 1]]
            heads, tails = codes // size, codes % size
            phrases = np.concatenate([np.zeros((1, level), dtype=np.int32), np.column_stack([phrases[heads], tails.astype(np.int32)])])
            whole = np.concatenate([np.zeros(1, dtype=np.uint64), longer_hashes(whole[heads], hashes[tails])])
            number = np.zeros(len(number) - 1, dtype=np.int32)
            number[at] = inverse + 1
            if level in self.levels:
                times = np.bincount(inverse[at < starts] + 1, minlength=len(codes) + 1)
                times[met] = 0
                yield from self._told(lang, level, names, whole, times, phrases)

    def _told(self, lang: str, level: int, names: pa.Array, hashes: np.ndarray, times: np.ndarray, phrases: np.ndarray) -> Iterator[pa.RecordBatch]:
        seen = np.flatnonzero(times)
        if self.fields.possible is not None:
            seen = seen[_has(self.fields.possible, hashes[seen])]
        if self.by_hash:
            # Some bits more than a field has tell phrases apart well enough here, and are less to send.
            yield from self._gather(hashes[seen], times[seen])
            return
        for start in range(0, len(seen), ROWS):
            rows = seen[start : start + ROWS]
            words = [names.take(pa.array(phrases[rows, k])) for k in range(level)]
            texts = words[0] if level == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))
            yield self._batch(lang, texts, times[rows], hashes[rows])

    def _batch(self, lang: str, texts: pa.Array, times: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array((hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int32)),
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(texts), dtype=np.int32))),
                texts.cast(pa.large_string()).cast(pa.string()),
                pa.array(times.astype(np.int64)),
            ],
            ["range", "lang", "phrase", "f"],
        )


def added(counts: pa.Table) -> pa.Table:
    """``range, lang, phrase, f`` with the counts of each phrase added up."""
    return counts.group_by(["range", "lang", "phrase"], use_threads=False).aggregate([("f", "sum")]).rename_columns(["range", "lang", "phrase", "f"])


def joined(counts: pa.Table) -> pa.RecordBatch:
    """``range, lang, phrases, times``: what :func:`added` gives, a row for each range and language."""
    counts = counts.sort_by([(c, "ascending") for c in ("range", "lang", "phrase")]).combine_chunks()
    ranges, langs, phrases, times = (c.combine_chunks() for c in counts.columns)
    codes = langs.dictionary_encode().indices.to_numpy()
    same = (np.diff(ranges.to_numpy()) == 0) & (np.diff(codes) == 0)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    starts = pa.array(np.append(first, len(codes)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ranges.take(pa.array(first)),
            langs.take(pa.array(first)),
            pc.binary_join(pa.ListArray.from_arrays(starts, phrases), _BETWEEN),
            pa.ListArray.from_arrays(starts, times),
        ],
        ["range", "lang", "phrases", "times"],
    )


def separate(rows: pa.RecordBatch) -> pa.Table:
    """The counts of rows of :func:`joined`."""
    lists = pc.split_pattern(rows["phrases"], pattern=_BETWEEN)
    of = pc.list_parent_indices(lists)
    return pa.table([rows["range"].take(of), rows["lang"].take(of), pc.list_flatten(lists), pc.list_flatten(rows["times"])], ["range", "lang", "phrase", "f"])


def _counted(docs: DataFrame, fields: Broadcast, levels: range, by_hash: bool) -> DataFrame:
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(fields.value, levels, by_hash)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                value = text.as_py()
                if value:
                    yield from counter.add(value.encode(), lang.as_py())
        yield from counter.end()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in counts(batches):
            parts.append(pa.table(part))
            held += part.nbytes
            if held > GATHERED:
                parts = [added(pa.concat_tables(parts))]
                held = parts[0].nbytes
                if 2 * held > GATHERED:
                    yield joined(parts[0])
                    parts, held = [], 0
        if parts:
            yield joined(added(pa.concat_tables(parts)))

    texts = small_batches(docs.select("lang", "text"))
    if by_hash:
        return texts.mapInArrow(counts, "range int, sums binary")
    return texts.mapInArrow(run, "range int, lang string, phrases string, times array<long>")


def frequent_hashes(docs: DataFrame, fields: Broadcast, levels: range, least: int) -> DataFrame:
    """``h``: hashes met ``least`` times or more. No phrase occurs more often than its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = fields.value.hash_bits
        low, most = np.uint64(64 - bits), np.uint64((1 << (64 - bits)) - 1)
        place, parts, held = None, [], 0

        def often() -> pa.RecordBatch:
            counts = summed(parts, bits)
            found = counts[(counts & most) >= least] >> low << low
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

        for batch in batches:
            for this, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if this != place and parts:
                    yield often()
                    parts, held = [], 0
                place = this
                parts.append(unpacked(this, sums.as_py(), bits))
                held += len(parts[-1])
                # A range has no more different hashes than half of this.
                if held > 2 << RANGE_BITS:
                    parts = [summed(parts, bits)]
                    held = len(parts[0])
        if parts:
            yield often()

    ranges = _counted(docs, fields, levels, True).repartition("range").sortWithinPartitions("range")
    return ranges.mapInArrow(run, "h long")


def count_phrases(docs: DataFrame, fields: Broadcast, levels: range, least: int) -> DataFrame:
    """``lang, words, phrase, f, known``: counts by the phrase itself, exact, of ``least`` or more."""

    def often(counts: pa.Table) -> pa.RecordBatch:
        found = counts.filter(pc.greater_equal(counts["f"], least)).combine_chunks()
        langs, phrases = found["lang"].to_pylist(), found["phrase"].to_pylist()
        hashes = [hash_of(*both) for both in zip(langs, phrases, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array([len(p.split(" ")) if p else 0 for p in phrases], pa.int32()),
                pa.array(phrases, pa.string()),
                pa.array(found["f"].to_numpy()),
                pa.array(_has(fields.value.now, np.concatenate([np.zeros(0, dtype=np.uint64), *hashes]))),
            ],
            ["lang", "words", "phrase", "f", "known"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the range and language that the rows before ended with: there may be more.
        open_ = None
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = separate(batch)
            counts = added(counts if open_ is None else pa.concat_tables([open_, counts]))
            last = pc.and_(pc.equal(counts["range"], batch["range"][-1]), pc.equal(counts["lang"], batch["lang"][-1]))
            yield often(counts.filter(pc.invert(last)))
            open_ = counts.filter(last)
        if open_ is not None:
            yield often(open_)

    rows = _counted(docs, fields, levels, False).repartition("range", "lang").sortWithinPartitions("range", "lang")
    return rows.mapInArrow(run, "lang string, words int, phrase string, f long, known boolean")


def bit_field(phrases: DataFrame, bits: int, base: np.ndarray | None = None) -> np.ndarray:
    """``base`` with the bits of ``phrases``: at most one row for every 64 bits of the field comes to the driver."""
    slot = F.shiftrightunsigned("h", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = phrases.select((slot / 64).cast("int").alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    table = words.toArrow()
    field = np.zeros(1 << (bits - 6), dtype="<i8") if base is None else base.view("<i8").copy()
    field[table["place"].to_numpy()] |= table["bits"].to_numpy()
    return field.view(np.uint8)


def field_bits(sample: DataFrame) -> int:
    """Size of a field for a sample: a bit for every byte of its text, between the bounds."""
    size = sample.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(MOST_BITS, max(LEAST_BITS, size.bit_length()))


def frequent_phrases(docs: DataFrame, least: int = LEAST, sampled: int = SAMPLED, proposed: int = PROPOSED) -> DataFrame:
    """``lang, words, phrase, f``: all phrases of 1 to :data:`LONGEST` words that occur ``least`` times or more.

    Also one empty phrase of 0 words for each language: how many words it has, if ``least`` or more.

    The result does not depend on ``sampled`` (a document in so many is in the sample) and ``proposed``
    (times a phrase occurs there to be proposed); only the number of passes does.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    sample = store(texts.filter(F.rand(7) * sampled < 1), "phrases-sample")
    bits = field_bits(sample)

    def possible_in(docs: DataFrame, levels: range, now: np.ndarray | None, least: int, base: np.ndarray | None = None) -> np.ndarray:
        sent = context.broadcast(Fields(now=now, hash_bits=bits + 8))
        field = bit_field(frequent_hashes(docs, sent, levels, least), bits, base)
        sent.destroy()
        return field

    now = words = possible_in(texts, range(1, 2), None, least)
    for level in range(2, LONGEST):
        now = possible_in(sample, range(level, level + 1), now, proposed, now)
    levels = range(1, LONGEST + 1)
    possible = possible_in(texts, range(2, LONGEST + 1), now, least, words)
    counted, before = [], None
    while True:
        sent = context.broadcast(Fields(before, now, possible))
        found = store(count_phrases(texts, sent, levels, least), "phrases-pass")
        sent.destroy()
        counted.append(found)
        failed = found.filter(~F.col("known") & F.col("words").between(1, LONGEST - 1)).select(phrase_hash("lang", "phrase").alias("h"))
        if failed.isEmpty():
            break
        # What a failure allows is little, so it is counted by its words at once.
        before, now, possible, levels = now, bit_field(failed, bits, now), None, range(2, LONGEST + 1)
    every = counted[0]
    for found in counted[1:]:
        every = every.unionByName(found)
    return every.select("lang", "words", "phrase", "f")


def _part(phrase: Column, first: Column, size: Column | None = None) -> Column:
    words = F.split(phrase, " ")
    return F.array_join(F.slice(words, first, F.size(words) if size is None else size), " ")


def scored_phrases(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score``: of all cuts of each phrase, the one with the lowest score.

    The score of a cut is floor(1000 a n / (l r)) in whole numbers, equal scores go to the shortest first
    part. Phrases inside a longer one that occurs as often are left out.
    """
    several = phrases.filter(F.col("words") > 1)
    inside = several.filter(F.col("words") > 2).select(
        "lang",
        F.explode(F.array(_part(F.col("phrase"), F.lit(1), F.col("words") - 1), _part(F.col("phrase"), F.lit(2)))).alias("phrase"),
        F.col("f").alias("longer"),
    )
    # As counts only fall with length, one word more decides for all longer phrases.
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = several.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("f"))).drop("longer")
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": _part(F.col("phrase"), F.lit(1), F.col("k")), "rest": _part(F.col("phrase"), F.col("k") + 1)})
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    totals = phrases.filter(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    # A row for each language, so that no task gets all phrases of one.
    met = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(F.broadcast(totals), "lang")
    # Up to 38 digits, without rounding.
    over = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(16,0)") * F.col("n").cast("decimal(16,0)")
    under = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    met = met.withColumn("score", F.call_function("div", over, under))
    least = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    return met.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    scored = scored_phrases(frequent_phrases(docs, least))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # What is among the first of a language is among the first of its part.
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
