"""Near duplicates by improved consistent weighted sampling of TF-IDF word shingles.

A document is a set of shingles of five words, each weighing ``(1 + ln tf) * idf``. Samples drawn by
improved consistent weighted sampling agree with the probability of the weighted Jaccard similarity.
Samples are joined into bands; documents that share a band are candidates, and the similarity of
candidates is then computed exactly from their whole texts.

idf is 1 for shingles of up to ``RARE`` of the documents and falls with the logarithm of the document
frequency to 0.8 for a shingle of every document. Frequencies above that share are exact: a first
pass counts all shingles into hashed bins, a second counts the shingles of full bins one by one. The
list of them is bounded by the mean number of shingles of a document over ``RARE``, whatever the size
of the corpus.

Equal word sequences are one node from the start. Two documents are candidates if they share a band and
no more of all their samples differ than is likely at the threshold. In a band's bucket every member is
compared with the hub, the member that meets most others. Members of buckets that then hold more than
one class are joined on the rarest shingles of their texts, which any two similar ones share, across
classes only. So every two candidates that are similar are compared or already in one class, and neither
groups of copies nor texts around a common passage pair off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.llm.common import keep_rows, small_batches, store
from varloom.llm.links import connected

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
RARE = 0.01
#: idf of a shingle of every document. Damped, so that similarities stay near those of plain sets.
LEAST_IDF = 0.8
#: Samples of the finer sketches of nodes that are compared across classes.
FINE = 1024
#: Prefixes of up to so many shingles are compared to find the first one shared.
SHORT = 256
BIN_BITS = 18
#: Characters of texts whose words are hashed together, and bytes of a step.
TOGETHER, SLICE = 1_000_000, 1 << 19
TABLE_BITS, TABLES, MOST_SAMPLES = 14, 64, 4096

#: Standard deviations below the expected agreement at the threshold where a pair stops being a candidate.
SIGMAS = 4.0

_SIGNATURE = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)


@dataclass(frozen=True)
class Frequent:
    """Shingles of more than ``RARE`` of the documents, sorted, and their idf."""

    shingles: np.ndarray
    idf: np.ndarray


NONE = Frequent(np.zeros(0, np.uint64), np.zeros(0))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    return next(_hashes([text]))


def _hashes(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """:func:`word_hashes` of each text; none for a null. Words of many texts are hashed together.

    Nothing is remembered between calls: a worker holds the words of :data:`TOGETHER` characters at most,
    or of one text.
    """
    lists, held = [], 0
    for text in texts:
        lists.append(text.lower().split() if isinstance(text, str) else [])
        held += len(text) if isinstance(text, str) else 0
        if held > TOGETHER:
            yield from _hashes_of(lists)
            lists, held = [], 0
    yield from _hashes_of(lists)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte; powers of an odd number modulo 2**64, and of its inverse."""
    letters = np.random.default_rng(20240301).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    both = [np.full(SLICE, b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for row in both:
        row[0] = 1
    return letters, *[np.multiply.accumulate(row) for row in both]


def _hashes_of(lists: list[list[str]]) -> Iterator[np.ndarray]:
    flat = list(chain.from_iterable(lists))
    try:
        words = pa.array(flat, pa.large_string())
    except UnicodeEncodeError:  # half of a character pair, which other sources than Spark may hold
        words = pa.array([w.encode("utf-8", "replace") for w in flat], pa.large_binary())
    del flat
    found = np.zeros(len(words), np.uint64)
    if len(words):
        ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[: len(words) + 1]
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
        letters, powers, inverse = _powers()
        first = 0
        while first < len(words):
            # Words of a slice of bytes; one that is longer stands alone.
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, side="right")) - 1)
            start, stop = int(ends[first]), int(ends[last])
            if stop - start <= SLICE:
                sums = np.zeros(stop - start + 1, dtype=np.uint64)
                np.cumsum(letters[data[start:stop]] * powers[: stop - start], out=sums[1:])
                at = ends[first : last + 1] - start
                # A word may begin where the slice ends, if it is empty.
                found[first:last] = (sums[at[1:]] - sums[at[:-1]]) * inverse[np.minimum(at[:-1], SLICE - 1)]
            else:
                found[first] = int.from_bytes(hashlib.blake2b(data[start:stop].tobytes(), digest_size=8).digest(), "little")
            first = last
        found = (found ^ (found >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    at = 0
    for words_of in lists:
        yield found[at : at + len(words_of)]
        at += len(words_of)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """A hash per window of five words; fewer words are one shingle, no words none."""
    if not len(words):
        return words
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return total


def distinct_of(shingles: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    ordered = np.sort(shingles)
    if len(ordered) < 2:
        return ordered
    new = ordered[1:] != ordered[:-1]
    return ordered if new.all() else ordered[np.concatenate([[True], new])]


def weights(shingles: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their TF-IDF weights."""
    distinct = distinct_of(shingles)
    weight = np.ones(len(distinct))
    if len(distinct) < len(shingles):
        weight += np.log(np.bincount(np.searchsorted(distinct, shingles), minlength=len(distinct)))
    if len(frequent.shingles):
        at = np.minimum(np.searchsorted(frequent.shingles, distinct), len(frequent.shingles) - 1)
        hit = frequent.shingles[at] == distinct
        weight[hit] *= frequent.idf[at[hit]]
    return distinct, weight


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets; 0 where both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    either = a[1].sum() + b[1].sum() - both
    return float(both / either) if either else 0.0


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Random numbers of the samples: r, beta, ln c, the sort key of a weight of 1, and multipliers."""
    rng = np.random.default_rng(20240229)
    shape = (TABLES, 1 << TABLE_BITS)
    r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
    log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
    beta = rng.random(shape, dtype=np.float32)
    odd = rng.integers(0, 1 << 63, MOST_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r, beta, log_c, _sort_key(log_c + r * beta - r), odd


def _sort_key(values: np.ndarray) -> np.ndarray:
    """Floats as integers of the same order, in the upper half of 64 bits."""
    bits = np.ascontiguousarray(values, dtype=np.float32).view(np.uint32)
    flip = np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
    return (bits ^ flip).astype(np.uint64) << np.uint64(32)


def samples_of(sets: list[tuple[np.ndarray, np.ndarray]], samples: int) -> np.ndarray:
    """A row per (non-empty) weighted set, a column per sample: the drawn shingle and level as 32 bits.

    r, c and beta of a shingle come from tables, at a place that a hash of its own names for each sample; shingles that meet in
    a table entry are told apart by their own bits.
    """
    r, beta, log_c, key_of_one, odd = _tables()
    shingles = np.concatenate([s for s, _ in sets])
    weight = np.concatenate([w for _, w in sets])
    starts = np.concatenate([[0], np.cumsum([len(s) for s, _ in sets])[:-1]]).astype(np.int64)
    low = shingles & np.uint64(0xFFFFFFFF)
    other = np.flatnonzero(weight != 1.0)
    log_weight = np.log(weight[other]).astype(np.float32)
    out = np.empty((len(sets), samples), dtype=np.uint64)
    for sample in range(samples):
        at = (shingles * odd[sample]) >> np.uint64(64 - TABLE_BITS)
        k = sample % TABLES
        key = key_of_one[k][at] | low
        if len(other):
            i = at[other]
            level = np.floor(log_weight / r[k][i] + beta[k][i])
            log_a = log_c[k][i] - r[k][i] * (level - beta[k][i]) - r[k][i]
            moved = (low[other] + level.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
            key[other] = _sort_key(log_a) | moved
        out[:, sample] = np.minimum.reduceat(key, starts)
    return out & np.uint64(0xFFFFFFFF)


def bands_of(drawn: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit bucket names, one per band."""
    parts = drawn.reshape(len(drawn), bands, rows)
    name = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        name = (name ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def sketches_of(drawn: np.ndarray) -> np.ndarray:
    """Four bits of every sample, 16 samples to a 64-bit number."""
    bits = (drawn * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)
    width = -(-drawn.shape[1] // 16) * 16
    padded = np.zeros((len(drawn), width), dtype=np.uint64)
    padded[:, : drawn.shape[1]] = bits
    parts = padded.reshape(len(drawn), -1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(parts, axis=2).view(np.int64)


def differing(a: str, b: str) -> Column:
    """How many samples differ between two sketch columns (equal samples never do)."""

    def one(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    return F.aggregate(F.zip_with(a, b, one), F.lit(0), lambda t, n: t + n)


def most_differing(samples: int, similar: float, sigmas: float = SIGMAS) -> int:
    """Differing samples up to which a pair may be as similar as asked."""
    return int(np.ceil(samples * (1 - similar) + sigmas * np.sqrt(samples * similar * (1 - similar))))


def _drawn(texts: pd.Series, frequent: Frequent, samples: int) -> list[tuple[bytes | None, np.ndarray | None]]:
    """Node and samples of each text, drawn for many texts at once; nulls for a text without words."""
    out: list[tuple[bytes | None, np.ndarray | None]] = [(None, None)] * len(texts)
    sets, at, size = [], [], 0

    def flush() -> None:
        if sets:
            for i, row in zip(at, samples_of(sets, samples), strict=True):
                out[i] = (out[i][0], row)
        sets.clear()
        at.clear()

    for i, words in enumerate(_hashes(texts)):
        if len(words):
            out[i] = (hashlib.blake2b(words.tobytes(), digest_size=16).digest(), None)
            sets.append(weights(shingle_hashes(words), frequent))
            at.append(i)
            size += len(words)
            if size > 30_000:
                flush()
                size = 0
    flush()
    return out


def frequent_shingles(docs: DataFrame, text: str = "text", rare: float = RARE) -> Frequent:
    """Exact frequencies of all shingles that more than ``rare`` of the documents have."""

    def bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, documents = np.zeros(1 << BIN_BITS, dtype=np.int64), 0
        for frame in frames:
            found = []
            for words in _hashes(frame.text):
                if len(words):
                    documents += 1
                    # Repeats count here, which may only fill more bins.
                    found.append((shingle_hashes(words) >> np.uint64(64 - BIN_BITS)).astype(np.int32))
            if found:
                counts += np.bincount(np.concatenate(found), minlength=len(counts))
        full = np.flatnonzero(counts)
        yield pd.DataFrame({"bin": np.append(full, -1), "n": np.append(counts[full], documents)})

    texts = small_batches(docs).select(F.col(text).alias("text"))
    counted = store(texts.mapInPandas(bins, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")), "bins")
    total = counted.filter("bin = -1").agg(F.sum("n")).first()[0] or 0
    least = rare * total
    full = np.array([r.bin for r in counted.filter((F.col("bin") >= 0) & (F.col("n") > least)).collect()], dtype=np.int64)
    if not len(full):
        return NONE
    wanted = np.zeros(1 << BIN_BITS, dtype=bool)
    wanted[full] = True
    packed = np.packbits(wanted)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.unpackbits(packed).astype(bool)
        for frame in frames:
            found = [np.zeros(0, np.uint64)]
            for words in _hashes(frame.text):
                if len(words):
                    one = shingle_hashes(words)
                    found.append(distinct_of(one[flags[(one >> np.uint64(64 - BIN_BITS)).astype(np.int64)]]))
            shingles, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"shingle": shingles.view(np.int64), "n": n})

    sums = texts.mapInPandas(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = sums.filter(F.col("n") > least).collect()
    shingles = np.array([r.shingle for r in rows], dtype=np.int64).view(np.uint64)
    share = np.array([r.n for r in rows], dtype=float) / max(total, 1)
    order = np.argsort(shingles)
    return Frequent(shingles[order], (LEAST_IDF + (1 - LEAST_IDF) * np.log(1 / share) / np.log(1 / rare))[order])


def signatures(
    docs: DataFrame, frequent: Frequent, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, raw_hash, node, bands, sketch, copies``: a row per distinct id and text.

    ``node`` is a digest of the sequence of words (null where there is none), ``copies`` counts rows.
    """

    @F.pandas_udf(_SIGNATURE)
    def sign(texts: pd.Series) -> pd.DataFrame:
        signed = _drawn(texts, frequent, bands * rows)
        out = pd.DataFrame({"node": [node for node, _ in signed], "bands": None, "sketch": None}, dtype=object)
        at = [i for i, (_, row) in enumerate(signed) if row is not None]
        if at:
            drawn = np.array([signed[i][1] for i in at])
            for i, names, sketch in zip(at, bands_of(drawn, bands, rows), sketches_of(drawn), strict=True):
                out.iat[i, 1], out.iat[i, 2] = names, sketch
        return out

    base = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("raw_hash"), sign(F.col(text)).alias("s"))
    base = base.select("doc_id", "raw_hash", "s.node", "s.bands", "s.sketch")
    return base.groupBy("doc_id", "raw_hash", "node").agg(
        F.count("*").alias("copies"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    )


def _texts(docs: DataFrame, signed: DataFrame, needed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(node, text)`` of the nodes in ``needed(node)``, stored."""
    one = signed.join(needed, "node").groupBy("node").agg(F.min(F.struct("doc_id", "raw_hash")).alias("one"))
    one = one.select("node", F.col("one.doc_id").alias("id"), F.col("one.raw_hash").alias("raw"))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("raw_hash", F.xxhash64("text"))
    texts = source.join(one, source.doc_id.eqNullSafe(one.id) & (source.raw_hash == one.raw)).select("node", "text")
    return store(texts.dropDuplicates(["node"]), "near-texts")


def _prefix_pairs(
    docs: DataFrame, signed: DataFrame, contested: DataFrame, frequent: Frequent, doc_id: str, text: str, similar: float
) -> DataFrame:
    """Pairs ``(a, b)`` of contested nodes of different labels that share a shingle of both prefixes.

    Shingles are ordered by how many contested nodes have them. A node's prefix is the shortest run of its
    rarest whose rest weighs less than ``similar`` of it: two nodes as similar as that share one. So a
    passage that many of them have makes no pairs. Samples are drawn anew, and more of them, to leave out
    pairs that are clearly less similar.
    """

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for node, value in zip(frame.node, frame.text, strict=True):
                shingles, weight = weights(shingle_hashes(word_hashes(value)), frequent)
                rows = pd.DataFrame({"shingle": shingles.view(np.int64), "weight": weight, "total": weight.sum()})
                yield rows.assign(node=node)[["node", "shingle", "weight", "total"]]

    def refine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            drawn = [row for _, row in _drawn(frame.text, frequent, FINE)]
            yield pd.DataFrame({"node": frame.node, "sketch": list(sketches_of(np.array(drawn)))})

    texts = _texts(docs, signed, contested.select("node"), doc_id, text)
    finer = small_batches(texts).mapInPandas(refine, "node binary, sketch array<long>")
    contested = store(contested.join(finer, "node"), "contested")
    far = most_differing(FINE, similar)
    spread_rows = small_batches(texts).mapInPandas(spread, "node binary, shingle long, weight double, total double")
    every = store(spread_rows, "contested-shingles")
    counts = every.groupBy("shingle").agg(F.count("*").alias("n"))
    order = Window.partitionBy("node").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    # A shingle of one node joins nothing, but counts in its prefix.
    prefix = every.join(counts, "shingle").withColumn("before", before)
    prefix = prefix.filter((F.col("n") > 1) & (F.col("total") - F.col("before") >= (similar - 1e-9) * F.col("total")))
    held = store(prefix.select("shingle", "node").join(contested, "node"), "prefixes")
    sizes = held.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    heads = sizes.groupBy("shingle").agg(F.max(F.struct("n", "label")).alias("head"), F.count("*").alias("labels"))
    heads = heads.filter("labels > 1").select("shingle", F.col("head.label").alias("head"))
    held = store(held.join(heads, "shingle"), "prefixes")
    # Two nodes may share many shingles: where both lists are short, the lowest they share stands for all.
    lists = held.groupBy("node").agg(F.collect_list("shingle").alias("tokens"))
    lists = lists.select("node", F.when(F.size("tokens") <= SHORT, F.col("tokens")).alias("tokens"))
    held = held.join(lists, "node")
    odd = held.filter("label != head").select("shingle", F.col("node").alias("x"), F.col("label").alias("xl"), F.col("sketch").alias("xs"), F.col("tokens").alias("xt"))
    rest = held.select(
        F.col("shingle").alias("s"), F.col("node").alias("y"), F.col("label").alias("yl"), F.col("sketch").alias("ys"), "head", F.col("tokens").alias("yt")
    )
    # Two odd nodes meet twice and are taken once.
    once = (F.col("x") < F.col("y")) | (F.col("yl") == F.col("head"))
    apart = (F.col("shingle") == F.col("s")) & (F.col("xl") != F.col("yl")) & once & (differing("xs", "ys") <= far)
    apart = apart & F.coalesce(F.array_min(F.array_intersect("xt", "yt")) == F.col("shingle"), F.lit(True))
    return odd.join(rest, apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _verified(
    docs: DataFrame, signed: DataFrame, pairs: DataFrame, frequent: Frequent, doc_id: str, text: str, similar: float
) -> DataFrame:
    """Those of ``pairs(a, b)`` that are similar enough, from the whole texts of their nodes."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = _texts(docs, signed, needed, doc_id, text)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, set_b = None, None
        for frame in frames:
            keep = []
            for a, b, text_a, text_b in zip(frame.a, frame.b, frame.text_a, frame.text_b, strict=True):
                if b != last:
                    last, set_b = b, weights(shingle_hashes(word_hashes(text_b)), frequent)
                keep.append(similarity(weights(shingle_hashes(word_hashes(text_a)), frequent), set_b) >= similar)
            yield frame.loc[keep, ["a", "b"]]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    met = small_batches(pairs.join(left, "a").join(right, "b")).select("a", "b", "text_a", "text_b")
    return store(met.mapInPandas(compare, "a binary, b binary"), "near-links")


def near_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, raw_hash, copies, class, class_id, class_size``: a row per distinct id and text.

    Documents whose similarity is at least ``similar`` are linked, and classes are what links connect.
    ``class_id`` is the smallest id of the class, ``class_size`` its rows. A text without words (null,
    empty, white space) is a class of its own; ``class`` is null there.
    """
    frequent = frequent_shingles(docs, text)
    signed = store(signatures(docs, frequent, doc_id, text, bands, rows), "signatures")
    nodes = signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    )
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = store(members.join(shared, "bucket"), "buckets")
    # The member that meets most others over all buckets is the likeliest to be like all of them.
    weight = members.groupBy("node").agg(F.sum("n").alias("meets")).join(nodes.select("node", "sketch"), "node")
    members = store(members.join(weight, "node"), "members")
    hubs = members.groupBy("bucket").agg(F.max(F.struct("meets", "node", "sketch")).alias("hub"))
    hubs = store(hubs.select("bucket", F.col("hub.node").alias("hub"), F.col("hub.sketch").alias("hub_sketch")), "hubs")
    far = most_differing(bands * rows, similar)
    star = members.join(hubs, "bucket").filter((F.col("node") != F.col("hub")) & (differing("sketch", "hub_sketch") <= far))
    star = store(star.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "near-pairs")
    links = _verified(docs, signed, star, frequent, doc_id, text, similar)
    label = connected(links)
    placed = members.filter("n > 2").select("bucket", "node").join(label, "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    contested = placed.join(mixed, "bucket", "left_semi").select("node", "label").distinct()
    contested = store(contested, "contested")
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = _prefix_pairs(docs, signed, contested, frequent, doc_id, text, similar)
    cross = store(cross.join(tried, ["a", "b"], "left_anti"), "near-pairs")
    if not cross.isEmpty():
        more = _verified(docs, signed, cross, frequent, doc_id, text, similar)
        if not more.isEmpty():
            # Classes are linked, not nodes: what is joined already is not gone through again.
            ends = label.select(F.col("node").alias("a"), F.col("label").alias("la"))
            far = label.select(F.col("node").alias("b"), F.col("label").alias("lb"))
            joined = more.join(ends, "a", "left").join(far, "b", "left")
            joined = joined.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
            over = connected(joined).withColumnRenamed("label", "over").withColumnRenamed("node", "label")
            nodes = label.unionByName(more.select(F.col("a").alias("node"), F.col("a").alias("label")).union(more.select("b", "b")))
            nodes = nodes.groupBy("node").agg(F.min("label").alias("label"))
            label = store(nodes.join(over, "label", "left").select("node", F.coalesce("over", "label").alias("label")), "labels")
    met = signed.join(label, "node", "left").withColumn("class", F.coalesce("label", "node"))
    sums = met.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size")
    )
    # Stored, so that the join deals both sides itself and can split a class that very many rows have.
    met = met.select("doc_id", "raw_hash", "copies", "class").join(store(sums, "near-sums"), "class", "left")
    alone = F.col("class").isNull()
    met = met.withColumn("class_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")))
    return met.withColumn("class_size", F.when(alone, F.lit(1)).otherwise(F.col("class_size")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """A row per document: ``doc_id, class_id, class_size``. An empty table gives no row."""
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    rows = near_classes(docs, doc_id, text, **settings)
    return rows.select("doc_id", "class_id", F.col("class_size").cast("long").alias("class_size"), each.alias("nth")).drop("nth")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One document of each class, that of the smallest id (null last), columns as they were.

    Texts without words stay, every row of them.
    """
    rows = store(near_classes(docs, doc_id, text, **settings), "near-classes")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw_hash")
    best = rows.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min(order).alias("best"))
    best = best.select("best.doc_id", "best.raw_hash").distinct()
    key = best.doc_id.eqNullSafe(rows.doc_id) & (best.raw_hash == rows.raw_hash)
    kept = rows.join(best, key, "left_semi").select(F.col("doc_id").alias("key0"), F.col("raw_hash").alias("key1"), "copies")
    has_words = F.coalesce(F.col(text).rlike(r"(?U)[^\s\x1C-\x1F]"), F.lit(False))
    plain = docs.filter(~has_words)
    return keep_rows(docs.filter(has_words), [F.col(doc_id), F.xxhash64(text)], kept).unionByName(plain)
