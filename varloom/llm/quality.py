"""A quality classifier over supervised subword embeddings.

Every word of a text, every three and four characters of it with its ends marked, and the pair of a word
with itself are hashed to learned vectors. A document is the mean of the vectors, a softmax layer gives its classes, and both are
trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. Mean and layer are
linear, so when texts are scored a word adds one number that is looked up.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import small_batches

BUCKET_BITS = 17
SIZE = 8
GRAMS = (3, 4)
#: Labelled rows to learn from, about.
SAMPLE_ROWS = 2000
EPOCHS = 6
RATE = 0.1
DECAY = 1e-3
PARTS = 1_000_000_000
#: Words whose share a Python worker remembers; only speed depends on it.
REMEMBERED = 800_000
#: Stands for every word pair whose second word repeats the first; no word has a blank.
TWICE = "= ="


def document_words(text: str | None) -> Counter:
    """Words of a text and their counts; pairs of one word twice are counted under :data:`TWICE`."""
    words = text.split() if text else []
    found = Counter(words)
    twice = sum(map(eq, words, words[1:]))
    if twice:
        found[TWICE] = twice
    return found


def _bucket(values: np.ndarray) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def subwords(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of words, and those of the words themselves.

    Per n: a bucket for each place of the joined words and whether an n-gram of one word begins there;
    then where each word begins, and the bucket of each word.
    """
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    left = np.repeat(starts + sizes, sizes) - np.arange(len(codes))
    buckets, valid = [], []
    for n in GRAMS:
        padded = np.concatenate([codes, np.zeros(n - 1, np.uint64)])
        name = np.full(len(codes), n, dtype=np.uint64)
        for i in range(n):
            name = name * np.uint64(0x100000001B3) + padded[i : i + len(codes)]
        buckets.append(_bucket(name))
        valid.append(left >= n)
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    return buckets, valid, starts, _bucket(whole + np.uint64(1 << 40))


def document_features(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and their shares, which sum to 1."""
    buckets, valid, starts, whole = subwords(words)
    sizes = np.diff(np.concatenate([starts, [len(buckets[0])]]))
    every = np.repeat(counts.astype(float), sizes)
    names = np.concatenate([whole, *(b[v] for b, v in zip(buckets, valid, strict=True))])
    shares = np.concatenate([counts.astype(float), *(every[v] for v in valid)])
    ids, at = np.unique(names, return_inverse=True)
    total = np.bincount(at, weights=shares)
    return ids, total / total.sum()


@dataclass
class Model:
    """Log odds of class 1 that each bucket adds, and those of a text without words."""

    shares: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.known: dict[str, tuple[float, int]] = {}

    def __getstate__(self) -> dict:
        return {"shares": self.shares, "bias": self.bias, "known": {}}

    def _learn(self, words: list[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        buckets, valid, starts, whole = subwords(words)
        total, number = self.shares[whole].astype(np.float64), np.ones(len(words))
        for b, v in zip(buckets, valid, strict=True):
            total += np.add.reduceat(np.where(v, self.shares[b], 0.0), starts)
            number += np.add.reduceat(v.astype(np.int64), starts)
        self.known.update(zip(words, zip(total.tolist(), number.tolist(), strict=True), strict=True))

    def score(self, text: str | None) -> float:
        """Probability of class 1 of a whole text; null counts as empty."""
        found = document_words(text)
        if not found:
            return float(1 / (1 + np.exp(-self.bias)))
        new = [w for w in found if w not in self.known]
        if new:
            self._learn(new)
            if len(new) < len(found):
                again = [w for w in found if w not in self.known]
                if again:
                    self._learn(again)
        total = number = 0.0
        known = self.known
        for word, n in found.items():
            t, k = known[word]
            total += n * t
            number += n * k
        return float(1 / (1 + np.exp(-np.clip(total / number + self.bias, -30, 30))))


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY, seed: int = 3) -> Model:
    """Train vectors and softmax layer, one document a step; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((1 << BUCKET_BITS, SIZE)) - 0.5).astype(np.float32)
    layer, bias = (rng.random((2, SIZE)) - 0.5).astype(np.float32), np.zeros(2, dtype=np.float32)
    if len(set(labels)) < 2:
        only = {0: -2.0, 1: 2.0}.get(labels[0] if labels else -1, 0.0)
        return Model(np.zeros(1 << BUCKET_BITS, dtype=np.float32), only)
    share = np.bincount(labels, minlength=2) / len(labels)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(labels)):
            ids, weight = features[i]
            hidden = weight @ vectors[ids] if len(ids) else np.zeros(SIZE, dtype=np.float32)
            logits = layer @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            error = error * (0.5 / share[labels[i]])
            back = error @ layer
            layer = (layer * (1 - step * decay) - step * np.outer(error, hidden)).astype(np.float32)
            bias -= (0.1 * step * error).astype(np.float32)
            if len(ids):
                # The mean moves by one step, whatever the number of its vectors.
                vectors[ids] -= np.outer(weight / (weight @ weight), step * back).astype(np.float32)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on about ``sample_rows`` labelled documents, those of lowest hash; no label: a constant model.

    Labels are sampled before they meet the documents, so what is broadcast and collected does not grow.
    Labels other than 0 and 1 are left out.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    known = known.withColumn("pick", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    n = known.count()
    chosen = known.filter(F.col("pick") < min(PARTS, PARTS * sample_rows // max(1, n) + 1)).drop("pick")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [document_words(t if isinstance(t, str) else None) for t in frame.text]
            pairs = [sorted(c.items()) for c in found]
            yield pd.DataFrame(
                {"label": frame.label, "words": [[w for w, _ in p] for p in pairs], "counts": [[k for _, k in p] for p in pairs]}
            )

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    rows = small_batches(rows.select("id", "label", "text").distinct()).select("label", "text")
    got = [(r.label, r.words, r.counts) for r in rows.mapInPandas(count, "label int, words array<string>, counts array<long>").collect()]
    got.sort()
    none = (np.zeros(0, np.int64), np.zeros(0))
    features = [document_features(w, np.array(c)) if w else none for _, w, c in got]
    return fit(features, [r[0] for r in got])


def score(model: Model, text: Column) -> Column:
    """Probability of class 1 of a whole text; null and empty texts get that of no words."""

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return apply(text)
