"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. One linear classifier over hashed byte n-grams (one to three
bytes of the lower-cased text, non-letters of ASCII as blanks) is trained per bit. A text is decoded
to the codeword with the least loss, each bit weighted by how well its classifier tells that language
in the training rows; when the second codeword is nearly as close, the row is flagged ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.llm.common import fresh, small_batches

BINS_LOG2 = 12
BINS = 1 << BINS_LOG2
CHUNK_BYTES = 1 << 22
#: Training rows in all; shared out evenly over the languages.
SAMPLE_ROWS = 2000
#: Loss by which the best codeword must beat the second.
AMBIGUOUS = 0.005
UNDETERMINED = "und"
PARTS = 1_000_000_000
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams of whole texts, a row per text. Work space does not grow with a text."""
    parts = [b"  " + t.lower().encode("utf-8", "replace").translate(_BLANK) + b" " for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    raw = np.frombuffer(b"".join(parts) + b"  ", dtype=np.uint8)
    ends = np.cumsum(sizes)
    counts = np.zeros(len(texts) * BINS, dtype=np.int64)
    total = int(ends[-1]) if len(texts) else 0
    for start in range(0, total, CHUNK_BYTES):
        stop = min(total, start + CHUNK_BYTES)
        first, last = np.searchsorted(ends, [start, stop - 1], side="right")
        row = np.repeat(
            np.arange(first, last + 1, dtype=np.int64) * BINS,
            np.diff(np.concatenate([[start], np.minimum(ends[first:last], stop), [stop]])),
        )
        one = raw[start : stop + 2].astype(np.uint32)
        two = (one[:-1] << np.uint32(8)) | one[1:]
        three = (two[:-1] << np.uint32(8)) | one[2:]
        for salt, gram in enumerate((one[:-2], two[:-1], three)):
            bins = ((gram + np.uint32(salt << 24)) * np.uint32(2654435761)) >> np.uint32(32 - BINS_LOG2)
            low, high = first * BINS, (last + 1) * BINS
            counts[low:high] += np.bincount(row + bins - low, minlength=high - low)
    return counts.reshape(len(texts), BINS)


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of +1/-1 bits per class: all splits of the classes up to seven, else well-spread random ones."""
    if classes < 2:
        return np.zeros((classes, 0), dtype=np.float32)
    if classes <= 7:
        bits = [[1 if (column >> row) & 1 else -1 for column in range(1, 1 << (classes - 1))] for row in range(classes)]
        return np.array(bits, dtype=np.float32)
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(classes)))
    best, spread = None, -1.0
    for _ in range(100):
        code = rng.choice(np.array([-1.0, 1.0], dtype=np.float32), size=(classes, length))
        same = code @ code.T
        np.fill_diagonal(same, -length)
        mixed = bool((np.abs(code.sum(axis=0)) < classes).all())
        if mixed and length - same.max() > spread:
            best, spread = code, float(length - same.max())
    assert best is not None
    return best


@dataclass(frozen=True)
class Model:
    """Languages in order, their codewords, the weight of each bit for each language, and the classifiers."""

    languages: list[str]
    code: np.ndarray
    trust: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, a score from 0 to 1 and the margin to the second codeword."""
        n = len(counts)
        if len(self.languages) == 1:
            return np.zeros(n, dtype=int), np.ones(n), np.ones(n)
        output = _scaled(counts) @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -output * c) * t).sum(axis=1) for c, t in zip(self.code, self.trust, strict=True)], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(n)
        margin = loss[rows, order[:, 1]] - loss[rows, order[:, 0]]
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * self.code.shape[1])
        return order[:, 0], 1 / share.sum(axis=1), margin


def fit(counts: np.ndarray, labels: list[str], rounds: int = 150, rate: float = 20.0, decay: float = 1e-5) -> Model:
    """Train a classifier per bit by full gradient steps with momentum; the same rows give the same model."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    row = np.array([languages.index(x) for x in labels], dtype=int)
    x = _scaled(counts)
    weights = np.zeros((BINS, code.shape[1]), dtype=np.float32)
    bias = np.zeros(code.shape[1], dtype=np.float32)
    if len(languages) < 2:
        return Model(languages, code, code, weights, bias)
    target = code[row]
    share = (1.0 / np.bincount(row)[row] / len(languages)).astype(np.float32)[:, None]
    speed, speed_bias = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(rounds):
        output = x @ weights + bias
        slope = -target / (1 + np.exp(np.clip(target * output, -30, 30))) * share
        speed = 0.9 * speed - rate * 0.1 * (x.T @ slope + decay * weights)
        speed_bias = 0.9 * speed_bias - rate * 0.1 * slope.sum(axis=0)
        weights, bias = weights + speed, bias + speed_bias
    right = (np.sign(x @ weights + bias) == target).astype(np.float64)
    trust = np.stack([right[row == i].mean(axis=0) for i in range(len(languages))]) + 1e-6
    return Model(languages, code, trust / trust.sum(axis=1, keepdims=True), weights, bias)


def training_rows(labelled: DataFrame, doc_id: str, text: str, lang: str, sample_rows: int) -> DataFrame:
    """Languages and gram counts of a sample that stays near ``sample_rows`` at every size of the corpus.

    Texts are counted where they are read. Repeats of an id count once.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Rows whose hash lies in the lowest part of its range, a part set by the count of the language.
    rows = rows.withColumn("pick", F.pmod(F.xxhash64("doc_id", "lang"), F.lit(PARTS)))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], "lang string, bins array<int>, counts array<float>")
    each = max(10, sample_rows // len(counts))
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col("lang") == name) & (F.col("pick") < min(PARTS, PARTS * each // n + 1)))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for value, name in zip(frame.text, frame.lang, strict=True):
                row = gram_counts([value])[0]
                bins = np.flatnonzero(row)
                out.append((name, bins.astype(np.int32), row[bins].astype(np.float32)))
            yield pd.DataFrame(out, columns=["lang", "bins", "counts"])

    picked = rows.filter(chosen).dropDuplicates(["pick", "lang"]).select("text", "lang")
    return picked.mapInPandas(count, "lang string, bins array<int>, counts array<float>")


def train(
    labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on about ``sample_rows`` rows (ten per language at least). No labelled row: an empty model."""
    small_batches(labelled)
    rows = sorted(
        ((r.lang, r.bins, r.counts) for r in training_rows(labelled, doc_id, text, lang, sample_rows).collect()),
        key=lambda r: (r[0], r[1], r[2]),
    )
    counts = np.zeros((len(rows), BINS), dtype=np.float32)
    for i, (_, bins, values) in enumerate(rows):
        counts[i, bins] = values
    return fit(counts, [r[0] for r in rows])


def predict_texts(model: Model, texts: list[str | None], ambiguous: float = AMBIGUOUS) -> pd.DataFrame:
    """Predictions of whole texts, 64 at a time."""
    out = [(UNDETERMINED, 0.0, 0.0, True)] * len(texts)
    known = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
    for start in range(0, len(known), 64):
        part = known[start : start + 64]
        best, score, margin = model.decode(gram_counts([texts[i] for i in part]))
        for i, b, s, m in zip(part, best, score, margin, strict=True):
            out[i] = (model.languages[b], float(s), float(m), bool(m < ambiguous))
    return pd.DataFrame(out, columns=RESULT.names)


def identify(model: Model, text: Column, ambiguous: float = AMBIGUOUS) -> Column:
    """Struct of ``lang_pred, score, margin, ambiguous`` for a text.

    Null texts, texts without a letter, and all texts under an empty model give ``und``, score 0.
    """

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        return predict_texts(model, [None if not isinstance(t, str) else t for t in texts], ambiguous)

    return predict(text)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", ambiguous: float = AMBIGUOUS) -> DataFrame:
    """Rows whose language is determined and not ambiguous, with their columns as they were."""
    name = fresh(docs, "identified")
    told = small_batches(docs).withColumn(name, identify(model, F.col(text), ambiguous))
    sure = (F.col(f"{name}.lang_pred") != UNDETERMINED) & ~F.col(f"{name}.ambiguous")
    return told.filter(sure).select(*docs.columns)
