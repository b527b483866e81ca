"""Quality classifier: supervised subword embeddings, averaged for each document.

Features of a text: its words (as hashes), the character n-grams inside its words (with the white
space around them as an end mark), and for each word equal to one of the two words before it a
common mark "again", which is the word n-gram (w, w) of any word w. Every feature is hashed to one
of ``BUCKETS`` learned vectors; a document is the mean of its features' vectors, and a softmax over
two classes gives the score. Vectors and output weights are trained together by stochastic gradient
descent in numpy, one document a step, with a falling rate.

Training reads a bounded sample: ``TRAIN_ROWS`` labelled rows, the first by a hash of doc_id, and
of these at most ``TRAIN_ENTRIES`` (feature, weight) entries. Only these numbers reach the driver,
no text. Scoring is one pass over all whole texts without a shuffle: with trained weights a
feature's part in the score is one number, so a document's score is a mean of looked-up numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import WHITE, map_texts, slices
from vigilog.llm.fingerprint import window_hashes
from vigilog.llm.perfect_hash import mix

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (3, 4)
TRAIN_ROWS = 3000
TRAIN_ENTRIES = 6_000_000
EPOCHS = 6
RATE = 2.0
#: Features without meaning that each document has besides its own: a text of a few words stays
#: near the share of label 1 instead of hanging on them.
BLANK_FEATURES = 10
FOLDS = 5
THRESHOLD = 0.3

_WHITE = np.array([ord(c) for c in WHITE], np.uint32)
_POWERS = mix(np.arange(1 << 12, dtype=np.uint64), 3) | np.uint64(1)
_AGAIN = np.uint64(0xA6A1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every feature of every text."""
    joined = "".join(f" {t} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 2 for t in texts])
    blank = np.isin(codes, _WHITE)
    blanks = np.concatenate([[0], np.cumsum(blank)])
    found_of, found = [], []

    shape = np.where(blank, np.uint32(32), codes)
    for n in NGRAMS:
        if len(codes) < n:
            continue
        inner = blanks[n - 1 : -1] - blanks[1 : len(blanks) - n + 1]  # blanks strictly inside
        at = np.flatnonzero(inner == 0)
        found.append(window_hashes(shape, n)[at] + np.uint64(n))
        found_of.append(of[at])

    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if len(starts):
        size = ends - starts
        inside = np.flatnonzero(~blank)
        place = np.arange(len(inside)) - np.repeat(np.cumsum(size) - size, size)
        part = mix(codes[inside], 1) * _POWERS[place & (len(_POWERS) - 1)]
        words = np.add.reduceat(part, np.cumsum(size) - size)
        word_of = of[starts]
        found.append(mix(words, 2))
        found_of.append(word_of)
        for back in (1, 2):
            same = np.flatnonzero((words[back:] == words[:-back]) & (word_of[back:] == word_of[:-back]))
            found.append(np.full(len(same), _AGAIN + np.uint64(back)))
            found_of.append(word_of[same + back])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_of), (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """For scoring: what each bucket adds to the log odds of label 1, and the bias."""

    parts: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        of, buckets = features(texts)
        total = np.bincount(of, self.parts[buckets], len(texts))
        mean = total / (np.bincount(of, minlength=len(texts)) + BLANK_FEATURES)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -30, 30)))


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """``samples``: (label, distinct buckets, their weights) of each document."""
    labels = np.array([s[0] for s in samples])
    share = labels.mean() if len(labels) else 0.5
    if not 0 < share < 1:
        odds = 0.0 if not len(labels) else (30.0 if share else -30.0)
        return Model(np.zeros(BUCKETS), odds)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, 2)), np.log([1 - share, share])
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for n in rng.permutation(len(samples)):
            label, buckets, part = samples[n]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = part @ vectors[buckets]
            out = mean @ weights + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # Shared among the features by weight, at a rate that does not sink with their number.
            vectors[buckets] -= np.minimum(1, part * 100)[:, None] * (rate * back)
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def is_held_out(doc_id: Column) -> Column:
    """A fixed fifth of the documents, never trained on; a null doc_id is not in it."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on labelled documents that are not held out.

    Labels other than 0 and 1 and null ids are left out; of several labels or several rows of a
    document one counts. Without documents of both classes the model is a constant.
    """
    chosen = (
        labels.filter("quality in (0, 1) and doc_id is not null")
        .filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )

    def make() -> Callable[[list[str]], dict[str, object]]:
        def compute(texts: list[str]) -> dict[str, object]:
            buckets, parts = [], []
            for text in texts:
                found, counts = np.unique(features([text])[1], return_counts=True)
                buckets.append(found.astype(np.int32))
                parts.append((counts / (counts.sum() + BLANK_FEATURES)).astype(np.float32))
            return {"buckets": buckets, "parts": parts}

        return compute

    # At most ``rows`` pairs of numbers are broadcast.
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    made = map_texts(own, make, "buckets array<int>, parts array<float>")
    single = made.groupBy("doc_id").agg(F.min(F.struct("label", "buckets", "parts")).alias("row"))
    single = single.select("doc_id", "row.*").orderBy(F.xxhash64("doc_id"), "doc_id")
    samples, entries = [], 0
    for r in single.toArrow().to_batches():
        for label, b, p in zip(r.column("label"), r.column("buckets"), r.column("parts"), strict=True):
            # The sample ends at the first document beyond the bound; none is chosen by its length.
            entries += len(b)
            if entries <= TRAIN_ENTRIES or not samples:
                samples.append((label.as_py(), b.values.to_numpy(), p.values.to_numpy()))
    return train(samples)


def predicted_score(text: Column, model: Model) -> Column:
    """The score of a text column, for use in a filter."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        own = [t or "" for t in texts]
        found = [model.scores(own[s:e]) for s, e in slices(own)]
        return pd.Series(np.concatenate([np.zeros(0), *found]))

    return scores(text)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted instead of text.

    The score comes from the whole text alone. A null or empty text gets the score of a document
    without features (the bias). Rows pass through one by one: repeated rows and null ids stay,
    and columns named score or predicted are replaced. An empty table gives an empty result.
    """

    def make() -> Callable[[list[str]], dict[str, object]]:
        return lambda texts: {"score": model.scores(texts)}

    scored = map_texts(docs.drop("score", "predicted"), make, "score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
