"""Supervised subword embeddings for text quality.

Each whitespace word contributes one feature for itself and one for each of
its character n-grams (with word boundaries marked), all hashed into
``BUCKETS`` vectors.  A document is the mean of its features' vectors, a
softmax over two classes follows, and both layers are trained by plain
stochastic gradient descent in numpy.

The model is fitted on a bounded sample of labelled rows (``MAX_TRAIN``
documents of at most ``MAX_TRAIN_CHARS`` characters, chosen by hash): labels
only from rows outside the held-out fold.  Scoring covers all rows and whole texts.
As nothing lies between the mean and the softmax, a feature's effect on the
score is one number; the tasks get that table (``BUCKETS`` doubles, 2 MB).

Defined cases: null text counts as ''; a text without words scores as the
zero vector does (0.5); a document with several labels takes the largest;
null labels are ignored; without labelled rows all scores are 0.5; repeated
rows are scored alike; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.llm.common import BoundedCache, crc_fold, table

BUCKETS = 1 << 18
NGRAMS = (3, 4)
DIM = 16
EPOCHS = 8
RATE = 0.5
MAX_TRAIN = 4000
MAX_TRAIN_CHARS = 200_000
HELD_OUT_FOLDS = 5
THRESHOLD = 0.3
#: The word bigram of any word with itself; contains a space, so no word equals it.
REPEAT = "\x00 \x00"


def word_features(word: str) -> list[int]:
    """Buckets of a word and its character n-grams."""
    marked = f"<{word}>"
    out = [zlib.crc32(marked.encode()) % BUCKETS]
    for n in NGRAMS:
        out += [zlib.crc32(marked[i:i + n].encode(), n) % BUCKETS
                for i in range(len(marked) - n + 1)]
    return out


def words_of(text: str | None) -> list[str]:
    """White-space words; each that repeats its predecessor adds the word ``REPEAT``."""
    words = (text or "").split()
    return words + [REPEAT] * sum(map(operator.eq, words, words[1:]))


def text_features(text: str, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    words = [cache[w] for w in words_of(text)]
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    idx, n = np.unique(np.concatenate(words), return_counts=True)
    return idx, n / n.sum()


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 1) -> np.ndarray:
    """Effect of each bucket on the log odds of label 1, by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out = np.zeros((2, DIM))
    cache = BoundedCache(lambda w: np.array(word_features(w)))
    docs = [text_features(t, cache) for t in texts]
    # classes weigh by the inverse root of their frequency
    share_of = np.bincount(labels, minlength=2) / max(1, len(labels))
    weight = np.sqrt(0.5 / np.maximum(share_of, 1e-9))
    step, steps = 0, epochs * max(1, len(docs))
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            rate = RATE * (1 - step / steps)
            step += 1
            idx, share = docs[d]
            if not len(idx):
                continue
            rows = vectors[idx]
            hidden = share @ rows
            logits = out @ hidden
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[d]] -= 1
            p *= weight[labels[d]]
            grad = out.T @ p
            out -= rate * np.outer(p, hidden)
            # fastText's update: every feature takes the document's gradient
            # in proportion to its occurrences
            vectors[idx] = rows - rate * np.minimum(1, share * len(idx))[:, None] * grad
    return vectors @ (out[1] - out[0])


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """At most ``limit`` labelled rows (text, label) outside the held-out fold."""
    marked = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                           & (crc_fold(F.col("doc_id"), HELD_OUT_FOLDS) != 0))
              .groupBy("doc_id").agg(F.max("quality").alias("label")))
    chosen = (marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
              .select(F.col("doc_id").alias("__id"), "label"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
            .where(F.length(text) <= MAX_TRAIN_CHARS)
            .groupBy("__id", "label").agg(F.min(text).alias("text")))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> np.ndarray:
    """The model: one number per bucket."""
    rows = training_sample(docs, labels, limit).collect()  # bounded by limit
    rows.sort(key=lambda r: r["__id"])
    if not rows:
        return np.zeros(BUCKETS)
    return train([r["text"] for r in rows], [int(r["label"]) for r in rows])


def scorer(spark: SparkSession, model: np.ndarray):
    """Column function: text -> probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        effect = shared.value

        def sums(word: str) -> complex:
            # a word's summed effect and its number of features, added up together
            idx = word_features(word)
            return complex(float(effect[idx].sum()), len(idx))

        cache = BoundedCache(sums)
        for texts in batches:
            totals = [sum(map(cache.__getitem__, words_of(t)), 0j) for t in texts]
            total = np.array(totals, complex)
            mean = total.real / np.maximum(total.imag, 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(mean, -30, 30))))

    return score


def with_score(docs: DataFrame, labels: DataFrame, name: str = "score",
               text: Column | None = None) -> DataFrame:
    """``docs`` with a column ``name``."""
    score = scorer(docs.sparkSession, fit(docs, labels))
    return docs.withColumn(name, score(F.col("text") if text is None else text))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``."""
    score = scorer(docs.sparkSession, fit(docs, labels))
    return docs.where(score(F.col("text")) >= threshold)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_score(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (crc_fold(F.col("doc_id"), HELD_OUT_FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
