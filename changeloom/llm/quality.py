"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products.

Tokens are words and runs of punctuation. Features are hashed token unigrams and bigrams and trigrams of word shapes
(case, digits, kind of punctuation, repetition of the word before), each weighted by its relative frequency. Models
are fitted on shards of a bounded sample in parallel and averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import bounded_sample, fold_of, staged, with_python

BITS = 18
#: Rows that are used for fitting, at most (about); every row is scored.
TRAIN_ROWS = 12_000
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 20.0
#: Distinct tokens whose hashes are remembered by a task.
REMEMBERED = 200_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MASK = (1 << BITS) - 1


class _Tokens(dict):
    """Hash and shape (packed into one number) of a token."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        if not (token[0].isalnum() or token[0] == "_"):
            shape = 8 + zlib.crc32((token[0] + str(min(len(token), 3))).encode()) % 55
        elif token.isdigit():
            shape = 1
        elif token.islower():
            shape = 2
        elif token.isupper():
            shape = 3 if len(token) > 1 else 4
        else:
            shape = 5 if token[1:].islower() else 6
        value = (zlib.crc32(token.lower().encode()) & 0x7FFFFFFF) << 6 | shape
        self[token] = value
        return value


def features(text: str | None, tokens: _Tokens) -> np.ndarray:
    """Hashed n-grams of a text, with repeats; feature 0 is the bias and not among them."""
    found = _TOKEN.findall(text) if text else []
    if not found:
        return np.zeros(0, np.int64)
    packed = np.fromiter(map(tokens.__getitem__, found), np.int64, len(found))
    words, shapes = packed >> 6, packed & 63
    shapes[1:][words[1:] == words[:-1]] = 7
    triples = shapes.copy()
    triples[1:] += shapes[:-1] << 6
    triples[2:] += shapes[:-2] << 12
    pairs = words[1:] * 0x9E3779B1 + words[:-1] * 0x85EBCA77
    mixed = np.concatenate([words * 0xC2B2AE35 + 1, pairs + 2, triples * 0x27D4EB2F + 3, shapes * 0x165667B1 + 4])
    mixed ^= mixed >> 29
    mixed *= 0x5851F42D
    return ((mixed >> 20) & _MASK) | 1 << BITS


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights after FTRL-proximal updates over the rows of one shard, in an order fixed by a seed."""
    tokens, size = _Tokens(), 2 << BITS
    z, n = np.zeros(size), np.zeros(size)
    examples = []
    rows = rows.sort_values("doc_id", ignore_index=True)
    for text, label in zip(rows["text"], rows["label"], strict=True):
        found = features(text, tokens)
        index, counts = np.unique(found, return_counts=True)
        values = counts * (SCALE / max(1, len(found)))
        examples.append((np.append(0, index), np.append(1.0, values), float(label)))
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in order.permutation(len(examples)):
            index, values, label = examples[k]
            zi, ni = z[index], n[index]
            w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
            w[np.abs(zi) <= L1] = 0
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            gradient = (p - label) * values
            after = ni + gradient * gradient
            z[index] = zi + gradient - (np.sqrt(after) - np.sqrt(ni)) / ALPHA * w
            n[index] = after
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0
    used = np.flatnonzero(w)
    return pd.DataFrame({"feature": used, "weight": w[used]})


def learn(rows: DataFrame, *, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights by feature, from rows (doc_id, text, label 0 or 1); about ``train_rows`` of them are looked at.

    Without rows all weights are 0 and every score is a half. The result has a fixed size.
    """
    sample = staged(bounded_sample(rows, "doc_id", train_rows), "quality-train")
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(SHARDS)))
    fitted = with_python(dealt).groupBy("shard").applyInPandas(_fit, "feature long, weight double")
    mean = fitted.groupBy("feature").agg((F.sum("weight") / SHARDS).alias("weight")).toPandas()
    weights = np.zeros(2 << BITS, np.float32)
    weights[mean["feature"].to_numpy(np.int64)] = mean["weight"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text; null and empty texts get the bias's."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size: 4 bytes for each feature

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens, w = _Tokens(), shared.value
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                found = features(text, tokens)
                out[k] = w[0] + (SCALE * float(w[found].mean(dtype=np.float64)) if len(found) else 0.0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return with_python(docs).withColumn(name, scored(F.col(text_col)))


def training_rows(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held_out: int = 0, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled texts outside the held-out fold, a bounded number of them: their ids are small enough to be broadcast.

    Null ids, null labels and labels other than 0 and 1 are left out; of several labels of a row the smallest counts.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(fold_of("doc_id", folds) != held_out)
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Nulls, empty texts, repeated rows and empty tables are allowed; a text without tokens gets the score of the bias.
    ``labels`` (doc_id, quality) is read for fitting only; ids in fold 0 of 5 are never looked at.
    """
    weights = learn(training_rows(docs, labels))
    scored = score(docs.select("doc_id", "text"), weights)
    held = (fold_of("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
