"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stem_hashes, stored, word_hashes
from medallion.llm.labels import TRAIN_ROWS, held_out_column, training_sample

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
BITS = 20
SHARD_ROWS = 5_000
STEMS = (4, 5, 6)


def _hashed(text: str | None, bits: int) -> np.ndarray:
    h = word_hashes(text, bare=True) if text else np.empty(0, np.uint64)
    k, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    pairs = (h[:-1] * k + h[1:]) * k
    skips = (h[:-2] * k + h[2:] + np.uint64(1)) * (k + np.uint64(2))
    stems = stem_hashes(text, STEMS) if text else []
    return (np.concatenate([h, pairs, skips, *stems]) >> shift).astype(np.int64)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Distinct hashed features of a text: 0 (always there), words, their stems, word pairs and skip-grams.

    A stem is a word's first 4, 5 or 6 bytes, so that forms of a word share it; a skip-gram is two words
    with one between them.
    """
    ids = np.unique(_hashed(text, bits))
    return np.concatenate([[0], ids[ids > 0]])


def total_weight(text: str | None, weights: np.ndarray, bits: int = BITS) -> float:
    """Sum of the weights of a text's features; only those with a weight are made distinct."""
    ids = _hashed(text, bits)
    ids = ids[weights[ids] != 0]
    return weights[0] + weights[np.unique(ids[ids > 0])].sum()


def fit_ftrl(
    rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = 4, alpha: float = 0.15,
    beta: float = 1.0, l1: float = 1.5, l2: float = 1.0,
) -> np.ndarray:
    """Weights after `epochs` passes in the order given; each coordinate has its own rate and L1 shrinkage.

    Feature 0 is the constant and isn't shrunk.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        shrink = np.where(i == 0, 0.0, l1)
        w = -(zi - np.sign(zi) * shrink) / ((beta + np.sqrt(n[i])) / alpha + l2 * (i != 0))
        return np.where(np.abs(zi) <= shrink, 0.0, w)

    for _ in range(epochs):
        for i, y in zip(rows, labels):
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weights(np.arange(1 << bits))


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, bits: int = BITS
) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) other than zero, from at most `rows` labelled documents outside the held-out fold.

    Each shard of some SHARD_ROWS rows of the sample is fitted in a task of its own, and the weights are averaged. What comes back is
    at most 2**bits numbers, a few thousand with L1. Texts outside the sample aren't shuffled.
    """
    sample = training_sample(labels, "toxic", FOLDS, HELD_OUT, rows)
    shards = max(1, round(sample.count() / SHARD_ROWS))
    known = documents.select("doc_id", "text").join(sample, "doc_id")
    known = known.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    known = known.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).cast("int"))

    def each(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id").sample(frac=1.0, random_state=17)
        w = fit_ftrl([features(t, bits) for t in part["text"]], part["label"].to_numpy(float), bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"feature": at, "weight": w[at], "shard": part["shard"].iloc[0]})

    fitted = stored(known.groupBy("shard").applyInPandas(each, "feature long, weight double, shard int"), "ftrl")
    used = max(1, fitted.agg(F.countDistinct("shard")).first()[0])
    mean = fitted.groupBy("feature").agg((F.sum("weight") / used).alias("weight")).toPandas()
    mean = mean.sort_values("feature")
    return mean["feature"].to_numpy(np.int64), mean["weight"].to_numpy(np.float64)


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of documents, from whole texts.

    Null and empty texts have the constant feature only. A row without id is scored but never trained on;
    repeated rows are scored each; of several labels of an id the larger counts. Empty labels give the
    score 0.5, empty documents no rows.
    """
    at, weight = fit_toxicity(documents, labels, bits=bits)
    sparse = documents.sparkSession.sparkContext.broadcast((at, weight))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dense = np.zeros(1 << bits)
        dense[sparse.value[0]] = sparse.value[1]
        for batch in batches:
            total = np.array([total_weight(t, dense, bits) for t in batch["text"]], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": 1 / (1 + np.exp(-np.clip(total, -30, 30)))})

    scored = documents.select("doc_id", "text").mapInPandas(each, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out_column(FOLDS, HELD_OUT),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
