"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

Statistics are computed in one pass over the texts and stored; the trees are fitted on a bounded sample
of labelled rows and travel as four small arrays, which score any number of rows by array look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored, word_hashes
from medallion.llm.labels import TRAIN_ROWS, held_out_column, training_sample

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "distinct_words", "repeated_neighbours", "top_word",
    "upper", "digits", "marks", "stops", "commas", "bars", "loud", "symbols", "beyond_ascii", "spaces",
    "lines_per_word", "repeated_lines", "top_pair", "distinct_pairs", "hashes", "controls",
]


def _of(characters: bytes) -> np.ndarray:
    hit = np.zeros(256)
    hit[list(characters)] = 1
    return hit


_CLASSES = np.stack(
    [
        _of(bytes(range(65, 91))),
        _of(b"0123456789"),
        _of(bytes(c for c in range(33, 127) if not chr(c).isalnum())),
        _of(b"."),
        _of(b","),
        _of(b"|"),
        _of(b"!?"),
        _of(b"*#$%&@^~<>{}[]\\=+_"),
        _of(bytes(range(128, 256))),
        _of(b" \t\n\r\x0b\x0c"),
    ]
)
_CONTROLS = _of(bytes([*range(9), *range(14, 32), 127]))


def statistics(text: str | None) -> np.ndarray:
    """STATISTICS of one text, all zero if it is null or empty."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    raw = np.frombuffer(text.encode(), np.uint8)
    bytes_seen = np.bincount(raw, minlength=256)
    share = _CLASSES @ bytes_seen / raw.size
    words = word_hashes(text)
    n = max(1, words.size)
    _, counts = np.unique(words, return_counts=True)
    _, pairs = np.unique(words[1:] * np.uint64(3) + words[:-1], return_counts=True)
    lines = text.split("\n")
    out[:6] = [
        np.log1p(raw.size),
        np.log1p(words.size),
        (raw.size - bytes_seen[[9, 10, 11, 12, 13, 32]].sum()) / n,
        counts.size / n,
        (words[1:] == words[:-1]).mean() if n > 1 else 0,
        counts.max(initial=0) / n,
    ]
    out[6:16] = share
    out[16:] = [
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        pairs.max(initial=0) / n,
        pairs.size / n,
        bytes_seen[35] / raw.size,
        _CONTROLS @ bytes_seen / raw.size,
    ]
    return out


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x) with x the STATISTICS of every document's whole text."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [statistics(t).astype(np.float32) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": x})

    return documents.select("doc_id", "text").mapInPandas(each, "doc_id long, x array<float>")


@dataclass
class Trees:
    """Complete binary trees of one depth: a row of each array is a tree, node k has children 2k+1, 2k+2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for the rows of x: all trees and rows descend a level at a time."""
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.base + self.leaf[tree, node - self.feature.shape[1]].sum(1) if self.leaf.size else self.base
        return 1 / (1 + np.exp(-np.clip(total, -30, 30) * np.ones(len(x))))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 1.0, least: float = 1e-3,
) -> Trees:
    """Trees for the log loss, split by second-order gain over histograms of at most `bins` bins.

    Cuts are quantiles of each column. A node without a split that gains gets the cut infinity, so its
    rows go left. Without rows, or with one label only, the result is the smoothed share of label 1.
    """
    n_in, n_out = 2**depth - 1, 2**depth
    rows = len(y)
    base = np.log((y.sum() + 1) / (rows - y.sum() + 1)) if rows else 0.0
    if rows == 0 or y.min() == y.max():
        none = np.zeros((0, n_in))
        return Trees(none.astype(int), none, np.zeros((0, n_out)), float(base))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], 1)
    feature, threshold = np.zeros((trees, n_in), int), np.full((trees, n_in), np.inf)
    leaf, total = np.zeros((trees, n_out)), np.full(rows, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess, node = p - y, p * (1 - p), np.zeros(rows, int)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = (node - first) * bins
            best = np.full(width, least)
            for f, c in enumerate(cuts):
                g = np.bincount(at + binned[:, f], grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(at + binned[:, f], hess, width * bins).reshape(width, bins).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                cut = gain[:, : len(c)].argmax(1)
                top = gain[np.arange(width), cut]
                better = top > best
                best[better] = top[better]
                feature[t, first : first + width][better] = f
                threshold[t, first : first + width][better] = c[cut[better]]
            node = 2 * node + 1 + (x[np.arange(rows), feature[t, node]] > threshold[t, node])
        g = np.bincount(node - n_in, grad, n_out)
        h = np.bincount(node - n_in, hess, n_out)
        leaf[t] = -rate * g / (h + ridge)
        total += leaf[t, node - n_in]
    return Trees(feature, threshold, leaf, float(base))


def fit_quality(stats: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees from the labelled documents outside the held-out fold, `rows` of them at most."""
    sample = training_sample(labels, "quality", FOLDS, HELD_OUT, rows)
    known = stats.join(sample, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.max("label").alias("label"))
    got = known.orderBy("doc_id").limit(rows).toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(STATISTICS))
    return fit_trees(x, got["label"].to_numpy(np.float64))


def score_quality(stats: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, score) of every row of document statistics."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), np.float64).reshape(len(batch), len(STATISTICS))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(x)})

    return stats.mapInPandas(each, "doc_id long, score double")


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of documents.

    Null and empty texts have all-zero statistics and are scored like any other. A row without id is
    scored but never trained on. Repeated rows are scored each; ties of ids in labels count once, with the
    larger label. Empty labels give every row the score 0.5, empty documents give no rows.
    """
    stats = stored(document_statistics(documents), "quality")
    scored = score_quality(stats, fit_quality(stats, labels))
    return scored.select(
        "doc_id",
        held_out_column(FOLDS, HELD_OUT),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that the classifier doesn't reject, with their columns.

    Texts are read twice and never shuffled: each row is scored where it is read.
    """
    model = fit_quality(stored(document_statistics(documents), "quality"), labels)
    columns = documents.columns

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([statistics(t).astype(np.float32) for t in batch["text"]], np.float64)
            yield batch[model.score(x.reshape(len(batch), len(STATISTICS))) >= threshold][columns]

    return documents.mapInPandas(each, documents.schema)
