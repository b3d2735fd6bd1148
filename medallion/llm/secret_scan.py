"""Secret scans: fixed patterns, and strings that look random to two character Markov models.

One model is trained on random strings, one on ordinary identifiers; a string whose log-likelihood under the
first exceeds that under the second by enough is reported as kind `random`. The labels come from the corpus
itself: values that the fixed patterns found are samples of random strings, other words are identifiers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored

# The base kinds in their order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
_CODE = np.full(128, len(LETTERS), np.int64)
_CODE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_START = len(LETTERS)
_WIDTH = len(LETTERS) + 1
_WORD = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
LEAST_CHARS = 16
_LONG = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST_CHARS},}}")
_NO_DIGIT = re.compile(r"[^0-9]*")

#: Least difference of log-likelihoods, in all and for each character.
LEAST, LEAST_EACH = 20.0, 0.6


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed patterns' matches, in code points, by start."""
    out = [
        (m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_LEAST
    ]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _codes(word: str) -> np.ndarray:
    return _CODE[np.frombuffer(word.encode("ascii"), np.uint8)]


def _outside(pattern: re.Pattern, text: str, spans: list[tuple[int, int, int, int]]) -> Iterator[re.Match]:
    """Matches of a pattern that touch none of the spans, both in order of start."""
    ends, at = [(s[0], s[2]) for s in spans], 0
    for m in pattern.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        if at == len(ends) or ends[at][0] >= m.end():
            yield m


def transition_counts(documents: DataFrame) -> DataFrame:
    """(kind, step, n): how often a character follows another in random strings (1) and identifiers (0).

    Counted on all documents, since samples of random strings may be in very few of them; in each task first:
    at most 2 * 69 * 69 rows come from a task.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, _WIDTH * _WIDTH), np.int64)

        def add(kind: int, words: list[str]) -> None:
            codes = np.concatenate([np.append(_START, _codes(w)) for w in words])
            steps = codes[:-1] * _WIDTH + codes[1:]
            counts[kind] += np.bincount(steps[codes[1:] != _START], minlength=_WIDTH * _WIDTH)

        for batch in batches:
            for text in batch["text"].dropna():
                spans = base_spans(text)
                if spans:
                    add(1, list({text[s[3] : s[2]] for s in spans}))
                words = {m.group() for m in _outside(_WORD, text, spans)}
                words = {w for w in words if len(w) < LEAST_CHARS or _NO_DIGIT.fullmatch(w)}
                if words:
                    add(0, sorted(words))
        kind, step = np.nonzero(counts)
        yield pd.DataFrame({"kind": kind, "step": step, "n": counts[kind, step]})

    counted = documents.select("text").mapInPandas(each, "kind int, step int, n long")
    return counted.groupBy("kind", "step").agg(F.sum("n").alias("n"))


def log_ratios(counts: pd.DataFrame, smooth: float = 4.0) -> np.ndarray | None:
    """Log-likelihood ratio of every step, random against identifier; None without samples of both.

    A step's probability is smoothed towards how frequent the second character is in all samples of the kind.
    """
    n = np.zeros((2, _WIDTH * _WIDTH))
    n[counts["kind"], counts["step"]] = counts["n"]
    if not n.sum(1).all():
        return None
    n = n.reshape(2, _WIDTH, _WIDTH)[:, :, :-1]
    alone = n.sum(1, keepdims=True) + 0.5
    alone /= alone.sum(2, keepdims=True)
    p = np.log((n + smooth * alone) / (n.sum(2, keepdims=True) + smooth))
    return np.pad(p[1] - p[0], ((0, 0), (0, 1)))


def random_spans(text: str, base: list, ratios: np.ndarray | None) -> list[tuple[int, int, int, int]]:
    """Strings of LEAST_CHARS and more, outside the base spans, that the models call random."""
    out = []
    for m in _outside(_LONG, text, base) if ratios is not None else ():
        codes = _codes(m.group())
        gain = ratios[_START, codes[0]] + ratios[codes[:-1], codes[1:]].sum()
        if gain >= LEAST and gain >= LEAST_EACH * codes.size:
            out.append((m.start(), 3, m.end(), m.start()))
    return out


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def secret_scan(documents: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Null and empty texts have no spans (and the checksum of nothing). Rows are scanned on their own, so
    repeated rows and null ids give a row each. If the corpus holds no sample of random strings, the models
    add nothing. Empty documents give no rows.
    """
    counts = stored(transition_counts(documents), "secrets").toPandas()
    ratios = log_ratios(counts)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text or ""
                base = base_spans(text)
                more = random_spans(text, base, ratios)
                n = [sum(s[1] == k for s in base) for k in range(3)]
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((*n, digest, _written(sorted(base + more)), len(more)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return documents.select("doc_id", "text").mapInPandas(
        each,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long",
    )
