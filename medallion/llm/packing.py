"""Sum-of-squares online packing of token sequences.

A window takes `size` tokens. The last part of each document, shorter than a window, goes to the fill level
at which the sum of the squared counts of partially filled windows grows least; counts are kept in an array
by level. Each partition packs its own documents, so nothing is shuffled, and memory holds open windows only.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

SIZE = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces whose ids a worker remembers; others are tokenized again.
REMEMBERED = 1_000_000


class SumOfSquares:
    """Levels of partially filled windows, and the level that an item of a given length goes to."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # partially filled windows by tokens in them

    def level_for(self, length: int) -> int:
        """The level whose windows take the item with the least sum of squares afterwards; 0 opens a window.

        Moving a window from level h to h + length changes the sum by
        2 * (count[h + length] - count[h]) + 2, less where h is 0 or the window gets full. Ties go to the
        fullest level.
        """
        last = self.size - length
        n = self.count[: last + 1]
        after = 2 * self.count[length : length + last + 1] + 1
        after[last] = 0  # a full window isn't counted any more
        change = np.where(n > 0, after - 2 * n + 1, np.iinfo(np.int64).max)
        change[0] = after[0] if length < self.size else 0
        best = change.min()
        return int(np.flatnonzero(change == best)[-1])

    def move(self, level: int, length: int) -> None:
        if level:
            self.count[level] -= 1
        if level + length < self.size:
            self.count[level + length] += 1


class Pieces(dict):
    """Ids of one piece (lower case, as the tokenizer splits text) as little-endian bytes."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize

    def __missing__(self, piece: str) -> bytes:
        found = [t.id for t in self.tokenize(piece.translate(_BYTE_LETTERS))]
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) < REMEMBERED:
            self[piece] = ids
        return ids


class DocumentTokenizer:
    """Ids of whole texts.

    The tokenizer lowers a text, splits it into pieces that never hold white space and merges each piece on
    its own, so for Latin-1 texts (which its normalizer leaves alone otherwise) ids are looked up by piece.
    Other texts, and those that may hold a special token, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.pieces = Pieces(self.whole)

    def __call__(self, text: str) -> np.ndarray:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = None
        if raw is None or "<|" in text or raw.translate(None, _PLAIN):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower()))), "<u4")


# Latin-1 characters of which Python and the tokenizer agree what white space is.
_PLAIN = bytes(c for c in range(256) if c not in (*range(0x1C, 0x20), 0x85, 0xA0))
# Fixed value: the pattern of pieces in the tokenizer's file, its classes spelled out for lower-case Latin-1.
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(rf"[{_LETTER}]+|[{_NUMBER}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{_LETTER}{_NUMBER}]+")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write a Latin-1 character's UTF-8 bytes with.

    A printable byte stands for itself, the others are numbered from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in printable}
    letter |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letter)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


_BYTE_LETTERS = _byte_letters()
_loaded: dict[str, DocumentTokenizer] = {}


def document_tokenizer(path: str) -> DocumentTokenizer:
    """One for each worker process and file."""
    if path not in _loaded:
        _loaded[path] = DocumentTokenizer(path)
    return _loaded[path]


class Packer:
    """Packs documents in the order given; `place` returns finished windows as lists of pieces.

    A piece is (doc_id, start, ids, tokens of its document).
    """

    def __init__(self, size: int = SIZE):
        self.size, self.levels = size, SumOfSquares(size)
        self.open: dict[int, list[list]] = {}

    def place(self, doc_id, ids: np.ndarray) -> Iterator[list]:
        """Whole windows of a long document, then its rest where the sum of squares says."""
        total = len(ids)
        whole = total - total % self.size
        for at in range(0, whole, self.size):
            yield [(doc_id, at, ids[at : at + self.size], total)]
        if whole == total:
            return
        piece = (doc_id, whole, ids[whole:].copy(), total)
        length = total - whole
        level = self.levels.level_for(length)
        self.levels.move(level, length)
        window = self.open[level].pop() if level else []
        window.append(piece)
        if level + length == self.size:
            yield window
        else:
            self.open.setdefault(level + length, []).append(window)

    def rest(self) -> Iterator[list]:
        """The windows still open, filled up: pieces of all of them in a row, cut at every `size` tokens.

        Windows that lack little (one token in 64 at most) are closed as they are.
        """
        line, held = [], 0
        for level in sorted(self.open, reverse=True):
            for window in self.open[level]:
                if level >= self.size - self.size // 64:
                    yield window
                    continue
                for doc_id, start, ids, total in window:
                    while len(ids):
                        part, ids = ids[: self.size - held], ids[self.size - held :]
                        line.append((doc_id, start, part, total))
                        start, held = start + len(part), held + len(part)
                        if held == self.size:
                            yield line
                            line, held = [], 0
        if line:
            yield line
        self.open = {}


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long"
)


def pack(documents: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents' ids (each document followed by `end_id`) in sequences of at most `size` ids.

    Columns: doc_id, start (the document's ids before the piece), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset (in the sequence, without gaps),
    sequence_tokens (its ids before padding). A null or empty text is the end id alone. Repeated rows and
    null ids are packed like any other row. A sequence's number is its partition's number times 2**32 plus
    its number there, the same in every run over the same files. One sequence of a partition can be short, and
    others by a 64th at most. Empty documents give no rows.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenize, packer = document_tokenizer(path), Packer(size)
        number, rows = TaskContext.get().partitionId() << 32, []

        def emit(windows) -> None:
            nonlocal number
            for window in windows:
                offset, tokens = 0, sum(len(p[2]) for p in window)
                for doc_id, start, ids, total in window:
                    crc = zlib.crc32(ids.tobytes())
                    rows.append((doc_id, start, len(ids), crc, total, number, offset, tokens))
                    offset += len(ids)
                number += 1

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")], dtype=object)
            rows.clear()
            return out

        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for doc_id, text in zip(ids, batch["text"]):
                tokens = np.append(tokenize(text or ""), np.array(end_id, "<u4")).astype("<u4")
                emit(packer.place(None if doc_id is pd.NA else doc_id, tokens))
            yield frame()
        emit(packer.rest())
        yield frame()

    return documents.select("doc_id", "text").mapInPandas(each, PIECES)
