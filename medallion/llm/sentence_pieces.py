"""Encoding and decoding with a SentencePiece BPE model, by vectorised merge rounds.

Texts become one flat array of symbols, cut into words where no piece of the model can reach across. Equal words
are merged once. In a round every word finds the best rank among its neighbouring pairs and merges all its pairs of
that rank at once, leftmost first; then the array is compacted. Rounds go on until no word has a pair left.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
#: Characters that are merged together; longer texts are cut where no piece reaches across.
PART = 1 << 20
# Fixed values of the model format.
SPACE, REPLACEMENT = "▁", "�"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

_NONE = np.iinfo(np.int32).max
_POINTS = 0x110000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialized message."""

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class MergeRounds:
    """Merges symbols of words by ranked pairs: pair (left, right) -> (rank, result), symbols below `width`."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], width: int):
        self.width = width
        self.pairs = {left * width + right: found for (left, right), found in pairs.items()}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.rank, self.merged = (np.array([self.pairs[k][j] for k in self.keys.tolist()], np.int32) for j in (0, 1))

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair of symbols; _NONE and 0 for pairs that don't merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        hit = (self.keys[at] == key) & (left < self.width) & (right < self.width)
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.merged[at], 0)

    def merge_words(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of each word (flat, words in order), and how many; every word has a symbol at least."""
        word = np.repeat(np.arange(sizes.size), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, result = np.full(symbols.size, _NONE, np.int32), np.zeros(symbols.size, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], result[inner] = self._lookup(symbols[inner], symbols[inner + 1])
        while symbols.size:
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=symbols.size)
            if (best == _NONE).any():
                ended = np.repeat(best == _NONE, sizes)
                done.append((symbols[ended], word[ended]))
                symbols, word, rank, result = (x[~ended] for x in (symbols, word, rank, result))
                sizes, best = sizes[best != _NONE], best[best != _NONE]
                if not symbols.size:
                    break
            place = np.repeat(np.arange(best.size), sizes)  # of a symbol's word among those that remain
            hits = np.flatnonzero(rank == best[place])
            # Of pairs that overlap in a row, every other one merges, from the left.
            runs = np.diff(hits, prepend=-2) != 1
            first = np.maximum.accumulate(np.where(runs, hits, 0))
            hits = hits[(hits - first) % 2 == 0]
            joined = result[hits]
            keep = np.ones(symbols.size, bool)
            keep[hits + 1] = False
            before, after = symbols, symbols.copy()
            after[hits] = joined
            at = np.cumsum(keep)[hits] - 1  # where merged symbols are afterwards
            new, of = after[keep], word[keep]
            # Pairs that a merge makes: with what is left of it by then, and with what is still right of it.
            left = np.flatnonzero((at > 0) & (of[at - 1] == of[at]))
            left_rank, left_result = self._lookup(new[at[left] - 1], new[at[left]])
            follow = np.minimum(hits + 2, symbols.size - 1)
            right = np.flatnonzero((hits + 2 < symbols.size) & (word[follow] == word[hits]))
            right_rank, _ = self._lookup(joined[right], before[follow[right]])
            # One that ranks as high comes before the word's other merges: such words go one merge at a time.
            several = np.bincount(place[hits], minlength=best.size) > 1
            early = np.zeros(best.size, bool)
            for some, found in ((left, left_rank), (right, right_rank)):
                own = place[hits[some]]
                early[own[found <= best[own]]] = True
            early &= several
            starts = np.cumsum(sizes) - sizes
            for k in np.flatnonzero(early):
                lo = starts[k]
                own = before[lo : lo + sizes[k]]
                merged = np.array(self._merge_singly(own.tolist()), np.int32)
                done.append((merged, np.full(merged.size, word[lo])))
            rank, result = rank[keep], result[keep]
            rank[at], result[at] = _NONE, 0
            rank[at[left] - 1], result[at[left] - 1] = left_rank, left_result
            right = np.flatnonzero((at + 1 < new.size) & (of[np.minimum(at + 1, new.size - 1)] == of[at]))
            rank[at[right]], result[at[right]] = self._lookup(new[at[right]], new[at[right] + 1])
            symbols, word = new, of
            if early.any():
                stay = ~early[place[keep]]
                symbols, word, rank, result = (x[stay] for x in (symbols, word, rank, result))
        flat, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return flat[order], np.bincount(word)

    def _merge_singly(self, symbols: list[int]) -> list[int]:
        """One word merged pair by pair: the best rank first, of equal ranks the leftmost."""
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] >= 0:
                left, right = symbols[k], symbols[after[k]]
                found = self.pairs.get(left * self.width + right) if right < self.width else None
                if found:
                    heapq.heappush(queue, (found[0], k, left, right, found[1]))

        for k in range(len(symbols)):
            offer(k)
        while queue:
            _, k, left, right, new = heapq.heappop(queue)
            if symbols[k] != left or after[k] < 0 or symbols[after[k]] != right:
                continue
            gone = after[k]
            symbols[k], symbols[gone], after[k] = new, -1, after[gone]
            if after[k] >= 0:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [s for s in symbols if s >= 0]


class PieceModel:
    """A BPE model with byte fallback whose normalizer leaves texts alone but for spaces."""

    def __init__(self, data: bytes):
        pieces, flags = [], {3: 1, 4: 1, 5: 1}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own.get(2, bytes(4)))[0]
                pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif number == 3:
                flags |= dict(_fields(value))
        if flags.get(2) or flags[4] or not flags[5]:
            raise ValueError("only models whose normalizer is the identity, without removal of spaces")
        if {kind for *_, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with user-defined or unused pieces aren't supported")
        self.prefix = bool(flags[3])
        self.pieces = [piece for piece, *_ in pieces]
        self.kind = np.array([kind for *_, kind in pieces], np.int8)
        self.end_id = self.pieces.index("</s>")
        self.unknown_id = int(np.flatnonzero(self.kind == UNKNOWN)[0])
        self.byte_ids = np.zeros(256, np.int32)
        self.byte_of = {}
        for k in np.flatnonzero(self.kind == BYTE):
            self.byte_of[int(k)] = int(self.pieces[k][1:-1], 16)
            self.byte_ids[self.byte_of[int(k)]] = k
        if len(self.byte_of) != 256:
            raise ValueError("only models with byte fallback")
        self._symbols([(p, s, k) for k, (p, s, kind) in enumerate(pieces) if kind == NORMAL])
        self._surface()

    def _symbols(self, normal: list[tuple[str, float, int]]) -> None:
        """Symbols are pieces, and characters that are only parts of pieces; which pairs merge to what."""
        symbol = {piece: k for piece, _, k in normal}
        letters = sorted({c for piece, *_ in normal for c in piece})
        inside = sorted({c for piece, *_ in normal if len(piece) > 1 for c in piece})
        for c in letters:
            symbol.setdefault(c, len(self.pieces) + len(symbol))
        self.width = max(symbol.values()) + 1
        #: Symbol of each code point; others stand for themselves, above all symbols.
        self.of_point = np.arange(_POINTS, dtype=np.int32) + np.int32(self.width)
        self.of_point[[ord(c) for c in letters]] = [symbol[c] for c in letters]
        #: Class of each code point, and which classes follow each other within a piece.
        self.group = np.zeros(_POINTS, np.int16)
        self.group[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        self.follows = np.zeros((len(inside) + 1,) * 2, bool)
        scores = sorted({score for _, score, _ in normal}, reverse=True)
        rank = {score: k for k, score in enumerate(scores)}
        pairs = {}
        for piece, score, k in normal:
            own = self.group[[ord(c) for c in piece]]
            self.follows[own[:-1], own[1:]] = True
            for at in range(1, len(piece)):
                left, right = symbol.get(piece[:at]), symbol.get(piece[at:])
                if left is not None and right is not None:
                    pairs[left, right] = (rank[score], k)
        self.rounds = MergeRounds(pairs, self.width)

    def _surface(self) -> None:
        self.text = [
            "" if kind == CONTROL else piece.replace(SPACE, " ") for piece, kind in zip(self.pieces, self.kind)
        ]
        self.text[self.unknown_id] = " ⁇ "

    # --- encoding

    def _parts(self, text: str) -> Iterator[str]:
        """A text with the model's spaces, cut after about `PART` characters where no piece reaches across."""
        text = (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)
        at = 0
        while len(text) - at > PART:
            end = at + PART
            while end < len(text):
                near = self.group[np.frombuffer(text[end - 1 : end + 4096].encode("utf-32-le"), "<u4")]
                cuts = np.flatnonzero(~self.follows[near[:-1], near[1:]])
                if cuts.size:
                    end += int(cuts[0])
                    break
                end += 4096
            yield text[at:end]
            at = end
        if at < len(text):
            yield text[at:]

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        begins = np.cumsum([0, *map(len, parts)])[:-1]
        group = self.group[points]
        cut = np.ones(points.size, bool)
        cut[1:] = ~self.follows[group[:-1], group[1:]]
        cut[begins] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, points.size) * 4
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(points)]
        words = pa.Array.from_buffers(pa.large_binary(), starts.size, buffers).dictionary_encode()
        kind, distinct = words.indices.to_numpy(), words.dictionary
        edges = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] // 4
        letters = np.frombuffer(distinct.buffers()[2], "<u4")[edges[0] : edges[-1]]
        ids, counts = self.rounds.merge_words(self.of_point[letters], np.diff(edges))
        ids, counts = self._with_bytes(ids, counts)
        sizes = counts[kind]
        from_ = (np.cumsum(counts) - counts)[kind] - (np.cumsum(sizes) - sizes)
        flat = ids[np.repeat(from_, sizes) + np.arange(int(sizes.sum()))]
        return flat, np.add.reduceat(sizes, np.searchsorted(starts, begins))

    def _with_bytes(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for symbols: those that are no piece become the ids of their UTF-8 bytes."""
        other = np.flatnonzero(symbols >= len(self.pieces))
        if not other.size:
            return symbols, counts
        letter = {int(self.of_point[k]): k for k in np.flatnonzero(self.of_point < self.width)}
        points = [letter.get(s) if s < self.width else s - self.width for s in symbols[other].tolist()]
        spelled = [self.byte_ids[np.frombuffer(chr(p).encode(), np.uint8)] for p in points]
        sizes = np.ones(symbols.size, np.int64)
        sizes[other] = [len(s) for s in spelled]
        begin = np.cumsum(sizes) - sizes
        out = np.repeat(symbols, sizes)
        out[np.repeat(begin[other], sizes[other]) + np.concatenate([np.arange(len(s)) for s in spelled])] = (
            np.concatenate(spelled)
        )
        word = np.repeat(np.arange(counts.size), counts)
        return out, np.bincount(word, sizes, counts.size).astype(np.int64)

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has."""
        flats, counts, held, owners, size = [], [], [], [], 0

        def merge() -> None:
            nonlocal size
            if held:
                ids, sizes = self._encode_parts(held)
                flats.append(ids.astype(np.int32))
                np.add.at(total, owners, sizes)
            held.clear(), owners.clear()
            size = 0

        texts = list(texts)
        total = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            for part in self._parts(text):
                held.append(part), owners.append(k)
                size += len(part)
                if size >= PART:
                    merge()
        merge()
        return np.concatenate([np.empty(0, np.int32), *flats]), total

    # --- decoding

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: runs of byte pieces as UTF-8, the space put before a text taken off again."""
        ids = list(ids)
        out, raw, fresh = [], bytearray(), self.prefix
        plain = not any(k in self.byte_of for k in set(ids))
        if plain:
            out = [self.text[k] for k in ids]
            first = next((j for j, k in enumerate(ids) if self.text[k]), None)
            if fresh and first is not None and ids[first] != self.unknown_id and out[first][0] == " ":
                out[first] = out[first][1:]
            return "".join(out)
        for k in [*ids, None]:
            if k in self.byte_of:
                raw.append(self.byte_of[k])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw, fresh = bytearray(), False
            if k is None:
                break
            text = self.text[k]
            if text:
                out.append(text[1:] if fresh and k != self.unknown_id and text[0] == " " else text)
                fresh = False
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """Bytes as UTF-8; a byte that fits nowhere becomes one replacement character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out += [raw[at : at + wrong.start].decode(), REPLACEMENT]
            at += wrong.start + 1
    return "".join(out)


_loaded: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One for each worker process and file."""
    if path not in _loaded:
        with open(path, "rb") as file:
            _loaded[path] = PieceModel(file.read())
    return _loaded[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int, the end id last) and decoded (the text of these ids) of every whole text.

    A null or empty text is the end id alone and decodes to ''. Every row counts, repeated rows and rows
    without id too; other columns are ignored. A text without spaces is merged as it is, whatever its length.
    Nothing is shuffled. `path` is the model file, found at the same place on every executor.
    """
    path = path or public_path(MODEL)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        end = np.array([model.end_id], np.int32)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (size < PART or to == at):
                    size, to = size + len(texts[to]), to + 1
                flat, counts = model.encode(texts[at:to])
                ends = np.cumsum(counts)
                ids = np.insert(flat, ends, end[0])
                offsets = np.append(0, ends + np.arange(1, ends.size + 1))
                rows = ids.tolist()
                decoded = [model.decode(rows[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, to - at),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )
                at = to

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(each, "doc_id long, ids array<int>, decoded string")


def piece_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, one space between) and decoded_sha256."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
