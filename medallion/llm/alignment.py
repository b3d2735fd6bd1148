"""Alignment of the tokens of two tokenizers over the same bytes, as Arrow tables.

Documents are taken in chunks. A chunk's token lists are flattened with their parent indices, cumulative sums give
every token's end in the chunk's bytes, both tokenizers' ends are merged into the cuts of either, and group_by counts the
documents that hold a pair of linked ids. Spark merges these partial counts over the corpus and brings each chunk
those of its own pairs.
"""

from __future__ import annotations

import hashlib
import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm.common import stored
from medallion.llm.sentence_pieces import MODEL, MergeRounds, PieceModel, piece_model, public_path

BYTE_MODEL = "byte_bpe_50k.json"
#: Characters of a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 20

_LETTER, _DIGIT, _MARK = 1, 2, 3


class ByteTokenizer:
    """Ids of a byte-level BPE, and the bytes of each id.

    Its pattern starts a new word at a space between two characters that aren't white space. Texts are cut there,
    between characters that are surely none (ASCII, Latin letters). Words of such characters are split like its
    pattern does and merged in rounds; other words go to the tokenizer.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in printable}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            entries[k] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.entries = pa.array(entries, pa.large_binary())
        self.of_byte = np.zeros(256, np.int32)
        self.of_byte[list(byte.values())] = [vocabulary[c] for c in byte]
        merges = json.loads(self.whole.to_str())["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        pairs = {(vocabulary[x], vocabulary[y]): (rank, vocabulary[x + y]) for rank, (x, y) in enumerate(merges)}
        self.rounds = MergeRounds(pairs, len(entries))
        self.kind = np.zeros(0x110000, np.int8)
        self.kind[0x21:0x7F] = _MARK
        self.kind[0x30:0x3A] = _DIGIT
        for low, high in ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250)):
            self.kind[low:high] = _LETTER
        self.kind[[0xD7, 0xF7]] = _MARK

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all texts, where words start, which are odd (not of known characters), where texts start."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        begins = np.cumsum([0, *map(len, texts)])[:-1]
        kind = self.kind[points]
        space = points == 0x20
        cut = np.zeros(points.size, bool)
        cut[1:-1] = space[1:-1] & (kind[:-2] > 0) & (kind[2:] > 0)
        cut[begins] = True
        starts = np.flatnonzero(cut)
        known = kind > 0
        known[starts[space[starts]]] = True
        # A space alone, or one before the end of a text, isn't the begin of a word.
        ends = np.append(starts[1:], points.size)
        odd = ~np.logical_and.reduceat(known, starts) | (space[starts] & (ends - starts == 1))
        # Within words of known characters, words end where the kind of character changes.
        plain = ~np.repeat(odd, ends - starts)
        inner = np.zeros(points.size, bool)
        inner[1:] = plain[1:] & (kind[1:] != kind[:-1]) & (kind[:-1] > 0) & (kind[1:] > 0)
        inner &= ~cut
        self._contractions(points, kind, plain & ~space, inner)
        inner |= cut
        at = np.flatnonzero(inner)
        return points, at, ~plain[at], begins

    @staticmethod
    def _contractions(points: np.ndarray, kind: np.ndarray, plain: np.ndarray, cut: np.ndarray) -> None:
        """An apostrophe after a letter or digit begins 's, 't, 'm, 'd, 're, 've or 'll, whatever follows them."""
        at = np.flatnonzero((points == 0x27) & plain & cut)
        at = at[at + 1 < points.size]
        follow = [points[np.minimum(at + k, points.size - 1)] for k in (1, 2)]
        inside = [plain[np.minimum(at + k, points.size - 1)] & (at + k < points.size) for k in (1, 2)]
        one = inside[0] & np.isin(follow[0], [ord(c) for c in "stmd"])
        pair = (follow[0].astype(np.int64) << 32) | follow[1]
        two = inside[0] & inside[1] & np.isin(pair, [(ord(a) << 32) | ord(b) for a, b in ("re", "ve", "ll")])
        for hit, size in ((one, 2), (two, 3)):
            cut[at[hit] + 1] = False
            end = at[hit] + size
            end = end[end < points.size]
            cut[end[plain[end]]] = True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none empty), one after another, and how many each text has."""
        points, starts, odd, begins = self._words(texts)
        offsets = np.append(starts, points.size).astype(np.int64) * 4
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(points)]
        words = pa.Array.from_buffers(pa.large_binary(), starts.size, buffers).dictionary_encode()
        kind, distinct = words.indices.to_numpy(), words.dictionary
        strange = np.zeros(len(distinct), bool)
        strange[kind[odd]] = True  # equal words are all odd, or none is
        spelled = [w.decode("utf-32-le") for w in distinct.to_pylist()]
        plain = [w.encode() for w, s in zip(spelled, strange) if not s]
        sizes = np.zeros(len(distinct), np.int64)
        flats = []
        if plain:
            symbols = self.of_byte[np.frombuffer(b"".join(plain), np.uint8)]
            flat, sizes[~strange] = self.rounds.merge_words(symbols, np.array([len(w) for w in plain]))
            flats.append(flat)
        if strange.any():
            texts = [w for w, s in zip(spelled, strange) if s]
            found = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
            sizes[strange] = [len(ids) for ids in found]
            flats.append(np.fromiter((k for ids in found for k in ids), np.int32))
        flat = np.concatenate(flats)
        at = np.zeros(len(distinct), np.int64)
        order = np.argsort(strange, kind="stable")  # as the flat ids are
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        own = sizes[kind]
        from_ = at[kind] - (np.cumsum(own) - own)
        flat = flat[np.repeat(from_, own) + np.arange(int(own.sum()))]
        return flat, np.add.reduceat(own, np.searchsorted(starts, begins))


def piece_entries(model: PieceModel) -> pa.Array:
    """The bytes of each id of a piece model."""
    entries = [
        bytes([model.byte_of[k]]) if k in model.byte_of else text.encode() for k, text in enumerate(model.text)
    ]
    return pa.array(entries, pa.large_binary())


class Aligner:
    """Aligns chunks of texts; A is the byte-level tokenizer, B the piece model."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path), piece_model(piece_path)
        self.entries = [self.a.entries, piece_entries(self.b)]
        # What is written after an id: A's ends with "|" where a group ends, B's with ";".
        self.written = [f"{k}{mark}" for k in range(len(self.a.entries)) for mark in ",|"]
        self.first_b = len(self.written)
        self.written += [f"{k}{mark}" for k in range(len(self.b.pieces)) for mark in ",;"]

    def _ends(self, side: int, ids: np.ndarray) -> np.ndarray:
        """Where each token ends, in the bytes of all documents."""
        spelled = self.entries[side].take(pa.array(ids, pa.int32()))
        return pc.cumulative_sum(pc.binary_length(spelled).cast(pa.int64())).to_numpy()

    def _kept(self, texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Which texts both tokenizers spell exactly, and ids and counts of those, by tokenizer."""
        use = [k for k, text in enumerate(texts) if text]
        spaced = [" " + texts[k] for k in use]
        sides = [self.a.encode(spaced) if use else (np.empty(0, np.int32), np.empty(0, np.int64))]
        sides.append(self.b.encode(texts[k] for k in use))
        want = [text.encode() for text in spaced]
        good = np.ones(len(use), bool)
        for side, (ids, counts) in enumerate(sides):
            spelled = self.entries[side].take(pa.array(ids, pa.int32()))
            edges = np.zeros(1, np.int64)
            if len(spelled):
                edges = np.frombuffer(spelled.buffers()[1], np.int64)[: len(spelled) + 1]
            raw, ends = memoryview(spelled.buffers()[2] or b"").cast("B"), np.cumsum(counts)
            for k, (lo, hi) in enumerate(zip(edges[ends - counts], edges[ends])):
                good[k] &= raw[lo:hi] == want[k]
        fine = np.flatnonzero(good)
        out = []
        for ids, counts in sides:
            stay = np.repeat(good, counts)
            out.append((ids[stay], counts[fine]))
        return np.array(use, np.int64)[fine], out

    def align(self, texts: list[str]) -> tuple[dict[str, list], pa.Table, pa.Table]:
        """By text: n_a, n_b, n_groups, n_links, groups. Then the chunk's pairs (a, b, docs) and links (doc, pair, times).

        Two tokens are linked if their bytes overlap: between any two neighbouring cuts of either tokenizer lies
        one link, of the tokens that end there or next.
        """
        own, sides = self._kept(texts)
        n = len(texts)
        out = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
        groups = [""] * n
        if not own.size:
            none = pa.array([], pa.int32())
            pairs = pa.table({"a": none, "b": none, "docs": pa.array([], pa.int64())})
            links = pa.table({"doc": none, "pair": none, "times": none})
            return out | {"groups": groups}, pairs, links
        # Both spell the same bytes, so a document's last token ends at the same place for both.
        (ids_a, n_a), (ids_b, n_b) = sides
        end_a, end_b = self._ends(0, ids_a), self._ends(1, ids_b)
        cuts = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        cuts = cuts[np.append(True, np.diff(cuts) > 0)]
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)  # the tokens that end there or next
        has_a, has_b = end_a[at_a] == cuts, end_b[at_b] == cuts
        both, doc = has_a & has_b, np.repeat(np.arange(n_a.size), n_a)[at_a]
        a, b = ids_a[at_a], ids_b[at_b]
        out["n_a"][own], out["n_b"][own] = (counts for _, counts in sides)
        out["n_links"][own] = np.bincount(doc, minlength=own.size)
        out["n_groups"][own] = np.bincount(doc[both], minlength=own.size)
        for k, text in zip(own, self._groups(sides, both[has_a], both[has_b])):
            groups[k] = text
        held = pa.table({"doc": own[doc].astype(np.int32), "a": a.astype(np.int32), "b": b.astype(np.int32)})
        held = held.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
        pairs = held.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        pairs = pairs.rename_columns({"count_all": "docs"}).combine_chunks()
        place = pairs.select(["a", "b"]).append_column("pair", pa.array(np.arange(len(pairs), dtype=np.int32)))
        links = held.join(place, ["a", "b"], join_type="inner", use_threads=False)
        links = links.select(["doc", "pair", "count_all"]).rename_columns(["doc", "pair", "times"])
        links = links.sort_by([("doc", "ascending"), ("pair", "ascending")])
        return out | {"groups": groups}, pairs, links.set_column(2, "times", links["times"].cast(pa.int32()))

    def _groups(self, sides, cut_a: np.ndarray, cut_b: np.ndarray) -> Iterator[str]:
        """a1,a2|b1;a3|b2,b3 of each document; the flags say which tokens end a group."""
        (a, n_a), (b, n_b) = sides
        of_a, of_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b  # a token's group, over the whole chunk
        in_a, in_b = np.bincount(of_a), np.bincount(of_b)
        line = np.empty(a.size + b.size, np.int64)
        line[np.arange(a.size) + (np.cumsum(in_b) - in_b)[of_a]] = 2 * a.astype(np.int64) + cut_a
        line[np.arange(b.size) + np.cumsum(in_a)[of_b]] = self.first_b + 2 * b.astype(np.int64) + cut_b
        ends = np.cumsum(n_a + n_b)
        for lo, hi in zip(ends - n_a - n_b, ends):
            yield "".join([self.written[k] for k in line[lo:hi].tolist()])[:-1]


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One for each worker process and pair of files."""
    if (byte_path, piece_path) not in _loaded:
        _loaded[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _loaded[byte_path, piece_path]


def _packed(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue()


COUNTS = "n_a n_b n_groups n_links".split()
CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64()))]
    + [(name, pa.list_(pa.int64())) for name in COUNTS]
    + [("groups_sha256", pa.list_(pa.string()))]
    + [("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64()))]
    + [("links", pa.binary())]
)


def aligned_chunks(documents: DataFrame, byte_path: str, piece_path: str, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of documents: by document its counts and groups, by pair its documents, and the links."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(byte_path, piece_path).align
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def finished() -> pa.RecordBatch:
            nonlocal number, size
            by_text, pairs, links = align(texts)
            hashed = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in by_text["groups"]]
            row = [number, list(ids), *(by_text[c].tolist() for c in COUNTS), hashed]
            row += [pairs[c].to_numpy() for c in ("a", "b", "docs")] + [_packed(links)]
            number, size = number + 1, 0
            ids.clear(), texts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, CHUNKS)], schema=CHUNKS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id), texts.append(text or "")
                size += len(texts[-1])
                if size >= chunk:
                    yield finished()
        if texts:
            yield finished()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    kinds = {"chunk": "long", "groups_sha256": "array<string>", "links": "binary", "a": "array<int>", "b": "array<int>"}
    return rows.mapInArrow(each, ", ".join(f"{f.name} {kinds.get(f.name, 'array<long>')}" for f in CHUNKS))


ALIGNED = pa.schema(
    [("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in [*COUNTS, "n_best", "count_sum"]]
    + [("groups_sha256", pa.string())]
)


def _judged(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the corpus-wide counts of their links."""
    out = []
    counts = counts.sort_by("pair")
    for row in chunk.to_pylist():
        with pa.ipc.open_stream(row["links"]) as stream:
            links = stream.read_all()
        own = counts.select(["count", "top"]).take(links["pair"])
        times = links["times"].cast(pa.int64())
        best = pc.multiply(own["top"].cast(pa.int64()), times)
        found = pa.table({"doc": links["doc"], "n_best": best, "count_sum": pc.multiply(own["count"], times)})
        found = found.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        sums = np.zeros((2, len(row["doc_id"])), np.int64)
        sums[:, found["doc"].to_numpy()] = found["n_best_sum"].to_numpy(), found["count_sum_sum"].to_numpy()
        columns = [row["doc_id"], *(row[c] for c in COUNTS), *sums, row["groups_sha256"]]
        out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ALIGNED)], schema=ALIGNED))
    return pa.concat_tables(out) if out else ALIGNED.empty_table()


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, count, top): how many documents hold the pair linked, and whether that is the most of any pair of a."""
    pairs = chunks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p"))
    counts = stored(pairs.groupBy("p.a", "p.b").agg(F.sum("p.docs").alias("count")), "alignment-counts")
    # As many rows as the first tokenizer has ids, at most.
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("top"))


def align_tokenizers(
    documents: DataFrame, byte_path: str | None = None, piece_path: str | None = None, chunk: int = CHUNK
) -> DataFrame:
    """By document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A are the ids of a space and the text by a byte-level BPE, B those of the text by a piece model. Places where
    tokens of both end cut a text into groups; A and B tokens whose bytes overlap are linked. A pair's count is the
    number of documents, of the whole corpus, that hold it linked; `n_best` are links whose count is the highest of
    their A id, `count_sum` sums the counts of all links, and `groups_sha256` is the hash of the groups written like
    a1,a2|b1;a3|b2,b3.

    Null and empty texts, and texts that either tokenizer's tokens don't spell exactly, have zeros and ''. Every row
    counts as a document, repeated rows and rows without id too; other columns are ignored.
    """
    chunks = aligned_chunks(documents, byte_path or public_path(BYTE_MODEL), piece_path or public_path(MODEL), chunk)
    chunks = stored(chunks, "alignment-chunks")
    held = chunks.select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("a", "b")).alias("pair", "p"))
    held = held.select("of", "pair", "p.a", "p.b")
    counts = held.join(pair_counts(chunks), ["a", "b"]).select("of", "pair", "count", "top")
    rest = chunks.drop("a", "b", "docs")
    kinds = {"groups_sha256": "string"}
    schema = ", ".join(f"{f.name} {kinds.get(f.name, 'long')}" for f in ALIGNED)
    return rest.groupBy("chunk").cogroup(counts.groupBy("of")).applyInArrow(_judged, schema)
