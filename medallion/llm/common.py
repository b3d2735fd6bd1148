"""What several operators of this folder share: reading, working tables, word hashes, components."""

from __future__ import annotations

import io
import zipfile
import zlib
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import workspace
from medallion.sinks.writers import remove_directory, write_bytes

SHINGLE = 5
#: Rows that a Python worker is handed at a time.
BATCH_ROWS = 2_000
#: Bits that keys are marked in: some 10 MB to broadcast at the most.
MARK_BITS = 1 << 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
_PIECE = 1 << 20


_shared: set[str] = set()


def share_checkout(spark: SparkSession) -> None:
    """Let Python workers import this package: Spark sends every executor a zip of it, once per application.

    The zip lies in the shared working folder. Texts can be long, so workers are handed fewer rows at a time than
    Spark's default, which bounds what one holds.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shared:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    archive = f"{workspace(spark, 'package')}/{root.name}-package.zip"
    context.addPyFile(write_bytes(spark, archive, packed.getvalue()))
    _shared.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_working: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared working folder and read back: computed once, lineage cut."""
    path = workspace(df.sparkSession, label)
    _working.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def working_tables(spark: SparkSession):
    """Removes the tables that are stored inside, but the last, when all is done: the last is what was made of them."""
    before = len(_working)
    yield
    made = _working[before:]
    del _working[before:]
    for path in made[:-1]:
        remove_directory(spark, path)
    _working.extend(made[-1:])


def by_marks(df: DataFrame, column: str, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose `column` may be among the keys, and rows whose `column` surely isn't (nulls too), without a shuffle.

    The keys are a bit for each of their hashes, which is broadcast: `MARK_BITS` at most, however many keys there are.
    All rows of keys are in the first part. Others get there as hashes meet, the more of them the more keys there
    are: a join by the key itself decides, which has few rows to shuffle where there are few keys.
    """
    of_type = F.col(f"`{column}`").cast(keys.schema[key].dataType)
    bit, cell = F.pmod(F.xxhash64(key), F.lit(MARK_BITS)).alias("_mark_bit"), F.shiftright("_mark_bit", 6)
    one = F.expr("shiftleft(1L, cast(_mark_bit & 63 as int))")
    marks = keys.select(bit).groupBy(cell.alias("_mark_cell")).agg(F.bit_or(one).alias("_mark_mask"))
    rows = df.withColumn("_mark_bit", F.pmod(F.xxhash64(of_type), F.lit(MARK_BITS))).withColumn("_mark_cell", cell)
    rows = rows.join(F.broadcast(marks), "_mark_cell", "left")
    hit = F.expr("shiftright(_mark_mask, cast(_mark_bit & 63 as int)) & 1L = 1L") & F.col(f"`{column}`").isNotNull()
    rows = rows.withColumn("_mark_hit", F.coalesce(hit, F.lit(False)))
    own = [f"`{c}`" for c in df.columns]
    return rows.where("_mark_hit").select(*own), rows.where("not _mark_hit").select(*own)


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: the checksum of its id, written in decimal, modulo `folds`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def crc_fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(2)
def _bytes_table(bare: bool) -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte (A-Z as a-z, separators 0), and which bytes are separators.

    Separators are ASCII white space, or with `bare` all of ASCII but letters and digits.
    """
    value = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    if bare:
        space[:128] = [not chr(c).isalnum() for c in range(128)]
    value[space] = 0
    return value, space


@lru_cache(4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, 2**bits of each."""
    inverse = pow(int(_STEP), -1, 1 << 64)
    out = []
    for base in (int(_STEP), inverse):
        p = np.ones(1 << bits, np.uint64)
        for k in range(bits):
            p[1 << k : 2 << k] = p[: 1 << k] * np.uint64(pow(base, 1 << k, 1 << 64))
        out.append(p)
    return out[0], out[1]


def _piece_hashes(b: np.ndarray, bare: bool) -> np.ndarray:
    value, space = _bytes_table(bare)
    gap = space[b]
    start = ~gap
    start[1:] &= gap[:-1]
    starts = np.flatnonzero(start)
    if not starts.size:
        return np.empty(0, np.uint64)
    up, down = _powers(max(8, int(b.size).bit_length()))
    return _mix(np.add.reduceat(value[b] * up[: b.size], starts) * down[starts])


def word_hashes(text: str, bare: bool = False) -> np.ndarray:
    """64-bit hash of every word (run of bytes that aren't ASCII white space, A-Z as a-z), in order.

    With `bare`, words end at any ASCII character but letters and digits.

    A word's hash is a polynomial over random values of its bytes, so all words of a text take a few
    vector operations. Long texts go piece by piece, cut at white space.
    """
    b = np.frombuffer(text.encode(), np.uint8)
    if b.size <= _PIECE:
        return _piece_hashes(b, bare)
    gaps, at, out = np.flatnonzero(_bytes_table(bare)[1][b]), 0, []
    while at < b.size:
        k = np.searchsorted(gaps, at + _PIECE)
        end = int(gaps[k]) if k < gaps.size else b.size
        out.append(_piece_hashes(b[at:end], bare))
        at = end
    return np.concatenate(out)


def stem_hashes(text: str, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each of the ascending `lengths`, hashes of the first so many bytes of every longer word.

    Words are as with `bare`.
    """
    value, space = _bytes_table(True)
    b = np.frombuffer(text.encode(), np.uint8)
    edges = np.flatnonzero(np.diff(space[b], prepend=True, append=True))
    at, size = edges[::2], edges[1::2] - edges[::2]
    out, h, done = [], np.zeros(at.size, np.uint64), 0
    for k in lengths:
        longer = size > k
        at, size, h = at[longer], size[longer], h[longer]
        for j in range(done, k):
            h = h * _STEP + value[b[at + j]]
        done = k
        out.append(_mix(h + np.uint64(k)))
    return out


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word shingles of a text, in order, from its word hashes. Fewer words are one shingle."""
    n, width = words.size, min(SHINGLE, words.size)
    if not n:
        return words
    s = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        s = s * _STEP + words[j : n - width + 1 + j]
    return _mix(s)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of a text.

    Fewer words count as one shingle, no words or no text as none.
    """
    return np.unique(shingle_hashes(word_hashes(text) if text else np.empty(0, np.uint64)))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of the nodes of undirected `edges` (a, b); component is the smallest node.

    Large-star and small-star steps on edge tables, each step stored: every step is joins and grouped
    minima, a node with a third of all edges arrives as one minimum per task, and the rounds grow with
    the logarithm of a component's size.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = stored(edges.where("a <> b").select(*ends).distinct(), label)
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        large = stored(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.select(*ends).where("a <> b")
        now = stored(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), label)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
