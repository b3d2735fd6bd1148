"""Line dedup: a segment-partition edit join of all lines.

Two lines within some edits have one of so many segments, and one more, of the shorter one in common, at nearly
the same place. Every distinct line is indexed by its segments and probes with the substrings that can match a segment
of a line up to `most` shorter; keys hold length, segment number and a hash of the substring. Lines that meet
are compared by their letters' counts, then exactly, with a banded bit-parallel automaton.

Edits are the same for lines of all lengths, or with `per` one for each `per` code points of the shorter line, so
that short lines go as exact repeats only. With `per`, a line also goes only for being near a line that is kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import _ODD, _STEP, _mix, _powers, stored

#: Edits within which a line repeats an earlier one.
MOST = 2
#: Shorter lines are left alone: below, two edits are more than a quarter of a line.
LEAST_CHARS = 8
#: Code points that a line has for each edit, where edits follow the length.
PER_EDIT = 20
#: Pairs of lines that one task decides in order, once rounds over all have left no more.
ONE_TASK = 1_000_000
#: Code points handled at once when keys are made.
_PIECE = 1 << 20
_BUCKETS = 16
#: White space besides line feeds, of which blank lines consist; as code points and as a pattern.
_SPACES = np.array([9, 11, 12, 13, 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x3000], np.uint32)
_BLANK = r"^[\t\x0B\f\r \x{85}\x{A0}\x{2000}-\x{200A}\x{3000}]*\z"


def within(a: str, b: str, most: int) -> bool:
    """Whether two strings are at most `most` edits (insert, delete, replace) apart.

    What both begin and end with is cut off by bisection. For the rest, `most` + 1 bit rows say which places of
    `a` are reachable with so many edits; only the 2 * most + 1 places around the diagonal are kept, in a frame
    that moves along with `b`.
    """
    if abs(len(a) - len(b)) > most:
        return False
    k = min(len(a), len(b))
    start = bisect_left(range(1, k + 1), True, key=lambda n: a[:n] != b[:n])
    a, b = a[start:], b[start:]
    k = min(len(a), len(b))
    end = bisect_left(range(1, k + 1), True, key=lambda n: a[-n:] != b[-n:])
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return max(len(a), len(b)) <= most
    frame = (1 << (2 * most + 1)) - 1
    rows = [1 << most]
    for d in range(1, most + 1):
        rows.append((rows[-1] | rows[-1] << 1) & frame)
    for j, c in enumerate(b):
        match = 0
        for bit in range(max(0, most - j), min(2 * most + 1, len(a) - j + most)):
            match |= (a[j + bit - most] == c) << bit
        new = [rows[0] & match]
        for d in range(1, most + 1):
            new.append((rows[d] & match | rows[d - 1] | rows[d - 1] >> 1 | new[-1] << 1) & frame)
        rows = new
        if not rows[most]:
            return False
    place = len(a) - len(b) + most
    return 0 <= place <= 2 * most and bool(rows[most] >> place & 1)


def _segments(length: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of each of `parts` segments of lines of the given lengths; the last ones are longer."""
    small, longer = length // parts, length % parts
    out, at = [], np.zeros_like(length)
    for i in range(parts):
        size = small + (i >= parts - longer)
        out.append((at, size))
        at = at + size
    return out


def line_keys(texts: list[str], most: int, least: int, per: int | None = None) -> Iterator[pd.DataFrame]:
    """(key, line, letters) of the distinct lines of some texts: keys of segments and of probes.

    `line` is a hash of the line, its last bit is 1 for probes; `letters` holds sixteen 4-bit counts of
    characters. A hash is a polynomial over the code points, so keys of all lines come from running sums.
    """
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    ends = np.append(np.flatnonzero(points == 10), points.size)
    starts = np.append(0, ends[:-1] + 1)
    ok = ends - starts >= max(least, per or 0)
    starts, ends = starts[ok], ends[ok]
    if not starts.size:
        return
    up, down = _powers(max(8, int(points.size + 1).bit_length()))
    value = (points.astype(np.uint64) + np.uint64(1)) * _ODD
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * up[: points.size], dtype=np.uint64)])

    def hashed(at: np.ndarray, to: np.ndarray) -> np.ndarray:
        return (sums[to] - sums[at]) * down[at]

    length = ends - starts
    line = _mix(hashed(starts, ends) + length.astype(np.uint64) * _STEP) | np.uint64(1)
    _, first = np.unique(line, return_index=True)
    starts, length, line = starts[first], length[first], line[first]
    owner = np.repeat(np.arange(starts.size), length)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts, length)
    bucket = (points[at].astype(np.int64) * 7 >> 1) % _BUCKETS
    counts = np.bincount(owner * _BUCKETS + bucket, minlength=starts.size * _BUCKETS).reshape(-1, _BUCKETS) & 15
    letters = (counts.astype(np.uint64) << (np.arange(_BUCKETS, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64)

    def rows(number: int, of: np.ndarray, begin: np.ndarray, size: np.ndarray, kind: int, pick) -> pd.DataFrame:
        tag = (of.astype(np.uint64) * np.uint64(64) + np.uint64(number)) * _STEP
        key = _mix(hashed(begin, begin + size) + tag)
        mark = line[pick] if kind else line[pick] ^ np.uint64(1)
        return pd.DataFrame({"key": key.view(np.int64), "line": mark.view(np.int64), "letters": letters[pick].view(np.int64)})

    for edits in range(1, most + 1) if per else [most]:
        pick = np.flatnonzero(np.minimum(most, length // per) == edits) if per else np.arange(starts.size)
        for i, (p, size) in enumerate(_segments(length[pick], edits + 1)):
            yield rows(i, length[pick], starts[pick] + p, size, 0, pick)
        for shorter in range(edits + 1):
            of = length - shorter
            pick = np.flatnonzero((of >= least) & (np.minimum(most, of // per) == edits if per else True))
            of = of[pick]
            for i, (p, size) in enumerate(_segments(of, edits + 1)):
                for move in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                    fits = (p + move >= 0) & (p + move + size <= length[pick])
                    yield rows(i, of[fits], (starts[pick] + p + move)[fits], size[fits], 1, pick[fits])


def _document() -> list[Column]:
    """A document's identity: its id and a hash of its text, for rows that share an id."""
    return [F.col("doc_id"), F.xxhash64("text").alias("tie")]


def _differing(a: str, b: str) -> Column:
    """How much the packed counts differ in all; a replaced character changes two counts by one."""
    total = F.lit(0)
    for k in range(_BUCKETS):
        d = F.shiftrightunsigned(F.col(a), 4 * k).bitwiseAND(15) - F.shiftrightunsigned(F.col(b), 4 * k).bitwiseAND(15)
        d = F.pmod(d, F.lit(16))
        total = total + F.least(d, F.lit(16) - d)
    return total


def first_occurrences(documents: DataFrame, least: int, blank: bool = True) -> DataFrame:
    """(line, doc_id, tie, line_no, n): where each distinct line first occurs, by document then line, and how often.

    Lines of nothing but white space count only with `blank`.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_line_hashes(np.frombuffer((t or "").encode("utf-32-le"), np.uint32), least, blank) for t in batch["text"]]
            of = np.repeat(np.arange(len(batch)), [line.size for line, _ in found])
            yield pd.DataFrame(
                {
                    "line": np.concatenate([np.empty(0, np.int64), *(line for line, _ in found)]),
                    "doc_id": batch["doc_id"].astype("Int64").array[of],
                    "tie": batch["tie"].to_numpy()[of],
                    "line_no": np.concatenate([np.empty(0, np.int32), *(number for _, number in found)]),
                }
            )

    rows = documents.select(*_document(), "text").mapInPandas(each, "line long, doc_id long, tie long, line_no int")
    first = F.min(F.struct("doc_id", "tie", "line_no")).alias("f")
    return rows.groupBy("line").agg(first, F.count("*").alias("n")).select("line", "f.*", "n")


def _line_hashes(points: np.ndarray, least: int, blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number) of the lines of one text that have `least` code points; hashes as in `line_keys`, even."""
    ends = np.append(np.flatnonzero(points == 10), points.size)
    starts = np.append(0, ends[:-1] + 1)
    ok = ends - starts >= least
    if not blank:
        dark = np.append(0, np.cumsum(~np.isin(points, _SPACES)))
        ok &= dark[ends] > dark[starts]
    number = np.flatnonzero(ok)
    starts, ends = starts[number], ends[number]
    up, down = _powers(max(8, int(points.size + 1).bit_length()))
    value = (points.astype(np.uint64) + np.uint64(1)) * _ODD
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * up[: points.size], dtype=np.uint64)])
    h = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)
    return ((h | np.uint64(1)) ^ np.uint64(1)).view(np.int64), number.astype(np.int32)


def near_lines(documents: DataFrame, first: DataFrame, most: int, least: int, per: int | None = None) -> DataFrame:
    """(line, other): pairs of different lines within `most` edits, or one for each `per` code points, each once."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [], 0
            for text in batch["text"].dropna():
                held.append(text)
                size += len(text)
                if size >= _PIECE:
                    yield from line_keys(held, most, least, per)
                    held, size = [], 0
            yield from line_keys(held, most, least, per)

    rows = documents.select("text").mapInPandas(keys, "key long, line long, letters long")
    group = Window.partitionBy("key")
    bare = F.shiftrightunsigned("line", 1)
    rows = rows.withColumns({"least": F.min(bare).over(group), "most": F.max(bare).over(group)})
    met = stored(rows.where("least <> most").select("key", "line", "letters").distinct(), "met")
    probe = F.col("line").bitwiseAND(1) == 1
    left = met.where(~probe).select("key", "line", "letters")
    right = met.where(probe).select(
        F.col("key").alias("its_key"), F.col("line").bitwiseXOR(F.lit(1).cast("long")).alias("other"), F.col("letters").alias("others")
    )
    alike = _differing("letters", "others") <= 2 * most
    pairs = left.join(right, (F.col("key") == F.col("its_key")) & (F.col("line") != F.col("other")) & alike)
    pairs = pairs.select(F.least("line", "other").alias("line"), F.greatest("line", "other").alias("other")).distinct()
    pairs = stored(pairs, "pairs")

    needed = pairs.select("line").unionByName(pairs.select(F.col("other").alias("line"))).distinct()
    at = first.join(needed, "line").groupBy("doc_id", "tie").agg(F.collect_list(F.struct("line", "line_no")).alias("lines"))
    at = at.withColumnRenamed("doc_id", "its_id").withColumnRenamed("tie", "its_tie")
    here = documents.select(*_document(), "text")
    here = here.join(at, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("tie") == F.col("its_tie")))
    here = here.select(F.split("text", "\n").alias("all"), "lines").select("all", F.explode("lines").alias("l"))
    texts = here.select("l.line", F.element_at("all", F.col("l.line_no") + 1).alias("text"))
    texts = stored(texts.dropDuplicates(["line"]), "line-texts")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [
                within(a, b, min(most, min(len(a), len(b)) // per) if per else most)
                for a, b in zip(batch["text"], batch["other_text"])
            ]
            yield batch.loc[ok, ["line", "other"]]

    others = texts.select(F.col("line").alias("other"), F.col("text").alias("other_text"))
    return pairs.join(texts, "line").join(others, "other").select("line", "other", "text", "other_text").mapInPandas(
        verified, "line long, other long"
    )


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines that go, of pairs (line, earlier) in order of line: those near an earlier line that doesn't go."""
    gone: set[int] = set()
    for batch in batches:
        gone.update(line for line, earlier in zip(batch["line"], batch["earlier"]) if earlier not in gone)
    yield pd.DataFrame({"line": np.array(sorted(gone), np.int64)})


def near_kept(pairs: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(line): the lines that go, of pairs (line, place, earlier) of a line, its place and a near line before it.

    In order of place, a line goes if one of those before it stays. In rounds over all pairs, lines of which no
    pair is left stay, lines near those go, and both are done with; the first undecided line is always decided.
    Once few pairs are left, one task decides them in order.
    """
    gone = None
    while True:
        open_ = pairs.count()
        if open_ <= one_task:
            break
        lines = pairs.select("line").distinct()
        stay = pairs.select(F.col("earlier").alias("line")).distinct().join(lines, "line", "left_anti")
        go = pairs.join(stay.select(F.col("line").alias("earlier")), "earlier", "left_semi").select("line").distinct()
        go = stored(go, "gone-lines")
        gone = go if gone is None else gone.unionByName(go)
        pairs = pairs.join(go, "line", "left_anti").join(go.select(F.col("line").alias("earlier")), "earlier", "left_anti")
        pairs = stored(pairs.select("line", "place", "earlier"), "open-pairs")

    ordered = pairs.coalesce(1).sortWithinPartitions("place").select("line", "earlier")
    last = stored(ordered.mapInPandas(_in_order, "line long"), "last-lines")
    return last if gone is None else gone.unionByName(last)


def kept_lines(documents: DataFrame, most: int = MOST, least: int = LEAST_CHARS, per: int | None = None) -> DataFrame:
    """(doc_id, tie, kept): per document, the numbers (from 0) of its lines that repeat no earlier line.

    A line is kept if no line before it, by document id (null first) then line number, is within `most` edits.
    Only lines of at least `least` code points take part; documents that keep none of them aren't in the result.
    With `per`, lines are as many edits apart as the shorter one has `per` code points, `most` at the most, a line
    is kept if no line before it that is kept is so near, and blank lines take no part.
    """
    first = stored(first_occurrences(documents, least, per is None), "first-lines")
    pairs = stored(near_lines(documents, first, most, least, per), "near-lines")
    place = F.struct("doc_id", "tie", "line_no")
    line = first.select("line", place.alias("place"))
    other = first.select(F.col("line").alias("other"), place.alias("other_place"))
    later = pairs.join(line, "line").join(other, "other")
    is_first = F.col("place") < F.col("other_place")
    if per is None:
        gone = later.select(F.when(is_first, F.col("other")).otherwise(F.col("line")).alias("line")).distinct()
    else:
        ends = {
            "line": F.when(is_first, F.col("other")).otherwise(F.col("line")),
            "place": F.greatest("place", "other_place"),
            "earlier": F.when(is_first, F.col("line")).otherwise(F.col("other")),
        }
        gone = near_kept(stored(later.select(*[c.alias(n) for n, c in ends.items()]), "open-pairs"))
    alone = first.join(gone, "line", "left_anti")
    return alone.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list("line_no")).alias("kept"))


def _joined(documents: DataFrame, kept: DataFrame) -> DataFrame:
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie"), "kept")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie"))
    return documents.join(kept, same, "left").drop("kept_id", "kept_tie")


def _takes_part(line: Column, least: int, per: int | None) -> Column:
    long = F.char_length(line) >= least
    return long if per is None else long & ~line.rlike(_BLANK)


def line_report(documents: DataFrame, most: int = MOST, least: int = LEAST_CHARS, per: int | None = None) -> DataFrame:
    """Per row of documents: doc_id, n_lines, n_long_lines (of `least` code points), n_kept (of those), kept.

    `kept` lists the numbers of the long lines that repeat no earlier line. With `per` (see `kept_lines`), blank
    lines are not long. Null texts have no lines, an empty
    text has one empty line. A repeated row (same id and text) is the same document and keeps the same lines.
    Empty documents give no rows.
    """
    lines = F.coalesce(F.split("text", "\n"), F.array().cast("array<string>"))
    long = F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + _takes_part(x, least, per).cast("long"))
    counted = documents.select(*_document(), F.size(lines).cast("long").alias("n_lines"), long.alias("n_long_lines"))
    out = _joined(counted, kept_lines(documents, most, least, per))
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", "n_long_lines", F.size(kept).cast("long").alias("n_kept"), kept.alias("kept"))


def without_repeated_lines(
    documents: DataFrame, most: int = MOST, least: int = LEAST_CHARS, short_count: bool = False, per: int | None = None
) -> DataFrame:
    """Documents without the lines that repeat an earlier one, with their columns; `n_chars` follows the text.

    Shorter lines, and with `per` (see `kept_lines`) blank ones, stay where they are. A document that had longer lines and keeps none of them is dropped, with
    `short_count` only if none of its shorter lines that stay has more than white space; null and empty texts stay.
    """
    columns = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), *_document(), "text")
    rows = _joined(rows, kept_lines(documents, most, least, per))
    lines = F.split("text", "\n")
    has_long = F.exists(lines, lambda x: _takes_part(x, least, per))
    none = F.array().cast("array<int>")
    left = F.filter(
        lines, lambda x, k: ~_takes_part(x, least, per) | F.array_contains(F.coalesce("kept", none), k)
    )
    stays = F.col("kept").isNotNull() | F.col("text").isNull() | ~has_long
    if short_count:
        stays = stays | F.exists(left, lambda x: ~x.rlike(_BLANK))
    rows = rows.where(stays)
    text = F.when(F.col("text").isNotNull(), F.array_join(left, "\n"))
    new = {"text": text} | ({"n_chars": F.char_length(text).cast("long")} if "n_chars" in columns else {})
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
