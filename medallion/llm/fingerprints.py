"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest distinct hashes of a text's word shingles. Sketches of parts
merge into the sketch of the whole, and two sketches estimate resemblance, containment and distinct counts.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 128
SHINGLE = 5
#: Documents to a range of ids when looking for the next document, and most ranges.
RANGE_ROWS, MOST_RANGES = 2_000, 10_000

_BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words (runs of characters other than ASCII white space) of a text; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def sketch_of_words(words: Column, k: int = SIZE) -> Column:
    """The k smallest distinct hashes of the runs of five words; all words are one run, if there are fewer.

    `words` has to be a column of the frame, or it is computed again for every word.
    """
    n = F.size(words)
    firsts = F.slice(words, F.lit(1), F.when(n >= SHINGLE, n - (SHINGLE - 1)).otherwise(F.least(n, F.lit(1))))
    hashes = F.transform(firsts, lambda _, i: F.xxhash64(F.slice(words, i + 1, SHINGLE)))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, name: str, k: int = SIZE) -> DataFrame:
    """`df` with the sketch of a text column. The words are a column meanwhile, under a name of their own."""
    words = f"{name}_words"
    return df.withColumn(words, words_of(F.col(text))).withColumn(name, sketch_of_words(F.col(words), k)).drop(words)


def merged(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of two sets from their sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimate of intersection by union: the share of the union's sketch that both have; 1 if both are empty.

    Exact while the union has no more than k hashes.
    """
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = SIZE) -> Column:
    """Estimate of the number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimate of the share of a's shingles that b has too; 1 if a is empty."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def written(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(documents: DataFrame, columns: list[str]) -> DataFrame:
    """Each row with `next_<c>` of the next row in ascending doc_id; the last row's next is the first.

    Null ids come first, and rows of the same id are ordered by a hash of their text. Ids are cut into ranges
    of equal width, so that every range is sorted on its own; a copy of the next range's first row is added to
    a range, so that its last row has its next row there too. Needs doc_id and text among `columns`.
    """
    rows = documents.withColumn("tie", F.xxhash64("text"))
    low, high, count = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    ranges = max(1, min(MOST_RANGES, count // RANGE_ROWS))
    spread = F.lit(1).cast("long")
    if low is not None and high > low:
        spread = F.width_bucket(
            F.col("doc_id").cast("double"), F.lit(float(low)), F.lit(float(high) + 1), F.lit(ranges)
        )
    rows = rows.withColumn("range", F.coalesce(spread, F.lit(0)).cast("long"))

    # First row of each range, to be copied to the range before; at most MOST_RANGES + 2 of them.
    key = ["doc_id", "tie"]
    first = rows.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), *key)).alias("f"))
    before = F.coalesce(
        F.lag("range").over(Window.orderBy("range")),
        F.max("range").over(Window.partitionBy()),
    )
    first = first.select("range", *[F.col(f"f.{c}").alias(f"first_{c}") for c in key], before.alias("to"))
    same = (F.col("r.range") == F.col("h.range")) & F.col("tie").eqNullSafe(F.col("first_tie"))
    same = same & F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
    copies = rows.alias("r").join(F.broadcast(first).alias("h"), same)
    copies = copies.select(*[f"r.{c}" for c in columns], "tie", F.col("to").alias("range"), F.lit(True).alias("copy"))
    rows = rows.select(*columns, "tie", "range", F.lit(False).alias("copy"))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").asc_nulls_first(), "tie")
    following = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return rows.unionByName(copies).withColumns(following).where(~F.col("copy")).drop("tie", "range", "copy")


def edited_fingerprints(documents: DataFrame, k: int = SIZE) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next
    document in ascending doc_id, or all, if that has fewer. Null texts count as empty; an empty text has the
    empty fingerprint, which is like itself only. A repeated row is a document of its own, whose next one may be
    its copy. A single document is its own next one. Empty documents give no rows.
    """
    rows = with_sketch(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "sketch", k)
    rows = with_next(rows, ["doc_id", "text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch"
    )
    rows = with_sketch(rows, "edited", "edited_sketch", k)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_contained"),
        distinct_count(F.col("sketch"), k).alias("distinct_shingles"),
    )
