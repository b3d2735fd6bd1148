"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks of documents.

Documents of a source are dealt into disjoint blocks by a hash, and a source's target is a number of its
blocks, the last one cut by document. A binary tree splits the blocks of all sources among output shards: at
every node the left half takes a number of each source's blocks that is drawn without replacement, so every
shard's blocks are a random sample of the mix and the quotas add up exactly. Each shard then draws its blocks
in a permuted order, and its documents get a random place. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import stored

# Weights by a source's place in code point order, and the most that a source is repeated.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block at least, and blocks at most: blocks grow with a corpus beyond that.
BLOCK_WORDS, MOST_BLOCKS = 1 << 16, 1 << 20
#: Output shards at least, and words of a shard, by which a larger mix gets more of them.
SHARDS, SHARD_WORDS = 64, 1 << 24
#: Blocks that are drawn one by one; beyond it, their number is drawn at once.
STEPS = 1_024
SEED = 20


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row for each source.

    Sources in code point order, null last, weigh `weights` in turn and share the sum of all sizes. A target
    stops at `most` times its source's size, and what is above goes to the others by weight: in ascending
    order of cap per weight, sources are capped as long as the level of those from there on is above the cap.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    out = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    out = out.withColumn("level", left / F.sum("weight").over(rest))
    per_weight = (F.col("cap") / F.col("weight")).alias("per_weight")
    first_open = F.min(
        F.when(F.col("level") < per_weight, F.struct(per_weight, F.col("source").isNull(), "source", "level"))
    ).over(whole)
    target = F.coalesce(F.least("cap", first_open["level"] * F.col("weight")), F.col("cap"))
    return out.select("source", "source_size", target.alias("target"))


def _uniform(*key: Column) -> Column:
    """A number in [0, 1) that only the key decides."""
    return (F.pmod(F.xxhash64(*key, F.lit(SEED)), F.lit(1 << 53)) / float(1 << 53)).cast("double")


def _left_draw(quota: Column, node: Column, level: int, capacity: Column) -> Column:
    """How many blocks of each source the left half takes, as an array beside `quota`.

    One source after another draws from what is left, which is the multivariate hypergeometric distribution.
    """
    total = F.aggregate(quota, F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(
        capacity.cast("long").alias("room"), total.alias("all"), F.array().cast("array<long>").alias("taken")
    )

    def of_source(state: Column, q: Column) -> Column:
        place = F.size(state["taken"])
        won = hypergeometric(state["all"], q, state["room"], [node, F.lit(level), place])
        return F.struct(
            (state["room"] - won).alias("room"),
            (state["all"] - q).alias("all"),
            F.concat(state["taken"], F.array(won)).alias("taken"),
        )

    return F.aggregate(quota, start, of_source)["taken"]


def hypergeometric(total: Column, marked: Column, drawn: Column, key: list[Column]) -> Column:
    """How many of `drawn` items, taken from `total` without replacement, are among the `marked` ones.

    What is marked and what is drawn can change places, and either can be what is left over instead, so the smallest
    of the four is walked: exact, one step for each of its items, up to `STEPS`. Beyond that the number has a spread
    of more than 11 and is drawn at once, as a normal variate of the exact mean and variance, rounded and kept
    within its bounds. `key` decides the draw.
    """
    free, left = total - marked, total - drawn
    few_marked, few_drawn = F.least(marked, free), F.least(drawn, left)
    walked, other = F.least(few_marked, few_drawn), F.greatest(few_marked, few_drawn)

    def one(won: Column, k: Column) -> Column:
        return won + (_uniform(*key, k) < (other - won) / F.greatest(total - k, F.lit(1))).cast("long")

    none = F.array().cast("array<long>")
    steps = F.when((walked > 0) & (walked <= STEPS), F.sequence(F.lit(0).cast("long"), walked - 1)).otherwise(none)
    # The walked items go to the other side's: how many of the few marked are among the few drawn.
    met = F.aggregate(steps, F.lit(0).cast("long"), one)
    share = marked.cast("double") / F.greatest(total, F.lit(1))
    mean = drawn.cast("double") * share
    spread = F.sqrt(mean * (1 - share) * left.cast("double") / F.greatest(total - 1, F.lit(1)))
    u, v = (_uniform(*key, F.lit(k).cast("long")) for k in (-1, -2))
    normal = F.sqrt(-2 * F.ln(F.lit(1.0) - u)) * F.cos(v * 6.283185307179586)
    at_once = F.greatest(F.lit(0), drawn - free, F.least(marked, drawn, F.round(mean + spread * normal).cast("long")))
    # Back from the few to the asked: marked or free, drawn or left.
    own = F.when(marked <= free, F.when(drawn <= left, met).otherwise(marked - met)).otherwise(
        F.when(drawn <= left, drawn - met).otherwise(marked - (left - met))
    )
    return F.when(walked <= STEPS, own).otherwise(at_once).cast("long")


def splitting_tree(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(source_no, shard, quota): blocks of every source in every shard, from (source_no, quota).

    `shards` is a power of two. The root row holds the quota of every source in order of source_no; each level
    splits every row in two, whose block counts differ by at most one.
    """
    levels = shards.bit_length() - 1
    if 1 << levels != shards:
        raise ValueError("the number of shards has to be a power of two")
    rows = F.sort_array(F.collect_list(F.struct("source_no", "quota")))
    node = quotas.agg(rows.alias("rows")).select(
        F.lit(0).cast("long").alias("node"),
        F.col("rows.source_no").alias("source_no"),
        F.transform("rows", lambda r: r["quota"].cast("long")).alias("quota"),
    )
    for level in range(levels):
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, q: a + q)
        capacity = F.floor((total + F.pmod(F.col("node"), F.lit(2))) / 2)
        node = node.withColumn("left", _left_draw(F.col("quota"), F.col("node"), level, capacity))
        right = F.zip_with("quota", "left", lambda q, x: q - x)
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quota")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quota")),
        )
        node = node.select("source_no", F.explode(halves).alias("half")).select(
            F.col("half.node").alias("node"), "source_no", F.col("half.quota").alias("quota")
        )
    pairs = F.explode(F.arrays_zip("source_no", "quota")).alias("p")
    return node.select(F.col("node").alias("shard"), pairs).select("p.source_no", "shard", "p.quota")


def _order() -> Column:
    return F.xxhash64("doc_id", "text", F.lit(SEED)).alias("order")


def mix(
    documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shards: int | None = None,
    block_words: int = BLOCK_WORDS, carry: Column | None = None,
) -> DataFrame:
    """Every document with its place in the mix: doc_id, source, size, source_size, target, shards, places.

    `shards` lists the shard of each copy taken (none, if the document isn't taken), `places` the copy's
    random place in its shard, by which the shard's documents are ordered. A source's taken words differ from
    its target by less than the shortest document left out of its last block. With `carry`, that column of documents
    comes along. The number of shards is `shards`, or follows the size of the corpus.

    Null sources are a source of their own, null texts have size 0 and are in the mix as often as their block
    is. Repeated rows and ties of ids are rows of their own: where some of equal rows are taken, the others aren't.
    Empty documents give no rows. Texts are read once, for sizes; all else works on ids, hashes and counts.
    """
    carried = [] if carry is None else [carry.alias("carried")]
    size = word_count(F.col("text")).alias("size")
    row_no = F.monotonically_increasing_id().alias("row_no")  # tells equal rows apart, kept by being stored
    sized = stored(documents.select("doc_id", "source", size, _order(), row_no, *carried), "mix")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    target = source_targets(per_source, weights, most).withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = F.greatest(F.lit(block_words), F.ceil(F.sum("source_size").over(whole) / MOST_BLOCKS))
    target = target.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / words)).cast("long"))
    target = stored(target.withColumnRenamed("source", "its_source"), "mix-targets")
    if shards is None:
        total = target.agg(F.sum("source_size")).first()[0] or 0
        shards = max(SHARDS, 1 << (int(total) // SHARD_WORDS).bit_length())

    def deal(rows: DataFrame) -> DataFrame:
        rows = rows.join(target, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
        return rows.withColumn("block", F.pmod(F.xxhash64("order"), F.col("blocks")))

    dealt = deal(sized)

    # Blocks in permuted order: all are taken `full` times, the first ones once more, one of them in part.
    block = dealt.groupBy("source_no", "block").agg(F.sum("size").alias("words"))
    block = block.join(target.select("source_no", "source_size", "target"), "source_no")
    block = block.withColumn("full", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
    permuted = Window.partitionBy("source_no").orderBy(F.xxhash64("source_no", "block", F.lit(SEED + 1)), "block")
    above = permuted.rowsBetween(Window.unboundedPreceding, -1)
    need = F.col("target") - F.col("full") * F.col("source_size") - F.coalesce(F.sum("words").over(above), F.lit(0))
    block = block.withColumn("need", need).withColumn("rank", F.row_number().over(permuted))
    once_more = F.when(F.col("need") >= F.col("words"), "whole").when(F.col("need") > 0, "part").otherwise("none")
    block = block.withColumn("more", once_more)

    # The block taken in part gives its documents from the longest down, as far as each still fits.
    part = block.where("more = 'part'").select("source_no", "block", "need")
    inside = dealt.where("size > 0").join(part, ["source_no", "block"])
    longest = F.sort_array(F.collect_list(F.struct("size", "order", "row_no")), asc=False)
    inside = inside.groupBy("source_no", "block").agg(longest.alias("docs"), F.max("need").alias("need"))
    start = F.struct(F.col("need").alias("need"), F.array().cast("array<long>").alias("taken"))
    greedy = F.aggregate(
        "docs",
        start,
        lambda s, d: F.when(
            d["size"] <= s["need"],
            F.struct((s["need"] - d["size"]).alias("need"), F.concat(s["taken"], F.array(d["row_no"])).alias("taken")),
        ).otherwise(s),
    )
    some = inside.select("source_no", "block", greedy["taken"].alias("taken"))

    # Copies of blocks are numbered in permuted order and dealt to shards by the tree's quotas.
    count = F.col("full") + F.when(F.col("more") == "none", 0).otherwise(1)
    copies = block.where(count > 0).select(
        "source_no", "block", "rank", "full", "more", F.explode(F.sequence(F.lit(1), count.cast("int"))).alias("copy")
    )
    drawn = Window.partitionBy("source_no").orderBy(F.xxhash64("source_no", "block", "copy", F.lit(SEED + 2)), "block", "copy")
    copies = copies.withColumn("drawn", F.row_number().over(drawn).cast("long"))
    quotas = copies.groupBy("source_no").agg(F.count("*").alias("quota"))
    split = splitting_tree(quotas, shards).where("quota > 0")
    upto = Window.partitionBy("source_no").orderBy("shard")
    split = split.withColumn("last", F.sum("quota").over(upto))
    split = split.select(
        "source_no", "shard", F.explode(F.sequence(F.col("last") - F.col("quota") + 1, F.col("last"))).alias("drawn")
    )
    copies = copies.join(split, ["source_no", "drawn"])
    extra = (F.col("copy") > F.col("full")) & (F.col("more") == "part")
    lists = copies.groupBy("source_no", "block").agg(
        F.sort_array(F.collect_list(F.when(~extra, F.col("shard")))).alias("whole_shards"),
        F.max(F.when(extra, F.col("shard"))).alias("part_shard"),
    )
    lists = lists.join(some, ["source_no", "block"], "left")

    out = dealt.join(lists, ["source_no", "block"], "left")
    taken = F.coalesce(F.array_contains("taken", F.col("row_no")), F.lit(False))
    none = F.array().cast("array<long>")
    shard_list = F.concat(
        F.coalesce("whole_shards", none), F.when(taken, F.array("part_shard")).otherwise(none)
    )
    out = out.withColumn("shards", shard_list)
    places = F.transform("shards", lambda s, k: F.xxhash64(F.col("order"), s, k, F.lit(SEED + 3)))
    return out.withColumn("places", places).drop(
        "source_no", "block", "blocks", "order", "row_no", "whole_shards", "part_shard", "taken"
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: a document's row once for each copy taken, with the columns of documents.

    Rows are dealt to their shards, a shard's rows lie together, in the order of their places.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    placed = mix(documents, carry=row, **options)
    copies = placed.select("carried", F.explode(F.arrays_zip("shards", "places")).alias("copy"))
    copies = copies.select(F.col("copy.shards").alias("shard"), F.col("copy.places").alias("place"), "carried")
    return copies.repartition("shard").sortWithinPartitions("shard", "place").select("carried.*")
