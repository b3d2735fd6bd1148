"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are integers. An index shard holds its components as posting segments by descending impact. Queries go
through the segments and add up what they have seen. A query stops only when what unseen segments can add or
take proves that no vector outside a small set can be among the best; the set is scored exactly. Queries and vectors are dealt into blocks, and each pair of a shard and a
block of queries is a task's work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
SHARD_ROWS, QUERY_ROWS = 8_192, 1_024
#: Segments, by equal steps from the largest impact down to nothing.
STEPS = 4


class ImpactIndex:
    """Vectors of one shard, cut into posting segments by the size of their components, largest first.

    A segment holds the components of one band of impacts, as a matrix that is zero elsewhere, so that a block
    of queries takes a segment in one product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, steps: int = STEPS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        self.top = int(size.max(initial=0))
        self.cuts = [self.top * (steps - step) // steps for step in range(1, steps + 1)]
        self.bands = [self.top, *self.cuts]
        self.size = size

    def segments(self, exact: type):
        """(matrix, largest component still unseen) by descending impact."""
        for high, low in zip(self.bands[:-1], self.cuts):
            if high > low:
                yield np.where((self.size <= high) & (self.size > low), self.vectors, 0).astype(exact), low

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and scores of its k best vectors but its own, ties to smaller ids.

        After each segment a score lies within the query's sum of sizes times the largest unseen component of
        what was added up. A query is done when that leaves few possible members, or nothing is unseen.
        """
        n = self.ids.size
        most = int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) * self.top
        # Sums of doubles are exact, or those of longs, or those of Python's numbers.
        exact = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object
        if exact is object:
            queries, self.vectors = queries.astype(object), self.vectors.astype(object)
        weight = np.abs(queries).sum(1)
        seen, open_ = np.zeros((len(queries), n), exact), np.arange(len(queries))
        possible = [np.arange(n)] * len(queries)
        for matrix, unseen in self.segments(exact):
            seen[open_] += queries[open_].astype(exact) @ matrix.T
            still = []
            for q in open_:
                slack, others = int(weight[q]) * unseen, self.ids != own[q]
                rivals = seen[q][others]
                if rivals.size > k:
                    least = np.sort(rivals)[-k] if exact is object else np.partition(rivals, rivals.size - k)[rivals.size - k]
                    others &= (seen[q] + slack >= least - slack).astype(bool)
                possible[q] = np.flatnonzero(others)
                if possible[q].size > 4 * k:
                    still.append(q)
            open_ = np.array(still, np.int64)
            if not open_.size:
                break
        out = []
        for q, members in enumerate(possible):
            members = members[self.ids[members] != own[q]]
            scores = self.vectors[members] @ queries[q]
            if exact is object:
                chosen = np.array(sorted(range(members.size), key=lambda m: (-scores[m], self.ids[members[m]]))[:k], np.int64)
            else:
                chosen = np.lexsort((self.ids[members], -scores))[:k]
            out.append((self.ids[members[chosen]], scores[chosen]))
        return out


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) of every component as long.

    Vectors that are null or hold null or non-finite components take no part. A component that doesn't fit a
    long when scaled is an error.
    """

    def whole(c: Column) -> Column:
        x = F.lit(float(scale)) * c.cast("double")
        beyond = F.raise_error(F.lit("a component beyond a long")).cast("long")
        return F.when(F.abs(x) < float(1 << 63), F.floor(x)).otherwise(beyond)

    def finite(c: Column) -> Column:
        return F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))

    fine = F.col("embedding").isNotNull() & F.forall("embedding", finite)
    x = F.when(fine, F.transform("embedding", whole))
    return embeddings.where(fine).select("vec_id", x.alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query, all if there are fewer.

    Both frames have vec_id and v (array of long). Ties go to the smaller vec_id; vectors with the query's id
    are its own and no candidates. Shorter vectors count as filled up with zeros. Rows without id take no part.
    Without queries or candidates there are no rows. Scores are exact, and one beyond a long is an error.
    """
    vectors, queries = vectors.where("vec_id is not null"), queries.where("vec_id is not null")
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        to = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)
        return df.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(own), to)

    left = dealt(vectors, "shard", shards, "block", blocks).groupBy("shard", "block")
    right = dealt(queries, "block", blocks, "shard", shards).groupBy("shard", "block")

    def matrix(rows: pd.Series, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width), np.int64)
        for at, row in enumerate(rows):
            out[at, : len(row)] = row
        return out

    def each(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(asked):
            width = max(candidates["v"].map(len).max(), asked["v"].map(len).max())
            index = ImpactIndex(candidates["vec_id"].to_numpy(), matrix(candidates["v"], width))
            own = asked["vec_id"].to_numpy()
            for own, (ids, scores) in zip(own, index.search(matrix(asked["v"], width), own, k)):
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": np.array(scores.tolist(), np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = left.cogroup(right).applyInPandas(each, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
