"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.alignment import align_tokenizers
from medallion.llm.common import read_table, share_checkout
from medallion.llm.fingerprints import edited_fingerprints
from medallion.llm.html_text import main_texts
from medallion.llm.jaccard_join import jaccard_components
from medallion.llm.line_dedup import PER_EDIT, line_report
from medallion.llm.mixing import mix
from medallion.llm.packing import pack
from medallion.llm.quality import quality_scores
from medallion.llm.secret_scan import secret_scan
from medallion.llm.sentence_pieces import encode_documents, piece_digests
from medallion.llm.topk_search import quantised, top_k
from medallion.llm.toxicity import toxicity_scores
from medallion.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB SQL of the queries that SQL expresses, over the same tables.
ORACLE_SQL: dict[str, str] = {}


def _registered(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_checkout(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


@_registered
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


@_registered
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents"))


@_registered
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


@_registered
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_registered
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mix(read_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.size("shards")).cast("long").alias("taken")
    return placed.select("doc_id", "size", "source_size", "target", taken, "shards")


@_registered
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_registered
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


@_registered
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"), least=1, per=PER_EDIT)


@_registered
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(read_table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


@_registered
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


@_registered
def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(encode_documents(read_table(spark, sf_dir, "documents")))


@_registered
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"))


@_registered
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op2_topk_search"] = """
WITH whole AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), parts AS (
    SELECT vec_id, unnest(range(len(embedding))) AS place,
           CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
    FROM whole
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.place = c.place AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY ALL
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""
