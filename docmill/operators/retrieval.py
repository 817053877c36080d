"""Exact cosine search over a collection, with citations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.functions.expressions import citations, dot, norm, vector_problem
from docmill.operators.embedding import EmbeddingProvider, check_vectors
from docmill.operators.vindex import collection_points, collection_state
from docmill.plans.runtime import tasks_for

#: Questions and points that meet in one task.
QUESTION_BLOCK, POINT_BLOCK = 2_000, 20_000


def cosine_top_k(points: DataFrame, query: list[float], k: int, id_column: str = "point_id", digits: int | None = None) -> DataFrame:
    """The ``k`` points nearest to ``query`` with ``score``, best first; ties go to the smaller id.

    One scan, scores in the JVM in double precision, a bounded heap per task.
    Vectors that cannot be used are left out.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    length = float(np.linalg.norm(np.asarray(query, dtype=np.float64)))
    if not length or not np.isfinite(length):
        raise ValueError("the query vector has no direction")
    q = F.array(*(F.lit(float(x)) for x in query))
    score = dot(F.col("vector"), q) / (norm(F.col("vector")) * F.lit(length))
    if digits is not None:
        score = F.round(score, digits)
    usable = points.filter(vector_problem(F.col("vector"), len(query)).isNull())
    return usable.withColumn("score", score).orderBy(F.desc("score"), id_column).limit(k)


def batch_top_k(points: DataFrame, queries: DataFrame, k: int, dim: int, id_column: str = "vec_id", query_column: str = "query_id", digits: int = 9) -> DataFrame:
    """``(query_id, id, score, rank)``: the ``k`` nearest points of each query of a stated set.

    Queries and points are dealt by hash to blocks, and every block of queries
    meets every block of points in one task, which puts out ``k`` rows per
    query. Cosine in double precision rounded to ``digits``; a point never
    finds a query of the same id if both columns have the same name.
    """
    sides = {}
    for name, df, key, rows in (("query", queries, query_column, QUESTION_BLOCK), ("point", points, id_column, POINT_BLOCK)):
        usable = df.filter(vector_problem(F.col("vector"), dim).isNull()).select(F.col(key).cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
        count = tasks_for(usable.count(), rows, least=1)
        sides[name] = usable.withColumn(f"{name}_block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")), count
    met = lambda side, other: sides[side][0].withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.lit(sides[other][1] - 1))))
    same = id_column == query_column

    def unit(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        x = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        return table["id"].to_numpy(), x / np.linalg.norm(x, axis=1, keepdims=True)

    def best(asked: pa.Table, data: pa.Table) -> pa.Table:
        (q_ids, q), (ids, x) = unit(asked), unit(data)
        scores = np.round(q @ x.T, digits)
        if same:
            scores[q_ids[:, None] == ids[None, :]] = -np.inf
        if scores.shape[1] > k:  # what is under the k-th best of a query cannot be among its k best
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            scores[scores < least[:, None]] = -np.inf
        row, col = np.nonzero(scores > -np.inf)
        return pa.table({"query_id": pa.array(q_ids[row]), "id": pa.array(ids[col]), "score": pa.array(scores[row, col])})

    blocks = ["query_block", "point_block"]
    found = met("query", "point").groupBy(*blocks).cogroup(met("point", "query").groupBy(*blocks)).applyInArrow(best, "query_id bigint, id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def retrieve(spark: SparkSession, question: str, folder: str, provider: EmbeddingProvider, top_k: int = 5) -> DataFrame:
    """``(score, chunk, citations)`` of the chunks nearest to a question.

    Refuses a collection that is incomplete, was made with another embedding
    configuration or has lost or gained points.
    """
    if top_k <= 0:
        raise ValueError("top_k must be positive")
    state = collection_state(spark, folder)
    if state.get("status") != "complete":
        raise ValueError("the collection is incomplete; run its indexing again")
    if state["configuration"]["embedding"] != provider.configuration():
        raise ValueError("the embedding configuration differs from the collection's")
    points = collection_points(spark, folder)
    if points.count() != state["configuration"]["chunk_count"]:
        raise ValueError("the number of points changed; run indexing again")
    [vector] = check_vectors([provider.embed_query(question)], 1, provider.configuration()["dimension"])
    return cited(cosine_top_k(points, vector, top_k))


def cited(found: DataFrame, *kept: str) -> DataFrame:
    """Search results in their outer form, with columns that are ``kept``."""
    return found.select(*kept, "score", F.col("payload").alias("chunk"), citations(F.col("payload.metadata")).alias("citations"))


def compare_collections(spark: SparkSession, question: str, folders: list[str], provider: EmbeddingProvider, top_k: int = 5) -> DataFrame:
    """The same question on several collections: results with their ``collection``."""
    parts = [retrieve(spark, question, f, provider, top_k).select(F.lit(f).alias("collection"), "*") for f in folders]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def recall_at_k(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Extension: ``(query_id, recall, reciprocal_rank)`` of ranked results against relevant ``(query_id, id)``."""
    hits = ranked.filter(F.col("rank") <= k).join(relevant.select("query_id", "id"), ["query_id", "id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first"))
    totals = relevant.groupBy("query_id").agg(F.countDistinct("id").alias("total"))
    return totals.join(hits, "query_id", "left").select("query_id", (F.coalesce("hits", F.lit(0)) / F.least("total", F.lit(k))).alias("recall"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"))
