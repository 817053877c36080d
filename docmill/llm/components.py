"""Connected components over an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.plans.runtime import discard, materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Alternates large-star and small-star steps: each links a node's neighbours
    to the smallest of them, so the number of edges never grows and the rounds
    are logarithmic in the number of nodes. Every round is one aggregation and
    one join on the node, written to the shared folder. Self-loops and nulls
    are ignored; repeated and reversed edges count once; no edges, no rows.
    """
    current = materialize(
        edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        following = materialize(small, "edges")
        discard(current)
        current = following
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
