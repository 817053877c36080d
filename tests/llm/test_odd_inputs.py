"""Nested and oddly named extra columns, and one key that holds most rows."""

from collections import Counter

from pyspark.sql import functions as F

from docmill.llm.markup import clean_documents
from docmill.llm.packing import pack_documents, sized_documents
from docmill.llm.sitelines import found_lines
from docmill.llm.tokens import token_budget, with_token_counts
from docmill.llm.toxicity import score_documents


def odd(spark):
    rows = [(1, "**one** two", ("x", [1, None]), {"k": None}), (2, None, None, None), (3, "", ("y", []), {})]
    return spark.createDataFrame(rows, "`doc id` bigint, text string, `a-b c` struct<`x.y`:string,z:array<int>>, m map<string,int>")


def test_extra_columns_pass_through(spark):
    df = odd(spark)
    labels = spark.createDataFrame([], "doc_id bigint, label string")
    terms = spark.createDataFrame([], "term string, category string")
    scored = score_documents(df.withColumn("doc_id", F.lit(1).cast("bigint")), labels, terms)
    for made in (with_token_counts(df), clean_documents(df), scored):
        rows = {r["doc id"]: r for r in made.collect()}
        assert rows[1]["a-b c"]["x.y"] == "x" and rows[1]["a-b c"]["z"] == [1, None] and rows[2]["a-b c"] is None and rows[1]["m"] == {"k": None}


def test_hot_keys(spark):
    n = 3000
    hot = spark.range(n).select(
        F.lit("chunks").alias("dataset"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("id"), F.lit("big").alias("source"), F.lit("en").alias("lang"), F.lit("https://h/x").alias("url"), F.lit("some words").alias("text")
    )
    [row] = token_budget(hot).collect()
    assert row.n_rows == n and row.n_texts == 2001 and row.n_tokens == 2 * 2001 and row.n_tokens_rows == 2 * n
    lines = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("source"), F.concat(F.lit("d"), F.col("id") % 10).alias("doc"), F.lit("the same line on every page\nx").alias("text"))
    assert found_lines(lines).count() == n
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 == 0, "a copy of one text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    packed = pack_documents(docs, spark.createDataFrame([("c", 64)], "capacity_name string, capacity_tokens int"), shard_items=1000)
    clusters = {r.doc_id: r.cluster for r in sized_documents(docs).collect()}
    seen = Counter((r.container_id, clusters[r.doc_id]) for r in packed.collect())
    assert max(seen.values()) == 1 and sum(seen.values()) == n
