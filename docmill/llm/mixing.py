"""Mixing sources to target weights by weighted fair queueing.

Each pass over a source shuffles its documents by a hash. A document's virtual
finish time is the number of tokens of its source up to its end, divided by the
source's weight; sorting all documents of a mix by it and cutting at the total
budget serves every source in proportion to its weight. Running sums are made
in two levels, so that neither a large source nor the whole mix is ordered in
one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.packing import sized_documents
from docmill.llm.tokens import DEFAULT_VOCABULARY
from docmill.plans.prefix import running_sum
from docmill.plans.runtime import materialize

#: Rows of the table of targets, which is read by the driver and broadcast.
MAX_TARGETS = 100_000
ROWS_PER_BUCKET = 10_000
PLAN_SCHEMA = "mix string, source string, target_share double, weight double, max_repeats int, passes int, available bigint, n_docs bigint, budget double, finish double"


def finish_time(shares: list[tuple[float, float]], total: float) -> float:
    """Virtual time at which sources of ``(weight, tokens at most)`` have given ``total`` tokens (or all they have)."""
    served, weight, now = 0.0, sum(w for w, _ in shares), 0.0
    for end, w in sorted((most / w, w) for w, most in shares):
        if served + weight * (end - now) >= total:
            return now + (total - served) / weight
        served += weight * (end - now)
        now, weight = end, weight - w
    return now


def mixing_plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[tuple]:
    """Rows of ``PLAN_SCHEMA``: weight, passes and budget of every source of every mix.

    Shares of a mix are scaled to 1 over the sources that have tokens; a source
    without any keeps its row, with weight 0. Without ``total_tokens`` the
    budget is the largest at which every source reaches its share within its
    repeats. Rows with null mix, source or share, or a share of 0 or less, are
    ignored, a null ``max_repeats`` is 1; repeated (mix, source) rows add up.
    """
    clean = targets.filter("mix IS NOT NULL AND source IS NOT NULL AND target_share > 0")
    wanted = clean.groupBy("mix", "source").agg(F.sum("target_share").alias("share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1))).alias("repeats"))
    have = sized.filter("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    rows = wanted.join(have, "source", "left").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    plan = []
    for mix in sorted({r.mix for r in rows}):
        own = sorted((r for r in rows if r.mix == mix), key=lambda r: r.source)
        present = [r for r in own if r.tokens]
        whole = sum(r.share for r in present)
        if total_tokens is not None:
            budget = float(total_tokens)
        else:
            budget = min((r.tokens * r.repeats / (r.share / whole) for r in present), default=0.0)
        finish = finish_time([(r.share / whole, r.tokens * r.repeats) for r in present], budget) if present else 0.0
        for r in own:
            weight = r.share / whole if r.tokens else 0.0
            passes = min(r.repeats, math.ceil(weight * finish / r.tokens * (1 + 1e-12))) if r.tokens else 0
            plan.append((mix, r.source, r.share, weight, r.repeats, passes, r.tokens or 0, r.docs or 0, budget, finish))
    return plan


def mix_documents(sized: DataFrame, plan: list[tuple], seed: int = 11) -> DataFrame:
    """``(mix, doc_id, copy, source, n_tokens, virtual_finish, end_offset)`` of every document taken.

    ``copy`` counts the passes over the source (from 0), ``end_offset`` is the
    number of tokens of the mix up to the end of the document in the order of
    ``virtual_finish`` (ties: source, copy, shuffle hash, doc_id). No document
    ends beyond the budget. Documents without tokens or source are not taken.
    """
    spark = sized.sparkSession
    # Bounded by MAX_TARGETS rows.
    wanted = F.broadcast(spark.createDataFrame(plan, PLAN_SCHEMA).filter("passes > 0").select("mix", "source", "weight", "passes", "available", "n_docs", "budget", "finish"))
    copies = sized.filter("n_tokens > 0").select("doc_id", "source", "n_tokens").join(wanted, "source").select("*", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("copy"))
    order = F.xxhash64("doc_id", "copy", F.lit(seed))
    # The hash as a share of its range, to deal a pass into buckets that follow its order.
    spread = F.shiftrightunsigned(order.bitwiseXOR(F.lit(-(1 << 63))), 11) / F.lit(float(1 << 53))
    copies = copies.withColumn("shuffle", order).withColumn("bucket", F.floor(spread * F.ceil(F.col("n_docs") / ROWS_PER_BUCKET)).cast("bigint"))
    summed = running_sum(copies, ["mix", "source", "copy"], "bucket", [F.col("shuffle"), F.col("doc_id")], "n_tokens", "in_pass")
    timed = summed.withColumn("virtual_finish", (F.col("copy") * F.col("available") + F.col("in_pass")) / F.col("weight")).filter(F.col("virtual_finish") <= F.col("finish") * (1 + 1e-12))
    timed = materialize(timed.select("mix", "doc_id", "copy", "source", "n_tokens", "virtual_finish", "shuffle", "budget", "finish"), "virtual-times")
    counts = timed.groupBy("mix").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_BUCKET).alias("buckets"))
    ranged = timed.join(F.broadcast(counts), "mix").withColumn("range", F.floor(F.col("virtual_finish") / F.col("finish") * F.col("buckets")).cast("bigint"))
    placed = running_sum(ranged, ["mix"], "range", [F.col("virtual_finish"), F.col("source"), F.col("copy"), F.col("shuffle"), F.col("doc_id")], "n_tokens", "end_offset")
    return placed.filter(F.col("end_offset") <= F.col("budget") * (1 + 1e-12)).select("mix", "doc_id", "copy", "source", "n_tokens", "virtual_finish", "end_offset")


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    sized = sized_documents(documents, vocabulary)
    return mix_documents(sized, mixing_plan(sized, targets, total_tokens))


def shares_report(mixed: DataFrame, plan: list[tuple]) -> DataFrame:
    """Per mix and source: target share, weight among the sources at hand, share reached, tokens, documents and repeats used."""
    spark = mixed.sparkSession
    taken = mixed.groupBy("mix", "source").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_rows"), (F.max("copy") + 1).alias("repeats"))
    wanted = spark.createDataFrame(plan, PLAN_SCHEMA).select("mix", "source", "target_share", "weight", "max_repeats", F.col("available").alias("available_tokens"), F.floor("budget").cast("bigint").alias("budget"))
    totals = taken.groupBy("mix").agg(F.sum("n_tokens").alias("all_tokens"))
    joined = wanted.join(taken, ["mix", "source"], "left").join(totals, "mix", "left")
    return joined.select(
        "mix", "source", "target_share", "weight", (F.coalesce("n_tokens", F.lit(0)) / F.col("all_tokens")).alias("actual_share"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("repeats", F.lit(0)).alias("repeats"), "max_repeats", "available_tokens", "budget"
    )
