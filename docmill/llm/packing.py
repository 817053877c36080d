"""Filling containers of fixed capacity with documents measured in tokens.

Best-fit decreasing with conflicts: open containers are ordered by what is left
in them; the search starts at the first that holds the item and goes on to
larger remainders until one is compatible. A container carries bitmaps of its
sources and duplicate clusters: two copies of a text never share a container,
and of equally tight containers one without the item's source is preferred.
Items are dealt by hash to shards of bounded size that are packed in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.tokens import DEFAULT_VOCABULARY, with_token_counts
from docmill.plans.runtime import materialize, tasks_for

#: Items packed together in one task.
SHARD_ITEMS = 20_000
MAX_CAPACITIES = 1_000


class OpenBins:
    """Containers ordered by residual; positions of a residual's list never move, so searches resume."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []  # ascending residuals that have containers
        self.bins: dict[int, list[int]] = {}  # containers by residual, -1 once moved on
        self.live: Counter = Counter()
        self.head: dict[int, int] = {}
        self.passed: dict[int, dict[int, int]] = {}
        self.shared: dict[int, dict[int, int]] = {}
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """The container chosen; ``source`` and ``cluster`` are bit positions, cluster -1 has no copies."""
        bit = 1 << cluster if cluster >= 0 else 0
        for k in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[k]
            at = self._compatible(residual, bit, cluster, 1 << source)
            if at >= 0:
                chosen = self.bins[residual][at]
                self.bins[residual][at] = -1
                self.live[residual] -= 1
                if not self.live[residual]:
                    del self.residuals[k], self.bins[residual], self.live[residual]
                    self.head.pop(residual, None)
                    self.shared.pop(residual, None)
                    self.passed.pop(residual, None)
                self._keep(chosen, residual - size, bit, source)
                return chosen
        self.sources.append(0)
        self.clusters.append(0)
        self._keep(len(self.sources) - 1, self.capacity - size, bit, source)
        return len(self.sources) - 1

    def _keep(self, chosen: int, residual: int, bit: int, source: int) -> None:
        self.sources[chosen] |= 1 << source
        self.clusters[chosen] |= bit
        if residual:
            if residual not in self.bins:
                insort(self.residuals, residual)
                self.bins[residual] = []
            self.bins[residual].append(chosen)
            self.live[residual] += 1

    def _compatible(self, residual: int, bit: int, cluster: int, source_bit: int) -> int:
        row = self.bins[residual]
        # Before ``start`` all containers have moved on or hold this cluster, for good.
        start = max(self.head.get(residual, 0), self.passed.get(residual, {}).get(cluster, 0) if bit else 0)
        while start < len(row) and (row[start] < 0 or bit & self.clusters[row[start]]):
            start += 1
        if bit:
            self.passed.setdefault(residual, {})[cluster] = start
        else:
            self.head[residual] = start
        # Before ``other`` all containers have moved on or hold this source, for good.
        shared = self.shared.setdefault(residual, {})
        other = shared.get(source_bit, 0)
        while other < len(row) and (row[other] < 0 or self.sources[row[other]] & source_bit):
            other += 1
        shared[source_bit] = other
        for at in range(max(start, other), len(row)):
            if row[at] >= 0 and not bit & self.clusters[row[at]] and not self.sources[row[at]] & source_bit:
                return at
        return start if start < len(row) else -1


def pack(sizes: list[int], sources: list[str | None], clusters: list[int], capacity: int) -> list[int]:
    """Container number of each item; every size is at most ``capacity``."""
    source_bit = {s: k for k, s in enumerate(dict.fromkeys(sources))}
    repeated = [c for c, n in Counter(clusters).items() if n > 1]
    cluster_bit = {c: k for k, c in enumerate(repeated)}
    bins = OpenBins(capacity)
    chosen = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        chosen[k] = bins.place(sizes[k], source_bit[sources[k]], cluster_bit.get(clusters[k], -1))
    return chosen


def sized_documents(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``(doc_id, source, cluster, n_tokens)``, written once; ``cluster`` is equal for texts that differ in white space only."""
    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)[\s\u001c-\u001f]+", " "))
    chosen = documents.filter(F.col("doc_id").isNotNull()).select("doc_id", "source", F.xxhash64(text).alias("cluster"), "text")
    return materialize(with_token_counts(chosen, "text", vocabulary).select("doc_id", "source", "cluster", "n_tokens"), "sized-documents")


def pack_documents(documents: DataFrame, capacities: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, shard_items: int = SHARD_ITEMS, sized: DataFrame | None = None) -> DataFrame:
    """``(capacity_name, container_id, doc_id, part, start_token, end_token, n_tokens)``.

    Every document (``doc_id`` is taken to be unique, a repeated row is packed
    as often as it comes; rows without an id are left out) is packed once per
    capacity. One that is larger than the capacity is cut at token
    boundaries into full containers and a rest, which is packed like any other
    document. Null and empty texts have no tokens: they come out with a null
    container. ``sized`` may bring what :func:`sized_documents` made. Capacities with a null name or less than one token are ignored,
    other columns too.
    """
    named = capacities.filter("capacity_name IS NOT NULL AND capacity_tokens > 0").select("capacity_name", "capacity_tokens").distinct().limit(MAX_CAPACITIES + 1).collect()
    if len(named) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    sized = sized_documents(documents, vocabulary) if sized is None else sized
    if not named:
        return sized.select(F.lit("").alias("capacity_name"), F.lit("").alias("container_id"), "doc_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), "n_tokens", "n_tokens").toDF(
            "capacity_name", "container_id", "doc_id", "part", "start_token", "end_token", "n_tokens"
        ).limit(0)
    options = F.array(*(F.struct(F.lit(r.capacity_name).alias("capacity_name"), F.lit(r.capacity_tokens).cast("bigint").alias("cap")) for r in named))
    each = sized.select("*", F.explode(options).alias("c")).select("doc_id", "source", "cluster", "n_tokens", "c.*").withColumn("whole", F.expr("n_tokens div cap"))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1))
    full = each.filter("whole > 0").select("capacity_name", "doc_id", "cap", part.alias("part")).select(
        "capacity_name", F.concat_ws("-", "capacity_name", F.lit("full"), "doc_id", "part").alias("container_id"), "doc_id", F.col("part").cast("int").alias("part"),
        (F.col("part") * F.col("cap")).alias("start_token"), ((F.col("part") + 1) * F.col("cap")).alias("end_token"), F.col("cap").alias("n_tokens"),
    )
    empty = each.filter("n_tokens = 0").select("capacity_name", F.lit(None).cast("string").alias("container_id"), "doc_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), F.lit(0).cast("bigint").alias("end_token"), F.lit(0).cast("bigint").alias("n_tokens"))
    shards = tasks_for(sized.count(), shard_items)
    rest = each.filter("n_tokens % cap > 0").select(
        "capacity_name", "cap", F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(shards)).alias("shard"), "doc_id", "source", "cluster", F.col("whole").cast("int").alias("part"), (F.col("whole") * F.col("cap")).alias("start_token"), (F.col("n_tokens") % F.col("cap")).alias("size")
    )

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending")])
        capacity, name, shard = table["cap"][0].as_py(), table["capacity_name"][0].as_py(), table["shard"][0].as_py()
        chosen = pack(table["size"].to_pylist(), table["source"].to_pylist(), table["cluster"].to_pylist(), capacity)
        start, size = table["start_token"], table["size"]
        return pa.table(
            {
                "capacity_name": table["capacity_name"], "container_id": pa.array([f"{name}-{shard}-{c}" for c in chosen], pa.string()), "doc_id": table["doc_id"], "part": table["part"],
                "start_token": start, "end_token": pa.compute.add(start, size), "n_tokens": size,
            }
        )

    packed = rest.groupBy("capacity_name", "shard").applyInArrow(fill, "capacity_name string, container_id string, doc_id bigint, part int, start_token bigint, end_token bigint, n_tokens bigint")
    return packed.unionByName(full).unionByName(empty)


def packing_report(packed: DataFrame, capacities: DataFrame, sized: DataFrame) -> DataFrame:
    """Per capacity: containers, items, tokens, the share of room that is filled, and what the preference for other sources leaves.

    ``n_shared`` counts the items that share their container with an earlier
    one of their source: what a hard rule would have had to move elsewhere.
    ``n_conflicts`` counts copies of a text in one container; there are none.
    """
    inside = packed.filter("container_id IS NOT NULL").join(sized.select("doc_id", "source", "cluster").dropDuplicates(["doc_id"]), "doc_id")
    per = inside.groupBy("capacity_name", "container_id").agg(
        F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("items"), (F.count("source") - F.countDistinct("source")).alias("shared"), (F.count("cluster") - F.countDistinct("cluster")).alias("conflicts")
    )
    totals = per.groupBy("capacity_name").agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("items").alias("n_items"), F.sum("used").alias("n_tokens"), F.sum("shared").alias("n_shared"), F.sum("conflicts").alias("n_conflicts")
    )
    return totals.join(capacities.select("capacity_name", "capacity_tokens").distinct(), "capacity_name").select(
        "capacity_name", "capacity_tokens", "n_containers", "n_items", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"), "n_shared", "n_conflicts"
    )
