"""Distributed running sums in which no single task sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(
    df: DataFrame,
    keys: list[str],
    bucket: str,
    order: list[Column],
    value: str,
    out: str,
) -> DataFrame:
    """Inclusive running sum of ``value`` within ``keys`` in the order (``bucket``, ``order``).

    ``bucket`` is an integer column that never decreases along ``order``. The
    sum is made in two levels: totals per (keys, bucket) are summed up in a
    window over one row per bucket, and only rows of one bucket are ordered
    together. A key holding most rows therefore spreads over its buckets. Null
    values count as 0. Ties in ``order`` must be broken by the caller.
    """
    totals = df.groupBy(*keys, bucket).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("__total"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, bucket, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("__within", F.sum(F.coalesce(F.col(value), F.lit(0))).over(within))
    same = [local[k].eqNullSafe(offsets[k]) for k in [*keys, bucket]]
    joined = local.join(offsets, _all(same), "inner")
    return joined.select(*[local[c] for c in df.columns], (local["__within"] + offsets["__before"]).alias(out))


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def running_last(df: DataFrame, keys: list[str], bucket: str, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """For each of ``values`` the last non-null one up to and including the row, in the order (``bucket``, ``order``).

    In two levels like :func:`running_sum`: the last value per bucket, carried
    over buckets in a window of one row each, and a window within each bucket.
    The order within a bucket must be total.
    """
    rows = df.withColumns({f"__v_{name}": value for name, value in values.items()})
    position = F.struct(*order)
    found = {name: F.max_by(F.when(F.col(f"__v_{name}").isNotNull(), F.struct(F.col(f"__v_{name}").alias("v"))), F.when(F.col(f"__v_{name}").isNotNull(), position)) for name in values}
    per_bucket = rows.groupBy(*keys, bucket).agg(*(column.alias(f"__l_{name}") for name, column in found.items()))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*keys, bucket, *(F.last(f"__l_{name}", ignorenulls=True).over(before)["v"].alias(f"__b_{name}") for name in values))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"__w_{name}": F.last(f"__v_{name}", ignorenulls=True).over(within) for name in values})
    same = [local[k].eqNullSafe(carried[k]) for k in [*keys, bucket]]
    joined = local.join(carried, _all(same), "inner")
    return joined.select(*[local[c] for c in df.columns], *(F.coalesce(local[f"__w_{name}"], carried[f"__b_{name}"]).alias(name) for name in values))
