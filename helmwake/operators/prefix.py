"""Running sums over groups that may be far larger than one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null meets null; the right key columns are dropped."""
    names = {k: f"__r{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in right.columns])
    on = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(r, on, how).drop(*names.values())


def distributed_prefix_sum(df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows of the group up to and with this row.

    ``bucket`` must be monotone in ``order`` within a group (the high bits of the
    first order column, say). Each (group, bucket) is summed on its own; only the
    totals, one row per bucket, are scanned in order. So a group with a third of
    all rows still spreads over all its buckets. Null values count as 0; the group
    columns must not be null. An empty table gives an empty table.
    """
    b = df.withColumn("__b", bucket)
    g = [*group, "__b"]
    val = F.coalesce(F.col(value), F.lit(0))
    totals = b.groupBy(*g).agg(F.sum(val).alias("__t"))
    before = Window.partitionBy(*[F.col(c) for c in group]).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*g, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*[F.col(c) for c in g]).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = b.withColumn("__in", F.sum(val).over(inside))
    return summed.join(base, g).withColumn(out, F.col("__in") + F.col("__base")).drop("__b", "__in", "__base")
