"""Feature statistics of episodes and data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmwake.operators.prefix import join_null_safe


def exploded(df: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """(by, dim, x): the numbers of a vector column; null numbers and NaN left out."""
    e = df.select(*by, F.posexplode(F.col(f"`{vector}`")).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    return e.where(F.col("x").isNotNull() & ~F.isnan("x"))


def vector_stats(df: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """Least, largest, mean, population deviation and count of each dimension."""
    e = exploded(df, by, vector)
    return e.groupBy(*by, "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("*").alias("count"))


def partial_moments(df: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """Mergeable sums of each dimension (A03): n, sum, sum of squares, least, largest."""
    e = exploded(df, by, vector)
    return e.groupBy(*by, "dim").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"), F.min("x").alias("lo"), F.max("x").alias("hi"))


def merged_moments(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Statistics from partial sums; the variance is cut at 0 against rounding."""
    m = parts.groupBy(*by).agg(F.sum("n").alias("count"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    mean = F.col("s") / F.col("count")
    return m.select(*by, "min", "max", mean.alias("mean"), F.sqrt(F.greatest(F.col("ss") / F.col("count") - mean * mean, F.lit(0.0))).alias("std"), "count")


#: Bins per doubling of the histogram that places a quantile.
PER_DOUBLING = 64


def _ordered_bin(x: Column) -> Column:
    """A whole number that never falls as x grows: 64 bins per doubling on either side of 0."""
    b = F.floor(F.log2(F.abs(x)) * PER_DOUBLING).cast("bigint") + 100_000
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, b).otherwise(-b)


def exact_quantiles(df: DataFrame, by: Sequence[str], c: str, qs: Sequence[float]) -> DataFrame:
    """(by, q0, q1, ...): the exact quantiles with linear interpolation; null and NaN are no values.

    Two passes. A histogram per group, whose bins combine inside each task, tells
    the bins that hold the ranks asked for; only the distinct values of those bins
    are then counted and put in order. So no group's values come to one task.
    """
    by = list(by)
    v = df.select(*by, F.col(c).cast("double").alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x)").withColumn("__b", _ordered_bin(F.col("__x")))
    h = v.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    g = [F.col(k) for k in by]
    h = h.withColumn("__upto", F.sum("__n").over(Window.partitionBy(*g).orderBy("__b"))).withColumn("__all", F.sum("__n").over(Window.partitionBy(*g)))
    at = [F.lit(float(q)) * (F.col("__all") - 1) for q in qs]
    held = lambda rank, lo, hi: (rank >= lo) & (rank < hi)
    ends = [f(a) for a in at for f in (F.floor, F.ceil)]
    wanted = F.lit(False)
    for e in ends:
        wanted = wanted | held(e, F.col("__upto") - F.col("__n"), F.col("__upto"))
    need = h.where(wanted).select(*by, "__b", (F.col("__upto") - F.col("__n")).alias("__before"), "__all")
    d = join_null_safe(v, need, [*by, "__b"]).groupBy(*by, "__b", "__before", "__all", "__x").agg(F.count("*").alias("__m"))
    d = d.withColumn("__hi", F.col("__before") + F.sum("__m").over(Window.partitionBy(*g, "__b").orderBy("__x")))
    value = lambda e: F.max(F.when(held(e, F.col("__hi") - F.col("__m"), F.col("__hi")), F.col("__x")))
    found = d.groupBy(*by).agg(F.max("__all").alias("__all"), *[value(e).alias(f"__e{i}") for i, e in enumerate(ends)])
    lo, hi = (lambda i: F.col(f"__e{2 * i}")), (lambda i: F.col(f"__e{2 * i + 1}"))
    return found.select(*by, *[(lo(i) + (a - F.floor(a)) * (hi(i) - lo(i))).alias(f"q{i}") for i, a in enumerate(at)])


def score_report(df: DataFrame, by: Sequence[str], c: str) -> DataFrame:
    """Count, extremes, mean, population variance, P99 and P01 (A10)."""
    s = df.groupBy(*by).agg(F.count("*").alias("n"), F.max(c).alias("max"), F.min(c).alias("min"), F.avg(c).alias("mean"), F.var_pop(c).alias("var"))
    q = exact_quantiles(df, by, c, (0.99, 0.01)).withColumnsRenamed({"q0": "p99", "q1": "p01"})
    return join_null_safe(s, q, list(by)) if by else s.crossJoin(F.broadcast(q))  # one row each


def top_block_report(df: DataFrame, by: Sequence[str], c: str, share: float) -> DataFrame:
    """Mean, maximum, median, the (1 - share) quantile and the mean of all values from it upwards."""
    by = list(by)
    s = df.groupBy(*by).agg(F.avg(c).alias("mean"), F.max(c).alias("max"))
    q = exact_quantiles(df, by, c, (0.5, 1 - share)).withColumnsRenamed({"q0": "median", "q1": "threshold"})
    if not by:
        t = q.select("threshold").scalar()
        top = df.where(F.col(c) >= t).agg(F.avg(c).alias("top_mean"), F.count("*").alias("n_top"))
        return s.crossJoin(F.broadcast(q)).crossJoin(F.broadcast(top))  # one row each
    top = join_null_safe(df.select(*by, c), q.select(*by, "threshold"), by).where(F.col(c) >= F.col("threshold"))
    top = top.groupBy(*by).agg(F.avg(c).alias("top_mean"), F.count("*").alias("n_top"))
    return join_null_safe(join_null_safe(s, q, by), top, by)


def histogram(df: DataFrame, c: str, lo: float, hi: float, bins: int) -> DataFrame:
    """(bin, n, density) of equal bins; the last one holds its upper edge, values outside are left out."""
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1)).cast("bigint")
    h = df.where(F.col(c).between(lo, hi)).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    total = df.where(F.col(c).between(lo, hi)).agg(F.count("*").alias("t")).scalar()
    return h.withColumn("density", F.col("n") / (total * width))


def kde(df: DataFrame, c: str, grid: Sequence[float], bins: int = 1 << 14) -> DataFrame:
    """(g, density): Gaussian kernel density on a grid with Scott's bandwidth, sample deviation times n ** -1/5.

    The values are binned first, ``bins`` between the least and the largest one; each
    bin stands with its mean and count, so a row is read once and never meets the grid.
    The error is of the order of (bin width / bandwidth) squared, some 1e-8 of the density.
    """
    m = df.agg(F.count(c).alias("n"), F.stddev_samp(c).alias("s"), F.min(c).alias("lo"), F.max(c).alias("hi"))
    n, s, lo, hi = (m.select(k).scalar() for k in ("n", "s", "lo", "hi"))
    at = F.when(hi > lo, F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    b = df.where(F.col(c).isNotNull()).groupBy(at.alias("__at")).agg(F.count("*").alias("__k"), F.avg(c).alias("__x"))
    bw = s * F.pow(n.cast("double"), F.lit(-0.2))
    e = b.select("__k", "__x", bw.alias("__bw"), n.alias("__n"), F.explode(F.lit(list(map(float, grid)))).alias("g"))
    z = (F.col("g") - F.col("__x")) / F.col("__bw")
    return e.groupBy("g").agg((F.sum(F.col("__k") * F.exp(-z * z / 2)) / (F.first("__n") * F.first("__bw") * F.lit((2 * 3.141592653589793) ** 0.5))).alias("density"))


def timing_report(seconds: DataFrame, by: Sequence[str], c: str) -> DataFrame:
    """Number of runs, mean and population deviation of their times."""
    return seconds.groupBy(*by).agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))


def min_max_normalised(df: DataFrame, c: Column, lo: Column, hi: Column) -> Column:
    """The value on [-1, 1] between two statistics; 0 where they are equal (UD8)."""
    return F.when(hi == lo, F.lit(0.0)).otherwise(2 * (c - lo) / (hi - lo) - 1)


def zeroed(vector: Column) -> Column:
    """A float vector of the same length, all 0 (UD9)."""
    return F.transform(vector, lambda v: F.lit(0.0).cast("float"))
