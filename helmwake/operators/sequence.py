"""Ordered-sequence operators: windows over the frames of an episode.

``by`` are the columns of the episode, ``order`` columns that put its rows into a
total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def over(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def span(by: Sequence[str], order: Sequence[str], lo: int, hi: int) -> WindowSpec:
    return over(by, order).rowsBetween(lo, hi)


def angle_step(yaw: Column, w: WindowSpec) -> Column:
    """Wrapped difference to the row before; a jump of exactly 180 degrees keeps its sign."""
    raw = yaw - F.lag(yaw).over(w)
    wrapped = F.pmod(raw + 180.0, F.lit(360.0)) - 180.0
    return F.when((wrapped == -180.0) & (raw > 0), F.lit(180.0)).otherwise(wrapped)


def with_yaw_rate(df: DataFrame, by: Sequence[str], order: Sequence[str], yaw: str, dt: float, out: str = "yaw_rate") -> DataFrame:
    """Absolute rate of a wrapping angle by central differences, one-sided at the ends (W03); 0 for a single row."""
    w = over(by, order)
    d = df.withColumn("__d", angle_step(F.col(yaw), w)).withColumn("__n", F.lead("__d").over(w))
    rate = F.when(F.col("__d").isNotNull() & F.col("__n").isNotNull(), F.abs(F.col("__d") + F.col("__n")) / (2 * dt)).otherwise(F.abs(F.coalesce("__d", "__n", F.lit(0.0))) / dt)
    return d.withColumn(out, rate).drop("__d", "__n")


def box_smooth(c: str, by: Sequence[str], order: Sequence[str], k: int) -> Column:
    """Centred box of k rows with zeros outside, divided by k (W04); an even box reaches further back."""
    return F.sum(c).over(span(by, order, -(k // 2), k - 1 - k // 2)) / k


def speed(x: str, y: str, z: str, by: Sequence[str], order: Sequence[str], dt: float) -> Column:
    """Length of the step from the row before, per second; the first row takes the second's (W05); 0 for a single row."""
    w = over(by, order)

    def step(other):
        return sum(((F.col(c) - other(F.col(c)).over(w)) ** 2 for c in (y, z)), (F.col(x) - other(F.col(x)).over(w)) ** 2)

    return F.coalesce(F.sqrt(step(F.lag)), F.sqrt(step(F.lead)), F.lit(0.0)) / dt


def with_velocity(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: Sequence[str], dt: float) -> DataFrame:
    """Forward differences per second, v_<col>; the last row repeats the one before (W06); 0 for a single row."""
    w = over(by, order)
    for c in cols:
        fwd = (F.lead(c).over(w) - F.col(c)) / dt
        back = (F.col(c) - F.lag(c).over(w)) / dt
        df = df.withColumn(f"v_{c}", F.coalesce(fwd, back, F.lit(0.0)))
    return df


def lookahead_min(c: str, by: Sequence[str], order: Sequence[str], horizon: int) -> Column:
    """Least value over this and the next horizon - 1 rows."""
    return F.min(c).over(span(by, order, 0, horizon - 1))


def next_match(cond: Column, index: Column, by: Sequence[str], order: Sequence[str]) -> Column:
    """Index of the next later row where ``cond`` holds, else null."""
    return F.min(F.when(cond, index)).over(span(by, order, 1, Window.unboundedFollowing))


def first_of(keys: Sequence[Column], none: int = -1) -> Column:
    """The first of the keys that is neither null nor the sentinel, else the sentinel."""
    return F.coalesce(*[F.nullif(k, F.lit(none)) for k in keys], F.lit(none))


def quota_split(df: DataFrame, order: Sequence[str], quotas: Sequence[tuple[str, int | None]], out: str = "split") -> DataFrame:
    """The first rows in ``order`` get the first split's name and so on; rows beyond all quotas are left out.

    A quota of None takes all that is left. Only the rows of finite quotas are put in
    order: a limit keeps that sort to the heads of the partitions, and the rest is
    what does not come before the last of them.
    """
    finite: list[tuple[str, int]] = []
    rest = None
    for label, n in quotas:
        if n is None:
            rest = label
            break
        finite.append((label, n))
    total = sum(n for _, n in finite)
    edges, at = [], 0
    for label, n in finite:
        at += n
        edges.append((label, at))
    if not total:
        return df.withColumn(out, F.lit(rest)) if rest is not None else df.where(F.lit(False)).withColumn(out, F.lit(None).cast("string"))
    case = F.lit(None).cast("string")
    for label, edge in reversed(edges):
        case = F.when(F.col("__rn") <= edge, F.lit(label)).otherwise(case)
    numbered = df.orderBy(*order).limit(total).withColumn("__rn", F.row_number().over(Window.orderBy(*order)))
    head = numbered.withColumn(out, case).drop("__rn")
    if rest is None:
        return head
    # the order's keys name a row; without a head there is no rest
    last = numbered.where(F.col("__rn") == total).select(F.struct(*order).alias("k")).scalar()
    return head.unionByName(df.where(F.struct(*order) > last).withColumn(out, F.lit(rest)))


def with_gap(df: DataFrame, by: Sequence[str], order: Sequence[str], seconds: str, fps: float, slack: float = 0.1) -> DataFrame:
    """gap_s, the time since the row before (null for the first), and is_gap, when it exceeds 1/fps by ``slack``."""
    gap = F.col(seconds) - F.lag(seconds).over(over(by, order))
    d = df.withColumn("gap_s", gap)
    return d.withColumn("is_gap", F.coalesce(F.col("gap_s") - 1.0 / fps > slack, F.lit(False)))


def run_groups(df: DataFrame, id_col: str, order: Sequence[str], by: Sequence[str] = (), out: str = "run_no") -> DataFrame:
    """Numbers the runs of equal ids in the given order, from 0 (A04): an id that returns starts a new run.

    ``by`` names the files or partitions within which order is defined; runs do
    not reach across them.
    """
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    new = F.coalesce((~F.col(id_col).eqNullSafe(F.lag(id_col).over(w))).cast("int"), F.lit(1))
    d = df.withColumn("__new", F.when(F.lag(F.lit(1)).over(w).isNull(), F.lit(0)).otherwise(new))
    return d.withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def action_chunk(c: str, by: Sequence[str], order: Sequence[str], steps: int = 16) -> Column:
    """The values of this and the next steps - 1 rows as a list."""
    return F.collect_list(c).over(span(by, order, 0, steps - 1))


#: Offset that stands for the episode's first row.
FIRST = -9999


def at_offset(c: str, by: Sequence[str], order: Sequence[str], offset: int) -> Column:
    """The value ``offset`` rows ahead, that of the last row beyond it, or the first row's for FIRST."""
    if offset == FIRST:
        return first_frame(c, by, order)
    return F.last(c).over(span(by, order, min(0, offset), offset))


def first_frame(c: str, by: Sequence[str], order: Sequence[str]) -> Column:
    """The value of the episode's first row."""
    return F.first(c).over(span(by, order, Window.unboundedPreceding, 0))


def next_or_self(c: str, by: Sequence[str], order: Sequence[str]) -> Column:
    """The next row's value; the last row's own (W02u)."""
    return F.coalesce(F.lead(c).over(over(by, order)), F.col(c))


def every_kth(df: DataFrame, index: str, k: int) -> DataFrame:
    """Every k-th row by its index."""
    return df.where(F.pmod(F.col(index), F.lit(k)) == 0)


def fold_planar(deltas: Column) -> Column:
    """[x, y, z, yaw degrees] after applying planar body-frame steps in order (W15); null steps are skipped."""
    start = F.array(*[F.lit(0.0)] * 4)

    def step(p: Column, d: Column) -> Column:
        yaw = F.radians(p[3])
        moved = F.array(p[0] + F.cos(yaw) * d[0] - F.sin(yaw) * d[1], p[1] + F.sin(yaw) * d[0] + F.cos(yaw) * d[1], p[2] + d[2], F.pmod(p[3] + d[3] + 180.0, F.lit(360.0)) - 180.0)
        return F.when(d.isNull(), p).otherwise(moved)

    return F.aggregate(deltas, start, step)
