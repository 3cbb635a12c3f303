"""The farthest later frame that can be seen from each frame.

Candidate frames j of frame i lie between i and the end of its sub-task interval.
They are pairs of one episode within a bounded look-ahead, joined by episode and
block of frames, so that a long episode spreads. A candidate is blocked when it is
out of the image, behind the camera or hidden by the depth around its pixel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pixels from the image's edge that count as near it; half width of the depth patch.
EDGE, PATCH = 20, 5


def enclosing_end(intervals: Column, i: Column, last: Column) -> Column:
    """End of the interval around frame i with the smallest end, else the last frame (J08); ends beyond it are cut."""
    around = F.filter(intervals, lambda p: (p["start"] <= i) & (i <= p["end"]))
    return F.least(F.coalesce(F.array_min(F.transform(around, lambda p: p["end"])), last), last)


def min_filter(pixels: DataFrame, by: Sequence[str], size: int = 2 * PATCH + 1) -> DataFrame:
    """Least depth in the square around each pixel, cut at the image's edges (W09): rows first, then columns.

    ``pixels`` has the image columns ``by``, v, u and depth, every pixel of the
    image; a window may thus count rows.
    """
    h = size // 2
    row = Window.partitionBy(*by, "v").orderBy("u").rowsBetween(-h, h)
    col = Window.partitionBy(*by, "u").orderBy("v").rowsBetween(-h, h)
    return pixels.withColumn("__r", F.min("depth").over(row)).withColumn("min_depth", F.min("__r").over(col)).drop("__r")


def blocked(u: Column, v: Column, d: Column, depth_min: Column, width: Column, height: Column) -> Column:
    """True where a projected point cannot be seen (F09, F10); a null depth hides nothing."""
    out = F.coalesce((u < 0) | (u >= width) | (v < 0) | (v >= height), F.lit(True)) | (d <= 0)
    return out | F.coalesce(depth_min <= d, F.lit(False))


def near_edge(u: Column, v: Column, width: Column, height: Column, edge: int = EDGE) -> Column:
    """True for a pixel closer than ``edge`` to the image's border."""
    return (u < edge) | (u > width - edge) | (v < edge) | (v > height - edge)


def candidate_pairs(frames: DataFrame, by: Sequence[str], frame: str, end: str, cols: Sequence[str]) -> DataFrame:
    """Pairs (i, j) with i < j <= i's ``end`` of one episode (J05): ``cols`` of both, the target's with the prefix t_.

    Every frame is written to the blocks of 256 frames it looks into, so pairs
    meet by episode and block. The pairs are the operator's own task; their number
    is bounded by the intervals, which are sub-tasks of an episode.
    """
    b = lambda c: F.shiftright(c, 8)
    left = frames.where(F.col(end) > F.col(frame)).select(*by, F.col(frame), F.col(end), *cols, F.explode(F.sequence(b(F.col(frame) + 1), b(F.col(end)))).alias("__b"))
    right = frames.select(*[F.col(c).alias(f"__t{c}") for c in by], F.col(frame).alias("t_frame"), *[F.col(c).alias(f"t_{c}") for c in cols], b(F.col(frame)).alias("__tb"))
    on = [F.col(c) == F.col(f"__t{c}") for c in by] + [F.col("__b") == F.col("__tb"), F.col("t_frame") > F.col(frame), F.col("t_frame") <= F.col(end)]
    return left.join(right, on).drop("__b", "__tb", *[f"__t{c}" for c in by])


def farthest(pairs: DataFrame, by: Sequence[str], frame: str, end: str, stop: str, edge: str) -> DataFrame:
    """(by, frame, farthest): the last unblocked frame before the first blocked one, not near the edge.

    One aggregation gives the first stop; a second, over the pairs before it, the
    last frame away from the edge. Where all are near the edge it is the next frame.
    """
    first = pairs.groupBy(*by, frame, end).agg(F.min(F.when(F.col(stop), F.col("t_frame"))).alias("__stop"), F.sort_array(F.collect_list(F.when(~F.col(edge), F.col("t_frame")))).alias("__free"))
    visible = F.when(F.col("__stop").isNull(), F.col(end)).otherwise(F.greatest(F.col(frame) + 1, F.col("__stop") - 1))
    last = F.array_max(F.filter("__free", lambda j: j <= visible))
    return first.select(*by, frame, F.coalesce(last, F.col(frame) + 1).alias("farthest"))
