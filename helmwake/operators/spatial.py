"""Point clouds: voxels, nearest points and risk along projected paths.

There is no spatial index in Spark; points are joined by grid cell. Cells of
the search radius make the 27 cells around a query exact for all distances up to
the radius, which is all that the clamped risk needs. Unbounded nearest
neighbours enlarge the cells until no closer point can be left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmwake.operators.prefix import join_null_safe
from helmwake.operators.se3 import expit, norm3
from helmwake.operators.sequence import box_smooth, lookahead_min, over, speed, with_velocity, with_yaw_rate

#: Growth of the cells from one round of the neighbour search to the next, and the rounds.
GROWTH, ROUNDS = 8, 3


def voxel_downsample(points: DataFrame, scene: Sequence[str], size: float, cols: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Mean point of each voxel, and the number of its points.

    A scene's grid starts half a voxel below its least coordinates. Sums combine
    inside each task, so a dense voxel costs no more.
    """
    lo = points.groupBy(*scene).agg(*[F.min(c).alias(f"__lo_{c}") for c in cols])
    p = join_null_safe(points, lo, list(scene))
    cells = [F.floor((F.col(c) - (F.col(f"__lo_{c}") - size / 2)) / size).cast("bigint").alias(f"v{c}") for c in cols]
    p = p.select(*scene, *cols, *cells)
    return p.groupBy(*scene, *[f"v{c}" for c in cols]).agg(*[F.avg(c).alias(c) for c in cols], F.count("*").alias("n_points"))


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("bigint")


def nearest_within(queries: DataFrame, points: DataFrame, scene: str, key: Sequence[str], radius: float, out: str = "dist") -> DataFrame:
    """(key, out): distance to the nearest point of the same scene, capped at ``radius``; one row per key, over all its query points.

    Each point is written to the 27 cells around its own, so a query meets all
    points within the radius in its one cell. Keys without any point near get the
    radius (J07 with A08).
    """
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    p = points.select(F.col(scene).alias("__s"), *[F.col(c).alias(f"p{c}") for c in "xyz"], F.explode(around).alias("o"))
    p = p.select("__s", "px", "py", "pz", *[(_cell(F.col(f"p{c}"), radius) + F.col(f"o.{o}")).alias(f"__c{c}") for c, o in zip("xyz", "ijk")])
    q = queries.select(scene, *key, "x", "y", "z", *[_cell(F.col(c), radius).alias(f"__q{c}") for c in "xyz"])
    on = [F.col(scene) == F.col("__s"), *[F.col(f"__q{c}") == F.col(f"__c{c}") for c in "xyz"]]
    j = q.join(p, on, "left")
    d = norm3(F.col("x") - F.col("px"), F.col("y") - F.col("py"), F.col("z") - F.col("pz"))
    return j.groupBy(scene, *key).agg(F.least(F.coalesce(F.min(d), F.lit(radius)), F.lit(radius)).alias(out))


def knn(queries: DataFrame, points: DataFrame, scene: str, key: Sequence[str], point_key: str, k: int, cell: float) -> DataFrame:
    """The k nearest points of the same scene for each query point: key, point_key, dist, rank.

    Round by round: a query looks into the 27 cells around it and is settled once its
    k-th distance is no larger than a cell. For those still open the cells are GROWTH
    times as large in the next round, so each round looks into 27 cells only. What is
    open after ROUNDS, with cells far larger than a scene, is compared with its whole
    scene, so the result is exact. Ties go by ``point_key``.
    """
    qs = queries.select(scene, *key, "x", "y", "z")
    ps = points.select(F.col(scene).alias("__s"), F.col(point_key).alias("__p"), *[F.col(c).alias(f"p{c}") for c in "xyz"])
    dist = norm3(F.col("x") - F.col("px"), F.col("y") - F.col("py"), F.col("z") - F.col("pz"))
    rank = F.row_number().over(Window.partitionBy(scene, *key).orderBy("dist", "__p"))
    done = None
    rest = qs
    around = F.array(*[F.struct(*[F.lit(o).alias(n) for o, n in zip((i, j, m), "ijk")]) for i in (-1, 0, 1) for j in (-1, 0, 1) for m in (-1, 0, 1)])
    for r in range(ROUNDS):
        size = cell * GROWTH**r
        q = rest.select("*", F.explode(around).alias("o"))
        p = ps.select("*", *[_cell(F.col(f"p{c}"), size).alias(f"__c{c}") for c in "xyz"])
        on = [F.col(scene) == F.col("__s"), *[(_cell(F.col(c), size) + F.col(f"o.{o}")) == F.col(f"__c{c}") for c, o in zip("xyz", "ijk")]]
        near = q.join(p, on).select(scene, *key, F.col("__p"), dist.alias("dist")).withColumn("rank", rank).where(F.col("rank") <= k)
        full = near.groupBy(scene, *key).agg(F.count("*").alias("n"), F.max("dist").alias("d")).where((F.col("n") >= k) & (F.col("d") <= size)).select(scene, *key)
        settled = near.join(full, [scene, *key], "left_semi")
        done = settled if done is None else done.unionByName(settled)
        rest = rest.join(full, [scene, *key], "left_anti")
    last = rest.join(ps, F.col(scene) == F.col("__s")).select(scene, *key, F.col("__p"), dist.alias("dist")).withColumn("rank", rank).where(F.col("rank") <= k)
    return done.unionByName(last).select(scene, *key, F.col("__p").alias(point_key), "dist", F.col("rank").cast("bigint").alias("rank"))


def risk_logistic(d: Column, safe: float = 0.5, sigma: float = 0.2) -> Column:
    """Logistic risk of a distance."""
    return expit((F.lit(safe) - d) / sigma)


def risk_biased(d: Column, safe: float = 0.5, beta: float = 8.0, at_safe: float = 0.75) -> Column:
    """Logistic risk that is ``at_safe`` at the safe distance."""
    return expit(-(d - safe) * beta + F.log(F.lit(at_safe / (1 - at_safe))))


def risk_linear(d: Column, full: float = 0.01, none: float = 1.2) -> Column:
    """1 up to ``full``, 0 from ``none``, a straight line between."""
    return F.when(d <= full, F.lit(1.0)).when(d >= none, F.lit(0.0)).otherwise((F.lit(none) - d) / (none - full))


def ghost_points(poses: DataFrame, scene: str, key: Sequence[str], speed_col: str, dt: float, steps: Column | int, heading: str = "yaw") -> DataFrame:
    """Points ahead of each pose at constant speed along its heading (G19): key, step, x, y, z."""
    n = F.lit(steps) if isinstance(steps, int) else steps
    e = poses.withColumn("step", F.explode(F.sequence(F.lit(1), n)))
    ahead = F.col(speed_col) * F.col("step") * dt
    a = F.radians(F.col(heading))
    return e.select(scene, *key, "step", (F.col("x") + ahead * F.cos(a)).alias("x"), (F.col("y") + ahead * F.sin(a)).alias("y"), F.col("z"))


def collision_probability(poses: DataFrame, points: DataFrame, scene: str, episode: Sequence[str], frame: str, dt: float = 0.1, horizon_s: float = 3.5, none: float = 1.2) -> DataFrame:
    """(episode, frame, prob): risk of a collision when going on straight.

    ``poses`` has scene, episode, frame, x, y, z and yaw in degrees, in the world.
    Distances beyond ``none`` do not count, so the grid of that size is exact.
    """
    steps = int(round(horizon_s / dt))
    p = poses.withColumn("__v", speed("x", "y", "z", episode, [frame], dt))
    key = [*[c for c in episode if c != scene], frame]
    ghosts = ghost_points(p, scene, key, "__v", dt, steps)
    near = nearest_within(ghosts, points, scene, key, none, "m")
    return near.select(scene, *key, risk_linear(F.col("m"), none=none).alias("prob"))


def avoidance(poses: DataFrame, points: DataFrame, scene: str, episode: Sequence[str], frame: str, strategy: str | Callable = "turning", **options) -> DataFrame:
    """(episode, frame, score) by the strategy: 'turning' (G21), 'velocity' (G22) or any function with their parameters."""
    known = {"turning": avoidance_turning, "velocity": avoidance_velocity}
    if isinstance(strategy, str) and strategy not in known:
        raise ValueError(f"no such strategy: {strategy}; there are {sorted(known)}")
    return (known[strategy] if isinstance(strategy, str) else strategy)(poses, points, scene, episode, frame, **options)


def _nearest(queries: DataFrame, points: DataFrame, scene: str, key: Sequence[str], reach: float) -> DataFrame:
    """Distance of each query point to its scene's nearest point, up to ``reach``, beyond which the risks are 0 within 1e-9."""
    return nearest_within(queries, points, scene, key, reach, "d")


def avoidance_turning(poses: DataFrame, points: DataFrame, scene: str, episode: Sequence[str], frame: str, dt: float = 0.1, reach: float = 5.0) -> DataFrame:
    """(episode, frame, score): risk that turning took away, against going straight.

    The real path's risk is that of its least distance over 4 s; the straight
    path has as many steps as frames are left. ``reach`` caps distances where the
    logistic risk is below 1e-9.
    """
    h = int(round(4.0 / dt))
    key = [*[c for c in episode if c != scene], frame]
    p = poses.withColumn("__v", speed("x", "y", "z", episode, [frame], dt))
    p = with_yaw_rate(p, episode, [frame], "yaw", dt, "__w")
    p = p.withColumn("__w", box_smooth("__w", episode, [frame], 5))
    w = over(episode, [frame])
    p = p.withColumn("__left", F.least(F.lit(h), F.count("*").over(Window.partitionBy(*episode)) - F.row_number().over(w) + 1).cast("int"))
    real = join_null_safe(p, _nearest(p, points, scene, key, reach), [scene, *key])
    real = real.withColumn("__m", lookahead_min("d", episode, [frame], h)).select(scene, *key, "__v", "__w", "__m")
    ghosts = ghost_points(p.where("__v > 0.1"), scene, key, "__v", dt, F.col("__left"))
    g = nearest_within(ghosts, points, scene, key, reach, "__g")
    j = join_null_safe(real, g, [scene, *key], "left")
    risk_real = risk_logistic(F.col("__m"))
    risk_ghost = F.when(F.col("__g").isNotNull(), risk_logistic(F.col("__g"))).otherwise(risk_real)
    return j.select(scene, *key, (F.greatest(F.lit(0.0), risk_ghost - risk_real) * expit((F.col("__w") - 15.0) / 5.0)).alias("score"))


def avoidance_velocity(poses: DataFrame, points: DataFrame, scene: str, episode: Sequence[str], frame: str, dt: float = 0.1, reach: float = 5.0) -> DataFrame:
    """(episode, frame, score): the same from the velocity vector; 0 where less than 4 s are left."""
    h = int(round(4.0 / dt))
    key = [*[c for c in episode if c != scene], frame]
    p = with_velocity(poses, ["x", "y", "z"], episode, [frame], dt)
    p = with_yaw_rate(p, episode, [frame], "yaw", dt, "__w")
    p = p.withColumn("__w", F.radians(box_smooth("__w", episode, [frame], 5)))
    w = over(episode, [frame])
    p = p.withColumn("__ok", F.row_number().over(w) - 1 + h < F.count("*").over(Window.partitionBy(*episode)))
    real = join_null_safe(p, _nearest(p, points, scene, key, reach), [scene, *key])
    real = real.withColumn("__m", lookahead_min("d", episode, [frame], h)).select(scene, *key, "__w", "__m", "__ok")
    e = p.where("__ok").withColumn("__s", F.explode(F.sequence(F.lit(1), F.lit(h))))
    ghosts = e.select(scene, *key, *[(F.col(c) + F.col(f"v_{c}") * dt * F.col("__s")).alias(c) for c in "xyz"])
    g = nearest_within(ghosts, points, scene, key, reach, "__g")
    j = join_null_safe(real, g, [scene, *key], "left")
    gain = F.greatest(F.lit(0.0), risk_biased(F.col("__g")) - risk_biased(F.col("__m"))) * expit((F.col("__w") - 0.2) * 10.0)
    return j.select(scene, *key, F.when(F.col("__ok"), gain).otherwise(F.lit(0.0)).alias("score"))
