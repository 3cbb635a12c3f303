"""Views of the project's tables as episodes, and the registry of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helmwake.session import table


@dataclass
class Registry:
    """Queries by name, with the SQL that must give the same rows."""

    fns: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        return self.fns

    def oracle_sql(self) -> dict[str, str]:
        return self.sql

    def query(self, name: str, sql: str | None = None):
        def add(fn: Callable[[SparkSession, str], DataFrame]):
            self.fns[name] = fn
            if sql:
                self.sql[name] = sql.strip()
            return fn

        return add


def r6(c: Column | str) -> Column:
    """Rounded to six places, beyond 1e5 to the nearest float32, without a negative zero."""
    v = F.col(c) if isinstance(c, str) else c
    r = F.when(F.abs(v) >= 1e5, v.cast("float").cast("double")).otherwise(F.round(v, 6))
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def q6(expr: str) -> str:
    """SQL of r6."""
    return f"CASE WHEN abs({expr}) >= 1e5 THEN CAST(CAST({expr} AS FLOAT) AS DOUBLE) WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END"


def rounded(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return df.select(*keys, *[r6(c).alias(c) for c in cols])


def steps(spark: SparkSession, d: str) -> DataFrame:
    """The states, one row per (scene, ep, f): ts, x, y, z, yaw; exact copies once.

    A frame whose state lacks one of the four numbers (null, NaN, a short array) is no
    pose; every other frame is here, however implausible its reading. The one exchange by
    ``ep`` serves the copies and every window by episode after it.
    """
    s = "`observation.state`"
    t = table(spark, d, "frames").where("episode_index IS NOT NULL AND frame_index IS NOT NULL")
    at = lambda i, n: F.expr(f"nullif(cast(get({s}, {i}) AS double), double('NaN'))").alias(n)
    t = t.select("scene", "robot", F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), F.col("timestamp").alias("ts"), F.col("task_index").alias("task"), at(0, "x"), at(1, "y"), at(2, "z"), at(3, "yaw"))
    return t.dropna(subset=["x", "y", "z", "yaw"]).repartition("ep").distinct()


STEPS = """steps AS (
  SELECT DISTINCT * FROM (SELECT scene, robot, episode_index AS ep, frame_index AS f, "timestamp" AS ts, task_index AS task,
    CAST("observation.state"[1] AS DOUBLE) AS x, CAST("observation.state"[2] AS DOUBLE) AS y, CAST("observation.state"[3] AS DOUBLE) AS z, CAST("observation.state"[4] AS DOUBLE) AS yaw
  FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL)
  WHERE NOT (isnan(x) OR isnan(y) OR isnan(z) OR isnan(yaw)))"""


def poses(spark: SparkSession, d: str) -> DataFrame:
    """Poses with all six axes, from the first numbers of the vectors: ep, f, x, y, z, roll, pitch, yaw (degrees) and a point px, py, pz."""
    e = lambda i, k: F.expr(f"cast(get(embedding, {i}) AS double) * {k}")
    names = ["x", "y", "z", "roll", "pitch", "yaw", "px", "py", "pz"]
    scale = [10.0] * 3 + [60.0] * 3 + [10.0] * 3
    t = table(spark, d, "embeddings").select(F.col("label").cast("bigint").alias("ep"), F.col("vec_id").alias("f"), *[e(i, k).alias(n) for i, (n, k) in enumerate(zip(names, scale))])
    return t


POSES = """poses AS (
  SELECT CAST(label AS BIGINT) AS ep, vec_id AS f, CAST(embedding[1] AS DOUBLE) * 10.0 AS x, CAST(embedding[2] AS DOUBLE) * 10.0 AS y, CAST(embedding[3] AS DOUBLE) * 10.0 AS z,
    CAST(embedding[4] AS DOUBLE) * 60.0 AS roll, CAST(embedding[5] AS DOUBLE) * 60.0 AS pitch, CAST(embedding[6] AS DOUBLE) * 60.0 AS yaw,
    CAST(embedding[7] AS DOUBLE) * 10.0 AS px, CAST(embedding[8] AS DOUBLE) * 10.0 AS py, CAST(embedding[9] AS DOUBLE) * 10.0 AS pz
  FROM embeddings)"""


def numbered(df: DataFrame) -> DataFrame:
    """Poses whose f is the place in the episode, from 0."""
    from pyspark.sql import Window

    return df.withColumn("f", (F.row_number().over(Window.partitionBy("ep").orderBy("f")) - 1).cast("bigint"))


NUMBERED = POSES + """,
np AS (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY ep ORDER BY f) - 1 AS BIGINT) AS f) FROM poses)"""


def sql_rot(yaw: str, pitch: str, roll: str, p: str) -> str:
    """SQL columns p0..p8 of the rotation Rz(yaw) Ry(pitch) Rx(roll), angles in degrees."""
    cy, sy, cp, sp, cr, sr = (f"{fn}(radians({a}))" for a in (yaw, pitch, roll) for fn in ("cos", "sin"))
    m = [f"{cy}*{cp}", f"{cy}*{sp}*{sr}-{sy}*{cr}", f"{cy}*{sp}*{cr}+{sy}*{sr}", f"{sy}*{cp}", f"{sy}*{sp}*{sr}+{cy}*{cr}", f"{sy}*{sp}*{cr}-{cy}*{sr}", f"-({sp})", f"{cp}*{sr}", f"{cp}*{cr}"]
    return ", ".join(f"{e} AS {p}{i}" for i, e in enumerate(m))


def sql_mul(a: str, b: str, out: str, ta: bool = False) -> str:
    """SQL columns of the product of the rotations a (transposed where ta) and b."""
    ix = (lambda i, k: f"{a}{3 * k + i}") if ta else (lambda i, k: f"{a}{3 * i + k}")
    return ", ".join(f"{ix(i, 0)}*{b}{j}+{ix(i, 1)}*{b}{3 + j}+{ix(i, 2)}*{b}{6 + j} AS {out}{3 * i + j}" for i in range(3) for j in range(3))


def sql_apply(a: str, v: list[str], out: list[str], ta: bool = False) -> str:
    """SQL columns of the rotated vector."""
    ix = (lambda i, k: f"{a}{3 * k + i}") if ta else (lambda i, k: f"{a}{3 * i + k}")
    return ", ".join(f"{ix(i, 0)}*({v[0]})+{ix(i, 1)}*({v[1]})+{ix(i, 2)}*({v[2]}) AS {o}" for i, o in enumerate(out))


def sql_wrap(e: str) -> str:
    return f"(({e}) + 180.0 - 360.0 * floor((({e}) + 180.0) / 360.0) - 180.0)"
