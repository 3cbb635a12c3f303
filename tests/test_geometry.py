import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helmwake.operators import se3

P6 = ["x", "y", "z", "roll", "pitch", "yaw"]


def rot(roll, pitch, yaw):
    cr, sr, cp, sp, cy, sy = (f(math.radians(a)) for a in (roll, pitch, yaw) for f in (math.cos, math.sin))
    rz, ry, rx = np.array([[cy, -sy, 0], [sy, cy, 0], [0, 0, 1]]), np.array([[cp, 0, sp], [0, 1, 0], [-sp, 0, cp]]), np.array([[1, 0, 0], [0, cr, -sr], [0, sr, cr]])
    return rz @ ry @ rx


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(42)
    lo, hi = [-10, -10, 0, -180, -89, -180], [10, 10, 20, 180, 89, 180]
    rows = [tuple(map(float, np.r_[rng.uniform(lo, hi), rng.uniform(lo, hi)])) for _ in range(50)]
    return rows, spark.createDataFrame(rows, ", ".join(f"{p}{c} double" for p in "ab" for c in P6))


def cols(p):
    return [F.col(p + c) for c in P6]


def test_relative_pose_and_back(pairs):
    rows, df = pairs
    rel = se3.relative_pose(cols("a"), cols("b"))
    d = df.select("*", *[c.alias("r" + n) for n, c in zip(P6, rel)])
    back = se3.body_to_world(cols("a"), cols("r"))
    got = d.select(*[F.col("r" + n) for n in P6], *[c.alias("w" + n) for n, c in zip(P6, back)]).collect()
    for r, g in zip(rows, got):
        a, b = np.array(r[:6]), np.array(r[6:])
        assert np.allclose(g[:3], rot(*a[3:]).T @ (b[:3] - a[:3]), atol=1e-9)
        assert np.allclose(rot(*g[3:6]), rot(*a[3:]).T @ rot(*b[3:]), atol=1e-9)
        assert np.allclose(g[6:9], b[:3], atol=1e-6) and np.allclose(rot(*g[9:12]), rot(*b[3:]), atol=1e-6)


def test_planar_forms_agree(pairs):
    _, df = pairs
    full = se3.relative_pose_given_axes(cols("a"), cols("b"), ["x", "y", "z", "yaw"])
    flat = se3.planar_local([F.col("a" + c) for c in ("x", "y", "z", "yaw")], [F.col("b" + c) for c in ("x", "y", "z", "yaw")])
    for r in df.select(*[full[i].alias(f"f{i}") for i in (0, 1, 2, 5)], *[c.alias(f"p{i}") for i, c in enumerate(flat)]).collect():
        assert np.allclose(r[:3], r[4:7], atol=1e-6) and abs((r[3] - r[7] + 180) % 360 - 180) < 1e-6
    with pytest.raises(ValueError):
        se3.keep_axes(cols("a"), ["w"])


def test_inverse_compose_and_level_camera(pairs):
    _, df = pairs
    p = se3.pose6(cols("a"))
    one = se3.compose(p, se3.inverse(p))
    lv = se3.level_camera(p.r)
    roll = F.degrees(se3.euler_zyx(lv)[2])
    dist = se3.angular_distance(p.r, p.r)
    for r in df.select(*[c.alias(f"m{i}") for i, c in enumerate([*one.r, *one.t])], roll.alias("roll"), dist.alias("d")).collect():
        assert np.allclose(r[:12], [1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0], atol=1e-9)
        assert abs(r["roll"] - 90) < 1e-6 and r["d"] < 1e-6


def test_projection_guards(spark):
    df = spark.createDataFrame([(0.0, 0.0, -2.0), (0.0, 0.0, 0.0), (1.0, 1.0, 3.0)], "x double, y double, z double")
    u, v, d = se3.pinhole(F.col("x"), F.col("y"), F.col("z"), F.lit(100.0), F.lit(100.0), F.lit(50.0), F.lit(40.0), F.lit(80))
    rows = df.select(u.alias("u"), v.alias("v"), d.alias("d")).collect()
    assert tuple(rows[0]) == (50.0, 39.0, 2.0) and rows[1]["u"] is None and rows[2]["v"] is None
    assert df.select(se3.half_even(F.lit(2.5)).alias("a"), se3.half_even(F.lit(3.5)).alias("b")).first()[:] == (2.0, 4.0)
