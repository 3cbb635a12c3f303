"""Rigid-body algebra as column expressions.

A rotation is nine columns (row-major), a pose a rotation and three columns of
translation. Angles are radians unless a function says degrees. Euler angles are
intrinsic Z-Y-X: R = Rz(yaw) Ry(pitch) Rx(roll). All expressions stay in whole-stage
code generation, where common subexpressions are computed once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rot = list[Column]
AXES = ("x", "y", "z", "roll", "pitch", "yaw")


@dataclass(frozen=True)
class Pose:
    """A rotation and a translation."""

    r: Rot
    t: list[Column]


def rot_zyx(yaw: Column, pitch: Column, roll: Column) -> Rot:
    """Rotation of intrinsic Z-Y-X angles."""
    cy, sy, cp, sp, cr, sr = F.cos(yaw), F.sin(yaw), F.cos(pitch), F.sin(pitch), F.cos(roll), F.sin(roll)
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def clip(c: Column, lo: float, hi: float) -> Column:
    """The value, bounded on both sides; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def euler_zyx(r: Rot) -> tuple[Column, Column, Column]:
    """(yaw, pitch, roll) of a rotation."""
    return F.atan2(r[3], r[0]), -F.asin(clip(r[6], -1.0, 1.0)), F.atan2(r[7], r[8])


def euler_yxz(r: Rot) -> tuple[Column, Column, Column]:
    """(yaw, pitch, roll) of a rotation by intrinsic Y-X-Z angles."""
    return F.atan2(r[2], r[8]), -F.asin(clip(r[5], -1.0, 1.0)), F.atan2(r[3], r[4])


def transpose(r: Rot) -> Rot:
    return [r[0], r[3], r[6], r[1], r[4], r[7], r[2], r[5], r[8]]


def apply(r: Rot, v: Sequence[Column]) -> list[Column]:
    """The rotated vector."""
    return [r[3 * i] * v[0] + r[3 * i + 1] * v[1] + r[3 * i + 2] * v[2] for i in range(3)]


def matmul(a: Rot, b: Rot) -> Rot:
    return [a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)]


def inverse(p: Pose) -> Pose:
    """The inverse of a rigid pose, by transposition."""
    rt = transpose(p.r)
    return Pose(rt, [-c for c in apply(rt, p.t)])


def compose(a: Pose, b: Pose) -> Pose:
    """b, given in a's frame, in the frame a is given in."""
    return Pose(matmul(a.r, b.r), [x + y for x, y in zip(apply(a.r, b.t), a.t)])


def from_flat(m: Column) -> Pose:
    """The pose in a flat row-major 4 x 4 matrix (array<double> of 16)."""
    g = [F.get(m, F.lit(i)) for i in range(12)]
    return Pose([g[0], g[1], g[2], g[4], g[5], g[6], g[8], g[9], g[10]], [g[3], g[7], g[11]])


def to_flat(p: Pose) -> Column:
    z = F.lit(0.0)
    r, t = p.r, p.t
    return F.array(r[0], r[1], r[2], t[0], r[3], r[4], r[5], t[1], r[6], r[7], r[8], t[2], z, z, z, F.lit(1.0))


def flat_matrix(m: Column, nested: bool) -> Column:
    """A matrix column as a flat array, whether it comes nested or flat."""
    return F.flatten(m) if nested else m


def pose6(cols: Sequence[Column], degrees: bool = True) -> Pose:
    """The pose of [x, y, z, roll, pitch, yaw]."""
    ang = [F.radians(c) for c in cols[3:]] if degrees else list(cols[3:])
    return Pose(rot_zyx(ang[2], ang[1], ang[0]), list(cols[:3]))


def as_pose6(p: Pose, degrees: bool = True) -> list[Column]:
    """[x, y, z, roll, pitch, yaw] of a pose."""
    yaw, pitch, roll = euler_zyx(p.r)
    ang = [roll, pitch, yaw]
    return [*p.t, *([F.degrees(c) for c in ang] if degrees else ang)]


def relative_pose(a: Sequence[Column], b: Sequence[Column], degrees: bool = True) -> list[Column]:
    """Pose b in a's frame, both and the result as [x, y, z, roll, pitch, yaw]."""
    return as_pose6(compose(inverse(pose6(a, degrees)), pose6(b, degrees)), degrees)


def body_to_world(a: Sequence[Column], rel: Sequence[Column], degrees: bool = True) -> list[Column]:
    """The inverse of ``relative_pose``."""
    return as_pose6(compose(pose6(a, degrees), pose6(rel, degrees)), degrees)


def keep_axes(p: Sequence[Column], axes: Sequence[str]) -> list[Column]:
    """The pose with all axes but those named set to zero (P02); an unknown name is an error."""
    if unknown := set(axes) - set(AXES):
        raise ValueError(f"no such axes: {sorted(unknown)}")
    return [c if n in axes else F.lit(0.0) for n, c in zip(AXES, p)]


def relative_pose_given_axes(a: Sequence[Column], b: Sequence[Column], axes: Sequence[str], degrees: bool = True) -> list[Column]:
    """``relative_pose`` of the poses reduced to ``axes``."""
    return relative_pose(keep_axes(a, axes), keep_axes(b, axes), degrees)


def wrap_degrees(c: Column) -> Column:
    """The angle in [-180, 180)."""
    return F.pmod(c + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def planar_local(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    """[x, y, z, yaw] of b in a's yaw-only frame, degrees."""
    yaw = F.radians(a[3])
    d = [q - p for p, q in zip(a[:3], b[:3])]
    return [F.cos(yaw) * d[0] + F.sin(yaw) * d[1], F.cos(yaw) * d[1] - F.sin(yaw) * d[0], d[2], wrap_degrees(b[3] - a[3])]


def planar_global(a: Sequence[Column], rel: Sequence[Column]) -> list[Column]:
    """A goal given in a's yaw-only frame, in the world."""
    yaw = F.radians(a[3])
    return [a[0] + F.cos(yaw) * rel[0] - F.sin(yaw) * rel[1], a[1] + F.sin(yaw) * rel[0] + F.cos(yaw) * rel[1], a[2] + rel[2], wrap_degrees(a[3] + rel[3])]


def level_camera(r: Rot, roll_degrees: float = 90.0) -> Rot:
    """The rotation with its yaw and pitch, and the roll of a level camera."""
    yaw, pitch, _ = euler_zyx(r)
    return rot_zyx(yaw, pitch, F.radians(F.lit(roll_degrees)))


def body_of_camera(t_w_c0: Pose) -> Pose:
    """World pose of the body at the first frame: forward, left and up from the levelled camera."""
    lv = level_camera(t_w_c0.r)
    return Pose([-lv[2], -lv[0], lv[1], -lv[5], -lv[3], lv[4], -lv[8], -lv[6], lv[7]], t_w_c0.t)


def camera_in_body(t_w_c0: Pose) -> Pose:
    """T_b_c: the camera in the body frame, constant for an episode."""
    return compose(inverse(body_of_camera(t_w_c0)), t_w_c0)


def pose4_degrees(p: Pose) -> list[Column]:
    """[x, y, z, yaw in degrees]."""
    return [*p.t, F.degrees(F.atan2(p.r[3], p.r[0]))]


def pinhole(x: Column, y: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column, height: Column) -> tuple[Column, Column, Column]:
    """(u, v, depth) of a point in a camera that looks along -z with y up; null at or behind the camera."""
    d = -z
    front = d > 0
    safe = F.when(front, d)
    return x * fx / safe + cx, (height - 1) - (y * fy / safe + cy), d


def flu_pixel(x: Column, y: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Truncated pixel of a point in a forward-left-up frame; null unless it lies in front."""
    depth = F.when(x > 0.1, x)
    return (fx * -y / depth + cx).cast("int"), (fy * -z / depth + cy).cast("int")


def intrinsics_fov(width: Column, height: Column, fov_x: Column, fov_y: Column | None = None) -> list[Column]:
    """(fx, fy, cx, cy) of a camera with the given angles of view in degrees, centre at half the size."""
    fx = width / (2 * F.tan(F.radians(fov_x) / 2))
    fy = fx if fov_y is None else height / (2 * F.tan(F.radians(fov_y) / 2))
    return [fx, fy, width / 2, height / 2]


def intrinsics_hfov(width: Column, height: Column, hfov: Column, center: str = "pixel") -> list[Column]:
    """(fx, fy, cx, cy) from the horizontal angle; the centre on a pixel ((n - 1) / 2) or in the plane (n / 2)."""
    f = width / (2 * F.tan(F.radians(hfov) / 2))
    mid = (lambda n: (n - 1) / 2) if center == "pixel" else (lambda n: n / 2)
    return [f, f, mid(width), mid(height)]


def back_project(u: Column, v: Column, depth: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> list[Column]:
    """The point of a pixel in a camera that looks along z with y down."""
    return [(u - cx) * depth / fx, (v - cy) * depth / fy, depth]


def angular_distance(a: Rot, b: Rot) -> Column:
    """The angle of the rotation from a to b (G26), from the skew part and the trace, as exact near 0 and 180 degrees as elsewhere."""
    m = matmul(transpose(a), b)
    return F.atan2(norm3(m[7] - m[5], m[2] - m[6], m[3] - m[1]), m[0] + m[4] + m[8] - 1)


def to_homogeneous(v: Sequence[Column], point: bool = True) -> list[Column]:
    """[x, y, z, 1] of a point, [x, y, z, 0] of a vector, which a translation does not move."""
    return [*v, F.lit(1.0 if point else 0.0)]


def apply_homogeneous(p: Pose, h: Sequence[Column]) -> list[Column]:
    """The pose's 4 x 4 matrix times a homogeneous point or vector."""
    return [*[r + t * h[3] for r, t in zip(apply(p.r, h[:3]), p.t)], h[3]]


def pose6_of_pose4(p: Sequence[Column]) -> list[Column]:
    """[x, y, z, roll, pitch, yaw] of [x, y, z, yaw]; roll and pitch are 0."""
    return [*p[:3], F.lit(0.0), F.lit(0.0), p[3]]


def pose4_of_pose6(p: Sequence[Column]) -> list[Column]:
    """[x, y, z, yaw] of [x, y, z, roll, pitch, yaw]."""
    return [*p[:3], p[5]]


def relative_pose4(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    """Pose b in a's frame, all as [x, y, z, yaw in degrees]."""
    return pose4_of_pose6(relative_pose(pose6_of_pose4(a), pose6_of_pose4(b)))


def levelled_state(first: Pose, here: Pose) -> tuple[list[Column], Column, Column]:
    """[x, y, z, yaw in degrees] of a camera seen from the first one, both levelled: forward, left, up (W01, first form); and pitch and roll, which must be 0."""
    level = lambda p: Pose(level_camera(p.r), p.t)
    rel = compose(inverse(level(first)), level(here))
    yaw, pitch, roll = euler_yxz(rel.r)
    x, y, z = rel.t
    return [-z, -x, y, F.degrees(yaw)], F.degrees(pitch), F.degrees(roll)


def require_level(value: Column, pitch: Column, roll: Column, most: float = 1e-3) -> Column:
    """The value, or an error that ends the query where pitch or roll is not 0."""
    return F.when((F.abs(pitch) < most) & (F.abs(roll) < most), value).otherwise(F.raise_error(F.concat(F.lit("pitch or roll is not 0: "), pitch.cast("string"), F.lit(", "), roll.cast("string"))))


def is_level(roll: Column, limit: float = 5.0) -> Column:
    """Is the camera's roll within ``limit`` degrees of a level one's 90 (F01)?"""
    return F.abs(F.lit(90.0) - roll) <= limit


def random_poses(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n poses with x, y in [-10, 10], z in [0, 20] and angles in [-180, 180], the same for a seed.

    The numbers are hashes of the row, so they do not depend on the partitions.
    """
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1 << 53)) / float(1 << 53)
    span = [(-10, 10), (-10, 10), (0, 20), (-180, 180), (-180, 180), (-180, 180)]
    return spark.range(n).select("id", *[(F.lit(float(a)) + u(k) * float(b - a)).alias(c) for k, (c, (a, b)) in enumerate(zip(AXES, span))])


def spiral_poses(spark: SparkSession, n: int, radius: float = 5.0, turns: float = 2.0, height: float = 10.0) -> DataFrame:
    """n poses up a spiral, heading along it."""
    t = F.col("id") / F.lit(float(max(n - 1, 1)))
    a = t * (2 * 3.141592653589793 * turns)
    return spark.range(n).select("id", (F.lit(radius) * F.cos(a)).alias("x"), (F.lit(radius) * F.sin(a)).alias("y"), (t * height).alias("z"), F.lit(0.0).alias("roll"), F.lit(0.0).alias("pitch"), wrap_degrees(F.degrees(a) + 90.0).alias("yaw"))


def path_colour(at: Column, start: Sequence[float] = (0.0, 0.0, 1.0), end: Sequence[float] = (1.0, 0.0, 0.0)) -> list[Column]:
    """[red, green, blue] from 0 to 1 of a place along a path, from 0 to 1."""
    t = clip(at, 0.0, 1.0)
    return [F.lit(a) + t * (b - a) for a, b in zip(map(float, start), map(float, end))]


def norm3(x: Column, y: Column, z: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(x * x + y * y + z * z)


def half_even(c: Column) -> Column:
    """Rounded to the nearest integer, halves to the even one."""
    return F.rint(c)


def expit(c: Column) -> Column:
    """The logistic function."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def duration_hms(seconds: Column) -> Column:
    """Hours, minutes and seconds as H:MM:SS."""
    s = F.floor(seconds).cast("bigint")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("bigint"), F.pmod(s, F.lit(60)))
