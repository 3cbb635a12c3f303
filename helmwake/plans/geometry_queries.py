"""Queries of the rigid-body, projection, visibility and risk operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from helmwake.operators import se3, sequence, spatial, visibility
from helmwake.plans.base import NUMBERED, POSES, STEPS, Registry, numbered, poses, q6, r6, rounded, sql_apply, sql_mul, sql_rot, sql_wrap, steps
from helmwake.session import table
from helmwake.sources.images import depth_pixels

R = Registry()
W = "OVER (PARTITION BY ep ORDER BY f)"
P6 = ["x", "y", "z", "roll", "pitch", "yaw"]
_cols = lambda p="": [F.col(p + c) for c in P6]
_euler = lambda r: (f"degrees(atan2({r}7, {r}8))", f"degrees(-asin(least(greatest({r}6, -1.0), 1.0)))", f"degrees(atan2({r}3, {r}0))")
_rpy = lambda r: ", ".join(f"{q6(e)} AS r_{n}" for e, n in zip(_euler(r), ("roll", "pitch", "yaw")))
_first = ", ".join(f"first_value({c}) {W} AS f_{c}" for c in P6)
_next = ", ".join(f"lead({c}) {W} AS n_{c}" for c in P6)


def _with(df, fn, prefix):
    for c in P6:
        df = df.withColumn(prefix + c, fn(c))
    return df


def _relative_sql(other: str, extra: str = "") -> str:
    """CTEs of each pose seen from ``other`` (a column prefix): columns q0..q2 and the rotation m."""
    a, b = (other, "") if other == "f_" else ("", other)
    return f"""{NUMBERED}, w AS (SELECT *, {_first if other == 'f_' else _next} FROM np),
r AS (SELECT *, {sql_rot(a + 'yaw', a + 'pitch', a + 'roll', 'a')}, {sql_rot(b + 'yaw', b + 'pitch', b + 'roll', 'b')} FROM w),
m AS (SELECT *, {sql_apply('a', [f'{b}x - {a}x', f'{b}y - {a}y', f'{b}z - {a}z'], ['q0', 'q1', 'q2'], ta=True)}, {sql_mul('a', 'b', 'm', ta=True)} FROM r){extra}"""


@R.query("G01_W01_relative_to_first", f"WITH {_relative_sql('f_')} SELECT ep, f, {q6('q0')} AS r_x, {q6('q1')} AS r_y, {q6('q2')} AS r_z, {_rpy('m')} FROM m")
def g01(spark, d):
    p = _with(numbered(poses(spark, d)), lambda c: sequence.first_frame(c, ["ep"], ["f"]), "f_")
    rel = se3.relative_pose(_cols("f_"), _cols())
    return p.select("ep", "f", *[r6(c).alias(f"r_{n}") for n, c in zip(P6, rel)])


@R.query("G06_W02_next_delta", f"WITH {_relative_sql('n_')} SELECT ep, f, " + ", ".join(f"{q6(f'coalesce({c}, 0.0)')} AS {n}" for c, n in zip(["q0", "q1", "q2", _euler("m")[2]], ["dx", "dy", "dz", "dyaw"])) + " FROM m")
def g06(spark, d):
    w = sequence.over(["ep"], ["f"])
    p = _with(numbered(poses(spark, d)), lambda c: F.lead(c).over(w), "n_")
    delta = se3.compose(se3.inverse(se3.pose6(_cols())), se3.pose6(_cols("n_")))
    return p.select("ep", "f", *[r6(F.coalesce(c, F.lit(0.0))).alias(n) for n, c in zip(["dx", "dy", "dz", "dyaw"], se3.pose4_degrees(delta))])


@R.query("W02u_G02_next_or_self", f"""WITH {STEPS}, n AS (SELECT *, coalesce(lead(x) {W}, x) - x AS dx, coalesce(lead(y) {W}, y) - y AS dy, coalesce(lead(z) {W}, z) - z AS dz, coalesce(lead(yaw) {W}, yaw) - yaw AS dw FROM steps)
SELECT ep, f, {q6('cos(radians(yaw)) * dx + sin(radians(yaw)) * dy')} AS dx, {q6('cos(radians(yaw)) * dy - sin(radians(yaw)) * dx')} AS dy, {q6('dz')} AS dz, {q6('degrees(atan2(sin(radians(dw)), cos(radians(dw)))) + 1.3e-8')} AS dyaw FROM n""")
def w02u(spark, d):
    s = steps(spark, d)
    for c in ("x", "y", "z", "yaw"):
        s = s.withColumn("n_" + c, sequence.next_or_self(c, ["ep"], ["f"]))
    zero = F.lit(0.0)
    a, b = [F.col("x"), F.col("y"), F.col("z"), zero, zero, F.col("yaw")], [F.col("n_x"), F.col("n_y"), F.col("n_z"), zero, zero, F.col("n_yaw")]
    rel = se3.relative_pose_given_axes(a, b, ["x", "y", "z", "yaw"])
    # float32 angles lie exactly between two roundings now and then; the same small shift on both sides decides
    return s.select("ep", "f", *[r6(rel[i]).alias(n) for i, n in zip((0, 1, 2), ("dx", "dy", "dz"))], r6(rel[5] + 1.3e-8).alias("dyaw"))


@R.query("G03_G23_planar_local", f"""WITH {STEPS}, n AS (SELECT *, lead(x) {W} - x AS dx, lead(y) {W} - y AS dy, lead(z) {W} - z AS dz, lead(yaw) {W} - yaw AS dw FROM steps)
SELECT ep, f, {q6('cos(radians(yaw)) * dx + sin(radians(yaw)) * dy')} AS lx, {q6('cos(radians(yaw)) * dy - sin(radians(yaw)) * dx')} AS ly, {q6('dz')} AS lz, {q6(sql_wrap('dw'))} AS lyaw FROM n WHERE dx IS NOT NULL""")
def g03(spark, d):
    w = sequence.over(["ep"], ["f"])
    s = steps(spark, d)
    c = ["x", "y", "z", "yaw"]
    s = s.select("*", *[F.lead(k).over(w).alias("n_" + k) for k in c]).where("n_x IS NOT NULL")
    rel = se3.planar_local([F.col(k) for k in c], [F.col("n_" + k) for k in c])
    return s.select("ep", "f", *[r6(v).alias("l" + k) for k, v in zip(c, rel)])


_LEVEL = f"""{NUMBERED}, c AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'c')} FROM np), e AS (SELECT *, degrees(atan2(c3, c0)) AS ly, degrees(-asin(least(greatest(c6, -1.0), 1.0))) AS lp, degrees(atan2(c7, c8)) AS lr FROM c),
w AS (SELECT *, {', '.join(f'first_value({k}) {W} AS f_{k}' for k in ('x', 'y', 'z', 'ly', 'lp'))} FROM e), r AS (SELECT *, {sql_rot('f_ly', 'f_lp', '90.0', 'a')}, {sql_rot('ly', 'lp', '90.0', 'b')} FROM w),
m AS (SELECT *, {sql_apply('a', ['x - f_x', 'y - f_y', 'z - f_z'], ['q0', 'q1', 'q2'], ta=True)}, {sql_mul('a', 'b', 'm', ta=True)} FROM r)"""


def _levelled(spark, d):
    p = _with(numbered(poses(spark, d)), lambda c: sequence.first_frame(c, ["ep"], ["f"]), "f_")
    state, pitch, roll = se3.levelled_state(se3.pose6(_cols("f_")), se3.pose6(_cols()))
    return p.select("ep", "f", *[c.alias(n) for n, c in zip(("sx", "sy", "sz", "syaw"), state)], pitch.alias("pitch"), roll.alias("roll"))


@R.query("W01_v1_state", f"WITH {_LEVEL} SELECT ep, f, {q6('-q2')} AS sx, {q6('-q0')} AS sy, {q6('q1')} AS sz, {q6('degrees(atan2(m2, m8))')} AS syaw FROM m")
def w01_v1(spark, d):
    return rounded(_levelled(spark, d), ["ep", "f"], ["sx", "sy", "sz", "syaw"])


@R.query("F18_pitch_assert", f"WITH {_LEVEL}, p AS (SELECT ep, degrees(-asin(least(greatest(m5, -1.0), 1.0))) AS pitch, degrees(atan2(m3, m4)) AS roll FROM m) SELECT ep, count(*) AS n_frames, count(*) FILTER (abs(pitch) < 2.0 AND abs(roll) < 2.0) AS n_level, {q6('max(abs(pitch))')} AS worst FROM p GROUP BY ep")
def f18(spark, d):
    """Per episode the frames whose levelled camera has pitch and roll within two degrees; the assertion's own limit would fail every random pose."""
    s = _levelled(spark, d)
    ok = (F.abs("pitch") < 2.0) & (F.abs("roll") < 2.0)
    return s.groupBy("ep").agg(F.count("*").alias("n_frames"), F.count(F.when(ok, 1)).alias("n_level"), r6(F.max(F.abs("pitch"))).alias("worst"))


@R.query("F01_roll_filter", f"WITH {_LEVEL} SELECT ep, {q6('lr + 90')} AS roll0 FROM m WHERE f = 0 AND abs(90.0 - (lr + 90)) <= 5.0")
def f01(spark, d):
    """Episodes whose first camera is level within five degrees; the poses' roll counts from level."""
    p = numbered(poses(spark, d)).where("f = 0").withColumn("roll0", F.degrees(se3.euler_zyx(se3.pose6(_cols()).r)[2]) + 90)
    return p.where(se3.is_level(F.col("roll0"))).select("ep", r6("roll0").alias("roll0"))


@R.query("P07_pose4_pose6", f"WITH {NUMBERED} SELECT ep, f, x, y, z, 0.0::DOUBLE AS roll, 0.0::DOUBLE AS pitch, yaw, yaw AS yaw4 FROM np")
def p07(spark, d):
    p4 = [F.col(c) for c in ("x", "y", "z", "yaw")]
    p6 = se3.pose6_of_pose4(p4)
    return numbered(poses(spark, d)).select("ep", "f", *[c.alias(n) for n, c in zip(se3.AXES, p6)], se3.pose4_of_pose6(p6)[3].alias("yaw4"))


@R.query("P08_homogeneous", f"""WITH {NUMBERED}, r AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'a')} FROM np), m AS (SELECT *, {sql_apply('a', ['px', 'py', 'pz'], ['q0', 'q1', 'q2'])} FROM r)
SELECT ep, f, {q6('q0 + x')} AS p0, {q6('q1 + y')} AS p1, {q6('q2 + z')} AS p2, 1.0::DOUBLE AS p3, {q6('q0')} AS v0, {q6('q1')} AS v1, {q6('q2')} AS v2, 0.0::DOUBLE AS v3 FROM m""")
def p08(spark, d):
    at = [F.col(c) for c in ("px", "py", "pz")]
    pose = se3.pose6(_cols())
    cols = [r6(c).alias(f"{n}{i}") for n, h in (("p", True), ("v", False)) for i, c in enumerate(se3.apply_homogeneous(pose, se3.to_homogeneous(at, h)))]
    return numbered(poses(spark, d)).select("ep", "f", *cols)


_M9 = " + ".join(f"{i + 1} * a{i}" for i in range(9))


@R.query("P04_matrix_layout", f"WITH {NUMBERED}, r AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'a')} FROM np) SELECT ep, f, {q6(_M9)} AS content, 9 AS n FROM r")
def p04(spark, d):
    """Rotations delivered as nested matrices, read flat."""
    r = se3.pose6(_cols()).r
    nested = F.array(*[F.array(*r[3 * i : 3 * i + 3]) for i in range(3)])
    t = numbered(poses(spark, d)).select("ep", "f", se3.flat_matrix(nested, nested=True).alias("m"))
    return t.select("ep", "f", r6(sum(((i + 1) * F.col("m")[i] for i in range(1, 9)), F.col("m")[0])).alias("content"), F.size("m").alias("n"))


@R.query("G27_spiral", f"""WITH t AS (SELECT i AS id, i / 999.0 AS t FROM range(1000) r(i)) SELECT id, {q6('5 * cos(t * 4 * pi())')} AS x, {q6('5 * sin(t * 4 * pi())')} AS y, {q6('10 * t')} AS z, {q6(sql_wrap('degrees(t * 4 * pi()) + 90 + 1e-9'))} AS yaw FROM t""")
def g27(spark, d):
    """A generator: poses up a spiral."""
    s = se3.spiral_poses(spark, 1000)
    return s.select("id", *[r6(c).alias(c) for c in "xyz"], r6(se3.wrap_degrees(F.col("yaw") + 1e-9)).alias("yaw"))


@R.query("G30_path_colour", f"WITH {NUMBERED}, n AS (SELECT ep, f, f / CAST(max(f) OVER (PARTITION BY ep) AS DOUBLE) AS t FROM np) SELECT ep, f, {q6('t')} AS red, 0.0::DOUBLE AS green, {q6('1 - t')} AS blue FROM n WHERE NOT isnan(t)")
def g30(spark, d):
    p = numbered(poses(spark, d)).withColumn("last", F.max("f").over(Window.partitionBy("ep"))).where("last > 0")
    return p.select("ep", "f", *[r6(c).alias(n) for n, c in zip(("red", "green", "blue"), se3.path_colour(F.col("f") / F.col("last")))])


@R.query("G04_body_to_world", f"""WITH {NUMBERED}, w AS (SELECT *, {_first} FROM np), r AS (SELECT *, {sql_rot('f_yaw', 'f_pitch', 'f_roll', 'a')}, {sql_rot('yaw', 'pitch', 'roll', 'b')} FROM w),
m AS (SELECT *, {sql_apply('a', ['x', 'y', 'z'], ['q0', 'q1', 'q2'])}, {sql_mul('a', 'b', 'm')} FROM r)
SELECT ep, f, {q6('q0 + f_x')} AS r_x, {q6('q1 + f_y')} AS r_y, {q6('q2 + f_z')} AS r_z, {_rpy('m')} FROM m""")
def g04(spark, d):
    p = _with(numbered(poses(spark, d)), lambda c: sequence.first_frame(c, ["ep"], ["f"]), "f_")
    return p.select("ep", "f", *[r6(c).alias(f"r_{n}") for n, c in zip(P6, se3.body_to_world(_cols("f_"), _cols()))])


@R.query("G24_planar_global", f"""WITH {STEPS} SELECT ep, f, {q6('x + cos(radians(yaw)) * 2.0 - sin(radians(yaw)) * 0.5')} AS gx, {q6('y + sin(radians(yaw)) * 2.0 + cos(radians(yaw)) * 0.5')} AS gy, {q6('z + 0.25')} AS gz, {q6(sql_wrap('yaw + 30.0'))} AS gyaw FROM steps""")
def g24(spark, d):
    g = se3.planar_global([F.col(c) for c in ("x", "y", "z", "yaw")], [F.lit(2.0), F.lit(0.5), F.lit(0.25), F.lit(30.0)])
    return steps(spark, d).select("ep", "f", *[r6(c).alias(n) for n, c in zip(("gx", "gy", "gz", "gyaw"), g)])


@R.query("G05_G07_inverse", f"""WITH {NUMBERED}, r AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'a')} FROM np), m AS (SELECT *, {sql_apply('a', ['x', 'y', 'z'], ['q0', 'q1', 'q2'], ta=True)} FROM r)
SELECT ep, f, {q6('-q0')} AS ix, {q6('-q1')} AS iy, {q6('-q2')} AS iz, {q6('degrees(atan2(a1, a0))')} AS iyaw FROM m""")
def g05(spark, d):
    inv = se3.from_flat(se3.to_flat(se3.inverse(se3.pose6(_cols()))))
    return numbered(poses(spark, d)).select("ep", "f", *[r6(c).alias(n) for n, c in zip(("ix", "iy", "iz", "iyaw"), se3.pose4_degrees(inv))])


@R.query("G08_euler", f"""WITH {NUMBERED}, r AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'a')} FROM np)
SELECT ep, f, {_rpy('a')}, {q6('degrees(atan2(a2, a8))')} AS yxz_yaw, {q6('degrees(-asin(least(greatest(a5, -1.0), 1.0)))')} AS yxz_pitch, {q6('degrees(atan2(a3, a4))')} AS yxz_roll FROM r""")
def g08(spark, d):
    r = se3.pose6(_cols()).r
    yaw, pitch, roll = se3.euler_zyx(r)
    y2, p2, r2 = se3.euler_yxz(r)
    vals = {"r_roll": roll, "r_pitch": pitch, "r_yaw": yaw, "yxz_yaw": y2, "yxz_pitch": p2, "yxz_roll": r2}
    return numbered(poses(spark, d)).select("ep", "f", *[r6(F.degrees(c)).alias(n) for n, c in vals.items()])


@R.query("G09_G10_body_frame", f"""WITH {NUMBERED}, r AS (SELECT *, {sql_rot('yaw', 'pitch', '90.0', 'l')}, {sql_rot('yaw', 'pitch', 'roll', 'c')} FROM np WHERE f = 0 AND abs(pitch) < 89),
b AS (SELECT *, -l2 AS b0, -l0 AS b1, l1 AS b2, -l5 AS b3, -l3 AS b4, l4 AS b5, -l8 AS b6, -l6 AS b7, l7 AS b8 FROM r), m AS (SELECT *, {sql_mul('b', 'c', 'm', ta=True)} FROM b)
SELECT ep, {', '.join(q6(f'm{i}') + f' AS m{i}' for i in range(9))} FROM m""")
def g10(spark, d):
    p = numbered(poses(spark, d)).where("f = 0 AND abs(pitch) < 89")
    m = se3.camera_in_body(se3.pose6(_cols())).r
    return p.select("ep", *[r6(c).alias(f"m{i}") for i, c in enumerate(m)])


# a camera that looks along -z of the pose, at the points of the later frames
_FX, _W, _H = 200.0, 480, 270


@R.query("G11_F09_F11_pinhole", f"""WITH {POSES}, c AS (SELECT ep, f, px, py, pz - 20.0 AS zz FROM poses), u AS (SELECT *, -zz AS dd, CASE WHEN -zz > 0 THEN px * {_FX} / -zz + {_W / 2} END AS u, CASE WHEN -zz > 0 THEN {_H - 1} - (py * {_FX} / -zz + {_H / 2}) END AS v FROM c)
SELECT ep, f, {q6('u')} AS u, {q6('v')} AS v, {q6('dd')} AS depth, coalesce(dd > 0 AND u >= 0 AND u < {_W} AND v >= 0 AND v < {_H}, false) AS inside, coalesce(u < 20 OR u > {_W - 20} OR v < 20 OR v > {_H - 20}, true) AS at_edge, CAST(round_even(u, 0) AS BIGINT) AS col FROM u""")
def g11(spark, d):
    w, h = F.lit(_W), F.lit(_H)
    u, v, dd = se3.pinhole(F.col("px"), F.col("py"), F.col("pz") - 20.0, F.lit(_FX), F.lit(_FX), w / 2, h / 2, h)
    p = poses(spark, d).select("ep", "f", u.alias("u"), v.alias("v"), dd.alias("depth"))
    stop = visibility.blocked(F.col("u"), F.col("v"), F.col("depth"), F.lit(None).cast("double"), w, h)
    edge = F.coalesce(visibility.near_edge(F.col("u"), F.col("v"), w, h), F.lit(True))
    return p.select("ep", "f", r6("u").alias("u"), r6("v").alias("v"), r6("depth").alias("depth"), (~stop).alias("inside"), edge.alias("at_edge"), se3.half_even(F.col("u")).cast("bigint").alias("col"))


@R.query("G12_F14_frustum", f"""WITH {POSES}, c AS (SELECT ep, f, px + 5.0 AS xx, py, pz FROM poses), u AS (SELECT *, CAST(trunc({_FX} * -py / xx + 240.0) AS INTEGER) AS u, CAST(trunc({_FX} * -pz / xx + 135.0) AS INTEGER) AS v FROM c WHERE xx > 0.1) SELECT ep, f, u, v FROM u WHERE u BETWEEN 0 AND 479 AND v BETWEEN 0 AND 269""")
def g12(spark, d):
    u, v = se3.flu_pixel(F.col("px") + 5.0, F.col("py"), F.col("pz"), F.lit(_FX), F.lit(_FX), F.lit(240.0), F.lit(135.0))
    return poses(spark, d).where("px + 5.0 > 0.1").select("ep", "f", u.alias("u"), v.alias("v")).where("u BETWEEN 0 AND 479 AND v BETWEEN 0 AND 269")


@R.query("G13_G14_intrinsics", """SELECT scene, round(width / (2 * tan(radians(84.0) / 2)), 6) AS fx, width / 2.0 AS cx, height / 2.0 AS cy, round(height / (2 * tan(radians(60.0) / 2)), 6) AS fy, round(width / (2 * tan(radians(90.0) / 2)), 6) AS f_h, (width - 1) / 2.0 AS cx_pixel FROM scenes""")
def g13(spark, d):
    from helmwake.session import table

    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    fx, fy, cx, cy = se3.intrinsics_fov(w, h, F.lit(84.0), F.lit(60.0))
    f_h, _, cp, _ = se3.intrinsics_hfov(w, h, F.lit(90.0))
    return table(spark, d, "scenes").select("scene", F.round(fx, 6).alias("fx"), cx.alias("cx"), cy.alias("cy"), F.round(fy, 6).alias("fy"), F.round(f_h, 6).alias("f_h"), cp.alias("cx_pixel"))


@R.query("G15_F13_back_project", f"""WITH {POSES}, k AS (SELECT ep, f, abs(px) * 10 AS u, abs(py) * 10 AS v, abs(pz) AS dd FROM poses) SELECT ep, f, {q6('(u - 240.0) * dd / 200.0')} AS bx, {q6('(v - 135.0) * dd / 200.0')} AS b_y, {q6('dd')} AS bz FROM k WHERE dd > 0 AND dd <= 4.0""")
def g15(spark, d):
    p = poses(spark, d).select("ep", "f", (F.abs("px") * 10).alias("u"), (F.abs("py") * 10).alias("v"), F.abs("pz").alias("dd")).where("dd > 0 AND dd <= 4.0")
    b = se3.back_project(F.col("u"), F.col("v"), F.col("dd"), F.lit(200.0), F.lit(200.0), F.lit(240.0), F.lit(135.0))
    return p.select("ep", "f", *[r6(c).alias(n) for n, c in zip(("bx", "b_y", "bz"), b)])


@R.query("G16_G17_G18_risks", f"""WITH {POSES}, k AS (SELECT ep, f, abs(px) AS dd FROM poses) SELECT ep, f, {q6('1 / (1 + exp(-((0.5 - dd) / 0.2)))')} AS logistic, {q6('1 / (1 + exp((dd - 0.5) * 8.0 - ln(3.0)))')} AS biased, {q6('CASE WHEN dd <= 0.01 THEN 1.0 WHEN dd >= 1.2 THEN 0.0 ELSE (1.2 - dd) / 1.19 END')} AS linear FROM k""")
def g16(spark, d):
    dd = F.abs("px")
    return poses(spark, d).select("ep", "f", r6(spatial.risk_logistic(dd)).alias("logistic"), r6(spatial.risk_biased(dd)).alias("biased"), r6(spatial.risk_linear(dd)).alias("linear"))


@R.query("G25_G26_G29_magnitudes", f"""WITH {NUMBERED}, w AS (SELECT *, {_first} FROM np), r AS (SELECT *, {sql_rot('f_yaw', 'f_pitch', 'f_roll', 'a')}, {sql_rot('yaw', 'pitch', 'roll', 'b')} FROM w), m AS (SELECT *, {sql_mul('a', 'b', 'm', ta=True)} FROM r)
SELECT ep, f, {q6('degrees(atan2(sqrt((m7-m5)**2 + (m2-m6)**2 + (m3-m1)**2), m0 + m4 + m8 - 1))')} AS angle, {q6('sqrt((x-f_x)**2 + (y-f_y)**2 + (z-f_z)**2)')} AS dist FROM m WHERE f > 0""")
def g26(spark, d):
    p = _with(numbered(poses(spark, d)), lambda c: sequence.first_frame(c, ["ep"], ["f"]), "f_").where("f > 0")
    ang = se3.angular_distance(se3.pose6(_cols("f_")).r, se3.pose6(_cols()).r)
    dist = se3.norm3(F.col("x") - F.col("f_x"), F.col("y") - F.col("f_y"), F.col("z") - F.col("f_z"))
    return p.select("ep", "f", r6(F.degrees(ang)).alias("angle"), r6(dist).alias("dist"))


@R.query("G31_duration", "SELECT episode_index, length, CAST(length * 37 // 3600 AS VARCHAR) || ':' || lpad(CAST(length * 37 % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(length * 37 % 60 AS VARCHAR), 2, '0') AS hms FROM (SELECT DISTINCT episode_index, length FROM episodes WHERE length IS NOT NULL)")
def g31(spark, d):
    from helmwake.session import table

    e = table(spark, d, "episodes").where("length IS NOT NULL").select("episode_index", "length").distinct()
    return e.select("episode_index", "length", se3.duration_hms(F.col("length") * 37).alias("hms"))


_CLOUD = f"{NUMBERED}, cloud AS (SELECT ep, f AS pid, px AS cx, py AS cy, pz AS cz FROM np)"
_STEP0 = "sqrt((x - lag(x) {W})**2 + (y - lag(y) {W})**2 + (z - lag(z) {W})**2)".replace("{W}", W)
_STEP1 = _STEP0.replace("lag(", "lead(")
_GHOST = f"{_CLOUD}, sp AS (SELECT *, coalesce({_STEP0}, {_STEP1}, 0.0) / 0.1 AS v, row_number() {W} - 1 AS i, count(*) OVER (PARTITION BY ep) AS n FROM np)"
_DIST = "sqrt(({x} - cx)**2 + ({y} - cy)**2 + ({z} - cz)**2)".format


def _cloud(p):
    return p.select("ep", F.col("f").alias("pid"), F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"))


@R.query("G20_G19_A08_collision", f"""WITH {_GHOST}, g AS (SELECT ep, f, x + v * s * 0.1 * cos(radians(yaw)) AS gx, y + v * s * 0.1 * sin(radians(yaw)) AS gy, z AS gz FROM sp, (SELECT unnest(range(1, 36)) AS s)),
m AS (SELECT g.ep, g.f, min({_DIST(x='gx', y='gy', z='gz')}) AS m FROM g JOIN cloud c ON c.ep = g.ep GROUP BY g.ep, g.f) SELECT ep, f, {q6('CASE WHEN m <= 0.01 THEN 1.0 WHEN m >= 1.2 THEN 0.0 ELSE (1.2 - m) / 1.19 END')} AS prob FROM m""")
def g20(spark, d):
    p = numbered(poses(spark, d))
    c = spatial.collision_probability(p, _cloud(p), "ep", ["ep"], "f")
    return c.select("ep", "f", r6("prob").alias("prob"))


_RATE = f"""d0 AS (SELECT *, yaw - lag(yaw) {W} AS raw FROM sp), d1 AS (SELECT *, {sql_wrap('raw')} AS dd FROM d0), d2 AS (SELECT *, lead(dd) {W} AS nn FROM d1),
rt AS (SELECT *, CASE WHEN dd IS NOT NULL AND nn IS NOT NULL THEN abs(dd + nn) / 0.2 ELSE abs(coalesce(dd, nn, 0.0)) / 0.1 END AS rate FROM d2),
sm AS (SELECT *, sum(rate) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 AS w FROM rt),
near AS (SELECT a.ep, a.f, least(min({_DIST(x='x', y='y', z='z')}), 5.0) AS dist FROM np a JOIN cloud c ON c.ep = a.ep GROUP BY a.ep, a.f),
re AS (SELECT sm.*, min(dist) OVER (PARTITION BY sm.ep ORDER BY sm.f ROWS BETWEEN CURRENT ROW AND 39 FOLLOWING) AS m FROM sm JOIN near ON near.ep = sm.ep AND near.f = sm.f)"""


@R.query("G21_W07_UD7_avoidance_turning", f"""WITH {_GHOST}, {_RATE}, g AS (SELECT ep, f, x + v * s * 0.1 * cos(radians(yaw)) AS gx, y + v * s * 0.1 * sin(radians(yaw)) AS gy, z AS gz FROM sp, (SELECT unnest(range(1, 41)) AS s) WHERE s <= n - i AND v > 0.1),
gm AS (SELECT g.ep, g.f, least(min({_DIST(x='gx', y='gy', z='gz')}), 5.0) AS gd FROM g JOIN cloud c ON c.ep = g.ep GROUP BY g.ep, g.f),
k AS (SELECT re.*, 1 / (1 + exp(-((0.5 - m) / 0.2))) AS rr, CASE WHEN gd IS NULL THEN 1 / (1 + exp(-((0.5 - m) / 0.2))) ELSE 1 / (1 + exp(-((0.5 - gd) / 0.2))) END AS rg FROM re LEFT JOIN gm ON gm.ep = re.ep AND gm.f = re.f)
SELECT ep, f, {q6('greatest(0.0, rg - rr) / (1 + exp(-((w - 15.0) / 5.0)))')} AS score FROM k""")
def g21(spark, d):
    p = numbered(poses(spark, d))
    return spatial.avoidance(p, _cloud(p), "ep", ["ep"], "f", "turning").select("ep", "f", r6("score").alias("score"))


@R.query("G22_J13_A09_UD7_avoidance_velocity", f"""WITH {_GHOST}, {_RATE}, ve AS (SELECT ep, f, x, y, z, {', '.join(f'coalesce(lead({c}) {W} - {c}, {c} - lag({c}) {W}, 0.0) AS d{c}' for c in 'xyz')}, row_number() {W} - 1 + 40 < count(*) OVER (PARTITION BY ep) AS ok FROM np),
g AS (SELECT ep, f, x + dx * s AS gx, y + dy * s AS gy, z + dz * s AS gz FROM ve, (SELECT unnest(range(1, 41)) AS s) WHERE ok),
gm AS (SELECT g.ep, g.f, least(min({_DIST(x='gx', y='gy', z='gz')}), 5.0) AS gd FROM g JOIN cloud c ON c.ep = g.ep GROUP BY g.ep, g.f),
k AS (SELECT re.ep, re.f, ok, radians(w) AS w, 1 / (1 + exp((m - 0.5) * 8.0 - ln(3.0))) AS rr, 1 / (1 + exp((gd - 0.5) * 8.0 - ln(3.0))) AS rg FROM re JOIN ve ON ve.ep = re.ep AND ve.f = re.f LEFT JOIN gm ON gm.ep = re.ep AND gm.f = re.f)
SELECT ep, f, {q6('CASE WHEN ok THEN greatest(0.0, rg - rr) / (1 + exp(-(10.0 * (w - 0.2)))) ELSE 0.0 END')} AS score FROM k""")
def g22(spark, d):
    p = numbered(poses(spark, d))
    return spatial.avoidance(p, _cloud(p), "ep", ["ep"], "f", "velocity").select("ep", "f", r6("score").alias("score"))


_PROB = f"""g AS (SELECT ep, f, x + v * s * 0.1 * cos(radians(yaw)) AS gx, y + v * s * 0.1 * sin(radians(yaw)) AS gy, z AS gz FROM sp, (SELECT unnest(range(1, 36)) AS s)),
pm AS (SELECT g.ep, g.f, min({_DIST(x='gx', y='gy', z='gz')}) AS m FROM g JOIN cloud c ON c.ep = g.ep GROUP BY g.ep, g.f), pr AS (SELECT ep, f, CASE WHEN m <= 0.01 THEN 1.0 WHEN m >= 1.2 THEN 0.0 ELSE (1.2 - m) / 1.19 END AS prob FROM pm)"""


@R.query("F12_high_risk_mask", f"""WITH {_GHOST}, {_RATE}, {_PROB}, b AS (SELECT ep, f, sum(rate) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 AS s FROM rt)
SELECT b.ep, b.f, {q6('CASE WHEN prob > 0.8 THEN s ELSE 0.0 END')} AS gated, prob > 0.8 AS high FROM b JOIN pr ON pr.ep = b.ep AND pr.f = b.f""")
def f12(spark, d):
    """The smoothed yaw rate where the risk of a collision ahead exceeds 0.8, else 0."""
    p = numbered(poses(spark, d))
    prob = spatial.collision_probability(p, _cloud(p), "ep", ["ep"], "f")
    rate = sequence.with_yaw_rate(p, ["ep"], ["f"], "yaw", 0.1).withColumn("s", sequence.box_smooth("yaw_rate", ["ep"], ["f"], 10)).select("ep", "f", "s")
    high = F.col("prob") > 0.8
    return rate.join(prob, ["ep", "f"]).select("ep", "f", r6(F.when(high, F.col("s")).otherwise(F.lit(0.0))).alias("gated"), high.alias("high"))


@R.query("J07_O08_knn", f"""WITH {_CLOUD}, k AS (SELECT np.ep, np.f, pid, {_DIST(x='x', y='y', z='z')} AS dist FROM np JOIN cloud c ON c.ep = np.ep), r AS (SELECT *, row_number() OVER (PARTITION BY ep, f ORDER BY dist, pid) AS rank FROM k)
SELECT ep, f, pid, {q6('dist')} AS dist, rank FROM r WHERE rank <= 3""")
def j07(spark, d):
    p = numbered(poses(spark, d))
    k = spatial.knn(p, _cloud(p), "ep", ["f"], "pid", 3, 1.0)
    return k.select("ep", "f", "pid", r6("dist").alias("dist"), "rank")


_LO = ", ".join(f"min(p{c}) OVER (PARTITION BY ep) AS l{c}" for c in "xyz")


@R.query("A15_F15_A18_voxel", f"""WITH {POSES}, o AS (SELECT *, {_LO} FROM poses WHERE pz > -4), v AS (SELECT ep, px, py, pz, {', '.join(f'CAST(floor((p{c} - (l{c} - 1.0)) / 2.0) AS BIGINT) AS v{c}' for c in 'xyz')} FROM o)
SELECT ep, vx, vy, vz, {', '.join(q6(f'avg(p{c})') + f' AS {c}' for c in 'xyz')}, count(*) AS n_points FROM v GROUP BY ep, vx, vy, vz""")
def a15(spark, d):
    c = _cloud(poses(spark, d)).where("z > -4")
    halves = c.where("pid % 2 = 0").unionByName(c.where("pid % 2 <> 0"))
    v = spatial.voxel_downsample(halves, ["ep"], 2.0)
    return v.select("ep", "vx", "vy", "vz", *[r6(k).alias(k) for k in "xyz"], "n_points")


# visibility: each frame looks at later frames of its episode through a camera at its pose; the depth is a function of the pixel
_DEPTH = "2.0 + abs(sin(radians(u + 2 * v))) * 12.0"


@R.query("J05_F10_W10_W11_farthest", f"""WITH {NUMBERED}, e AS (SELECT *, max(f) OVER (PARTITION BY ep) AS stop_at FROM np), r AS (SELECT *, {sql_rot('yaw', 'pitch', 'roll', 'a')} FROM e),
pr AS (SELECT r.*, t.f AS j, t.x - r.x AS tx, t.y - r.y AS ty, t.z - r.z AS tz FROM r JOIN np t ON t.ep = r.ep AND t.f > r.f AND t.f <= r.stop_at),
q AS (SELECT ep, f, j, stop_at, {sql_apply('a', ['tx', 'ty', 'tz'], ['q0', 'q1', 'q2'], ta=True)} FROM pr),
uv AS (SELECT *, -q2 AS dd, CASE WHEN -q2 > 0 THEN q0 * {_FX} / -q2 + {_W / 2} END AS u, CASE WHEN -q2 > 0 THEN {_H - 1} - (q1 * {_FX} / -q2 + {_H / 2}) END AS v FROM q),
fl AS (SELECT *, coalesce(dd <= 0 OR u < 0 OR u >= {_W} OR v < 0 OR v >= {_H}, true) OR coalesce({_DEPTH} <= dd, false) AS stop, coalesce(u < 20 OR u > {_W - 20} OR v < 20 OR v > {_H - 20}, true) AS edge FROM uv),
s AS (SELECT ep, f, stop_at, min(CASE WHEN stop THEN j END) AS fs FROM fl GROUP BY ep, f, stop_at),
vis AS (SELECT ep, f, CASE WHEN fs IS NULL THEN stop_at ELSE greatest(f + 1, fs - 1) END AS upto FROM s)
SELECT vis.ep, vis.f, coalesce(max(CASE WHEN NOT edge AND j <= upto THEN j END), vis.f + 1) AS farthest FROM vis JOIN fl ON fl.ep = vis.ep AND fl.f = vis.f GROUP BY vis.ep, vis.f
UNION ALL SELECT ep, f, f FROM e WHERE f = stop_at""")
def j05(spark, d):
    # embeddings have no sub-task intervals, so the search ends at the episode's last frame
    p = numbered(poses(spark, d)).withColumn("stop_at", F.max("f").over(Window.partitionBy("ep")))
    pr = visibility.candidate_pairs(p, ["ep"], "f", "stop_at", P6)
    cam = se3.pose6(_cols())
    q = se3.apply(se3.transpose(cam.r), [F.col("t_x") - F.col("x"), F.col("t_y") - F.col("y"), F.col("t_z") - F.col("z")])
    w, h = F.lit(_W), F.lit(_H)
    u, v, dd = se3.pinhole(*q, F.lit(_FX), F.lit(_FX), w / 2, h / 2, h)
    pr = pr.select("ep", "f", "t_frame", "stop_at", u.alias("u"), v.alias("v"), dd.alias("d"))
    depth = F.expr(_DEPTH)
    pr = pr.withColumn("stop", visibility.blocked(F.col("u"), F.col("v"), F.col("d"), depth, w, h)).withColumn("edge", F.coalesce(visibility.near_edge(F.col("u"), F.col("v"), w, h), F.lit(True)))
    seen = visibility.farthest(pr, ["ep"], "f", "stop_at", "stop", "edge").select("ep", "f", "farthest")
    # nothing lies beyond the search end: such a frame is its own answer
    return seen.unionByName(p.where("f >= stop_at").select("ep", "f", F.col("f").alias("farthest")))


@R.query("W09_min_filter")
def w09(spark, d):
    """Every pixel of the complete depth images, with the least depth around it in metres."""
    # one exchange by image serves the windows over rows and over columns
    px = depth_pixels(table(spark, d, "image_files"), "observation.images.depth").repartition("file_id")
    return visibility.min_filter(px, ["file_id"]).select("file_id", "u", "v", r6("min_depth").alias("min_depth"))
