"""Queries of the ordered-sequence operators on the frames of episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helmwake.operators import sequence as sq
from helmwake.operators import stats
from helmwake.plans.base import POSES, STEPS, Registry, poses, q6, r6, rounded, sql_wrap, steps
from helmwake.session import table

R = Registry()
BY, ON = ["ep"], ["f"]
W = "OVER (PARTITION BY ep ORDER BY f)"

_RATE = f"""{STEPS},
d0 AS (SELECT *, yaw - lag(yaw) {W} AS raw FROM steps),
d1 AS (SELECT *, CASE WHEN {sql_wrap('raw')} = -180 AND raw > 0 THEN 180.0 ELSE {sql_wrap('raw')} END AS d FROM d0),
d2 AS (SELECT *, lead(d) {W} AS n FROM d1),
rate AS (SELECT *, CASE WHEN d IS NOT NULL AND n IS NOT NULL THEN abs(d + n) / 0.2 ELSE abs(coalesce(d, n, 0.0)) / 0.1 END AS yaw_rate FROM d2),
smooth AS (SELECT *, sum(yaw_rate) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 AS s FROM rate)"""


def _smooth(spark: SparkSession, d: str) -> DataFrame:
    r = sq.with_yaw_rate(steps(spark, d), BY, ON, "yaw", 0.1)
    return r.withColumn("s", sq.box_smooth("yaw_rate", BY, ON, 10))


@R.query("W03_yaw_rate", f"WITH {_RATE} SELECT ep, f, {q6('yaw_rate')} AS yaw_rate FROM rate")
def w03(spark, d):
    return rounded(sq.with_yaw_rate(steps(spark, d), BY, ON, "yaw", 0.1), ["ep", "f"], ["yaw_rate"])


@R.query("W04_box_smooth", f"WITH {_RATE} SELECT ep, f, {q6('s')} AS smoothed FROM smooth")
def w04(spark, d):
    return _smooth(spark, d).select("ep", "f", r6("s").alias("smoothed"))


@R.query(
    "A11_turn_report",
    f"""WITH {_RATE}, high AS (SELECT robot, s AS v FROM smooth WHERE s > 0),
q AS (SELECT robot, avg(v) AS mean, max(v) AS max, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.9) AS threshold FROM high GROUP BY robot),
top AS (SELECT robot, avg(v) AS top_mean, count(*) AS n_top FROM high JOIN q USING (robot) WHERE v >= threshold GROUP BY robot)
SELECT robot, {q6('mean')} AS mean, {q6('max')} AS max, {q6('median')} AS median, {q6('threshold')} AS threshold, {q6('top_mean')} AS top_mean, n_top FROM q JOIN top USING (robot)""",
)
def a11(spark, d):
    v = _smooth(spark, d).where("s > 0").select("robot", F.col("s").alias("v"))
    r = stats.top_block_report(v, ["robot"], "v", 0.1)
    return rounded(r, ["robot"], ["mean", "max", "median", "threshold", "top_mean"]).join(r.select("robot", "n_top"), "robot")


_SPEED = f"""{STEPS}, sp AS (SELECT *, coalesce(sqrt((x - lag(x) {W})**2 + (y - lag(y) {W})**2 + (z - lag(z) {W})**2), sqrt((x - lead(x) {W})**2 + (y - lead(y) {W})**2 + (z - lead(z) {W})**2), 0.0) / 0.1 AS speed FROM steps)"""


@R.query("W05_speed", f"WITH {_SPEED} SELECT ep, f, {q6('speed')} AS speed FROM sp")
def w05(spark, d):
    return rounded(steps(spark, d).withColumn("speed", sq.speed("x", "y", "z", BY, ON, 0.1)), ["ep", "f"], ["speed"])


@R.query(
    "W06_velocity",
    f"""WITH {STEPS} SELECT ep, f, {", ".join(q6(f'coalesce((lead({c}) {W} - {c}) / 0.1, ({c} - lag({c}) {W}) / 0.1, 0.0)') + f' AS v_{c}' for c in 'xyz')} FROM steps""",
)
def w06(spark, d):
    return rounded(sq.with_velocity(steps(spark, d), ["x", "y", "z"], BY, ON, 0.1), ["ep", "f"], ["v_x", "v_y", "v_z"])


@R.query("W07_lookahead_min", f"WITH {STEPS} SELECT ep, f, {q6('min(z) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN CURRENT ROW AND 39 FOLLOWING)')} AS least FROM steps")
def w07(spark, d):
    return steps(spark, d).select("ep", "f", r6(sq.lookahead_min("z", BY, ON, 40)).alias("least"))


_FWD = "x > lag(x, 1, x) OVER (PARTITION BY ep ORDER BY f)"
_NEXT = f"""{STEPS}, mv AS (SELECT *, {_FWD} AS fwd FROM steps), nx AS (SELECT *, min(CASE WHEN fwd THEN f END) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nf, max(f) OVER (PARTITION BY ep) AS lf FROM mv)"""


def _next(spark, d):
    s = steps(spark, d).withColumn("fwd", F.col("x") > F.lag("x", 1).over(sq.over(BY, ON))).withColumn("fwd", F.coalesce("fwd", F.lit(False)))
    s = s.withColumn("nf", sq.next_match(F.col("fwd"), F.col("f"), BY, ON))
    return s.withColumn("lf", F.max("f").over(Window.partitionBy(*BY)))


@R.query("W08_next_forward", f"WITH {_NEXT} SELECT ep, f, coalesce(nf, lf) AS goal FROM nx")
def w08(spark, d):
    return _next(spark, d).select("ep", "f", F.coalesce("nf", "lf").alias("goal"))


@R.query(
    "J09_goal_join",
    f"""WITH {_NEXT}, g AS (SELECT ep, f, coalesce(nf, lf) AS goal FROM nx)
SELECT g.ep, g.f, g.goal, {q6('s.x')} AS goal_x, {q6('s.yaw')} AS goal_yaw FROM g JOIN steps s ON s.ep = g.ep AND s.f = g.goal""",
)
def j09(spark, d):
    g = _next(spark, d).select("ep", "f", F.coalesce("nf", "lf").alias("goal"))
    s = steps(spark, d).select(F.col("ep").alias("e2"), F.col("f").alias("f2"), "x", "yaw")
    return g.join(s, (F.col("ep") == F.col("e2")) & (F.col("goal") == F.col("f2"))).select("ep", "f", "goal", r6("x").alias("goal_x"), r6("yaw").alias("goal_yaw"))


@R.query(
    "W13_goal_priority",
    f"""WITH {STEPS} SELECT ep, f, CAST(coalesce(nullif(CASE WHEN f % 3 = 0 THEN f % 7 ELSE -1 END, -1), nullif(CASE WHEN f % 5 = 0 THEN f % 11 ELSE -1 END, -1), -1) AS BIGINT) AS rel FROM steps""",
)
def w13(spark, d):
    k = [F.when(F.col("f") % 3 == 0, F.col("f") % 7).otherwise(F.lit(-1)), F.when(F.col("f") % 5 == 0, F.col("f") % 11).otherwise(F.lit(-1))]
    return steps(spark, d).select("ep", "f", sq.first_of(k).cast("bigint").alias("rel"))


@R.query(
    "W12_F17_frame_gaps",
    f"""WITH {STEPS}, g AS (SELECT *, ts - lag(ts) {W} AS gap FROM steps)
SELECT ep, count(*) AS n_frames, CAST(sum(CASE WHEN gap - 0.1 > 0.1 + 1e-9 THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps, {q6('max(gap)')} AS longest FROM g GROUP BY ep""",
)
def w12(spark, d):
    g = sq.with_gap(steps(spark, d), BY, ON, "ts", 10.0, 0.1 + 1e-9)
    return g.groupBy("ep").agg(F.count("*").alias("n_frames"), F.sum(F.col("is_gap").cast("bigint")).alias("n_gaps"), r6(F.max("gap_s")).alias("longest"))


@R.query(
    "W14_A06_quota_split",
    """WITH n AS (SELECT DISTINCT episode_index, length FROM episodes), r AS (SELECT *, row_number() OVER (ORDER BY episode_index, length) AS k FROM n),
s AS (SELECT *, CASE WHEN k <= 10 THEN 'eval' ELSE 'train' END AS split FROM r WHERE k <= 110)
SELECT split, count(*) AS trajectories, CAST(sum(length) AS BIGINT) AS frames, round(sum(length) / 5.0, 6) AS seconds FROM s GROUP BY split""",
)
def w14(spark, d):
    e = table(spark, d, "episodes").select("episode_index", "length").distinct()
    s = sq.quota_split(e, ["episode_index", "length"], [("eval", 10), ("train", 100)])
    return s.groupBy("split").agg(F.count("*").alias("trajectories"), F.sum("length").alias("frames"), F.round(F.sum("length") / 5.0, 6).alias("seconds"))


@R.query(
    "W15_fold_path",
    f"""WITH RECURSIVE {STEPS}, ac AS (SELECT DISTINCT episode_index AS ep, frame_index AS f, CAST("action"[1] AS DOUBLE) AS a, CAST("action"[2] AS DOUBLE) AS b, CAST("action"[3] AS DOUBLE) AS c, CAST("action"[4] AS DOUBLE) AS h FROM frames
  WHERE len("action") >= 4 AND episode_index IS NOT NULL AND frame_index IS NOT NULL),
ok AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY f) AS k FROM ac WHERE NOT (isnan(a) OR isnan(b) OR isnan(c) OR isnan(h))),
run AS (SELECT ep, k, a AS x, b AS y, c AS z, {sql_wrap('h')} AS yaw FROM ok WHERE k = 1
  UNION ALL SELECT o.ep, o.k, r.x + cos(radians(r.yaw)) * o.a - sin(radians(r.yaw)) * o.b, r.y + sin(radians(r.yaw)) * o.a + cos(radians(r.yaw)) * o.b, r.z + o.c, {sql_wrap('r.yaw + o.h')} FROM run r JOIN ok o ON o.ep = r.ep AND o.k = r.k + 1)
SELECT ep, k AS n_steps, {q6('x')} AS x, {q6('y')} AS y, {q6('z')} AS z, {q6('yaw')} AS yaw FROM (SELECT *, max(k) OVER (PARTITION BY ep) AS mk FROM run) WHERE k = mk""",
)
def w15(spark, d):
    a = table(spark, d, "frames").where("size(action) >= 4 AND episode_index IS NOT NULL AND frame_index IS NOT NULL")
    a = a.select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), F.expr("transform(slice(action, 1, 4), v -> cast(v AS double))").alias("a"))
    a = a.where("NOT exists(a, v -> v IS NULL OR isnan(v))").distinct()
    g = a.groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("f", "a"))).alias("s"))
    g = g.select("ep", F.size("s").cast("bigint").alias("n_steps"), sq.fold_planar(F.col("s.a")).alias("p"))
    return g.select("ep", "n_steps", *[r6(F.col("p")[i]).alias(n) for i, n in enumerate(["x", "y", "z", "yaw"])])


@R.query(
    "W16_action_chunk",
    f"""WITH {STEPS} SELECT ep, f, count(*) OVER w AS n, {q6('sum(z) OVER w')} AS total, {q6('first_value(yaw) OVER (PARTITION BY ep ORDER BY f)')} AS first_yaw FROM steps WINDOW w AS (PARTITION BY ep ORDER BY f ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING)""",
)
def w16(spark, d):
    s = steps(spark, d).withColumn("c", sq.action_chunk("z", BY, ON)).withColumn("first_yaw", sq.first_frame("yaw", BY, ON))
    return s.select("ep", "f", F.size("c").cast("bigint").alias("n"), r6(F.aggregate("c", F.lit(0.0), lambda a, x: a + x)).alias("total"), r6("first_yaw").alias("first_yaw"))


@R.query(
    "W16_frame_subset",
    f"""WITH {STEPS}, n AS (SELECT *, row_number() {W} AS i, count(*) OVER (PARTITION BY ep) AS n FROM steps), j AS (SELECT ep, f, i, n, unnest([-9999, 0, 4, 15]) AS off FROM n)
SELECT j.ep, j.f, off, {q6('s.z')} AS z FROM j JOIN n s ON s.ep = j.ep AND s.i = CASE WHEN off = -9999 THEN 1 ELSE least(j.i + off, j.n) END""",
)
def w16_subset(spark, d):
    offs = (sq.FIRST, 0, 4, 15)
    s = steps(spark, d).select("ep", "f", *[sq.at_offset("z", BY, ON, o).alias(f"z{i}") for i, o in enumerate(offs)])
    subset = F.array(*[F.struct(F.lit(o).alias("off"), F.col(f"z{i}").alias("z")) for i, o in enumerate(offs)])
    return s.select("ep", "f", F.inline(subset)).select("ep", "f", "off", r6("z").alias("z"))


@R.query("W17_every_kth", f"WITH {STEPS} SELECT scene, count(*) AS n, {q6('avg(x)')} AS mean_x FROM steps WHERE f % 10 = 0 GROUP BY scene")
def w17(spark, d):
    return sq.every_kth(steps(spark, d), "f", 10).groupBy("scene").agg(F.count("*").alias("n"), r6(F.avg("x")).alias("mean_x"))


@R.query(
    "A04_ST1_run_groups",
    f"""WITH {STEPS}, n AS (SELECT *, CASE WHEN lag(f) {W} IS NULL THEN 0 WHEN task IS NOT DISTINCT FROM lag(task) {W} THEN 0 ELSE 1 END AS new FROM steps),
r AS (SELECT *, sum(new) {W} AS run_no FROM n)
SELECT ep, CAST(run_no AS BIGINT) AS run_no, min(task) AS task, min(f) AS first_f, count(*) AS n FROM r GROUP BY ep, run_no""",
)
def a04(spark, d):
    r = sq.run_groups(steps(spark, d), "task", ON, BY)
    return r.groupBy("ep", F.col("run_no").cast("bigint").alias("run_no")).agg(F.min("task").alias("task"), F.min("f").alias("first_f"), F.count("*").alias("n"))


@R.query("P06_index_columns", f"""WITH {STEPS}, n AS (SELECT *, CAST(row_number() {W} - 1 AS BIGINT) AS frame_no FROM steps) SELECT ep, f, frame_no, {q6('frame_no / 10.0')} AS t, CAST(ep // 1000 AS BIGINT) AS chunk FROM n""")
def p06(spark, d):
    n = steps(spark, d).withColumn("frame_no", (F.row_number().over(sq.over(BY, ON)) - 1).cast("bigint"))
    return n.select("ep", "f", "frame_no", r6(F.col("frame_no") / 10.0).alias("t"), F.floor(F.col("ep") / 1000).cast("bigint").alias("chunk"))


@R.query("A14_F16_trajectories", f"WITH {STEPS} SELECT ep, count(*) AS length, {q6('max(z)')} AS top, {q6('avg(z)')} AS mean_z FROM steps GROUP BY ep HAVING count(*) >= 5")
def a14(spark, d):
    return steps(spark, d).groupBy("ep").agg(F.count("*").alias("length"), r6(F.max("z")).alias("top"), r6(F.avg("z")).alias("mean_z")).where("length >= 5")


@R.query("A10_score_report", f"WITH {_SPEED} SELECT robot, count(*) AS n, {q6('max(speed)')} AS max, {q6('min(speed)')} AS min, {q6('avg(speed)')} AS mean, {q6('var_pop(speed)')} AS var, {q6('quantile_cont(speed, 0.99)')} AS p99, {q6('quantile_cont(speed, 0.01)')} AS p01 FROM sp GROUP BY robot")
def a10(spark, d):
    r = stats.score_report(steps(spark, d).withColumn("speed", sq.speed("x", "y", "z", BY, ON, 0.1)), ["robot"], "speed")
    return r.select("robot", "n", *[r6(c).alias(c) for c in ("max", "min", "mean", "var", "p99", "p01")])


@R.query("A12_histogram", f"WITH {STEPS}, b AS (SELECT CAST(least(floor((yaw + 180.0) / 7.2), 49) AS BIGINT) AS bin FROM steps WHERE yaw BETWEEN -180 AND 180) SELECT bin, count(*) AS n, {q6('count(*) / ((SELECT count(*) FROM b) * 7.2)')} AS density FROM b GROUP BY bin")
def a12(spark, d):
    h = stats.histogram(steps(spark, d), "yaw", -180.0, 180.0, 50)
    return h.select("bin", "n", r6("density").alias("density"))


@R.query("A17_timing", f"""WITH {STEPS}, t AS (SELECT robot, ep, max(ts) - min(ts) AS s FROM steps GROUP BY robot, ep) SELECT robot, count(*) AS n, {q6('avg(s)')} AS mean, {q6('stddev_pop(s)')} AS std FROM t GROUP BY robot""")
def a17(spark, d):
    t = steps(spark, d).groupBy("robot", "ep").agg((F.max("ts") - F.min("ts")).alias("s"))
    return rounded(stats.timing_report(t, ["robot"], "s"), ["robot", "n"], ["mean", "std"])


_GRID = [-15 + 30 * i / 499 for i in range(500)]


@R.query(
    "A13_kde",
    f"""WITH {POSES}, v AS (SELECT x AS z FROM poses), m AS (SELECT stddev_samp(z) * count(*) ** -0.2 AS bw, count(*) AS n FROM v), g AS (SELECT unnest([{', '.join(map(str, _GRID))}]::DOUBLE[]) AS g)
SELECT g, {q6('sum(exp(-((g - z) / bw) * ((g - z) / bw) / 2)) / (max(n) * max(bw) * sqrt(2 * pi()))')} AS density FROM g, v, m GROUP BY g""",
)
def a13(spark, d):
    k = stats.kde(poses(spark, d), "x", _GRID)
    return k.select("g", r6("density").alias("density"))


_VEC = """vec AS (SELECT DISTINCT scene, episode_index AS ep, frame_index AS f, action FROM frames WHERE action IS NOT NULL),
ex AS (SELECT scene, ep, f, CAST(unnest(action) AS DOUBLE) AS x, generate_subscripts(action, 1) - 1 AS dim FROM vec), ok AS (SELECT * FROM ex WHERE NOT isnan(x))"""


def _vec(spark, d):
    v = table(spark, d, "frames").where("action IS NOT NULL").select("scene", F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), "action").distinct()
    return v.withColumn("action", F.filter("action", lambda x: F.lit(True)))


@R.query("A01_F19_episode_stats", f"WITH {_VEC} SELECT ep, CAST(dim AS INTEGER) AS dim, {q6('min(x)')} AS min, {q6('max(x)')} AS max, {q6('avg(x)')} AS mean, {q6('stddev_pop(x)')} AS std, count(*) AS count FROM ok GROUP BY ep, dim")
def a01(spark, d):
    e = stats.exploded(_vec(spark, d), ["ep"], "action")
    s = e.groupBy("ep", "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("*").alias("count"))
    return s.select("ep", "dim", *[r6(c).alias(c) for c in ("min", "max", "mean", "std")], "count")


@R.query("A03_merged_stats", f"WITH {_VEC} SELECT CAST(dim AS INTEGER) AS dim, {q6('min(x)')} AS min, {q6('max(x)')} AS max, {q6('avg(x)')} AS mean, {q6('stddev_pop(x)')} AS std, count(*) AS count FROM ok GROUP BY dim")
def a03(spark, d):
    m = stats.merged_moments(stats.partial_moments(_vec(spark, d), ["scene"], "action"), ["dim"])
    return m.select("dim", *[r6(c).alias(c) for c in ("min", "max", "mean", "std")], "count")


@R.query("UD8_normalised", f"WITH {_VEC}, m AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM ok GROUP BY dim) SELECT scene, CAST(dim AS INTEGER) AS dim, {q6('avg(CASE WHEN hi = lo THEN 0.0 ELSE 2 * (x - lo) / (hi - lo) - 1 END)')} AS mean FROM ok JOIN m USING (dim) GROUP BY scene, dim")
def ud8(spark, d):
    e = stats.exploded(_vec(spark, d), ["scene"], "action")
    m = e.groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    j = e.join(m, "dim")
    return j.groupBy("scene", "dim").agg(r6(F.avg(stats.min_max_normalised(j, F.col("x"), F.col("lo"), F.col("hi")))).alias("mean"))


_SUM4 = " + ".join(f"CAST(action[{i}] AS DOUBLE)" for i in range(1, 5))


@R.query("P10_P03_slices", f"""SELECT scene, episode_index AS ep, frame_index AS f, count(*) AS n, {q6(f'max({_SUM4})')} AS delta_sum FROM frames
WHERE len(action) >= 8 AND NOT list_bool_or(list_transform(action, lambda v: isnan(v))) GROUP BY ALL""")
def p10(spark, d):
    t = table(spark, d, "frames").where("size(action) >= 8 AND NOT exists(action, v -> isnan(v))")
    part = F.slice("action", 1, 4).cast("array<double>")
    return t.groupBy("scene", F.col("episode_index").alias("ep"), F.col("frame_index").alias("f")).agg(F.count("*").alias("n"), r6(F.max(part[0] + part[1] + part[2] + part[3])).alias("delta_sum"))
