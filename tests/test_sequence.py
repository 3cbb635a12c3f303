import numpy as np
import pytest
from pyspark.sql import functions as F

from helmwake.operators import sequence as sq
from helmwake.operators import spatial, visibility


def frames(spark, seed=0, sizes=(1, 2, 9, 10, 60)):
    rng = np.random.default_rng(seed)
    rows = []
    for e, n in enumerate(sizes):
        yaw = (np.cumsum(rng.normal(0, 30, n)) + 180) % 360 - 180
        xyz = np.cumsum(rng.normal(0, 0.2, (n, 3)), axis=0)
        rows += [(e, f, *map(float, xyz[f]), float(yaw[f])) for f in range(n)]
    return rows, spark.createDataFrame(rows, "e int, f int, x double, y double, z double, yaw double")


def episode(rows, e):
    return np.array([r[2:] for r in rows if r[0] == e])


@pytest.mark.parametrize("k", [5, 10])
def test_yaw_rate_and_smoothing(spark, k):
    rows, df = frames(spark)
    d = sq.with_yaw_rate(df, ["e"], ["f"], "yaw", 0.1).withColumn("s", sq.box_smooth("yaw_rate", ["e"], ["f"], k))
    got = d.orderBy("e", "f").select("e", "yaw_rate", "s").collect()
    for e in range(5):
        yaw = episode(rows, e)[:, 3]
        mine = np.array([(r["yaw_rate"], r["s"]) for r in got if r["e"] == e])
        want = np.abs(np.rad2deg(np.gradient(np.unwrap(np.deg2rad(yaw)), 0.1))) if len(yaw) > 1 else np.zeros(1)
        assert np.allclose(mine[:, 0], want, atol=1e-8)
        if len(yaw) >= k:
            assert np.allclose(mine[:, 1], np.convolve(want, np.ones(k) / k, mode="same"), atol=1e-8)


def test_speed_velocity_and_lookahead(spark):
    rows, df = frames(spark)
    d = sq.with_velocity(df, ["x", "y", "z"], ["e"], ["f"], 0.1).withColumn("sp", sq.speed("x", "y", "z", ["e"], ["f"], 0.1)).withColumn("lo", sq.lookahead_min("z", ["e"], ["f"], 4))
    got = d.orderBy("e", "f").collect()
    for e in range(5):
        p = episode(rows, e)[:, :3]
        mine = [r for r in got if r["e"] == e]
        step = np.diff(p, axis=0) / 0.1
        sp = np.linalg.norm(step, axis=1)
        assert np.allclose([r["sp"] for r in mine], np.r_[sp[:1], sp] if len(p) > 1 else [0.0])
        assert np.allclose([[r["v_x"], r["v_y"], r["v_z"]] for r in mine], np.r_[step, step[-1:]] if len(p) > 1 else np.zeros((1, 3)))
        assert np.allclose([r["lo"] for r in mine], [p[i : i + 4, 2].min() for i in range(len(p))])


def test_runs_goals_gaps_and_quota(spark):
    df = spark.createDataFrame([("s", 0, "a"), ("s", 1, "a"), ("s", 2, "b"), ("s", 3, None), ("s", 4, None), ("s", 5, "a"), ("t", 0, "a")], "src string, n int, id string")
    r = sq.run_groups(df, "id", ["n"], ["src"]).orderBy("src", "n").collect()
    assert [x["run_no"] for x in r] == [0, 0, 1, 2, 2, 3, 0]
    one = sq.first_of([F.lit(-1), F.lit(None).cast("int"), F.lit(4), F.lit(5)])
    assert spark.range(1).select(one.alias("a"), sq.first_of([F.lit(-1)]).alias("b")).first()[:] == (4, -1)
    q = sq.quota_split(spark.range(10).withColumnRenamed("id", "k"), ["k"], [("eval", 2), ("train", 5)])
    assert [r["split"] for r in q.orderBy("k").collect()] == ["eval"] * 2 + ["train"] * 5
    g = sq.with_gap(spark.createDataFrame([(1, 0.0), (1, 0.1), (1, 0.5)], "e int, t double"), ["e"], ["t"], "t", 10.0)
    assert [r["is_gap"] for r in g.orderBy("t").collect()] == [False, False, True]
    assert sq.with_yaw_rate(frames(spark)[1].limit(0), ["e"], ["f"], "yaw", 0.1).count() == 0


def test_fold_and_chunk(spark):
    rng = np.random.default_rng(1)
    steps = rng.normal(0, 1, (12, 4))
    steps[:, 3] *= 40
    x = np.zeros(4)
    for s in steps:
        c, n = np.cos(np.deg2rad(x[3])), np.sin(np.deg2rad(x[3]))
        x = np.array([x[0] + c * s[0] - n * s[1], x[1] + n * s[0] + c * s[1], x[2] + s[2], (x[3] + s[3] + 180) % 360 - 180])
    df = spark.createDataFrame([(steps.tolist(),), ([],)], "d array<array<double>>").select(sq.fold_planar(F.col("d")).alias("p")).collect()
    assert np.allclose(df[0]["p"], x) and df[1]["p"] == [0.0] * 4
    _, f = frames(spark)
    c = f.withColumn("c", sq.action_chunk("z", ["e"], ["f"])).where("e = 4").orderBy("f").collect()
    assert [len(r["c"]) for r in c] == [min(16, 60 - i) for i in range(60)]


def cloud(spark, n=300, seed=5):
    p = np.random.default_rng(seed).uniform(-3, 3, (n, 3))
    return p, spark.createDataFrame([("s", i, *map(float, x)) for i, x in enumerate(p)], "sc string, pid int, x double, y double, z double")


def test_nearest_and_knn_against_brute_force(spark):
    p, c = cloud(spark)
    q = np.r_[np.random.default_rng(6).uniform(-4, 4, (40, 3)), [[50.0, 0, 0]]]
    d = spark.createDataFrame([("s", i, *map(float, x)) for i, x in enumerate(q)] + [("none", 99, 0.0, 0.0, 0.0)], "sc string, k int, x double, y double, z double")
    dist = np.linalg.norm(q[:, None] - p[None], axis=2)
    got = {r["k"]: r["dist"] for r in spatial.nearest_within(d, c, "sc", ["k"], 1.2).collect()}
    assert got[99] == 1.2 and np.allclose([got[i] for i in range(len(q))], np.minimum(dist.min(axis=1), 1.2))
    knn = spatial.knn(d, c, "sc", ["k"], "pid", 3, 0.5).collect()
    for i in range(len(q)):
        mine = sorted((r["rank"], r["pid"], r["dist"]) for r in knn if r["k"] == i)
        assert [m[1] for m in mine] == np.argsort(dist[i])[:3].tolist() and np.allclose([m[2] for m in mine], np.sort(dist[i])[:3])


def test_collision_against_loop(spark):
    p, c = cloud(spark, 40)
    rows, df = frames(spark, 7, (1, 30))
    df = df.withColumn("sc", F.lit("s"))
    got = {(r["e"], r["f"]): r["prob"] for r in spatial.collision_probability(df, c, "sc", ["sc", "e"], "f").collect()}
    for e in range(2):
        x = episode(rows, e)
        sp = np.linalg.norm(np.diff(x[:, :3], axis=0), axis=1) / 0.1
        sp = np.r_[sp[:1], sp] if len(x) > 1 else np.zeros(1)
        for i in range(len(x)):
            a, s = np.deg2rad(x[i, 3]), np.arange(1, 36) * 0.1 * sp[i]
            g = x[i, :3] + np.c_[s * np.cos(a), s * np.sin(a), 0 * s]
            m = np.linalg.norm(g[:, None] - p[None], axis=2).min()
            want = 1.0 if m <= 0.01 else 0.0 if m >= 1.2 else (1.2 - m) / 1.19
            assert abs(got[(e, i)] - want) < 1e-9


def test_voxels(spark):
    p, c = cloud(spark)
    got = spatial.voxel_downsample(c, ["sc"], 0.7).collect()
    cell = np.floor((p - (p.min(axis=0) - 0.35)) / 0.7).astype(int)
    assert len(got) == len(np.unique(cell, axis=0)) and sum(r["n_points"] for r in got) == len(p)


def test_intervals_and_farthest(spark):
    iv = "array<struct<start:bigint,end:bigint>>"
    df = spark.sql(f"SELECT cast(i AS bigint) AS i, 20L AS last, from_json('[{{\"start\":0,\"end\":9}},{{\"start\":3,\"end\":5}},{{\"start\":12,\"end\":99}}]', '{iv}') AS iv FROM VALUES (4), (6), (10), (15) AS t(i)")
    got = df.select("i", visibility.enclosing_end(F.col("iv"), F.col("i"), F.col("last")).alias("e")).orderBy("i").collect()
    assert [r["e"] for r in got] == [5, 9, 20, 20]
    n = 700
    f = spark.range(n).select(F.lit(1).alias("e"), F.col("id").alias("f"), F.least(F.col("id") + 300, F.lit(n - 1)).alias("stop_at"))
    pairs = visibility.candidate_pairs(f, ["e"], "f", "stop_at", [])
    assert pairs.count() == sum(min(i + 300, n - 1) - i for i in range(n))
    small = spark.createDataFrame([(1, 0, 5, j, s, ed) for j, s, ed in [(1, False, True), (2, False, False), (3, False, True), (4, True, False), (5, False, False)]] + [(1, 1, 3, 2, True, True), (1, 1, 3, 3, False, False)], "e int, f int, stop_at int, t_frame int, stop boolean, edge boolean")
    got = {r["f"]: r["farthest"] for r in visibility.farthest(small, ["e"], "f", "stop_at", "stop", "edge").collect()}
    assert got == {0: 2, 1: 2}
