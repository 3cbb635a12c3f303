"""Queries that once left out a part of their input, against brute force over all of it."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry
from helmwake.operators.consolidate import consolidate
from helmwake.sinks.files import png_bytes

FRAMES = pa.schema([("scene", pa.string()), ("robot", pa.string()), ("episode_index", pa.int64()), ("frame_index", pa.int64()), ("timestamp", pa.float64()), ("task_index", pa.int64()), ("observation.state", pa.list_(pa.float32())), ("action", pa.list_(pa.float32()))])
STILL = [0.0, 0.0, 0.0, 0.0]


def frame(ep, f, state=STILL, action=STILL):
    return {"scene": "s", "robot": "r", "episode_index": ep, "frame_index": f, "timestamp": f * 0.1, "task_index": 0, "observation.state": state, "action": action}


def run(spark, d, name, **tables):
    """Rows of a query over a data directory of the given tables."""
    for n, t in tables.items():
        pq.write_table(t, d / f"{n}.parquet")
    return entry.queries()[name](spark, str(d)).collect()


def test_fold_path_goes_to_the_end(spark, tmp_path):
    steps = {(e, f): [0.5, 0.25 * (f % 3), -0.125, 7.0 + e] for e, n in ((1, 150), (2, 61), (3, 5)) for f in range(n)}
    rows = [frame(e, f, action=a) for (e, f), a in steps.items()] + [frame(1, 149, action=steps[1, 149]), frame(2, 70, action=None)]
    got = {r["ep"]: r for r in run(spark, tmp_path, "W15_fold_path", frames=pa.Table.from_pylist(rows[::-1], FRAMES))}
    for e, n in ((1, 150), (2, 61), (3, 5)):
        x = y = z = yaw = 0.0
        for f in range(n):
            a, t = steps[e, f], math.radians(yaw)
            x, y, z, yaw = x + math.cos(t) * a[0] - math.sin(t) * a[1], y + math.sin(t) * a[0] + math.cos(t) * a[1], z + a[2], (yaw + a[3] + 180) % 360 - 180
        assert got[e]["n_steps"] == n and all(abs(got[e][k] - v) < 1e-5 for k, v in (("x", x), ("y", y), ("z", z), ("yaw", yaw)))


def seen_farthest(t, r):
    """Farthest later frame of each frame, by the loop of SURVEY 7.6 up to the last frame; camera of 480 x 270 pixels."""
    out = {}
    for i in range(len(t)):
        free, best = True, i + 1 if i < len(t) - 1 else i
        for j in range(i + 1, len(t)):
            q = r[i].T @ (t[j] - t[i])
            if -q[2] <= 0:
                break
            u, v = q[0] * 200 / -q[2] + 240, 269 - (q[1] * 200 / -q[2] + 135)
            free = 0 <= u < 480 and 0 <= v < 270 and 2 + abs(math.sin(math.radians(u + 2 * v))) * 12 > -q[2]
            if not free:
                break
            if 20 <= u <= 460 and 20 <= v <= 250:
                best = j
        out[i] = best
    return out


def test_farthest_looks_to_the_last_frame(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for e, n in ((0, 300), (1, 20), (2, 1)):
        v = np.zeros((n, 9), np.float32)
        v[:, :2], v[:, 2], v[:, 5] = rng.normal(0, 0.0005, (n, 2)), -0.004 * np.arange(n), rng.normal(0, 0.2, n)
        rows += [{"vec_id": 1000 * e + 3 * i, "embedding": x.tolist(), "label": e} for i, x in enumerate(v)]
        yaw = np.radians(v[:, 5].astype(float) * 60)
        r = [np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]]) for a in yaw]
        want |= {(e, i): j for i, j in seen_farthest(v[:, :3].astype(float) * 10, r).items()}
    assert max(j - i for (_, i), j in want.items()) > 12
    got = run(spark, tmp_path, "J05_F10_W10_W11_farthest", embeddings=pa.Table.from_pylist(rows, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])))
    assert len(got) == 321 and {(r["ep"], r["f"]): r["farthest"] for r in got} == want


def test_every_frame_asks_for_its_nearest(spark, tmp_path):
    times = {(e, f): f * 0.1 + (0.04 if f % 3 == 0 else 0.0) for e, n in ((1, 23), (2, 4)) for f in range(n) if (e, f) not in ((1, 7), (1, 8), (1, 9), (1, 10))}
    rows = [frame(e, f) | {"timestamp": t} for (e, f), t in times.items()]
    got = {(r["ep"], round(r["want"], 6)): (r["f"], r["gap"]) for r in run(spark, tmp_path, "J06_nearest_asof", frames=pa.Table.from_pylist(rows + rows[:5], FRAMES))}
    want = {}
    for e, f in times:
        gap, k = min((abs(t - (f * 0.1 + 0.03)), j) for (x, j), t in times.items() if x == e)
        if gap <= 0.15:
            want[e, round(f * 0.1 + 0.03, 6)] = k, gap
    assert len(want) == len(times) and {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - v[1]) < 1e-5 for k, v in want.items())


def test_a_frame_counts_whatever_its_readings(spark, tmp_path):
    odd = [None, [1.0], [float("nan"), 0.0, 0.0, 0.0], [5000.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 400.0]]
    rows = [frame(1, f, s) for f, s in enumerate(odd)] + [frame(1, 0, None), frame(2, 0), frame(2, 1, None), frame(3, 0, None)]
    lengths = [(1, 5), (2, 3), (3, 1), (4, 2), (5, None), (None, 1)]
    tables = {"frames": pa.Table.from_pylist(rows, FRAMES), "episodes": pa.Table.from_pylist([{"episode_index": e, "length": n} for e, n in lengths], pa.schema([("episode_index", pa.int64()), ("length", pa.int64())]))}
    got = {tuple(r) for r in run(spark, tmp_path, "F06_count_match", **tables)}
    assert got == {(1, 5, 5, True), (2, 3, 2, False), (3, 1, 1, True), (4, 2, 0, False)}
    assert {tuple(r) for r in run(spark, tmp_path, "A16_status_report")} == {("SUCCESS", 2), ("FAIL", 1), ("ERROR", 1), ("SKIP", 1)}


IMAGES = pa.schema([("file_id", pa.int64()), ("path", pa.string()), ("n_bytes", pa.int64()), ("modified_at", pa.timestamp("us")), ("observation.images.rgb", pa.binary()), ("observation.images.depth", pa.binary())])


def image(i, path, rgb=None, depth=None):
    return {"file_id": i, "path": path, "observation.images.rgb": rgb, "observation.images.depth": depth}


def test_min_filter_over_the_depth_images(spark, tmp_path):
    rng = np.random.default_rng(8)
    px = {i: rng.integers(0, 65536, hw).astype(np.uint16) for i, hw in enumerate([(18, 24), (13, 9), (2, 30), (1, 1)])}
    rows = [image(i, f"s\\videos\\chunk-000\\observation.images.depth\\episode_000001_{i}.png", depth=png_bytes(x)) for i, x in px.items()]
    rows += [image(10, "s/videos/chunk-000/observation.images.depth/episode_000001_9.png", depth=png_bytes(px[0])[:-20]), image(11, "s/videos/chunk-000/observation.images.rgb/episode_000001_0.png", rgb=png_bytes(np.zeros((4, 4, 3), np.uint8)))]
    got = {(r["file_id"], r["v"], r["u"]): r["min_depth"] for r in run(spark, tmp_path, "W09_min_filter", image_files=pa.Table.from_pylist(rows, IMAGES))}
    want = {(i, v, u): x[max(0, v - 5) : v + 6, max(0, u - 5) : u + 6].min() * 0.0001 for i, x in px.items() for v in range(x.shape[0]) for u in range(x.shape[1])}
    assert got.keys() == want.keys() and all(abs(got[k] - w) < 1e-9 for k, w in want.items())


def test_irregular_paths_have_parts_and_a_place(spark, tmp_path):
    at = "ash-loft__01ab/videos/chunk-000/observation.images.{}/episode_000007_{}.png"
    paths = {1: at.format("rgb", 10), 2: at.format("rgb", 9).replace("/", "\\"), 3: at.format("depth", 9), 4: at.format("depth", 2).replace("/", "\\"), 5: at.format("rgb", 2).replace("episode", "retry_1/episode"), 6: at.format("depth", 10).replace("7", "8")}
    files = pa.Table.from_pylist([image(i, p, rgb=b"x" if "rgb" in p else None, depth=b"x" if "depth" in p else None) for i, p in paths.items()], IMAGES)
    got = {tuple(r) for r in run(spark, tmp_path, "O01_O02_numeric_order", image_files=files)}
    assert got == {(5, "000007", 2, 1, 2), (2, "000007", 9, 2, 3), (1, "000007", 10, 3, 1), (4, "000007", 2, 1, 1), (3, "000007", 9, 2, 2), (6, "000008", 10, 1, 1)}
    parts = {r["file_id"]: r for r in run(spark, tmp_path, "X03_X04_X05_X06_S18_paths")}
    assert parts.keys() == paths.keys() and all(r["root"] == "ash-loft__01ab" and r["prefix"] == "ash" for r in parts.values())
    assert parts[2][2:] == ("ash-loft__01ab/videos/chunk-000/observation.images.rgb", "episode_000007_9_png", "ash", 9)


def test_surplus_comes_from_merged_key_ranges(spark, tmp_path):
    at = "s/videos/chunk-000/observation.images.{}/episode_{:06d}_{}.png"
    rng = np.random.default_rng(4)
    keys = [("rgb" if rng.random() < 0.5 else "depth", int(rng.integers(1, 6)), int(rng.integers(0, 9))) for _ in range(300)]
    ids = [int(i) for i in rng.permutation(300)]
    rows = [image(i, at.format(*k), rgb=b"x" if k[0] == "rgb" else None, depth=b"x" if k[0] == "depth" else None) for i, k in zip(ids, keys)]
    files = rows + rows[:40] + [image(900, "odd name", rgb=b"x"), image(901, "odd name", rgb=b"x")]
    by = {}
    for i, k in zip(ids, keys):
        by.setdefault(k, []).append(i)
    got = [tuple(r) for r in run(spark, tmp_path, "p5_found", image_files=pa.Table.from_pylist(files, IMAGES))]
    assert sorted(got) == sorted((min(x), i) for x in by.values() for i in x if i != min(x))
    plan = entry.queries()["p5_found"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Window" not in plan and "Aggregate" not in plan


def test_entries_without_identity_are_cut_by_bytes(spark, tmp_path):
    png = png_bytes(np.arange(48, dtype=np.uint8).reshape(4, 4, 3))
    rows = [image(i if i else None, f"odd name {i}", rgb=png) for i in range(3000)] + [image(5000, "s/observation.images.depth/x.png", depth=png)]
    pq.write_table(pa.Table.from_pylist(rows, IMAGES), tmp_path / "image_files.parquet")
    man = consolidate(spark.read.parquet(str(tmp_path / "image_files.parquet")), str(tmp_path / "out"), 500 * len(png)).collect()
    got = {(r["image_key"], r["out_file"]): r["n_images"] for r in man}
    assert got == {("rgb", -1 - k): 500 for k in range(6)} | {("depth", -1): 1}
