import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from helmwake import pipelines
from helmwake.sinks.files import png_bytes

LEVEL = np.array([[0, 0, -1.0], [-1, 0, 0], [0, 1, 0]])  # a level camera that looks along the world's x


def pose(x, y, z, yaw=0.0):
    c, s = np.cos(np.deg2rad(yaw)), np.sin(np.deg2rad(yaw))
    t = np.eye(4)
    t[:3, :3] = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]) @ LEVEL
    t[:3, 3] = x, y, z
    return t.reshape(-1).tolist()


def tree(tmp_path, depth_value=60000):
    sc = tmp_path / "scene_a"
    for d in ("data/chunk-000", "meta", "videos/chunk-000/observation.images.depth"):
        (sc / d).mkdir(parents=True)
    n = 12
    k = [100.0, 0, 240, 0, 100, 135, 0, 0, 1]
    for e, cam in ((0, [pose(0.3 * i, 0, 1) for i in range(n)]), (1, [np.eye(4).reshape(-1).tolist()] * 3), (2, [pose(i, 0, 1) for i in range(3)])):
        pq.write_table(pa.table({"action": cam, "observation.camera_intrinsic": [k] * len(cam)}), sc / f"data/chunk-000/episode_{e:06d}.parquet")
    for i in range(n):
        (sc / f"videos/chunk-000/observation.images.depth/episode_000000_{i}.png").write_bytes(png_bytes(np.full((270, 480), depth_value, np.uint16)))
    step = lambda a, z: {"sub_instruction": "go", "revised_sub_instruction": "", "sub_indexes": [a, z]}
    rows = [{"episode_index": 0, "tasks": [{"sub_instruction": "old", "sub_indexes": [0, 3]}]}, {"episode_index": 0, "tasks": [step(0, 5), step(6, 11)]}, {"episode_index": 1, "tasks": [step(0, 2)]}, {"episode_index": 2, "tasks": [step(2, 0)]}]
    (sc / "meta/episodes.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbroken\n")
    return sc


@pytest.mark.parametrize("depth,far", [(60000, [5, 5, 5, 5, 5, 5, 11, 11, 11, 11, 11, None]), (10000, [3, 4, 5, 5, 5, 5, 9, 10, 11, 11, 11, None])])
def test_n1(spark, tmp_path, depth, far):
    tree(tmp_path, depth)
    r = pipelines.convert_n1(spark, str(tmp_path)).orderBy("frame_index").collect()
    assert {x["source_episode"] for x in r} == {"0"} and len(r) == 12  # the others are not level or have no valid task
    for i, x in enumerate(r):
        assert np.allclose(x["state"], [0.3 * i, 0, 0, 0, 0], atol=1e-9)
        assert np.allclose(x["action"][:4], [0.3 if i < 11 else 0, 0, 0, 0], atol=1e-9)
        assert np.allclose(x["action"][4:], [0.3 * (far[i] - i) if far[i] else 0, 0, 0, 0], atol=1e-9)


def test_n1_gates_the_yaw_rate_by_risk(spark, tmp_path):
    sc = tree(tmp_path)
    cam = [pose(0.1 * i, 0, 1, 10.0 * i) for i in range(20)]
    pq.write_table(pa.table({"action": cam, "observation.camera_intrinsic": [[100.0, 0, 240, 0, 100, 135, 0, 0, 1]] * 20}), sc / "data/chunk-000/episode_000000.parquet")
    (sc / "meta/pointcloud.ply").write_bytes(b"ply\nformat ascii 1.0\nelement vertex 1\nproperty float x\nproperty float y\nproperty float z\nend_header\n2 0 1\n")
    r = pipelines.convert_n1(spark, str(tmp_path)).orderBy("frame_index").collect()
    rate = [x["state"][4] for x in r]
    assert rate[0] > 0 and rate[12] == 0  # first it heads for the point, later it has turned away


def test_ce_and_publish(spark, tmp_path):
    sc = tmp_path / "in" / "scene_b"
    (sc / "data/chunk-000").mkdir(parents=True)
    (sc / "meta").mkdir()
    cam = []
    for i in range(5):
        t = np.eye(4)
        t[:3, :3], t[:3, 3] = np.array([[0, 0, 1.0], [-1, 0, 0], [0, -1, 0]]), (float(i), 0, 0)
        cam.append(t.tolist())
    pq.write_table(pa.table({"pose.125cm_0deg": cam, "action": [-1, 1, 2, 1, 0], "relative_goal_frame_id.125cm_45deg": [-1, 3, -1, -1, -1], "relative_goal_frame_id.60cm_30deg": [2, 1, -1, -1, -1]}), sc / "data/chunk-000/episode_000007.parquet")
    (sc / "meta/episodes.jsonl").write_text(json.dumps({"episode_index": 7, "tasks": ["walk on", "x"]}) + "\n")
    f = pipelines.convert_ce(spark, str(tmp_path / "in"))
    r = f.orderBy("frame_index").collect()
    goal = [2, 4, 3, 4, 4]
    for i, x in enumerate(r):
        assert np.allclose(x["state"], [i, 0, 0, 0], atol=1e-9)
        assert np.allclose(x["action"], [1 if i < 4 else 0, 0, 0, 0, goal[i] - i, 0, 0, 0], atol=1e-9)
    root = str(tmp_path / "out")
    assert pipelines.publish(f, root, 10, "robot") == {"total_episodes": 1, "total_frames": 5, "total_tasks": 1}
    t = pq.read_table(f"{root}/data/chunk-000/episode_000000.parquet").to_pylist()
    assert [x["index"] for x in t] == list(range(5)) and t[0]["annotation.human.action.task_description"] == [0] and len(t[0]["action"]) == 8
    assert json.loads(open(f"{root}/meta/tasks.jsonl").readline()) == {"task_index": 0, "task": "walk on"}
    assert json.loads(open(f"{root}/meta/episodes.jsonl").readline())["length"] == 5
    s = json.loads(open(f"{root}/meta/episodes_stats.jsonl").readline())["stats"]["observation.state"]
    assert s["max"] == [4.0, 0.0, 0.0, 0.0] and s["count"] == [5] and abs(s["std"][0] - 2**0.5) < 1e-9


def lines(path):
    return [json.loads(x) for x in open(path).read().splitlines()]


def converted(spark, names, task):
    rows = [(s, e, f, task(s, e), [float(f), 0.0, 0.0, 1.0], [1.0] * 8) for s, e, n in names for f in range(n)]
    return spark.createDataFrame(rows, "source string, source_episode string, frame_index bigint, task string, state array<double>, action array<double>")


def test_publishing_twice_appends(spark, tmp_path):
    """Counters, numbers and files go on behind the first output; known tasks keep their numbers."""
    root = str(tmp_path / "out")
    first = converted(spark, [("a", "0", 3), ("b", "0", 2)], lambda s, e: f"go {s}")
    ex = spark.createDataFrame([("a", "0", [1.0, 2.0]), ("b", "0", [3.0, 4.0])], "source string, source_episode string, K array<double>")
    err = spark.createDataFrame([("z", "9", "no valid task")], "source string, source_episode string, reason string")
    assert pipelines.publish(first, root, 10, "uav", extras=ex, errors=err, shapes={"video.ego_view": {"dtype": "video", "shape": [270, 480, 3], "names": ["height", "width", "channels"]}}) == {"total_episodes": 2, "total_frames": 5, "total_tasks": 2}
    second = converted(spark, [("c", "0", 4), ("c", "1", 1)], lambda s, e: "go b" if e == "0" else "stop")
    assert pipelines.publish(second, root, 10, "uav", append=True, extras=ex.limit(0), errors=err) == {"total_episodes": 4, "total_frames": 10, "total_tasks": 3}
    assert lines(f"{root}/meta/tasks.jsonl") == [{"task_index": 0, "task": "go a"}, {"task_index": 1, "task": "go b"}, {"task_index": 2, "task": "stop"}]
    assert [(x["episode_index"], x["length"], x["tasks"]) for x in lines(f"{root}/meta/episodes.jsonl")] == [(0, 3, ["go a"]), (1, 2, ["go b"]), (2, 4, ["go b"]), (3, 1, ["stop"])]
    assert [x["episode_index"] for x in lines(f"{root}/meta/episodes_stats.jsonl")] == [0, 1, 2, 3]
    assert lines(f"{root}/meta/episodes_extras.jsonl")[1] == {"episode_index": 1, "K": [3.0, 4.0]} and len(lines(f"{root}/meta/errors.jsonl")) == 2
    seen = 0
    for i, x in enumerate(lines(f"{root}/meta/episodes.jsonl")):
        t = pq.read_table(f"{root}/data/chunk-000/episode_{i:06d}.parquet").to_pylist()
        assert len(t) == x["length"] and [r["frame_index"] for r in t] == list(range(len(t))) and {r["episode_index"] for r in t} == {i}
        assert [r["global_index"] for r in t] == list(range(seen, seen + len(t))) and all(abs(r["timestamp"] - k / 10) < 1e-9 for k, r in enumerate(t))
        seen += len(t)
    info = json.load(open(f"{root}/meta/info.json"))
    assert info["codebase_version"] == "v2.1" and info["splits"] == {"train": "0:4"} and info["total_chunks"] == 1
    assert info["features"]["observation.state"]["shape"] == [4] and {"timestamp", "frame_index", "episode_index", "index", "task_index"} <= set(info["features"])
    with pytest.raises(FileExistsError):
        pipelines.publish(second, root, 10, "uav")
    assert pipelines.publish(second, root, 10, "uav", overwrite=True)["total_episodes"] == 2


def test_splits_by_quota(spark, tmp_path):
    f = converted(spark, [("a", str(i), i + 1) for i in range(5)], lambda s, e: e)
    got = pipelines.publish_splits(f, str(tmp_path / "o"), 5, "uav", [("eval", 2), ("train", None)])
    assert {k: (v["total_episodes"], v["total_frames"]) for k, v in got.items()} == {"eval": (2, 3), "train": (3, 12)}
    from helmwake import functions as fn

    for words, want in ((("all",), {"eval": 5}), (("2", "1"), {"eval": 2, "train": 1}), (("0", "all"), {"train": 5})):
        s = pipelines.split_trajectories(f, list(zip(("eval", "train"), map(fn.quota, words))))
        assert {r["split"]: r["trajectories"] for r in pipelines.split_report(s, 5).collect()} == want


def test_n1_levelled_and_strict(spark, tmp_path):
    sc = tree(tmp_path)
    r = pipelines.convert_n1_levelled(spark, str(tmp_path), strict=False).where("source_episode = '0'").orderBy("frame_index").collect()
    new = pipelines.convert_n1(spark, str(tmp_path)).orderBy("frame_index").collect()
    for i, (x, y) in enumerate(zip(r, new)):  # both forms agree on a level camera
        assert np.allclose(x["state"], y["state"][:4], atol=1e-5) and np.allclose(x["action"], y["action"], atol=1e-5)
    with pytest.raises(Exception, match="no valid task"):
        pipelines.convert_n1_levelled(spark, str(tmp_path)).collect()
    log = {(x["source_episode"], x["reason"]) for x in pipelines.rejected(spark, str(tmp_path)).collect()}
    assert log == {("1", "not level"), ("2", "no valid task")}
    x = {r["source_episode"]: r for r in pipelines.n1_extras(spark, str(tmp_path)).collect()}
    assert x["0"]["K"][0] == 100.0 and len(x["0"]["T_b_c"]) == 16
    kept = pipelines.convert_n1_levelled(spark, str(tmp_path), strict=False, keep=lambda f: f.where("episode_index <> 1"))
    assert {r["source_episode"] for r in kept.select("source_episode").distinct().collect()} == {"0"} and sc.exists()


def test_pitch_or_roll_of_a_levelled_camera_is_an_error(spark):
    from pyspark.sql import functions as F

    from helmwake.operators import se3

    df = spark.createDataFrame([(0.0, 0.0005), (0.2, 0.0)], "p double, r double")
    assert df.where("p = 0").select(se3.require_level(F.lit(7), F.col("p"), F.col("r")).alias("v")).first()["v"] == 7
    with pytest.raises(Exception, match="pitch or roll"):
        df.select(se3.require_level(F.lit(7), F.col("p"), F.col("r"))).collect()
