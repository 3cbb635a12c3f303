import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helmwake import functions as fn
from helmwake.sinks import episodes as sink
from helmwake.sinks import files as out
from helmwake.sources import clouds, episodes, images, jsonl, uav, video


@pytest.mark.parametrize("px", [np.arange(12, dtype=np.uint16).reshape(3, 4) * 4000, np.arange(36, dtype=np.uint8).reshape(3, 4, 3), np.zeros((2, 5), np.uint8)])
def test_png_round_trip(px):
    data = out.png_bytes(px)
    assert (images.decode_png(data) == px).all()
    assert images.png_size(data)[:2] == (px.shape[1], px.shape[0])
    assert images.decode_png(data[:-20]) is None or len(data) < 60
    assert images.decode_png(b"") is None and images.decode_png(data[:10]) is None


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(0)
    px = rng.integers(0, 256, (5, 6, 3)).astype(np.uint8)
    raw, rows = b"", px.reshape(5, 18).astype(int)
    for y in range(5):
        up = rows[y - 1] if y else np.zeros(18, int)
        left, corner = np.r_[np.zeros(3, int), rows[y][:-3]], np.r_[np.zeros(3, int), up[:-3]]
        paeth = [min(((abs(a + b - c - v), k, v) for k, v in enumerate((a, b, c))))[2] for a, b, c in zip(left, up, corner)]
        pred = [np.zeros(18, int), left, up, (left + up) // 2, np.array(paeth)][y]
        raw += bytes([y]) + ((rows[y] - pred) % 256).astype(np.uint8).tobytes()
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    data = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert (images.decode_png(data) == px).all()


def test_depth_modes():
    px = np.array([[0, 10000, 65535]], np.uint16)
    assert np.allclose(images.depth_metres(px), [[0, 1, 6.5535]]) and np.allclose(images.depth_metres(px, "linear", lo=1, hi=3), [[1, 1 + 20000 / 65535, 3]])
    with pytest.raises(ValueError):
        images.depth_metres(px, "other")


def test_listing_prefers_endings_and_numbers(spark, tmp_path):
    d = tmp_path / "sc" / "videos" / "chunk-000" / "observation.images.rgb"
    d.mkdir(parents=True)
    for n in ("episode_000001_10.png", "episode_000001_2.jpg", "episode_000001_2.png", "episode_000001_0.bmp", "notes.txt"):
        (d / n).write_bytes(b"x")
    rows = images.preferred(images.list_images(spark, str(tmp_path)).where("episode_index IS NOT NULL")).orderBy("place").collect()
    assert [(r["frame_index"], r["place"], r["path"].rsplit(".", 1)[1]) for r in rows] == [(0, 0, "bmp"), (2, 1, "png"), (10, 2, "png")]


def test_ply_round_trip_and_text_points(spark, tmp_path):
    p = pd.DataFrame({"scene": ["a"] * 3 + ["b"], "x": [0.0, 1.5, -2.0, 9.0], "y": [0.0] * 4, "z": [1.0, 2.0, 3.0, 4.0], "red": [0.0, 1.0, 0.2, 1.0], "green": [0.0] * 4, "blue": [1.0] * 4})
    done = out.write_clouds(spark.createDataFrame(p), str(tmp_path / "c")).collect()
    assert {r["scene"]: r["n_points"] for r in done} == {"a": 3, "b": 1}
    got = clouds.read_ply(spark, str(tmp_path / "c")).where("path IS NOT NULL" if False else "x IS NOT NULL").toPandas().sort_values("z")
    assert np.allclose(got[["x", "y", "z", "red", "blue"]].to_numpy(), p.sort_values("z")[["x", "y", "z", "red", "blue"]].to_numpy(), atol=1 / 255)
    text = b"ply\nformat ascii 1.0\nelement vertex 2\nproperty float x\nproperty float y\nproperty float z\nend_header\n1 2 3\n4 5 6\n"
    assert clouds.parse_ply(text)[["x", "y", "z"]].to_numpy().tolist() == [[1, 2, 3], [4, 5, 6]]
    assert len(clouds.parse_ply(text.replace(b"vertex 2", b"vertex 0"))) == 0
    with pytest.raises(ValueError):
        clouds.parse_ply(b"nothing")
    (tmp_path / "pts.txt").write_text("1, 2, 3\n4 5  6\nx\n\n7,8\n")
    assert sorted(map(tuple, clouds.read_points(spark, str(tmp_path / "pts.txt")).collect())) == [(1, 2, 3), (4, 5, 6)]


def test_jsonl(spark, tmp_path):
    m = tmp_path / "scene_a" / "meta"
    m.mkdir(parents=True)
    (m / "episodes.jsonl").write_text('{"episode_index": 0, "tasks": ["a"]}\n\n{bad\n{"episode_index": 2, "tasks": [{"sub_indexes": [0, 4]}]}\n[1]\n{"tasks": []}\n')
    rows = jsonl.read_episodes(spark, str(m / "episodes.jsonl")).orderBy("line_no").collect()
    assert [(r["scene"], r["line_no"], r["episode_index"], json.loads(r["tasks"])) for r in rows] == [("scene_a", 1, 0, ["a"]), ("scene_a", 4, 2, [{"sub_indexes": [0, 4]}])]
    (tmp_path / "done.txt").write_text("e1\n\ne2\ne1\n")
    assert jsonl.read_progress(spark, str(tmp_path / "done.txt")).count() == 2


def test_uav_trajectories(spark, tmp_path):
    rng = np.random.default_rng(0)
    logs = {i: [[float(x) for x in rng.normal(0, 3, 6)] + [t * 0.2] for t in range(5)] for i in "ab"}
    log = lambda i: json.dumps({"raw_logs": logs[i], "instruction": f"go {i}", "instruction_unified": "x"})
    order = [("a", 0), ("a", 2), ("a", 1), ("b", 0), ("b", 1), ("a", 3), ("b", 9)]
    t = pa.table({"id": [i for i, _ in order], "frame_idx": [f for _, f in order], "image": [{"bytes": b"z"}] * 7, "log": [log(i) for i, _ in order]})
    pq.write_table(t, tmp_path / "f.parquet")
    f = uav.trajectories(uav.read_trajectories(spark, str(tmp_path)))
    assert {(r["traj_no"], r["id"]) for r in f.collect()} == {(0, "a"), (1, "b"), (2, "a"), (3, "b")}
    assert all(r["constant"] for r in uav.constant_logs(f).collect())
    rows = {(r["traj_no"], r["frame_idx"]): r for r in uav.states_and_actions(f).collect()}
    assert set(rows) == {(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 3)}
    p0, p1 = np.array(logs["a"][0]), np.array(logs["a"][1])
    c, s = np.cos(np.deg2rad(p0[4])), np.sin(np.deg2rad(p0[4]))
    d = p1[:3] - p0[:3]
    want = [c * d[0] + s * d[1], c * d[1] - s * d[0], d[2]]
    assert np.allclose(rows[(0, 1)]["state"][:3], want) and np.allclose(rows[(0, 0)]["action"][:3], want)
    assert rows[(0, 0)]["state"] == [0.0] * 4 and rows[(0, 0)]["task"] == "go a"


def test_episode_files_nested_or_flat(spark, tmp_path):
    flat = list(map(float, range(16)))
    for scene, v in (("s1", [flat]), ("s2", [[flat[i : i + 4] for i in (0, 4, 8, 12)]])):
        d = tmp_path / scene / "data" / "chunk-000"
        d.mkdir(parents=True)
        pq.write_table(pa.table({"action": v, "relative_goal_frame_id.60cm_15deg": [3]}), d / "episode_000004.parquet")
    for scene in ("s1", "s2"):
        r = episodes.read_frames(spark, str(tmp_path / scene)).first()
        assert r["action"] == flat and r["episode_index"] == 4 and r["scene"] == scene
    df = episodes.read_frames(spark, str(tmp_path / "s1"))
    assert episodes.goal_columns(df) == ["relative_goal_frame_id.60cm_15deg"]
    with pytest.raises(KeyError):
        episodes.goal_columns(spark.range(1))


def test_episode_sink(spark, tmp_path):
    root = str(tmp_path / "out")
    sink.prepare(spark, root, False)
    with pytest.raises(FileExistsError):
        sink.prepare(spark, root, False)
    rows = [(e, f * 2, [float(f)] * 4, 7) for e in (3, 1004) for f in range(5)] + [(None, 0, [0.0], 7)]
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, `observation.state` array<float>, task_index bigint")
    f = sink.with_indexes(df.where("episode_index IS NOT NULL"), 10.0)
    done = sink.write_frames(f, root).orderBy("episode_index").collect()
    assert [(r["path"], r["n_rows"]) for r in done] == [("data/chunk-000/episode_000003.parquet", 5), ("data/chunk-001/episode_001004.parquet", 5)]
    t = pq.read_table(f"{root}/{done[1]['path']}").to_pylist()
    assert [r["frame_index"] for r in t] == list(range(5)) and [r["global_index"] for r in t] == list(range(5, 10)) and t[1]["timestamp"] == 0.1 and t[2]["observation.state"] == [2.0] * 4
    assert sink.missing_files(root, df.where("episode_index IS NOT NULL")).count() == 0
    assert [r["path"] for r in sink.missing_files(root, spark.createDataFrame([(8,)], "episode_index bigint")).collect()] == ["data/chunk-000/episode_000008.parquet"]
    sink.write_jsonl(spark.createDataFrame([(1, "b"), (0, "a")], "task_index int, task string"), f"{root}/meta/tasks.jsonl", ["task_index"])
    assert [json.loads(x) for x in open(f"{root}/meta/tasks.jsonl")] == [{"task_index": 0, "task": "a"}, {"task_index": 1, "task": "b"}]
    sink.write_info(spark, root, {"total_episodes": 1001, "total_frames": 10}, {}, 10, "uav")
    info = json.load(open(f"{root}/meta/info.json"))
    assert info["total_chunks"] == 2 and info["splits"] == {"train": "0:1001"}
    sink.append_progress(spark, f"{root}/p.txt", ["a"])
    sink.append_progress(spark, f"{root}/p.txt", ["b"])
    assert open(f"{root}/p.txt").read() == "a\nb\n"
    out.write_report(spark.range(3), f"{root}/report", [F.desc("id")])
    csv = next(n for n in os.listdir(f"{root}/report") if n.endswith(".csv"))
    assert open(f"{root}/report/{csv}").read() == "id\n2\n1\n0\n"
    got = out.write_images(spark.createDataFrame([("a/b.png", bytearray(b"xy")), (None, None)], "path string, data binary"), root).collect()
    assert [tuple(r) for r in got] == [("a/b.png", 2)] and open(f"{root}/a/b.png", "rb").read() == b"xy"


def test_image_layout():
    assert out.normalise_image(np.ones((3, 4, 5), np.float32)).shape == (4, 5, 3) and out.normalise_image(np.ones((2, 2))).max() == 255


@pytest.mark.skipif(video.av is not None, reason="codec present")
def test_video_says_what_is_missing():
    for call in (lambda: video.video_info("x"), lambda: video.frames_at("x", [0.0], 0.1), lambda: video.encode([], "x", 5)):
        with pytest.raises(images.CodecUnavailable):
            call()


def test_names(spark):
    assert [fn.quota(x) for x in ("inf", "ALL", "-3", "7", "2.0")] == [None, None, 0, 7, 2]
    df = spark.createDataFrame([("a/b-c_d/data/chunk-000/episode_000012_7.png",), ("x",), (None,)], "p string")
    p = F.col("p")
    rows = df.select(fn.episode_of_name(fn.base_name(p)).alias("e"), fn.parent(p).alias("d"), fn.stem_of(p).alias("s"), fn.scene_root(p).alias("r"), fn.last_number(p).alias("n"), fn.file_safe(p).alias("f")).collect()
    assert tuple(rows[0]) == (12, "a/b-c_d/data/chunk-000", "episode_000012_7", "a/b-c_d", 7, "a_b-c_d_data_chunk-000_episode_000012_7_png")
    assert tuple(rows[1])[:4] == (None, "", "x", "") and rows[2]["e"] is None


def test_compact_json_and_numpy_json(spark):
    from pyspark.sql import functions as F

    from helmwake.functions.encoder import PlainEncoder
    from helmwake.operators.tasks import TASKS, compact_json, require_valid

    steps = [{"sub_instruction": "fly 🚁 über \"A\" to 塔", "revised_sub_instruction": "", "sub_indexes": [0, 7]}, {"sum_instruction": "plain", "sum_indexes": [0, 9]}]
    df = spark.createDataFrame([(json.dumps(steps),), (json.dumps(steps[1:]),)], "t string").select(F.from_json("t", TASKS).alias("t"))
    assert [r[0] for r in df.select(compact_json(F.col("t"))).collect()] == [json.dumps(s, separators=(",", ":")) for s in (steps, steps[1:])]
    assert df.select(require_valid(F.col("t")).alias("v")).where("size(v) > 0").count() == 2
    assert json.loads(json.dumps({"a": np.arange(3), "b": np.float32(0.5), "c": [np.int64(2)]}, cls=PlainEncoder)) == {"a": [0, 1, 2], "b": 0.5, "c": [2]}
    with pytest.raises(TypeError):
        json.dumps({"a": object()}, cls=PlainEncoder)


@pytest.mark.parametrize("shape,step", [((7, 5), 1), ((6, 9), 3), ((40, 33), 2), ((1, 4), 4), ((12, 1), 3)])
def test_filters_along_diagonals(shape, step):
    rng = np.random.default_rng(1)
    h, w = shape
    rows = np.c_[rng.integers(0, 5, (h, 1)), rng.integers(0, 256, (h, w * step))].astype(np.uint8)
    want, up = [], np.zeros(w * step, np.uint8)
    for r in rows:
        line = r[1:].copy()
        if r[0] == 1:
            line = np.add.accumulate(line.reshape(w, step), axis=0, dtype=np.uint8).reshape(-1)
        elif r[0] == 2:
            line = line + up
        elif r[0] in (3, 4):
            line = images._unfilter(line, up, step, int(r[0]))
        want.append(line)
        up = line
    assert (images._along_diagonals(rows, step) == np.array(want)).all()


def test_large_image_with_filters_decodes_either_way(monkeypatch):
    import struct
    import zlib

    rng = np.random.default_rng(2)
    h, w = 120, 90
    body = b"".join(bytes([y % 5]) + rng.integers(0, 256, w * 3, dtype=np.uint8).tobytes() for y in range(h))
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    data = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(body)[:500]) + part(b"IDAT", zlib.compress(body)[500:]) + part(b"IEND", b"")
    monkeypatch.setattr(images, "DIAGONALS", 0)
    fast = images.decode_png(data)
    monkeypatch.setattr(images, "DIAGONALS", 10**9)
    assert (fast == images.decode_png(data)).all() and fast.shape == (h, w, 3)


def test_resize():
    px = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    assert (images.resized(px, 4, 4) == px).all() and images.resized(px, 8, 2).shape == (2, 8, 3)
    assert (images.resized(np.full((5, 7), 9, np.uint16), 3, 11) == 9).all()
    assert images.resized(np.array([[0.0, 10.0]]), 4, 1).tolist() == [[0.0, 2.5, 7.5, 10.0]]
