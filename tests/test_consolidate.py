import glob

from pyspark.sql import functions as F

from helmwake.operators.consolidate import complete_png, consolidate, entries, merged, surplus
from helmwake.session import table
from helmwake.sinks.files import png_bytes

import numpy as np

SCHEMA = "file_id bigint, path string, n_bytes bigint, modified_at timestamp_ntz, `observation.images.rgb` binary, `observation.images.depth` binary"
PNG = png_bytes(np.arange(48, dtype=np.uint8).reshape(4, 4, 3))
STEM = "s/videos/chunk-000/observation.images.rgb/"


def files(spark, rows):
    return spark.createDataFrame([(i, p, len(b) if b is not None else None, None, bytearray(b) if b is not None and "depth" not in (p or "") else None, bytearray(b) if b is not None and "depth" in (p or "") else None) for i, p, b in rows], SCHEMA.replace("timestamp_ntz", "timestamp"))


def test_same_image_whatever_the_path(spark):
    ps = ["episode_000007_4.png", "episode_000007_0004.png", "retry_2/episode_000007_4.png", "episode_000007_4 (1).png", "episode_000007_4.png.part", "episode_000007_4.PNG"]
    rows = [(10 + i, STEM + p, PNG if i == 3 else PNG[:20]) for i, p in enumerate(ps)]
    rows += [(5, "." + "/s//videos/chunk-000/observation.images.rgb/episode_000007_4.png", b""), (30, (STEM + ps[0]).replace("/", "\\"), PNG)]
    rows += [(40, STEM.replace("rgb", "depth") + ps[0], PNG), (41, STEM + "episode_000007_40.png", PNG), (42, STEM + "episode_000070_4.png", PNG)]
    df = files(spark, rows)
    assert {tuple(r) for r in surplus(df).collect()} == {(5, x) for x in (10, 11, 12, 13, 14, 15, 30)}
    m = {(r["image_key"], r["episode_index"], r["frame_index"]): r for r in merged(df).collect()}
    assert m[("rgb", 7, 4)]["n_entries"] == 8 and m[("rgb", 7, 4)]["kept_file_id"] == 13 and m[("rgb", 7, 4)]["kept_complete"]
    assert len(m) == 4


def test_nothing_lost_nothing_doubled(spark, tmp_path):
    rows = [(i, STEM + f"episode_{i % 50:06d}_{i % 7}.png", PNG if i % 3 else PNG[:30]) for i in range(700)] + [(900, "odd name", PNG), (901, None, PNG)]
    out = str(tmp_path / "out")
    man = consolidate(files(spark, rows), out, 4 * len(PNG)).collect()
    got = spark.read.parquet(out)
    assert got.where("out_file >= 0").count() == 350 and got.where("out_file = -1").count() == 2
    assert got.where("out_file >= 0").select("episode_index", "frame_index").distinct().count() == 350
    assert got.where("out_file >= 0 AND NOT complete").count() == 0
    assert sum(r["n_images"] for r in man) == 352
    sizes = [r["n_bytes"] for r in man if r["out_file"] >= 0]
    assert max(sizes) <= 5 * len(PNG)
    assert len(glob.glob(out + "/*/*/*.parquet")) == len(man)
    spans = sorted((r["first_episode"], r["first_frame"], r["last_episode"], r["last_frame"]) for r in man if r["out_file"] >= 0)
    assert all(a[2:] < b[:2] for a, b in zip(spans, spans[1:]))


def test_empty_null_and_complete(spark, data, clashing):
    t = table(spark, data, "image_files")
    assert surplus(t.limit(0)).count() == 0
    assert {tuple(r) for r in surplus(clashing(t)).collect()} == {tuple(r) for r in surplus(t).collect()}
    b = spark.createDataFrame([(bytearray(PNG),), (bytearray(PNG[:-1]),), (bytearray(b""),), (None,)], "b binary").select(complete_png(F.col("b")).alias("c"))
    assert [r["c"] for r in b.collect()] == [True, False, False, False]
    assert entries(files(spark, [(1, None, PNG)])).first()["image_key"] == "rgb"


def test_entry_delivered_twice_is_no_surplus(spark):
    df = files(spark, [(1, STEM + "episode_000001_1.png", PNG)] * 2)
    assert surplus(df).count() == 0


def test_many_ranges_levels_and_a_hot_image(spark, monkeypatch, tmp_path):
    """A third of all entries are of one image; small ranges and fan-in make parts and levels."""
    from helmwake.operators import consolidate as c

    rng = np.random.default_rng(7)
    rows = [(i, STEM + (f"episode_000003_5.png" if i % 3 == 0 else f"episode_{rng.integers(0, 30):06d}_{rng.integers(0, 9)}.png"), PNG if rng.random() < 0.5 else PNG[:20]) for i in rng.permutation(3000).tolist()]
    df = files(spark, rows).repartition(9)
    by = {}
    for i, p, b in rows:
        by.setdefault(p, []).append((b != PNG, -len(b), i))
    monkeypatch.setattr(c, "RANGE_ROWS", 150)
    monkeypatch.setattr(c, "FAN_IN", 2)
    got = [tuple(r) for r in surplus(df).collect()]
    assert sorted(got) == sorted((min(x[2] for x in v), x[2]) for v in by.values() for x in v if x[2] != min(y[2] for y in v))
    monkeypatch.setattr(c, "RANGE_FILES", 2)
    out = str(tmp_path / "out")
    man = consolidate(df, out, 10 * len(PNG))
    back = spark.read.parquet(out)
    assert {r["file_id"] for r in back.collect()} == {min(v)[2] for v in by.values()} and back.count() == len(by)
    assert man.count() > 10 and {tuple(r) for r in man.collect()} == {tuple(r) for r in c.manifest(back).collect()}
    assert max(r["n_bytes"] for r in man.collect()) <= 10 * len(PNG)
    spans = sorted((r["first_episode"], r["first_frame"], r["last_episode"], r["last_frame"]) for r in man.collect())
    assert all(a[2:] < b[:2] for a, b in zip(spans, spans[1:]))


def test_merge_keeps_repeated_rows_in_order(spark, tmp_path):
    from helmwake.operators import runs as rn

    rows = spark.createDataFrame([(i * 7 % 40, i % 11) for i in range(500)] * 2, "o bigint, id bigint").repartition(5)
    runs = rn.write_runs(rows, ["o", "id"], str(tmp_path / "r"))
    t = [x for part in rn.merge(runs, {"lo": 3, "hi": 30, "part": 0, "parts": 1}) for x in zip(part["o"].to_pylist(), part["id"].to_pylist())]
    assert t == sorted((r["o"], r["id"]) for r in rows.collect() if 3 <= r["o"] < 30) and len(runs) == 5
