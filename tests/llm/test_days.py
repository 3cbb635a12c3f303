"""A query of the percentiles over a directory of tables: the digests of days come first."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry

FRAMES = pa.schema([("scene", pa.string()), ("robot", pa.string()), ("episode_index", pa.int64()), ("frame_index", pa.int64()), ("timestamp", pa.float64()), ("task_index", pa.int64()), ("observation.state", pa.list_(pa.float32())), ("action", pa.list_(pa.float32()))])


def frame(ep, f, state):
    return {"scene": "s", "robot": "r", "episode_index": ep, "frame_index": f, "timestamp": f * 0.1, "task_index": 0, "observation.state": state, "action": [0.0] * 4}


def test_percentiles_are_merged_from_days(spark, tmp_path, monkeypatch):
    from datetime import datetime

    from helmwake.llm import quantiles

    made = []
    plain = quantiles.digests
    monkeypatch.setattr(quantiles, "digests", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    rng = np.random.default_rng(6)
    rows = [frame(e, f, [float(x) for x in rng.normal(e, 1, 4)]) | {"scene": f"s{e % 3}", "robot": f"r{e % 2}", "recorded_at": datetime(2024, 1, 1 + e % 5, 12)} for e in range(12) for f in range(30)]
    t = pa.Table.from_pylist(rows + rows[:50], FRAMES.append(pa.field("recorded_at", pa.timestamp("us"))))
    pq.write_table(t, tmp_path / "frames.parquet")
    got = {(r["source"], r["dim"]): r for r in entry.queries()["p2_percentiles"](spark, str(tmp_path)).collect() if r["field_name"] == "observation.state" and r["q"] == 0.5}
    for at in ("scene", "robot"):
        for s in {r[at] for r in rows}:
            for d in range(4):
                v = sorted(np.float32(r["observation.state"][d]) for r in rows if r[at] == s)
                g = got[s, d]
                assert g["n"] == len(v) and abs(v.index(np.float32(g["value"])) + 1 - 0.5 * len(v)) <= g["rank_error"] + 1
    days = made[0].groupBy("robot", "scene", "day", "field_name", "dim").count().collect()
    assert {r["day"] for r in days} == {f"2024-01-0{k}" for k in range(1, 6)} and all(r["count"] == 1 for r in days)
