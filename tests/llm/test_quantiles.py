import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helmwake.llm.quantiles import KEYS, LEVELS, compress, digests, distinct_readings, frame_percentiles, leaf, merge, pack, percentiles, ranked, unpack, value
from helmwake.session import table


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(width=32, allow_nan=False), min_size=1, max_size=50))
def test_leaves_keep_order_and_value(xs):
    x = np.array(xs, np.float32)
    assert (np.argsort(leaf(x), kind="stable") == np.argsort(x, kind="stable")).all()
    assert (value(leaf(x)) == x).all()


def error(values, x, c, q):
    v = np.sort(values)
    got = ranked(x, c, [q])[0]
    lo, hi = np.searchsorted(v, got, "left"), np.searchsorted(v, got, "right")
    return max(0.0, lo - q * len(v), q * len(v) - hi)


def test_rank_error_is_bounded_also_after_merging():
    rng = np.random.default_rng(0)
    eps = 0.02
    parts = [rng.normal(0, 1, 20_000), rng.exponential(5, 30_000), np.full(10_000, 2.5), rng.integers(0, 5, 15_000).astype(float)]
    done = []
    for p in parts:
        g, x, c = compress(np.zeros(len(p), int), leaf(p) + np.uint64(1 << 32), np.ones(len(p), int), eps)
        assert c.sum() == len(p) and len(x) < 3 * LEVELS / eps + LEVELS
        x2, c2 = unpack(pack(x, c))
        assert (x2 == x).all() and (c2 == c).all()
        done.append((x, c))
    whole = np.concatenate(parts).astype(np.float32)
    x, c = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    _, x, c = compress(np.zeros(len(x), int), x, c, eps)
    for q in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0):
        assert error(whole, x, c, q) <= 2 * eps * len(whole) + 1
    assert c.sum() == len(whole)


def test_groups_do_not_mix():
    g = np.array([0, 1, 0, 1, 2])
    x = leaf(np.array([1.0, 2.0, 1.0, 2.0, 3.0])) + np.uint64(1 << 32)
    a, b, c = compress(g, x, np.ones(5, int), 0.001)
    assert a.tolist() == [0, 1, 2] and c.tolist() == [2, 2, 1]


def frames(spark, rows):
    return spark.createDataFrame(rows, "scene string, robot string, episode_index bigint, frame_index bigint, `observation.state` array<float>, action array<float>, recorded_at timestamp").withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


def test_days_combine_into_all_days(spark, data):
    t = distinct_readings(table(spark, data, "frames"))
    keys = ["scene", "field_name", "dim"]
    days = digests(t, by_day=True)
    assert days.select("day").distinct().count() > 1
    per_day = merge(days, KEYS)
    a = {tuple(r[:4]): (r["value"], r["n"]) for r in percentiles(merge(per_day, keys), keys).collect()}
    b = {tuple(r[:4]): (r["value"], r["n"]) for r in percentiles(merge(digests(t, by_day=False), keys), keys).collect()}
    assert a == b and a  # small groups are exact


def test_exact_on_small_groups_copies_once(spark, data, clashing):
    t = table(spark, data, "frames")
    got = {(r["source"], r["field_name"], r["dim"]): r for r in frame_percentiles(t, [0.5]).where("source_kind = 'robot'").collect()}
    rows = {(r["robot"], r["episode_index"], r["frame_index"], tuple(map(str, r["observation.state"] or []))): r["observation.state"] for r in t.collect()}
    by = {}
    for (robot, *_), s in rows.items():
        for d, x in enumerate(s or []):
            if not math.isnan(x):
                by.setdefault((robot, "observation.state", d), []).append(x)
    for k, v in by.items():
        v.sort()
        assert got[k]["n"] == len(v)
        at = v.index(got[k]["value"])
        assert abs(at + 1 - 0.5 * len(v)) <= got[k]["rank_error"] + v.count(got[k]["value"])
    assert frame_percentiles(clashing(t), [0.5]).count() == frame_percentiles(t, [0.5]).count()


def test_nulls_nan_infinity_ties_and_empty(spark):
    inf = math.inf
    df = frames(spark, [("s", "r", 1, 0, [1.0, math.nan], None, None), ("s", "r", 1, 1, [1.0, None], [], None), ("s", "r", 1, 2, [inf, -inf], [2.0], None), (None, None, None, None, [7.0], None, None)])
    rows = {(r["source_kind"], r["source"], r["field_name"], r["dim"], r["q"]): (r["value"], r["n"]) for r in frame_percentiles(df, [0.5, 1.0]).collect()}
    assert rows[("robot", "r", "observation.state", 0, 0.5)] == (1.0, 3) and rows[("robot", "r", "observation.state", 0, 1.0)] == (inf, 3)
    assert rows[("scene", "s", "observation.state", 1, 0.5)] == (-inf, 1) and rows[("robot", None, "observation.state", 0, 0.5)] == (7.0, 1)
    assert frame_percentiles(df.limit(0)).count() == 0


def test_two_thousand_saturated_keys(monkeypatch):
    """Memory follows the nodes in work, and the compressions the input; sorted keys come out once, others right, too."""
    import pyarrow as pa

    from helmwake.llm import quantiles as q

    eps, rng, work = 0.1, np.random.default_rng(1), []
    plain = q.compress
    monkeypatch.setattr(q, "HELD", 60_000)
    monkeypatch.setattr(q, "KEPT", 30_000)
    monkeypatch.setattr(q, "compress", lambda g, x, c, epsilon: work.append(len(x)) or plain(g, x, c, epsilon))
    values = rng.normal(0, 1, (2000, 400)).astype(np.float32)

    def batches(order):
        for part in np.array_split(order, 100):
            day = pa.array([f"d{k:04d}" for k in part // 400])
            name = pa.array(["r"] * len(part))
            nums = pa.array([[float(v)] for v in values.reshape(-1)[part]], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([name, name, day, nums, pa.nulls(len(part), pa.list_(pa.float32()))], ["robot", "scene", "day", "state", "action"])

    for order in (np.arange(800_000), rng.permutation(800_000)):
        work.clear()
        got = {}
        for b in q._partial(eps)(batches(order)):
            for r in b.to_pylist():
                got.setdefault(r["day"], []).append(r)
        assert len(got) == 2000 and all(sum(r["n"] for r in v) == 400 for v in got.values())
        for k in (0, 777, 1999):
            x, c = (np.concatenate(z) for z in zip(*[q.unpack(r["digest"]) for r in got[f"d{k:04d}"]]))
            assert error(values[k], x, c, 0.5) <= 2 * eps * 400 + 1
        assert sum(work) < 6 * 800_000
        assert max(work) < 500_000 and (order[1] != 1 or max(map(len, got.values())) <= 2)
