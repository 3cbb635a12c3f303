import math

import numpy as np
from pyspark.sql import functions as F

from helmwake.operators.spikes import flag_spikes
from helmwake.session import table

SCHEMA = "scene string, robot string, episode_index bigint, frame_index bigint, `observation.state` array<float>, action array<float>"


def episodes(n=8, frames=80, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(n):
        v = np.cumsum(rng.normal(0, 0.1, (frames, 4)), axis=0)
        v[:, 2] = 0.0  # never leaves the ground
        v[:, 3] = (np.cumsum(rng.normal(0, 8.0, frames)) + 170 + 180) % 360 - 180
        a = rng.normal(0, 0.05, (frames, 4))
        rows += [["s", "r", e, f, v[f].tolist(), a[f].tolist()] for f in range(frames)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    return {tuple(r) for r in flag_spikes(df).collect()}


S, A = "observation.state", "action"


def test_planted_cases(spark):
    rows = episodes()
    at = {(r[2], r[3]): r for r in rows}
    want = set()

    def put(e, f, field, d, x):
        at[(e, f)][4 if field == S else 5][d] = x
        want.add((e, f, field, d))

    put(0, 10, S, 0, 9.0)
    put(1, 20, S, 1, -7.0), put(1, 21, S, 1, 8.0), put(1, 22, S, 1, -9.0)
    put(2, 30, S, 2, 0.7)
    put(3, 5, A, 0, 65535.0), put(3, 6, A, 0, 65535.0)
    put(4, 40, S, 3, 400.0)
    put(5, 12, A, 2, 1.5)
    held = at[(6, 30)][4][0]
    for f in range(31, 40):
        put(6, f, S, 0, held)
    at[(7, 8)][4] = None
    at[(7, 9)][4][1] = math.nan
    assert run(spark, rows) == want


def test_clean_data_missing_frames_and_copies(spark):
    rows = [r for r in episodes(seed=3) if r[3] % 17 != 5]
    assert run(spark, rows + rows[::3]) == set()


def test_a_level_that_stays_is_no_spike(spark):
    rows = episodes(seed=4)
    for r in rows:
        if r[2] == 1 and r[3] >= 40:
            r[4][0] += 30.0
    assert {x for x in run(spark, rows) if x[0] == 1} == set()


def test_nulls_short_arrays_and_empty(spark):
    rows = episodes(2) + [["s", None, 90, f, [float(f)], None] for f in range(5)] + [["s", "r", None, 1, [1.0], [1.0]], ["s", "r", 91, None, [1.0], [1.0]], ["s", "q", 92, 0, [], []], ["s", "q", 92, 1, [None, 1.0], [2.0]]]
    assert {x for x in run(spark, rows) if x[0] in (90, 91, 92)} == set()
    assert run(spark, [tuple(r) for r in rows[:0]] or []) == set()


def test_blocks_of_a_long_episode(spark):
    n = (1 << 16) + 400
    rng = np.random.default_rng(1)
    x = np.cumsum(rng.normal(0, 0.1, n)).astype(float)
    edge = 1 << 16
    x[edge - 4 : edge + 5] = x[edge - 4]  # a stuck run across the border
    x[edge + 50] += 40
    rows = [("s", "r", 1, i, [float(x[i])], None) for i in range(edge - 3000, n)]
    got = run(spark, rows)
    assert got == {(1, f, S, 0) for f in range(edge - 3, edge + 5)} | {(1, edge + 50, S, 0)}


def test_stuck_runs_over_several_blocks(spark):
    """Readings usually stand for 45 frames here: a run over a border counts with both its parts, each too short alone."""
    edge, rng = 1 << 16, np.random.default_rng(5)
    x = np.repeat(np.cumsum(rng.normal(0, 0.1, 3200)), 45)
    x[edge - 130 : edge + 106] = 77.0 - np.abs(x).max()
    x[edge + 9000 : edge + 9100] = x[edge + 9000]  # too short
    lo, hi = edge - 130, edge + 106
    rows = [("s", "r", 1, i, [float(x[i])], None) for i in range(edge - 40_000, 2 * edge + 2000)]
    got = {r["frame_index"] for r in flag_spikes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == set(range(lo + 1, hi))


def test_whole_blocks_of_one_value(spark):
    edge, rng = 1 << 16, np.random.default_rng(6)
    x = np.cumsum(rng.normal(0, 0.1, 3 * edge + 900))
    x[edge - 100 : 3 * edge + 200] = x[edge - 100]  # two blocks hold nothing else
    rows = [("s", "r", 1, i, [float(x[i])], None) for i in range(edge - 3000, len(x), 7)]
    got = {r["frame_index"] for r in flag_spikes(spark.createDataFrame(rows, SCHEMA)).collect()}
    held = [r[3] for r in rows if edge - 100 <= r[3] < 3 * edge + 200]
    assert got == set(held[1:])


def test_the_ellipsoids_decide():
    """Without the ellipsoid other readings are flagged; with axes that are longer, fewer."""
    from helmwake.operators import spikes

    rng = np.random.default_rng(2)
    v = np.cumsum(rng.normal(0, 0.1, 4000))
    for at in range(50, 3950, 100):
        v[at] += rng.choice([-1, 1]) * rng.uniform(0.2, 6)
    g, t = np.zeros(4000, int), np.arange(4000)
    prof = np.array([0.0, 60.0, 1.2, 2.0, 0.3, 1e3, np.inf])
    kept = spikes._flag(g, t, v, prof, None)[0]
    off, plain = spikes.outside, spikes.outside
    try:
        spikes.outside = lambda u, d, s, prof, wide: np.ones(len(u), bool)
        off = spikes._flag(g, t, v, prof, None)[0]
        spikes.outside = lambda u, d, s, prof, wide: plain(u, d, s, prof * [1, 1, 3, 3, 1, 1, 1], wide)
        long = spikes._flag(g, t, v, prof, None)[0]
    finally:
        spikes.outside = plain
    assert 0 < long.sum() < kept.sum() < off.sum() and off.sum() > 1000


def test_axes_are_taken_again_without_the_spikes(spark):
    """A source whose great spikes hide small ones until the axes are taken anew."""
    rows = episodes(40, seed=9)
    hit = set()
    for i, r in enumerate(rows):
        if i % 50 == 25 and 2 < r[3] < 77:
            r[5][1] += 50.0 if i % 100 == 25 else 4.0
            hit.add((r[2], r[3], A, 1))
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    once, again = ({tuple(x) for x in flag_spikes(df, n).collect()} for n in (0, 1))
    assert 0 < len(once) < len(again) and once < again == hit


def test_clashing_columns(spark, data, clashing):
    t = table(spark, data, "frames")
    want = {tuple(r) for r in flag_spikes(t).collect()}
    assert want and {tuple(r) for r in flag_spikes(clashing(t)).collect()} == want
    assert flag_spikes(t.where(F.lit(False))).count() == 0
