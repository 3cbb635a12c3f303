"""Implausible readings in vector measurements, judged by what is normal for their source.

Phase-space thresholding. A reading between the readings p and q around it is the
point (value, first difference, second difference): u = x - centre, d = the smaller of
|x - p| and |x - q|, s = (x - p) + (x - q). The ellipsoid of normal points has robust
semi-axes per source, field and dimension: MARGIN times the universal threshold
sqrt(2 ln n) times a scale from the median absolute deviation and the 97 % quantile;
in the plane of value and second difference it is turned by their correlation. A
reading outside the ellipsoid is a spike when p and q, put side by side, lie inside.

The axes come from mergeable histograms over all readings. Spikes found are taken out,
within a block until nothing new turns up, and over all data ROUNDS times: the
histograms are taken again from the readings left, and so is the correlation. Long
zero-difference runs are stuck sensors, bounds catch impossible values.

All passes share one exchange by (episode, frame block). Blocks of 2**16 frames overlap
by HALO frames for the differences; pieces of a stuck run at the ends of blocks are put
together afterwards, so a very long episode spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("observation.state", "action")
#: Their names inside the operator, without dots.
INNER = ("state", "action")
#: Dimensions that are angles in degrees and wrap at 180; dimension 3 of the state must lie within.
ANGLES = {"observation.state": {3: 180.0}, "action": {3: 180.0, 7: 180.0}}
BLOCK_BITS, HALO = 16, 128
#: Times the universal threshold; the longest series of spikes; impossible beyond so many times the usual size.
MARGIN, SERIES, FAR_OUT = 2.5, 5, 40.0
#: Passes over all readings after which the axes are taken anew, without the spikes found.
ROUNDS = 1
#: A rare value alone is no spike: the value counts up to this part of its axis; largest correlation used.
VALUE_PART, MOST_TURN = 0.5, 0.8
#: A stuck run is longer than STUCK times the usual run and than STUCK_LEAST readings.
STUCK, STUCK_LEAST = 3.0, 5
#: Sources whose profiles (about 1 kB each) may be broadcast.
MAX_BROADCAST_SOURCES = 20_000
TINY = 1e-6
#: Histograms: steps, sizes, runs, second differences, signed values; sums of the value and the second difference.
STEP, SIZE, RUN, SECOND, VALUE, SUMS = range(6)
#: One source's normal: per (field, dim) centre, the three semi-axes, correlation, bound, longest run.
WIDTH = 7


def _bins(x: np.ndarray) -> np.ndarray:
    """Bin of a number: the exponent and three bits of the fraction, eight bins per doubling, negative for negative numbers."""
    a = np.abs(x)
    b = (np.ascontiguousarray(np.where(a < 1e-7, 0.0, a), dtype=np.float32).view(np.uint32) >> 20).astype(np.int64)
    return np.where(x < 0, -b, b)


def _edge(b: np.ndarray) -> np.ndarray:
    """Number of a bin farthest from 0; 0 for bin 0."""
    a = np.abs(b)
    e = np.where(a == 0, 0.0, (((a.astype(np.uint32) + 1) << 20) - 1).astype(np.uint32).view(np.float32).astype(float))
    return np.where(b < 0, -e, e)


def _dense(col: pa.Array) -> np.ndarray:
    """A list column as a matrix, padded with NaN."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    lens = np.asarray(col.value_lengths().fill_null(0))
    out = np.full((n, int(lens.max()) if n else 0), np.nan)
    rows = np.repeat(np.arange(n), lens)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[rows, at] = np.asarray(col.flatten().fill_null(np.nan), dtype=float)
    return out


class _Chunk:
    """Whole (episode, block) groups of one partition, exact copies taken out."""

    def __init__(self, t: pa.Table):
        self.source = t["robot"]
        e, b, f = (t[c].to_numpy() for c in ("episode_index", "block", "frame_index"))
        mats = [_dense(t[c]) for c in INNER]
        same = np.r_[False, (e[1:] == e[:-1]) & (b[1:] == b[:-1]) & (f[1:] == f[:-1])] if len(e) else np.zeros(0, bool)
        for m in mats:
            same[1:] &= ((m[1:] == m[:-1]) | (np.isnan(m[1:]) & np.isnan(m[:-1]))).all(axis=1)
        keep = ~same
        self.episode, self.block, self.frame = e[keep], b[keep], f[keep]
        self.mats = [m[keep] for m in mats]
        codes, names = pd.factorize(t["robot"].to_pandas())
        self.code, self.names = codes[keep], list(names)
        self.profile = t["profile"] if "profile" in t.column_names else None
        self.keep = keep
        self.group = np.cumsum(np.r_[True, (self.episode[1:] != self.episode[:-1]) | (self.block[1:] != self.block[:-1])]) if len(self.episode) else np.zeros(0, int)


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[_Chunk]:
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        e, k = t["episode_index"].to_numpy(), t["block"].to_numpy()
        cut = np.flatnonzero((e[1:] != e[:-1]) | (k[1:] != k[:-1]))
        if len(cut):
            at = int(cut[-1]) + 1
            yield _Chunk(t.slice(0, at))
            held = t.slice(at).to_batches()
            n = sum(x.num_rows for x in held)
    if n:
        yield _Chunk(pa.Table.from_batches(held))


def _difference(a: np.ndarray, b: np.ndarray, angle: bool) -> np.ndarray:
    d = a - b
    return (d + 180.0) % 360.0 - 180.0 if angle else d


def _points(g: np.ndarray, v: np.ndarray, angle: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the readings with one on either side in their group, and their second differences."""
    i = np.arange(1, len(v) - 1)
    i = i[g[i - 1] == g[i + 1]]
    return i, _difference(v[i], v[i - 1], angle) + _difference(v[i], v[i + 1], angle)


def _profile_of(raw: bytes | None) -> np.ndarray | None:
    return None if raw is None else np.frombuffer(raw, np.float32).reshape(len(FIELDS), -1, WIDTH).astype(float)


def _columns(c: _Chunk) -> Iterator[tuple]:
    """(field, dim, rows, profile or None) of every column of one source in a chunk; rows hold a number."""
    prof = c.profile.combine_chunks() if isinstance(c.profile, pa.ChunkedArray) else c.profile
    kept = np.flatnonzero(c.keep) if prof is not None else None
    for r in np.unique(c.code):
        rows = np.flatnonzero(c.code == r)
        table = _profile_of(prof[int(kept[rows[0]])].as_py()) if prof is not None else None
        for fi, m in enumerate(c.mats):
            for d in range(m.shape[1]):
                ok = rows[~np.isnan(m[rows, d])]
                if len(ok):
                    yield fi, d, ok, (table[fi, d] if table is not None and d < table.shape[1] else None)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of steps, sizes, run lengths, second differences and values by source, field, dimension and bin.

    Each block counts its own frames. Where the rows bring a profile, readings it
    flags are left out of all but sizes and runs, and the sums for the correlation are added.
    """
    total: dict[tuple, np.ndarray] = {}
    sums: dict[tuple, np.ndarray] = {}
    for c in _chunks(batches):
        own_frames = (c.frame >> BLOCK_BITS) == c.block
        for fi, d, rows, prof in _columns(c):
            name = c.names[c.code[rows[0]]] if c.code[rows[0]] >= 0 else None
            angle = ANGLES[FIELDS[fi]].get(d)
            own = rows[own_frames[rows]]
            g, v = c.group[own], c.mats[fi][own, d]
            at = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (g[1:] != g[:-1])]) if len(v) else np.zeros(0, int)
            found = [(SIZE, np.abs(v)), (RUN, np.diff(np.r_[at, len(v)]).astype(float))]
            if prof is not None:
                good = rows[~_flag(c.group[rows], c.frame[rows], c.mats[fi][rows, d], prof, angle)[0]]
                good = good[own_frames[good]]
                g, v = c.group[good], c.mats[fi][good, d]
            step = np.abs(_difference(v[1:], v[:-1], angle is not None))[g[1:] == g[:-1]]
            i, second = _points(g, v, angle is not None)
            for stat, x in (*found, (STEP, step), (SECOND, np.abs(second)), (VALUE, v)):
                if len(x):
                    h = total.setdefault((name, fi, d, stat), np.zeros(4096, np.int64))
                    h += np.bincount(_bins(x) + 2048, minlength=4096)
            if prof is not None and angle is None and len(i):
                u = v[i] - prof[0]
                sums[name, fi, d] = sums.get((name, fi, d), 0.0) + np.array([len(u), u.sum(), second.sum(), (u * u).sum(), (second * second).sum(), (u * second).sum()])
    out = [(name, fi, d, stat, int(b) - 2048, int(h[b]), 0.0) for (name, fi, d, stat), h in total.items() for b in np.flatnonzero(h)]
    out += [(name, fi, d, SUMS, k, 0, float(x)) for (name, fi, d), z in sums.items() for k, x in enumerate(z)]
    if out:
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(x, pa.int64()) for x in cols[1:6]], pa.array(cols[6], pa.float64())], ["robot", "field", "dim", "stat", "bin", "n", "x"])


def _quantile(h: pd.DataFrame, q: float) -> float:
    c = np.cumsum(h["n"].to_numpy())
    return float(_edge(h["bin"].to_numpy())[min(int(np.searchsorted(c, q * c[-1])), len(c) - 1)]) if len(c) else 0.0


def _scale(h: pd.DataFrame) -> float:
    """Robust deviation of a distribution of absolute numbers: from its median, or from its 97 % quantile where the tail is heavy.

    Few readings give few high ones: the quantile leaves out at least as many
    readings as some planted faults would hold.
    """
    n = int(h["n"].sum())
    if not n:
        return 0.0
    q = max(0.5, min(0.97, 1 - 8 / n))
    # normal quantiles of the median and of q, the latter by Tukey's lambda
    p = (1 + q) / 2
    return max(_quantile(h, 0.5) / 0.6745, _quantile(h, q) / (4.91 * (p**0.14 - (1 - p) ** 0.14)))


def _profile(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's normal ellipsoids, bounds and run lengths."""
    dims = int(pdf["dim"].max()) + 1
    out = np.zeros((len(FIELDS), dims, WIDTH), np.float32)
    for (fi, d), x in pdf.sort_values("bin").groupby(["field", "dim"]):
        step, size, run, second, val, sums = (x[x["stat"] == k] for k in range(6))
        moved, n = step[step["bin"] > 0], int(step["n"].sum())
        # a dimension that hardly ever moves has no normal step
        s1 = _scale(moved) if int(moved["n"].sum()) >= max(1, 0.02 * n) else 0.0
        s2 = _scale(second[second["bin"] > 0]) if s1 else 0.0
        centre = _quantile(val, 0.5)
        dev = pd.DataFrame({"bin": _bins(np.abs(_edge(val["bin"].to_numpy()) - centre)), "n": val["n"].to_numpy()}).sort_values("bin")
        reach = MARGIN * np.sqrt(2 * np.log(max(n, 3)))
        # a start or a stop has a second difference as large as its step, and is no spike
        axes = [max(reach * k, TINY) for k in (_scale(dev), s1, max(s2, 2 * s1))]
        z = sums["x"].to_numpy()
        turn = 0.0
        if len(z) == 6 and z[0] > 2:
            vu, vs = z[3] - z[1] ** 2 / z[0], z[4] - z[2] ** 2 / z[0]
            turn = np.clip((z[5] - z[1] * z[2] / z[0]) / np.sqrt(vu * vs), -MOST_TURN, MOST_TURN) if vu > 0 and vs > 0 else 0.0
        big = _quantile(size, max(0.5, min(0.99, 1 - 4 / max(int(size["n"].sum()), 1))))
        usual = _quantile(run, max(0.5, min(0.99, 1 - 2.5 / max(int(run["n"].sum()), 1))))
        limit = max(STUCK_LEAST, STUCK * np.floor(usual)) if s1 else np.inf
        out[fi, d] = (centre, *axes, turn, FAR_OUT * max(big, s1, TINY), limit)
    return pd.DataFrame({"robot": [pdf["robot"].iloc[0]], "dims": [dims], "profile": [out.tobytes()]})


def outside(u: np.ndarray, d: np.ndarray, s: np.ndarray, prof: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Does the point (value from the centre, first, second difference) lie outside the ellipsoid, whose movement axes are ``wide`` times as long?"""
    _, a0, a1, a2, turn, _, _ = prof
    x, y = np.clip(u / a0, -VALUE_PART, VALUE_PART), s / (a2 * wide)
    return (d / (a1 * wide)) ** 2 + (x * x - 2 * turn * x * y + y * y) / (1 - turn * turn) > 1


def _flag(g: np.ndarray, t: np.ndarray, v: np.ndarray, prof: np.ndarray, angle: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Spikes and impossible numbers among the readings ``v`` (no NaN) of the groups ``g`` at the frames ``t``; and the run of each reading."""
    n, wrap = len(v), angle is not None
    centre, _, a1, _, _, bound, limit = prof
    bad = np.abs(v) > bound
    if wrap:
        bad |= np.abs(v) > angle + 1e-3
    which = np.cumsum(np.r_[True, (v[1:] != v[:-1]) | (g[1:] != g[:-1])]) - 1
    long_run = np.bincount(which)[which] > limit
    while True:
        before = int(bad.sum())
        for m in range(1, SERIES + 1):
            idx = np.flatnonzero(~bad)
            if len(idx) < m + 2:
                break
            vv, gg, tt = v[idx], g[idx], t[idx]
            p, q = vv[: -m - 1], vv[m + 1 :]
            wide = np.maximum(1.0, 0.3 * (tt[m + 1 :] - tt[: -m - 1]))
            spike = (gg[: -m - 1] == gg[m + 1 :]) & (np.abs(_difference(q, p, wrap)) <= a1 * wide)
            for k in range(1, m + 1):
                x = vv[k : len(vv) - m - 1 + k]
                first, back = _difference(x, p, wrap), _difference(x, q, wrap)
                u = np.zeros(len(x)) if wrap else x - centre
                spike &= outside(u, np.minimum(np.abs(first), np.abs(back)), first + back, prof, wide)
            for k in range(1, m + 1):
                bad[idx[np.flatnonzero(spike) + k]] = True
        # the first and the last readings of an episode have one side only: the first difference decides
        idx = np.flatnonzero(~bad)
        if len(idx) >= 3:
            vv, gg, tt, lr = v[idx], g[idx], t[idx], long_run[idx]
            far = np.abs(_difference(vv[1:], vv[:-1], wrap)) > a1 * np.maximum(1.0, 0.3 * np.diff(tt))
            same = gg[1:] == gg[:-1]
            jump, calm = same & far & ~lr[1:] & ~lr[:-1], same & ~far
            end, start = np.r_[~same, True], np.r_[True, ~same]
            bad[idx[np.flatnonzero(end[1:] & jump & np.r_[False, calm[:-1]]) + 1]] = True
            bad[idx[np.flatnonzero(start[:-1] & jump & np.r_[calm[1:], False])]] = True
        if int(bad.sum()) == before:
            return bad, which


_FLAGS = "episode_index bigint, field_name string, dim int, block bigint, side int, value float, n bigint, whole boolean, enough double, frames array<bigint>"
#: Sides of a block on which a run may go on.
ALL, LEAD, TAIL = 0, 1, 2


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flagged frames of each block, and as rows of their own the runs at those ends beyond which the episode goes on."""
    mask = (1 << BLOCK_BITS) - 1
    for c in _chunks(batches):
        own_frames = (c.frame >> BLOCK_BITS) == c.block
        out: list[tuple] = []
        for fi, d, rows, prof in _columns(c):
            if prof is None:
                continue
            g, v, limit = c.group[rows], c.mats[fi][rows, d], prof[6]
            bad, which = _flag(g, c.frame[rows], v, prof, ANGLES[FIELDS[fi]].get(d))
            own = own_frames[rows]
            o = np.flatnonzero(own)
            if not len(o):
                continue
            new = np.r_[True, which[o][1:] != which[o][:-1]]
            length = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
            stuck = (length > limit) & ~new
            if np.isfinite(limit) and (c.block[rows[o]].any() or (c.frame[rows[o]] & mask).max() > mask - HALO or len(o) < len(rows)):
                for k in np.unique(g[o]):
                    mine = o[g[o] == k]
                    block = int(c.block[rows[mine[0]]])
                    more = bool((g[~own] == k).any()) and bool((c.frame[rows[(g == k) & ~own]] >> BLOCK_BITS > block).any())
                    w = which[mine]
                    for side, there, run in ((LEAD, block > 0, w == w[0]), (TAIL, more, w == w[-1])):
                        if there:
                            whole = bool(run.all())
                            out.append((int(c.episode[rows[mine[0]]]), fi, d, block, side, float(v[mine[run][0]]), int(run.sum()), whole, float(limit), c.frame[rows[mine[run]]].tolist()))
            hit = o[bad[o] | stuck]
            if len(hit):
                cut = np.flatnonzero(np.r_[True, g[hit][1:] != g[hit][:-1]])
                for a, z in zip(cut, np.r_[cut[1:], len(hit)]):
                    r = rows[hit[a:z]]
                    out.append((int(c.episode[r[0]]), fi, d, int(c.block[r[0]]), ALL, None, None, None, None, c.frame[r].tolist()))
        if out:
            z = list(zip(*out))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.float32(), pa.int64(), pa.bool_(), pa.float64(), pa.list_(pa.int64())]
            z[1] = [FIELDS[i] for i in z[1]]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(z, kinds)], [f.split()[0] for f in _FLAGS.split(", ")])


def _joined_runs(found: DataFrame) -> DataFrame:
    """Frames of the flags and of those runs that are stuck once their pieces of successive blocks are put together.

    A block that is one run as a whole has a leading and a trailing piece of the same
    frames, which count once. One exchange serves this and the removal of copies.
    """
    key = ["episode_index", "field_name", "dim"]
    w = Window.partitionBy(*key).orderBy("side_known", "block", "side")
    f = found.repartition(*key).withColumn("side_known", F.col("side") > ALL)
    before = lambda c: F.lag(c).over(w)
    goes_on = before("side_known") & (F.col("value") == before("value")) & (((F.col("side") == LEAD) & (before("side") == TAIL) & (before("block") == F.col("block") - 1)) | ((F.col("side") == TAIL) & F.col("whole") & (before("block") == F.col("block"))))
    f = f.withColumn("run", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    again = F.col("whole") & (F.col("side") == TAIL) & (F.lag("side").over(w) == LEAD) & (F.lag("block").over(w) == F.col("block"))
    f = f.withColumn("n", F.when(again, 0).otherwise(F.col("n")))
    run = Window.partitionBy(*key, "run")
    f = f.withColumn("total", F.sum("n").over(run)).withColumn("first", F.min(F.array_min("frames")).over(run))
    f = f.where((F.col("side") == ALL) | (F.col("total") > F.col("enough")))
    f = f.select(*key, F.col("side"), F.col("first"), F.explode("frames").alias("frame_index")).where((F.col("side") == ALL) | (F.col("frame_index") > F.col("first")))
    return f.select("episode_index", "frame_index", "field_name", "dim").distinct()


def _exchanged(frames: DataFrame) -> DataFrame:
    """The readings by (episode, block), with copies of the frames near a block's ends in the block beside it."""
    state, action = (F.col(f"`{c}`").cast("array<float>").alias(i) for c, i in zip(FIELDS, INNER))
    x = frames.where("episode_index IS NOT NULL AND frame_index IS NOT NULL").select(F.coalesce("robot", F.lit("")).alias("robot"), F.col("episode_index").cast("bigint").alias("episode_index"), F.col("frame_index").cast("bigint").alias("frame_index"), state, action)
    mask = (1 << BLOCK_BITS) - 1
    b, at = f"shiftright(frame_index, {BLOCK_BITS})", f"(frame_index & {mask})"
    blocks = f"CASE WHEN {b} > 0 AND {at} < {HALO} THEN array({b}, {b} - 1) WHEN {at} >= {mask + 1 - HALO} THEN array({b}, {b} + 1) ELSE array({b}) END"
    x = x.select("*", F.explode(F.expr(blocks)).alias("block"))
    return x.repartition("episode_index", "block")


def profiles(exchanged: DataFrame) -> DataFrame:
    """(robot, dims, profile): what is normal for each source; without what a profile on the rows flags."""
    h = exchanged.sortWithinPartitions("episode_index", "block", "frame_index", *INNER).mapInArrow(_histograms, "robot string, field bigint, dim bigint, stat bigint, bin bigint, n bigint, x double")
    h = h.groupBy("robot", "field", "dim", "stat", "bin").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    # at most 4096 bins per statistic: a source's group is bounded however many readings it has
    return h.groupBy("robot").applyInPandas(_profile, "robot string, dims bigint, profile binary")


def flag_spikes(frames: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Implausible numbers of ``observation.state`` and ``action``: episode_index, frame_index, field_name, dim.

    Flags isolated readings and series of up to SERIES that lie outside the source's
    ellipsoid while the readings around them fit, numbers the quantity cannot
    take, and every reading after the first of an unusually long run of equal
    readings. Null arrays, null and NaN numbers are no readings; missing frames
    widen what is allowed; wrapping angles are one step. Exact copies count once;
    rows with a null episode or frame are left out; a null robot is a source of
    its own; arrays may differ in length; no rows give no rows.
    """
    x = _exchanged(frames)
    sources = frames.agg(F.approx_count_distinct("robot").alias("n")).first()["n"]

    def known(of: DataFrame) -> DataFrame:
        prof = profiles(of).select("robot", "profile")
        if sources <= MAX_BROADCAST_SOURCES:
            return x.join(F.broadcast(prof), "robot", "left")
        return x.join(prof, "robot", "left").repartition("episode_index", "block")

    j = known(x)
    for _ in range(rounds):
        j = known(j)
    j = j.sortWithinPartitions("episode_index", "block", "frame_index", *INNER)
    return _joined_runs(j.mapInArrow(_flags, _FLAGS))
