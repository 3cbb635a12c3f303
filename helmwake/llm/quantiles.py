"""Percentiles of very large numeric columns with a deterministic rank error.

Values are float32 numbers mapped to 32-bit integers in their order, a bounded
universe of 2**32 leaves. A digest holds counts on nodes of the binary tree over
it. Compression moves the counts of a node and its sibling to their parent while
the three together hold no more than n / k values; so any path holds at most
32 * floor(n / k) values that are placed too high, which is the rank error.
Digests of separate partitions, days or scenes are merged by adding the counts of
equal nodes; the error bounds add up, so the relative bound stays the same.

A digest travels as one binary: node numbers and counts, delta coded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 32
#: Relative rank error: a reported value's rank is off by no more than EPSILON * n.
EPSILON = 0.005
FIELDS = ("observation.state", "action")
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
#: Partial digests one merging task takes at a time (at most some 200 kB each); more are merged in steps.
FAN_IN = 256
#: Nodes a task holds before it compresses them, and how many may be left before it puts out the digests that are done.
HELD, KEPT = 8_000_000, 4_000_000


def leaf(x: np.ndarray) -> np.ndarray:
    """The number of each float32 in their order; -0 is 0."""
    b = (np.asarray(x, np.float32) + np.float32(0)).view(np.uint32)
    return np.where(b >> 31, ~b, b | np.uint32(1 << 31)).astype(np.uint64)


def value(k: np.ndarray) -> np.ndarray:
    """The float32 of each leaf number."""
    k = np.asarray(k, np.uint32)
    return np.where(k >> 31, k & np.uint32((1 << 31) - 1), ~k).astype(np.uint32).view(np.float32)


def _sum_by(group: np.ndarray, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((node, group))
    group, node, count = group[order], node[order], count[order]
    if not len(node):
        return group, node, count
    at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (node[1:] != node[:-1])])
    return group[at], node[at], np.add.reduceat(count, at)


def compress(group: np.ndarray, node: np.ndarray, count: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of many groups at once: equal nodes added, then counts moved up from the leaves.

    Node numbers are those of a heap: the root is 1, the leaf of number x is
    2**32 + x. Groups are numbered from 0. The result is sorted by group and node.
    """
    group, node, count = _sum_by(group.astype(np.int64), node.astype(np.uint64), count.astype(np.int64))
    if not len(node):
        return group, node, count
    n = np.bincount(group, weights=count).astype(np.int64)
    limit = np.floor(n * epsilon / LEVELS).astype(np.int64)
    active = limit[group] >= 1
    done = [(group[~active], node[~active], count[~active])]
    group, node, count = group[active], node[active], count[active]
    for level in range(LEVELS, 0, -1):
        if not len(node):
            break
        here = node >= np.uint64(1 << level)
        if not here.any():
            continue
        g, x, c = group[here], node[here], count[here]
        pg, px, pc = _sum_by(np.r_[g, group[~here]], np.r_[x >> np.uint64(1), node[~here]], np.r_[c, np.zeros((~here).sum(), np.int64)])
        og, ox, oc = group[~here], node[~here], count[~here]
        # the parent's own count, where it is a node already
        own = _lookup(og, ox, oc, pg, px)
        fits = (pc > 0) & (pc + own <= limit[pg])
        up = _member(pg[fits], px[fits], g, x >> np.uint64(1))
        done.append((g[~up], x[~up], c[~up]))
        group, node, count = _sum_by(np.r_[og, g[up]], np.r_[ox, x[up] >> np.uint64(1)], np.r_[oc, c[up]])
    done.append((group, node, count))
    return _sum_by(*(np.concatenate(z) for z in zip(*done)))


def _pack(g: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (g.astype(np.uint64) << np.uint64(33)) | x


def _lookup(g: np.ndarray, x: np.ndarray, c: np.ndarray, pg: np.ndarray, px: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros(len(px), np.int64)
    key, want = _pack(g, x), _pack(pg, px)
    at = np.minimum(np.searchsorted(key, want), len(key) - 1)
    return np.where(key[at] == want, c[at], 0)


def _member(pg: np.ndarray, px: np.ndarray, g: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(px):
        return np.zeros(len(x), bool)
    key, want = _pack(pg, px), _pack(g, x)
    return key[np.minimum(np.searchsorted(key, want), len(key) - 1)] == want


def pack(node: np.ndarray, count: np.ndarray) -> bytes:
    d = np.diff(node.astype(np.int64), prepend=np.int64(0))
    return zlib.compress(np.r_[np.int64(len(d)), d, count.astype(np.int64)].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T.tobytes(), "<i8")
    n = int(a[0])
    return np.cumsum(a[1 : n + 1]).astype(np.uint64), a[n + 1 : 2 * n + 1].copy()


def ranked(node: np.ndarray, count: np.ndarray, qs: Sequence[float]) -> np.ndarray:
    """The values at the fractions ``qs``: the right end of the node where the count in order of right ends, small nodes first, reaches it."""
    level = np.floor(np.log2(node.astype(float))).astype(np.int64)
    width = np.uint64(1) << (LEVELS - level).astype(np.uint64)
    right = (node - (np.uint64(1) << level.astype(np.uint64)) + np.uint64(1)) * width - np.uint64(1)
    order = np.lexsort((width, right))
    c = np.cumsum(count[order])
    at = np.searchsorted(c, np.maximum(1, np.ceil(np.asarray(qs) * c[-1])))
    return value(right[order][np.minimum(at, len(c) - 1)])


KEYS = ["robot", "scene", "day", "field_name", "dim"]
_DIGEST = "robot string, scene string, day string, field_name string, dim int, n bigint, digest binary"


def _partial(epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]] = []
        size = base = 0
        for b in batches:
            labels, first, parts = [], 0, []
            keys = pd.DataFrame({c: b.column(c).to_pandas() for c in ("robot", "scene", "day")})
            code, uniq = pd.factorize(pd.MultiIndex.from_frame(keys), use_na_sentinel=False)
            rows = uniq.to_frame(index=False)
            rows.columns = ["robot", "scene", "day"]
            for fi, name in enumerate(("state", "action")):
                col = b.column(name)
                lens = np.asarray(col.value_lengths().fill_null(0))
                if not lens.sum():
                    continue
                at = np.repeat(np.arange(len(col)), lens)
                dim = np.arange(len(at)) - np.repeat(np.cumsum(lens) - lens, lens)
                v = np.asarray(col.flatten().fill_null(np.nan), np.float32)
                ok = ~np.isnan(v)
                width = int(lens.max())
                g = code[at][ok] * width + dim[ok]
                parts.append((g + first, leaf(v[ok]) + np.uint64(1 << 32), np.ones(int(ok.sum()), np.int64)))
                label = rows.loc[rows.index.repeat(width)].reset_index(drop=True)
                label["field_name"], label["dim"] = FIELDS[fi], np.tile(np.arange(width), len(rows))
                labels.append(label)
                first += len(label)
            if parts:
                g, x, c = compress(*(np.concatenate(z) for z in zip(*parts)), epsilon=epsilon)
                held.append((pd.concat(labels, ignore_index=True), g, x, c))
                size += len(x)
            # what is left doubles before it is compressed again, so the work stays in proportion to the input
            if size > max(HELD, 2 * base):
                done, open_ = _closed(_joined(held, epsilon), rows, KEPT)
                yield from _batches(*done)
                held = [open_]
                size = base = len(open_[2])
        if held:
            yield from _batches(*_joined(held, epsilon))

    return run


def _joined(held: list[tuple], epsilon: float) -> tuple:
    """Digests of the same key, added and compressed."""
    labels = pd.concat([h[0] for h in held], ignore_index=True)
    code, uniq = pd.factorize(pd.MultiIndex.from_frame(labels[KEYS]), use_na_sentinel=False)
    shift = np.cumsum([0, *[len(h[0]) for h in held]])
    g = np.concatenate([code[h[1] + s] for h, s in zip(held, shift)])
    frame = uniq.to_frame(index=False)
    frame.columns = KEYS
    return (frame, *compress(g, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]), epsilon))


def _closed(all_: tuple, last: pd.DataFrame, kept: int) -> tuple[tuple, tuple]:
    """Digests to put out, and those to go on with: all of them; beyond ``kept`` nodes those of the last batch's keys; none where these are too many."""
    frame, g, x, c = all_
    if len(x) <= kept:
        return (frame, g[:0], x[:0], c[:0]), all_
    both = pd.concat([last, frame[["robot", "scene", "day"]]], ignore_index=True)
    code, _ = pd.factorize(pd.MultiIndex.from_frame(both), use_na_sentinel=False)
    stays = np.isin(code[len(last) :], code[: len(last)])[g]
    stays &= stays.sum() <= kept
    return (frame, g[~stays], x[~stays], c[~stays]), (frame, g[stays], x[stays], c[stays])


def _batches(labels: pd.DataFrame, g: np.ndarray, x: np.ndarray, c: np.ndarray, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    if not len(x):
        return
    at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    ends = np.r_[at[1:], len(g)]
    total = np.add.reduceat(c, at)
    schema = pa.schema([("robot", pa.string()), ("scene", pa.string()), ("day", pa.string()), ("field_name", pa.string()), ("dim", pa.int32()), ("n", pa.int64()), ("digest", pa.binary())])
    for i in range(0, len(at), rows):
        part = labels.iloc[g[at[i : i + rows]]]
        cols = [pa.array([None if pd.isna(z) else z for z in part[k]], schema.field(k).type) for k in KEYS[:4]]
        packed = [pack(x[a:b], c[a:b]) for a, b in zip(at[i : i + rows], ends[i : i + rows])]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(part["dim"].to_numpy(), pa.int32()), pa.array(total[i : i + rows], pa.int64()), pa.array(packed, pa.binary())], schema=schema)


def distinct_readings(frames: DataFrame) -> DataFrame:
    """The frames without exact copies of one (episode_index, frame_index), as robot, scene, day, state, action.

    All rows of a robot, scene and day come to one task, so its day's digest is made there.
    """
    state, action = (F.col(f"`{c}`").cast("array<float>") for c in FIELDS)
    x = frames.select("episode_index", "frame_index", "robot", "scene", F.date_format("recorded_at", "yyyy-MM-dd").alias("day"), state.alias("state"), action.alias("action"))
    # a digest of the content keeps frames apart that share a name but differ
    x = x.withColumn("h", F.xxhash64("robot", "scene", "day", "state", "action")).repartition("robot", "scene", "day")
    one = x.dropDuplicates(["robot", "scene", "day", "episode_index", "frame_index", "h"])
    # in order of the keys, a task needs to hold few of them; the removal of copies has sorted already
    return one.sortWithinPartitions("robot", "scene", "day").select("robot", "scene", "day", "state", "action")


def digests(readings: DataFrame, by_day: bool = True, epsilon: float = EPSILON) -> DataFrame:
    """Digests of each (robot, scene, day, field_name, dim): n and digest, one row per key and task.

    ``readings`` has robot, scene, day and the float arrays state and action. Null
    arrays, null and NaN numbers are no values; infinities are. Null keys are keys
    of their own. Every task adds up its own rows first; rows of equal keys from
    several tasks are merged by ``merge``. With ``by_day`` off all days share a null day.
    """
    r = readings if by_day else readings.withColumn("day", F.lit(None).cast("string"))
    return r.select("robot", "scene", "day", "state", "action").mapInArrow(_partial(epsilon), _DIGEST)


def _merge_step(epsilon: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) == 1:
            return pdf
        parts = [unpack(d) for d in pdf["digest"]]
        x, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        _, x, c = compress(np.zeros(len(x), np.int64), x, c, epsilon)
        return pdf.iloc[:1].assign(n=int(pdf["n"].sum()), digest=[pack(x, c)])

    return run


def merge(parts: DataFrame, keys: Sequence[str], epsilon: float = EPSILON, most: int | None = None) -> DataFrame:
    """One digest per key from any number of digests, by adding nodes and compressing.

    Partial digests of one key are merged about FAN_IN at a time by many tasks,
    then the results; each is of bounded size, so no task gets more than it can
    hold. ``most`` is a bound of the digests per key, where one is known; up to
    FAN_IN of them need no first step.
    """
    keys = list(keys)
    p = parts.select(*keys, "n", "digest")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema.fields)
    groups = FAN_IN if most is None else -(-most // FAN_IN)
    if groups > 1:
        salted = p.withColumn("__s", F.pmod(F.xxhash64("digest"), F.lit(groups)))
        p = salted.groupBy(*keys, "__s").applyInPandas(_merge_step(epsilon), schema + ", `__s` bigint").drop("__s")
    return p.groupBy(*keys).applyInPandas(_merge_step(epsilon), schema)


def _read(qs: Sequence[float], epsilon: float):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                x, c = unpack(r.digest)
                bound = LEVELS * int(np.floor(r.n * epsilon / LEVELS))
                out.extend((*r[:-2], float(q), float(v), int(r.n), bound) for q, v in zip(qs, ranked(x, c, qs)))
            yield pd.DataFrame(out, columns=[*pdf.columns[:-2], "q", "value", "n", "rank_error"])

    return run


def percentiles(merged: DataFrame, keys: Sequence[str], qs: Sequence[float] = PERCENTILES, epsilon: float = EPSILON) -> DataFrame:
    """(keys, q, value, n, rank_error): the true rank of ``value`` lies within rank_error of q * n."""
    m = merged.select(*keys, "n", "digest")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in m.schema.fields[:-2])
    return m.mapInPandas(_read(qs, epsilon), schema + ", q double, value double, n bigint, rank_error bigint")


def frame_percentiles(frames: DataFrame, qs: Sequence[float] = PERCENTILES, epsilon: float = EPSILON) -> DataFrame:
    """Percentiles of every dimension of state and action per robot and per scene, over all days.

    Columns: source_kind ('robot' or 'scene'), source, field_name, dim, q, value,
    n, rank_error. Each day has digests of its own. The digests of scenes are
    merged from those of their days, those of robots from those of their scenes.
    """
    days = digests(distinct_readings(frames), by_day=True, epsilon=epsilon)
    found = frames.agg(F.approx_count_distinct("scene", 0.02).alias("scenes"), F.approx_count_distinct(F.to_date("recorded_at"), 0.02).alias("days")).first()
    # all readings of a robot, scene and day lie in one task, which gives one digest per key; the counts are approximate
    scenes = merge(days, ["robot", "scene", "field_name", "dim"], epsilon, found["days"] + found["days"] // 10 + 1)
    keys = ["source_kind", "source", "field_name", "dim"]
    both = F.array(F.struct(F.lit("scene").alias("source_kind"), F.col("scene").alias("source")), F.struct(F.lit("robot").alias("source_kind"), F.col("robot").alias("source")))
    each = scenes.select("field_name", "dim", "n", "digest", F.inline(both))
    return percentiles(merge(each, keys, epsilon, found["scenes"]), keys, qs, epsilon)
