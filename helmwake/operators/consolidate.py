"""Consolidation of many tiny files into a few well-sized ones.

Entries are identified by what they hold (image key, episode, frame), whatever
their path looks like. Every input task sorts its entries and writes them as one
run; the key range is cut at quantiles of all keys; and one task per range merges
that part of all runs (``runs.py``), at most FAN_IN at a time. An image's entries
come side by side there: its first one against the others are the surplus, the
best one goes to the output, which is rolled by bytes. Each file's key range,
count and bytes go to the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helmwake.operators import runs as rn
from helmwake.session import shared_path

# The first eight and the last twelve bytes of a whole PNG file.
PNG_HEAD = "89504E470D0A1A0A"
PNG_TAIL = "0000000049454E44AE426082"

RGB, DEPTH = "observation.images.rgb", "observation.images.depth"
#: Keys that make up an entry's place in order: bits of the frame and of the episode number.
FRAME_BITS, EPISODE_BITS = 24, 36
#: Output files one merging task writes, and slim entries it reads.
RANGE_FILES, RANGE_ROWS = 16, 4_000_000
#: Runs merged at a time, and the most key ranges.
FAN_IN, MAX_RANGES = 256, 10_000
# The order of the image keys, and of the entries without an identity behind them.
CODES = {"depth": 0, "rgb": 1}
LOOSE = {"depth": 2, "rgb": 3, "none": 4}


def complete_png(c: Column) -> Column:
    """True when the bytes have a PNG's signature and its end chunk; null bytes are not complete."""
    return F.coalesce((F.hex(F.substring(c, 1, 8)) == PNG_HEAD) & (F.hex(F.substring(c, -12, 12)) == PNG_TAIL), F.lit(False))


def entries(files: DataFrame) -> DataFrame:
    """One row per entry: file_id, image_key, episode_index, frame_index, complete, size, modified_at, path, data.

    The path may have any separators, extra folders, copy suffixes and endings;
    the numbers may be zero-padded. An image key missing in the path is taken from
    the column that holds bytes. Entries without an episode number below 2**36 and a
    frame number below 2**24, or with no image key at all, have nulls there and are an image of their own.
    """
    name = r"episode_0*(\d+)_0*(\d+)"
    # plain string search first: a regular expression only sees the short last part
    stem = F.substring_index(F.translate("path", "\\", "/"), "/", -1)
    low = F.lower("path")
    key = F.when(low.contains(RGB), F.lit("rgb")).when(low.contains(DEPTH), F.lit("depth")).when(F.col(f"`{RGB}`").isNotNull(), F.lit("rgb")).when(F.col(f"`{DEPTH}`").isNotNull(), F.lit("depth"))
    data = F.coalesce(F.col(f"`{RGB}`"), F.col(f"`{DEPTH}`"))

    def number(k: int, bits: int) -> Column:
        n = F.regexp_extract(stem, name, k).try_cast("bigint")
        return F.when(n < (1 << bits), n)

    e = files.select("file_id", "path", "modified_at", key.alias("image_key"), number(1, EPISODE_BITS).alias("episode_index"), number(2, FRAME_BITS).alias("frame_index"), data.alias("data"))
    return e.withColumn("complete", complete_png(F.col("data"))).withColumn("size", F.coalesce(F.octet_length("data"), F.lit(0)).cast("bigint"))


IMAGE = ["image_key", "episode_index", "frame_index"]


def merged(files: DataFrame) -> DataFrame:
    """The images: IMAGE, first_file_id, n_entries, kept_file_id, kept_complete, kept_size.

    The kept entry is a complete one where there is any, then the largest, then
    the newest, then the one of the smallest file_id. The aggregation combines
    inside each task first, so an image with very many entries costs no task more.
    """
    e = entries(files)
    e = e.where(F.col("image_key").isNotNull() & F.col("episode_index").isNotNull() & F.col("frame_index").isNotNull())
    best = F.struct("complete", "size", "modified_at", (-F.col("file_id")).alias("id"))
    m = e.groupBy(*IMAGE).agg(F.min("file_id").alias("first_file_id"), F.count("*").alias("n_entries"), F.max(best).alias("b"))
    return m.select(*IMAGE, "first_file_id", "n_entries", (-F.col("b.id")).alias("kept_file_id"), F.col("b.complete").alias("kept_complete"), F.col("b.size").alias("kept_size"))


def _ordered(e: DataFrame) -> DataFrame:
    """Entries with ``o``, the place of their image in the order of (image key, episode, frame); loose ones by key and file_id behind all images."""
    known = F.col("image_key").isNotNull() & F.col("episode_index").isNotNull() & F.col("frame_index").isNotNull()
    place = lambda m, c: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), c).cast("bigint")
    at = F.shiftleft(place(CODES, F.col("image_key")), FRAME_BITS + EPISODE_BITS) + F.shiftleft("episode_index", FRAME_BITS) + F.col("frame_index")
    number = F.coalesce("file_id", F.lit(0)).bitwiseAND((1 << FRAME_BITS + EPISODE_BITS) - 1)
    loose = F.shiftleft(place(LOOSE, F.coalesce("image_key", F.lit("none"))), FRAME_BITS + EPISODE_BITS) + number
    return e.withColumn("o", F.when(known, at).otherwise(loose))


def surplus(files: DataFrame) -> DataFrame:
    """One row per surplus entry: file_id_a is the smallest file_id of the image, file_id_b another one.

    Slim sorted runs are merged per key range; an image's first entry comes just
    before its others. An image with very many entries is merged by several tasks,
    each from some of the runs; their first entries, at most one per task, are then
    compared. A row delivered twice with one file_id is no surplus. Null file_ids
    and entries without an identity are left out.
    """
    spark = files.sparkSession
    folder = shared_path(spark, f"p5_runs_{uuid.uuid4().hex}")
    e = _ordered(entries(files).dropna(subset=[*IMAGE, "file_id"])).select("o", F.col("file_id").alias("id"))
    runs = rn.write_runs(e, ["o", "id"], f"{folder}/0")
    ranges = rn.cut(spark, runs, RANGE_ROWS, MAX_RANGES)
    runs = rn.levelled(spark, runs, ranges, FAN_IN, folder)

    def pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rn.rows_of(it):
            held = (None, None, None)
            for t in rn.merge(runs, r):
                o, i = t["o"].to_numpy(), t["id"].to_numpy()
                start = np.r_[o[0] != held[0], o[1:] != o[:-1]]
                first = np.where(start, i, 0)[np.maximum.accumulate(np.where(start, np.arange(len(o)), 0))]
                if not start[0]:
                    first[: int(np.argmax(start)) if start.any() else len(o)] = held[1]
                again = ~start & (i == np.r_[i[0] if start[0] else held[2], i[:-1]])
                held = (o[-1], first[-1], i[-1])
                keep = (~again & (i != first)) | (start & (r["parts"] > 1))
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(o[keep]), pa.array(first[keep]), pa.array(i[keep]), pa.array(np.full(int(keep.sum()), r["parts"] > 1))], ["o", "a", "b", "open"])

    found = rn.spread(spark, ranges).mapInArrow(pairs, "o bigint, a bigint, b bigint, open boolean")
    if not any(r["parts"] > 1 for r in ranges):
        return found.select(F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b"))
    heads = F.broadcast(found.where("open AND a = b").groupBy("o").agg(F.min("a").alias("least")))
    j = found.join(heads, "o", "left").withColumn("a", F.coalesce("least", "a")).where("a <> b")
    return j.select(F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b")).distinct()


_MANIFEST = "image_key string, out_file bigint, n_images bigint, n_bytes bigint, n_complete bigint, first_episode bigint, first_frame bigint, last_episode bigint, last_frame bigint"
_KEPT = ["file_id", "path", "modified_at", "episode_index", "frame_index", "data", "complete", "size"]


class _Roller:
    """Writes tables to files of one key range, a new file after ``target`` bytes or at another image key."""

    def __init__(self, out: str, base: dict[int, int], target: int):
        self.out, self.base, self.target, self.done, self.key = out, base, target, [], None

    def add(self, t: pa.Table) -> None:
        code = t["o"].to_numpy() >> (FRAME_BITS + EPISODE_BITS)
        size = t["size"].to_numpy()
        at = 0
        while at < len(t):
            if self.key is None or code[at] != self.key:
                self.close()
                same = [d for d in self.done if d[0] == code[at]]
                self.key, self.n, self.bytes, self.complete, self.seq = int(code[at]), 0, 0, 0, len(same)
                self.first = self.last = None
                names = {c: k for m in (CODES, LOOSE) for k, c in m.items()}
                no = self.base[self.key] + self.seq
                no = no if self.key in CODES.values() else -1 - no
                self.row = (names[self.key], no)
                self.file = rn.writer(f"{self.out}/image_key={names[self.key]}/out_file={no}/part-0.parquet", t.select(_KEPT).schema)
            end = at + int(np.argmax(code[at:] != self.key)) if (code[at:] != self.key).any() else len(t)
            room = np.searchsorted(np.cumsum(size[at:end]), self.target - self.bytes, "right")
            to = max(at + int(room), at + (1 if not self.n else 0))
            part = t.slice(at, min(to, end) - at)
            if len(part):
                self.file.write(part.select(_KEPT))
                self.n += len(part)
                self.bytes += int(size[at : at + len(part)].sum())
                self.complete += int(pc.sum(part["complete"].cast(pa.int64())).as_py() or 0)
                ends = [tuple(part[c][i].as_py() for c in ("episode_index", "frame_index")) for i in (0, len(part) - 1)]
                self.first, self.last = self.first or ends[0], ends[1]
                at += len(part)
            if at < end:
                key = self.key
                self.close()
                self.key = None if at < len(t) else key

    def close(self) -> None:
        if self.key is not None:
            self.file.close()
            self.done.append((self.key, (*self.row, self.n, self.bytes, self.complete, *self.first, *self.last)))
            self.key = None


def _best(t: pa.Table, held: pa.Table | None) -> tuple[pa.Table, pa.Table]:
    """The best entry of each image of a merged stretch, save that of the last image, which may go on."""
    t = t if held is None else pa.concat_tables([held, t])
    o, i = t["o"].to_numpy(), t["id"].to_numpy()
    when = t["modified_at"].cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()
    loose = o >> (FRAME_BITS + EPISODE_BITS) > max(CODES.values())
    worse = [np.where(loose, 0, k) for k in (-when, -t["size"].to_numpy(), ~t["complete"].to_numpy(zero_copy_only=False))]
    order = np.lexsort((i, *worse, o))
    start = np.r_[True, o[order][1:] != o[order][:-1]] | loose[order]
    best = order[start]
    last = o[best] == o[best[-1]]
    if loose[best[-1]]:
        last[:] = False
    return t.take(pa.array(best[~last])), t.take(pa.array(best[last]))


def consolidate(files: DataFrame, out_dir: str, target_bytes: int = 128 << 20) -> DataFrame:
    """Writes each image exactly once into sorted files of about ``target_bytes``; returns the manifest.

    The files lie in ``out_dir``/image_key=K/out_file=N, sorted by episode and frame;
    N grows with the keys. The kept entry of an image is chosen as in ``merged``. Runs
    hold an image once: a task keeps the best of its own entries. Entries without an
    identity are kept, too, in out_file -1, -2, ... of their key (or of key 'none') in
    order of file_id. A merging task writes under a temporary name and renames, so a
    lost executor leaves no half file and a task that runs twice the same ones. The
    manifest has one row per file with its count, bytes and key range.
    """
    spark = files.sparkSession
    folder = f"{out_dir.rstrip('/')}_runs_{uuid.uuid4().hex}"
    e = _ordered(entries(files)).withColumn("id", F.coalesce("file_id", F.lit(-1)))
    e = e.select("o", "id", *_KEPT)

    def combined(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in it:
            t, held = _best(pa.Table.from_batches([b]), held)
            yield from t.to_batches()
        if held is not None:
            yield from held.to_batches()

    one = e.sortWithinPartitions("o", "id").mapInArrow(combined, e.schema)
    runs = rn.write_runs(one, ["o", "id"], f"{folder}/0")
    ranges = rn.cut(spark, runs, target_bytes * RANGE_FILES, MAX_RANGES, "size")
    runs = rn.levelled(spark, runs, ranges, FAN_IN, folder)
    rn.clear(spark, out_dir)
    # files are numbered from the first range that may hold their image key
    first = {c: min((r["no"] for r in ranges if r["hi"] > c << FRAME_BITS + EPISODE_BITS), default=0) for c in (*CODES.values(), *LOOSE.values())}

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rn.rows_of(it):
            to, held = _Roller(out_dir, {c: 10_000 * (r["no"] - f) for c, f in first.items()}, target_bytes), None
            for t in rn.merge(runs, r):
                t, held = _best(t, held)
                to.add(t)
            if held is not None:
                to.add(held)
            to.close()
            if to.done:
                z = list(zip(*[d[1] for d in to.done]))
                yield pa.RecordBatch.from_arrays([pa.array(z[0], pa.string()), *[pa.array(x, pa.int64()) for x in z[1:]]], [f.split()[0] for f in _MANIFEST.split(", ")])

    # an image is in one range only: its place is a single number here, and runs hold it once
    whole = [r for r in ranges if r["part"] == 0]
    rn.spread(spark, [r | {"parts": 1} for r in whole]).mapInArrow(write, _MANIFEST).write.mode("overwrite").parquet(f"{out_dir}/_manifest")
    rn.clear(spark, folder)
    return spark.read.parquet(f"{out_dir}/_manifest")


def manifest(out_dir_files: DataFrame) -> DataFrame:
    """The manifest recomputed from consolidated files that were read back."""
    at = F.struct("episode_index", "frame_index")
    m = out_dir_files.groupBy("image_key", "out_file").agg(F.count("*").alias("n_images"), F.sum("size").alias("n_bytes"), F.sum(F.col("complete").cast("bigint")).alias("n_complete"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    return m.select("image_key", F.col("out_file").cast("bigint").alias("out_file"), "n_images", "n_bytes", "n_complete", F.col("lo.episode_index").alias("first_episode"), F.col("lo.frame_index").alias("first_frame"), F.col("hi.episode_index").alias("last_episode"), F.col("hi.frame_index").alias("last_frame"))
