"""The output layout: data/chunk-NNN/episode_NNNNNN.parquet and meta/*.json(l).

Episodes are grouped by hash, written by the executors one file each under a
temporary name and renamed, so a task that runs twice leaves one whole file.
Metadata is sorted and written in parts by the executors; only the joining of the
parts' bytes goes through the driver. All paths may be of any shared file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helmwake.functions.encoder import PlainEncoder
from helmwake.operators import runs
from helmwake.operators.prefix import distributed_prefix_sum
from helmwake.sinks import fs

CHUNK = 1000


def chunk_dir(episode: int) -> str:
    return f"chunk-{episode // CHUNK:03d}"


def data_path(episode: int) -> str:
    return f"data/{chunk_dir(episode)}/episode_{episode:06d}.parquet"


def with_indexes(frames: DataFrame, fps: float, episode: str = "episode_index", order: str = "frame_index", frames_before: int = 0) -> DataFrame:
    """Dense frame_index and timestamp, index (restarts per episode, as the layout has it) and global_index.

    The running number over all episodes is the sum of the lengths before, from
    one row per episode; the frames themselves are only put in order by episode. It
    goes on from ``frames_before`` where there is output already.
    """
    w = Window.partitionBy(episode).orderBy(order)
    f = frames.withColumn("__n", (F.row_number().over(w) - 1).cast("bigint"))
    lengths = f.groupBy(episode).agg(F.count("*").alias("__len"))
    upto = distributed_prefix_sum(lengths, [], F.shiftright(episode, 10), [episode], "__len", "__upto")
    base = upto.select(episode, (F.col("__upto") - F.col("__len")).alias("__base"))
    f = f.join(base, episode)
    return f.withColumn(order, F.col("__n")).withColumn("index", F.col("__n")).withColumn("global_index", F.col("__base") + F.col("__n") + frames_before).withColumn("timestamp", F.col("__n") / fps).drop("__n", "__base")


def _writer(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, str, int]] = []
        held: list[pa.Table] = []
        at: int | None = None

        def flush() -> None:
            if at is None:
                return
            t = pa.concat_tables(held)
            out = runs.writer(f"{root}/{data_path(at)}", t.schema)
            out.write(t)
            out.close()
            done.append((at, data_path(at), t.num_rows))

        for b in batches:
            t = pa.Table.from_batches([b])
            e = t["episode_index"].to_pylist()
            start = 0
            for i in range(1, len(e) + 1):
                if i == len(e) or e[i] != e[start]:
                    if e[start] != at:
                        flush()
                        held, at = [], e[start]
                    held.append(t.slice(start, i - start))
                    start = i
        flush()
        if done:
            c = list(zip(*done))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int64())], ["episode_index", "path", "n_rows"])

    return run


def write_frames(frames: DataFrame, root: str) -> DataFrame:
    """Writes one Parquet file per episode (K01); returns (episode_index, path, n_rows) of the files written.

    ``root`` is a folder that all executors share. Frames with a null episode are
    left out; an episode already there is replaced.
    """
    f = frames.where("episode_index IS NOT NULL").repartition("episode_index").sortWithinPartitions("episode_index", "frame_index")
    names = [c.replace(".", "․") for c in f.columns]
    safe = f.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = (pa.RecordBatch.from_arrays(b.columns, [n.replace("․", ".") for n in b.schema.names]) for b in batches)
        yield from _writer(root)(back)

    written = safe.mapInArrow(run, "episode_index bigint, path string, n_rows bigint")
    # writing the list is what runs the tasks; it stays beside the data and never comes to the driver
    at = f"{root}/meta/written/{uuid.uuid4().hex}"
    written.write.parquet(at)
    return frames.sparkSession.read.parquet(at)


def write_jsonl(rows: DataFrame, path: str, order: list[str], append: bool = False) -> None:
    """One JSON object per line, ordered, in one file (K05, O09); behind the lines that are there where ``append``."""
    lines = rows.orderBy(*order).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("value"))
    lines.write.mode("overwrite").text(f"{path}.parts")
    fs.join_parts(rows.sparkSession, f"{path}.parts", path, append)


# The layout's version and the fields every episode file has.
VERSION = "v2.1"
STANDARD = {"timestamp": "float32", "frame_index": "int64", "episode_index": "int64", "index": "int64", "task_index": "int64"}


def features(shapes: dict[str, dict], fps: float, codec: str = "h264", pix_fmt: str = "yuv420p") -> dict:
    """The features of info.json: those given (dtype, shape, names), with the description of videos, and the standard fields."""
    out = {}
    for name, f in shapes.items():
        f = {"names": None, **f}
        if f["dtype"] == "video" and len(f.get("shape", ())) == 3 and not f.get("info"):
            h, w, c = f["shape"]
            f["info"] = {"video.height": h, "video.width": w, "video.codec": codec, "video.pix_fmt": pix_fmt, "video.is_depth_map": False, "video.fps": fps, "video.channels": c, "has_audio": False}
        out[name] = f
    return out | {k: {"dtype": t, "shape": [1], "names": None} for k, t in STANDARD.items() if k not in shapes}


def read_info(spark: SparkSession, root: str) -> dict:
    """meta/info.json, or an empty one."""
    path = f"{root}/meta/info.json"
    return json.loads(fs.read_text(spark, path)) if fs.exists(spark, path) else {}


def write_info(spark: SparkSession, root: str, totals: dict, shapes: dict, fps: float, robot: str) -> None:
    """meta/info.json with counters, paths and features."""
    n = int(totals["total_episodes"])
    videos = sum(f["dtype"] == "video" for f in shapes.values())
    info = {
        "codebase_version": VERSION,
        "robot_type": robot,
        "fps": fps,
        **{k: int(v) for k, v in totals.items()},
        "total_videos": videos * n,
        "total_chunks": (n - 1) // CHUNK + 1 if n else 0,
        "chunks_size": CHUNK,
        "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet",
        "video_path": "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4",
        "features": features(shapes, fps),
        "splits": {"train": f"0:{n}"},
    }
    fs.make_folder(spark, f"{root}/meta")
    fs.write_text(spark, f"{root}/meta/info.json", json.dumps(info, indent=2, ensure_ascii=False, cls=PlainEncoder))


def append_progress(spark: SparkSession, path: str, names: list[str]) -> None:
    """Appends names to a progress file, one per line."""
    before = fs.read_text(spark, path) if fs.exists(spark, path) else ""
    fs.write_text(spark, path, before + "".join(f"{n}\n" for n in names))


def missing_files(root: str, episodes: DataFrame) -> DataFrame:
    """(episode_index, path) of the episodes whose file is not there."""
    spark = episodes.sparkSession
    e = F.col("episode_index")
    want = episodes.select(e, F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(e / CHUNK).cast("bigint"), e).alias("path")).distinct()
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/data").select(F.regexp_extract("path", r"(data/chunk-\d+/[^/]*)$", 1).alias("path"))
    return want.join(there, "path", "left_anti").select("episode_index", "path")


def prepare(spark: SparkSession, root: str, overwrite: bool, append: bool = False) -> None:
    """The output folder: empty, or as it is where ``append`` (ST4); one that exists is replaced only on demand."""
    if fs.exists(spark, root) and not append:
        if not overwrite:
            raise FileExistsError(root)
        fs.remove(spark, root)
    fs.make_folder(spark, f"{root}/meta")
