"""Trajectory files of drones: one row per frame, the flight log as JSON beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helmwake.operators.sequence import run_groups

# Where each axis stands in a raw log row (yaw before pitch); the time in seconds is last.
LOG_INDEX = {"x": 0, "y": 1, "z": 2, "roll": 3, "yaw": 4, "pitch": 5}
LOG = "struct<raw_logs:array<array<double>>,instruction:string,instruction_unified:string>"


def pose_of_log(row: Column) -> dict[str, Column]:
    """The axes of a raw log row by name, and t, its time (P01); null where the row is too short."""
    return {k: F.get(row, F.lit(i)) for k, i in LOG_INDEX.items()} | {"t": F.get(row, F.size(row) - 1)}


def read_trajectories(spark: SparkSession, path: str) -> DataFrame:
    """All frames below a folder or glob (S01, S02): id, frame_idx, image, log, file, row.

    Files are read by the vectorised reader, in any number of tasks. ``file`` and
    ``row``, the row's place in its file, keep the order in which an id's run is defined.
    """
    t = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return t.select("id", F.col("frame_idx").cast("bigint").alias("frame_idx"), F.col("image.bytes").alias("image"), "log", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def trajectories(frames: DataFrame) -> DataFrame:
    """Frames with the number of their trajectory: a run of equal ids within a file, in the order of its rows."""
    return run_groups(frames, "id", ["row"], ["file"], "traj_no")


def constant_logs(frames: DataFrame) -> DataFrame:
    """(file, traj_no, id, constant): does every frame of a trajectory have the same log?"""
    return frames.groupBy("file", "traj_no", "id").agg((F.count_distinct(F.sha2(F.coalesce("log", F.lit("")), 256)) == 1).alias("constant"))


def states_and_actions(frames: DataFrame, unified: bool = False) -> DataFrame:
    """State (pose seen from the first log row) and action (step to the next log row) of each frame.

    The last row's action is that to itself, 0. Both are [x, y, z, yaw in degrees];
    roll and pitch count as 0. Columns: file, traj_no, id, frame_idx, task, t, state, action.
    Frames without a log row are left out.
    """
    from helmwake.operators.se3 import relative_pose_given_axes

    axes = ["x", "y", "z", "yaw"]
    p = frames.withColumn("l", F.from_json("log", LOG)).where("l.raw_logs IS NOT NULL AND frame_idx >= 0 AND frame_idx < size(l.raw_logs)")
    logs = F.col("l.raw_logs")
    at = lambda i: pose_of_log(F.get(logs, i))
    here, first = at(F.col("frame_idx")), at(F.lit(0))
    nxt = at(F.least(F.col("frame_idx") + 1, F.size(logs) - 1))
    six = lambda d: [d[k] for k in ("x", "y", "z", "roll", "pitch", "yaw")]
    state, action = (relative_pose_given_axes(six(a), six(b), axes) for a, b in ((first, here), (here, nxt)))
    four = lambda r: F.array(r[0], r[1], r[2], r[5])
    task = F.col("l.instruction_unified") if unified else F.col("l.instruction")
    return p.select("file", "traj_no", "id", "frame_idx", task.alias("task"), here["t"].alias("t"), four(state).alias("state"), four(action).alias("action"))
