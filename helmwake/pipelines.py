"""Conversions of whole data sets, as compositions of the operators.

Each ``convert_*`` gives the frames of all surviving episodes as one DataFrame:
source (scene or id), source_episode, frame_index, task, state and action
(array<double>). ``publish`` numbers episodes and tasks and writes the layout.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helmwake.operators import se3, sequence, spatial, tasks, visibility
from helmwake.operators.prefix import distributed_prefix_sum, join_null_safe
from helmwake.session import shared_path
from helmwake.sinks import episodes as sink
from helmwake.sinks import fs
from helmwake.sources import clouds, episodes, images, jsonl, uav

KEY = ["scene", "episode_index"]

# Fixed value: pose of the body in a camera that looks along z with y down, row-major.
CAMERA_TO_BODY = (0.0, -1.0, 0.0, 0.0, 0.0, 0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)


def _zeros() -> Column:
    return F.array(*[F.lit(0.0)] * 4)


def _pose4(p: se3.Pose) -> Column:
    return F.array(*se3.pose4_degrees(p))


def _in_frame_of(a: str, b: str) -> Column:
    """[x, y, z, yaw] of the flat pose b seen from the flat pose a; null when either is."""
    rel = _pose4(se3.compose(se3.inverse(se3.from_flat(F.col(a))), se3.from_flat(F.col(b))))
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), rel)


def _with_state_and_delta(f: DataFrame, pose: str) -> DataFrame:
    """state: the pose seen from the first frame; delta: the next one seen from this, 0 for the last."""
    f = f.withColumn("__first", sequence.first_frame(pose, KEY, ["frame_index"])).withColumn("__next", F.lead(pose).over(sequence.over(KEY, ["frame_index"])))
    f = f.withColumn("state", _in_frame_of("__first", pose)).withColumn("delta", F.coalesce(_in_frame_of(pose, "__next"), _zeros()))
    return f.drop("__first", "__next")


def _with_goal(f: DataFrame, pose: str, goal: str) -> DataFrame:
    """goal_pose: the pose of frame ``goal`` of the episode, seen from this one (J09); 0 where there is no such frame."""
    g = f.select(*KEY, F.col("frame_index").alias(goal), F.col(pose).alias("__g"))
    j = join_null_safe(f, g, [*KEY, goal], "left")
    return j.withColumn("goal_pose", F.coalesce(_in_frame_of(pose, "__g"), _zeros())).drop("__g")


def _ordered(frames: DataFrame) -> DataFrame:
    return frames.withColumn("frame_index", (F.row_number().over(Window.partitionBy(*KEY).orderBy("row")) - 1).cast("bigint")).drop("row")


def _metadata(spark: SparkSession, root: str) -> DataFrame:
    """(scene, episode_index, tasks): the last line of each episode counts."""
    m = jsonl.read_episodes(spark, f"{root}/*/meta/episodes.jsonl")
    return tasks.latest_by(m, KEY, F.struct("file", "line_no"), "tasks", "tasks")


def convert_uav(spark: SparkSession, path: str, unified: bool = False) -> DataFrame:
    """Drone trajectories: state and action of each image row from the flight log (W02u)."""
    s = uav.states_and_actions(uav.trajectories(uav.read_trajectories(spark, path)), unified)
    s = s.withColumn("source_episode", F.concat_ws("#", "id", F.col("traj_no").cast("string")))
    place = F.row_number().over(Window.partitionBy("file", "traj_no").orderBy("frame_idx")) - 1
    return s.select(F.col("file").alias("source"), "source_episode", place.cast("bigint").alias("frame_index"), "task", "state", "action")


def split_trajectories(frames: DataFrame, quotas: Sequence[tuple[str, int | None]]) -> DataFrame:
    """Converted frames with ``split``: the first trajectories by source and source_episode go to the first split and so on."""
    e = frames.select("source", "source_episode").distinct()
    return join_null_safe(frames, sequence.quota_split(e, ["source", "source_episode"], quotas), ["source", "source_episode"])


def split_report(frames: DataFrame, fps: float) -> DataFrame:
    """Trajectories, frames and seconds of each split."""
    return frames.groupBy("split").agg(F.count_distinct("source", "source_episode").alias("trajectories"), F.count("*").alias("frames"), (F.count("*") / F.lit(float(fps))).alias("seconds"))


def convert_ce(spark: SparkSession, root: str) -> DataFrame:
    """Room navigation with goal frames: the first given goal, else the next forward action, else the last frame."""
    f = _ordered(episodes.read_frames(spark, root))
    goals = episodes.goal_columns(f)
    first_task = F.coalesce(F.get(F.from_json("tasks", "array<string>"), F.lit(0)), F.lit(""))
    f = join_null_safe(f, _metadata(spark, root), KEY, "left").withColumn("task", first_task)
    body = se3.compose(se3.from_flat(F.col("`pose.125cm_0deg`")), se3.from_flat(F.array(*[F.lit(x) for x in CAMERA_TO_BODY])))
    f = f.select(*KEY, "frame_index", "task", F.col("action").cast("int").alias("move"), *[F.col(f"`{g}`").cast("bigint").alias(f"g{i}") for i, g in enumerate(goals)], se3.to_flat(body).alias("pose"))
    f = _with_state_and_delta(f, "pose")
    rel = sequence.first_of([F.col(f"g{i}") for i in range(len(goals))])
    ahead = sequence.next_match(F.col("move") == 1, F.col("frame_index"), KEY, ["frame_index"])
    last = F.max("frame_index").over(Window.partitionBy(*KEY))
    f = f.withColumn("__rel", rel).withColumn("__ahead", ahead).withColumn("__last", last)
    f = f.withColumn("goal", F.when(F.col("__rel") >= 0, F.col("frame_index") + F.col("__rel")).otherwise(F.coalesce("__ahead", "__last")))
    f = _with_goal(f, "pose", "goal")
    return f.select(F.col("scene").alias("source"), F.col("episode_index").cast("string").alias("source_episode"), "frame_index", "task", "state", F.concat("delta", "goal_pose").alias("action"))


def _patch_least(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Least depth around each pixel of a frame's candidates; only the patches asked for are looked at."""
    h = visibility.PATCH
    for pdf in it:
        out = []
        for data, us, vs in zip(pdf["data"], pdf["us"], pdf["vs"]):
            px = images.decode_png(bytes(data)) if data is not None else None
            if px is None or px.ndim != 2:
                out.append([None] * len(us))
                continue
            d = images.depth_metres(px)
            rows, cols = d.shape
            least = []
            for u, v in zip(us, vs):
                if u is None or v is None or np.isnan(u) or np.isnan(v):
                    least.append(None)
                    continue
                r, c = int(np.clip(np.rint(v), 0, rows - 1)), int(np.clip(np.rint(u), 0, cols - 1))
                least.append(float(d[max(0, r - h) : r + h + 1, max(0, c - h) : c + h + 1].min()))
            out.append(least)
        yield pdf[["scene", "episode_index", "frame_index", "end"]].assign(js=pdf["js"], us=pdf["us"], vs=pdf["vs"], ds=pdf["ds"], least=out)


def _farthest_frames(f: DataFrame, depth: DataFrame, width: int, height: int) -> DataFrame:
    """(scene, episode_index, frame_index, farthest) over frames with cam (flat), fx, fy, cx, cy and end."""
    w, h = F.lit(width), F.lit(height)
    pairs = visibility.candidate_pairs(f, KEY, "frame_index", "end", ["cam", "fx", "fy", "cx", "cy"])
    rel = se3.compose(se3.inverse(se3.from_flat(F.col("cam"))), se3.from_flat(F.col("t_cam"))).t
    u, v, d = se3.pinhole(*rel, F.col("fx"), F.col("fy"), F.col("cx"), F.col("cy"), h)
    pairs = pairs.select(*KEY, "frame_index", "end", F.col("t_frame").alias("j"), u.alias("u"), v.alias("v"), d.alias("d"))
    # a frame's candidates are bounded by its interval; its depth image is read once
    g = pairs.groupBy(*KEY, "frame_index", "end").agg(F.sort_array(F.collect_list(F.struct("j", "u", "v", "d"))).alias("c"))
    g = g.select(*KEY, "frame_index", "end", *[F.col(f"c.{x}").alias(f"{x}s") for x in "juvd"])
    j = join_null_safe(g, depth, [*KEY, "frame_index"], "left")
    schema = "scene string, episode_index bigint, frame_index bigint, end bigint, js array<bigint>, us array<double>, vs array<double>, ds array<double>, least array<double>"
    m = j.select(*KEY, "frame_index", "end", "js", "us", "vs", "ds", "data").mapInPandas(_patch_least, schema)
    p = m.select(*KEY, "frame_index", "end", F.inline(F.arrays_zip("js", "us", "vs", "ds", "least"))).withColumnRenamed("js", "t_frame")
    p = p.withColumn("stop", visibility.blocked(F.col("us"), F.col("vs"), F.col("ds"), F.col("least"), w, h)).withColumn("edge", F.coalesce(visibility.near_edge(F.col("us"), F.col("vs"), w, h), F.lit(True)))
    return visibility.farthest(p, KEY, "frame_index", "end", "stop", "edge")


def rejected(spark: SparkSession, root: str, roll_limit: float | None = 5.0) -> DataFrame:
    """The error log of a camera data set (K11): source, source_episode and reason of every episode that a conversion leaves out.

    Reasons, the first that holds: 'no metadata', 'no valid task', 'not level' (only
    with a roll limit). A conversion's frames and this log together name every episode.
    """
    f = episodes.read_frames(spark, root).select(*KEY, "row", F.col("action").alias("cam"))
    first = f.groupBy(*KEY).agg(F.min_by("cam", "row").alias("c0"))
    m = _metadata(spark, root).select(*KEY, F.lit(True).alias("there"), tasks.valid_tasks(tasks.parse_tasks(F.col("tasks"))).alias("valid"))
    j = join_null_safe(first, m, KEY, "left")
    level = F.lit(True) if roll_limit is None else se3.is_level(F.degrees(se3.euler_zyx(se3.from_flat(F.col("c0")).r)[2]), roll_limit)
    why = F.when(F.col("there").isNull(), F.lit("no metadata")).when(~F.col("valid"), F.lit("no valid task")).when(~F.coalesce(level, F.lit(False)), F.lit("not level"))
    return j.select(F.col("scene").alias("source"), F.col("episode_index").cast("string").alias("source_episode"), why.alias("reason")).where("reason IS NOT NULL")


def _n1_frames(spark: SparkSession, root: str, keep: Column | Callable[[DataFrame], DataFrame] | None, strict: bool) -> DataFrame:
    """Frames of the episodes with valid tasks: cam, intrinsics, task, iv (intervals), and __c0, the first frame's camera.

    ``keep`` is a predicate on the frames' columns, or a function that leaves
    episodes out (UD1). With ``strict`` an episode without a valid task is an error.
    """
    f = _ordered(episodes.read_frames(spark, root))
    if keep is not None:
        f = f.where(keep) if isinstance(keep, Column) else keep(f)
    meta = _metadata(spark, root).withColumn("steps", tasks.parse_tasks(F.col("tasks")))
    meta = meta.withColumn("steps", tasks.require_valid(F.col("steps"))) if strict else meta.where(tasks.valid_tasks(F.col("steps")))
    meta = meta.select(*KEY, tasks.canonical_key(F.col("steps")).alias("task"), tasks.sub_intervals(F.col("steps")).alias("iv"))
    k = F.col("`observation.camera_intrinsic`")
    f = f.select(*KEY, "frame_index", F.col("action").alias("cam"), k.alias("k"), *[F.get(k, F.lit(i)).alias(n) for n, i in (("fx", 0), ("fy", 4), ("cx", 2), ("cy", 5))])
    return join_null_safe(f, meta, KEY).withColumn("__c0", sequence.first_frame("cam", KEY, ["frame_index"]))


def _with_end(f: DataFrame) -> DataFrame:
    """``end``: the last frame a frame may look at, by its sub-task interval."""
    f = f.withColumn("__last", F.max("frame_index").over(Window.partitionBy(*KEY)))
    return f.withColumn("end", visibility.enclosing_end(F.col("iv"), F.col("frame_index"), F.col("__last"))).drop("iv")


def _depth_images(spark: SparkSession, root: str) -> DataFrame:
    """(scene, episode_index, frame_index, data) of the depth images of a tree."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(root)
    listing = listing.where(F.col("path").contains("observation.images.depth"))
    name = F.substring_index("path", "/", -1)
    return listing.select(F.regexp_extract("path", r"([^/]+)/videos/", 1).alias("scene"), F.regexp_extract(name, r"episode_0*(\d+)", 1).try_cast("bigint").alias("episode_index"), F.regexp_extract(name, r"_0*(\d+)\.[^.]*$", 1).try_cast("bigint").alias("frame_index"), F.col("content").alias("data"))


def n1_extras(spark: SparkSession, root: str) -> DataFrame:
    """Per episode K, the first frame's intrinsics, and T_b_c, the camera in the body frame."""
    f = episodes.read_frames(spark, root)
    g = f.groupBy(*KEY).agg(F.min_by("action", "row").alias("c0"), F.min_by("`observation.camera_intrinsic`", "row").alias("K"))
    return g.select(F.col("scene").alias("source"), F.col("episode_index").cast("string").alias("source_episode"), "K", se3.to_flat(se3.camera_in_body(se3.from_flat(F.col("c0")))).alias("T_b_c"))


def convert_n1_levelled(spark: SparkSession, root: str, width: int = 480, height: int = 270, keep: Column | Callable[[DataFrame], DataFrame] | None = None, strict: bool = True, check_level: bool = True) -> DataFrame:
    """The first form of the camera conversion: every frame's camera is levelled, state is forward, left, up and yaw of four values.

    Invalid tasks are an error unless ``strict`` is off, and so is a levelled camera
    with pitch or roll unless ``check_level`` is off (F18). Steps and the pose of the
    farthest visible frame are planar; the last frame's step is 0.
    """
    f = _with_end(_n1_frames(spark, root, keep, strict))
    state, pitch, roll = se3.levelled_state(se3.from_flat(F.col("__c0")), se3.from_flat(F.col("cam")))
    state = F.array(*state)
    f = f.withColumn("state", se3.require_level(state, pitch, roll) if check_level else state)
    far = _farthest_frames(f.select(*KEY, "frame_index", "end", "cam", "fx", "fy", "cx", "cy"), _depth_images(spark, root), width, height)
    f = join_null_safe(f, far, [*KEY, "frame_index"], "left").withColumn("goal", F.coalesce("farthest", "frame_index"))
    f = f.withColumn("next", F.lead("state").over(sequence.over(KEY, ["frame_index"])))
    g = f.select(*KEY, F.col("frame_index").alias("goal"), F.col("state").alias("there"))
    f = join_null_safe(f, g, [*KEY, "goal"], "left")
    seen = lambda c: F.when(F.col(c).isNotNull(), F.array(*se3.relative_pose4([F.col("state")[i] for i in range(4)], [F.col(c)[i] for i in range(4)])))
    return f.select(F.col("scene").alias("source"), F.col("episode_index").cast("string").alias("source_episode"), "frame_index", "task", "state", F.concat(F.coalesce(seen("next"), _zeros()), F.coalesce(seen("there"), _zeros())).alias("action"))


def convert_n1(spark: SparkSession, root: str, width: int = 480, height: int = 270, roll_limit: float | None = 5.0, keep: Column | Callable[[DataFrame], DataFrame] | None = None, fps: float = 10.0, risk: float = 0.8, voxel: float | None = 0.01, strict: bool = False) -> DataFrame:
    """Camera trajectories with depth: state with a gated yaw rate, steps and the pose of the farthest visible frame.

    Episodes without valid tasks, or whose first roll differs from level by more
    than ``roll_limit``, are left out before any costly step (``rejected`` names them);
    ``keep`` is a further predicate on the frames' columns or a function of the frames.
    The point cloud is thinned to one point per ``voxel`` first. Scenes without a point
    cloud have no risk.
    """
    f = _n1_frames(spark, root, keep, strict)
    if roll_limit is not None:
        f = f.where(se3.is_level(F.degrees(se3.euler_zyx(se3.from_flat(F.col("__c0")).r)[2]), roll_limit))
    body = se3.compose(se3.from_flat(F.col("cam")), se3.inverse(se3.camera_in_body(se3.from_flat(F.col("__c0")))))
    f = _with_end(f.withColumn("pose", se3.to_flat(body)))
    f = _with_state_and_delta(f, "pose")
    world = se3.pose4_degrees(se3.from_flat(F.col("pose")))
    p = f.select(*KEY, "frame_index", *[c.alias(n) for n, c in zip(("x", "y", "z", "yaw"), world)])
    try:
        points = clouds.read_ply(spark, f"{root}/*/meta").select("scene", "x", "y", "z")
        if voxel:
            points = spatial.voxel_downsample(points, ["scene"], voxel).select("scene", "x", "y", "z")
        prob = spatial.collision_probability(p, points, "scene", KEY, "frame_index", 1.0 / fps)
    except Exception as e:  # no cloud anywhere below the root
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        prob = p.select(*KEY, "frame_index", F.lit(0.0).alias("prob"))
    rate = sequence.with_yaw_rate(p, KEY, ["frame_index"], "yaw", 1.0 / fps).withColumn("smooth", sequence.box_smooth("yaw_rate", KEY, ["frame_index"], 10)).select(*KEY, "frame_index", "smooth")
    f = join_null_safe(join_null_safe(f, rate, [*KEY, "frame_index"]), prob, [*KEY, "frame_index"], "left")
    gated = F.when(F.col("prob") > risk, F.col("smooth")).otherwise(F.lit(0.0))
    far = _farthest_frames(f.select(*KEY, "frame_index", "end", "cam", "fx", "fy", "cx", "cy"), _depth_images(spark, root), width, height)
    f = join_null_safe(f, far, [*KEY, "frame_index"], "left")
    f = f.withColumn("goal", F.when(F.col("frame_index") < F.col("__last"), F.coalesce("farthest", "frame_index")))
    f = _with_goal(f, "pose", "goal")
    state = F.concat("state", F.array(gated))
    return f.select(F.col("scene").alias("source"), F.col("episode_index").cast("string").alias("source_episode"), "frame_index", "task", state.alias("state"), F.concat("delta", "goal_pose").alias("action"))


def publish(frames: DataFrame, root: str, fps: float, robot: str, overwrite: bool = False, append: bool = False, extras: DataFrame | None = None, errors: DataFrame | None = None, shapes: dict | None = None) -> dict:
    """Writes converted frames as episodes with tasks, statistics and info; returns the totals.

    Episodes are numbered densely in order of source and source_episode, tasks in
    order of first appearance (Q03): the numbers follow from the data alone. With
    ``append`` they go on behind the output that is there, whose tasks keep their
    numbers; counters, tasks and statistics are carried on (ST4). ``extras`` has one row
    per source and source_episode, written to episodes_extras.jsonl, ``errors`` the log
    of what was left out. The frames are converted once, to the shared folder.
    """
    from helmwake.operators import stats

    spark = frames.sparkSession
    sink.prepare(spark, root, overwrite, append)
    before = sink.read_info(spark, root) if append else {}
    n_before = int(before.get("total_episodes", 0))
    at = shared_path(spark, f"publish_{uuid.uuid4().hex}")
    frames.write.parquet(f"{at}/frames")
    frames = spark.read.parquet(f"{at}/frames")
    e = frames.select("source", "source_episode").distinct().withColumn("__one", F.lit(1))
    e = distributed_prefix_sum(e, [], F.col("source"), ["source", "source_episode"], "__one", "__n")
    e = e.select("source", "source_episode", (F.col("__n") - 1 + n_before).cast("bigint").alias("episode_index"))
    e.write.parquet(f"{at}/episodes")
    e = spark.read.parquet(f"{at}/episodes")
    f = join_null_safe(frames, e, ["source", "source_episode"])
    known = None
    if before and fs.exists(spark, f"{root}/meta/tasks.jsonl"):
        # as it is now: the file grows below
        spark.read.schema("task_index bigint, task string").json(f"{root}/meta/tasks.jsonl").write.parquet(f"{at}/known")
        known = spark.read.parquet(f"{at}/known")
    tasks.registry(f, "task", ["episode_index", "frame_index"], known).write.parquet(f"{at}/tasks")
    new = spark.read.parquet(f"{at}/tasks")
    f = tasks.encode(f, new if known is None else known.unionByName(new), "task")
    vec = lambda c: F.col(c).cast("array<float>")
    rows = f.select("episode_index", "frame_index", "task_index", F.array(F.col("task_index").cast("int")).alias("annotation.human.action.task_description"), vec("state").alias("observation.state"), vec("action").alias("action"))
    sink.write_frames(sink.with_indexes(rows, fps, frames_before=int(before.get("total_frames", 0))), root)
    sink.write_jsonl(new, f"{root}/meta/tasks.jsonl", ["task_index"], append)
    ep = f.groupBy("episode_index").agg(F.array_sort(F.collect_set("task")).alias("tasks"), F.count("*").alias("length"))
    sink.write_jsonl(ep, f"{root}/meta/episodes.jsonl", ["episode_index"], append)
    each = [stats.vector_stats(rows, ["episode_index"], c).withColumn("feature", F.lit(c)) for c in ("observation.state", "action")]
    st = each[0].unionByName(each[1]).groupBy("episode_index", "feature").agg(*[F.array_sort(F.collect_list(F.struct("dim", c))).getField(c).alias(c) for c in ("min", "max", "mean", "std")], F.array(F.max("count")).alias("count"))
    st = st.groupBy("episode_index").agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("min", "max", "mean", "std", "count")))).alias("stats"))
    sink.write_jsonl(st, f"{root}/meta/episodes_stats.jsonl", ["episode_index"], append)
    if extras is not None:
        x = join_null_safe(extras, e, ["source", "source_episode"]).drop("source", "source_episode")
        sink.write_jsonl(x.select("episode_index", *[c for c in x.columns if c != "episode_index"]), f"{root}/meta/episodes_extras.jsonl", ["episode_index"], append)
    if errors is not None:
        sink.write_jsonl(errors, f"{root}/meta/errors.jsonl", ["source", "source_episode"], append)
    t = f.agg(F.count_distinct("episode_index").alias("total_episodes"), F.count("*").alias("total_frames"), F.coalesce(F.max(F.size("state")), F.lit(4)).alias("s"), F.coalesce(F.max(F.size("action")), F.lit(8)).alias("a")).first().asDict()
    own = {"annotation.human.action.task_description": {"dtype": "int32", "shape": [1]}, "observation.state": {"dtype": "float32", "shape": [t.pop("s")]}, "action": {"dtype": "float32", "shape": [t.pop("a")]}}
    total = {k: int(v) + int(before.get(k, 0)) for k, v in t.items()} | {"total_tasks": new.count() + int(before.get("total_tasks", 0))}
    sink.write_info(spark, root, total, own | (shapes or {}), fps, robot)
    fs.remove(spark, at)
    return total


def publish_splits(frames: DataFrame, root: str, fps: float, robot: str, quotas: Sequence[tuple[str, int | None]], **options) -> dict[str, dict]:
    """Publishes each split of the trajectories below ``root``/<split>; returns the totals by split."""
    s = split_trajectories(frames, quotas)
    return {label: publish(s.where(F.col("split") == label).drop("split"), f"{root}/{label}", fps, robot, **options) for label, _ in quotas}
