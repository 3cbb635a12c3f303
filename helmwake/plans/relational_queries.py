"""Queries of joins, filters, task, name and totals operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from helmwake import functions as fn
from helmwake.operators import intervals, tasks
from helmwake.operators.consolidate import entries
from helmwake.operators.se3 import half_even
from helmwake.plans.base import POSES, STEPS, Registry, poses, q6, r6, steps
from helmwake.session import shared_path, table

R = Registry()

_TEXT = "regexp_matches(coalesce({}, ''), '[^\\s]')".format


def _ok(col: str) -> str:
    return f"coalesce(len({col}) = 2 AND {col}[1] <= {col}[2], false)"


_VALID = f"coalesce(list_bool_or(list_transform(tasks, lambda t: ((({_TEXT('t.sub_instruction')}) OR ({_TEXT('t.revised_sub_instruction')})) AND {_ok('t.sub_indexes')}) OR (({_TEXT('t.sum_instruction')}) AND {_ok('t.sum_indexes')}))), false)"


@R.query("F02_F04_valid_tasks", f"SELECT episode_index, recorded_at, {_VALID} AS valid FROM episodes")
def f02(spark, d):
    return table(spark, d, "episodes").select("episode_index", "recorded_at", tasks.valid_tasks(F.col("tasks")).alias("valid"))


@R.query("F03_X11_valid_pairs", f"SELECT episode_index, count(*) AS n_steps, CAST(sum(CAST({_ok('t.sub_indexes')} AS INT)) AS BIGINT) AS n_sub, CAST(sum(CAST({_ok('t.sum_indexes')} AS INT)) AS BIGINT) AS n_sum FROM (SELECT episode_index, unnest(tasks) AS t FROM episodes) GROUP BY episode_index")
def f03(spark, d):
    t = table(spark, d, "episodes").select("episode_index", F.explode("tasks").alias("t"))
    n = lambda c: F.sum(intervals.valid_pair(F.col(c)).cast("bigint"))
    return t.groupBy("episode_index").agg(F.count("*").alias("n_steps"), n("t.sub_indexes").alias("n_sub"), n("t.sum_indexes").alias("n_sum"))


@R.query("F05_K11_quarantine", f"SELECT episode_index, CASE WHEN tasks IS NULL THEN 'no tasks' WHEN len(tasks) = 0 THEN 'empty tasks' ELSE 'invalid tasks' END AS reason, count(*) AS n FROM episodes WHERE NOT {_VALID} GROUP BY ALL")
def f05(spark, d):
    e = table(spark, d, "episodes").where(~tasks.valid_tasks(F.col("tasks")))
    why = F.when(F.col("tasks").isNull(), F.lit("no tasks")).when(F.size("tasks") == 0, F.lit("empty tasks")).otherwise(F.lit("invalid tasks"))
    return e.groupBy("episode_index", why.alias("reason")).agg(F.count("*").alias("n"))


def delivered(spark, d):
    """Every frame that came, whatever its readings: ep, f."""
    return table(spark, d, "frames").where("episode_index IS NOT NULL AND frame_index IS NOT NULL").select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"))


@R.query("F06_count_match", """WITH l AS (SELECT episode_index AS ep, max(length) AS length FROM episodes GROUP BY episode_index), n AS (SELECT episode_index AS ep, count(DISTINCT frame_index) AS n_frames FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL GROUP BY ep)
SELECT l.ep, length, coalesce(n_frames, 0) AS n_frames, length = coalesce(n_frames, 0) AS matches FROM l LEFT JOIN n ON n.ep = l.ep WHERE l.ep IS NOT NULL AND length IS NOT NULL""")
def f06(spark, d):
    le = table(spark, d, "episodes").where("episode_index IS NOT NULL").groupBy(F.col("episode_index").alias("ep")).agg(F.max("length").alias("length")).where("length IS NOT NULL")
    n = delivered(spark, d).groupBy("ep").agg(F.count_distinct("f").alias("n_frames"))
    return le.join(n, "ep", "left").select("ep", "length", F.coalesce("n_frames", F.lit(0)).alias("n_frames"), (F.col("length") == F.coalesce("n_frames", F.lit(0))).alias("matches"))


@R.query("F07_semi_resources", "SELECT DISTINCT e.scene, e.episode_index FROM episodes e WHERE EXISTS (SELECT 1 FROM frames f WHERE f.episode_index = e.episode_index)")
def f07(spark, d):
    e = table(spark, d, "episodes").select("scene", "episode_index").distinct()
    return e.join(table(spark, d, "frames").select("episode_index"), "episode_index", "left_semi").select("scene", "episode_index")


_NAME = r"regexp_extract(path, '([^/\\]*)$', 1)"


@R.query("F08_X01_name_parse", rf"WITH n AS (SELECT file_id, {_NAME} AS name FROM image_files) SELECT file_id, name, TRY_CAST(split_part(name, '_', 2) AS BIGINT) AS episode FROM n WHERE TRY_CAST(split_part(name, '_', 2) AS BIGINT) IS NOT NULL")
def f08(spark, d):
    n = table(spark, d, "image_files").select("file_id", F.regexp_extract("path", r"([^/\\]*)$", 1).alias("name"))
    return n.withColumn("episode", fn.episode_of_name(F.col("name"))).where("episode IS NOT NULL")


@R.query("F20_missing_files", """WITH e AS (SELECT DISTINCT episode_index FROM episodes WHERE episode_index IS NOT NULL), i AS (SELECT DISTINCT CAST(regexp_extract(path, 'episode_0*(\\d+)_', 1) AS BIGINT) AS ep FROM image_files)
SELECT episode_index, printf('data/chunk-%03d/episode_%06d.parquet', episode_index // 1000, episode_index) AS expected FROM e WHERE episode_index NOT IN (SELECT ep FROM i WHERE ep IS NOT NULL)""".replace("\\\\", "\\"))
def f20(spark, d):
    have = table(spark, d, "image_files").select(F.regexp_extract("path", r"episode_0*(\d+)_", 1).try_cast("bigint").alias("episode_index")).distinct()
    e = table(spark, d, "episodes").where("episode_index IS NOT NULL").select("episode_index").distinct().join(have, "episode_index", "left_anti")
    ep = F.col("episode_index")
    return e.select(ep, F.format_string("data/chunk-%03d/episode_%06d.parquet", fn.chunk_of(ep), ep).alias("expected"))


@R.query("F21_constant_in_group", "SELECT episode_index, count(DISTINCT scene) AS n_scenes, count(DISTINCT robot) = 1 AS constant FROM frames WHERE episode_index IS NOT NULL GROUP BY episode_index")
def f21(spark, d):
    g = table(spark, d, "frames").where("episode_index IS NOT NULL").groupBy("episode_index")
    return g.agg(F.count_distinct("scene").alias("n_scenes"), (F.count_distinct("robot") == 1).alias("constant"))


@R.query("J01_latest_metadata", """WITH m AS (SELECT episode_index, arg_max(length, (recorded_at, arrived_at)) AS length FROM episodes WHERE length IS NOT NULL GROUP BY episode_index), f AS (SELECT episode_index, count(*) AS n_rows FROM frames WHERE episode_index IS NOT NULL GROUP BY episode_index)
SELECT f.episode_index, n_rows, coalesce(length, 0) AS length FROM f LEFT JOIN m USING (episode_index)""")
def j01(spark, d):
    m = tasks.latest_by(table(spark, d, "episodes").where("length IS NOT NULL"), ["episode_index"], F.struct("recorded_at", "arrived_at"), "length", "length")
    f = table(spark, d, "frames").where("episode_index IS NOT NULL").groupBy("episode_index").agg(F.count("*").alias("n_rows"))
    return f.join(m, "episode_index", "left").select("episode_index", "n_rows", F.coalesce("length", F.lit(0)).alias("length"))


@R.query("J02_J14_zip_images", f"""WITH {STEPS}, i AS (SELECT CAST(regexp_extract(path, 'episode_0*(\\d+)_0*(\\d+)', 1) AS BIGINT) AS ep, CAST(regexp_extract(path, 'episode_0*(\\d+)_0*(\\d+)', 2) AS BIGINT) AS f, min(file_id) FILTER (path LIKE '%rgb%') AS rgb_id, min(file_id) FILTER (path LIKE '%depth%') AS depth_id FROM image_files GROUP BY ALL)
SELECT s.ep, s.f, {q6('x')} AS x, rgb_id, depth_id FROM steps s JOIN i ON i.ep = s.ep AND i.f = s.f WHERE rgb_id IS NOT NULL""".replace("\\\\", "\\"))
def j02(spark, d):
    p = r"episode_0*(\d+)_0*(\d+)"
    i = table(spark, d, "image_files").select(F.regexp_extract("path", p, 1).try_cast("bigint").alias("ep"), F.regexp_extract("path", p, 2).try_cast("bigint").alias("f"), "file_id", "path")
    i = i.groupBy("ep", "f").agg(F.min(F.when(F.col("path").contains("rgb"), F.col("file_id"))).alias("rgb_id"), F.min(F.when(F.col("path").contains("depth"), F.col("file_id"))).alias("depth_id")).where("rgb_id IS NOT NULL")
    return steps(spark, d).join(i, ["ep", "f"]).select("ep", "f", r6("x").alias("x"), "rgb_id", "depth_id")


@R.query("J06_nearest_asof", f"""WITH {STEPS}, q AS (SELECT DISTINCT ep, CAST(f AS DOUBLE) * 0.1 + 0.03 AS want FROM steps), c AS (SELECT q.ep, want, s.f, abs(s.ts - want) AS gap, row_number() OVER (PARTITION BY q.ep, want ORDER BY abs(s.ts - want), s.f) AS k FROM q JOIN steps s ON s.ep = q.ep AND abs(s.ts - want) <= 0.15)
SELECT ep, {q6('want')} AS want, f, {q6('gap')} AS gap FROM c WHERE k = 1""")
def j06(spark, d):
    s = steps(spark, d)
    q = s.select("ep", (F.col("f").cast("double") * 0.1 + 0.03).alias("want")).distinct()
    return nearest_in_time(q, s.select("ep", "ts", "f"), "ep", "want", "ts", "f", 0.15).select("ep", r6("want").alias("want"), "f", r6("gap").alias("gap"))


def nearest_in_time(queries, rows, by, want, at, key, tolerance):
    """For each query the row of its group nearest in time within the tolerance; ties go to the smaller key.

    Rows are written to the time buckets beside their own, so queries meet them by
    group and bucket; a query without a row within the tolerance has no result.
    """
    b = lambda c: F.floor(F.col(c) / tolerance).cast("bigint")
    r = rows.select(F.col(by).alias("__by"), F.col(at).alias("__at"), F.col(key), F.explode(F.array(b(at) - 1, b(at), b(at) + 1)).alias("__b"))
    j = queries.withColumn("__q", b(want)).join(r, (F.col(by) == F.col("__by")) & (F.col("__q") == F.col("__b")))
    gap = F.abs(F.col("__at") - F.col(want))
    return j.where(gap <= tolerance).groupBy(by, want).agg(F.min(F.struct(gap.alias("gap"), F.col(key))).alias("m")).select(by, want, f"m.{key}", "m.gap")


_IV = f"""iv AS (SELECT episode_index AS ep, recorded_at, t.sub_indexes[1] AS lo, t.sub_indexes[2] AS hi FROM (SELECT episode_index, recorded_at, unnest(tasks) AS t FROM episodes) WHERE {_ok('t.sub_indexes')}),
lst AS (SELECT episode_index AS ep, max(recorded_at) AS recorded_at FROM episodes GROUP BY episode_index)"""


@R.query("J08_O03_enclosing_interval", f"""WITH {STEPS}, {_IV}, cur AS (SELECT iv.ep, lo, hi FROM iv JOIN lst ON lst.ep = iv.ep AND lst.recorded_at = iv.recorded_at), n AS (SELECT ep, max(f) AS last FROM steps GROUP BY ep)
SELECT s.ep, s.f, least(coalesce(min(hi), max(last)), max(last)) AS search_end FROM steps s JOIN n ON n.ep = s.ep LEFT JOIN cur ON cur.ep = s.ep AND s.f BETWEEN lo AND hi GROUP BY s.ep, s.f""")
def j08(spark, d):
    from helmwake.operators import visibility

    e = table(spark, d, "episodes").select(F.col("episode_index").alias("ep"), "recorded_at", F.explode("tasks").alias("t")).where(intervals.valid_pair(F.col("t.sub_indexes")))
    last_row = table(spark, d, "episodes").groupBy(F.col("episode_index").alias("ep")).agg(F.max("recorded_at").alias("recorded_at"))
    iv = e.join(last_row, ["ep", "recorded_at"]).groupBy("ep").agg(F.array_sort(F.collect_list(F.struct(F.col("t.sub_indexes")[1].alias("end"), F.col("t.sub_indexes")[0].alias("start")))).alias("iv"))
    s = steps(spark, d).withColumn("last", F.max("f").over(Window.partitionBy("ep"))).join(iv, "ep", "left")
    iv_or_none = F.coalesce("iv", F.array().cast("array<struct<end:bigint,start:bigint>>"))
    return s.select("ep", "f", visibility.enclosing_end(iv_or_none, F.col("f"), F.col("last")).alias("search_end")).distinct()


@R.query("J10_ST3_unprocessed", "SELECT scene, episode_index, count(*) AS n FROM episodes WHERE episode_index NOT IN (SELECT DISTINCT episode_index FROM documents WHERE episode_index IS NOT NULL) GROUP BY ALL")
def j10(spark, d):
    left = tasks.keep_unprocessed(table(spark, d, "episodes").where("episode_index IS NOT NULL"), table(spark, d, "documents"), ["episode_index"])
    return left.groupBy("scene", "episode_index").agg(F.count("*").alias("n"))


@R.query("J11_ST6_UD3_registry", "WITH f AS (SELECT task, min(task_index) AS first FROM tasks WHERE task IS NOT NULL GROUP BY task) SELECT CAST(row_number() OVER (ORDER BY first, task) - 1 AS BIGINT) AS task_index, task FROM f")
def j11(spark, d):
    return tasks.registry(table(spark, d, "tasks"), "task", ["task_index"])


@R.query("J12_scene_dimension", "SELECT s.robot_type, s.fps, count(*) AS n_rows, count(DISTINCT f.episode_index) AS n_episodes FROM frames f JOIN scenes s USING (scene) GROUP BY ALL")
def j12(spark, d):
    return table(spark, d, "frames").join(table(spark, d, "scenes").select("scene", "robot_type", "fps"), "scene").groupBy("robot_type", "fps").agg(F.count("*").alias("n_rows"), F.count_distinct("episode_index").alias("n_episodes"))


@R.query("A05_K04_totals", "SELECT count(DISTINCT episode_index) AS total_episodes, count(*) AS total_frames, count(DISTINCT task_index) AS total_tasks, CAST((count(DISTINCT episode_index) - 1) // 1000 + 1 AS BIGINT) AS total_chunks FROM (SELECT DISTINCT episode_index, frame_index, task_index FROM frames WHERE episode_index IS NOT NULL)")
def a05(spark, d):
    f = table(spark, d, "frames").where("episode_index IS NOT NULL").select("episode_index", "frame_index", "task_index").distinct()
    t = f.agg(F.count_distinct("episode_index").alias("total_episodes"), F.count("*").alias("total_frames"), F.count_distinct("task_index").alias("total_tasks"))
    return t.withColumn("total_chunks", (F.floor((F.col("total_episodes") - 1) / 1000) + 1).cast("bigint"))


@R.query("A07_episode_tasks", "SELECT episode_index, count(DISTINCT task_index) AS n_tasks, min(task_index) AS first_task FROM frames WHERE task_index >= 0 AND episode_index IS NOT NULL GROUP BY episode_index")
def a07(spark, d):
    g = table(spark, d, "frames").where("task_index >= 0 AND episode_index IS NOT NULL").groupBy("episode_index").agg(F.collect_set("task_index").alias("s"))
    return g.select("episode_index", F.size("s").cast("bigint").alias("n_tasks"), F.array_min("s").alias("first_task"))


@R.query("A16_status_report", "WITH e AS (SELECT episode_index, max(length) AS length FROM episodes WHERE episode_index IS NOT NULL GROUP BY episode_index), n AS (SELECT episode_index AS ep, count(DISTINCT frame_index) AS n FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL GROUP BY ep), s AS (SELECT CASE WHEN length IS NULL THEN 'SKIP' WHEN n IS NULL THEN 'ERROR' WHEN n = length THEN 'SUCCESS' ELSE 'FAIL' END AS status FROM e LEFT JOIN n ON n.ep = e.episode_index) SELECT status, count(*) AS n FROM s GROUP BY status")
def a16(spark, d):
    e = table(spark, d, "episodes").where("episode_index IS NOT NULL").groupBy(F.col("episode_index").alias("ep")).agg(F.max("length").alias("length"))
    j = e.join(delivered(spark, d).groupBy("ep").agg(F.count_distinct("f").alias("k")), "ep", "left")
    status = F.when(F.col("length").isNull(), "SKIP").when(F.col("k").isNull(), "ERROR").when(F.col("k") == F.col("length"), "SUCCESS").otherwise("FAIL")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@R.query("P01_P02_reorder_axes", f"WITH {STEPS} SELECT ep, f, {q6('x')} AS x, {q6('y')} AS y, CAST(0 AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS roll, {q6('yaw')} AS pitch FROM steps")
def p01(spark, d):
    from helmwake.operators.se3 import keep_axes
    from helmwake.sources.uav import pose_of_log

    log = F.array("x", "y", "z", F.lit(0.0), F.lit(0.0), "yaw", "ts")
    pose = pose_of_log(log)
    kept = keep_axes([pose[n] for n in ("x", "y", "z", "roll", "pitch", "yaw")], ["x", "y", "pitch"])
    return steps(spark, d).select("ep", "f", *[r6(c).alias(n) for n, c in zip(("x", "y", "z", "roll", "pitch"), kept)])


_PARTS = ", ".join(f'CAST(action[{i}] AS DOUBLE)' for i in range(1, 5)) + ", " + ", ".join(f'CAST("observation.state"[{i}] AS DOUBLE)' for i in range(1, 5))


@R.query("P05_frame_assembly", f"""SELECT episode_index AS ep, frame_index AS f, CAST(max(len(v)) AS BIGINT) AS n, {q6('max(' + ' + '.join(f'{i} * v[{i}]' for i in range(1, 9)) + ')')} AS content FROM (SELECT episode_index, frame_index, [{_PARTS}] AS v FROM frames WHERE len(action) >= 4 AND len("observation.state") >= 4)
WHERE NOT list_bool_or(list_transform(v, lambda x: isnan(x))) GROUP BY ALL""")
def p05(spark, d):
    t = table(spark, d, "frames").where("size(action) >= 4 AND size(`observation.state`) >= 4")
    t = t.select("episode_index", "frame_index", F.concat(F.slice("action", 1, 4), F.slice("`observation.state`", 1, 4)).cast("array<double>").alias("v")).where("NOT exists(v, x -> isnan(x))")
    content = F.lit(0.0)
    for i in range(8):
        content = content + (i + 1) * F.col("v")[i]
    return t.groupBy(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f")).agg(F.max(F.size("v")).cast("bigint").alias("n"), r6(F.max(content)).alias("content"))


@R.query("O10_first_discrepancies", """WITH e AS (SELECT episode_index AS ep, max(length) AS length FROM episodes WHERE episode_index IS NOT NULL GROUP BY ep), n AS (SELECT episode_index AS ep, count(DISTINCT frame_index) AS k FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL GROUP BY ep)
SELECT e.ep, 'episode ' || e.ep || ': expected ' || length || ' frames, found ' || coalesce(k, 0) AS message FROM e LEFT JOIN n ON n.ep = e.ep WHERE length <> coalesce(k, 0) ORDER BY e.ep LIMIT 5""")
def o10(spark, d):
    """The first five discrepancies of the status report, as messages: a report of five rows."""
    e = table(spark, d, "episodes").where("episode_index IS NOT NULL").groupBy(F.col("episode_index").alias("ep")).agg(F.max("length").alias("length"))
    j = e.join(delivered(spark, d).groupBy("ep").agg(F.count_distinct("f").alias("k")), "ep", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    return j.where("length <> k").select("ep", F.format_string("episode %d: expected %d frames, found %d", "ep", "length", "k").alias("message")).orderBy("ep").limit(5)


@R.query("X09_plain_json", "SELECT vec_id, to_json(list_transform(embedding, lambda v: CASE WHEN v > 0 THEN CAST(floor(CAST(v AS DOUBLE) * 1000) AS DOUBLE) END)) AS text FROM embeddings")
def x09(spark, d):
    """Vectors as JSON, numbers that JSON lacks as null."""
    v = F.transform("embedding", lambda x: F.when(x > 0, F.floor(x.cast("double") * 1000).cast("double")).otherwise(F.lit(float("nan"))))
    return table(spark, d, "embeddings").select("vec_id", fn.plain_json(v).alias("text"))


@R.query("X12_take_mask", "SELECT DISTINCT episode_index AS ep, frame_index AS f, [action[1], action[3], action[10]] AS taken, list_concat(action[1:1], action[3:4]) AS kept FROM frames WHERE action IS NOT NULL")
def x12(spark, d):
    a = F.col("action")
    t = table(spark, d, "frames").where("action IS NOT NULL")
    return t.select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), fn.take(a, F.array(*map(F.lit, (0, 2, 9)))).alias("taken"), fn.masked(a, F.array(*map(F.lit, (True, False, True, True)))).alias("kept")).distinct()


@R.query("UD9_zero_state", 'SELECT DISTINCT episode_index AS ep, frame_index AS f, list_transform("observation.state", lambda v: 0.0::FLOAT) AS state FROM frames WHERE "observation.state" IS NOT NULL')
def ud9(spark, d):
    from helmwake.operators.stats import zeroed

    s = "`observation.state`"
    return table(spark, d, "frames").where(f"{s} IS NOT NULL").select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), zeroed(F.col(s)).alias("state")).distinct()


@R.query("P11_extras", "SELECT episode_index, any_value(scene) AS scene, CAST(max(width) AS DOUBLE) / 2 AS cx, CAST(max(height) AS DOUBLE) / 2 AS cy FROM (SELECT DISTINCT episode_index, scene FROM episodes WHERE episode_index IS NOT NULL) JOIN scenes USING (scene) GROUP BY episode_index HAVING count(*) = 1")
def p11(spark, d):
    e = table(spark, d, "episodes").where("episode_index IS NOT NULL").select("episode_index", "scene").distinct().join(table(spark, d, "scenes").select("scene", "width", "height"), "scene")
    g = e.groupBy("episode_index").agg(F.min("scene").alias("scene"), F.max("width").alias("w"), F.max("height").alias("h"), F.count("*").alias("k")).where("k = 1")
    return g.select("episode_index", "scene", (F.col("w").cast("double") / 2).alias("cx"), (F.col("h").cast("double") / 2).alias("cy"))


@R.query("G28_rounding", f"WITH {STEPS} SELECT ep, f, CAST(round_even(f / 2.0, 0) AS BIGINT) AS half, CAST(least(greatest(floor(yaw), -90.0), 90.0) AS BIGINT) AS clipped FROM steps")
def g28(spark, d):
    from helmwake.operators.se3 import clip

    return steps(spark, d).select("ep", "f", half_even(F.col("f") / 2.0).cast("bigint").alias("half"), clip(F.floor("yaw").cast("double"), -90.0, 90.0).cast("bigint").alias("clipped"))


@R.query("O01_O02_numeric_order", rf"""WITH n AS (SELECT file_id, coalesce(nullif(lower(regexp_extract(path, '(?i)observation\.images\.(rgb|depth)', 1)), ''), CASE WHEN "observation.images.rgb" IS NOT NULL THEN 'rgb' WHEN "observation.images.depth" IS NOT NULL THEN 'depth' END) AS image_key, {_NAME} AS name FROM image_files),
p AS (SELECT file_id, image_key, name, split_part(name, '_', 2) AS ep, TRY_CAST(regexp_extract(name, '(\d+)\D*$', 1) AS BIGINT) AS k FROM n)
SELECT file_id, ep, k, row_number() OVER (PARTITION BY image_key, ep ORDER BY k NULLS LAST, file_id) AS place, row_number() OVER (PARTITION BY image_key, ep ORDER BY encode(name), file_id) AS lexical_place FROM p""")
def o01(spark, d):
    n = entries(table(spark, d, "image_files")).select("file_id", "image_key", fn.base_name(F.translate("path", "\\", "/")).alias("name"))
    n = n.select("file_id", "image_key", "name", F.coalesce(F.try_element_at(F.split("name", "_"), F.lit(2)), F.lit("")).alias("ep"), fn.last_number(F.col("name")).alias("k"))
    place = F.row_number().over(Window.partitionBy("image_key", "ep").orderBy(F.col("k").asc_nulls_last(), "file_id")).cast("bigint")
    lexical = F.row_number().over(Window.partitionBy("image_key", "ep").orderBy("name", "file_id")).cast("bigint")
    return n.select("file_id", "ep", "k", place.alias("place"), lexical.alias("lexical_place"))


@R.query("O04_O05_O06_top_report", "SELECT scene, count(*) AS n FROM frames GROUP BY scene ORDER BY n DESC, scene LIMIT 10")
def o05(spark, d):
    return table(spark, d, "frames").groupBy("scene").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "scene").limit(10)


@R.query("X02_K01_layout", "SELECT DISTINCT episode_index, printf('data/chunk-%03d/episode_%06d.parquet', episode_index // 1000, episode_index) AS path FROM frames WHERE episode_index IS NOT NULL")
def x02(spark, d):
    ep = F.col("episode_index")
    return table(spark, d, "frames").where(ep.isNotNull()).select(ep).distinct().select(ep, F.format_string("data/chunk-%03d/%s.parquet", fn.chunk_of(ep), fn.episode_name(ep)).alias("path"))


@R.query("X03_X04_X05_X06_S18_paths", r"""WITH n AS (SELECT file_id, replace(path, '\', '/') AS path FROM image_files), p AS (SELECT file_id, path, regexp_extract(path, '^(.*?)/(?:data|meta|videos)/', 1) AS root FROM n)
SELECT file_id, root, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '[^\p{L}\p{N}_-]', '_', 'g') AS safe, regexp_extract(root, '^([^-_]*)', 1) AS prefix, TRY_CAST(regexp_extract(path, '(\d+)\D*$', 1) AS BIGINT) AS last_no FROM p""")
def x03(spark, d):
    p = table(spark, d, "image_files").select("file_id", F.translate("path", "\\", "/").alias("path")).withColumn("root", fn.scene_root(F.col("path")))
    path = F.col("path")
    return p.select("file_id", "root", fn.parent(path).alias("parent"), fn.file_safe(fn.base_name(path)).alias("safe"), fn.scene_prefix(F.col("root")).alias("prefix"), fn.last_number(path).alias("last_no"))


@R.query("X07_S06_json_lines", """SELECT stream, count(*) AS n_lines, count(*) FILTER (TRY(json_type(payload)) = 'OBJECT') AS n_good, CAST(sum(TRY_CAST(TRY(json_extract_string(payload, '$.frame_index')) AS BIGINT)) AS BIGINT) AS frame_sum FROM raw_records GROUP BY stream""")
def x07(spark, d):
    from helmwake.sources.jsonl import json_objects

    t = table(spark, d, "raw_records")
    v = json_objects(t, "payload")
    good = v.groupBy("stream").agg(F.count("*").alias("n_good"), F.sum(F.expr("try_variant_get(v, '$.frame_index', 'bigint')")).alias("frame_sum"))
    return t.groupBy("stream").agg(F.count("*").alias("n_lines")).join(good, "stream", "left").select("stream", "n_lines", F.coalesce("n_good", F.lit(0)).alias("n_good"), "frame_sum")


@R.query("X08_canonical_key", "SELECT count(*) AS n_rows, count(DISTINCT CAST(to_json(tasks) AS VARCHAR)) AS n_keys FROM episodes WHERE tasks IS NOT NULL")
def x08(spark, d):
    return table(spark, d, "episodes").where("tasks IS NOT NULL").agg(F.count("*").alias("n_rows"), F.count_distinct(tasks.canonical_key(F.col("tasks"))).alias("n_keys"))


@R.query("X10_defaults", "SELECT source, count(*) AS n, max(CASE source WHEN 'field_log' THEN 'log' WHEN 'checklist' THEN 'list' ELSE 'other' END) AS kind FROM documents WHERE source IS NOT NULL GROUP BY source")
def x10(spark, d):
    m = F.create_map(F.lit("field_log"), F.lit("log"), F.lit("checklist"), F.lit("list"))
    return table(spark, d, "documents").where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"), F.max(fn.with_default(m, F.col("source"), "other")).alias("kind"))


@R.query("X14_base64", 'SELECT file_id, to_base64("observation.images.rgb") AS payload FROM image_files WHERE "observation.images.rgb" IS NOT NULL AND octet_length("observation.images.rgb") > 0')
def x14(spark, d):
    c = "`observation.images.rgb`"
    return table(spark, d, "image_files").where(f"{c} IS NOT NULL AND octet_length({c}) > 0").select("file_id", fn.base64_line(F.col(c)).alias("payload"))


@R.query("S04_scene_discovery", r"WITH p AS (SELECT regexp_extract(replace(path, '\', '/'), '([a-z]+-[a-z]+__[0-9a-f]+)/videos+/', 1) AS scene, path LIKE '%images.rgb%' AS rgb, path LIKE '%images.depth%' AS depth FROM image_files) SELECT scene, bool_or(rgb) AS has_rgb, bool_or(depth) AS has_depth, count(*) AS n FROM p WHERE scene <> '' GROUP BY scene HAVING bool_or(rgb)")
def s04(spark, d):
    path = F.translate("path", "\\", "/")
    p = table(spark, d, "image_files").select(F.regexp_extract(path, r"([a-z]+-[a-z]+__[0-9a-f]+)/videos+/", 1).alias("scene"), F.col("path").contains("images.rgb").alias("rgb"), F.col("path").contains("images.depth").alias("depth"))
    return p.where("scene <> ''").groupBy("scene").agg(F.bool_or("rgb").alias("has_rgb"), F.bool_or("depth").alias("has_depth"), F.count("*").alias("n")).where("has_rgb")


@R.query("S17_size_probe", r"""WITH p AS (SELECT regexp_extract(replace(path, '\', '/'), '([a-z]+-[a-z]+__[0-9a-f]+)/videos+/', 1) AS scene, hex("observation.images.rgb") AS h FROM image_files),
s AS (SELECT scene, CAST('0x' || substr(h, 33, 8) AS INTEGER) AS width, CAST('0x' || substr(h, 41, 8) AS INTEGER) AS height FROM p WHERE scene <> '' AND starts_with(h, '89504E470D0A1A0A') AND len(h) >= 52)
SELECT scene, min(width) AS least_width, max(width) AS width, min(height) AS least_height, max(height) AS height, count(*) AS n FROM s GROUP BY scene ORDER BY scene LIMIT 5""")
def s17(spark, d):
    """Image sizes of the first five scenes, from the headers: a probe of five rows."""
    from helmwake.sources.images import header_size

    path = F.translate("path", "\\", "/")
    w, h = header_size(F.col("`observation.images.rgb`"))
    p = table(spark, d, "image_files").select(F.regexp_extract(path, r"([a-z]+-[a-z]+__[0-9a-f]+)/videos+/", 1).alias("scene"), w.alias("w"), h.alias("h")).where("scene <> '' AND w IS NOT NULL")
    return p.groupBy("scene").agg(F.min("w").alias("least_width"), F.max("w").alias("width"), F.min("h").alias("least_height"), F.max("h").alias("height"), F.count("*").alias("n")).orderBy("scene").limit(5)


@R.query("O07_seeded_sample", "SELECT scene, episode_index FROM (SELECT DISTINCT scene, episode_index FROM episodes) ORDER BY md5(concat_ws(':', scene, episode_index, '42')), scene, episode_index LIMIT 20")
def o07(spark, d):
    """Twenty episodes by a seeded order: a sampling operator, the same for every run."""
    return table(spark, d, "episodes").select("scene", "episode_index").distinct().orderBy(F.md5(F.concat_ws(":", "scene", "episode_index", F.lit("42"))), "scene", "episode_index").limit(20)


@R.query("A02_S09_image_stats")
def a02(spark, d):
    """Channel statistics of the RGB images, decoded on the executors."""
    from helmwake.sources.images import channel_stats

    return channel_stats(table(spark, d, "image_files"), "observation.images.rgb")


@R.query("S09_S10_depth_stats")
def s09(spark, d):
    """Depth of each decodable depth image in metres."""
    from helmwake.sources.images import depth_stats

    return depth_stats(table(spark, d, "image_files"), "observation.images.depth")


# round trips: written by the sinks to the shared folder and read back by the sources


def _fresh(spark, name):
    return shared_path(spark, f"{name}_{uuid.uuid4().hex}")


@R.query("K01_S03_S05_episode_files", f"WITH {STEPS} SELECT ep, f, {q6('max(x)')} AS x, {q6('max(yaw)')} AS yaw, 'data/chunk-' || lpad(CAST(ep // 1000 AS VARCHAR), 3, '0') AS chunk FROM steps GROUP BY ep, f")
def k01(spark, d):
    """One Parquet file per episode, read back as one table."""
    from helmwake.sinks.episodes import write_frames
    from helmwake.sources.episodes import read_frames

    root = _fresh(spark, "k01")
    write_frames(steps(spark, d).groupBy(F.col("ep").alias("episode_index"), F.col("f").alias("frame_index")).agg(F.max("x").alias("x"), F.max("yaw").alias("yaw")), f"{root}/scene")
    t = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/scene/data").select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), F.regexp_extract("_metadata.file_path", r"(data/chunk-\d+)/", 1).alias("chunk"))
    r = read_frames(spark, f"{root}/scene").select(F.col("episode_index").alias("ep"), F.col("frame_index").alias("f"), r6("x").alias("x"), r6("yaw").alias("yaw"))
    return r.join(t, ["ep", "f"]).select("ep", "f", "x", "yaw", "chunk")


@R.query("K08_S12_cloud_files", f"WITH {POSES} SELECT CAST(ep AS VARCHAR) AS scene, count(*) AS n, {q6('sum(px)')} AS x, {q6('min(py)')} AS y, {q6('max(pz)')} AS z FROM poses GROUP BY ep")
def k08(spark, d):
    """Point clouds as PLY files, one per scene, read back."""
    from helmwake.sinks.files import write_clouds
    from helmwake.sources.clouds import read_ply

    root = _fresh(spark, "k08")
    p = poses(spark, d).select(F.col("ep").cast("string").alias("scene"), F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"))
    write_clouds(p, root).write.parquet(f"{root}_list")
    c = read_ply(spark, root).select(F.regexp_extract("path", r"([^/]+)\.ply$", 1).alias("scene"), "x", "y", "z")
    return c.groupBy("scene").agg(F.count("*").alias("n"), r6(F.sum("x")).alias("x"), r6(F.min("y")).alias("y"), r6(F.max("z")).alias("z"))


@R.query("K05_O09_S07_metadata_lines", "SELECT episode_index, count(*) AS n FROM (SELECT DISTINCT scene, episode_index, length FROM episodes WHERE episode_index IS NOT NULL) GROUP BY episode_index")
def k05(spark, d):
    """Metadata as ordered JSON lines, of which only the episode numbers are read back."""
    from helmwake.sinks.episodes import write_jsonl
    from helmwake.sources.jsonl import read_episode_indexes

    path = f"{_fresh(spark, 'k05')}/scene/meta/episodes.jsonl"
    write_jsonl(table(spark, d, "episodes").where("episode_index IS NOT NULL").select("scene", "episode_index", "length").distinct(), path, ["episode_index", "scene", "length"])
    return read_episode_indexes(spark, path).groupBy("episode_index").agg(F.count("*").alias("n"))


@R.query("K09_csv_report", "SELECT scene, count(*) AS n, max(episode_index) AS last FROM frames GROUP BY scene")
def k09(spark, d):
    """A report as one ordered CSV file, read back."""
    from helmwake.sinks.files import write_report

    root = _fresh(spark, "k09")
    write_report(table(spark, d, "frames").groupBy("scene").agg(F.count("*").alias("n"), F.max("episode_index").alias("last")), root, ["scene"])
    return spark.read.option("header", "true").schema("scene string, n bigint, last bigint").csv(root)


@R.query("K02_S08_image_files", """SELECT file_id, octet_length("observation.images.rgb") AS n_bytes, md5("observation.images.rgb") AS digest FROM image_files WHERE octet_length("observation.images.rgb") > 0""")
def k02(spark, d):
    """Images as files in folders, listed and read back; no bytes make no image."""
    from helmwake.sinks.files import write_images

    root = _fresh(spark, "k02")
    i = table(spark, d, "image_files").where("octet_length(`observation.images.rgb`) > 0").select(F.format_string("rgb/%03d/image_%d.png", F.col("file_id") % 100, "file_id").alias("path"), F.col("`observation.images.rgb`").alias("data"))
    write_images(i, root).write.parquet(f"{root}_list")
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return r.select(F.regexp_extract("path", r"image_(\d+)\.png$", 1).cast("bigint").alias("file_id"), F.col("length").alias("n_bytes"), F.md5("content").alias("digest"))
