"""Queries of the data-quality operators (problems 3 to 7); each takes (spark, data directory)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helmwake.operators import consolidate, drift, intervals, orphans, spikes
from helmwake.session import shared_path, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return intervals.episode_periods(table(spark, d, "episodes"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.flag_spikes(table(spark, d, "frames"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Flagged numbers per field and dimension."""
    return p4_found(spark, d).groupBy("field_name", "dim").agg(F.count("*").alias("n_flagged"), F.count_distinct("episode_index").alias("n_episodes"))


def p4_angles(spark: SparkSession, d: str) -> DataFrame:
    """Frames whose yaw no angle can have, and whether that number is flagged."""
    flags = p4_found(spark, d).where("field_name = 'observation.state' AND dim = 3").select("episode_index", "frame_index", F.lit(True).alias("flagged"))
    odd = table(spark, d, "frames").where("episode_index IS NOT NULL AND frame_index IS NOT NULL AND NOT isnan(get(`observation.state`, 3)) AND abs(get(`observation.state`, 3)) > 180.01")
    return odd.select("episode_index", "frame_index").distinct().join(flags, ["episode_index", "frame_index"], "left").select("episode_index", "frame_index", F.coalesce("flagged", F.lit(False)).alias("flagged"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.surplus(table(spark, d, "image_files"))


def p5_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Writes the consolidated files to the shared folder and reports them."""
    out = shared_path(spark, "p5_" + hashlib.sha1(d.encode()).hexdigest()[:12])
    return consolidate.consolidate(table(spark, d, "image_files"), out)


def p5_volumes(spark: SparkSession, d: str) -> DataFrame:
    """Images, bytes and key range of the consolidated files, per image key."""
    lo, hi = F.min(F.struct("first_episode", "first_frame")), F.max(F.struct("last_episode", "last_frame"))
    m = p5_manifest(spark, d).where("image_key <> 'none'").groupBy("image_key").agg(*[F.sum(c).alias(c) for c in ("n_images", "n_bytes", "n_complete")], lo.alias("lo"), hi.alias("hi"))
    return m.select("image_key", "n_images", "n_bytes", "n_complete", "lo.first_episode", "lo.first_frame", "hi.last_episode", "hi.last_frame")


def p5_images(spark: SparkSession, d: str) -> DataFrame:
    """The images with the number of their entries and the completeness of the best one."""
    return consolidate.merged(table(spark, d, "image_files")).select(*consolidate.IMAGE, "first_file_id", "n_entries", "kept_complete")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "raw_records"))


def p6_lifespans(spark: SparkSession, d: str) -> DataFrame:
    return drift.lifespans(table(spark, d, "raw_records"))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    t = drift.consistent_table(table(spark, d, "raw_records"))
    return t.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in t.columns if c != "other"], F.to_json("other").alias("other"))


def p6_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the consistent table per stream, and how many hold each quantity."""
    t = drift.consistent_table(table(spark, d, "raw_records"))
    held = [F.count(f"`{c}`").alias(c.replace(".", "_")) for c in drift.TARGET]
    return t.groupBy("stream").agg(F.count("*").alias("n_lines"), *held, F.sum("frame_index").alias("frame_sum"), F.round(F.sum("timestamp"), 3).alias("time_sum"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans(*[table(spark, d, t) for t in ("frames", "documents", "episodes", "tasks")])


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p7_found(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = [p3_found, p4_found, p4_report, p4_angles, p5_found, p5_manifest, p5_volumes, p5_images, p6_found, p6_lifespans, p6_table, p6_coverage, p7_found, p7_report]
    return {f.__name__: f for f in fs}


_RANGES = """
ranges AS (
  SELECT episode_index, layer, p[1] AS a, p[2] AS z FROM (
    SELECT episode_index, 'sub' AS layer, t.sub_indexes AS p FROM (SELECT episode_index, unnest(tasks) AS t FROM episodes)
    UNION ALL
    SELECT episode_index, 'sum' AS layer, t.sum_indexes AS p FROM (SELECT episode_index, unnest(tasks) AS t FROM episodes))
  WHERE len(p) = 2 AND p[1] <= p[2])"""

_ORPHANS = """
refs AS (
  SELECT DISTINCT 'frames' AS child_table, 'episode_index' AS ref_column, episode_index AS ref_key, strftime(recorded_at, '%Y-%m') AS period FROM frames
  UNION SELECT DISTINCT 'frames', 'task_index', task_index, strftime(recorded_at, '%Y-%m') FROM frames
  UNION SELECT DISTINCT 'documents', 'episode_index', episode_index, strftime(written_at, '%Y-%m') FROM documents),
found AS (
  SELECT * FROM refs WHERE ref_key IS NOT NULL AND ref_key <> -1 AND (
    (ref_column = 'episode_index' AND ref_key NOT IN (SELECT episode_index FROM episodes WHERE deleted_at IS NULL AND episode_index IS NOT NULL))
    OR (ref_column = 'task_index' AND ref_key NOT IN (SELECT task_index FROM tasks WHERE deleted_at IS NULL AND task_index IS NOT NULL))))"""

_ENTRIES = r"""
entries AS (
  SELECT file_id, lower(regexp_extract(path, '(?i)observation\.images\.(rgb|depth)', 1)) AS image_key,
    CAST(regexp_extract(path, 'episode_0*(\d+)_0*(\d+)', 1) AS BIGINT) AS episode_index, CAST(regexp_extract(path, 'episode_0*(\d+)_0*(\d+)', 2) AS BIGINT) AS frame_index,
    coalesce("observation.images.rgb", "observation.images.depth") AS data
  FROM image_files),
images AS (
  SELECT image_key, episode_index, frame_index, min(file_id) AS first_file_id, count(*) AS n_entries,
    bool_or(starts_with(hex(data), '89504E470D0A1A0A') AND ends_with(hex(data), '0000000049454E44AE426082')) AS kept_complete
  FROM entries GROUP BY ALL)"""


_ALIAS = "CASE " + " ".join(f"WHEN field IN ({', '.join(repr(n) for n in ns)}) THEN '{q}'" for q, ns in drift.ALIASES.items()) + " ELSE field END"
_VALUES = """
lines AS (SELECT stream, file_id, line_no, recorded_at, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS p FROM raw_records WHERE stream IS NOT NULL AND file_id IS NOT NULL),
ord AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY r NULLS FIRST, file_id) AS ord FROM (SELECT stream, file_id, min(recorded_at) AS r FROM lines GROUP BY ALL)),
keyed AS (SELECT stream, file_id, line_no, p, unnest(json_keys(p)) AS field FROM lines WHERE json_type(p) = 'OBJECT'),
vals AS (SELECT * EXCLUDE (p), json_extract(p, '$."' || field || '"') AS v FROM keyed)"""
_SPANS = _VALUES + """,
kinds AS (SELECT stream, file_id, field, CASE json_type(v) WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'truth value' WHEN 'OBJECT' THEN 'object'
  WHEN 'ARRAY' THEN CASE json_type(v, '$[0]') WHEN 'ARRAY' THEN 'list of lists' WHEN 'VARCHAR' THEN 'list of texts' ELSE 'list of numbers' END ELSE 'number' END AS kind FROM vals WHERE v IS NOT NULL AND json_type(v) <> 'NULL'),
held AS (SELECT stream, field, arg_max(kind, (n, kind)) AS kind, ord FROM (SELECT *, count(*) AS n FROM kinds GROUP BY ALL) JOIN ord USING (stream, file_id) GROUP BY stream, file_id, ord, field),
spans AS (SELECT stream, field, kind, min(ord) AS first_ord, max(ord) AS last_ord FROM (SELECT *, ord - row_number() OVER (PARTITION BY stream, field, kind ORDER BY ord) AS island FROM held) GROUP BY stream, field, kind, island)"""
_CHANGES = f"""{_SPANS},
gone AS (SELECT stream, last_ord + 1 AS ord, field, {_ALIAS} AS q FROM spans), came AS (SELECT stream, first_ord AS ord, field, {_ALIAS} AS q FROM spans WHERE first_ord > 1),
same AS (SELECT stream, ord, field FROM gone JOIN came USING (stream, ord, field)),
g AS (SELECT *, row_number() OVER (PARTITION BY stream, ord, q ORDER BY field) AS k FROM gone ANTI JOIN same USING (stream, ord, field)),
c AS (SELECT *, row_number() OVER (PARTITION BY stream, ord, q ORDER BY field) AS k FROM came ANTI JOIN same USING (stream, ord, field)),
pairs AS (SELECT stream, ord, 'retyped' AS change_kind, field AS old_field, field AS new_field FROM same
  UNION ALL SELECT coalesce(g.stream, c.stream), coalesce(g.ord, c.ord), CASE WHEN g.field IS NULL THEN 'added' WHEN c.field IS NULL THEN 'removed' ELSE 'renamed' END, coalesce(g.field, ''), coalesce(c.field, '')
    FROM g FULL JOIN c ON g.stream = c.stream AND g.ord = c.ord AND g.q = c.q AND g.k = c.k)"""
_COVERED = ", ".join(f"count(*) FILTER (list_has_any(fields, [{', '.join(repr(n) for n in drift.ALIASES[q])}])) AS {q.replace('.', '_')}" for q in drift.TARGET)


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"""
WITH {_RANGES},
reach AS (SELECT *, max(z) OVER (PARTITION BY episode_index, layer ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ranges),
islands AS (SELECT *, sum(CASE WHEN r IS NULL OR a > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_index, layer ORDER BY a, z) AS k FROM reach),
periods AS (SELECT episode_index, layer, k, min(a) AS f, max(z) AS l FROM islands GROUP BY ALL)
SELECT episode_index, layer, 'period' AS kind, f AS first_frame, l AS last_frame FROM periods
UNION ALL
SELECT p.episode_index, p.layer, 'gap', p.l + 1, n.f - 1 FROM periods p JOIN periods n ON n.episode_index = p.episode_index AND n.layer = p.layer AND n.k = p.k + 1""",
        "p5_found": f"WITH {_ENTRIES} SELECT DISTINCT i.first_file_id AS file_id_a, e.file_id AS file_id_b FROM entries e JOIN images i USING (image_key, episode_index, frame_index) WHERE e.file_id <> i.first_file_id",
        "p5_images": f"WITH {_ENTRIES} SELECT image_key, episode_index, frame_index, first_file_id, n_entries, kept_complete FROM images",
        "p4_angles": """SELECT DISTINCT episode_index, frame_index, true AS flagged FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL AND NOT isnan("observation.state"[4]) AND abs("observation.state"[4]) > 180.01""",
        "p5_volumes": f"""WITH {_ENTRIES}, e AS (SELECT x.*, modified_at, octet_length(coalesce(data, ''::BLOB)) AS size, coalesce(starts_with(hex(data), '89504E470D0A1A0A') AND ends_with(hex(data), '0000000049454E44AE426082'), false) AS complete FROM entries x JOIN image_files USING (file_id)),
best AS (SELECT image_key, episode_index, frame_index, arg_max((complete, size), (complete, size, coalesce(modified_at, TIMESTAMP '0001-01-01'), -file_id)) AS b FROM e GROUP BY ALL)
SELECT image_key, count(*) AS n_images, CAST(sum(b[2]) AS BIGINT) AS n_bytes, CAST(sum(CAST(b[1] AS INT)) AS BIGINT) AS n_complete, min((episode_index, frame_index))[1] AS first_episode, min((episode_index, frame_index))[2] AS first_frame, max((episode_index, frame_index))[1] AS last_episode, max((episode_index, frame_index))[2] AS last_frame FROM best GROUP BY image_key""",
        "p6_found": f"WITH {_CHANGES} SELECT DISTINCT file_id, change_kind, old_field, new_field FROM pairs JOIN ord USING (stream, ord)",
        "p6_lifespans": f"WITH {_SPANS} SELECT stream, field, kind, first_ord, last_ord FROM spans",
        "p6_coverage": f"""WITH {_VALUES}, held AS (SELECT stream, file_id, line_no, list(field) FILTER (json_type(v) <> 'NULL') AS fields, max(TRY_CAST(json_extract_string(v, '$') AS BIGINT)) FILTER ({_ALIAS} = 'frame_index') AS fi, max(TRY_CAST(json_extract_string(v, '$') AS DOUBLE)) FILTER ({_ALIAS} = 'timestamp') AS ts FROM vals GROUP BY ALL)
SELECT stream, count(*) AS n_lines, {_COVERED}, CAST(sum(fi) AS BIGINT) AS frame_sum, round(sum(ts), 3) AS time_sum FROM held GROUP BY stream""",
        "p7_found": f"WITH {_ORPHANS} SELECT child_table, ref_column, ref_key, period FROM found",
        "p7_report": f"WITH {_ORPHANS} SELECT child_table, ref_column, period, count(DISTINCT ref_key) AS n_orphans FROM found GROUP BY ALL",
    }
