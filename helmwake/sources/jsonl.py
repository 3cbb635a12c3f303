"""JSON Lines with broken lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def json_objects(lines: DataFrame, text: str) -> DataFrame:
    """The lines whose text is a JSON object, parsed as the variant ``v``; all others are left out."""
    p = lines.withColumn("v", F.try_parse_json(F.col(text)))
    return p.where(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: file, line_no (from 1), text. Lines are numbered within their file only."""
    t = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"), F.monotonically_increasing_id().alias("__id"))
    return t.select("file", F.row_number().over(Window.partitionBy("file").orderBy("__id")).cast("bigint").alias("line_no"), "text")


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """meta/episodes.jsonl files: scene, file, line_no, episode_index, tasks (JSON text); bad lines skipped."""
    v = json_objects(read_lines(spark, path), "text")
    scene = F.regexp_extract("file", r"([^/]+)/meta/[^/]*$", 1)
    return v.select(scene.alias("scene"), "file", "line_no", F.expr("try_variant_get(v, '$.episode_index', 'bigint')").alias("episode_index"), F.to_json(F.expr("try_variant_get(v, '$.tasks', 'variant')")).alias("tasks")).where("episode_index IS NOT NULL")


def read_episode_indexes(spark: SparkSession, path: str) -> DataFrame:
    """Only (scene, episode_index); the tasks are never built."""
    return read_episodes(spark, path).select("scene", "episode_index")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Names already processed, one per line; blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''").distinct()
