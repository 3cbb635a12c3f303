"""Episode files of navigation scenes: matrices per frame, metadata beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from helmwake.operators.se3 import flat_matrix

# The goal columns, in order of priority.
GOALS = ("relative_goal_frame_id.125cm_30deg", "relative_goal_frame_id.125cm_45deg", "relative_goal_frame_id.60cm_15deg", "relative_goal_frame_id.60cm_30deg")


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """All episode files of a tree in one scan (S03, S05): scene, episode_index, row and the files' columns.

    The episode is taken from the file's name; files with other names are left
    out (F08). Matrices come out flat, whether stored nested or flat.
    """
    t = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "episode_*.parquet").option("mergeSchema", "true").parquet(path)
    file = F.col("_metadata.file_path")
    # the path names scene and episode, whatever columns of these names the files hold
    cols = [_flat(t, c).alias(c) for c in t.columns if c not in ("scene", "episode_index", "row")]
    t = t.select(F.regexp_extract(file, r"([^/]+)/data/", 1).alias("scene"), F.regexp_extract(file, r"episode_0*(\d+)\.parquet$", 1).try_cast("bigint").alias("episode_index"), F.col("_metadata.row_index").alias("row"), *cols)
    return t.where("episode_index IS NOT NULL")


def _flat(t: DataFrame, c: str) -> Column:
    kind = t.schema[c].dataType
    nested = isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType)
    return flat_matrix(F.col(f"`{c}`"), nested)


def goal_columns(t: DataFrame) -> list[str]:
    """The goal columns a table has, by priority; having none is an error."""
    have = [c for c in GOALS if c in t.columns]
    if not have:
        raise KeyError(f"none of the goal columns {list(GOALS)}")
    return have
